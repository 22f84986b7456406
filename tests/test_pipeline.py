"""The production path: raw files -> bronze readers -> silver -> gold."""

import os
import time

import pytest
from pyspark.sql import functions as F

from odflow.lake import Lake
from odflow.plans import questions as Q
from odflow.plans.pipeline import BronzeInputs, build_all, together
from odflow.plans.silver import resolve_all_levels
from odflow.sources import files
from odflow.sources import fixtures as fx
from odflow.sources.fixture_lake import trip_folder
from odflow.streaming.ingest import LEVEL_FILES

SF = "/root/testdata/sf0.001"


def test_build_from_files_matches_one_pass_resolution(spark, scratch):
    levels = {lv: files.read_trip_csv(spark, trip_folder(spark, SF), LEVEL_FILES[lv]) for lv in LEVEL_FILES}
    b = BronzeInputs(
        relaciones=fx.relaciones(spark, SF),
        poblacion=fx.bronze_poblacion(spark, SF),
        renta=fx.bronze_renta(spark, SF),
        calendario=fx.bronze_calendario(spark, SF),
        provincias=fx.bronze_provincias(spark, SF),
        geo_by_level={lv: fx.bronze_geo(spark, SF, p) for lv, p in
                      (("municipios", "municipio"), ("distritos", "distrito"), ("gaus", "gau"))},
        trips_by_level=levels,
    )
    lake = Lake(spark, os.path.join(scratch, "lake"))
    build_all(lake, b)

    silver = lake.read("silver", "viajes")
    expected = resolve_all_levels(fx.bronze_trips(spark, SF), fx.relaciones(spark, SF))
    cols = expected.columns
    assert sorted(map(tuple, silver.select(*cols).collect())) == sorted(map(tuple, expected.collect()))

    # gold totals equal silver totals per zone and day
    for lv in LEVEL_FILES:
        g = lake.read("gold", f"mobility_{lv}_periodo").groupBy("fecha").agg(F.sum("total_viajes").alias("t"))
        s = silver.filter(F.col("tipo_zona") == lv).groupBy("fecha").agg(F.sum("viajes").alias("t"))
        assert sorted(map(tuple, g.collect())) == sorted(map(tuple, s.collect()))

    # shares of every day sum to 1 (or 0 for a day without trips)
    gold = lake.read("gold", "mobility_municipios_periodo")
    hourly = gold.groupBy("fecha", F.col("periodo").cast("int").alias("periodo")).agg(F.sum("total_viajes").alias("total_viajes"))
    v = Q.day_vectors(hourly)
    sums = v.select(sum(F.col(f"s{h:02d}") for h in range(24)).alias("t")).collect()
    assert all(abs(r.t - 1.0) < 1e-9 or r.t == 0.0 for r in sums)


def test_loads_side_by_side_all_end_before_an_error_is_raised(spark):
    done = []

    def late():
        time.sleep(0.5)
        done.append(spark.range(3).count())

    def broken():
        raise ValueError("broken load")

    with pytest.raises(ValueError, match="broken load"):
        together(spark, broken, late)
    assert done == [3]


def _star(spark, folder, lines, files):
    """A star schema of ``lines`` trips, lineitem in several files."""
    n = spark.range(lines)
    tables = {
        "region": spark.range(5).selectExpr("id r_regionkey", "concat('R', id) r_name"),
        "nation": spark.range(25).selectExpr("id n_nationkey", "concat('N', id) n_name", "id % 5 n_regionkey"),
        "customer": spark.range(40).selectExpr("id c_custkey", "id % 25 c_nationkey", "1.5D c_acctbal"),
        "supplier": spark.range(10).selectExpr("id s_suppkey", "id % 25 s_nationkey"),
        "orders": spark.range(30).selectExpr("id o_orderkey", "if(id = 7, null, id % 40) o_custkey"),
        "lineitem": n.selectExpr("id % 30 l_orderkey", "id l_partkey", "id % 10 l_suppkey", "id div 14 % 7 l_linenumber", "2.0D l_quantity",
                                 "10.5D l_extendedprice").repartition(files),
    }
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_trip_files_follow_days_and_rows_not_tasks(spark, scratch):
    sf = _star(spark, scratch, 600, 6)
    paths = files.list_files(spark, trip_folder(spark, sf))
    assert len(paths) == 14 * 3
    rows = files.read_trip_csv(spark, trip_folder(spark, sf), "Viajes_", day_in_name=True)
    assert rows.count() == 600 - 20                 # lines of the order without a customer have no trip
