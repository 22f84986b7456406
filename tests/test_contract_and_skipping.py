"""Checked loads with a report of all broken rules, and row groups that questions skip."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.functions import geo
from odflow.lake import Lake
from odflow.operators.joins import key_ranges, within
from odflow.params import MobilityParams
from odflow.plans import gold as G
from odflow.plans import questions as Q


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id string, poblacion string, note string")


def test_three_broken_rules_in_one_report(spark, scratch):
    lake = Lake(spark, scratch)
    lake.overwrite_checked(_rows(spark, [("1", "10", "old")]), S.SILVER_POBLACION, "silver", "poblacion")
    good = [(str(i), "5", "ok") for i in range(50)]
    bad = [(None, "1", "no id"), (None, "2", "no id"), ("x", "3", "no number"), ("7", None, "empty"), ("8", "many", "words")]
    passes = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    df = _rows(spark, good + bad)
    df = df.mapInArrow(count, df.schema)
    with pytest.raises(S.ContractError) as e:
        lake.overwrite_checked(df, S.SILVER_POBLACION, "silver", "poblacion")
    text = str(e.value)
    assert "silver.poblacion" in text and "id in 3 rows" in text and "poblacion in 2 rows" in text
    assert '"note":"no id"' in text or '"note":"no number"' in text
    assert passes.value == len(good + bad)                                    # one pass
    assert [tuple(r) for r in lake.read("silver", "poblacion").collect()] == [(1, 10)]     # the old table stays
    assert not glob.glob(f"{scratch}/silver/*_load_*")
    lake.overwrite_checked(_rows(spark, good), S.SILVER_POBLACION, "silver", "poblacion")
    assert lake.read("silver", "poblacion").count() == 50


def test_checked_load_of_partitions_and_of_nothing(spark, scratch):
    lake = Lake(spark, scratch)
    rows = spark.createDataFrame([(1, 2, "2023-01-01", 3, 4.0, 5.0)], "id_origen int, id_destino int, fecha string, periodo int, total_viajes double, avg_viajes_metros double")
    lake.overwrite_checked(rows, S.GOLD_MOBILITY, "gold", "g", ["fecha"])
    assert lake.read("gold", "g").first().periodo == "3"
    lake.overwrite_checked(rows.limit(0), S.GOLD_MOBILITY, "gold", "g")
    assert lake.read("gold", "g").count() == 0
    with pytest.raises(S.ContractError, match="missing"):
        lake.overwrite_checked(rows.drop("fecha"), S.GOLD_MOBILITY, "gold", "g")


def test_key_ranges_hold_all_keys_and_few_others(spark):
    ids = [1, 2, 3, 10, 11, 50, 100, 101, 102, 500]
    df = spark.createDataFrame([(i,) for i in ids + [None]], "id int")
    assert key_ranges(df, "id", df, "a", most=3) == [(1, 50), (100, 102), (500, 500)]
    assert key_ranges(df, "id", df, "b", most=99) == [(1, 3), (10, 11), (50, 50), (100, 102), (500, 500)]
    assert key_ranges(df.limit(0), "id", df, "c") == []
    kept = spark.range(600).filter(within("id", [(1, 50), (500, 500)])).count()
    assert kept == 51 and spark.range(9).filter(within("id", [])).count() == 0


def test_row_groups_read_fall_with_the_polygon(spark, scratch):
    """A 20 x 20 grid of zones; gold of two days with small row groups."""
    spark.conf.set("parquet.block.size", "4096")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "4096")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.page.size.row.check.min", "10")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.min", "10")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size.row.check.max", "100")
    try:
        lake = Lake(spark, scratch)
        trips = spark.range(40_000).selectExpr(
            "date_add(date'2023-01-01', cast(id % 2 as int)) as fecha", "cast(id % 24 as int) as periodo", "'municipios' as tipo_zona",
            "cast(id * 7919 % 400 as int) as id_origen", "cast(id % 399 as int) as id_destino", "1D as viajes", "10D as viajes_metros")
        G.write_gold(lake, trips, "municipios")
        places = spark.range(400).select(
            F.col("id").cast("int").alias("id"), F.format_string("p%d", "id").alias("nombre"), F.lit("municipio").alias("tipo_zona"),
            geo.rect("id div 20 + 0.1D", "id % 20 + 0.1D", "id div 20 + 0.9D", "id % 20 + 0.9D").alias("coordenadas"))
        lake.overwrite(places, "silver", "lugares")
    finally:
        for k in ("parquet.block.size", "parquet.page.size.row.check.min", "parquet.block.size.row.check.min", "parquet.block.size.row.check.max"):
            spark.sparkContext._jsc.hadoopConfiguration().unset(k)
        spark.conf.unset("parquet.block.size")
    gold, places = lake.read("gold", G.ZONES["municipios"].gold_table), lake.read("silver", "lugares")
    groups = []
    for f in glob.glob(f"{scratch}/gold/{G.ZONES['municipios'].gold_table}/*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        column = [meta.schema.column(i).name for i in range(meta.num_columns)].index("id_origen")
        groups += [(s.min, s.max) for s in (meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups))]
    assert len(groups) > 30

    read = []
    for side in (20, 10, 5, 2):
        p = MobilityParams(f"POLYGON((0 0, {side} 0, {side} {side}, 0 {side}, 0 0))", "2023-01-01", "2023-01-02", "municipios")
        df = Q.from_polygon(gold, places, p)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "id_origen" in plan.split("PushedFilters")[1]
        ranges = key_ranges(places, "id", places, p.polygon, p.tipo_zona, p.zone_filter)
        read.append(sum(any(a <= hi and b >= lo for a, b in ranges) for lo, hi in groups))
        total = Q.bq1_hourly_totals(gold, places, p).agg(F.sum("total_viajes")).first()[0]
        inside = [i for i in range(400) if i // 20 + 0.9 <= side and i % 20 + 0.9 <= side]
        assert total == gold.filter(F.col("id_origen").isin(inside)).agg(F.sum("total_viajes")).first()[0]
    assert read[0] == len(groups) and read == sorted(read, reverse=True) and read[-1] < len(groups) / 4
