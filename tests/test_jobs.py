"""Raw files written from the driver tables -> the job entry points -> the same silver tables."""

import os

from odflow import jobs
from odflow.lake import Lake
from odflow.plans.silver import resolve_all_levels
from odflow.queries import _geo_file, _relations_file
from odflow.sources import files
from odflow.sources import fixtures as fx
from odflow.sources.fixture_lake import fixture_lake, trip_folder

SF = "/root/testdata/sf0.001"


def _csv(df, path):
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def test_jobs_from_raw_files(spark, scratch):
    prov = os.path.join(scratch, "provincias")
    files.feature_json(fx.bronze_provincias(spark, SF), jobs.PROVINCE_PROPERTIES).write.text(prov)
    raw = jobs.RawPaths(
        trips=trip_folder(spark, SF),
        relaciones=_relations_file(spark, SF),
        poblacion=_csv(fx.bronze_poblacion(spark, SF), os.path.join(scratch, "poblacion")),
        renta=_csv(fx.bronze_renta(spark, SF), os.path.join(scratch, "renta")),
        calendario=_csv(fx.bronze_calendario(spark, SF), os.path.join(scratch, "calendario")),
        provincias=prov,
        geo={lv: _geo_file(spark, SF, lv) for lv in ("municipios", "distritos", "gaus")},
        geojson_sequence=True,
    )
    root = os.path.join(scratch, "lake")
    lake = Lake(spark, root)
    jobs.ingest(spark, raw, lake)
    jobs.main(["--lake", root, "rollup"])
    jobs.main(["--lake", root, "questions", "--polygon", fx.RECT_WKT, "--start-date", "2023-01-01",
               "--end-date", "2023-01-14", "--only", "bq3"])

    ref = fixture_lake(spark, SF)
    for t in ("provincias", "poblacion", "renta", "calendario", "lugares"):
        a = sorted(map(tuple, lake.read("silver", t).drop("geom", "coordenadas").collect()))
        b = sorted(map(tuple, ref.read("silver", t).drop("geom", "coordenadas").collect()))
        assert a == b, t
    expected = resolve_all_levels(fx.bronze_trips(spark, SF), fx.relaciones(spark, SF))
    got = lake.read("silver", "viajes").select(*expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    assert lake.read("gold", "mobility_gaus_periodo").count() > 0
    assert lake.read("gold", "bq3/ranking").count() >= 1
