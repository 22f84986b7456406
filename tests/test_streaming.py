import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.lake import Lake
from odflow.streaming.ingest import start_trip_ingest

REL = [("Z1", "00001", "Z1", "00001", "Z1"), ("Z2", "00002", "Z2", "00002", "Z2"), ("Z3", "NA", "Z3", "NA", "Z3")]


def _write_day(folder, day, level_file, rows):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, f"{day}_{level_file}.csv.gz"), "wt") as f:
        f.write("fecha|periodo|origen|destino|viajes|viajes_km\n")
        for r in rows:
            f.write("|".join(r) + "\n")


def _run(spark, src, lake, ckpt, **options):
    rel = spark.createDataFrame(REL, S.BRONZE_RELACIONES)
    q = start_trip_ingest(spark, src, lake, rel, ckpt, levels=["distritos", "gaus"], **options)
    q.awaitTermination(120)
    assert q.exception() is None


def _write(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("\n".join([header, *lines]) + "\n")


def _trips(lake):
    return sorted((r.tipo_zona, r.fecha.day, r.viajes) for r in lake.read("silver", "viajes").collect())


def test_several_and_late_files_of_a_day_are_all_kept(spark, scratch):
    src, ckpt = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt")
    lake = Lake(spark, os.path.join(scratch, "lake"))
    for i, n in enumerate(["10", "11"]):
        _write_day(src, "20230101", f"Viajes_distritos_{i}", [("2023-01-01", "08", "Z1", "Z2", n, "1")])
    _run(spark, src, lake, ckpt, max_files_per_trigger=1)
    assert _trips(lake) == [("distritos", 1, 10.0), ("distritos", 1, 11.0)]
    # a late file, with its columns in another order and one more
    _write(src, "20230102_Viajes_distritos_late.csv.gz", "km2|destino|viajes|origen|viajes_km|fecha|periodo", ["x|Z2|7|Z1|2|2023-01-02|09"])
    _run(spark, src, lake, ckpt)
    _write_day(src, "20230101", "Viajes_distritos_2", [("2023-01-01", "09", "Z2", "Z1", "12", "1")])
    _run(spark, src, lake, ckpt)
    assert _trips(lake) == [("distritos", 1, 10.0), ("distritos", 1, 11.0), ("distritos", 1, 12.0), ("distritos", 2, 7.0)]
    got = lake.read("silver", "viajes").filter("viajes = 7").first()
    assert (got.id_origen, got.id_destino, got.viajes_metros) == (1, 2, 2000.0)


def test_a_day_whose_files_come_in_many_batches_is_built_once(spark, scratch, monkeypatch):
    src = os.path.join(scratch, "in")
    for i in range(3):
        _write_day(src, "20230101", f"Viajes_distritos_{i}", [("2023-01-01", "08", "Z1", "Z2", str(i), "1")])
    _write_day(src, "20230102", "Viajes_distritos_0", [("2023-01-02", "08", "Z1", "Z2", "9", "1")])
    built, real = [], Lake.replace_days

    def counted(self, df, layer, table, days, **options):
        built.extend((layer, d) for d in days)
        return real(self, df, layer, table, days, **options)

    monkeypatch.setattr(Lake, "replace_days", lambda self, df, layer, table, days, *a, **k: counted(self, df, layer, table, days, **k))
    lake = Lake(spark, os.path.join(scratch, "lake"))
    _run(spark, src, lake, os.path.join(scratch, "ckpt"), max_files_per_trigger=1)
    assert _trips(lake) == [("distritos", 1, 0.0), ("distritos", 1, 1.0), ("distritos", 1, 2.0), ("distritos", 2, 9.0)]
    assert sorted(built) == [(layer, f"2023-01-0{d}") for layer in ("gold", "silver") for d in (1, 2)]


@pytest.mark.parametrize("lines", [["2023-01-01|08|Z1|Z2|1"], ["2023-01-02|08|Z1|Z2|1|1"]])
def test_short_lines_and_rows_of_another_day_fail_the_stream(spark, scratch, lines):
    src = os.path.join(scratch, "in")
    _write(src, "20230101_Viajes_distritos.csv.gz", "fecha|periodo|origen|destino|viajes|viajes_km", ["2023-01-01|08|Z1|Z2|3|1", *lines])
    rel = spark.createDataFrame(REL, S.BRONZE_RELACIONES)
    q = start_trip_ingest(spark, src, Lake(spark, os.path.join(scratch, "lake")), rel, os.path.join(scratch, "ckpt"), levels=["distritos"])
    with pytest.raises(Exception):
        q.awaitTermination(120)


def test_stream_ingest_is_incremental_and_idempotent(spark, scratch):
    src, ckpt = os.path.join(scratch, "in"), os.path.join(scratch, "ckpt")
    lake = Lake(spark, os.path.join(scratch, "lake"))
    _write_day(src, "20230101", "Viajes_distritos", [("2023-01-01", "08", "Z1", "Z2", "2.5", "1.5"),
                                                     ("2023-01-01", "08", "Z1", "Z2", "3", "2.5"),
                                                     ("2023-01-01", "09", "Z1", "Z3", "9", "1")])
    _write_day(src, "20230101", "Viajes_GAU", [("2023-01-01", "08", "Z2", "Z1", "1", "1")])
    _run(spark, src, lake, ckpt)
    v = lake.read("silver", "viajes")
    assert v.count() == 3
    g = lake.read("gold", "mobility_distritos_periodo").collect()
    assert [(r.id_origen, r.id_destino, r.fecha, r.periodo, r.total_viajes, r.avg_viajes_metros) for r in g] == [
        (1, 2, dt.date(2023, 1, 1), "8", 5.0, 2000.0)]

    # a new day arrives: only it is added
    _write_day(src, "20230102", "Viajes_distritos", [("2023-01-02", "10", "Z2", "Z2", "4", "1")])
    _run(spark, src, lake, ckpt)
    assert lake.read("silver", "viajes").count() == 4
    days = sorted(r.fecha.day for r in lake.read("gold", "mobility_distritos_periodo").select("fecha").distinct().collect())
    assert days == [1, 2]

    # nothing new: nothing changes
    before = sorted(tuple(r) for r in lake.read("silver", "viajes").collect())
    _run(spark, src, lake, ckpt)
    assert sorted(tuple(r) for r in lake.read("silver", "viajes").collect()) == before
    assert lake.read("gold", "mobility_gaus_periodo").agg(F.sum("total_viajes")).first()[0] == 1.0
