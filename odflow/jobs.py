"""Job entry points: the ingestion, roll-up and question runs over raw files.

``python -m odflow.jobs <command> ...`` with a session from ``spark-submit``
(the cluster's configuration, including ``spark.checkpoint.dir``, comes
from there).  Commands:

* ``ingest``     raw files -> silver tables (all zone levels, one job each)
* ``rollup``     silver trips -> gold tables (all days, or ``--days``)
* ``questions``  BQ1..BQ3 result tables for a polygon, period and zone level
* ``stream``     new daily trip files -> silver and gold (available-now)
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import SparkSession

from odflow import schema as S
from odflow.lake import Lake
from odflow.params import DEFAULT_END_DATE, DEFAULT_POLYGON, DEFAULT_START_DATE, DEFAULT_ZONE, MobilityParams
from odflow.plans import pipeline, reports
from odflow.sources import files
from odflow.streaming.ingest import LEVEL_FILES, start_trip_ingest

# ---- fixed values: column names of the raw statistics and calendar files ----
POPULATION_COLUMNS = ["column0", "Total"]
INCOME_COLUMNS = ["column0", "Renta neta media por persona"]
CALENDAR_COLUMNS = ["Dia", "Dia_semana", "laborable"]
PROVINCE_PROPERTIES = ["Codigo", "Texto", "Texto_Alt", "Cod_CCAA", "CCAA"]
ZONE_PROPERTIES = ["id", "name"]


@dataclass
class RawPaths:
    trips: str                      # folder with <yyyyMMdd>_Viajes_<level>.csv.gz files (any depth)
    relaciones: str                 # '|' separated code relations
    poblacion: str
    renta: str
    calendario: str
    provincias: str                 # GeoJSON
    geo: dict[str, str]             # zone level -> GeoJSON of its shapes
    geojson_sequence: bool = False  # one feature per line instead of a FeatureCollection
    stats_sep: str | None = None    # detected, file by file


def bronze_inputs(spark: SparkSession, raw: RawPaths) -> pipeline.BronzeInputs:
    seq = raw.geojson_sequence
    return pipeline.BronzeInputs(
        relaciones=files.read_all_varchar(spark, raw.relaciones, S.BRONZE_RELACIONES),
        poblacion=files.read_stat_csv(spark, raw.poblacion, POPULATION_COLUMNS, raw.stats_sep),
        renta=files.read_stat_csv(spark, raw.renta, INCOME_COLUMNS, raw.stats_sep),
        calendario=files.read_stat_csv(spark, raw.calendario, CALENDAR_COLUMNS, raw.stats_sep),
        provincias=files.read_geojson(spark, raw.provincias, PROVINCE_PROPERTIES, sequence=seq),
        geo_by_level={lv: files.read_geojson(spark, p, ZONE_PROPERTIES, sequence=seq) for lv, p in raw.geo.items()},
        trips_by_level={lv: files.read_trip_csv(spark, raw.trips, LEVEL_FILES[lv]) for lv in raw.geo},
    )


def ingest(spark: SparkSession, raw: RawPaths, lake: Lake) -> None:
    pipeline.build_silver(lake, bronze_inputs(spark, raw))


def rollup(lake: Lake, levels: list[str] | None = None, days: list[str] | None = None) -> None:
    pipeline.build_gold(lake, levels, days)


def questions(lake: Lake, p: MobilityParams, which: tuple[str, ...] = ("bq1", "bq2", "bq3")) -> None:
    runs = {"bq1": reports.run_bq1, "bq2": reports.run_bq2, "bq3": reports.run_bq3}
    for q in which:
        runs[q](lake, p)


def _raw_from_args(a) -> RawPaths:
    geo = {lv: path for lv, path in (("municipios", a.geo_municipios), ("distritos", a.geo_distritos),
                                     ("gaus", a.geo_gaus)) if path}
    return RawPaths(a.trips, a.relaciones, a.poblacion, a.renta, a.calendario, a.provincias, geo,
                    a.geojson_sequence, a.stats_sep)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="odflow.jobs")
    ap.add_argument("--lake", required=True, help="root folder of the layered tables")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "stream"):
        s = sub.add_parser(name)
        for opt in ("trips", "relaciones"):
            s.add_argument(f"--{opt}", required=True)
        for opt in ("poblacion", "renta", "calendario", "provincias", "geo-municipios", "geo-distritos", "geo-gaus"):
            s.add_argument(f"--{opt}", required=(name == "ingest" and opt in ("poblacion", "renta", "calendario", "provincias")))
        s.add_argument("--geojson-sequence", action="store_true")
        s.add_argument("--stats-sep", default=None, help="detected if not given")
        if name == "stream":
            s.add_argument("--checkpoint", required=True)
    r = sub.add_parser("rollup")
    r.add_argument("--levels", nargs="*")
    r.add_argument("--days", nargs="*")
    q = sub.add_parser("questions")
    q.add_argument("--polygon", default=DEFAULT_POLYGON)
    q.add_argument("--start-date", default=DEFAULT_START_DATE)
    q.add_argument("--end-date", default=DEFAULT_END_DATE)
    q.add_argument("--tipo-zona", default=DEFAULT_ZONE)
    q.add_argument("--zone-filter", action="store_true")
    q.add_argument("--only", nargs="*", default=["bq1", "bq2", "bq3"])
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"odflow-{a.cmd}").getOrCreate()
    lake = Lake(spark, a.lake)
    if a.cmd == "ingest":
        ingest(spark, _raw_from_args(a), lake)
    elif a.cmd == "rollup":
        rollup(lake, a.levels or None, a.days or None)
    elif a.cmd == "questions":
        p = MobilityParams(a.polygon, a.start_date, a.end_date, a.tipo_zona, zone_filter=a.zone_filter)
        questions(lake, p, tuple(a.only))
    elif a.cmd == "stream":
        levels = [lv for lv in ("municipios", "distritos", "gaus")] if not (a.geo_municipios or a.geo_distritos or a.geo_gaus) \
            else [lv for lv, g in (("municipios", a.geo_municipios), ("distritos", a.geo_distritos), ("gaus", a.geo_gaus)) if g]
        rel = files.read_all_varchar(spark, a.relaciones, S.BRONZE_RELACIONES)
        start_trip_ingest(spark, a.trips, lake, rel, a.checkpoint, levels=levels).awaitTermination()


if __name__ == "__main__":
    main()
