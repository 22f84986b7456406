"""A lake built once per session from the driver tables.

Query functions for the checks read silver and gold tables from here, as
the real questions read persisted layers instead of recomputing the
ingestion.  The lake lives under the session's checkpoint folder (a
shared folder on a cluster), keyed by the source directory and its file
sizes and times, and is rebuilt when the marker is missing.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from odflow.lake import Lake
from odflow.plans.pipeline import BronzeInputs, build_all
from odflow.session import scratch_path
from odflow.sources import fixtures as fx
from odflow.sources import storage
from odflow.sources.files import read_trip_csv
from odflow.streaming.ingest import LEVEL_FILES

# Bump when the layout of lake tables changes, so older lakes are not reused.
LAYOUT_VERSION = 5

_LOCK = threading.Lock()
_FILES_LOCK = threading.Lock()
_BUILT: dict[tuple[str, str], Lake] = {}


def source_key(spark: SparkSession, sf_dir: str) -> str:
    """Key of the source files: their names, sizes and times, from whatever
    store holds them."""
    h = hashlib.sha1(f"{LAYOUT_VERSION}:{sf_dir.rstrip('/')}".encode())
    for name in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        for file, size, time in storage.listing(spark, path):
            h.update(f"{file}:{size}:{time}".encode())
    return h.hexdigest()[:16]


def trip_folder(spark: SparkSession, sf_dir: str) -> str:
    """Daily gzip trip files of all levels, written once: as many files a day as
    its rows need, columns in another order than the table's, and one that
    nobody reads.  Rows are dealt by day and level first (AQE cuts a large day),
    so the number of files follows the rows, not tasks times days."""
    root = scratch_path(spark, "files", source_key(spark, sf_dir), "raw", "trips")
    with _FILES_LOCK:
        if not storage.exists(spark, f"{root}/_ready"):
            tmp = f"{root}_tmp_{uuid.uuid4().hex[:8]}"
            df = fx.bronze_trips(spark, sf_dir).select(
                F.regexp_replace("fecha", "-", "").alias("day"), F.col("tipo_zona").alias("level"),
                F.lit("x").alias("residencia"), "destino", "viajes_km", "fecha", "origen", "viajes", "periodo")
            (df.hint("rebalance", "day", "level").write.partitionBy("day", "level").option("header", True).option("sep", "|")
             .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(tmp))
            count: dict[str, int] = {}
            for path, _, _ in storage.listing(spark, tmp):
                if path.endswith(".csv.gz"):
                    day, level = (part.split("=")[1] for part in path.split("/")[-3:-1])
                    name = f"{day}_{LEVEL_FILES[level]}"
                    count[name] = count.get(name, -1) + 1
                    storage.rename(spark, path, f"{root}/{level}/{name}_{count[name]}.csv.gz")
            storage.touch(spark, f"{root}/_ready")
    return root


def fixture_inputs(spark: SparkSession, sf_dir: str) -> BronzeInputs:
    return BronzeInputs(
        relaciones=fx.relaciones(spark, sf_dir),
        poblacion=fx.bronze_poblacion(spark, sf_dir),
        renta=fx.bronze_renta(spark, sf_dir),
        calendario=fx.bronze_calendario(spark, sf_dir),
        provincias=fx.bronze_provincias(spark, sf_dir),
        geo_by_level={
            "municipios": fx.bronze_geo(spark, sf_dir, "municipio"),
            "distritos": fx.bronze_geo(spark, sf_dir, "distrito"),
            "gaus": fx.bronze_geo(spark, sf_dir, "gau"),
        },
        trips_by_level={lv: read_trip_csv(spark, trip_folder(spark, sf_dir), LEVEL_FILES[lv]) for lv in LEVEL_FILES},
    )


def fixture_lake(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Lake:
    """The lake for ``sf_dir``; reused if already built for the same source
    files.  ``rebuild=True`` always builds a new one in a fresh folder (the
    bench times the build that way)."""
    key = (spark.sparkContext.applicationId, source_key(spark, sf_dir))
    with _LOCK:
        if key in _BUILT and not rebuild:
            return _BUILT[key]
        root = scratch_path(spark, "lake", key[1] + (f"-{uuid.uuid4().hex[:12]}" if rebuild else ""))
        lake = Lake(spark, root)
        marker = f"{root}/_built"
        if not storage.exists(spark, f"{marker}/_SUCCESS"):
            build_all(lake, fixture_inputs(spark, sf_dir), calendar_from_trips=fx.calendar_from_trips)
            spark.createDataFrame([(sf_dir,)], "src string").write.mode("overwrite").text(marker)
        lake = Lake(spark, root, frozen=True)
        _BUILT[key] = lake
        return lake
