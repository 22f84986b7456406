"""Incremental ingestion of daily trip files with Structured Streaming.

The batch pipeline loads every file of a level at once; this keeps the
layers current as new daily files land.  A file source watches the trip
folder and streams the names of new files.  Each micro-batch takes the
(zone level, day) pairs of its files and rebuilds those days of silver.viajes
from all files of these days in the folder, read by the batch reader with its
checks, then reloads the same days of the gold tables.

No row is lost however files come: a day may have any number of files, in one
batch, in several (``max_files_per_trigger``), or late in another run, since a
day is always rebuilt whole.  A query remembers the files (names, sizes, times)
that it built each day from: a later batch that brings more of the same files
finds the day as it would build it, and work grows with the files, not with
files times batches.  A restarted query remembers nothing: a batch that is run
again after a failure writes the same partitions again.  This relies on names that start with the day
(``<yyyyMMdd>_Viajes_<level>...csv.gz``); a row of another day than its file's
name, a malformed line or another header fails the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from odflow import schema as S
from odflow.lake import Lake
from odflow.plans import gold
from odflow.plans.silver import silver_trips
from odflow.session import stored
from odflow.sources.files import file_versions, read_trip_csv

# ---- fixed values: file-name markers of the three trip levels ----
LEVEL_FILES = {"municipios": "Viajes_municipios", "distritos": "Viajes_distritos", "gaus": "Viajes_GAU"}


_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def trip_file_stream(spark: SparkSession, prefix: str, level: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of (path, tipo_zona) of the trip files of one level under
    ``prefix``; the files themselves are not read."""
    r = (
        spark.readStream.format("binaryFile").schema(_FILES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{LEVEL_FILES[level]}*.csv.gz")
    )
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(prefix).select("path", F.lit(level).alias("tipo_zona"))


def file_day(path: str) -> str:
    """ISO day of a trip file, from its name."""
    name = path.rsplit("/", 1)[-1]
    if not name[:8].isdigit():
        raise S.ContractError(f"{path}: the name of a trip file starts with its day (yyyyMMdd)")
    return f"{name[:4]}-{name[4:6]}-{name[6:8]}"


def _process_batch(lake: Lake, relaciones: DataFrame, prefix: str, built: dict[tuple[str, str], dict], batch: DataFrame,
                   batch_id: int) -> None:
    """``built``: the files that this query built each (level, day) from."""
    new: dict[str, set[str]] = {}
    for r in batch.select("tipo_zona", "path").distinct().collect():     # one row per new file
        new.setdefault(r.tipo_zona, set()).add(file_day(r.path))
    spark = lake.spark
    files = file_versions(spark, prefix, "", ".csv.gz")       # once a batch, for all levels
    for level in sorted(new):
        present: dict[str, dict] = {day: {} for day in sorted(new[level])}
        for path, version in files.items():
            if LEVEL_FILES[level] in path.rsplit("/", 1)[-1] and file_day(path) in present:
                present[file_day(path)][path] = version
        days = [day for day, of_day in present.items() if built.get((level, day)) != of_day]
        if not days:
            continue
        paths = [path for day in days for path in present[day]]
        rows = silver_trips({level: read_trip_csv(spark, paths, day_in_name=True)}, relaciones).drop("tipo_zona")
        lake.replace_days(rows, "silver", f"viajes/tipo_zona={level}", days)
        gold.write_gold(lake, lake.read("silver", "viajes"), level, days)
        built.update({(level, day): present[day] for day in days})


def start_trip_ingest(
    spark: SparkSession,
    prefix: str,
    lake: Lake,
    relaciones: DataFrame,
    checkpoint_location: str,
    levels: list[str] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the ingestion query; ``available_now`` processes what is there and stops.

    ``checkpoint_location`` must be on shared storage (it records the
    consumed files).
    """
    streams = [trip_file_stream(spark, prefix, lv, max_files_per_trigger) for lv in (levels or list(LEVEL_FILES))]
    src = streams[0]
    for s in streams[1:]:
        src = src.unionByName(s)
    rel = stored(relaciones, "relaciones")      # a small dimension that every batch reads
    built: dict[tuple[str, str], dict] = {}
    w = src.writeStream.foreachBatch(lambda df, bid: _process_batch(lake, rel, prefix, built, df, bid)).option(
        "checkpointLocation", checkpoint_location
    )
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()
