"""Bronze -> silver -> gold build into a ``Lake``.

One driver program, lazy plans; control leaves the driver only at the
writes, and tables that do not read each other are written side by side.  Silver trips are partitioned by (tipo_zona, fecha) so zone
reloads and day filters prune directories; gold tables by fecha.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.lake import Lake
from odflow.params import ZONES
from odflow.plans import gold, silver


@dataclass
class BronzeInputs:
    relaciones: DataFrame
    poblacion: DataFrame
    renta: DataFrame
    calendario: DataFrame
    provincias: DataFrame
    geo_by_level: dict[str, DataFrame]
    trips_by_level: dict[str, DataFrame] = field(default_factory=dict)


def together(spark: SparkSession, *loads: Callable[[], None]) -> None:
    """Loads of tables that do not read each other, side by side: Spark fills
    the cores that one leaves idle with the tasks of the next.  All are ended
    before the first error, if any, is raised."""
    with ThreadPoolExecutor(len(loads)) as pool:
        ends = [pool.submit(inheritable_thread_target(spark)(load)) for load in loads]
    for end in ends:
        end.result()


def write_viajes(lake: Lake, viajes: DataFrame, levels: list[str] | None = None, rebalance: bool = True) -> None:
    """Write silver.viajes partitioned by (tipo_zona, fecha).

    A full build is one job and one static overwrite.  A reload of some
    levels rewrites each ``tipo_zona=<level>`` directory (days missing from
    the new data disappear).  With ``rebalance`` rows are first shuffled on
    the partition columns (AQE splits a skewed (zone, day) partition and
    merges small ones, no sampling pass), for inputs whose partitions mix
    days.  Trips read from per-day files are already day-aligned (one task
    per file writes one directory), so that path skips the shuffle.
    """
    typed = S.enforce_schema(viajes, S.SILVER_VIAJES, "silver.viajes")
    if levels is None:
        out = typed.hint("rebalance", "tipo_zona", "fecha") if rebalance else typed
        lake.overwrite(out, "silver", "viajes", partition_by=["tipo_zona", "fecha"])
        return
    for level in levels:
        part = typed.filter(F.col("tipo_zona") == level)
        lake.replace_zone(part.hint("rebalance", "fecha") if rebalance else part, "silver", "viajes", level)


def build_silver(lake: Lake, b: BronzeInputs, calendar_from_trips=None) -> None:
    """Write every silver table.

    ``calendar_from_trips``, if given, derives the bronze calendar from the
    written trip table (its day partitions) instead of ``b.calendario``.
    """
    def provinces_and_places() -> None:
        lake.overwrite(silver.clean_provinces(b.provincias), "silver", "provincias")
        places = silver.place_catalogue(b.geo_by_level, b.relaciones, lake.read("silver", "provincias"))
        lake.overwrite(places, "silver", "lugares")

    def trips_and_calendar() -> None:
        write_viajes(lake, silver.silver_trips(b.trips_by_level, b.relaciones), rebalance=False)
        cal = calendar_from_trips(lake.read("silver", "viajes")) if calendar_from_trips else b.calendario
        lake.overwrite(silver.clean_calendar(cal), "silver", "calendario")

    together(
        lake.spark,
        trips_and_calendar,
        provinces_and_places,
        lambda: lake.overwrite(silver.clean_population(b.poblacion), "silver", "poblacion"),
        lambda: lake.overwrite(silver.clean_income(b.renta), "silver", "renta"),
    )


def build_gold(lake: Lake, levels: list[str] | None = None, days: list[str] | None = None) -> None:
    v = lake.read("silver", "viajes")
    together(lake.spark, *[partial(gold.write_gold, lake, v, level, days) for level in levels or list(ZONES)])


def build_all(lake: Lake, b: BronzeInputs, calendar_from_trips=None) -> None:
    build_silver(lake, b, calendar_from_trips)
    build_gold(lake)
