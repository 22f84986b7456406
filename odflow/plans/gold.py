"""Gold layer (C-7): trips rolled up by origin, destination, day and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.lake import Lake
from odflow.params import ZONES

GROUP_KEYS = ["id_origen", "id_destino", "fecha", "periodo"]


def gold_rollup(viajes: DataFrame, tipo_zona: str, days: list[str] | None = None, one_exchange: bool = False) -> DataFrame:
    """Sum of trips and unweighted mean of metres per (origin, destination, day, hour).

    The zone and day filters hit partition columns of silver.viajes, so only
    those directories are read.  The aggregate is partial per task, then
    shuffled on the four keys; a hot origin is split by destination, day and
    hour and pre-aggregated on the map side.  ``one_exchange``: trips are dealt
    by ranges of the four keys, day first, which serves the grouping and a write
    by day alike; nothing is pre-aggregated before that shuffle.
    """
    if tipo_zona not in ZONES:
        raise ValueError(f"unknown zone level {tipo_zona!r}")
    v = viajes.filter(F.col("tipo_zona") == tipo_zona)
    if days:
        v = v.filter(F.col("fecha").isin([F.lit(d).cast("date") for d in days]))
    if one_exchange:
        v = v.repartitionByRange("fecha", "id_origen", "id_destino", "periodo")
    agg = v.groupBy(*GROUP_KEYS).agg(
        F.sum("viajes").alias("total_viajes"),
        F.avg("viajes_metros").alias("avg_viajes_metros"),
    )
    return S.enforce_schema(agg.withColumn("periodo", F.col("periodo").cast("string")), S.GOLD_MOBILITY, "gold.mobility")


def write_gold(lake: Lake, viajes_table: DataFrame, tipo_zona: str, days: list[str] | None = None, one_exchange: bool = False) -> None:
    """Build or reload one gold table, partitioned by day.

    All days in one job (not one job per day).  The roll-up output is
    rebalanced on the day before the write, so each task writes one day
    directory and AQE splits a day that is too large.  Rows inside a file are
    in order of their origin (one sort with that for the day directories), so
    a row group holds few origins, and questions about a few skip the others.
    With ``days`` only those days are replaced; a requested day without trips
    is emptied.  ``one_exchange``: as ``gold_rollup`` says; the better way where
    a group has hardly more than one trip row, so that partial sums save nothing.
    """
    table = ZONES[tipo_zona].gold_table
    g = gold_rollup(viajes_table, tipo_zona, days, one_exchange)
    g = (g if one_exchange else g.hint("rebalance", "fecha")).sortWithinPartitions("fecha", "id_origen")
    if days:
        present = viajes_table.filter(F.col("tipo_zona") == tipo_zona).select("fecha")
        lake.replace_days(g, "gold", table, days, present_days=present)
    else:
        lake.overwrite(g, "gold", table, partition_by=["fecha"])
