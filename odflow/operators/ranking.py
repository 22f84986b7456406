"""Ranks over a whole table without one task for all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from odflow.session import stored

#: Rows of one range, about.
RANGE_ROWS = 1_000_000


def percent_rank(df: DataFrame, column: str, out: str, ranges: int | None = None) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY column NULLS LAST)`` as ``out``.

    Rows are sorted over the cluster by ranges of (value, row number) and
    written with the number of their range.  A row's rank is its rank inside the
    range plus the rows of the ranges before; ties go across borders, so a value
    that a range begins with takes its rank from the first range that has it.
    A value that many rows share is spread like any other.  The one step
    without partitions is over a row for each range.
    """
    n_rows = df.count() if ranges is None else None
    ranges = ranges or max(1, -(-n_rows // RANGE_ROWS))
    order = [F.col("_none"), F.col("_value"), F.col("_row")]
    dealt = df.withColumns({"_none": F.col(column).isNull(), "_value": F.col(column), "_row": F.monotonically_increasing_id()})
    dealt = stored(dealt.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    key = F.struct("_none", "_value")
    ranked = dealt.withColumn("_inside", F.rank().over(Window.partitionBy("_range").orderBy("_none", "_value")))

    # one row a range from here on: its size, its first and last value and where the last one begins
    edges = stored(ranked.groupBy("_range").agg(
        F.count("*").alias("_size"), F.min(key).alias("_first"), F.max(key).alias("_last"), F.max("_inside").alias("_last_inside")), "range-edges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    begins = edges.select(F.col("_first").alias("_key"), (F.col("_before") + 1).alias("_at")).unionByName(
        edges.select(F.col("_last").alias("_key"), (F.col("_before") + F.col("_last_inside")).alias("_at")))
    begins = begins.groupBy("_key").agg(F.min("_at").alias("_first_at"))
    edges = edges.join(begins, edges["_first"].eqNullSafe(begins["_key"])).select(
        F.col("_range").alias("_of"), "_before", F.col("_first"), "_first_at")

    total = dealt.agg(F.count("*")).scalar()
    joined = ranked.join(F.broadcast(edges), F.col("_range") == F.col("_of"))
    rank = F.when(key.eqNullSafe(F.col("_first")), F.col("_first_at")).otherwise(F.col("_before") + F.col("_inside"))
    share = F.when(total > 1, (rank - 1) / (total - 1).cast("double")).otherwise(F.lit(0.0))
    return joined.withColumn(out, share).select(*df.columns, out)
