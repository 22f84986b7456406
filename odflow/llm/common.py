"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odflow.session import checkpoint_dir

#: Words are runs of anything but space and the controls 9 to 13.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one bucket of a running sum (see ``running_sum``).
BUCKET_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here,
    and a lost executor costs only its own tasks."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def masked(docs: DataFrame, *wanted: str) -> tuple[DataFrame, list[str], list[str]]:
    """``docs`` with its columns renamed to c0, c1, ... so that no name of its
    own gets in the way; the new names of ``wanted``; the old names."""
    names = docs.columns
    return docs.toDF(*[f"c{i}" for i in range(len(names))]), [f"c{names.index(w)}" for w in wanted], names


def unmasked(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns c0, c1, ... under their old names."""
    return df.select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def words_sql(text: str) -> str:
    """SQL for the array of words of a text expression."""
    return f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"


def n_words(text: Column) -> Column:
    """Number of words (null text: 0), counted without building an array."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform_key(*cols: Column) -> Column:
    """A 52-bit number from the MD5 of the columns: the same on any engine,
    and evenly spread, whatever the columns hold."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def running_sum(df: DataFrame, group: list[str], order: list[str], value: str | None, out: str, n_rows: int) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (None: the number of rows) over the
    rows of the group that come before the row in ``order``, whose first
    column is a ``uniform_key``.

    A group may hold any share of the rows.  Each is cut into buckets of
    about BUCKET_ROWS along the key, summed by themselves; only the totals
    of the buckets, not the rows, are added up group by group.
    """
    buckets = max(1, -(-n_rows // BUCKET_ROWS))
    v = F.lit(1) if value is None else F.col(value)
    df = df.withColumn("_bucket", F.floor(F.col(order[0]) / F.lit(2.0**52) * buckets).cast("int"))
    inner = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, "_bucket").agg(F.sum(v).alias("_total"))
    totals = totals.withColumn("_before", F.coalesce(F.sum("_total").over(across), F.lit(0))).drop("_total")
    df = df.withColumn("_inner", F.coalesce(F.sum(v).over(inner), F.lit(0)))
    cond = (df["_bucket"] == totals["_bucket"])
    for g in group:
        cond = cond & df[g].eqNullSafe(totals[g])
    joined = df.join(totals, cond, "inner")
    keep = [df[c] for c in df.columns if c not in ("_bucket", "_inner")]
    return joined.select(*keep, (F.col("_inner") + F.col("_before")).cast("long").alias(out))
