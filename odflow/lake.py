"""Layered table storage: ``<root>/<layer>/<table>`` Parquet directories.

Writes are idempotent reloads, never blind appends (a retried task that
appends twice would load a file twice):

* ``overwrite``            create-or-replace a whole table;
* ``overwrite_checked``    the same by a contract: all broken rules in one
                           report, and the old table stays if there are any;
* ``replace_partitions``   dynamic partition overwrite: only partitions
                           present in the new data are replaced;
* ``replace_zone``         static overwrite of one ``tipo_zona=<level>``
                           directory, so dates missing from a reload
                           disappear and an empty reload clears the zone;
* ``replace_days``         dynamic overwrite of the days that have rows,
                           plus an explicit empty overwrite of requested days
                           that produced none.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from odflow import schema as S
from odflow.sources import storage


class Lake:
    """Tables under one root.  ``frozen=True`` declares that the tables no
    longer change, so each table's schema is inferred once and reused."""

    def __init__(self, spark: SparkSession, root: str, frozen: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.frozen = frozen
        self._schemas: dict[str, object] = {}

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        path = self.path(layer, table)
        if not self.frozen:
            return self.spark.read.parquet(path)
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    # ------------------------------------------------------------ writes
    def overwrite(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None) -> None:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(layer, table))

    def overwrite_checked(self, df: DataFrame, schema, layer: str, table: str, partition_by: list[str] | None = None) -> None:
        """``overwrite`` by a contract, in one pass over ``df``.

        Rows go to a folder beside the table and are counted against every
        NOT NULL rule on the way.  Without a violation the folder takes the
        table's place; else it is removed, the table stays as it was, and the
        error tells for every broken rule how many rows break it, and one.
        """
        typed, watch = S.observed(df, schema, f"{layer}.{table}")
        target, beside = self.path(layer, table), f"{self.path(layer, table)}_load_{uuid.uuid4().hex[:12]}"
        w = typed.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(beside)
        found = S.violations(watch)
        if found:
            storage.delete(self.spark, beside)
            raise S.contract_error(f"{layer}.{table}", found)
        storage.delete(self.spark, target)
        storage.rename(self.spark, beside, target)

    def append(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None) -> None:
        """Positional-safe append (by name after the caller's ``enforce_schema``)."""
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(layer, table))

    def replace_partitions(self, df: DataFrame, layer: str, table: str, partition_by: list[str]) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(self.path(layer, table))
        )

    def replace_zone(self, df: DataFrame, layer: str, table: str, level: str, sub_partition: str | None = "fecha") -> None:
        """Reload every row of one zone level (``DELETE WHERE tipo_zona = level`` + insert)."""
        target = f"{self.path(layer, table)}/tipo_zona={level}"
        body = df.filter(F.col("tipo_zona") == level).drop("tipo_zona")
        w = body.write.mode("overwrite")
        if sub_partition:
            w = w.partitionBy(sub_partition)
        w.parquet(target)

    def replace_days(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        days: list[str],
        day_col: str = "fecha",
        present_days: DataFrame | None = None,
    ) -> None:
        """Reload the requested days; a requested day without rows becomes empty.

        ``present_days`` (one column of dates) says which requested days have
        rows; pass a partition-column projection of the source (cheap: no data
        columns are read).  Without it the days are noted while the rows are
        written, so ``df`` is run once.  The list holds at most ``len(days)`` dates.
        """
        requested = sorted(set(days))
        day_lits = [F.lit(d).cast("date") for d in requested]
        body = df.filter(F.col(day_col).isin(day_lits))
        if present_days is None:
            watch = Observation("days written")
            written = body.observe(watch, F.collect_set(F.col(day_col).cast("date").cast("string")).alias("days"))
            self.replace_partitions(written, layer, table, [day_col])
            present = set(watch.get.get("days") or [])
        else:
            self.replace_partitions(body, layer, table, [day_col])
            present = {
                r[0].isoformat()
                for r in present_days.toDF("d").filter(F.col("d").isin(day_lits)).distinct().collect()
            }
        self.clear_days(layer, table, day_col, [d for d in requested if d not in present], body.drop(day_col).schema)

    def clear_days(self, layer: str, table: str, day_col: str, days: list[str], schema) -> None:
        """Removes the directories of days without rows: file-system calls and
        one Spark job at most, which leaves an empty file that keeps the
        table readable."""
        if not days:
            return
        jvm = self.spark.sparkContext._jvm
        paths = [jvm.org.apache.hadoop.fs.Path(f"{self.path(layer, table)}/{day_col}={d}") for d in days]
        fs = paths[0].getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for p in paths[1:]:
            fs.delete(p, True)
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(paths[0].toString())
