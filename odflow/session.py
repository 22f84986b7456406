"""Spark session helpers.

The library never builds its own cluster configuration: callers pass a
``SparkSession``.  ``local_session`` exists for tests, the bench and the
smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCK = threading.Lock()
_LOCAL_CKPT: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "odflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory).  Only a local-mode session without one gets a
    private temporary folder; on a cluster an unset directory is an error,
    because a machine-local folder would not survive a lost executor.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared (distributed) folder"
        )
    with _LOCK:
        key = sc.applicationId
        if key not in _LOCAL_CKPT:
            path = tempfile.mkdtemp(prefix="odflow-ckpt-")
            sc.setCheckpointDir(path)
            # setCheckpointDir creates a sub-folder; use what Spark reports.
            _LOCAL_CKPT[key] = (sc.getCheckpointDir() or path).rstrip("/")
        return _LOCAL_CKPT[key]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "odflow", *parts)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the checkpoint folder and read back, for results
    that a plan reads more than once."""
    spark = df.sparkSession
    path = scratch_path(spark, "stored", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks for each core over which ``spread`` deals rows.
SPREAD = 3


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over all cores, for rows of few bytes that cost much
    each: the files' splits go by bytes (a row group is never cut), so that a
    million such rows would be one task."""
    return df.repartition(SPREAD * df.sparkSession.sparkContext.defaultParallelism)
