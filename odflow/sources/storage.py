"""Files through Hadoop file systems: the same calls for a local folder and
any remote store."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def listing(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of all files below ``folder``, sorted."""
    fs, p = _fs(spark, folder)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        f = it.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def head(spark: SparkSession, path: str, n_bytes: int) -> bytes:
    """The first bytes of a file, decompressed by what its name says."""
    fs, p = _fs(spark, path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codec = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    stream = fs.open(p)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        return bytes(stream.readNBytes(n_bytes))
    finally:
        stream.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    _, q = _fs(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot rename {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty marker file."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
