"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of characters other than ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"

#: A side of a join may be broadcast up to this many rows (of a few dozen bytes each).
BROADCAST_ROWS = 1_000_000

_own_dir: str | None = None
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark is local."""
    global _own_dir
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="wayglint-")
    return _own_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Cuts the lineage: writes ``df`` as a table in the shared folder and reads it back.

    ``instead_of``, a table written before that nothing but ``df`` reads any more, is deleted then.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    if instead_of is not None and (old := (spark, getattr(instead_of, "_written_to", None))) in _written:
        _delete(*old)
        _written.remove(old)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _remove_written() -> None:
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # the session has ended; its shared folder is the cluster's to clear
            return


def small_side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marks ``df`` for broadcast if it has at most ``most`` rows; beyond that the join shuffles both sides."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner", ways: int = 16) -> DataFrame:
    """Joins on ``key``, of which ``left`` may have any number of rows: they are dealt ``ways`` ways by a hash of ``by``.

    ``right`` has one row a key, and is repeated that many times.
    """
    salt = F.pmod(F.xxhash64(F.lit(7), by), F.lit(ways)).cast("int")
    many = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    return left.withColumn("_salt", salt).join(many, [key, "_salt"], how).drop("_salt")


def bounded_batches(spark: SparkSession, megabytes: int = 32) -> None:
    """Bounds the Arrow batches that go to Python by size, so that long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", megabytes << 20)


def words_of(text: Column) -> Column:
    """The words of a text as an array; null gives an empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hex16(x: Column) -> Column:
    """A 64-bit number as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(x), 16, "0"))
