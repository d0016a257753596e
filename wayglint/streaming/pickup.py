"""Incremental pickup of new files, by checkpoint, as a stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def pick_up(spark: SparkSession, source: str, schema: StructType, checkpoint: str, work: Callable[[DataFrame, int], None], kind: str = "parquet", **options) -> None:
    """Runs ``work(batch, number)`` on files that earlier runs with the checkpoint have not seen, then returns."""
    stream = spark.readStream.schema(schema).options(**options).format(kind).load(source)
    stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def new_ids(stream: DataFrame, key: str, time: str, lateness: str) -> DataFrame:
    """A stream's rows whose key has not come within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])
