"""Traces: a sequence's images along a road as a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayglint.functions import geo


def assemble(images: DataFrame, *keys: str, digits: int | None = 3) -> DataFrame:
    """For each sequence, road, area and further key: ids and vertices by time, geometry (null for one image) and length in metres.

    Lengths have ``digits`` decimals; None leaves them as they are, for what is rounded later, since rounding twice can end on the other side.
    """
    at = F.struct(F.col("timestamp").alias("t"), F.col("id").alias("id"), geo.vertex("long", "lat").alias("v"))
    t = images.where("osm_id is not null").groupBy("sequence", "osm_id", "urban", *keys).agg(F.array_sort(F.collect_list(at)).alias("a"))
    t = t.select("sequence", "osm_id", "urban", *keys, F.col("a.id").alias("ids"), F.col("a.t").alias("timestamps"), F.col("a.v").alias("vertices"))
    shape = F.when(F.size("vertices") > 1, geo.line(F.col("vertices")))
    return t.withColumn("geometry", shape).withColumn("length", geo.path_length(F.col("vertices"), digits))


def segment_lengths(traces: DataFrame, key: str) -> DataFrame:
    """``key, osm_id, urban, length``: the longest trace of any one sequence along a road in an area."""
    return traces.where(F.col(key).isNotNull()).groupBy(key, "osm_id", "urban").agg(F.max("length").alias("length"))
