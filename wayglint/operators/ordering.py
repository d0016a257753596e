"""Order, limits, samples and chunks that don't depend on how rows lie."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def order_nulls_last(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int = 1) -> DataFrame:
    """The first k rows of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= k).drop("_n")


def page(df: DataFrame, order: list, limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


BINS = 4096


def numbered(df: DataFrame, key: str, seed: int | None = None, name: str = "rn") -> DataFrame:
    """Numbers rows from 1 in the order of a unique whole-number ``key``, or of its seeded hash: a shuffle that reruns repeat.

    Rows are ordered inside bins of the order's range, and each bin counts on from the sizes of those before it, so
    no task holds all rows. Rows whose key is null are left out.
    """
    df = df.where(F.col(key).isNotNull())
    if seed is None:
        low, high = df.agg(F.min(key), F.max(key)).first()
        binned = df.withColumn("_o", F.col(key).cast("bigint")).withColumn("_b", F.floor((F.col("_o") - (low or 0)) / (((high or 0) - (low or 0)) // BINS + 1)))
    else:
        binned = df.withColumn("_o", F.xxhash64(F.lit(seed), F.col(key))).withColumn("_b", F.shiftright("_o", 64 - BINS.bit_length() + 1).cast("bigint"))
    sizes = binned.groupBy("_b").agg(F.count("*").alias("_c"))
    before = sizes.select("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = binned.join(F.broadcast(before), "_b").withColumn(name, F.row_number().over(Window.partitionBy("_b").orderBy("_o", key)) + F.col("_before"))
    return placed.drop("_o", "_b", "_before")


def ceil_chunks(df: DataFrame, total: int, n: int, rn: str = "rn") -> DataFrame:
    """Contiguous chunks of ceil(total / n) rows, numbered from 0."""
    return df.withColumn("chunk", F.floor((F.col(rn) - 1) / max(1, math.ceil(total / n))).cast("int"))


def near_equal_chunks(df: DataFrame, total: int, n: int, rn: str = "rn") -> DataFrame:
    """n contiguous chunks whose sizes differ by one at most, the larger first."""
    small, larger = divmod(total, n)
    i = F.col(rn) - 1
    first = larger * (small + 1)
    chunk = F.when(i < first, F.floor(i / (small + 1))).otherwise(larger + F.floor((i - first) / max(1, small)))
    return df.withColumn("chunk", chunk.cast("int"))


def batches_of(df: DataFrame, size: int, rn: str = "rn") -> DataFrame:
    return df.withColumn("batch", F.floor((F.col(rn) - 1) / size).cast("int"))


def strided(df: DataFrame, i: int, n: int, rn: str = "rn") -> DataFrame:
    """Every n-th row from the i-th, counted from 0."""
    return df.where((F.col(rn) - 1) % n == i)


def sample_with_replacement(df: DataFrame, total: int, n: int, seed: int = 0, rn: str = "rn") -> DataFrame:
    """n rows drawn with replacement: as many hashed draws, joined to the row numbers."""
    draws = df.sparkSession.range(n).select((F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(total, 1))) + 1).alias("_draw"))
    return df.join(draws, df[rn] == F.col("_draw")).drop("_draw")
