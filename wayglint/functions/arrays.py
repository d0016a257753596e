"""List operations with the null handling that list columns of partial results need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def list_where(values: Column, mask: Column) -> Column:
    """Elements whose place in ``mask`` is true."""
    return F.transform(F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda z: F.coalesce(z["m"], F.lit(False))), lambda z: z["v"])


def list_select(values: Column, places: Column) -> Column:
    """Elements at the places, counted from 1; null beyond the ends."""
    return F.transform(places, lambda i: F.get(values, (i - 1).cast("int")))


def list_contains(values: Column, x) -> Column:
    """False, never null, where a list without ``x`` has nulls."""
    return F.coalesce(F.array_contains(values, x), F.lit(False))


def list_distinct(values: Column) -> Column:
    """Different elements that are not null, sorted."""
    return F.array_sort(F.array_distinct(F.array_compact(values)))


def first_as_list(values: Column) -> Column:
    return F.slice(values, 1, 1)


def between_mask(values: Column, low: float, high: float) -> Column:
    """Which elements lie strictly between the bounds."""
    return F.transform(values, lambda v: (v > low) & (v < high))


def collect_all(x: Column | str) -> Column:
    """Aggregate: all values, nulls included, which collect_list would drop."""
    x = F.col(x) if isinstance(x, str) else x
    return F.transform(F.collect_list(F.struct(x.alias("v"))), lambda s: s["v"])


def collect_ordered(x: Column, *keys: Column) -> Column:
    """Aggregate: values in the order of the keys."""
    return F.transform(F.array_sort(F.collect_list(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)], x.alias("v")))), lambda s: s["v"])


def merge_sets(lists: Column | str) -> Column:
    """Aggregate: the union of lists of different rows; null lists are empty."""
    lists = F.col(lists) if isinstance(lists, str) else lists
    return list_distinct(F.flatten(F.collect_list(lists)))


def merge_lists(lists: Column | str) -> Column:
    """Aggregate: all elements of the lists, sorted so that the result doesn't depend on the order of rows."""
    lists = F.col(lists) if isinstance(lists, str) else lists
    return F.array_sort(F.flatten(F.collect_list(lists)))


def zip_explode(df: DataFrame, *columns: str) -> DataFrame:
    """One row for each place of the lists, shorter ones filled with null; rows whose lists are all empty or null go."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.arrays_zip(*[F.coalesce(F.col(c), F.array()).alias(c) for c in columns])))


def tag(tags: Column, key: str) -> Column:
    """The first value of a key in a map of lists; null if the key is missing."""
    return F.get(tags[key], F.lit(0))


def parse_tile_lists(lists: Column) -> Column:
    """``['158 137 8'], ...`` to lists of whole numbers."""
    return F.transform(lists, lambda e: F.transform(F.filter(F.split(F.get(e, F.lit(0)), " "), lambda t: t != ""), lambda t: t.cast("int")))
