"""Families of conditional metrics, as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

AREAS = ("", "_urban", "_rural")


def in_class(tags: Sequence[str], column: str = "osm_tags_highway") -> Column:
    if not tags:
        raise ValueError("a road class needs a tag at least")
    return F.coalesce(F.col(column).isin(*tags), F.lit(False))


def with_leads(rows: DataFrame, *keys: str, label: str | None = None) -> DataFrame:
    """Marks one row of each road of ``keys`` (``lead``), and with ``label`` one of each road and label (``lead_label``).

    Rows are a road in an area each. Sums of the marks then count different roads without distinct aggregates, whose
    rows Spark would multiply by the number of metrics.
    """
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("urban")) == 1
    rows = rows.withColumn("lead", first(*keys))
    return rows if label is None else rows.withColumn("lead_label", first(*keys, label))


def area_is(suffix: str) -> Column:
    return F.lit(True) if not suffix else F.coalesce(F.col("urban") == (1 if suffix == "_urban" else 0), F.lit(False))


def counted(where: Column) -> Column:
    return F.sum(where.cast("bigint"))


def summed(where: Column, what: str) -> Column:
    return F.sum(F.when(where, F.col(what)).otherwise(F.lit(0.0)))


def class_metrics(classes: Mapping[str, Sequence[str]], prefix: str = "", length: str = "length") -> list[Column]:
    """``{prefix}{class}_id{area}`` and ``{prefix}{class}_length{area}`` over rows of ``with_leads``."""
    out = []
    for name, tags in classes.items():
        for suffix in AREAS:
            here = area_is(suffix) & in_class(tags)
            out += [counted(here if suffix else here & F.col("lead")).alias(f"{prefix}{name}_id{suffix}"), summed(here, length).alias(f"{prefix}{name}_length{suffix}")]
    return out


def surface_metrics(classes: Mapping[str, Sequence[str]], label: str = "pred_label") -> list[Column]:
    """``{class}{area}_unpaved`` and ``_paved``: roads of either label."""
    out = []
    for name, tags in classes.items():
        for suffix in AREAS:
            here = area_is(suffix) & in_class(tags)
            here = here if suffix else here & F.col("lead_label")
            out += [F.coalesce(counted(here & (F.col(label) == value)), F.lit(0)).alias(f"{name}{suffix}_{surface}") for surface, value in (("unpaved", 1), ("paved", 0))]
    return out


def surface_names(classes: Mapping[str, Sequence[str]]) -> list[str]:
    return [f"{name}{suffix}_{surface}" for name in classes for suffix in AREAS for surface in ("unpaved", "paved")]


def class_names(classes: Mapping[str, Sequence[str]], what: str, prefix: str = "") -> list[str]:
    return [f"{prefix}{name}_{what}{suffix}" for name in classes for suffix in AREAS]


def sums(names: Sequence[str], factor: float = 1) -> list[Column]:
    """Each column's sum over the factor, by the column's name."""
    return [(F.sum(n) if factor == 1 else F.sum(n) / factor).alias(n) for n in names]


def ratio(over: Column, under: Column) -> Column:
    """Null where the denominator is 0 or null."""
    return F.try_divide(over.cast("double"), under.cast("double"))


def ratios(over: Sequence[str], under: Sequence[str | Column]) -> list[Column]:
    """``{over}_ratio`` of the sums; a denominator may be a column expression instead, such as a joined total."""
    return [ratio(F.sum(a), F.sum(b) if isinstance(b, str) else b).alias(f"{a}_ratio") for a, b in zip(over, under, strict=True)]


def paved_ratios(classes: Mapping[str, Sequence[str]]) -> list[Column]:
    """``{class}{area}_paved_ratio``: paved over paved and unpaved."""
    names = [f"{name}{suffix}" for name in classes for suffix in AREAS]
    return [ratio(F.sum(f"{n}_paved"), F.sum(f"{n}_paved") + F.sum(f"{n}_unpaved")).alias(f"{n}_paved_ratio") for n in names]


def prefixed(df: DataFrame, prefix: str, suffix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keep})
