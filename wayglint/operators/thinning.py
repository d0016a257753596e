"""Thinning of image sequences."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayglint.config import EARTH_RADIUS_M
from wayglint.functions import geo

#: Kept ids come in stretches of this many, so that appending to them does not copy all that is kept so far.
STRETCH = 256
_PLACE = "struct<order:bigint,id:bigint,x:double,y:double>"


def _gap(a: Column, b: Column, metric: str) -> Column:
    if metric == "haversine":
        return geo.haversine(a["x"], a["y"], b["x"], b["y"])
    dx = F.radians(b["x"] - a["x"]) * F.cos(F.radians((a["y"] + b["y"]) / 2))
    return EARTH_RADIUS_M * F.sqrt(dx * dx + F.pow(F.radians(b["y"] - a["y"]), F.lit(2.0)))


def thinned(places: Column, distance: Column | float, keep_last: bool = False, metric: str = "haversine") -> Column:
    """Ids that a walk along ordered places keeps: the first, and each that is farther than ``distance`` from the last kept one."""
    limit = distance if isinstance(distance, Column) else F.lit(float(distance))
    none = F.array().cast("array<bigint>")
    start = F.struct(F.lit(None).cast(_PLACE).alias("last"), none.alias("kept"), F.array().cast("array<array<bigint>>").alias("full"))

    def step(s: Column, p: Column) -> Column:
        keep = s["last"].isNull() | (_gap(s["last"], p, metric) > limit)
        longer = F.concat(s["kept"], F.array(p["id"]))
        moved = F.struct(p.cast(_PLACE).alias("last"), longer.alias("kept"), s["full"].alias("full"))
        emptied = F.struct(p.cast(_PLACE).alias("last"), none.alias("kept"), F.concat(s["full"], F.array(longer)).alias("full"))
        return F.when(keep, F.when(F.size(s["kept"]) < STRETCH, moved).otherwise(emptied)).otherwise(s)

    kept = F.aggregate(places, start, step, lambda s: F.concat(F.flatten(s["full"]), s["kept"]))
    return F.array_union(kept, F.array(F.element_at(places, -1)["id"])) if keep_last else kept


def thin(images: DataFrame, urban_spacing: float = 100.0, rural_spacing: float = 1000.0, **how) -> DataFrame:
    """Rows of ``images(sequence, id, timestamp, long, lat, urban)`` that thinning keeps, each at most once.

    Each sequence is walked by time (then id) in its urban and its rural part separately, with the spacing of either.
    """
    place = F.struct(F.col("timestamp").cast("bigint").alias("order"), F.col("id").cast("bigint").alias("id"), F.col("long").alias("x"), F.col("lat").alias("y"))
    walks = images.where("id is not null and long is not null and lat is not null").groupBy("sequence", "urban").agg(F.array_sort(F.collect_list(place)).alias("places"))
    spacing = F.when(F.col("urban") == 1, F.lit(float(urban_spacing))).otherwise(F.lit(float(rural_spacing)))
    kept = walks.select(F.explode(thinned(F.col("places"), spacing, **how)).alias("id")).distinct()
    return images.join(kept, "id", "left_semi")


def _rdp(xs: list[float], ys: list[float], epsilon: float) -> list[int]:
    """Places that Ramer-Douglas-Peucker keeps, planar in degrees, without recursion."""
    keep, todo = {0, len(xs) - 1}, [(0, len(xs) - 1)]
    while todo:
        a, b = todo.pop()
        dx, dy = xs[b] - xs[a], ys[b] - ys[a]
        length2 = dx * dx + dy * dy
        far, at = epsilon, None
        for i in range(a + 1, b):
            t = 0.0 if not length2 else max(0.0, min(1.0, ((xs[i] - xs[a]) * dx + (ys[i] - ys[a]) * dy) / length2))
            d = ((xs[i] - xs[a] - t * dx) ** 2 + (ys[i] - ys[a] - t * dy) ** 2) ** 0.5
            if d > far:
                far, at = d, i
        if at is not None:
            keep.add(at)
            todo += [(a, at), (at, b)]
    return sorted(keep)


def thin_by_shape(images: DataFrame, metres: float) -> DataFrame:
    """Rows of ``images`` that outline each sequence's path within about ``metres`` (Ramer-Douglas-Peucker)."""
    epsilon = metres / 111_195.0

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids = [p[i]["id"] for p in b["places"] for i in _rdp([q["x"] for q in p], [q["y"] for q in p], epsilon)]
            yield pd.DataFrame({"id": pd.Series(ids, dtype="int64")})

    place = F.struct(F.col("timestamp").cast("bigint").alias("order"), F.col("id").cast("bigint").alias("id"), F.col("long").alias("x"), F.col("lat").alias("y"))
    walks = images.groupBy("sequence").agg(F.array_sort(F.collect_list(place)).alias("places")).select("places")
    return images.join(walks.mapInPandas(outline, "id bigint").distinct(), "id", "left_semi")
