"""Discovery of what a service holds in a box, by splitting boxes that answer with a full page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayglint.functions import geo

BOX = "xmin double, ymin double, xmax double, ymax double"


def discover(boxes: DataFrame, count: Callable[[DataFrame], DataFrame], cap: int = 2000, n: int = 4, rounds: int = 16) -> tuple[DataFrame, DataFrame]:
    """``(done, full)``: boxes with fewer than ``cap`` hits, and those still full after the last round.

    ``count`` adds a column ``hits`` to a table of boxes; each round asks for all open boxes at once and splits the full ones.
    """
    todo, done = boxes.select("xmin", "ymin", "xmax", "ymax"), None
    for _ in range(rounds):
        asked = count(todo).persist()
        small = asked.where(F.col("hits") < cap)
        done = small if done is None else done.unionByName(small)
        full = asked.where(F.col("hits") >= cap)
        if full.isEmpty():
            return done, full
        todo = full.select(F.explode(geo.subdivide("xmin", "ymin", "xmax", "ymax", n)).alias("b")).select("b.*").where("xmin < xmax and ymin < ymax")
    return done, full
