"""One label for each road from the votes of its images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayglint.config import Settings


def reliable(images: DataFrame, s: Settings | None = None) -> DataFrame:
    """Images whose vote counts: open bounds for z and distance, a least score, on a road, with a label."""
    s = s or Settings()
    z = F.col("zs_pred_score")
    return images.where((z > -s.sigma) & (z < s.sigma) & (F.col("pred_score") >= s.least_score) & (F.col("no_road_image_filter") == 1) & F.col("pred_label").isNotNull() & (F.col("distance_meter") < s.vote_distance))


def votes(images: DataFrame, *keys: str) -> DataFrame:
    """Each image's vote, -1 for label 0 and 1 for label 1, weighed by nearness: 1 less its share of its group's distances.

    ``partial_micro`` is in millionths, a whole number, so that sums don't depend on the order of rows. An image
    that has all of the distance (alone, or all at 0) has a whole vote.
    """
    total = F.sum("distance_meter").over(Window.partitionBy(*keys))
    sign = F.when(F.col("pred_label") == 0, F.lit(-1.0)).when(F.col("pred_label") == 1, F.lit(1.0))
    d = images.withColumn("_total", total)
    share = F.when(F.col("distance_meter") == F.col("_total"), F.lit(1.0)).otherwise((F.col("_total") - F.col("distance_meter")) / F.col("_total"))
    return d.withColumn("partial_micro", F.floor(share * sign * 1e6 + 0.5).cast("bigint")).drop("_total")


def _label(mean: Column, paved: Column, unpaved: Column, decision: float) -> Column:
    return F.when(mean < -decision, 0).when(mean > decision, 1).when(paved > unpaved, 0).when(paved < unpaved, 1)


def consensus(images: DataFrame, *keys: str, s: Settings | None = None) -> DataFrame:
    """For each group of ``keys``: ``pred_label, n, score_micro, latest_timestamp, osm_tags_highway``.

    A mean vote beyond the decision bound decides; within it the later median time of the two labels does; without
    either the label is null.
    """
    s = s or Settings()
    v = votes(reliable(images, s), *keys)
    of = lambda label: F.median(F.when(F.col("pred_label") == label, F.col("timestamp")))
    g = v.groupBy(*keys).agg(
        F.sum("partial_micro").alias("_sum"), F.count("*").alias("_votes"), of(0).alias("_paved"), of(1).alias("_unpaved"),
        F.countDistinct("id").alias("n"), F.max("timestamp").alias("latest_timestamp"), F.max("osm_tags_highway").alias("osm_tags_highway"),
    )
    mean = F.col("_sum") / F.col("_votes") / F.lit(1e6)
    return g.select(*keys, _label(mean, F.col("_paved"), F.col("_unpaved"), s.decision).alias("pred_label"), "n", F.floor(F.col("_sum") / F.col("_votes") + 0.5).cast("bigint").alias("score_micro"), "latest_timestamp", "osm_tags_highway")
