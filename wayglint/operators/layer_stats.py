"""Statistics of images and roads for each member of a geographic layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayglint.config import Settings
from wayglint.functions import metrics as m
from wayglint.operators.consensus import consensus
from wayglint.operators.layers import left_star
from wayglint.operators.traces import segment_lengths


def _each_area(make) -> list:
    return [make(suffix, m.area_is(suffix)) for suffix in m.AREAS]


def prediction_stats(images: DataFrame, lengths: DataFrame, key: str, s: Settings) -> DataFrame:
    """Roads by consensus label: segments, lengths, images a road, latest times, and the class families.

    A road whose label stays open counts as paved, as n less the unpaved ones, and besides as undecided.
    """
    roads = consensus(images.where(F.col(key).isNotNull()), key, "urban", "osm_id", s=s).join(lengths, [key, "osm_id", "urban"], "left")
    roads = m.with_leads(roads, key, "osm_id", label="pred_label")
    out = []
    for a, here in _each_area(lambda a, here: (a, here)):
        unpaved, known = here & (F.col("pred_label") == 1), here & F.col("pred_label").isNotNull()
        out += [
            m.counted(F.coalesce(unpaved, F.lit(False))).alias(f"unpaved_segments{a}"),
            (m.counted(here) - m.counted(F.coalesce(unpaved, F.lit(False)))).alias(f"paved_segments{a}"),
            (m.counted(here) - m.counted(known)).alias(f"undecided_segments{a}"),
            m.summed(here, "length").alias(f"length{a}"),
            m.summed(unpaved, "length").alias(f"length{a}_unpaved"),
            m.summed(here & (F.col("pred_label") == 0), "length").alias(f"length{a}_paved"),
            m.ratio(F.sum(F.when(here, F.col("n"))), m.counted(here)).alias(f"n_predictions_p_osm_id{a}"),
            F.array_sort(F.collect_list(F.when(here, F.col("latest_timestamp")))).alias(f"latest_timestamps{a}"),
        ]
    return roads.groupBy(key).agg(*out, *m.surface_metrics(s.road_classes), *m.class_metrics(s.road_classes, "pred_"))


def road_stats(roads: DataFrame, key: str, s: Settings) -> DataFrame:
    """All roads of the layer: numbers, lengths and class families, each road once an area by its greatest length."""
    r = roads.where(F.col(key).isNotNull()).groupBy(key, "osm_id", "urban").agg(F.max("length").alias("length"), F.max("osm_tags_highway").alias("osm_tags_highway"))
    r = m.with_leads(r, key, "osm_id")
    out = []
    for a, here in _each_area(lambda a, here: (a, here)):
        out += [m.counted(here if a else F.col("lead")).alias(f"number_of_osm_ids{a}"), m.summed(here, "length").alias(f"osm_length{a}")]
    return r.groupBy(key).agg(*out, *m.class_metrics(s.road_classes, "osm_"))


def covered_stats(images: DataFrame, lengths: DataFrame, key: str, s: Settings) -> DataFrame:
    """Roads with an image nearer than the segment distance: covered lengths, images a road, latest times, class families."""
    near = images.where(F.col(key).isNotNull() & F.col("osm_id").isNotNull() & (F.col("distance_meter") < s.segment_distance))
    r = near.groupBy(key, "osm_id", "urban").agg(F.max("timestamp").alias("latest"), F.countDistinct("id").alias("n"), F.max("osm_tags_highway").alias("osm_tags_highway"))
    r = m.with_leads(r.join(lengths, [key, "osm_id", "urban"], "left"), key, "osm_id")
    out = []
    for a, here in _each_area(lambda a, here: (a, here)):
        out += [
            m.summed(here, "length").alias(f"total_length{a}"),
            m.ratio(F.sum(F.when(here, F.col("n"))), m.counted(here)).alias(f"n_points_p_osm_id{a}"),
            F.array_sort(F.collect_list(F.when(here, F.col("latest")))).alias(f"latest_timestamps{a}_osm"),
        ]
    return r.groupBy(key).agg(*out, *m.class_metrics(s.road_classes))


def coverage(images: DataFrame, key: str, s: Settings, lists: bool = True) -> DataFrame:
    """Different images, sequences, covered roads and fine tiles, as numbers and, with ``lists``, as sorted lists.

    Numbers come from rows made different first, a table for each thing that is counted, so that coarse layers hold
    no sets in memory; those leave ``lists`` off.
    """
    here = images.where(F.col(key).isNotNull())
    out = here.select(key).distinct()
    near = here.where(F.col("distance_meter") <= s.segment_distance)
    for name, what, rows in (("number_of_images", "id", here), ("number_of_sequences", "sequence", here), ("count_osm_ids", "osm_id", near)):
        flags = rows.where(F.col(what).isNotNull()).groupBy(key, what).agg(F.max(m.area_is("_urban")).alias("u"), F.max(m.area_is("_rural")).alias("r"))
        numbers = flags.groupBy(key).agg(F.count("*").alias(name), m.counted(F.col("u")).alias(f"{name}_urban"), m.counted(F.col("r")).alias(f"{name}_rural"))
        out = out.join(numbers, key, "left")
    tiles = here.where("z14_tiles is not null").groupBy(key, "z14_tiles").agg(F.lit(1).alias("one")).groupBy(key).agg(F.count("*").alias("number_of_z14_tiles"))
    out = out.join(tiles, key, "left").na.fill(0, [c for c in [*out.columns, "number_of_z14_tiles"] if c != key])
    if not lists:
        return out
    sets = [F.array_sort(F.collect_set(c)).alias(n) for n, c in (("countries", "country"), ("continents", "continent"), ("sequences", "sequence"), ("z14_tile_list", "z14_tiles"))]
    close = F.col("distance_meter") <= s.segment_distance
    sets += [F.array_sort(F.collect_set(F.when(close & h, F.col("osm_id")))).alias(f"osm_ids{a}") for a, h in _each_area(lambda a, h: (a, h))]
    return out.join(here.groupBy(key).agg(*sets), key, "left")


def layer_stats(images: DataFrame, traces: DataFrame, roads: DataFrame, key: str, s: Settings | None = None, lists: bool = True) -> DataFrame:
    """One row for each member of the layer: coverage, predictions, all roads and covered roads side by side.

    The same four tables serve every layer: tiles, urban areas, countries, continents, or a constant for the world.
    """
    s = s or Settings()
    lengths = segment_lengths(traces, key)
    return left_star(coverage(images, key, s, lists), key, pred=prediction_stats(images, lengths, key, s), osm=road_stats(roads, key, s), covered=covered_stats(images, lengths, key, s))


def road_totals(roads: DataFrame, *keys: str, s: Settings | None = None) -> DataFrame:
    """Road numbers, lengths and class families by country (or other keys): general ones of each road once, by area of all rows."""
    s = s or Settings()
    one = roads.groupBy(*keys, "osm_id").agg(F.max("length").alias("length"), F.max("osm_tags_highway").alias("osm_tags_highway"), F.lit(None).cast("int").alias("urban"))
    general = one.withColumn("lead", F.lit(True)).groupBy(*keys).agg(
        F.count("*").alias("number_of_osm_ids"), F.sum("length").alias("osm_length"), *[c for c, n in zip(m.class_metrics(s.road_classes, "osm_"), _class_order(s), strict=True) if not n.endswith(("_urban", "_rural"))]
    )
    by_road = roads.groupBy(*keys, "osm_id", "urban").agg(F.sum("length").alias("length"), F.max("osm_tags_highway").alias("osm_tags_highway")).withColumn("lead", F.lit(True))
    areas = by_road.groupBy(*keys).agg(
        *[m.summed(m.area_is(a), "length").alias(f"osm_length{a}") for a in m.AREAS[1:]], *[c for c, n in zip(m.class_metrics(s.road_classes, "osm_"), _class_order(s), strict=True) if n.endswith(("_urban", "_rural"))]
    )
    return areas.join(general, list(keys), "left")


def _class_order(s: Settings) -> list[str]:
    return [f"osm_{c}_{what}{a}" for c in s.road_classes for a in m.AREAS for what in ("id", "length")]


