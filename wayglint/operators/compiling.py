"""Merging of partial layer statistics into final ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayglint.config import Settings
from wayglint.functions import arrays, geo
from wayglint.functions import metrics as m


def _numbers(s: Settings) -> list[str]:
    names = [f"{n}{a}" for n in ("number_of_images", "number_of_sequences", "count_osm_ids", "number_of_osm_ids", "paved_segments", "unpaved_segments", "undecided_segments") for a in m.AREAS] + ["number_of_z14_tiles"]
    for prefix in ("", "pred_", "osm_"):
        names += m.class_names(s.road_classes, "id", prefix)
    return names + m.surface_names(s.road_classes)


def _ratios(s: Settings, covered: Callable[[str], Column], total: dict[str, Column] | None) -> list[Column]:
    """Shares of paved roads, of covered roads and lengths, in all and by class; ``total`` replaces summed road totals by joined ones."""
    of = lambda name: F.sum(name) if total is None else total[name]
    out = []
    for a in m.AREAS:
        out.append(m.ratio(F.sum(f"paved_segments{a}"), F.sum(f"paved_segments{a}") + F.sum(f"unpaved_segments{a}")).alias(f"paved_ratio{a}"))
        out.append(m.ratio(covered(a), of(f"number_of_osm_ids{a}")).alias(f"osm_coverage{a}"))
        out.append(m.ratio(F.sum(f"length{a}"), of(f"osm_length{a}")).alias(f"pred_length_ratio{a}"))
        out.append(m.ratio(F.sum(f"total_length{a}"), of(f"osm_length{a}")).alias(f"covered_length_ratio{a}"))
    for what in ("length", "id"):
        under = [of(n) for n in m.class_names(s.road_classes, what, "osm_")]
        for prefix in ("", "pred_"):
            out += m.ratios(m.class_names(s.road_classes, what, prefix), under)
    return out + m.paved_ratios(s.road_classes)


def compile_stats(partials: DataFrame, key: str, s: Settings | None = None, totals: DataFrame | None = None, exact_ids: bool = False) -> DataFrame:
    """Final statistics of each ``key`` from partial rows: sums, lengths in km, and shares.

    Sums of partial numbers count what is in several partials as often. ``exact_ids`` merges the lists of roads and fine
    tiles as well: covered roads and their share are those of the merged list, by which means a road are weighed too. ``totals`` (``key`` and road totals, of ``road_totals``
    or the like) serve as denominators where partial road totals would count a road twice.
    """
    s = s or Settings()
    lengths = [f"{n}{a}" for n in ("total_length", "osm_length", "length") for a in m.AREAS] + [f"length{a}_{x}" for a in m.AREAS for x in ("unpaved", "paved")]
    for prefix in ("", "pred_", "osm_"):
        lengths += m.class_names(s.road_classes, "length", prefix)
    total = None
    if totals is not None:
        names = [n for n in totals.columns if n != key]
        partials = partials.join(totals.select(F.col(key).alias("_total"), *[F.col(n).alias(f"_t_{n}") for n in names]), partials[key].eqNullSafe(F.col("_total")), "left").drop("_total")
        total = {n: F.max(f"_t_{n}") for n in names}
    merged_ids = lambda a: F.size(arrays.merge_sets(f"osm_ids{a}"))
    covered = merged_ids if exact_ids else lambda a: F.sum(f"count_osm_ids{a}")
    summed = [n for n in _numbers(s) if not (exact_ids and n.startswith("count_osm_ids"))]
    out = [*m.sums(summed), *m.sums(lengths, 1000), *_ratios(s, covered, total)]
    if exact_ids:
        for a in m.AREAS:
            merged = merged_ids(a)
            out += [arrays.merge_sets(f"osm_ids{a}").alias(f"osm_ids{a}"), merged.cast("bigint").alias(f"count_osm_ids{a}")]
            for n in (f"n_predictions_p_osm_id{a}", f"n_points_p_osm_id{a}"):
                weighted = F.floor(F.col(n) * F.size(f"osm_ids{a}") * 1e6 + 0.5).cast("bigint")  # whole millionths add up alike in any order
                out.append(m.ratio(F.sum(weighted) / 1e6, merged).alias(n))
            out += [arrays.merge_lists(f"latest_timestamps{a}").alias(f"latest_timestamps{a}"), arrays.merge_lists(f"latest_timestamps{a}_osm").alias(f"latest_timestamps{a}_osm")]
        out += [arrays.merge_sets(n).alias(n) for n in ("countries", "continents", "sequences", "z14_tile_list")]
    return partials.groupBy(key).agg(*out)


def with_tile_geometry(stats: DataFrame, tile: str) -> DataFrame:
    """Adds each tile's box as a polygon."""
    return stats.withColumn("geometry", geo.tile_polygon(F.col(tile)))


def on_layer(layer: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Every member of the layer with its statistics, null where there are none."""
    return layer.join(stats.withColumnRenamed(key, "_key"), layer[key].cast("string") == F.col("_key").cast("string"), "left").drop("_key")
