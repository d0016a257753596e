"""DuckDB SQL for the layer statistics, by plain definitions: distinct counts and filtered sums."""

from __future__ import annotations

from wayglint.config import ROAD_CLASSES
from wayglint.plans.fixtures import with_

AREA = {"": "true", "_urban": "urban = 1", "_rural": "urban = 0"}


def _in(tags) -> str:
    return "osm_tags_highway IN (" + ", ".join(f"'{t}'" for t in tags) + ")"


def families(prefix: str = "") -> str:
    out = []
    for name, tags in ROAD_CLASSES.items():
        for a, here in AREA.items():
            out.append(f"count(DISTINCT osm_id) FILTER ({here} AND {_in(tags)})::BIGINT AS {prefix}{name}_id{a}")
            out.append(f"coalesce(sum(length) FILTER ({here} AND {_in(tags)}), 0)::DOUBLE AS {prefix}{name}_length{a}")
    return ", ".join(out)


def surfaces() -> str:
    return ", ".join(
        f"count(DISTINCT osm_id) FILTER ({here} AND {_in(tags)} AND pred_label = {value})::BIGINT AS {name}{a}_{surface}"
        for name, tags in ROAD_CLASSES.items() for a, here in AREA.items() for surface, value in (("unpaved", 1), ("paved", 0))
    )


def _text(lst: str) -> str:
    return f"array_to_string(list_sort(list_distinct({lst})), ',')"


def consensus_ctes(*keys: str) -> str:
    k = ", ".join(keys)
    return f"""
rel AS (SELECT * FROM stat_images WHERE zs_pred_score > -1 AND zs_pred_score < 1 AND pred_score >= 0.8::DOUBLE AND no_road_image_filter = 1 AND pred_label IS NOT NULL AND distance_meter < 10),
tot AS (SELECT *, sum(distance_meter) OVER (PARTITION BY {k}) AS t FROM rel),
vote AS (SELECT *, floor((CASE WHEN distance_meter = t THEN 1.0::DOUBLE ELSE (t - distance_meter) / t END) * (CASE pred_label WHEN 0 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END) * 1e6 + 0.5::DOUBLE)::BIGINT AS m FROM tot),
grp AS (SELECT {k}, sum(m)::DOUBLE / count(*) AS mean, median(timestamp) FILTER (pred_label = 0) AS paved, median(timestamp) FILTER (pred_label = 1) AS unpaved,
        count(DISTINCT id)::BIGINT AS n, max(timestamp) AS latest_timestamp, max(osm_tags_highway) AS osm_tags_highway FROM vote GROUP BY {k}),
con AS (SELECT {k}, CASE WHEN mean / 1e6 < -0.3::DOUBLE THEN 0 WHEN mean / 1e6 > 0.3::DOUBLE THEN 1 WHEN paved > unpaved THEN 0 WHEN paved < unpaved THEN 1 END AS pred_label,
        n, floor(mean + 0.5::DOUBLE)::BIGINT AS score_micro, latest_timestamp, osm_tags_highway FROM grp)"""


def _pred() -> str:
    out = []
    for a, h in AREA.items():
        out.append(f"""count(*) FILTER ({h} AND pred_label = 1)::BIGINT AS unpaved_segments{a}, (count(*) FILTER ({h}) - count(*) FILTER ({h} AND pred_label = 1))::BIGINT AS paved_segments{a},
 count(*) FILTER ({h} AND pred_label IS NULL)::BIGINT AS undecided_segments{a}, coalesce(sum(length) FILTER ({h}), 0)::DOUBLE AS length{a},
 coalesce(sum(length) FILTER ({h} AND pred_label = 1), 0)::DOUBLE AS length{a}_unpaved, coalesce(sum(length) FILTER ({h} AND pred_label = 0), 0)::DOUBLE AS length{a}_paved,
 (sum(n) FILTER ({h}))::DOUBLE / nullif(count(*) FILTER ({h}), 0) AS n_predictions_p_osm_id{a}, coalesce(list_sort(list(latest_timestamp) FILTER ({h})), []) AS latest_timestamps{a}""")
    return ", ".join(out)


def _covered() -> str:
    return ", ".join(
        f"coalesce(sum(length) FILTER ({h}), 0)::DOUBLE AS total_length{a}, (sum(n) FILTER ({h}))::DOUBLE / nullif(count(*) FILTER ({h}), 0) AS n_points_p_osm_id{a}, coalesce(list_sort(list(latest) FILTER ({h})), []) AS latest_timestamps{a}_osm"
        for a, h in AREA.items()
    )


def layer_ctes(key: str) -> str:
    """Relations up to ``stats``, a row for each value of the key expression."""
    counts = ", ".join(
        f"count(DISTINCT id) FILTER ({h})::BIGINT AS number_of_images{a}, count(DISTINCT sequence) FILTER ({h})::BIGINT AS number_of_sequences{a}, count(DISTINCT osm_id) FILTER ({h} AND distance_meter <= 15)::BIGINT AS count_osm_ids{a},"
        f" coalesce(list_sort(list(DISTINCT osm_id) FILTER ({h} AND distance_meter <= 15)), []) AS osm_ids{a}"
        for a, h in AREA.items()
    )
    roads = ", ".join(f"count(DISTINCT osm_id) FILTER ({h})::BIGINT AS number_of_osm_ids{a}, coalesce(sum(length) FILTER ({h}), 0)::DOUBLE AS osm_length{a}" for a, h in AREA.items())
    return f"""
{with_("stat_images").rstrip().rstrip(",").replace("stat_images AS (", "all_images AS (", 1)},
stat_images AS (SELECT *, {key} AS k FROM all_images WHERE {key} IS NOT NULL),
{consensus_ctes("k", "urban", "osm_id").lstrip()},
seg AS (SELECT k, osm_id, urban, max(length) AS length FROM stat_images GROUP BY k, osm_id, urban),
pr AS (SELECT con.*, seg.length FROM con LEFT JOIN seg USING (k, osm_id, urban)),
pred AS (SELECT k, {_pred()}, {surfaces()}, {families("pred_")} FROM pr GROUP BY k),
rd AS (SELECT k, osm_id, urban, max(road_length) AS length, max(osm_tags_highway) AS osm_tags_highway FROM stat_images GROUP BY k, osm_id, urban),
osm AS (SELECT k, {roads}, {families("osm_")} FROM rd GROUP BY k),
cv AS (SELECT c.*, seg.length FROM (SELECT k, osm_id, urban, max(timestamp) AS latest, count(DISTINCT id) AS n, max(osm_tags_highway) AS osm_tags_highway FROM stat_images WHERE distance_meter < 15 GROUP BY k, osm_id, urban) c LEFT JOIN seg USING (k, osm_id, urban)),
cov AS (SELECT k, {_covered()}, {families()} FROM cv GROUP BY k),
agg AS (SELECT k, {counts}, count(DISTINCT z14_tiles)::BIGINT AS number_of_z14_tiles, list_sort(list(DISTINCT country)) AS countries, list_sort(list(DISTINCT continent)) AS continents,
        list_sort(list(DISTINCT sequence)) AS sequences, list_sort(list(DISTINCT z14_tiles)) AS z14_tile_list FROM stat_images GROUP BY k),
stats AS (SELECT * FROM agg LEFT JOIN pred USING (k) LEFT JOIN osm USING (k) LEFT JOIN cov USING (k))"""


LISTS = ["countries", "continents", "sequences", "z14_tile_list", *[f"osm_ids{a}" for a in AREA], *[f"latest_timestamps{a}" for a in AREA], *[f"latest_timestamps{a}_osm" for a in AREA]]
SETS = ["countries", "continents", "sequences", "z14_tile_list", *[f"osm_ids{a}" for a in AREA]]


def layer_sql(key: str, name: str, lists: bool = True) -> str:
    if lists:
        shown = ", ".join(f"array_to_string({n}, ',') AS {n}" for n in LISTS)
        return f"{layer_ctes(key)}\nSELECT k AS {name}, * EXCLUDE (k) REPLACE ({shown}) FROM stats"
    rest = [n for n in LISTS if n not in SETS]
    shown = ", ".join(f"array_to_string({n}, ',') AS {n}" for n in rest)
    return f"{layer_ctes(key)}\nSELECT k AS {name}, * EXCLUDE (k, {', '.join(SETS)}) REPLACE ({shown}) FROM stats"


def _names(what: str, prefix: str = "") -> list[str]:
    return [f"{prefix}{c}_{what}{a}" for c in ROAD_CLASSES for a in AREA]


def compiled_select(group: str, totals: bool = False, exact: bool = False) -> str:
    """The select list of compiled statistics over ``partials p`` (and ``totals t``)."""
    total = lambda n: f"max(t.{n})" if totals else f"sum(p.{n})"
    numbers = [f"{n}{a}" for n in ("number_of_images", "number_of_sequences", "count_osm_ids", "number_of_osm_ids", "paved_segments", "unpaved_segments", "undecided_segments") for a in AREA] + ["number_of_z14_tiles"]
    numbers = [n for n in numbers if not (exact and n.startswith("count_osm_ids"))]
    for prefix in ("", "pred_", "osm_"):
        numbers += _names("id", prefix)
    numbers += [f"{c}{a}_{x}" for c in ROAD_CLASSES for a in AREA for x in ("unpaved", "paved")]
    lengths = [f"{n}{a}" for n in ("total_length", "osm_length", "length") for a in AREA] + [f"length{a}_{x}" for a in AREA for x in ("unpaved", "paved")]
    for prefix in ("", "pred_", "osm_"):
        lengths += _names("length", prefix)
    out = [f"sum(p.{n})::BIGINT AS {n}" for n in numbers] + [f"sum(p.{n})::DOUBLE / 1000 AS {n}" for n in lengths]
    share = lambda a, b, n: f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0) AS {n}"
    for a in AREA:
        out.append(share(f"sum(p.paved_segments{a})", f"sum(p.paved_segments{a}) + sum(p.unpaved_segments{a})", f"paved_ratio{a}"))
        out.append(share(f"len(list_distinct(flatten(list(p.osm_ids{a}))))" if exact else f"sum(p.count_osm_ids{a})", total(f"number_of_osm_ids{a}"), f"osm_coverage{a}"))
        out.append(share(f"sum(p.length{a})", total(f"osm_length{a}"), f"pred_length_ratio{a}"))
        out.append(share(f"sum(p.total_length{a})", total(f"osm_length{a}"), f"covered_length_ratio{a}"))
    for what in ("length", "id"):
        for prefix in ("", "pred_"):
            out += [share(f"sum(p.{x})", total(y), f"{x}_ratio") for x, y in zip(_names(what, prefix), _names(what, "osm_"), strict=True)]
    out += [share(f"sum(p.{c}{a}_paved)", f"sum(p.{c}{a}_paved) + sum(p.{c}{a}_unpaved)", f"{c}{a}_paved_ratio") for c in ROAD_CLASSES for a in AREA]
    if exact:
        for a in AREA:
            merged = f"list_distinct(flatten(list(p.osm_ids{a})))"
            out += [f"{_text(f'flatten(list(p.osm_ids{a}))')} AS osm_ids{a}", f"len({merged})::BIGINT AS count_osm_ids{a}"]
            out += [share(f"sum(floor(p.{n} * len(p.osm_ids{a}) * 1e6 + 0.5::DOUBLE)::BIGINT)::DOUBLE / 1e6", f"len({merged})", n) for n in (f"n_predictions_p_osm_id{a}", f"n_points_p_osm_id{a}")]
            for n in (f"latest_timestamps{a}", f"latest_timestamps{a}_osm"):
                out.append(f"coalesce(array_to_string(list_sort(flatten(list(p.{n}) FILTER (p.{n} IS NOT NULL))), ','), '') AS {n}")
        out += [f"{_text(f'flatten(list(p.{n}))')} AS {n}" for n in ("countries", "continents", "sequences", "z14_tile_list")]
    return f"{group}, " + ",\n ".join(out)


def compile_sql(key: str, name: str, totals: bool = False, exact: bool = False) -> str:
    """Partials by tile and key, compiled by key."""
    ctes = layer_ctes(f"(z8_tiles || '|' || {key})")
    totals_cte = f""",
one AS (SELECT {key} AS g, osm_id, urban, max(road_length) AS length, max(osm_tags_highway) AS osm_tags_highway FROM all_images GROUP BY ALL),
totals AS (SELECT g, {', '.join(f"count(DISTINCT osm_id) FILTER ({h})::BIGINT AS number_of_osm_ids{a}, coalesce(sum(length) FILTER ({h}), 0)::DOUBLE AS osm_length{a}" for a, h in AREA.items())}, {families("osm_")} FROM one GROUP BY g)""" if totals else ""
    join = " LEFT JOIN totals t ON p.g = t.g::VARCHAR" if totals else ""
    return f"""{ctes}{totals_cte},
partials AS (SELECT *, split_part(k, '|', 2) AS g FROM stats)
SELECT {compiled_select(f"p.g AS {name}", totals, exact)} FROM partials p{join} GROUP BY p.g"""
