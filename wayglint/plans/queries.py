"""Queries over the plain tables, one for each operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayglint.config import Settings
from wayglint.functions import arrays, geo
from wayglint.functions import metrics as m
from wayglint.operators import compiling, consensus, layer_stats, layers, matching, ordering, thinning, traces
from wayglint.plans import fixtures as fx
from wayglint.plans import pipelines, stats_sql
from wayglint.plans.fixtures import with_
from wayglint.sources import files

QUERIES: dict = {}
SQL: dict[str, str] = {}
_R = "6371008.0::DOUBLE"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def _haversine_sql(x0: str, y0: str, x1: str, y1: str) -> str:
    return f"(2 * {_R} * asin(least(1.0::DOUBLE, sqrt(pow(sin((radians({y1}) - radians({y0})) / 2), 2) + cos(radians({y0})) * cos(radians({y1})) * pow(sin(radians({x1} - {x0}) / 2), 2)))))"


def _tile_sql(x: str, y: str, z: int) -> tuple[str, str]:
    n = f"{1 << z}.0::DOUBLE"
    return (
        f"least(greatest(floor(({x} + 180.0::DOUBLE) / 360.0::DOUBLE * {n}), 0), {(1 << z) - 1})::INT",
        f"least(greatest(floor((0.5::DOUBLE - ln((1 + sin(radians({y}))) / (1 - sin(radians({y})))) / (4 * pi())) * {n}), 0), {(1 << z) - 1})::INT",
    )


def _tile_name_sql(x: str, y: str, z: int) -> str:
    a, b = _tile_sql(x, y, z)
    return f"concat_ws('-', {a}, {b}, {z})"


# ---- choice among matches ----------------------------------------------------------------------------------------

_PAIRS = f"""{with_("matches")}
near AS (SELECT * FROM matches WHERE distance_meter < 30),
pairs AS (SELECT id, osm_id, min(distance_meter) AS d FROM near GROUP BY id, osm_id),
ranked AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, min(d) OVER (PARTITION BY id) AS least, row_number() OVER (PARTITION BY id ORDER BY d, osm_id) AS rn,
  max((d > 0 AND d < 10)::INT) OVER (PARTITION BY id) AS has1, max((d > 10 AND d < 20)::INT) OVER (PARTITION BY id) AS has2 FROM pairs),
picked AS (SELECT * FROM ranked WHERE CASE WHEN has1 = 1 THEN d > 0 AND d < 10 WHEN has2 = 1 THEN d > 10 AND d < 20 ELSE rn = 1 END)
"""


def _near(spark: SparkSession, sf: str) -> DataFrame:
    return fx.matches(spark, sf).where("distance_meter < 30")


@query(_PAIRS + "SELECT id, osm_id, d AS distance_meter, n::BIGINT AS n, floor((d - least) * 100 + 0.5::DOUBLE)::DOUBLE / 100 AS abs_diff, floor((d - least) * 100 / nullif(least, 0) * 100 + 0.5::DOUBLE)::DOUBLE / 100 AS percent_diff FROM picked")
def resolve_bands(spark: SparkSession, sf: str) -> DataFrame:
    return matching.resolve(_near(spark, sf).select("id", "osm_id", "distance_meter")).select("id", "osm_id", "distance_meter", "n", "abs_diff", "percent_diff")


@query(_PAIRS + "SELECT id, osm_id, d AS distance_meter FROM ranked WHERE rn = 1")
def nearest_per_image(spark: SparkSession, sf: str) -> DataFrame:
    pairs = matching.nearest_per_pair(_near(spark, sf).select("id", "osm_id", "distance_meter"))
    return ordering.top_per_group(pairs, ["id"], ["distance_meter", "osm_id"]).select("id", "osm_id", "distance_meter")


@query(f"{with_('matches')} t AS (SELECT DISTINCT * FROM matches) SELECT id, osm_id, m.d AS distance_meter, m.c AS changeset_timestamp FROM (SELECT id, osm_id, min({{'d': distance_meter, 'c': changeset_timestamp}}) AS m FROM t GROUP BY id, osm_id)")
def nearest_pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    return matching.nearest_per_pair(fx.matches(spark, sf).select("id", "osm_id", "distance_meter", "changeset_timestamp"))


@query(_PAIRS + "SELECT id, any_value(n)::BIGINT AS count, (SELECT string_agg(osm_id::VARCHAR, ',' ORDER BY d, osm_id) FROM pairs p WHERE p.id = k.id) AS osm_ids, string_agg(osm_id::VARCHAR, ',' ORDER BY d, osm_id) AS picks FROM picked k GROUP BY id")
def resolve_lists(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(matching.resolve_listed(_near(spark, sf).select("id", "osm_id", "distance_meter"))).select("id", "count", "osm_ids", "picks")


# ---- geometry ----------------------------------------------------------------------------------------------------


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, {_tile_name_sql('long', 'lat', 8)} AS tile FROM images")
def tile_point_z8(spark: SparkSession, sf: str) -> DataFrame:
    return fx.images(spark, sf).select("id", geo.tile_of("long", "lat", 8).alias("tile"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, {_tile_name_sql('long', 'lat', 14)} AS tile FROM images")
def tile_point_z14(spark: SparkSession, sf: str) -> DataFrame:
    return fx.images(spark, sf).select("id", geo.tile_of("long", "lat", 14).alias("tile"))


@query(f"""{with_('countries')} r AS (SELECT country, {_tile_sql('x0', 'y0', 8)[0]} AS xa, {_tile_sql('x0 + 1', 'y0', 8)[0]} AS xb, {_tile_sql('x0', 'y0 + 1', 8)[1]} AS ya, {_tile_sql('x0', 'y0', 8)[1]} AS yb FROM countries),
x AS (SELECT *, unnest(range(xa, xb + 1)) AS x FROM r), y AS (SELECT *, unnest(range(ya, yb + 1)) AS y FROM x)
SELECT country, concat_ws('-', x, y, 8) AS tile FROM y""")
def tile_cover_bbox(spark: SparkSession, sf: str) -> DataFrame:
    b = geo.bounds(F.col("geometry"))
    return fx.countries(spark, sf).withColumn("b", b).select("country", F.explode(geo.tile_cover("b.xmin", "b.ymin", "b.xmax", "b.ymax", 8)).alias("tile"))


@query(f"""{with_('images')} t AS (SELECT DISTINCT {_tile_sql('long', 'lat', 14)[0]}::DOUBLE AS x, {_tile_sql('long', 'lat', 14)[1]}::DOUBLE AS y FROM images),
b AS (SELECT *, x / 16384 * 360 - 180 AS x0, (x + 1) / 16384 * 360 - 180 AS x1, degrees(atan(sinh(pi() * (1 - 2 * y / 16384)))) AS y1, degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / 16384)))) AS y0 FROM t)
SELECT concat_ws('-', x::INT, y::INT, 14) AS tile, round(x0, 6) AS xmin, round(x1, 6) AS xmax, floor(y0 * 1e6 + 0.5::DOUBLE)::BIGINT AS ymin_micro, floor(y1 * 1e6 + 0.5::DOUBLE)::BIGINT AS ymax_micro FROM b""")
def tile_bounds(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.images(spark, sf).select(geo.tile_of("long", "lat", 14).alias("tile")).distinct().withColumn("b", geo.tile_bounds(F.col("tile")))
    micro = lambda c: F.floor(F.col(c) * 1e6 + 0.5).cast("bigint")
    return t.select("tile", F.round("b.xmin", 6).alias("xmin"), F.round("b.xmax", 6).alias("xmax"), micro("b.ymin").alias("ymin_micro"), micro("b.ymax").alias("ymax_micro"))


_STEPS = f"{with_('images')} s AS (SELECT id, long, lat, lag(long) OVER w AS px, lag(lat) OVER w AS py FROM images WINDOW w AS (PARTITION BY sequence ORDER BY timestamp, id))"


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql.window import Window

    w = Window.partitionBy("sequence").orderBy("timestamp", "id")
    return fx.images(spark, sf).select("id", "long", "lat", F.lag("long").over(w).alias("px"), F.lag("lat").over(w).alias("py")).where("px is not null")


@query(f"{_STEPS} SELECT id, floor({_haversine_sql('px', 'py', 'long', 'lat')} * 1000 + 0.5::DOUBLE)::BIGINT AS mm FROM s WHERE px IS NOT NULL")
def haversine_m(spark: SparkSession, sf: str) -> DataFrame:
    return _steps(spark, sf).select("id", F.floor(geo.haversine("px", "py", "long", "lat") * 1000 + 0.5).cast("bigint").alias("mm"))


@query(f"{_STEPS} SELECT id, floor({_haversine_sql('px', 'py', 'long', 'lat')} * 1000 + 0.5::DOUBLE)::BIGINT AS mm FROM s WHERE px IS NOT NULL")
def haversine_atan2_m(spark: SparkSession, sf: str) -> DataFrame:
    return _steps(spark, sf).select("id", F.floor(geo.haversine_atan("px", "py", "long", "lat") * 1000 + 0.5).cast("bigint").alias("mm"))


@query(f"""{with_('countries')} i AS (SELECT *, unnest(range(3)) AS i FROM countries), j AS (SELECT *, unnest(range(3)) AS j FROM i)
SELECT country, floor((x0 + i / 3.0::DOUBLE) * 1e5 + 0.5::DOUBLE)::BIGINT AS xmin, floor((y0 + j / 3.0::DOUBLE) * 1e5 + 0.5::DOUBLE)::BIGINT AS ymin FROM j""")
def bbox_subdivide(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.countries(spark, sf).select("country", F.explode(geo.subdivide("x0", "y0", F.col("x0") + 1, F.col("y0") + 1, 8)).alias("b"))
    fives = lambda x: F.floor(F.col(x) * 1e5 + 0.5).cast("bigint")
    return c.select("country", fives("b.xmin").alias("xmin"), fives("b.ymin").alias("ymin"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, floor(long * 1e6 + 0.5::DOUBLE)::BIGINT AS x, floor(lat * 1e6 + 0.5::DOUBLE)::BIGINT AS y FROM images")
def wkt_point_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    back = fx.images(spark, sf).select("id", geo.from_wkt(geo.to_wkt(geo.point("long", "lat"))).alias("g")).withColumn("v", geo.start_point(F.col("g")))
    return back.select("id", F.floor(F.col("v.x") * 1e6 + 0.5).cast("bigint").alias("x"), F.floor(F.col("v.y") * 1e6 + 0.5).cast("bigint").alias("y"))


@query(f"{with_('roads')} t AS (SELECT 1) SELECT osm_id, floor(x1 * 1e6 + 0.5::DOUBLE)::BIGINT AS x, floor(y2 * 1e6 + 0.5::DOUBLE)::BIGINT AS y FROM roads")
def wkb_line_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    back = fx.roads(spark, sf).select("osm_id", geo.from_wkb(geo.to_wkb("geometry")).alias("g"))
    return back.select("osm_id", F.floor(geo.start_point(F.col("g"))["x"] * 1e6 + 0.5).cast("bigint").alias("x"), F.floor(geo.end_point(F.col("g"))["y"] * 1e6 + 0.5).cast("bigint").alias("y"))


# ---- projections, filters, joins ---------------------------------------------------------------------------------


@query(f"{with_('stat_images')} t AS (SELECT 1) SELECT id, osm_id, distance_meter FROM stat_images WHERE zs_pred_score > -1 AND zs_pred_score < 1 AND pred_score >= 0.8::DOUBLE AND no_road_image_filter = 1 AND pred_label IS NOT NULL AND distance_meter < 10")
def quality_filter(spark: SparkSession, sf: str) -> DataFrame:
    return consensus.reliable(fx.stat_images(spark, sf)).select("id", "osm_id", "distance_meter")


_CLASS_LIST = ", ".join(f"'{t}'" for tags in Settings().road_classes.values() for t in tags)


@query(f"{with_('roads')} t AS (SELECT 1) SELECT osm_id, osm_tags_highway FROM roads WHERE latest AND visible AND osm_tags_highway IN ({_CLASS_LIST})")
def road_class_filter(spark: SparkSession, sf: str) -> DataFrame:
    tags = [t for group in Settings().road_classes.values() for t in group]
    r = fx.roads(spark, sf).withColumn("tags", F.create_map(F.lit("highway"), F.array("osm_tags_highway")))
    return r.where(F.col("latest") & F.col("visible") & m.in_class(tags, "osm_tags_highway")).select("osm_id", arrays.tag(F.col("tags"), "highway").alias("osm_tags_highway"))


@query("SELECT event_id, event_type, upper(event_type) AS user_id FROM events")
def replace_projection(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "events").select("event_id", "event_type", "user_id").withColumn("user_id", F.upper("event_type"))


@query(f"{with_('images', 'countries')} t AS (SELECT 1) SELECT i.id, c.country, c.continent FROM images i LEFT JOIN countries c ON i.long BETWEEN x0 AND x0 + 1 AND i.lat BETWEEN y0 AND y0 + 1")
def left_layer_join(spark: SparkSession, sf: str) -> DataFrame:
    return layers.join_points(fx.images(spark, sf), fx.countries(spark, sf), ["country", "continent"]).select("id", "country", "continent")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def semi_or_join(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return layers.semi_any(fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", c.where("c_nationkey < 5"), c.where("c_acctbal > 5000")).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25)")
def anti_done(spark: SparkSession, sf: str) -> DataFrame:
    done = fx.table(spark, sf, "lineitem").where("l_quantity > 25").withColumnRenamed("l_orderkey", "o_orderkey")
    return layers.not_done(fx.table(spark, sf, "orders").select("o_orderkey"), done, "o_orderkey")


@query("""WITH a AS (SELECT l_suppkey AS k, sum(l_quantity)::DOUBLE AS q FROM lineitem GROUP BY 1), b AS (SELECT l_suppkey AS k, count(*)::BIGINT AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
c AS (SELECT ps.k, count(*)::BIGINT AS parts FROM (SELECT DISTINCT l_suppkey AS k, l_partkey FROM lineitem WHERE l_quantity > 49) ps GROUP BY 1) SELECT s_suppkey AS k, q, n, parts FROM supplier LEFT JOIN a ON s_suppkey = a.k LEFT JOIN b ON s_suppkey = b.k LEFT JOIN c ON s_suppkey = c.k""")
def star_left_join(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "k")
    return layers.left_star(
        fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), "k",
        a=li.groupBy("k").agg(F.sum("l_quantity").alias("q")), b=li.where("l_returnflag = 'R'").groupBy("k").agg(F.count("*").alias("n")),
        c=li.where("l_quantity > 49").select("k", "l_partkey").distinct().groupBy("k").agg(F.count("*").alias("parts")),
    )


@query("SELECT n_name, (SELECT count(*) FROM orders)::BIGINT AS total FROM nation")
def const_cross_join(spark: SparkSession, sf: str) -> DataFrame:
    return layers.with_constant(fx.table(spark, sf, "nation").select("n_name"), fx.table(spark, sf, "orders").agg(F.count("*").alias("total")))


@query("SELECT s.k, n::BIGINT AS n FROM (SELECT s_suppkey::VARCHAR AS k FROM supplier) s LEFT JOIN (SELECT l_suppkey::VARCHAR AS k, count(*) AS n FROM lineitem GROUP BY 1) l USING (k)")
def casted_key_join(spark: SparkSession, sf: str) -> DataFrame:
    s = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("k"))
    return layers.left_star(s, "k", counts=fx.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n")))


_CAND = f"""{with_('images', 'roads')} pad AS (SELECT *, degrees(50.0::DOUBLE / {_R}) AS dy, degrees(50.0::DOUBLE / {_R}) / cos(radians(least(abs(greatest(y1, y2)) + degrees(50.0::DOUBLE / {_R}), 89.9::DOUBLE))) AS dx FROM roads),
cand AS (SELECT i.id, r.osm_id FROM images i JOIN pad r ON i.long BETWEEN r.x1 - dx AND r.x2 + dx AND i.lat BETWEEN least(y1, y2) - dy AND greatest(y1, y2) + dy)"""


@query(_CAND + " SELECT id, osm_id FROM cand")
def band_join(spark: SparkSession, sf: str) -> DataFrame:
    return matching.candidates(fx.images(spark, sf), fx.roads(spark, sf).select("osm_id", "geometry")).select("id", "osm_id")


# ---- enrichment --------------------------------------------------------------------------------------------------


@query(f"{with_('images', 'countries')} t AS (SELECT 1) SELECT coalesce(continent, 'none') AS continent, count(*)::BIGINT AS n FROM images i LEFT JOIN countries c ON i.long BETWEEN x0 AND x0 + 1 AND i.lat BETWEEN y0 AND y0 + 1 GROUP BY 1")
def enrich_continent(spark: SparkSession, sf: str) -> DataFrame:
    d = layers.join_points(fx.images(spark, sf), fx.countries(spark, sf), ["continent"])
    return d.groupBy(F.coalesce("continent", F.lit("none")).alias("continent")).agg(F.count("*").alias("n"))


@query(f"{with_('images', 'countries')} t AS (SELECT 1) SELECT i.id, c.country, {_tile_name_sql('i.long', 'i.lat', 8)} AS z8_tiles FROM images i LEFT JOIN countries c ON i.long BETWEEN x0 AND x0 + 1 AND i.lat BETWEEN y0 AND y0 + 1")
def enrich_country(spark: SparkSession, sf: str) -> DataFrame:
    d = layers.join_points(fx.images(spark, sf), fx.countries(spark, sf), ["country"])
    return d.select("id", "country", geo.tile_of("long", "lat", 8).alias("z8_tiles"))


_ENRICH = f"""{with_('images', 'countries', 'urban')}
ic AS (SELECT i.*, c.country, c.continent FROM images i LEFT JOIN countries c ON i.long BETWEEN c.x0 AND c.x0 + 1 AND i.lat BETWEEN c.y0 AND c.y0 + 1),
iu AS (SELECT ic.*, u.urban_id FROM ic LEFT JOIN urban u ON ic.country = u.country AND ic.long BETWEEN u.x0 AND u.x0 + u.w AND ic.lat BETWEEN u.y0 AND u.y0 + u.h)"""


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    d = layers.join_points(fx.images(spark, sf), fx.countries(spark, sf), ["country", "continent"])
    return layers.join_points(d, fx.urban(spark, sf), ["urban_id"], layers.URBAN_ZOOM, equal=["country"])


@query(_ENRICH + " SELECT id, country, urban_id FROM iu")
def enrich_urban(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).select("id", "country", "urban_id")


@query(_ENRICH + " SELECT id, max((urban_id IS NOT NULL)::INT) AS urban FROM iu GROUP BY id")
def urban_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).withColumn("urban", layers.is_urban("urban_id")).groupBy("id").agg(F.max("urban").alias("urban"))


@query(_ENRICH + " SELECT country, urban_id, count(*)::BIGINT AS n FROM iu WHERE urban_id IS NOT NULL GROUP BY 1, 2")
def country_tile_urban_join(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).where("urban_id is not null").groupBy("country", "urban_id").agg(F.count("*").alias("n"))


@query(f"{with_('countries', 'urban')} t AS (SELECT 1) SELECT u.urban_id, c.country AS met FROM urban u LEFT JOIN countries c ON u.x0 <= c.x0 + 1 AND u.x0 + u.w >= c.x0 AND u.y0 <= c.y0 + 1 AND u.y0 + u.h >= c.y0")
def polygon_layer_join(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.countries(spark, sf).select("geometry", F.col("country").alias("met"))
    return layers.join_shapes(fx.urban(spark, sf), c, "urban_id", ["met"]).select("urban_id", "met")


@query(f"""{with_('countries', 'roads')} clip AS (SELECT r.osm_id, c.country,
 (c.x0 - x1) / (x2 - x1) AS ta, (c.x0 + 1 - x1) / (x2 - x1) AS tb, CASE WHEN y2 <> y1 THEN (c.y0 - y1) / (y2 - y1) ELSE CASE WHEN y1 BETWEEN c.y0 AND c.y0 + 1 THEN -1e9 ELSE 1e9 END END AS tc,
 CASE WHEN y2 <> y1 THEN (c.y0 + 1 - y1) / (y2 - y1) ELSE 1e9 END AS td FROM roads r JOIN countries c ON r.x1 <= c.x0 + 1 AND r.x2 >= c.x0 AND r.y1 <= c.y0 + 1 AND r.y2 >= c.y0),
met AS (SELECT osm_id, country FROM clip WHERE greatest(ta, tc, 0) <= least(tb, td, 1)) SELECT r.osm_id, met.country FROM roads r LEFT JOIN met USING (osm_id)""")
def line_layer_join(spark: SparkSession, sf: str) -> DataFrame:
    return layers.join_shapes(fx.roads(spark, sf), fx.countries(spark, sf), "osm_id", ["country"]).select("osm_id", "country")


@query(f"""{with_('roads')} r AS (SELECT osm_id, {_tile_sql('x1', 'y1', 8)[0]} AS xa, {_tile_sql('x2', 'y1', 8)[0]} AS xb, {_tile_sql('x1', 'greatest(y1, y2)', 8)[1]} AS ya, {_tile_sql('x1', 'least(y1, y2)', 8)[1]} AS yb FROM roads WHERE latest AND visible),
x AS (SELECT *, unnest(range(xa, xb + 1)) AS x FROM r), y AS (SELECT *, unnest(range(ya, yb + 1)) AS y FROM x) SELECT osm_id, concat_ws('-', x, y, 8) AS z8_tiles FROM y""")
def roads_by_tile(spark: SparkSession, sf: str) -> DataFrame:
    return layers.layer_cells(fx.roads(spark, sf).where("latest and visible"), 8).select("osm_id", F.col("cell").alias("z8_tiles"))


# ---- thinning ----------------------------------------------------------------------------------------------------


def _thin_sql(rows: str, urban: float, rural: float) -> str:
    return f"""WITH RECURSIVE {_ENRICH.removeprefix("WITH ")},
fl AS (SELECT id, any_value(sequence) AS sequence, any_value(timestamp) AS timestamp, any_value(long) AS long, any_value(lat) AS lat, max((urban_id IS NOT NULL)::INT) AS urban FROM iu GROUP BY id),
o AS (SELECT *, row_number() OVER (PARTITION BY sequence, urban ORDER BY timestamp, id) AS rn FROM fl),
w AS (SELECT sequence, urban, rn, id, long AS kx, lat AS ky, true AS kept FROM o WHERE rn = 1
 UNION ALL SELECT o.sequence, o.urban, o.rn, o.id, CASE WHEN d > lim THEN o.long ELSE kx END, CASE WHEN d > lim THEN o.lat ELSE ky END, d > lim
 FROM w JOIN o ON o.sequence = w.sequence AND o.urban = w.urban AND o.rn = w.rn + 1, LATERAL (SELECT {_haversine_sql('w.kx', 'w.ky', 'o.long', 'o.lat')} AS d, CASE o.urban WHEN 1 THEN {urban}::DOUBLE ELSE {rural}::DOUBLE END AS lim))
SELECT id, urban FROM w WHERE kept{rows}"""


def _thinned(spark: SparkSession, sf: str, urban: float = 100.0, rural: float = 1000.0) -> DataFrame:
    d = layers.join_points(fx.images(spark, sf), fx.countries(spark, sf), ["country"])
    d = layers.flag_points(d, fx.urban(spark, sf), "urban", layers.URBAN_ZOOM, equal=["country"])
    one = d.groupBy("id", "sequence", "timestamp", "long", "lat").agg(F.max("urban").alias("urban"))
    return thinning.thin(one, urban, rural).select("id", "urban")


@query(_thin_sql("", 100, 1000))
def thin_combined(spark: SparkSession, sf: str) -> DataFrame:
    return _thinned(spark, sf)


@query(_thin_sql(" AND urban = 1", 3000, 1000))
def thin_urban(spark: SparkSession, sf: str) -> DataFrame:
    return _thinned(spark, sf, urban=3000.0).where("urban = 1")


@query(_thin_sql(" AND urban = 0", 100, 2000))
def thin_rural(spark: SparkSession, sf: str) -> DataFrame:
    return _thinned(spark, sf, rural=2000.0).where("urban = 0")


# ---- matching ----------------------------------------------------------------------------------------------------

_NEAREST = f"""{_CAND},
seg AS (SELECT c.id, c.osm_id, i.long, i.lat, r.x1, r.y1, r.x2 - r.x1 AS dx, r.y2 - r.y1 AS dy FROM cand c JOIN images i USING (id) JOIN roads r USING (osm_id)),
placed AS (SELECT *, least(greatest(((long - x1) * dx + (lat - y1) * dy) / (dx * dx + dy * dy), 0.0::DOUBLE), 1.0::DOUBLE) AS t FROM seg),
near AS (SELECT id, osm_id, long, lat, x1 + t * dx AS qx, y1 + t * dy AS qy FROM placed),
dist AS (SELECT *, {_haversine_sql('long', 'lat', 'qx', 'qy')} AS d FROM near)"""


@query(_CAND + " SELECT osm_id, count(*)::BIGINT AS n FROM cand GROUP BY osm_id")
def match_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return matching.candidate_counts(fx.images(spark, sf), fx.roads(spark, sf))


@query(_NEAREST + " SELECT id, osm_id, floor(qx * 1e6 + 0.5::DOUBLE)::BIGINT AS x, floor(qy * 1e6 + 0.5::DOUBLE)::BIGINT AS y FROM near")
def shortest_point_segment(spark: SparkSession, sf: str) -> DataFrame:
    c = matching.candidates(fx.images(spark, sf), fx.roads(spark, sf).select("osm_id", "geometry"), q=geo.nearest_on_line(geo.vertex("long", "lat"), F.col("geometry")))
    return c.select("id", "osm_id", F.floor(F.col("q.x") * 1e6 + 0.5).cast("bigint").alias("x"), F.floor(F.col("q.y") * 1e6 + 0.5).cast("bigint").alias("y"))


@query(_NEAREST + " SELECT id, osm_id, floor(d * 1000 + 0.5::DOUBLE)::BIGINT AS mm FROM dist WHERE d < 30")
def match_within_30m(spark: SparkSession, sf: str) -> DataFrame:
    found = matching.match(fx.images(spark, sf), fx.roads(spark, sf).select("osm_id", "geometry"), 30.0)
    return found.select("id", "osm_id", F.floor(F.col("distance_meter") * 1000 + 0.5).cast("bigint").alias("mm"))


# ---- traces ------------------------------------------------------------------------------------------------------

_TRACES = f"""{with_('stat_images')} near AS (SELECT * FROM stat_images WHERE distance_meter < 20),
st AS (SELECT *, lag(long) OVER w AS px, lag(lat) OVER w AS py FROM near WINDOW w AS (PARTITION BY sequence, osm_id, urban ORDER BY timestamp, id, long, lat)),
tr AS (SELECT sequence, osm_id, urban, count(*)::BIGINT AS n, coalesce(sum({_haversine_sql('px', 'py', 'long', 'lat')}) FILTER (px IS NOT NULL), 0)::DOUBLE AS len FROM st GROUP BY ALL)"""


def _traced(spark: SparkSession, sf: str, **how) -> DataFrame:
    return traces.assemble(fx.stat_images(spark, sf).where("distance_meter < 20"), **how)


@query(f"{with_('stat_images')} near AS (SELECT * FROM stat_images WHERE distance_meter < 20) SELECT sequence, osm_id, urban, string_agg(id::VARCHAR, ',' ORDER BY timestamp, id) AS ids, count(*) > 1 AS is_line FROM near GROUP BY ALL")
def trace_assemble(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(_traced(spark, sf).select("sequence", "osm_id", "urban", "ids", F.col("geometry").isNotNull().alias("is_line")))


@query(f"{_TRACES} SELECT sequence, osm_id, urban, n, floor(len + 0.5::DOUBLE)::BIGINT AS metres FROM tr")
def trace_length(spark: SparkSession, sf: str) -> DataFrame:
    return _traced(spark, sf, digits=None).select("sequence", "osm_id", "urban", F.size("ids").cast("bigint").alias("n"), F.floor(F.col("length") + 0.5).cast("bigint").alias("metres"))


@query(f"{with_('stat_images')} t AS (SELECT 1) SELECT z8_tiles, osm_id, urban, max(length) AS length FROM stat_images GROUP BY ALL")
def seglen_layer(spark: SparkSession, sf: str) -> DataFrame:
    return traces.segment_lengths(fx.stat_images(spark, sf), "z8_tiles")


# ---- consensus ---------------------------------------------------------------------------------------------------

_CON = with_("stat_images").rstrip().rstrip(",") + "," + stats_sql.consensus_ctes("z8_tiles", "urban", "osm_id")


@query(f"{_CON} SELECT z8_tiles, urban, osm_id, id, distance_meter, m AS partial_micro FROM vote")
def partial_weights(spark: SparkSession, sf: str) -> DataFrame:
    v = consensus.votes(consensus.reliable(fx.stat_images(spark, sf)), "z8_tiles", "urban", "osm_id")
    return v.select("z8_tiles", "urban", "osm_id", "id", "distance_meter", "partial_micro")


@query(f"{_CON} SELECT z8_tiles, urban, osm_id, pred_label, n, score_micro, latest_timestamp FROM con")
def consensus_label(spark: SparkSession, sf: str) -> DataFrame:
    return consensus.consensus(fx.stat_images(spark, sf), "z8_tiles", "urban", "osm_id").select("z8_tiles", "urban", "osm_id", "pred_label", "n", "score_micro", "latest_timestamp")


_WIDE = with_("stat_images").rstrip().rstrip(",") + "," + stats_sql.consensus_ctes("country", "urban", "osm_id")


@query(f"{_WIDE} SELECT country, urban, osm_id, pred_label, score_micro FROM con WHERE score_micro BETWEEN -300000 AND 300000")
def recency_tiebreak(spark: SparkSession, sf: str) -> DataFrame:
    c = consensus.consensus(fx.stat_images(spark, sf), "country", "urban", "osm_id")
    return c.where("score_micro between -300000 and 300000").select("country", "urban", "osm_id", "pred_label", "score_micro")


# ---- layer metrics -----------------------------------------------------------------------------------------------


def _stat_roads(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stat_images(spark, sf).drop("length").withColumnRenamed("road_length", "length")


def _stats(spark: SparkSession, sf: str, key: str, lists: bool = True, expr=None) -> DataFrame:
    images, roads = fx.stat_images(spark, sf), _stat_roads(spark, sf)
    if expr is not None:
        images, roads = images.withColumn(key, expr), roads.withColumn(key, expr)
    return layer_stats.layer_stats(images, images, roads, key, lists=lists)


_L8 = stats_sql.layer_ctes("z8_tiles")


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(n for n in m.surface_names(Settings().road_classes) if 'urban' not in n and 'rural' not in n)} FROM pred")
def surface_general(spark: SparkSession, sf: str) -> DataFrame:
    p = layer_stats.prediction_stats(fx.stat_images(spark, sf), traces.segment_lengths(fx.stat_images(spark, sf), "z8_tiles"), "z8_tiles", Settings())
    return p.select("z8_tiles", *[n for n in m.surface_names(Settings().road_classes) if "urban" not in n and "rural" not in n])


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(n for n in m.surface_names(Settings().road_classes) if 'urban' in n or 'rural' in n)}, length_urban_paved, length_rural_unpaved, undecided_segments FROM pred")
def surface_urban_rural(spark: SparkSession, sf: str) -> DataFrame:
    p = layer_stats.prediction_stats(fx.stat_images(spark, sf), traces.segment_lengths(fx.stat_images(spark, sf), "z8_tiles"), "z8_tiles", Settings())
    return p.select("z8_tiles", *[n for n in m.surface_names(Settings().road_classes) if "urban" in n or "rural" in n], "length_urban_paved", "length_rural_unpaved", "undecided_segments")


_OSM_NAMES = ["number_of_osm_ids", "osm_length", *[n for w in ("id", "length") for n in m.class_names(Settings().road_classes, w, "osm_")]]
_GENERAL = [n for n in _OSM_NAMES if "urban" not in n and "rural" not in n]
_AREAL = ["number_of_osm_ids_urban", "osm_length_rural", *[n for n in _OSM_NAMES if "urban" in n or "rural" in n]]


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(_GENERAL)} FROM osm")
def osm_general(spark: SparkSession, sf: str) -> DataFrame:
    return layer_stats.road_stats(_stat_roads(spark, sf), "z8_tiles", Settings()).select("z8_tiles", *_GENERAL)


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(_AREAL)} FROM osm")
def osm_urban_rural(spark: SparkSession, sf: str) -> DataFrame:
    return layer_stats.road_stats(_stat_roads(spark, sf), "z8_tiles", Settings()).select("z8_tiles", *_AREAL)


_COVER = [f"{n}{a}" for n in ("number_of_images", "number_of_sequences", "count_osm_ids") for a in m.AREAS] + ["number_of_z14_tiles"]


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(_COVER)} FROM agg")
def coverage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return layer_stats.coverage(fx.stat_images(spark, sf), "z8_tiles", Settings(), lists=False).select("z8_tiles", *_COVER)


_POINTS = [f"{n}{a}" for n in ("n_points_p_osm_id", "total_length") for a in m.AREAS]


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(_POINTS)} FROM cov")
def points_per_segment(spark: SparkSession, sf: str) -> DataFrame:
    lengths = traces.segment_lengths(fx.stat_images(spark, sf), "z8_tiles")
    return layer_stats.covered_stats(fx.stat_images(spark, sf), lengths, "z8_tiles", Settings()).select("z8_tiles", *_POINTS)


def _layer_query(name: str, key: str, lists: bool) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return fx.flat(_stats(spark, sf, key, lists))

    run.__name__ = f"layer_stats_{name}"
    query(stats_sql.layer_sql(key, key, lists))(run)


for _name, _key, _lists in (("tile8", "z8_tiles", True), ("tile14", "z14_tiles", True), ("urban", "urban_id", True), ("country", "country", False), ("continent", "continent", False), ("world", "world", False)):
    _layer_query(_name, _key, _lists)


# ---- compiled layers ---------------------------------------------------------------------------------------------


def _partials(spark: SparkSession, sf: str, key: str) -> DataFrame:
    p = _stats(spark, sf, "part_key", True, F.concat_ws("|", "z8_tiles", F.col(key).cast("string")))
    if key == "urban_id":
        p = _stats(spark, sf, "part_key", True, F.when(F.col(key).isNotNull(), F.concat_ws("|", "z8_tiles", F.col(key).cast("string"))))
    return p.withColumn(key, F.split("part_key", r"\|")[1]).drop("part_key")


def _totals(spark: SparkSession, sf: str, key: str) -> DataFrame:
    t = layer_stats.road_stats(_stat_roads(spark, sf), key, Settings())
    return t.withColumn(key, F.col(key).cast("string"))


def _compile_query(name: str, key: str, totals: bool, exact: bool) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        t = _totals(spark, sf, key) if totals else None
        return fx.flat(compiling.compile_stats(_partials(spark, sf, key), key, totals=t, exact_ids=exact))

    run.__name__ = f"compile_{name}"
    query(stats_sql.compile_sql(key, key, totals, exact))(run)


for _name, _key, _with_totals, _exact in (("z14", "z14_tiles", False, True), ("z8", "z8_tiles", False, False), ("urban", "urban_id", False, True), ("country", "country", True, False), ("continent", "continent", True, False), ("world", "world", True, False)):
    _compile_query(_name, _key, _with_totals, _exact)


@query(f"""{with_('stat_images')} t AS (SELECT z8_tiles, list(DISTINCT osm_id) AS l FROM stat_images GROUP BY z8_tiles, id % 3)
SELECT z8_tiles, array_to_string(list_sort(list_distinct(flatten(list(l)))), ',') AS osm_ids, len(list_distinct(flatten(list(l))))::BIGINT AS n FROM t GROUP BY 1""")
def merge_sets(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.stat_images(spark, sf).groupBy("z8_tiles", F.expr("id % 3")).agg(F.collect_set("osm_id").alias("l"))
    g = p.groupBy("z8_tiles").agg(arrays.merge_sets("l").alias("osm_ids"))
    return fx.flat(g.withColumn("n", F.size("osm_ids").cast("bigint")))


@query("SELECT l_suppkey, sum(l_quantity)::DOUBLE / nullif(sum(l_linenumber)::DOUBLE * 1, 0) AS l_quantity_ratio, sum(l_quantity)::DOUBLE / 1000 AS l_quantity FROM lineitem GROUP BY 1")
def ratio_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(*m.ratios(["l_quantity"], ["l_linenumber"]), *m.sums(["l_quantity"], 1000))


@query(f"{_L8} SELECT k AS z8_tiles, {', '.join(f'sum({c}{a}_paved)::DOUBLE / nullif(sum({c}{a}_paved) + sum({c}{a}_unpaved), 0) AS {c}{a}_paved_ratio' for c in Settings().road_classes for a in m.AREAS)} FROM pred GROUP BY k")
def paved_ratios(spark: SparkSession, sf: str) -> DataFrame:
    p = layer_stats.prediction_stats(fx.stat_images(spark, sf), traces.segment_lengths(fx.stat_images(spark, sf), "z8_tiles"), "z8_tiles", Settings())
    return p.groupBy("z8_tiles").agg(*m.paved_ratios(Settings().road_classes))


@query(f"""{with_('stat_images')} t AS (SELECT z8_tiles, id % 3 AS s, count(*) AS n, list(DISTINCT osm_id) AS l FROM stat_images GROUP BY 1, 2)
SELECT z8_tiles, sum(n * len(l))::DOUBLE / nullif(len(list_distinct(flatten(list(l)))), 0) AS mean FROM t GROUP BY 1""")
def weighted_mean_merge(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.stat_images(spark, sf).groupBy("z8_tiles", F.expr("id % 3")).agg(F.count("*").alias("n"), F.collect_set("osm_id").alias("l"))
    return p.groupBy("z8_tiles").agg(m.ratio(F.sum(F.col("n") * F.size("l")), F.size(arrays.merge_sets("l"))).alias("mean"))


_TOTAL_SQL = f"""{with_('stat_images')} r AS (SELECT continent, country, osm_id, urban, road_length AS length, osm_tags_highway FROM stat_images),
g AS (SELECT continent, country, osm_id, max(length) AS length, max(osm_tags_highway) AS osm_tags_highway FROM r GROUP BY ALL),
gs AS (SELECT continent, country, count(*)::BIGINT AS number_of_osm_ids, sum(length)::DOUBLE AS osm_length, {', '.join(f"count(*) FILTER ({stats_sql._in(t)})::BIGINT AS osm_{c}_id, coalesce(sum(length) FILTER ({stats_sql._in(t)}), 0)::DOUBLE AS osm_{c}_length" for c, t in Settings().road_classes.items())} FROM g GROUP BY ALL),
us AS (SELECT continent, country, {', '.join(f"coalesce(sum(length) FILTER ({h}), 0)::DOUBLE AS osm_length{a}, " + ', '.join(f"count(DISTINCT osm_id) FILTER ({h} AND {stats_sql._in(t)})::BIGINT AS osm_{c}_id{a}, coalesce(sum(length) FILTER ({h} AND {stats_sql._in(t)}), 0)::DOUBLE AS osm_{c}_length{a}" for c, t in Settings().road_classes.items()) for a, h in stats_sql.AREA.items() if a)} FROM r GROUP BY ALL)
SELECT * FROM us LEFT JOIN gs USING (continent, country)"""


@query(_TOTAL_SQL)
def osm_country_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return layer_stats.road_totals(_stat_roads(spark, sf), "continent", "country")


# ---- arrays ------------------------------------------------------------------------------------------------------

_LIST = "WITH l AS (SELECT l_orderkey, list(l_quantity ORDER BY l_quantity, l_partkey) AS q, list(l_partkey ORDER BY l_quantity, l_partkey) AS p FROM lineitem GROUP BY 1) "


def _lists(spark: SparkSession, sf: str) -> DataFrame:
    at = (F.col("l_quantity"), F.col("l_partkey"))
    return fx.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(arrays.collect_ordered(F.col("l_quantity"), *at).alias("q"), arrays.collect_ordered(F.col("l_partkey"), *at).alias("p"))


@query(_LIST + "SELECT l_orderkey, array_to_string(list_where(p, list_transform(q, lambda x: x > 10 AND x < 20)), ',') AS p FROM l")
def list_where(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(_lists(spark, sf).select("l_orderkey", arrays.list_where(F.col("p"), arrays.between_mask(F.col("q"), 10, 20)).alias("p")))


@query(_LIST + "SELECT l_orderkey, array_to_string(list_select(p, [1, 3]), ',') AS p FROM l")
def list_select(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(_lists(spark, sf).select("l_orderkey", arrays.list_select(F.col("p"), F.array(F.lit(1), F.lit(3))).alias("p")))


@query(_LIST + "SELECT l_orderkey, unnest(q)::INT AS q, unnest(list_concat(p, [0])) AS p FROM l")
def parallel_unnest(spark: SparkSession, sf: str) -> DataFrame:
    d = _lists(spark, sf).select("l_orderkey", F.col("q").cast("array<int>").alias("q"), F.concat("p", F.array(F.lit(0).cast("bigint"))).alias("p"))
    return arrays.zip_explode(d, "q", "p")


@query("SELECT l_suppkey, array_to_string(list_sort(list_distinct(list(CASE WHEN l_partkey % 7 > 0 THEN l_partkey % 50 END))), ',') AS p, list_contains(list(l_partkey % 50), 7) AS has FROM lineitem GROUP BY 1")
def list_distinct_flatten(spark: SparkSession, sf: str) -> DataFrame:
    g = fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(arrays.collect_all(F.expr("CASE WHEN l_partkey % 7 > 0 THEN l_partkey % 50 END")).alias("p"), arrays.collect_all(F.expr("l_partkey % 50")).alias("a"))
    return fx.flat(g.select("l_suppkey", arrays.list_distinct(F.col("p")).alias("p"), arrays.list_contains(F.col("a"), 7).alias("has")))


@query(f"{with_('roads')} t AS (SELECT osm_id, MAP {{'highway': [osm_tags_highway], 'x': ['y']}} AS tags FROM roads) SELECT osm_id, tags['highway'][1] AS highway, tags['surface'][1] AS surface FROM t")
def map_tag_lookup(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.roads(spark, sf).withColumn("tags", F.create_map(F.lit("highway"), F.array("osm_tags_highway"), F.lit("x"), F.array(F.lit("y"))))
    return d.select("osm_id", arrays.tag(F.col("tags"), "highway").alias("highway"), arrays.tag(F.col("tags"), "surface").alias("surface"))


@query(_LIST + "SELECT l_orderkey, array_to_string(p[1:1], ',') AS p FROM l")
def first_as_list(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(_lists(spark, sf).select("l_orderkey", arrays.first_as_list(F.col("p")).alias("p")))


@query("SELECT s_suppkey, concat_ws(',', s_suppkey % 16, s_nationkey, 8) AS t FROM supplier")
def tile_list_parse(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "supplier").select("s_suppkey", F.array(F.array(F.concat_ws(" ", F.expr("s_suppkey % 16"), F.lit(""), "s_nationkey", F.lit("8")))).alias("z"))
    return fx.flat(d.select("s_suppkey", F.get(arrays.parse_tile_lists(F.col("z")), F.lit(0)).alias("t")))


# ---- order, limits, chunks ---------------------------------------------------------------------------------------


@query("SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_partkey, l_linenumber) AS n FROM lineitem) WHERE n <= 3")
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return ordering.top_per_group(d, ["l_suppkey"], [F.desc("l_quantity"), "l_orderkey", "l_partkey", "l_linenumber"], 3)


@query(_LIST + "SELECT l_orderkey, array_to_string(p, ',') AS p FROM l")
def ordered_list(spark: SparkSession, sf: str) -> DataFrame:
    return fx.flat(_lists(spark, sf).select("l_orderkey", "p"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 500")
def limit_offset_chunk(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.page(fx.table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 1000, 500)


_RN = "WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn, count(*) OVER () AS n FROM orders) "


def _numbered(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    o = fx.table(spark, sf, "orders").select("o_orderkey")
    return ordering.numbered(o, "o_orderkey"), o.count()


@query(_RN + "SELECT o_orderkey, floor((rn - 1) / ceil(n / 10.0::DOUBLE))::INT AS chunk FROM r")
def ceil_chunks(spark: SparkSession, sf: str) -> DataFrame:
    d, n = _numbered(spark, sf)
    return ordering.ceil_chunks(d, n, 10).select("o_orderkey", "chunk")


@query(_RN + "SELECT o_orderkey, rn::BIGINT AS rn FROM r WHERE (rn - 1) % 7 = 3")
def strided_slice(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.strided(_numbered(spark, sf)[0], 3, 7).select("o_orderkey", "rn")


@query("SELECT o_orderkey, (ntile(7) OVER (ORDER BY o_orderkey) - 1)::INT AS chunk FROM orders")
def ntile_split(spark: SparkSession, sf: str) -> DataFrame:
    d, n = _numbered(spark, sf)
    return ordering.near_equal_chunks(d, n, 7).select("o_orderkey", "chunk")


@query(_RN + "SELECT floor((rn - 1) / 100)::INT AS batch, count(*)::BIGINT AS n, min(o_orderkey) AS first FROM r GROUP BY 1")
def fixed_batches(spark: SparkSession, sf: str) -> DataFrame:
    return ordering.batches_of(_numbered(spark, sf)[0], 100).groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first"))


@query("SELECT l_orderkey, l_linenumber, x FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS x FROM lineitem) ORDER BY x NULLS LAST, l_orderkey, l_linenumber")
def nulls_last_sort(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS x")
    return ordering.order_nulls_last(d, "x", "l_orderkey", "l_linenumber")


@query()
def sample_with_replacement(spark: SparkSession, sf: str) -> DataFrame:
    d, n = _numbered(spark, sf)
    return ordering.sample_with_replacement(d, n, 100, seed=1).select("o_orderkey")


@query()
def seeded_shuffle_chunks(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey")
    return ordering.ceil_chunks(ordering.numbered(o, "o_orderkey", seed=42), o.count(), 10).select("o_orderkey", "rn", "chunk")


# ---- sets --------------------------------------------------------------------------------------------------------


@query("SELECT r_name AS name, 'region' AS kind FROM region UNION ALL SELECT n_name, 'nation' FROM nation")
def union_literal_tag(spark: SparkSession, sf: str) -> DataFrame:
    return layers.union_tagged({"region": fx.table(spark, sf, "region").select(F.col("r_name").alias("name")), "nation": fx.table(spark, sf, "nation").select(F.col("n_name").alias("name"))}, "kind")


@query("SELECT l_partkey FROM lineitem WHERE l_quantity > 45 UNION SELECT l_partkey FROM lineitem WHERE l_discount > 0.09::DOUBLE")
def set_union(spark: SparkSession, sf: str) -> DataFrame:
    li = fx.table(spark, sf, "lineitem")
    return li.where("l_quantity > 45").select("l_partkey").union(li.where("l_discount > 9e-2").select("l_partkey")).distinct()


@query("SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    done = fx.table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return layers.not_done(fx.table(spark, sf, "part").select("p_partkey").distinct(), done, "p_partkey")


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def drop_duplicates_subset(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "lineitem").dropDuplicates(["l_returnflag", "l_linestatus"]).select("l_returnflag", "l_linestatus")


@query("""WITH d AS (SELECT DISTINCT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem),
c AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM d GROUP BY ALL), m AS (SELECT l_orderkey, first(l_returnflag ORDER BY n DESC, l_returnflag) AS m FROM c GROUP BY 1)
SELECT l_orderkey, max(l_quantity) AS most, sum(l_quantity)::DOUBLE AS total, count(*)::BIGINT AS n, any_value(m.m) AS m, median(l_quantity) AS mid FROM d JOIN m USING (l_orderkey) GROUP BY 1""")
def group_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag").distinct()
    return d.groupBy("l_orderkey").agg(F.max("l_quantity").alias("most"), F.sum("l_quantity").alias("total"), F.count("*").alias("n"), F.mode("l_returnflag", True).alias("m"), F.median("l_quantity").alias("mid"))


@query("SELECT l_partkey, max(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END) AS most, min(CASE WHEN l_linenumber > 5 THEN l_tax END) AS least FROM lineitem GROUP BY 1")
def null_skipping_extremes(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "lineitem")
    return d.groupBy("l_partkey").agg(F.max(F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity"))).alias("most"), F.min(F.when(F.col("l_linenumber") > 5, F.col("l_tax"))).alias("least"))


# ---- sources and sinks: written, read back -----------------------------------------------------------------------


def _image_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Images in the shape of a metadata file."""
    d = fx.images(spark, sf)
    have = {"sequence": F.col("sequence").cast("string"), "url": F.concat(F.lit("http://img/"), F.col("id")), "geometry": geo.to_wkt(geo.point("long", "lat")), "is_pano": F.col("id") % 2 == 0, "timestamp": F.col("timestamp").cast("bigint")}
    return d.withColumns(have).select(*[F.col(f.name).cast(f.dataType) if f.name in d.columns or f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in files.IMAGE_COLUMNS])


_IMAGE_COLUMNS_SQL = "id, sequence::VARCHAR AS sequence, 'http://img/' || id AS url, long, lat, id % 2 = 0 AS is_pano, timestamp::BIGINT AS timestamp"


@query(f"{with_('images')} t AS (SELECT 1) SELECT {_IMAGE_COLUMNS_SQL}, long AS x, lat AS y FROM images")
def csv_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "csv")
    files.write_csv(_image_rows(spark, sf), path, mode="overwrite")
    p = geo.start_point(F.col("geometry"))
    return files.read_images_csv(spark, path).select("id", "sequence", "url", "long", "lat", "is_pano", "timestamp", p["x"].alias("x"), p["y"].alias("y"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT sequence::VARCHAR AS sequence, count(*)::BIGINT AS n FROM images GROUP BY 1")
def csv_column_subset(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "csv")
    files.write_csv(_image_rows(spark, sf), path, mode="overwrite", rows_per_file=1000)
    return files.read_images_csv(spark, path, columns=["sequence"]).groupBy("sequence").agg(F.count("*").alias("n"))


@query("SELECT r_regionkey, r_name, n FROM region, (VALUES (1::BIGINT), (2::BIGINT)) v(n)")
def csv_append(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "append")
    for n in (1, 2):
        files.write_csv(fx.table(spark, sf, "region").select("r_regionkey", "r_name", F.lit(n).cast("bigint").alias("n")), path)
    return spark.read.schema("r_regionkey int, r_name string, n bigint").option("header", True).csv(path)


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def csv_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "snapshot")
    for region in (1, 2):
        files.write_csv(fx.table(spark, sf, "nation").where(F.col("n_regionkey") == region).select("n_nationkey", "n_name"), path, mode="overwrite")
    return spark.read.schema("n_nationkey int, n_name string").option("header", True).csv(path)


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, long, lat, {_tile_name_sql('long', 'lat', 8)} AS tile FROM images")
def tile_partitions(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "tiles")
    files.write_parquet(fx.images(spark, sf).select("id", "long", "lat", geo.tile_of("long", "lat", 8).alias("tile")), path, "tile", rows_per_file=500)
    return files.read_parquet(spark, path).select("id", "long", "lat", F.col("tile").cast("string").alias("tile"))


@query(f"{with_('images')} t AS (SELECT {_tile_name_sql('long', 'lat', 8)} AS tile, count(*) AS n FROM images GROUP BY 1) SELECT tile, n::BIGINT AS n, true AS split FROM t")
def chunked_write(spark: SparkSession, sf: str) -> DataFrame:
    """Files of at most 50 rows, their tile told from the path."""
    path = files.scratch_path(spark, "chunks")
    files.write_parquet(fx.images(spark, sf).select("id", geo.tile_of("long", "lat", 8).alias("tile")), path, "tile", rows_per_file=50)
    by_file = files.read_parquet(spark, path, file_name=True).groupBy("filename").agg(F.count("*").alias("rows"))
    return by_file.groupBy(files.tile_of_path(F.col("filename")).alias("tile")).agg(F.sum("rows").alias("n"), (F.max("rows") <= 50).alias("split"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, {_tile_name_sql('long', 'lat', 8)} AS tile FROM images")
def tile_from_path(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("file:/out/images_"), geo.tile_of("long", "lat", 8), F.lit(".parquet"))
    return fx.images(spark, sf).select("id", files.tile_of_path(path).alias("tile"))


@query("SELECT n_name, CASE WHEN contains(r_name, 'EUROPE') THEN 'Europe' WHEN contains(r_name, 'ASIA') THEN 'Asia' WHEN contains(r_name, 'AMERICA') THEN 'America' ELSE 'other' END AS class FROM nation JOIN region ON n_regionkey = r_regionkey")
def class_from_file_name(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.table(spark, sf, "nation").join(fx.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    path = F.concat(F.lit("/asia_data/roads_"), F.lower("r_name"), F.lit(".geojson"))
    return d.select("n_name", files.class_of_name(path, ["Europe", "Asia", "America"], "other").alias("class"))


def _z_order_sql(x: str, y: str) -> str:
    grid = {"c": f"least(greatest(floor(({x} + 180) / 360 * 65536), 0), 65535)::BIGINT", "r": f"least(greatest(floor(({y} + 90) / 180 * 65536), 0), 65535)::BIGINT"}
    return "(" + " + ".join(f"(({grid[v]} >> {k}) & 1) * {1 << 2 * k + n}" for k in range(16) for n, v in enumerate("cr")) + ")::BIGINT"


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, {_z_order_sql('long', 'lat')} AS code, true AS in_range FROM images")
def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    """Written in the order of a space-filling curve; no file's range of codes holds another's first code."""
    path = files.scratch_path(spark, "clustered")
    files.write_clustered(fx.images(spark, sf).select("id", geo.z_order("long", "lat").alias("code")), path, "code")
    d = files.read_parquet(spark, path, file_name=True)
    ranges = d.groupBy("filename").agg(F.min("code").alias("low"), F.max("code").alias("high"))
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    apart = ranges.withColumn("in_range", F.coalesce(before <= F.col("low"), F.lit(True))).select("filename", "in_range")
    return d.join(apart, "filename").select("id", "code", "in_range")


@query("SELECT n_nationkey, n_name, 'part-nation' AS kind FROM nation")
def scan_with_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """A scan by glob of several folders, with each row's file."""
    path = files.scratch_path(spark, "scan")
    files.write_parquet(fx.table(spark, sf, "nation").where("n_nationkey % 2 = 0"), f"{path}/a")
    files.write_parquet(fx.table(spark, sf, "nation").where("n_nationkey % 2 = 1"), f"{path}/b")
    d = files.read_parquet(spark, files.first_existing(spark, f"{path}/none/*", f"{path}/*"), glob="*.parquet", file_name=True)
    return d.select("n_nationkey", "n_name", F.when(F.contains("filename", F.lit("part-")), F.lit("part-nation")).alias("kind"))


@query("SELECT r_regionkey, r_name FROM region WHERE 1 = 1")
def scan_newer_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files written after a time; all that is older is not listed."""
    path = files.scratch_path(spark, "newer")
    files.write_parquet(fx.table(spark, sf, "region"), path)
    found = files.read_parquet(spark, path, newer_than="2000-01-01T00:00:00").select("r_regionkey", "r_name")
    return files.clean_names(found.toDF("\ufeffr_regionkey ", " r_name"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT id, 'http://img/' || id AS url, long, lat, id % 2 = 0 AS is_pano, timestamp::BIGINT AS timestamp FROM images WHERE id % 5 <> 0")
def api_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Answers of an image service: records without a place are dropped, repeated ones come once."""
    at = F.when(F.col("id") % 5 != 0, F.struct(F.array("long", "lat").alias("coordinates")))
    wrong = F.when(F.col("id") % 5 != 0, F.struct(F.array(F.lit(0.0), F.lit(0.0)).alias("coordinates")))
    record = F.struct(
        F.col("id").cast("string").alias("id"), F.col("sequence").cast("string").alias("sequence"), F.concat(F.lit("http://img/"), F.col("id")).alias("thumb_original_url"),
        F.when(F.col("id") % 3 == 0, at).alias("computed_geometry"), F.when(F.col("id") % 3 == 0, wrong).otherwise(at).alias("geometry"), F.col("timestamp").cast("bigint").alias("captured_at"), (F.col("id") % 2 == 0).alias("is_pano"),
    )
    answers = fx.images(spark, sf).groupBy("sequence").agg(F.collect_list(record).alias("data")).select(F.to_json(F.struct("data")).alias("json"))
    found = files.images_from_json(answers.unionByName(answers))
    return found.select("id", "url", "long", "lat", "is_pano", "timestamp")


@query(f"{with_('countries')} t AS (SELECT 1) SELECT country, x0, y0, x0 + 1 AS x1, y0 + 1 AS y1 FROM countries")
def geojson_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = files.scratch_path(spark, "geojson")
    lines = fx.countries(spark, sf).select("country", "geometry")
    files.write_geojson(lines, path)
    text = spark.read.text(path).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}")).alias("value"))
    text.coalesce(1).write.text(f"{path}-all")
    b = geo.bounds(F.col("geometry"))
    return files.read_geojson(spark, f"{path}-all", {"country": "string"}).select("country", b["xmin"].alias("x0"), b["ymin"].alias("y0"), b["xmax"].alias("x1"), b["ymax"].alias("y1"))


@query(f"{with_('images')} t AS (SELECT 1) SELECT sequence, count(*)::BIGINT AS n, max(long) AS east FROM images WHERE lat > 11 GROUP BY 1 HAVING count(*) > 2")
def view_sql(spark: SparkSession, sf: str) -> DataFrame:
    fx.images(spark, sf).createOrReplaceTempView("wayglint_images")
    return spark.sql("SELECT sequence, count(*) AS n, max(long) AS east FROM wayglint_images WHERE lat > 11 GROUP BY sequence HAVING count(*) > 2")


# ---- more of layers and shapes -----------------------------------------------------------------------------------


@query(f"{with_('images', 'countries')} t AS (SELECT 1) SELECT i.id, c.country FROM images i LEFT JOIN countries c ON i.long BETWEEN x0 AND x0 + 1 AND i.lat BETWEEN y0 AND y0 + 1 AND NOT (i.long > x0 + 0.25::DOUBLE AND i.long < x0 + 0.75::DOUBLE AND i.lat > y0 + 0.25::DOUBLE AND i.lat < y0 + 0.75::DOUBLE)")
def points_in_rings(spark: SparkSession, sf: str) -> DataFrame:
    """Polygons with a hole, whose edge belongs to them."""
    ring = lambda a, b: F.get(geo.box(F.col("x0") + a, F.col("y0") + a, F.col("x0") + b, F.col("y0") + b)["parts"], F.lit(0))
    c = fx.countries(spark, sf).withColumn("geometry", geo.geometry("POLYGON", F.array(ring(0.0, 1.0), ring(0.25, 0.75))))
    return layers.join_points(fx.images(spark, sf), c, ["country"]).select("id", "country")


@query(f"{with_('images', 'countries')} t AS (SELECT 1) SELECT i.id, c.country FROM images i LEFT JOIN countries c ON (i.long BETWEEN x0 AND x0 + 0.25::DOUBLE AND i.lat BETWEEN y0 AND y0 + 0.25::DOUBLE) OR (i.long BETWEEN x0 + 0.5::DOUBLE AND x0 + 0.75::DOUBLE AND i.lat BETWEEN y0 + 0.5::DOUBLE AND y0 + 0.75::DOUBLE)")
def points_in_multipolygons(spark: SparkSession, sf: str) -> DataFrame:
    ring = lambda a, b: F.get(geo.box(F.col("x0") + a, F.col("y0") + a, F.col("x0") + b, F.col("y0") + b)["parts"], F.lit(0))
    c = fx.countries(spark, sf).withColumn("geometry", geo.geometry("MULTIPOLYGON", F.array(ring(0.0, 0.25), ring(0.5, 0.75))))
    return layers.join_points(fx.images(spark, sf), c, ["country"]).select("id", "country")


@query(_ENRICH + """, second AS (SELECT urban_id AS centre_id, country, x0 + w / 4 AS x0, y0 + h / 4 AS y0, w / 2 AS w, h / 2 AS h FROM urban WHERE urban_id % 2 = 0)
SELECT iu.id, iu.urban_id, s.centre_id, (iu.urban_id IS NOT NULL OR s.centre_id IS NOT NULL)::INT AS urban FROM iu
LEFT JOIN second s ON iu.country = s.country AND iu.long BETWEEN s.x0 AND s.x0 + s.w AND iu.lat BETWEEN s.y0 AND s.y0 + s.h""")
def enrich_two_urban_layers(spark: SparkSession, sf: str) -> DataFrame:
    u = fx.urban(spark, sf)
    x, y = F.col("x0") + F.col("w") / 4, F.col("y0") + F.col("h") / 4
    centres = u.where("urban_id % 2 = 0").select(F.col("urban_id").alias("centre_id"), "country", geo.box(x, y, x + F.col("w") / 2, y + F.col("h") / 2).alias("geometry"))
    d = pipelines.enrich(fx.images(spark, sf), fx.countries(spark, sf), {"urban_id": u, "centre_id": centres}, Settings())
    return d.select("id", "urban_id", "centre_id", "urban")


@query(f"""{with_('countries', 'urban')} j AS (SELECT u.urban_id, c.country, c.continent, u.x0, u.y0, u.w, u.h FROM urban u LEFT JOIN countries c ON u.x0 <= c.x0 + 1 AND u.x0 + u.w >= c.x0 AND u.y0 <= c.y0 + 1 AND u.y0 + u.h >= c.y0)
SELECT urban_id, country, continent, ((xb - xa + 1) * (yb - ya + 1))::BIGINT AS n FROM (SELECT urban_id, country, continent, {_tile_sql('x0', 'y0', 8)[0]} AS xa, {_tile_sql('x0 + w', 'y0', 8)[0]} AS xb, {_tile_sql('x0', 'y0 + h', 8)[1]} AS ya, {_tile_sql('x0', 'y0', 8)[1]} AS yb FROM j)""")
def prepare_urban_layer(spark: SparkSession, sf: str) -> DataFrame:
    d = pipelines.prepare_urban(fx.urban(spark, sf).select("urban_id", "geometry"), fx.countries(spark, sf), "urban_id", 8)
    return d.select("urban_id", "country", "continent", F.size("tiles").cast("bigint").alias("n"))


@query(f"{with_('urban')} c AS ({stats_sql.compile_sql('urban_id', 'urban_id', False, True)}) SELECT u.urban_id, u.country, c.number_of_images, c.count_osm_ids, c.osm_coverage, c.number_of_z14_tiles FROM urban u LEFT JOIN c ON u.urban_id::VARCHAR = c.urban_id")
def compile_on_urban_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Every urban area with its compiled statistics, null where there are none."""
    stats = compiling.compile_stats(_partials(spark, sf, "urban_id"), "urban_id", exact_ids=True).select("urban_id", "number_of_images", "count_osm_ids", "osm_coverage", "number_of_z14_tiles")
    return compiling.on_layer(fx.urban(spark, sf).select("urban_id", "country"), stats, "urban_id")


@query("SELECT r_regionkey, r_name AS osm_r_name_2, r_name AS pred_r_name FROM region")
def prefixed_columns(spark: SparkSession, sf: str) -> DataFrame:
    r = fx.table(spark, sf, "region").select("r_regionkey", "r_name")
    return m.prefixed(r, "osm_", "_2", keep=["r_regionkey"]).join(m.prefixed(r, "pred_", keep=["r_regionkey"]), "r_regionkey")


@query(f"{with_('countries')} t AS (SELECT 1) SELECT country, 5::BIGINT AS vertices, x0 AS x, y0 AS y, x0 + 1 AS x2, y0 + 1 AS y2 FROM countries")
def boxes_to_polygons(spark: SparkSession, sf: str) -> DataFrame:
    ring = F.get(geo.box("x0", "y0", F.col("x0") + 1, F.col("y0") + 1)["parts"], F.lit(0))
    at = lambda i, c: F.get(ring, F.lit(i))[c]
    return fx.countries(spark, sf).select("country", F.size(ring).cast("bigint").alias("vertices"), at(0, "x").alias("x"), at(0, "y").alias("y"), at(2, "x").alias("x2"), at(2, "y").alias("y2"))


@query(f"""{with_('images')} t AS (SELECT a.x::INT AS x, b.y::INT AS y FROM (SELECT unnest(range(127, 136)) AS x) a, (SELECT unnest(range(108, 122)) AS y) b)
SELECT concat_ws('-', x, y, 8) AS tile FROM t WHERE x BETWEEN {_tile_sql('0.5', '10.5', 8)[0]} AND {_tile_sql('6.5', '12.5', 8)[0]} AND y BETWEEN {_tile_sql('0.5', '12.5', 8)[1]} AND {_tile_sql('0.5', '10.5', 8)[1]}""")
def tile_table(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.tile_table(spark, (0.5, 10.5, 6.5, 12.5), 8).select("tile")


@query()
def thin_by_shape(spark: SparkSession, sf: str) -> DataFrame:
    return thinning.thin_by_shape(fx.images(spark, sf), 2000.0).select("id", "sequence")
