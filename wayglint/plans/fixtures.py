"""Relations of the domain's shape over the plain tables, for queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayglint.functions import geo

_CLASS = "CASE p_size % 9 WHEN 0 THEN 'motorway' WHEN 1 THEN 'motorway_link' WHEN 2 THEN 'trunk' WHEN 3 THEN 'primary' WHEN 4 THEN 'secondary_link' WHEN 5 THEN 'tertiary' WHEN 6 THEN 'unclassified' WHEN 7 THEN 'residential' ELSE 'path' END"

#: Column expressions that Spark and DuckDB both read; {ms} is the engine's function for epoch milliseconds.
IMAGES = {
    "id": "event_id", "sequence": "user_id", "timestamp": "{ms_ts}",
    "long": "(user_id % 250) * 2e-2 + (event_id % 97) * 3e-4", "lat": "10 + (user_id % 125) * 4e-2 + (event_id % 89) * 3e-4",
}
ROADS = {
    "osm_id": "p_partkey", "x1": "(p_partkey % 250) * 2e-2", "y1": "10 + (p_partkey % 125) * 4e-2", "x2": "(p_partkey % 250) * 2e-2 + 3e-2",
    "y2": "10 + (p_partkey % 125) * 4e-2 + (p_partkey % 90) * 3e-4", "length": "round(p_retailprice * 100)", "osm_tags_highway": _CLASS, "latest": "p_size <> 13", "visible": "p_size <> 17",
}
COUNTRIES = {"country": "n_name", "continent": "r_name", "x0": "CAST(n_nationkey % 5 AS DOUBLE)", "y0": "10.0 + CAST(floor(n_nationkey / 5) AS DOUBLE)"}
URBAN = {
    "urban_id": "s_suppkey", "country": "n_name", "x0": "n_nationkey % 5 + (s_suppkey % 10) * 8e-2",
    "y0": "10 + floor(n_nationkey / 5) + (s_suppkey % 7) * 1e-1", "w": "2e-1", "h": "3e-1",
}
MATCHES = {"id": "l_orderkey", "osm_id": "l_partkey", "distance_meter": "l_quantity", "changeset_timestamp": "{ms_ship}", "osm_tags_highway": _CLASS, "osm_tags_surface": "l_returnflag"}
STAT_IMAGES = {
    "id": "l_orderkey", "osm_id": "l_partkey", "sequence": "l_orderkey % 211", "z8_tiles": "concat('8-', l_suppkey % 23)", "z14_tiles": "concat('14-', l_suppkey % 23, '-', l_partkey % 5)",
    "urban_id": "CASE WHEN l_suppkey % 4 = 0 THEN l_suppkey % 12 END", "country": "concat('C', l_suppkey % 5)", "continent": "concat('K', l_suppkey % 2)", "world": "1",
    "pred_label": "CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linestatus = 'O' THEN 1 ELSE 0 END", "pred_score": "1 - 2 * l_discount", "zs_pred_score": "(l_tax - 4e-2) * 40",
    "no_road_image_filter": "CASE WHEN l_linenumber = 7 THEN 0 ELSE 1 END", "distance_meter": "l_quantity", "timestamp": "{ms_ship}", "urban": "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END",
    "osm_tags_highway": _CLASS, "long": "(l_partkey % 250) * 2e-2 + (l_orderkey % 97) * 3e-4", "lat": "10 + (l_partkey % 125) * 4e-2 + (l_orderkey % 89) * 3e-4", "length": "round(l_extendedprice)", "road_length": "round(p_retailprice * 100)",
}


def _sql(columns: dict[str, str], source: str) -> str:
    ms = {"ms_ts": "epoch_us(ts) // 1000", "ms_ship": "epoch_us(l_shipdate) // 1000"}
    return "SELECT " + ", ".join(f"{e.format(**ms)} AS {n}" for n, e in columns.items()) + f" FROM {source}"


#: Table expressions for DuckDB.
SQL = {
    "images": _sql(IMAGES, "events"),
    "roads": _sql(ROADS, "part"),
    "countries": _sql(COUNTRIES, "nation JOIN region ON n_regionkey = r_regionkey"),
    "urban": _sql(URBAN, "supplier JOIN nation ON s_nationkey = n_nationkey"),
    "matches": _sql(MATCHES, "lineitem JOIN part ON l_partkey = p_partkey"),
    "stat_images": _sql(STAT_IMAGES, "lineitem JOIN part ON l_partkey = p_partkey"),
}


def with_(*names: str) -> str:
    """``WITH`` the named relations, a comma after each."""
    return "WITH " + "".join(f"{n} AS ({SQL[n]}),\n" for n in names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    ms = {"ms_ts": "unix_millis(cast(ts as timestamp))", "ms_ship": "unix_millis(cast(l_shipdate as timestamp))"}
    return df.selectExpr(*[f"{e.format(**ms)} AS `{n}`" for n, e in columns.items()])


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), IMAGES)


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _select(table(spark, sf_dir, "part"), ROADS)
    return r.withColumn("geometry", geo.line(F.array(geo.vertex("x1", "y1"), geo.vertex("x2", "y2"))))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _select(table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")), COUNTRIES)
    return c.withColumn("geometry", geo.box("x0", "y0", F.col("x0") + 1, F.col("y0") + 1))


def urban(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _select(table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")), URBAN)
    return u.withColumn("geometry", geo.box("x0", "y0", F.col("x0") + F.col("w"), F.col("y0") + F.col("h")))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_lines(spark, sf_dir), MATCHES)


def stat_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_lines(spark, sf_dir), STAT_IMAGES)


def flat(df: DataFrame) -> DataFrame:
    """Lists as comma-joined text, so that results compare as plain values."""
    return df.select(*[F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
