"""What odd and larger tables showed: queries against their SQL on rows made for the case."""

import time

import duckdb
import pytest
from pyspark.sql import functions as F

from wayglint.functions import geo
from wayglint.operators import layers
from wayglint.plans import queries

TABLES = "region nation customer supplier part orders lineitem events".split()
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def tables(tmp_path):
    """Writes the small tables, some of them replaced by a SELECT over themselves, and gives their folder."""

    def write(**replaced):
        con = duckdb.connect()
        for t in TABLES:
            select = replaced.get(t, "SELECT * FROM {0}").format(f"read_parquet('{SMALL}/{t}.parquet')")
            con.execute(f"COPY ({select}) TO '{tmp_path}/{t}.parquet'")
        return str(tmp_path)

    return write


@pytest.fixture
def compare(spark, tables):
    def run(name, **replaced):
        folder, con = tables(**replaced), duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
        got = queries.QUERIES[name](spark, folder)
        columns = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
        rows = [tuple(r) for r in got.select(*columns).collect()]
        assert sorted(map(repr, rows)) == sorted(map(repr, want))
        return rows

    return run


def test_trace_lengths_are_rounded_once(compare):
    """These two images lie 3847.49987 m apart, which is .5 to three decimals."""
    lines = "SELECT l.* REPLACE (o AS l_orderkey, 2 AS l_partkey, 1.0::DOUBLE AS l_quantity) FROM (SELECT * FROM {0} LIMIT 1) l, (VALUES (0), (239485)) v(o)"
    assert [r[0] for r in compare("trace_length", lineitem=lines)] == [3847]


#: A place and a road that many share: the road's box holds the place, which is 367 m from the road.
HEAP = {
    "events": "SELECT t.* REPLACE (20 + i * 8633 AS event_id, 45 AS user_id) FROM (SELECT * FROM {0} LIMIT 1) t, range(8000) r(i)",
    "part": "SELECT t.* REPLACE (45 + i * 2250 AS p_partkey) FROM (SELECT * FROM {0} LIMIT 1) t, range(8000) r(i)",
}


@pytest.mark.parametrize("name", ["shortest_point_segment", "band_join", "match_candidates", "match_within_30m"])
def test_images_of_one_place_and_roads_of_one_shape_are_matched_as_one(spark, tables, name):
    began = time.monotonic()
    got = queries.QUERIES[name](spark, tables(**HEAP))
    sums = {"shortest_point_segment": F.countDistinct("x", "y"), "match_candidates": F.sum("n")}
    n, total = got.agg(F.count("*"), sums.get(name, F.countDistinct(F.col("osm_id") % 2250))).first()
    want = {"match_candidates": (8000, 8000 * 8000), "match_within_30m": (0, 0)}
    assert (n, total) == want.get(name, (8000 * 8000, 1))
    assert time.monotonic() - began < 45


#: Images of one place in many equal urban areas.
CROWD = {
    "events": "SELECT t.* REPLACE (i * 8633 AS event_id, i AS user_id) FROM (SELECT * FROM {0} LIMIT 1) t, (SELECT unnest(range(0, 250 * 6000, 250)) AS i)",
    "supplier": "SELECT t.* REPLACE (i * 140 AS s_suppkey, 0 AS s_nationkey) FROM (SELECT * FROM {0} LIMIT 1) t, range(6000) r(i)",
}


@pytest.mark.parametrize("name, rows", [("enrich_urban", 6000 * 6000), ("enrich_two_urban_layers", 6000 * 6000), ("thin_combined", 6000), ("thin_urban", 6000), ("thin_rural", 0)])
def test_equal_urban_areas_are_tested_as_one(spark, tables, name, rows):
    began = time.monotonic()
    got = queries.QUERIES[name](spark, tables(**CROWD))
    c = "id" if name.startswith("thin") else "urban_id"
    assert got.agg(F.count("*"), F.count(c)).first() == (rows, rows)
    assert time.monotonic() - began < 45


@pytest.mark.parametrize("tiles", [100_000, 0])
def test_two_urban_layers_equal_their_sql_whether_broadcast_or_not(compare, monkeypatch, tiles):
    monkeypatch.setattr(layers, "BROADCAST_TILES", tiles)
    areas = "SELECT t.* REPLACE (s_suppkey + i * 10 AS s_suppkey, 0 AS s_nationkey) FROM {0} t, range(10) r(i)"
    assert len(compare("enrich_two_urban_layers", supplier=areas)) > 1000


def test_rows_of_a_crowded_place_are_spread_over_tasks(spark, tables):
    got = queries.QUERIES["enrich_two_urban_layers"](spark, tables(**CROWD))
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 6000 * 6000 and max(tasks) < sum(tasks) / 8


def test_polygons_that_are_no_boxes(spark):
    """Lines there and back around three corners, and a notched box, pass through corners of their bounding boxes."""
    shapes = {"box": "0 0, 2 0, 2 2, 0 2, 0 0", "back": "0 0, 2 0, 2 2, 2 0, 0 0", "bow": "0 0, 2 2, 2 0, 0 2, 0 0", "notched": "0 0, 2 0, 2 2, 1 1, 0 2, 0 0"}
    layer = spark.createDataFrame([(n, f"POLYGON (({t}))") for n, t in shapes.items()], "name string, wkt string").withColumn("geometry", geo.from_wkt(F.col("wkt")))
    assert [r.name for r in layer.where(geo.is_box(F.col("geometry"))).collect()] == ["box"]
    points = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.5, 1.0), (3, 1.0, 1.5), (4, 9.0, 9.0)], "id int, long double, lat double")
    got = {(r.id, r.name) for r in layers.join_points(points, layer.union(layer), ["name"]).collect()}
    assert got == {(1, "box"), (1, "back"), (1, "notched"), (2, "box"), (2, "bow"), (2, "notched"), (3, "box"), (4, None)}
    flags = {r.id: r.held for r in layers.flag_points(points, layer.where("name = 'back'"), "held").collect()}
    assert flags == {1: 1, 2: 0, 3: 0, 4: 0}
