import math

import pytest
from pyspark.sql import functions as F

from wayglint.functions import geo


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def poly(*rings):
    return geo.geometry("POLYGON", F.array(*[F.array(*[geo.vertex(float(x), float(y)) for x, y in r]) for r in rings]))


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]


def test_tiles(spark):
    assert one(spark, geo.tile_of(0.0, 0.0, 1)) == "1-1-1"
    assert one(spark, geo.tile_of(-180.0, 89.0, 8)) == "0-0-8"
    assert one(spark, geo.tile_of(180.0, -89.0, 8)) == "255-255-8"
    assert one(spark, geo.tile_of(13.4, 52.5, 8)) == "137-83-8"
    assert one(spark, geo.tile_x(F.lit(None).cast("double"), 8)) is None
    b = one(spark, geo.tile_bounds(F.lit("0-0-0")))
    assert (b.xmin, b.xmax) == (-180, 180) and math.isclose(b.ymax, 85.0511287798, abs_tol=1e-9)


def test_cover_over_the_antimeridian(spark):
    tiles = one(spark, geo.tile_cover(179.0, 0.5, -179.0, 1.0, 8))
    assert sorted(tiles) == ["0-127-8", "255-127-8"]
    assert len(one(spark, geo.tile_cover(0.0, 0.1, 3.0, 3.0, 8))) == 3 * 3


def test_haversine(spark):
    degree = math.radians(1) * 6_371_008
    for f in (geo.haversine, geo.haversine_atan):
        assert math.isclose(one(spark, f(0.0, 0.0, 1.0, 0.0)), degree, rel_tol=1e-12)
        assert one(spark, f(F.lit(None).cast("double"), 0.0, 1.0, 0.0)) is None
    path = F.array(*[geo.vertex(float(i), 0.0) for i in range(3)])
    assert math.isclose(one(spark, geo.path_length(path)), 2 * degree, abs_tol=1e-3)
    assert one(spark, geo.path_length(F.slice(path, 1, 1))) == 0


@pytest.mark.parametrize(("p", "inside"), [((2, 2), False), ((0.5, 2), True), ((0, 2), True), ((4, 4), True), ((1, 2), True), ((5, 2), False), ((-1, 0), False), ((2, 0.5), True), ((4.5, 4), False)])
def test_point_in_polygon_with_a_hole(spark, p, inside):
    assert one(spark, geo.point_in_polygon(geo.vertex(float(p[0]), float(p[1])), poly(SQUARE, HOLE))) is inside


def test_shapes_meet(spark):
    line = lambda *v: geo.line(F.array(*[geo.vertex(float(x), float(y)) for x, y in v]))
    sq = poly(SQUARE)
    for g, meets in ((line((-1, 2), (5, 2)), True), (line((1, 1), (2, 2)), True), (line((-1, 0), (-1, 5)), False), (line((-2, 4), (0, 4)), True), (line((5, 0), (5, 5), (4, 2)), True)):
        assert one(spark, geo.intersects(g, sq)) is meets
    for g, meets in ((poly(HOLE), True), (poly([(x + 10, y) for x, y in SQUARE]), False), (poly([(x * 9 - 10, y * 9 - 10) for x, y in SQUARE]), True), (poly([(x + 4, y) for x, y in SQUARE]), True)):
        assert one(spark, geo.intersects(g, sq)) is meets


def test_nearest_on_line(spark):
    zig = geo.line(F.array(geo.vertex(0.0, 0.0), geo.vertex(2.0, 0.0), geo.vertex(2.0, 0.0), geo.vertex(2.0, 2.0)))
    q = one(spark, geo.nearest_on_line(geo.vertex(1.5, 1.0), zig))
    assert (q.x, q.y) == (2.0, 1.0)


def test_codecs(spark):
    texts = ["POINT (1.5 -2)", "LINESTRING (0 0, 1 1, 2 0)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "CIRCLE (1 2)", None]
    d = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("g", geo.from_wkt(F.col("t")))
    rows = d.select("t", "g", geo.to_wkt(F.col("g")).alias("w"), geo.from_wkb(geo.to_wkb("g")).alias("b")).collect()
    assert [r.w and r.w.replace(".0", "") for r in rows] == [*texts[:5], None, None]
    assert all(r.g == r.b or (r.g is None and r.b.kind is None) for r in rows)
    assert len(rows[4].g.parts) == 2 and len(rows[2].g.parts) == 2


def test_wkb_of_other_makers():
    import struct

    big = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    z = struct.pack("<BIddd", 1, 1001, 3.0, 4.0, 5.0)
    ewkb = struct.pack("<BIIdd", 1, 0x20000001, 4326, 3.0, 4.0)
    for data in (big, z, ewkb):
        assert geo.decode_wkb(data)[:2] == ("POINT", [[{"x": 3.0, "y": 4.0}]])


def test_subdivide_and_padding(spark):
    cells = one(spark, geo.subdivide(0.0, 0.0, 1.0, 1.0, 5))
    assert len(cells) == 9 and cells[0].xmax == 0.33333
    dx, dy = geo.pad_degrees(60.0, 50.0)
    assert math.isclose(one(spark, dy), math.degrees(50 / 6_371_008)) and one(spark, dx) > 1.99 * math.degrees(50 / 6_371_008)
