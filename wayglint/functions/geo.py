"""Geometry as native columns, in lon/lat degrees.

A geometry is ``struct<kind string, parts array<array<struct<x double, y double>>>>``: a point has one part of one
vertex, a line one part or more, a polygon one closed part for each ring, holes included.
"""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from wayglint.config import EARTH_RADIUS_M

GEOMETRY = "struct<kind:string,parts:array<array<struct<x:double,y:double>>>>"
MAX_LATITUDE = 85.051129


def _c(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def _clamp(x: Column, low, high) -> Column:
    """x within bounds; null stays null, which least and greatest would skip."""
    return F.when(x < low, F.lit(low)).when(x > high, F.lit(high)).otherwise(x)


def vertex(x: Column | str | float, y: Column | str | float) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


def geometry(kind: str, parts: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))


def point(x, y) -> Column:
    return geometry("POINT", F.array(F.array(vertex(x, y))))


def line(vertices: Column) -> Column:
    return geometry("LINESTRING", F.array(vertices))


def box(x0, y0, x1, y1) -> Column:
    """The closed rectangle as a polygon."""
    return geometry("POLYGON", F.array(F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))))


def start_point(g: Column) -> Column:
    return F.get(F.get(g["parts"], F.lit(0)), F.lit(0))


def end_point(g: Column) -> Column:
    return F.element_at(F.element_at(g["parts"], -1), -1)


def bounds(g: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>`` of all vertices."""
    vs = F.flatten(g["parts"])
    xs, ys = F.transform(vs, lambda v: v["x"]), F.transform(vs, lambda v: v["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


# ---- tiles -------------------------------------------------------------------------------------------------------


def tile_x(lon, zoom: int) -> Column:
    n = 1 << zoom
    return _clamp(F.floor((_c(lon) + 180.0) / 360.0 * n), 0, n - 1).cast("int")


def tile_y(lat, zoom: int) -> Column:
    """Web-Mercator row, from the north; latitudes beyond the projection's are clipped to it."""
    n = 1 << zoom
    s = F.sin(F.radians(_clamp(_c(lat), -MAX_LATITUDE, MAX_LATITUDE)))
    return _clamp(F.floor((0.5 - F.ln((1 + s) / (1 - s)) / (4 * math.pi)) * n), 0, n - 1).cast("int")


def tile_name(x: Column, y: Column, zoom: int | Column) -> Column:
    """The tile's id, ``x-y-z``."""
    return F.concat_ws("-", x, y, F.lit(zoom) if isinstance(zoom, int) else zoom)


def tile_of(lon, lat, zoom: int) -> Column:
    return tile_name(tile_x(lon, zoom), tile_y(lat, zoom), zoom)


def tile_bounds(name: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>`` in degrees of a tile id."""
    p = F.transform(F.split(name, "-"), lambda t: t.cast("double"))
    n = F.pow(F.lit(2.0), F.get(p, F.lit(2)))
    lon = lambda x: x / n * 360.0 - 180.0
    lat = lambda y: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / n))))
    x, y = F.get(p, F.lit(0)), F.get(p, F.lit(1))
    return F.struct(lon(x).alias("xmin"), lat(y + 1).alias("ymin"), lon(x + 1).alias("xmax"), lat(y).alias("ymax"))


def tile_polygon(name: Column) -> Column:
    b = tile_bounds(name)
    return box(b["xmin"], b["ymin"], b["xmax"], b["ymax"])


def tile_cover(xmin, ymin, xmax, ymax, zoom: int) -> Column:
    """Ids of all tiles that a box touches; a box with xmin > xmax goes over the antimeridian."""
    rows = F.sequence(tile_y(ymax, zoom), tile_y(ymin, zoom))
    span = lambda a, b: F.flatten(F.transform(F.sequence(tile_x(a, zoom), tile_x(b, zoom)), lambda x: F.transform(rows, lambda y: tile_name(x, y, zoom))))
    whole, east, west = span(xmin, xmax), span(xmin, 180.0), span(-180.0, xmax)
    return F.when(_c(xmin) <= _c(xmax), whole).otherwise(F.array_distinct(F.concat(east, west)))


def subdivide(xmin, ymin, xmax, ymax, n: int) -> Column:
    """The boxes, to five decimals, of a square grid of at least ``n`` cells over a box."""
    k = math.ceil(math.sqrt(n))
    at = lambda a, b, i: F.round(_c(a) + (_c(b) - _c(a)) * i / k, 5)
    cell = lambda i, j: F.struct(at(xmin, xmax, i).alias("xmin"), at(ymin, ymax, j).alias("ymin"), at(xmin, xmax, i + 1).alias("xmax"), at(ymin, ymax, j + 1).alias("ymax"))
    steps = F.sequence(F.lit(0), F.lit(k - 1))
    return F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: cell(i, j))))


# ---- distances ---------------------------------------------------------------------------------------------------


def _half_chord(x0, y0, x1, y1) -> Column:
    a, b = F.radians(_c(y0)), F.radians(_c(y1))
    return F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(_c(x1) - _c(x0)) / 2), F.lit(2.0))


def haversine(x0, y0, x1, y1, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle metres, by the arcsine."""
    return 2 * radius * F.asin(_clamp(F.sqrt(_half_chord(x0, y0, x1, y1)), 0.0, 1.0))


def haversine_atan(x0, y0, x1, y1, radius: float = EARTH_RADIUS_M) -> Column:
    """The same by atan2, which is steadier near antipodes."""
    h = _clamp(_half_chord(x0, y0, x1, y1), 0.0, 1.0)
    return 2 * radius * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def path_length(vertices: Column, digits: int | None = 3) -> Column:
    """Metres along the vertices, to so many decimals (None: as they are); 0 for fewer than two."""
    pairs = F.zip_with(F.slice(vertices, F.lit(1), F.greatest(F.size(vertices) - 1, F.lit(0))), F.slice(vertices, F.lit(2), F.greatest(F.size(vertices) - 1, F.lit(0))), lambda a, b: haversine(a["x"], a["y"], b["x"], b["y"]))
    metres = F.aggregate(pairs, F.lit(0.0), lambda s, d: s + d)
    return metres if digits is None else F.round(metres, digits)


def pad_degrees(lat, metres: float, zero: bool = False) -> tuple[Column, Column]:
    """Degrees of longitude and latitude that hold ``metres`` around a latitude; ``zero`` keeps the bare box."""
    if zero:
        return F.lit(0.0), F.lit(0.0)
    up = math.degrees(metres / EARTH_RADIUS_M)
    worst = F.cos(F.radians(F.least(F.abs(_c(lat)) + up, F.lit(89.9))))
    return F.lit(up) / worst, F.lit(up)


def nearest_on_segment(p: Column, a: Column, b: Column) -> Column:
    """The vertex of the segment that is planar-nearest to ``p``."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.coalesce(F.try_divide((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = _clamp(t, 0.0, 1.0)
    return vertex(a["x"] + t * dx, a["y"] + t * dy)


def edges(part: Column) -> Column:
    """``array<struct<a, b>>`` of neighbouring vertices; a lone vertex is an edge to itself."""
    n = F.greatest(F.size(part) - 1, F.lit(1))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(part, i).alias("a"), F.coalesce(F.get(part, i + 1), F.get(part, i)).alias("b")))


def all_edges(g: Column) -> Column:
    return F.flatten(F.transform(g["parts"], edges))


def nearest_on_line(p: Column, g: Column) -> Column:
    """The vertex of the geometry's edges that is planar-nearest to ``p``, the first of equally near ones."""
    def scored(e: Column) -> Column:
        return F.transform(F.array(nearest_on_segment(p, e["a"], e["b"])), lambda q: F.struct((F.pow(q["x"] - p["x"], F.lit(2.0)) + F.pow(q["y"] - p["y"], F.lit(2.0))).alias("d"), q.alias("q")))[0]

    first = F.aggregate(F.transform(all_edges(g), scored), F.struct(F.lit(None).cast("double").alias("d"), F.lit(None).cast("struct<x:double,y:double>").alias("q")), lambda s, e: F.when(s["d"].isNull() | (e["d"] < s["d"]), e).otherwise(s))
    return first["q"]


def z_order(x, y, bits: int = 16) -> Column:
    """The Morton code of a place: the bits of its columns and rows in a grid of 2 ** ``bits`` each way, in turn.

    Places that are close mostly have close codes, so files that each hold a range of codes can be skipped by place.
    """
    last = (1 << bits) - 1
    column = _clamp(F.floor((_c(x) + 180) / 360 * (1 << bits)), 0, last).cast("bigint")
    row = _clamp(F.floor((_c(y) + 90) / 180 * (1 << bits)), 0, last).cast("bigint")
    code = F.lit(0).cast("bigint")
    for k in range(bits):
        for n, value in enumerate((column, row)):
            code = code + F.shiftleft(F.shiftright(value, k).bitwiseAND(F.lit(1)), 2 * k + n)
    return code


# ---- predicates --------------------------------------------------------------------------------------------------


def _side(a: Column, b: Column, p: Column) -> Column:
    return (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])


def _within(a: Column, b: Column, p: Column) -> Column:
    return p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def point_in_polygon(p: Column, g: Column) -> Column:
    """Inside by the even-odd rule over all rings, or on an edge."""
    on_edge = lambda e: (_side(e["a"], e["b"], p) == 0) & _within(e["a"], e["b"], p)
    straddles = lambda e: (e["a"]["y"] > p["y"]) != (e["b"]["y"] > p["y"])
    to_right = lambda e: (_side(e["a"], e["b"], p) > 0) == (e["b"]["y"] > e["a"]["y"])
    es = all_edges(g)
    return F.exists(es, on_edge) | (F.size(F.filter(es, lambda e: straddles(e) & to_right(e))) % 2 == 1)


def is_box(g: Column) -> Column:
    """Whether a polygon is one ring around its whole bounding box, so that the box's test is the polygon's."""
    ring, b = F.get(g["parts"], F.lit(0)), bounds(g)
    corner = lambda v: v["x"].isin(b["xmin"], b["xmax"]) & v["y"].isin(b["ymin"], b["ymax"])
    straight = lambda e: (e["a"]["x"] == e["b"]["x"]) | (e["a"]["y"] == e["b"]["y"])
    closed = (F.size(ring) == 5) & (F.size(F.array_distinct(ring)) == 4) & (F.get(ring, F.lit(0)) == F.get(ring, F.lit(4)))
    return F.coalesce((F.size(g["parts"]) == 1) & closed & F.forall(ring, corner) & F.forall(edges(ring), straight), F.lit(False))


def segments_meet(s: Column, e: Column) -> Column:
    """Whether two edges share a vertex of the plane, touching included."""
    d1, d2 = _side(s["a"], s["b"], e["a"]), _side(s["a"], s["b"], e["b"])
    d3, d4 = _side(e["a"], e["b"], s["a"]), _side(e["a"], e["b"], s["b"])
    cross = (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)
    touch = lambda d, a, b, p: (d == 0) & _within(a, b, p)
    return cross | touch(d1, s["a"], s["b"], e["a"]) | touch(d2, s["a"], s["b"], e["b"]) | touch(d3, e["a"], e["b"], s["a"]) | touch(d4, e["a"], e["b"], s["b"])


def _edges_meet(a: Column, b: Column) -> Column:
    others = all_edges(b)
    return F.exists(all_edges(a), lambda s: F.exists(others, lambda e: segments_meet(s, e)))


def line_meets_polygon(line_: Column, g: Column) -> Column:
    return point_in_polygon(start_point(line_), g) | _edges_meet(line_, g)


def polygons_meet(a: Column, b: Column) -> Column:
    return point_in_polygon(start_point(a), b) | point_in_polygon(start_point(b), a) | _edges_meet(a, b)


def intersects(a: Column, b: Column) -> Column:
    """Any of points, lines and polygons on the left against a polygon on the right."""
    return F.when(a["kind"] == "POINT", point_in_polygon(start_point(a), b)).when(a["kind"].endswith("LINESTRING"), line_meets_polygon(a, b)).otherwise(polygons_meet(a, b))


# ---- codecs ------------------------------------------------------------------------------------------------------


def from_wkt(text: Column) -> Column:
    """Points, lines and polygons, and multi forms of the latter two, from text; null where it is none of them."""
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    body = F.regexp_replace(F.regexp_replace(text, r"^\s*[A-Za-z]+\s*(?:[Zz]\s*)?", ""), r"[()]*\)\s*\(+|\)\s*,\s*\(+", "|")
    pair = lambda v: F.transform(F.array(F.split(F.trim(v), r"\s+")), lambda t: vertex(F.get(t, F.lit(0)).cast("double"), F.get(t, F.lit(1)).cast("double")))[0]
    parts = F.transform(F.split(F.regexp_replace(body, r"\)+\s*,\s*\(+", "|"), r"\|"), lambda part: F.transform(F.split(F.regexp_replace(part, "[()]", ""), ","), pair))
    return F.when(kind.isin("POINT", "LINESTRING", "POLYGON", "MULTILINESTRING", "MULTIPOLYGON"), F.struct(kind.alias("kind"), parts.alias("parts")))


def to_wkt(g: Column) -> Column:
    vs = lambda part: F.array_join(F.transform(part, lambda v: F.concat_ws(" ", v["x"], v["y"])), ", ")
    listed = F.array_join(F.transform(g["parts"], lambda part: F.concat(F.lit("("), vs(part), F.lit(")"))), ", ")
    many = F.when(g["kind"] == "MULTIPOLYGON", F.array_join(F.transform(g["parts"], lambda part: F.concat(F.lit("(("), vs(part), F.lit("))"))), ", ")).otherwise(listed)
    flat = F.concat(g["kind"], F.lit(" "), listed)
    return F.when(g["kind"].isin("POINT", "LINESTRING"), flat).otherwise(F.concat(g["kind"], F.lit(" ("), many, F.lit(")")))


_CODES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTILINESTRING": 5, "MULTIPOLYGON": 6}


def encode_wkb(kind: str, parts: list) -> bytes:
    """Little-endian well-known binary of one geometry."""
    head = struct.pack("<BI", 1, _CODES[kind])
    pack = lambda vs: b"".join(struct.pack("<dd", v["x"], v["y"]) for v in vs)
    if kind == "POINT":
        return head + pack(parts[0])
    if kind == "LINESTRING":
        return head + struct.pack("<I", len(parts[0])) + pack(parts[0])
    if kind == "POLYGON":
        return head + struct.pack("<I", len(parts)) + b"".join(struct.pack("<I", len(p)) + pack(p) for p in parts)
    inner = "LINESTRING" if kind == "MULTILINESTRING" else "POLYGON"
    return head + struct.pack("<I", len(parts)) + b"".join(encode_wkb(inner, [p]) for p in parts)


def decode_wkb(data: bytes, at: int = 0) -> tuple[str, list, int]:
    """Kind, parts and end of one geometry of either byte order; Z and M coordinates are dropped."""
    o = "<" if data[at] else ">"
    (code,) = struct.unpack_from(o + "I", data, at + 1)
    at += 5
    if code & 0x20000000:
        at += 4
    width = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    width += (code // 1000 + 1) // 2 if code >= 1000 else 0
    kind = next(k for k, v in _CODES.items() if v == code % 1000)

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(o + "I", data, at)
        at += 4
        return n

    def vertices(n: int) -> list:
        nonlocal at
        flat = struct.unpack_from(f"{o}{n * width}d", data, at)
        at += 8 * n * width
        return [{"x": flat[i * width], "y": flat[i * width + 1]} for i in range(n)]

    if kind == "POINT":
        return kind, [vertices(1)], at
    if kind == "LINESTRING":
        return kind, [vertices(count())], at
    if kind == "POLYGON":
        return kind, [vertices(count()) for _ in range(count())], at
    parts = []
    for _ in range(count()):
        _, more, at = decode_wkb(data, at)
        parts += more
    return kind, parts, at


def _to_wkb(g: pd.DataFrame) -> pd.Series:
    return pd.Series([encode_wkb(k, p) if k is not None else None for k, p in zip(g["kind"], g["parts"], strict=True)])


def _from_wkb(data: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if d is None else decode_wkb(bytes(d))[:2] for d in data], columns=["kind", "parts"])


def to_wkb(g: Column | str) -> Column:
    """Well-known binary; bytes are beyond native columns, so batches go through Arrow."""
    return F.pandas_udf(_to_wkb, "binary")(_c(g))


def from_wkb(data: Column | str) -> Column:
    return F.pandas_udf(_from_wkb, GEOMETRY)(_c(data))
