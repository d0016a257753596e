"""Joins of points, lines and polygons with polygon layers, over grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayglint.functions import geo

#: Tiles of areas within cities, which are small and lie close.
URBAN_ZOOM = 11


#: Rows that a list holds at most; what is beyond goes into further lists.
LISTED = 1000

#: A layer is broadcast up to this many tiles of different polygons, and ten times as many of its rows in tiles.
BROADCAST_TILES = 100_000


def listed(df: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """Rows of equal ``keys`` as one, ``columns`` as structs in the list ``name``; several where there are more than ``LISTED``."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    lists = df.withColumn("_list", F.floor((number - 1) / LISTED)).groupBy(*keys, "_list")
    return lists.agg(F.collect_list(F.struct(*columns)).alias(name)).drop("_list")


def layer_cells(layer: DataFrame, zoom: int, geometry: str = "geometry", box: str | None = None) -> DataFrame:
    """One row for each tile that a polygon's bounding box touches; ``cell`` is the key that spatial joins hash on.

    ``box`` names a column for the bounding box, if it is wanted.
    """
    b = geo.bounds(F.col(geometry))
    cells = layer.withColumn("_b", b).withColumn("cell", F.explode(geo.tile_cover("_b.xmin", "_b.ymin", "_b.xmax", "_b.ymax", zoom)))
    return cells.withColumnRenamed("_b", box) if box else cells.drop("_b")


def is_small(layer: DataFrame, zoom: int, equal: list[str] | None = None) -> bool:
    """Whether the layer, with its polygons' tiles and the rows of each, may be broadcast; counts them."""
    b = geo.bounds(F.col("geometry"))
    shapes = layer.groupBy("geometry", *(equal or [])).agg(F.count("*").alias("_n")).withColumn("_b", b)
    tiles = shapes.select("_n", F.size(geo.tile_cover("_b.xmin", "_b.ymin", "_b.xmax", "_b.ymax", zoom)).cast("bigint").alias("_t"))
    found = tiles.agg(F.coalesce(F.sum("_t"), F.lit(0)), F.coalesce(F.sum(F.col("_t") * F.col("_n")), F.lit(0))).first()
    return found[0] <= BROADCAST_TILES and found[1] <= 10 * BROADCAST_TILES


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly, whatever their keys, to a few partitions a core: for rows that later become very many."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def hold(points: DataFrame, cell: str, layer: DataFrame, columns: list[str], name: str, zoom: int, x: str = "long", y: str = "lat", equal: list[str] | None = None, small: bool = False) -> DataFrame:
    """Left join: each point with, under ``name``, a list of the rows (``columns``) of each different polygon that holds it.

    ``cell`` names the points' tile of ``zoom``; layers joined one after another by one such column need one shuffle,
    or none if they are ``small``: then they are broadcast, and points stay where they are.
    """
    equal = equal or []
    merged = listed(layer, ["geometry", *equal], columns, "_rows")
    cells = layer_cells(merged, zoom, box="_box").select("cell", F.col("geometry").alias("_polygon"), geo.is_box(F.col("geometry")).alias("_plain"), "_rows", *[F.col(f"_box.{c}").alias(f"_{c}") for c in ("xmin", "ymin", "xmax", "ymax")], *[F.col(c).alias(f"_on_{c}") for c in equal])
    on = points[cell] == cells["cell"]
    for c in equal:
        on = on & (points[c] == cells[f"_on_{c}"])
    on = on & points[x].between(cells["_xmin"], cells["_xmax"]) & points[y].between(cells["_ymin"], cells["_ymax"])
    on = on & (F.col("_plain") | geo.point_in_polygon(geo.vertex(x, y), F.col("_polygon")))
    return points.join(F.broadcast(cells) if small else cells, on, "left").select(*points.columns, F.col("_rows").alias(name))


def list_out(held: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """The lists of ``hold`` as rows, with ``columns`` in the list's place; no list: one row of nulls."""
    rest = [c for c in held.columns if c != name]
    return held.select(*rest, F.explode_outer(name).alias("_row")).select(*rest, *[F.col(f"_row.`{c}`").alias(c) for c in columns])


def join_points(points: DataFrame, layer: DataFrame, columns: list[str], zoom: int = 8, x: str = "long", y: str = "lat", equal: list[str] | None = None) -> DataFrame:
    """Left join: each point with ``columns`` of every polygon that holds it, edges included.

    The point's tile is a hash key, and ``equal`` names further key columns; a point is in one tile, so no pair
    comes up twice. Candidates pass the polygon's box before its edges are looked at, unless the box is all there is;
    ``zoom`` should make tiles about as large as the polygons. Overlapping polygons repeat the point. Equal polygons are
    tested as one, and their rows listed out at the end.
    """
    held = hold(points.withColumn("_cell", geo.tile_of(x, y, zoom)), "_cell", layer, columns, "_held", zoom, x, y, equal)
    return list_out(held.drop("_cell"), "_held", columns)


def flag_points(points: DataFrame, layer: DataFrame, name: str, zoom: int = 8, x: str = "long", y: str = "lat", equal: list[str] | None = None) -> DataFrame:
    """The different rows of points, with 1 under ``name`` if any polygon of the layer holds the point, else 0."""
    areas = layer.select("geometry", *(equal or [])).distinct().withColumn(name, F.lit(1))
    held = join_points(points, areas, [name], zoom, x, y, equal)
    return held.groupBy(*points.columns).agg(F.coalesce(F.max(name), F.lit(0)).alias(name))


def join_shapes(shapes: DataFrame, layer: DataFrame, key: str, columns: list[str], zoom: int = 8) -> DataFrame:
    """Left join of lines or polygons (``geometry``, unique ``key``) with every polygon of the layer that they meet.

    Candidates share a tile; as both sides are in several tiles, a pair is tested once, in the first tile of both.
    """
    right = layer.select("geometry", *columns).withColumn("_bounds", geo.bounds(F.col("geometry")))
    right = right.withColumn("_id", F.xxhash64("geometry", *columns))
    cells = layer_cells(right, zoom).select("cell", "_id", F.col("geometry").alias("_polygon"), "_bounds", *[F.col(c).alias(f"_new_{c}") for c in columns])
    left = layer_cells(shapes.select(key, "geometry"), zoom).withColumnRenamed("geometry", "_shape")
    overlap = lambda a, b: (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])
    candidates = left.join(cells, "cell").where(overlap(geo.bounds(F.col("_shape")), F.col("_bounds"))).dropDuplicates([key, "_id"])
    met = candidates.where(geo.intersects(F.col("_shape"), F.col("_polygon"))).select(F.col(key).alias("_key"), *[f"_new_{c}" for c in columns])
    joined = shapes.join(met, shapes[key] == met["_key"], "left")
    return joined.select(*shapes.columns, *[F.col(f"_new_{c}").alias(c) for c in columns])


def union_tagged(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """Tables one below the other, each with its key as a literal column."""
    out = None
    for value, df in parts.items():
        tagged = df.withColumn(name, F.lit(value))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def semi_any(df: DataFrame, key: str, *others: DataFrame) -> DataFrame:
    """Rows whose key is in any of the other tables, each row once however often the key is there."""
    keys = others[0].select(key)
    for o in others[1:]:
        keys = keys.unionByName(o.select(key))
    return df.join(keys.distinct(), key, "left_semi")


def not_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has not been worked on: resumption of an interrupted job."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def left_star(fact: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """Chained left joins on one key; clashing columns get the table's name in front, and keys are cast to the fact's type once."""
    kind = fact.schema[key].dataType
    for name, t in tables.items():
        t = t.select(F.col(key).cast(kind).alias("_key"), *[F.col(c).alias(f"{name}_{c}" if c in fact.columns else c) for c in t.columns if c != key])
        fact = fact.join(t, fact[key] == t["_key"], "left").drop("_key")
    return fact


def with_constant(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Each row with the columns of a table of one row at most, by a constant key."""
    b = one_row.limit(1).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(b), "_one", "left").drop("_one")


def is_urban(*ids: str) -> Column:
    """1 if any urban layer's id is there, else 0."""
    found = F.lit(False)
    for c in ids:
        found = found | F.col(c).isNotNull()
    return found.cast("int")
