"""Reading and writing of files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayglint.functions import geo

# The columns of a metadata file, in their order.
IMAGE_COLUMNS = T.StructType([
    T.StructField("sequence", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("geometry", T.StringType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("width", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("make", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("creator", T.StringType()),
    T.StructField("is_pano", T.BooleanType()),
    T.StructField("timestamp", T.LongType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def first_existing(spark: SparkSession, *paths: str) -> str:
    """The first path or glob that names anything, such as split files before the raw one."""
    for p in paths:
        if _exists(spark, p):
            return p
    raise FileNotFoundError(f"none of {paths}")


def read_parquet(spark: SparkSession, *paths: str, glob: str | None = None, newer_than: str | None = None, file_name: bool = False) -> DataFrame:
    """Parquet files, with hive partitions as columns; those written after ``newer_than`` only (ISO time)."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if newer_than:
        r = r.option("modifiedAfter", newer_than)
    df = r.parquet(*paths)
    return df.withColumn("filename", F.col("_metadata.file_path")) if file_name else df


def read_images_csv(spark: SparkSession, path: str, columns: list[str] | None = None, newer_than: str | None = None) -> DataFrame:
    """Typed metadata with the geometry parsed from its text; ``columns`` prunes before parsing."""
    r = spark.read.schema(IMAGE_COLUMNS).option("header", True).option("enforceSchema", False)
    if newer_than:
        r = r.option("modifiedAfter", newer_than)
    df = r.csv(path)
    if columns:
        df = df.select(*columns)
    return df.withColumn("geometry", geo.from_wkt(F.col("geometry"))) if "geometry" in df.columns else df


def clean_names(df: DataFrame) -> DataFrame:
    """Column names without byte order marks and outer blanks."""
    return df.toDF(*[c.replace("\ufeff", "").strip() for c in df.columns])


def read_geojson(spark: SparkSession, path: str, properties: dict[str, str]) -> DataFrame:
    """Features of GeoJSON files: a geometry, and the named properties with their types."""
    ring = T.ArrayType(T.ArrayType(T.DoubleType()))
    props = T.StructType([T.StructField(k, T.DataType.fromDDL(v)) for k, v in properties.items()])
    shape = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    whole = T.StructType([T.StructField("features", T.ArrayType(T.StructType([T.StructField("properties", props), T.StructField("geometry", shape)])))])
    f = spark.read.schema(whole).option("multiLine", True).json(path).select(F.explode("features").alias("f"))
    kind, text = F.upper(F.col("f.geometry.type")), F.col("f.geometry.coordinates")
    vs = lambda c: F.transform(c, lambda v: geo.vertex(F.get(v, F.lit(0)), F.get(v, F.lit(1))))
    as_ = lambda t: F.from_json(text, t)
    rings = lambda c: F.transform(c, vs)
    deep = T.ArrayType(ring)
    parts = (
        F.when(kind == "POINT", F.array(vs(F.array(as_(T.ArrayType(T.DoubleType()))))))
        .when(kind == "LINESTRING", F.array(vs(as_(ring))))
        .when(kind.isin("POLYGON", "MULTILINESTRING"), rings(as_(deep)))
        .when(kind == "MULTIPOLYGON", rings(F.flatten(as_(T.ArrayType(deep)))))
    )
    return f.select("f.properties.*", F.when(parts.isNotNull(), F.struct(kind.alias("kind"), parts.alias("parts"))).alias("geometry"))


def images_from_json(payload: DataFrame, column: str = "json") -> DataFrame:
    """Rows of API answers (``{"data": [...]}`` as text): coordinates taken apart, the computed place before the original one.

    Records without id, place, url or time are dropped, and ids come once.
    """
    at = T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    record = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("sequence", T.StringType()), T.StructField("thumb_original_url", T.StringType()),
        T.StructField("computed_geometry", at), T.StructField("geometry", at), T.StructField("captured_at", T.LongType()),
        T.StructField("height", T.DoubleType()), T.StructField("width", T.DoubleType()), T.StructField("altitude", T.DoubleType()),
        T.StructField("make", T.StringType()), T.StructField("model", T.StringType()),
        T.StructField("creator", T.StructType([T.StructField("id", T.StringType())])), T.StructField("is_pano", T.BooleanType()),
    ])
    d = payload.select(F.explode(F.from_json(column, T.StructType([T.StructField("data", T.ArrayType(record))]))["data"]).alias("r")).select("r.*")
    place = F.coalesce("computed_geometry.coordinates", "geometry.coordinates")
    d = d.withColumns({"_x": F.get(place, F.lit(0)), "_y": F.get(place, F.lit(1))}).where("id is not null and thumb_original_url is not null and captured_at is not null and _x is not null and _y is not null")
    return d.select(
        "sequence", F.col("id").cast("bigint").alias("id"), F.col("thumb_original_url").alias("url"), F.col("_x").alias("long"), F.col("_y").alias("lat"),
        geo.point("_x", "_y").alias("geometry"), "height", "width", "altitude", "make", "model", F.col("creator.id").alias("creator"), F.coalesce("is_pano", F.lit(False)).alias("is_pano"),
        F.col("captured_at").alias("timestamp"),
    ).dropDuplicates(["id"])


def class_of_name(path: Column, classes: list[str], otherwise: str | None = None) -> Column:
    """The first of ``classes`` that a file's name holds, whatever the letters' case."""
    name, found = F.lower(F.element_at(F.split(path, "/"), -1)), F.lit(otherwise)
    for c in reversed(classes):
        found = F.when(F.contains(name, F.lit(c.lower())), F.lit(c)).otherwise(found)
    return found


def tile_of_path(path: Column) -> Column:
    """The tile ``x-y-z`` in a file's name (``images_137-82-8.parquet``) or in the folder of a partition."""
    found = F.regexp_extract(path, r"(?:^|[/_=])(\d+-\d+-\d+)(?:[._/]|$)", 1)
    return F.nullif(found, F.lit(""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of ``spark.checkpoint.dir``; in a temporary one only where that is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="wayglint-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, partition: str | None = None, rows_per_file: int | None = None, mode: str = "overwrite") -> None:
    """zstd Parquet; with ``partition`` a folder for each value, whose rows come together in one shuffle, split by rows a file.

    With ``rows_per_file`` a value of more rows is dealt to as many writers as it has files, so that no task holds it all.
    """
    if partition and rows_per_file:
        ways = df.groupBy(F.col(partition).alias("_value")).agg(F.ceil(F.count("*") / rows_per_file).cast("int").alias("_ways"))
        by = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
        many = df.join(ways, df[partition].eqNullSafe(ways["_value"])).withColumn("_way", F.pmod(F.xxhash64(*by), F.col("_ways")))
        df = many.repartition(partition, "_way").select(*df.columns)
    elif partition:
        df = df.repartition(partition)
    w = df.write.mode(mode).option("compression", "zstd")
    if rows_per_file:
        w = w.option("maxRecordsPerFile", rows_per_file)
    (w.partitionBy(partition) if partition else w).parquet(path)


def write_clustered(df: DataFrame, path: str, *order: str) -> None:
    """Parquet files that each hold a range of the order, such as a space-filling curve's code, for scans to skip by."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "append", rows_per_file: int | None = None) -> None:
    """CSV with headers: appended, overwritten, or split into files of so many rows."""
    w = df.write.mode(mode).option("header", True)
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).csv(path)


def write_geojson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A GeoJSON feature a line; points, lines and polygons."""
    vs = lambda part: F.transform(part, lambda v: F.array(v["x"], v["y"]))
    g = F.col("geometry")
    one, many = F.to_json(vs(F.get(g["parts"], F.lit(0)))), F.to_json(F.transform(g["parts"], vs))
    coordinates = F.when(g["kind"] == "POINT", F.to_json(F.get(vs(F.get(g["parts"], F.lit(0))), F.lit(0)))).when(g["kind"] == "LINESTRING", one).when(g["kind"] == "MULTIPOLYGON", F.to_json(F.transform(g["parts"], lambda p: F.array(vs(p))))).otherwise(many)
    names = F.create_map(*[F.lit(x) for kv in {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon"}.items() for x in kv])
    rest = [c for c in df.columns if c != "geometry"]
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*rest)) if rest else F.lit("{}"), F.lit(',"geometry":{"type":"'), names[g["kind"]], F.lit('","coordinates":'), coordinates, F.lit("}}"))
    df.select(feature.alias("value")).write.mode(mode).text(path)
