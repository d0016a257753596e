import json
import os
import time

import pytest
from pyspark.sql import functions as F

from wayglint.functions import geo
from wayglint.sources import discovery, files, http
from wayglint.streaming.pickup import pick_up

ROW = "s,7,http://x,1.5,2.5,POINT (1.5 2.5),10,20,,mk,md,cr,true,1700000000000\n"


def test_csv_to_hive_parquet(spark, tmp_path):
    names = ",".join(files.IMAGE_COLUMNS.names)
    (tmp_path / "a.csv").write_text(names + "\n" + ROW * 3)
    d = files.read_images_csv(spark, str(tmp_path / "a.csv"))
    r = d.first()
    assert (r.id, r.is_pano, r.geometry.parts[0][0].x, r.altitude) == (7, True, 1.5, None)
    assert files.read_images_csv(spark, str(tmp_path / "a.csv"), ["sequence"]).columns == ["sequence"]
    files.write_parquet(d.withColumn("tile", geo.tile_of("long", "lat", 8)), str(tmp_path / "out"), "tile", rows_per_file=2)
    back = files.read_parquet(spark, str(tmp_path / "out"), file_name=True)
    assert back.count() == 3 and back.first().tile == "129-126-8" and "tile=" in back.first().filename
    assert len(list((tmp_path / "out" / "tile=129-126-8").glob("*.zstd.parquet"))) == 2
    files.write_csv(d.select("sequence", "id"), str(tmp_path / "c"))
    files.write_csv(d.select("sequence", "id"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 6
    files.write_clustered(d.select("id", "long"), str(tmp_path / "z"), "long")
    assert files.read_parquet(spark, str(tmp_path / "z"), glob="*.parquet").count() == 3


def test_newer_files_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    for f in (tmp_path / "p").iterdir():
        os.utime(f, (time.time() - 90_000,) * 2)
    spark.range(2).write.mode("append").parquet(str(tmp_path / "p"))
    day_ago = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 80_000))
    assert files.read_parquet(spark, str(tmp_path / "p"), newer_than=day_ago).count() == 2
    assert files.first_existing(spark, str(tmp_path / "none*"), str(tmp_path / "p")) == str(tmp_path / "p")
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, str(tmp_path / "none"))


def test_geojson(spark, tmp_path):
    shapes = [{"type": "Point", "coordinates": [1.0, 2.0]}, {"type": "LineString", "coordinates": [[0.0, 0.0], [1.0, 1.0]]}, {"type": "Polygon", "coordinates": [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]}, {"type": "MultiPolygon", "coordinates": [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]], [[[5.0, 5.0], [6.0, 5.0], [6.0, 6.0], [5.0, 5.0]]]]}]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": str(i), "n": i}, "geometry": g} for i, g in enumerate(shapes)]}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    d = files.read_geojson(spark, str(tmp_path / "f.json"), {"name": "string", "n": "int"})
    rows = {r.n: r for r in d.collect()}
    assert rows[0].geometry.parts[0][0].y == 2.0 and len(rows[3].geometry.parts) == 2 and rows[2].name == "2"
    files.write_geojson(d, str(tmp_path / "out"))
    back = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "out")).collect()]
    assert {f["properties"]["n"]: f["geometry"] for f in back} == dict(enumerate(shapes))
    odd = spark.createDataFrame([(1,)], "a int").toDF("﻿a ")
    assert files.clean_names(odd).columns == ["a"]


def test_api_payload(spark):
    data = [{"id": "5", "thumb_original_url": "u", "captured_at": 9, "geometry": {"coordinates": [1.0, 2.0]}, "computed_geometry": {"coordinates": [3.0, 4.0]}, "creator": {"id": "c"}}, {"id": "5", "thumb_original_url": "u", "captured_at": 9, "geometry": {"coordinates": [1.0, 2.0]}}, {"id": "6", "captured_at": 9}]
    d = files.images_from_json(spark.createDataFrame([(json.dumps({"data": data}),), ("nonsense",), (None,)], "json string"))
    assert d.columns == files.IMAGE_COLUMNS.names
    assert [(r.id, r.is_pano) for r in d.collect()] == [(5, False)]


def test_pages():
    answers = {0: [{"id": 1}, {"id": 2}], 1: [{"id": 2}, {"id": 3}], 2: [{"id": 2}, {"id": 3}]}
    tries = []

    def get(url, timeout):
        tries.append(url)
        page = int(url.rsplit("=")[-1])
        if len(tries) == 1:
            raise OSError("down")
        return 200, json.dumps({"data": answers[page]})

    rows = list(http.pages_of("http://h?k={key}&p={page}", "a", 2, pause=0, get=get, stale=1))
    assert [(r[1], r[2]) for r in rows] == [(0, "ok"), (1, "ok")]
    failed = list(http.pages_of("http://h?{key}{page}", "a", 2, retries=2, pause=0, get=lambda u, t: (500, "")))
    assert failed == [("a", 0, "failed", "status 500", None)]


def test_repeated_records_do_not_end_a_key():
    answers = [[1, 1], [1, 2], [2, 2], [1, 2], [3, 4], [4], [9, 9]]
    get = lambda u, t: (200, json.dumps({"data": [{"id": i} for i in answers[int(u[-1])]]}))
    assert [r[1] for r in http.pages_of("http://h?{key}{page}", "a", 2, pause=0, get=get)] == [0, 1, 4]
    assert [r[1] for r in http.pages_of("http://h?{key}{page}", "a", 2, pause=0, get=get, stale=2)] == [0, 1]
    began = time.monotonic()
    list(http.pages_of("http://h?{key}{page}", "a", 2, pause=0, get=get, rate=50))
    assert time.monotonic() - began >= 0.09


def test_names_and_paths(spark):
    rows = [("/a/Europe_x.csv",), ("/asia/EUROPE.asia",), ("/x/1-2-3.parquet",), ("/t=10-20-8/part-1.parquet",), ("none",), (None,)]
    d = spark.createDataFrame(rows, "p string")
    got = [(r.c, r.t) for r in d.select(files.class_of_name(F.col("p"), ["asia", "Europe"]).alias("c"), files.tile_of_path(F.col("p")).alias("t")).collect()]
    assert got == [("Europe", None), ("asia", None), (None, "1-2-3"), (None, "10-20-8"), (None, None), (None, None)]


def test_hot_partition_is_dealt_to_several_writers(spark, tmp_path):
    d = spark.range(1000).selectExpr("id", "CASE WHEN id < 900 THEN 'hot' WHEN id < 950 THEN 'b' END AS tile", "map('k', id) AS m")
    files.write_parquet(d, str(tmp_path / "t"), "tile", rows_per_file=100)
    back = files.read_parquet(spark, str(tmp_path / "t"), file_name=True)
    assert back.count() == 1000 and sorted(back.columns) == ["filename", "id", "m", "tile"]
    assert back.groupBy("filename").count().agg({"count": "max"}).first()[0] <= 100
    assert back.where("tile is null").count() == 50


def test_data_source_reports_failures(spark):
    spark.dataSource.register(http.PagedJson)
    d = spark.read.format("paged_json").options(url="http://127.0.0.1:1/{key}/{page}", keys="a,b", retries="1", pause="0", timeout="1").load()
    ok, failed = http.split_by_status(d)
    assert ok.count() == 0 and sorted(r.key for r in failed.collect()) == ["a", "b"]


def test_discovery(spark):
    points = spark.createDataFrame([(0.001 * i, 0.0005 * i) for i in range(500)], "x double, y double").cache()

    def count(boxes):
        inside = (F.col("x") >= F.col("xmin")) & (F.col("x") < F.col("xmax")) & (F.col("y") >= F.col("ymin")) & (F.col("y") < F.col("ymax"))
        return boxes.join(points, inside, "left").groupBy("xmin", "ymin", "xmax", "ymax").agg(F.count("x").alias("hits"))

    done, full = discovery.discover(spark.createDataFrame([(0.0, 0.0, 1.0, 1.0)], discovery.BOX), count, cap=100)
    assert full.isEmpty() and done.agg(F.sum("hits"), F.max("hits")).first()[0] == 500


def test_pick_up_once(spark, tmp_path):
    seen = []
    spark.range(3).write.parquet(str(tmp_path / "src"))
    for more in (0, 2):
        if more:
            spark.range(more).write.mode("append").parquet(str(tmp_path / "src"))
        pick_up(spark, str(tmp_path / "src"), spark.range(1).schema, str(tmp_path / "ck"), lambda batch, n: seen.append(batch.count()))
    assert seen == [3, 2]


def test_stages_from_csv_to_statistics(spark, tmp_path):
    from wayglint.config import Settings
    from wayglint.plans import pipelines

    s = Settings()
    names = ",".join(files.IMAGE_COLUMNS.names)
    rows = [f"s{i % 3},{i},http://x,{0.1 + i * 0.0005:.6f},0.5,POINT ({0.1 + i * 0.0005:.6f} 0.5),1,1,,a,b,c,false,{1000 + i}" for i in range(60)]
    (tmp_path / "a.csv").write_text("\n".join([names, *rows]) + "\n")
    pipelines.images_to_parquet(spark, str(tmp_path / "a.csv"), str(tmp_path / "images"), s)
    images = files.read_parquet(spark, str(tmp_path / "images"))
    assert images.count() == 60

    box = lambda d: d.withColumn("geometry", geo.box("x0", "y0", "x1", "y1")).drop("x0", "y0", "x1", "y1")
    countries = box(spark.createDataFrame([("A", "K", 0.0, 0.0, 1.0, 1.0)], "country string, continent string, x0 double, y0 double, x1 double, y1 double"))
    urban = box(spark.createDataFrame([(5, 0.1, 0.4, 0.115, 0.6)], "urban_id int, x0 double, y0 double, x1 double, y1 double"))
    areas = pipelines.prepare_urban(urban, countries, "urban_id", s.zoom)
    assert areas.first().country == "A" and areas.first().tiles
    d = pipelines.enrich(images.drop("tile", "geometry"), countries, {"urban_id": areas.drop("tiles", "continent")}, s).cache()
    assert d.where("urban = 1").count() == 31 and d.where("country = 'A'").count() == 60

    line = geo.line(F.array(geo.vertex(0.1, 0.50005), geo.vertex(0.2, 0.50005)))
    raw = spark.createDataFrame([(1, "primary", True), (2, "footway", True), (3, "primary", False)], "osm_id long, h string, latest boolean").select("osm_id", "latest", F.lit(True).alias("visible"), line.alias("geometry"), F.create_map(F.lit("highway"), F.array("h")).alias("tags"))
    roads = pipelines.prepare_roads(raw, countries, s)
    assert {r.osm_id for r in roads.collect()} == {1}
    found = pipelines.match_images(d, roads, s)
    assert found.count() == 60 and found.agg(F.max("distance_meter")).first()[0] < 6

    labelled = d.join(found.drop("n", "abs_diff", "percent_diff"), "id").withColumns({"pred_label": F.lit(1), "pred_score": F.lit(0.9), "zs_pred_score": F.lit(0.0), "no_road_image_filter": F.lit(1)})
    lengths = roads.withColumns({"length": F.lit(100.0), "urban": F.lit(0), "urban_id": F.lit(None).cast("int"), "z14_tiles": F.lit("x")})
    tables = pipelines.statistics(labelled, lengths, s, ("world",))
    pipelines.write_layers(tables, str(tmp_path / "stats"))
    world = files.read_parquet(spark, str(tmp_path / "stats/world")).first()
    assert (world.number_of_images, world.unpaved_segments, world.number_of_osm_ids, world.primary_id) == (60, 2, 1, 1)
    assert world.length_urban > 0 and pipelines.tile_table(spark, (0, 0.1, 3, 3), 8).count() == 9
