import math
import random
import time

import xxhash
from pyspark.sql import functions as F

from wayglint.config import Settings, load_settings
from wayglint.functions import arrays, geo
from wayglint.functions import metrics as m
from wayglint.operators import consensus, layers, matching, ordering, thinning, traces


def test_bands_are_open(spark):
    rows = [(1, a, float(d)) for a, d in enumerate((0, 5, 9, 10, 15))] + [(2, 1, 0.0), (2, 2, 10.0), (2, 3, 12.0)] + [(3, 1, 10.0), (3, 2, 20.0)] + [(4, 1, 7.0), (4, 1, 3.0)]
    d = spark.createDataFrame(rows, "id long, osm_id int, distance_meter double")
    got = {}
    for r in matching.resolve(d).collect():
        got.setdefault(r.id, set()).add((r.osm_id, r.distance_meter, r.abs_diff, r.percent_diff))
    assert got == {1: {(1, 5.0, 5.0, None), (2, 9.0, 9.0, None)}, 2: {(3, 12.0, 12.0, None)}, 3: {(1, 10.0, 0.0, 0.0)}, 4: {(1, 3.0, 0.0, 0.0)}}
    listed = {r.id: (r["count"], r.picks) for r in matching.resolve_listed(d).collect()}
    assert listed == {1: (5, [1, 2]), 2: (3, [3]), 3: (2, [1]), 4: (1, [1])}


def test_thinning(spark):
    r = random.Random(1)
    rows, x = [], 0.0
    for i in range(200):
        x += r.random() * 0.002
        rows.append((i, "s", i * 10, x, 0.0, int(i % 50 > 25)))
    rows += [(500, "one", 1, 5.0, 5.0, 0), (501, "same", 1, 6.0, 6.0, 0), (502, "same", 2, 6.0, 6.0, 0), (503, "nowhere", 1, None, None, 0)]
    d = spark.createDataFrame(rows, "id long, sequence string, timestamp long, long double, lat double, urban int")
    kept = {q.id: q for q in thinning.thin(d).collect()}
    assert 500 in kept and 501 in kept and 502 not in kept and 503 not in kept
    for urban, gap in ((1, 100), (0, 1000)):
        walk = sorted((q for q in kept.values() if q.sequence == "s" and q.urban == urban), key=lambda q: q.timestamp)
        assert all(math.radians(b.long - a.long) * 6_371_008 > gap for a, b in zip(walk, walk[1:], strict=False))
    last = {q.id for q in thinning.thin(d, keep_last=True, metric="equirect").collect()}
    assert {199, 502} <= last
    corner = spark.createDataFrame([(1, "a", 1, 0.0, 0.0), (2, "a", 2, 0.5, 0.0), (3, "a", 3, 1.0, 0.0), (4, "a", 4, 1.0, 1.0)], "id long, sequence string, timestamp long, long double, lat double")
    assert sorted(q.id for q in thinning.thin_by_shape(corner, 100).collect()) == [1, 3, 4]


def test_consensus_by_hand(spark):
    base = {"zs_pred_score": 0.0, "pred_score": 0.9, "no_road_image_filter": 1, "osm_tags_highway": "primary"}
    votes = [("a", 0, 2.0, 1), ("b", 1, 4.0, 1), ("b", 1, 6.0, 2), ("c", 0, 5.0, 9), ("c", 1, 5.0, 3), ("d", 0, 5.0, 3), ("d", 1, 5.0, 9), ("e", 1, 0.0, 1), ("e", 0, 0.0, 1), ("f", None, 1.0, 1), ("g", 1, 10.0, 1)]
    rows = [{**base, "osm_id": o, "pred_label": p, "distance_meter": d, "timestamp": t, "id": i} for i, (o, p, d, t) in enumerate(votes)]
    schema = "osm_id string, pred_label int, distance_meter double, timestamp long, id long, zs_pred_score double, pred_score double, no_road_image_filter int, osm_tags_highway string"
    got = {r.osm_id: (r.pred_label, r.score_micro, r.n) for r in consensus.consensus(spark.createDataFrame(rows, schema), "osm_id").collect()}
    assert got == {"a": (0, -1_000_000, 1), "b": (1, 500_000, 2), "c": (0, 0, 2), "d": (1, 0, 2), "e": (None, 0, 2)}


def test_layer_joins(spark):
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 9.0, 9.0), (4, None, None)], "id long, long double, lat double")
    layer = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0), ("b", 1.0, 0.0, 2.0, 1.0)], "name string, x0 double, y0 double, x1 double, y1 double").withColumn("geometry", geo.box("x0", "y0", "x1", "y1"))
    got = sorted((r.id, r.name or "") for r in layers.join_points(points, layer, ["name"]).collect())
    assert got == [(1, "a"), (2, "a"), (2, "b"), (3, ""), (4, "")]
    lines = spark.createDataFrame([(1, 0.5, 0.5, 1.5, 0.5), (2, 5.0, 5.0, 6.0, 6.0)], "k long, x0 double, y0 double, x1 double, y1 double").withColumn("geometry", geo.line(F.array(geo.vertex("x0", "y0"), geo.vertex("x1", "y1")))).select("k", "geometry")
    assert sorted((r.k, r.name or "") for r in layers.join_shapes(lines, layer, "k", ["name"]).collect()) == [(1, "a"), (1, "b"), (2, "")]
    assert layers.semi_any(points, "id", points.where("id < 2"), points.where("id < 3")).count() == 2
    assert layers.not_done(points, points.where("id > 1"), "id").count() == 1
    assert layers.with_constant(points, points.limit(0).select(F.lit(1).alias("z"))).count() == 4


def test_traces(spark):
    d = spark.createDataFrame([(1, "s", 7, 0, 2, 1.0, 0.0), (2, "s", 7, 0, 1, 0.0, 0.0), (3, "t", 7, 0, 1, 0.0, 0.0), (4, "t", None, 0, 1, 0.0, 0.0)], "id long, sequence string, osm_id long, urban int, timestamp long, long double, lat double")
    got = {r.sequence: r for r in traces.assemble(d).collect()}
    assert got["s"].ids == [2, 1] and got["t"].geometry is None and got["t"].length == 0
    assert math.isclose(got["s"].length, math.radians(1) * 6_371_008, abs_tol=1e-3)


def test_list_nulls(spark):
    d = spark.createDataFrame([(1, [1, None, 1]), (1, None), (1, [2]), (2, [])], "k int, l array<int>")
    got = {r.k: (r.s, r.a, r.h) for r in d.groupBy("k").agg(arrays.merge_sets("l").alias("s"), F.size(arrays.collect_all("l")).alias("a"), F.max(arrays.list_contains(F.col("l"), 9)).alias("h")).collect()}
    assert got == {1: ([1, 2], 3, False), 2: ([], 1, False)}
    z = spark.createDataFrame([(1, [1, 2], ["a"]), (2, [], None)], "k int, a array<int>, b array<string>")
    assert sorted((r.a, r.b or "") for r in arrays.zip_explode(z, "a", "b").collect()) == [(1, "a"), (2, "")]


def test_ratio_of_zero_and_classes(spark):
    d = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    assert d.agg(*m.ratios(["a"], ["b"])).first()[0] is None
    names = m.class_names(Settings().road_classes, "id") + m.surface_names(Settings().road_classes)
    assert len(names) == len(set(names)) == 63


def test_numbering_and_chunks(spark):
    d = spark.createDataFrame([(i * i,) for i in range(1000)] + [(None,)], "k long")
    for seed in (None, 3):
        rows = ordering.numbered(d.repartition(5), "k", seed).collect()
        assert sorted(r.rn for r in rows) == list(range(1, 1001))
        assert {r.k: r.rn for r in rows} == {r.k: r.rn for r in ordering.numbered(d, "k", seed).collect()}
    n = ordering.numbered(d, "k")
    sizes = sorted(r["count"] for r in ordering.near_equal_chunks(n, 1000, 7).groupBy("chunk").count().collect())
    assert sizes == [142] * 1 + [143] * 6 or sum(sizes) == 1000 and max(sizes) - min(sizes) <= 1
    assert ordering.sample_with_replacement(n, 1000, 50).count() == 50
    assert ordering.numbered(d.limit(0), "k").count() == 0


def test_settings(tmp_path):
    s = load_settings({"zoom": 9, "paths": {"root": "/d", "in": "{root}/in", "x": "{in}/x"}})
    assert s.zoom == 9 and s.path("x") == "/d/in/x"
    (tmp_path / "c.json").write_text('{"sigma": 2}')
    assert load_settings(tmp_path / "c.json").sigma == 2
    for bad in ({"nonsense": 1},):
        try:
            load_settings(bad)
        except ValueError:
            continue
        raise AssertionError


def test_rdp_against_recursion(spark):
    """Thinning by shape keeps what the plain recursive algorithm keeps."""

    def keep(p, a, b, epsilon):
        (x0, y0), (x1, y1) = p[a], p[b]
        best = (epsilon, None)
        for i in range(a + 1, b):
            dx, dy = x1 - x0, y1 - y0
            t = min(1.0, max(0.0, ((p[i][0] - x0) * dx + (p[i][1] - y0) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
            d = math.hypot(p[i][0] - x0 - t * dx, p[i][1] - y0 - t * dy)
            if d > best[0]:
                best = (d, i)
        return {a, b} if best[1] is None else keep(p, a, best[1], epsilon) | keep(p, best[1], b, epsilon)

    r = random.Random(2)
    rows, want = [], set()
    for s in range(12):
        p = [(r.uniform(0, 0.05), r.uniform(10, 10.05)) for _ in range(r.randint(1, 30))]
        rows += [(s * 100 + i, str(s), i, x, y) for i, (x, y) in enumerate(p)]
        want |= {s * 100 + i for i in keep(p, 0, len(p) - 1, 1000 / 111_195.0)}
    d = spark.createDataFrame(rows, "id long, sequence string, timestamp long, long double, lat double")
    assert {x.id for x in thinning.thin_by_shape(d, 1000.0).collect()} == want


def test_long_sequences_are_thinned_in_linear_time(spark):
    n = 60_000
    d = spark.range(n).selectExpr("id", "'s' AS sequence", "id AS timestamp", "id * 0.01 % 90 AS long", "10.0 AS lat", "0 AS urban")
    began = time.monotonic()
    assert thinning.thin(d, 100.0, 100.0).count() == n
    assert time.monotonic() - began < 60


def test_samples_and_shuffles_by_their_hashes(spark):
    """Spark's xxhash64 of a seed and a number, by the xxhash library."""
    digest = lambda seed, x: (xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)) + (1 << 63)) % (1 << 64) - (1 << 63)
    keys = [7 * i + 3 for i in range(500)]
    d = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    shuffled = ordering.numbered(d, "k", seed=42)
    assert [x.k for x in shuffled.orderBy("rn").collect()] == sorted(keys, key=lambda k: (digest(42, k), k))
    assert [x.chunk for x in ordering.ceil_chunks(shuffled, 500, 7).orderBy("rn").collect()] == [i // 72 for i in range(500)]
    drawn = sorted(x.k for x in ordering.sample_with_replacement(ordering.numbered(d, "k"), 500, 300, seed=1).collect())
    assert drawn == sorted(keys[digest(1, i) % 500] for i in range(300))


def test_matching_takes_the_nearest_segment_of_long_roads(spark):
    r = random.Random(6)
    roads = [(o, [(0.001 * i, 10 + r.uniform(0, 0.004)) for i in range(12)]) for o in range(4)]
    images = [(i, r.uniform(0, 0.011), 10 + r.uniform(0, 0.004)) for i in range(300)]
    text = lambda vs: "LINESTRING (" + ", ".join(f"{x} {y}" for x, y in vs) + ")"
    roads_df = spark.createDataFrame([(o, text(vs), "x") for o, vs in roads], "osm_id long, wkt string, osm_tags_highway string").withColumn("geometry", geo.from_wkt(F.col("wkt"))).drop("wkt")
    got = {(x.id, x.osm_id): x.distance_meter for x in matching.match(spark.createDataFrame(images, "id long, long double, lat double"), roads_df).collect()}

    def metres(x0, y0, x1, y1):
        a = math.sin(math.radians(y1 - y0) / 2) ** 2 + math.cos(math.radians(y0)) * math.cos(math.radians(y1)) * math.sin(math.radians(x1 - x0) / 2) ** 2
        return 2 * 6371008.0 * math.asin(math.sqrt(a))

    want = {}
    for i, x, y in images:
        for o, vs in roads:
            for (x0, y0), (x1, y1) in zip(vs, vs[1:], strict=False):
                t = min(1.0, max(0.0, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / ((x1 - x0) ** 2 + (y1 - y0) ** 2)))
                d = metres(x, y, x0 + t * (x1 - x0), y0 + t * (y1 - y0))
                if d < 30:
                    want[i, o] = min(d, want.get((i, o), d))
    assert got.keys() == want.keys() and len(want) > 20
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
