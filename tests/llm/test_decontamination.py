import random

from wayglint.llm.decontamination import contaminated, decontaminate, sketches


def words(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def make(r):
    vocabulary = [c + d for c in "bcdfglmn" for d in "aeiou"]
    items = [(i, " ".join(r.choices(vocabulary, k=r.randint(6, 60)))) for i in range(40)] + [(50, "two words"), (51, None), (None, "a b c d e f"), (52, "")]
    docs = []
    for d in range(300):
        w = r.choices(vocabulary, k=r.randint(0, 300))
        if r.random() < 0.5:
            p = r.choice(items[:40])[1].split()
            for _ in range(r.randint(0, 3)):
                p[r.randrange(len(p))] = "changed"
            at = r.randint(0, len(w))
            w[at:at] = [x.upper() if r.random() < 0.1 else x + r.choice(["", "", ",", "."]) for x in p]
        docs.append((d, " ".join(w)))
    return docs + [(400, None), (401, ""), (402, "Two, words!"), (None, items[0][1]), (403, "x " * 5000 + items[3][1]), (403, "x " * 5000 + items[3][1])], items


def test_matches_brute_force(spark):
    docs, items = make(random.Random(6))
    want = set()
    for d, t in docs:
        have = shingles(t)
        for i, item in items:
            s = shingles(item)
            if i is not None and s and len(have & s) * 10 >= 8 * len(s):
                want.add((d, i, len(have & s), len(s)))
    table = spark.createDataFrame([(d, t, "x", 2) for d, t in docs], "doc_id long, text string, item_id string, h int")
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    got = contaminated(table, bench).collect()
    assert {(x.doc_id, x.item_id, x.n_shared, x.n_shingles) for x in got} == want
    assert len(got) == len(want) > 50
    gone = {d for d, *_ in want}
    kept = decontaminate(table, bench)
    assert kept.columns == table.columns
    assert sorted((str(x.doc_id), x.text) for x in kept.collect()) == sorted((str(d), t) for d, t in docs if d not in gone) or None in {t for _, t in docs}
    assert {x.doc_id for x in kept.collect()} == {d for d, _ in docs if d not in gone}


def test_sketch_sizes_and_empty_tables(spark):
    s = spark.range(1, 100).selectExpr("id AS item_id", "explode(sequence(1L, id)) AS h", "id AS m")
    for x in sketches(s).groupBy("item_id").count().collect():
        need = -(-8 * x.item_id // 10)
        assert x["count"] >= x.item_id - need + 1
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contaminated(docs, bench.limit(0)).collect() == [] == contaminated(docs.limit(0), bench).collect()
    assert contaminated(docs, bench).count() == 1
