import random

import pytest
import xxhash
from pyspark.sql import functions as F

from wayglint.llm import simhash
from wayglint.llm.graph import connected_components
from wayglint.llm.simhash import _split_keys, block_keys, deduplicate, fingerprint, near_duplicates


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def slow_components(rows, distance=4):
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    fps = [slow_fingerprint(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, f"{f:016x}", least.get(root(i))) for i, (d, f) in enumerate(zip([d for d, _ in rows], fps, strict=True))), key=str)


def make_rows():
    r = random.Random(5)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(120)) for _ in range(12)]
    rows = []
    for n in range(160):
        words = base[n % 12].split()
        for _ in range(r.randint(0, 2)):
            words[r.randrange(len(words))] = "x"
        rows.append((1000 - n, " ".join(words)))
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one\ttwo"), (5, "one\ttwo"), (6, "É é"), (None, "one two"), (None, "lonely words are these five")]
    return rows


def test_matches_brute_force(spark):
    rows = make_rows()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == slow_components(rows)


@pytest.mark.parametrize(("blocks", "joined", "split"), [(6, 2, 0), (7, 3, 1 << 60), (8, 4, 0)])
def test_all_block_choices_give_the_same(spark, monkeypatch, blocks, joined, split):
    monkeypatch.setattr(simhash, "KEYS", ((1 << 62, blocks, joined),))
    monkeypatch.setattr(simhash, "SPLIT", split)
    test_matches_brute_force(spark)


def test_split_blocks_lose_no_close_pair(spark):
    r = random.Random(9)
    pairs = []
    for _ in range(500):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 4)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    rows = spark.createDataFrame(pairs, "a long, b long")
    for _, blocks, joined in simhash.KEYS:
        keys = lambda x: F.transform(block_keys(F.col(x), blocks, joined), lambda k: F.struct(k["key"].alias("key"), _split_keys(k["key"], k["rest"], blocks, joined, 4).alias("parts")))  # noqa: B023, E731
        shared = F.exists(keys("a"), lambda k: F.exists(keys("b"), lambda m: (k["key"] == m["key"]) & F.arrays_overlap(k["parts"], m["parts"])))
        assert rows.where(shared).count() == len(pairs)


def test_fingerprint_of_odd_texts():
    for t in (None, "", " ", "a", "a b c", "a b c d", "A\x0bB  c d e f g", "ß " * 900):
        assert fingerprint(t) == slow_fingerprint(t)


def test_empty_table_and_dedup(spark):
    schema = "doc_id long, text string, lang string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(3, "a b c d e", "x"), (2, "a b c d e", "y"), (2, "a b c d e", "y"), (7, "other words in this row", None), (None, "a b c d e", "z")], schema)
    kept = deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "7", "None"]
    near = " ".join(f"w{i}" for i in range(400))
    rows = [(5, near, "a"), (5, "a text of its own under the same id", "b"), (9, near + " end", "c"), (5, near, "d"), (12, "a text of its own under the same id", "e")]
    results = []
    for order in (rows, rows[::-1]):
        kept = deduplicate(spark.createDataFrame(order, schema).repartition(3)).collect()
        results.append(sorted(map(tuple, kept)))
        assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, near), (5, "a text of its own under the same id")])
    assert results[0] == results[1]
    clash = docs.withColumns({"fp": F.lit(1), "component": F.lit("c"), "text_hash": F.lit(None).cast("string"), "_id": F.create_map(F.lit("k"), F.lit(1))})
    assert deduplicate(clash).columns == clash.columns and deduplicate(clash).count() == 3
    assert deduplicate(docs.limit(0)).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(5, 5), (5, 6), (None, 3)]
    edges = spark.createDataFrame(path, "u long, v long")
    for small in (0, 1000):
        rows = connected_components(edges, small).collect()
        assert {r.node: r.component for r in rows} == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
        assert len(rows) == 71
        assert connected_components(edges.limit(0), small).collect() == []
