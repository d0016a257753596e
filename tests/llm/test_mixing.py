import hashlib
import random

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wayglint.llm.mixing import SQL, mix


def rows():
    r = random.Random(8)
    out = []
    for d in range(600):
        source = "big" if d % 3 == 0 else r.choice(["a", "b", "Z", "é", None])
        out.append((d, " ".join(["w"] * r.choice([0, 1, 5, 40, 90, 200])), source))
    out += [(900, None, "a"), (901, "w " * 3000, "b"), (902, "", "only empty"), (903, "one two", "two words")]
    return out


def test_matches_sql_and_reaches_targets(spark):
    documents = pd.DataFrame(rows(), columns=["doc_id", "text", "source"])
    docs = spark.createDataFrame([(*x, "t") for x in rows()], "doc_id long, text string, source string, target string").repartition(7)
    got = mix(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "inclusion", "copies", "taken"]
    got = got.toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(SQL["op4_mixing"]).df().sort_values("doc_id").reset_index(drop=True)
    for c in ("doc_id", "size", "source_size", "taken"):
        assert got[c].astype("int64").tolist() == want[c].astype("int64").tolist(), c
    assert (got.target - want.target).abs().max() < 1e-6
    assert (got.taken <= 2 * got["size"]).all()
    by = got.groupby(got.source.fillna("?")).agg(target=("target", "first"), taken=("taken", "sum"), words=("source_size", "first"))
    assert abs(by.target.sum() - 1.5 * by.words.sum()) < 1e-6 * by.words.sum()
    assert (by.target <= 2 * by.words + 1e-9).all()
    big = by[by.words > 5000]
    assert ((big.taken - big.target).abs() <= 0.01 * big.target).all()


def test_rerun_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, "a", None), (None, None, None)], "doc_id long, text string, source string")
    first, again = (sorted(map(tuple, mix(d).select("doc_id", "size", "taken").collect()), key=str) for d in (docs, docs.repartition(3)))
    assert first == again
    assert mix(docs.limit(0)).collect() == []


def test_long_documents_do_not_end_a_source(spark):
    sizes = [5000] * 5 + [20] * 400
    docs = spark.createDataFrame([(d, "w " * n, "a") for d, n in enumerate(sizes)], "doc_id long, text string, source string").repartition(3)
    got = mix(docs, share=0.5).collect()
    assert abs(sum(x.taken for x in got) - 0.5 * sum(sizes)) <= 0.01 * 0.5 * sum(sizes)
    assert all(x.copies <= 1 for x in got)


def test_ties_do_not_move_a_source_off_its_target(spark):
    rows = [(None, "one two three four five", "a")] * 1000 + [(5, f"w {i} x y z", "b") for i in range(1000)] + [(None, f"w {i} x y z", None) for i in range(999)] + [(7, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    seen = []
    for d in (docs, docs.repartition(5)):
        got = mix(d).drop("m").collect()
        assert len(got) == len(rows)
        by = {}
        for x in got:
            t = by.setdefault(x.source, [x.target, 0])
            t[1] += x.taken
            assert x.copies <= 2
        assert all(abs(taken - target) <= 0.01 * target for target, taken in by.values()), by
        seen.append(sorted(map(str, got)))
    assert seen[0] == seen[1]


def test_inclusion_probabilities(spark):
    """Those returned meet the budget, and are how often documents come before the cut over many seeds."""
    r = random.Random(3)
    sizes = [r.choice([1, 4, 9, 25, 60, 150]) for _ in range(400)]
    docs = spark.createDataFrame([(d, "w " * n, "a") for d, n in enumerate(sizes)], "doc_id long, text string, source string")
    got = sorted((x.doc_id, x.inclusion, x.target) for x in mix(docs, share=0.4).collect())
    pi, size = np.array([x[1] for x in got]), np.array(sizes)
    assert abs((pi * size).sum() / got[0][2] - 1) < 0.01
    root, hits, seeds = np.sqrt(size + 1), np.zeros(len(size)), 1500
    for seed in range(seeds):
        u = np.array([(int(hashlib.md5(f"{seed}:{d}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52) for d in range(len(size))])
        order = np.argsort(u / (1 - u) / root)
        hits[order[np.cumsum(size[order]) <= got[0][2]]] += 1
    for n in set(sizes):
        assert abs(hits[size == n].mean() / seeds - pi[size == n].mean()) < 0.02
