import math
import random
import zlib

import numpy as np

from wayglint.llm.rule_ensemble import STATISTICS, Rule, accept, classify, fit, statistics


def corpus(n=400):
    r = random.Random(4)
    rows, labels = [], []
    for d in range(n):
        words = [r.choice(["the", "of", "and"]) if r.random() < 0.3 else "".join(r.choices("aeinrst", k=r.randint(3, 8))) for _ in range(r.randint(20, 200))]
        bad = d % 5 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if d % 2 else [r.choice(words[:3])] * len(words)
        rows.append((d, " ".join(words) + "."))
        labels.append((d, int(not bad)))
    return rows, labels


def test_held_out_accuracy_and_keys(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(d, t, "x", 0.5) for d, t in rows] + [(None, "some text here", "x", 0.5), (3, None, "x", 0.5)], "doc_id long, text string, words string, score double")
    held = [(d, 1 - q) if zlib.crc32(str(d).encode()) % 4 == 2 else (d, q) for d, q in labels]
    table = spark.createDataFrame([*held, (None, 1), (7, None)], "doc_id long, quality int")
    got = classify(docs, table).collect()
    assert len(got) == len(rows) + 2
    truth = dict(labels)
    hits = [x.predicted == truth[x.doc_id] for x in got if x.held_out and x.doc_id != 3]
    assert sum(hits) >= 0.95 * len(hits) > 0
    for x in got:
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2)
        assert 0 <= x.score <= 1 and x.predicted == (x.score >= 0.7)
    kept = accept(docs, table)
    assert kept.columns == docs.columns
    assert kept.count() == sum(x.predicted for x in got)


def test_rules_compile_to_what_they_hold(spark):
    rows, labels = corpus(120)
    x = statistics(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").toPandas().sort_values("doc_id")
    y = np.array([q for _, q in labels], float)
    model = fit(x[list(STATISTICS)].to_numpy(float), y)
    assert 0 < len(model.rules) < 60
    by_hand = model.intercept + sum(r.weight * r.holds(x[list(STATISTICS)].to_numpy(float)) for r in model.rules)
    frame = statistics(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id")
    got = {r.doc_id: r.s for r in frame.select("doc_id", model.column().alias("s")).collect()}
    for (d, _), z in zip(rows, by_hand, strict=True):
        assert math.isclose(got[d], 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_degenerate_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert classify(docs, none).first().score == 0.5
    assert classify(docs.limit(0), none).collect() == []
    assert fit(np.zeros((5, len(STATISTICS))), np.ones(5)).rules == ()
    assert Rule(((0, True, 1.0),)).holds(np.array([[2.0], [1.0]])).tolist() == [True, False]
