import math
import random
import tracemalloc
from collections import Counter

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

from wayglint.llm import lm_scoring
from wayglint.llm.lm_scoring import SQL, backoff_scores


@pytest.mark.parametrize("words_a_batch", [1_500_000, 300])
def test_matches_sql(spark, monkeypatch, words_a_batch):
    monkeypatch.setattr(lm_scoring, "BATCH_WORDS", words_a_batch)
    monkeypatch.setattr(lm_scoring, "PIECE", 1)
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(d, r.choice([" ", "\n", "  "]).join(r.choices(vocabulary, weights=[1 / (i + 1) for i in range(60)], k=r.randint(0, 60)))) for d in range(200)]
    rows += [(300, None), (301, ""), (302, "only here"), (303, "w0 w0 w0 w0"), (304, "é w1 " * 900)]
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])
    docs = spark.createDataFrame([(*x, "b", 3) for x in rows], "doc_id long, text string, batch string, part int")
    got = {x.doc_id: (x.n_words, x.n_pairs_seen, x.mean_logprob) for x in backoff_scores(docs).collect()}
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(SQL["op9_lm_scoring"]).fetchall()
    assert len(got) == len(want) == len(rows)
    for d, n, seen, mean in want:
        assert got[d][:2] == (n, seen)
        assert abs(got[d][2] - mean) < 2e-6


def test_empty_null_and_repeated(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert backoff_scores(docs.limit(0)).collect() == []
    assert sorted(x.n_pairs_seen for x in backoff_scores(docs).collect()) == [1, 1, 1]


def slow(texts, order):
    """Sum of log scores of each text by the definition, counting the other texts anew each time."""
    docs, out = [(t or "").split() for t in texts], []
    grams = lambda w: Counter(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
    every, words = sum((grams(w) for w in docs), Counter()), sum(map(len, docs))
    for w in docs:
        c, n = every - grams(w), words - len(w)

        def score(g, c=c, n=n):
            if len(g) == 1:
                return c[g] / n if c[g] else 0.4 / (n + 1)
            return c[g] / c[g[:-1]] if c[g] else 0.4 * score(g[1:])

        out.append(sum(math.log(score(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_match_the_definition(spark, monkeypatch, order):
    monkeypatch.setattr(lm_scoring, "BATCH_WORDS", 60)
    monkeypatch.setattr(lm_scoring, "MOST_WORDS", 60)
    r = random.Random(order)
    texts = [" ".join(r.choices("abcde", k=r.randint(0, 25))) for _ in range(40)] + [None, "", "zz", "a b c d e a b c d e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.logprob for x in lm_scoring.backoff_scores(docs, order).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(slow(texts, order))


def test_a_batch_holds_the_words_of_few_texts_at_a_time():
    """Peak of Python's memory over 1.5 million words, where the words' objects alone would be over 80 MB."""
    texts = pa.chunked_array([pa.array([" ".join(f"w{(i * j) % 5000}" for j in range(1500)) for i in range(1000)])])
    lm_scoring._Batch(texts.slice(0, 100), 2)
    tracemalloc.start()
    b = lm_scoring._Batch(texts, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert b.sizes.sum() == 1_500_000 and b.counts.sum() == 3 * 1_500_000 - 1000  # all words, words, pairs
    assert peak < 250e6
