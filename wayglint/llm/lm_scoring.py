"""LM scoring: stupid backoff from count tables partitioned by hash, each document left out of its own counts."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .substring import mixed, word_names

#: Words in a batch of documents at least and at most, and n-grams of a batch in a part of the hash space about at least
#: (as long as batches may grow).
BATCH_WORDS, MOST_WORDS, PIECE = 1_500_000, 4_000_000, 2_000
#: Texts whose words are objects at one time.
SLICE = 64
#: Factor of each step back, as published.
BACKOFF = 0.4

_PIECE = pa.schema([("part", pa.int32()), ("batch", pa.int32()), ("n", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _pack(x: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed; sorted ones are best given as differences."""
    planes = np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


class _Batch:
    """The n-grams of some documents: hashes of one to ``order`` words in a row, sorted, with their counts."""

    def __init__(self, texts: pa.ChunkedArray, order: int):
        # words are objects of some sixty bytes each, so only those of a few texts are there at a time
        sizes, names = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for first in range(0, len(texts), SLICE):
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts.slice(first, SLICE).to_pylist()]
            sizes.append(np.array([len(w) for w in words], np.int64))
            names.append(word_names([w for d in words for w in d]))
        words, self.sizes, names = None, np.concatenate(sizes), np.concatenate(names)
        self.doc = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        place = np.arange(len(names)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        # for each length, where in the batch an n-gram of it ends
        self.ends = [np.flatnonzero(place >= k).astype(np.int32) for k in range(order)]
        del place
        grams, so_far = [mixed(names, 51)], names
        for k in range(1, order):
            so_far = np.concatenate([np.zeros(1, np.uint64), mixed(so_far[:-1] * np.uint64(0x9E3779B97F4A7C15) + mixed(names[1:], 53), 53 + 4 * k)])[: len(names)]
            grams.append(so_far[self.ends[k]])
        cuts, grams, n_words = np.cumsum([len(g) for g in grams])[:-1], np.concatenate(grams), len(names)
        del names, so_far
        self.hashes, inverse, self.counts = np.unique(grams, return_inverse=True, return_counts=True)
        self.at = np.split(inverse.astype(np.int32), cuts)
        if n_words:  # hash zero stands for all words, so that their number is counted like an n-gram's
            self.hashes, self.counts = np.concatenate([np.zeros(1, np.uint64), self.hashes]), np.concatenate([[n_words], self.counts])
            self.at = [a + np.int32(1) for a in self.at]

    def part_of(self, parts: int) -> np.ndarray:
        """Which of so many equal stretches of the hash space each n-gram is in."""
        return ((self.hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)

    def _others(self, at: np.ndarray, doc: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """For each occurrence, how often its n-gram is in other documents."""
        _, inverse, own = np.unique(doc.astype(np.int64) * len(self.hashes) + at, return_inverse=True, return_counts=True)
        return totals[at] - own[inverse]

    def scores(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the log scores of each document's words, and how many of them had their pair in other documents."""
        n_docs, n_words = len(self.sizes), len(self.doc)
        seen = np.zeros(n_docs, np.int64)
        if not n_words:
            return np.zeros(n_docs), seen
        shorter = self._others(self.at[0], self.doc, totals).astype(float)
        all_others = (int(totals[0]) - self.sizes)[self.doc].astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(shorter > 0, np.log(shorter / all_others), np.log(BACKOFF / (all_others + 1)))
            for k, (ends, at) in enumerate(zip(self.ends[1:], self.at[1:], strict=True), 2):
                found = self._others(at, self.doc[ends], totals).astype(float)
                score[ends] = np.where(found > 0, np.log(found / shorter[ends - 1]), score[ends] + math.log(BACKOFF))
                shorter = np.zeros(n_words)
                shorter[ends] = found
                if k == 2:
                    seen = np.bincount(self.doc[ends], weights=found > 0, minlength=n_docs).astype(np.int64)
        return np.bincount(self.doc, weights=score, minlength=n_docs), seen


def backoff_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """``doc_id, n_words, n_pairs_seen, logprob, mean_logprob`` of each row of ``docs(doc_id, text)``.

    The model counts the n-grams of up to ``order`` words of all documents; each document is scored as if it were not
    among them. A word's score is c(n-gram) / c(n-gram without its last word) for the longest n-gram that ends in it, up
    to ``order``, if other documents have it; else 0.4 times the score of the next shorter one; that of the word alone is
    c(word) / words, and a word that no other document has counts 0.4 / (words + 1). Contexts end at the document's
    start. logprob sums the natural logarithms; mean_logprob is over the words (both 0 for a text without words, null
    texts included).

    Batches of documents send each of their different n-grams once, with its count, to the part of the hash space
    it is in, where the counts add up; the totals come back in the same order, and the batch sums them by document.
    So a word that is in every document costs a number a batch. Batches grow with the root of the corpus up to
    MOST_WORDS words, and parts are as many as batches, so a task's memory is bounded at every size (a document is
    whole in its batch). Repeated rows and rows of null doc_id are documents like any other; other columns
    are ignored; an empty table gives an empty result.
    """
    if order < 1:
        raise ValueError("the order is at least one")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = (rows.agg(F.sum(F.length("text"))).first()[0] or 0) / 6
    parts = max(1, math.ceil(words / max(BATCH_WORDS, min(MOST_WORDS, math.sqrt(words * PIECE)))))
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", F.length("text"), "text"), F.lit(parts)).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        b = _Batch(table.column("text"), order)
        cuts = np.searchsorted(b.part_of(parts), np.arange(parts + 1))
        filled = [(p, a, z) for p, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a]
        batch = table.column("batch")[0].as_py()
        return pa.Table.from_pydict({
            "part": [p for p, _, _ in filled], "batch": [batch] * len(filled), "n": [z - a for _, a, z in filled],
            "hashes": [_pack(np.diff(b.hashes[a:z], prepend=np.uint64(0))) for _, a, z in filled],
            "counts": [_pack(b.counts[a:z]) for _, a, z in filled],
        }, schema=_PIECE)

    def add_up(table: pa.Table) -> pa.Table:
        pieces = table.to_pylist()
        hashes = [np.cumsum(_unpack(p["hashes"], p["n"]), dtype=np.uint64) for p in pieces]
        _, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        totals = np.bincount(inverse, weights=np.concatenate([_unpack(p["counts"], p["n"]) for p in pieces])).astype(np.int64)[inverse]
        cuts = np.cumsum([0, *(p["n"] for p in pieces)])
        answers = [_pack(totals[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.Table.from_pydict({"batch": [p["batch"] for p in pieces], "part": [p["part"] for p in pieces], "n": [p["n"] for p in pieces], "totals": answers}, schema=_ANSWER)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        b = _Batch(table.column("text"), order)
        found = sorted(answers.to_pylist(), key=lambda a: a["part"])
        totals = np.concatenate([np.zeros(0, np.uint64), *[_unpack(a["totals"], a["n"]) for a in found]]).astype(np.int64)
        logprob, seen = b.scores(totals)
        return pa.Table.from_pydict({
            "doc_id": table.column("doc_id"), "n_words": b.sizes, "n_pairs_seen": seen, "logprob": logprob, "mean_logprob": logprob / np.maximum(b.sizes, 1),
        }, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_pairs_seen", pa.int64()), ("logprob", pa.float64()), ("mean_logprob", pa.float64())]))

    asked = rows.groupBy("batch").applyInArrow(ask, "part int, batch int, n int, hashes binary, counts binary")
    answered = asked.groupBy("part").applyInArrow(add_up, "batch int, part int, n int, totals binary")
    return rows.groupBy("batch").cogroup(answered.groupBy("batch")).applyInArrow(score, "doc_id long, n_words long, n_pairs_seen long, logprob double, mean_logprob double")


_ANSWER = pa.schema([("batch", pa.int32()), ("part", pa.int32()), ("n", pa.int32()), ("totals", pa.binary())])


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_words", "n_pairs_seen", F.round("mean_logprob", 6).alias("mean_logprob"))


QUERIES = {"op9_lm_scoring": op9_lm_scoring}
SQL = {
    "op9_lm_scoring": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
t AS (
  SELECT doc_id, i, w[i] AS c, CASE WHEN i > 1 THEN w[i - 1] END AS b FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
u AS (SELECT c, count(*) AS n FROM t GROUP BY c),
ud AS (SELECT doc_id, c, count(*) AS n FROM t GROUP BY doc_id, c),
p AS (SELECT b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY b, c),
pd AS (SELECT doc_id, b, c, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY doc_id, b, c),
s AS (
  SELECT t.doc_id, t.b IS NOT NULL AS paired, coalesce(p.n - pd.n, 0)::DOUBLE AS cp, (ub.n - udb.n)::DOUBLE AS cb, (u.n - ud.n)::DOUBLE AS cc,
         ((SELECT count(*) FROM t) - len(d.w))::DOUBLE AS n
  FROM t JOIN d USING (doc_id) JOIN u ON t.c = u.c JOIN ud ON t.doc_id = ud.doc_id AND t.c = ud.c
  LEFT JOIN p ON t.b = p.b AND t.c = p.c LEFT JOIN pd ON t.doc_id = pd.doc_id AND t.b = pd.b AND t.c = pd.c
  LEFT JOIN u ub ON t.b = ub.c LEFT JOIN ud udb ON t.doc_id = udb.doc_id AND t.b = udb.c),
l AS (
  SELECT doc_id, cp > 0 AS seen,
         CASE WHEN cp > 0 THEN ln(cp / cb) ELSE CASE WHEN paired THEN ln(0.4::DOUBLE) ELSE 0 END + CASE WHEN cc > 0 THEN ln(cc / n) ELSE ln(0.4::DOUBLE / (n + 1)) END END AS x
  FROM s)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(g.k, 0)::BIGINT AS n_pairs_seen, round(coalesce(g.x, 0) / greatest(len(d.w), 1), 6) AS mean_logprob
FROM d LEFT JOIN (SELECT doc_id, count(*) FILTER (seen) AS k, sum(x) AS x FROM l GROUP BY doc_id) g USING (doc_id)
"""
}
