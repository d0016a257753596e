"""Substring dedup by recompression: consistent interior symbols reveal repeated windows of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bounded_batches, materialize

#: Words that are analysed at once, in whole documents, and words whose names a worker remembers.
CHUNK_WORDS, REMEMBERED = 400_000, 1_000_000
_BASE = 0x9E3779B97F4A7C15
_known: dict[bytes, bytes] = {}


def word_names(words: list[bytes]) -> np.ndarray:
    """The XXH64 of each word: the name that it has in every document."""
    try:
        found = [_known[w] for w in words]
    except KeyError:
        if len(_known) > REMEMBERED:
            _known.clear()
        for w in words:
            if w not in _known:
                _known[w] = xxhash.xxh64_intdigest(w, 7).to_bytes(8, "little")
        found = [_known[w] for w in words]
    return np.frombuffer(b"".join(found), "<u8")


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A scramble of 64-bit numbers, one to one."""
    x = x + np.uint64(salt * _BASE & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RunHash:
    """Hashes of runs of words, the same wherever a run stands, from prefix sums of word names times powers."""

    def __init__(self, names: np.ndarray, salt: int):
        base = (_BASE * (2 * salt + 3) & (1 << 64) - 1) | 1
        up = np.full(len(names) + 1, np.uint64(base))
        down = np.full(len(names) + 1, np.uint64(pow(base, -1, 1 << 64)))
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(len(names) + 1, np.uint64)
        np.cumsum(mixed(names, salt + 1) * np.multiply.accumulate(up)[:-1], out=self.sums[1:])
        self.salt = salt

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start], self.salt) + (end - start).astype(np.uint64)


@dataclass
class Symbols:
    """Symbols of one level, in order: name, first word, and the words ``[lo, hi)`` that fix the symbol's existence.

    Two equal runs of words that hold all of ``[lo, hi)`` have the same symbol in the same place. Where the start or
    end of a document would decide, lo or hi lies outside of it.
    """

    name: np.ndarray
    at: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray

    def _beside(self, step: int, outside_lo: np.ndarray, outside_hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """lo and hi of each symbol's neighbour in its document."""
        lo, hi = np.roll(self.lo, -step), np.roll(self.hi, -step)
        none = np.roll(self.doc, -step) != self.doc
        none[-1 if step > 0 else 0] = True
        lo[none], hi[none] = outside_lo[self.doc[none]], outside_hi[self.doc[none]]
        return lo, hi


def compress_runs(s: Symbols, before: np.ndarray, after: np.ndarray) -> Symbols:
    """One symbol, named by what is repeated and how often, for each longest run of equal symbols."""
    first = np.ones(len(s.name), bool)
    first[1:] = (s.name[1:] != s.name[:-1]) | (s.doc[1:] != s.doc[:-1])
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(first)) - 1
    many = tails > heads
    name = s.name[heads].copy()
    name[many] = mixed(name[many] + (tails - heads)[many].astype(np.uint64) * np.uint64(_BASE), 11)
    left = s._beside(-1, before, before + 1)[0]
    right = s._beside(1, after - 1, after)[1]
    return Symbols(name, s.at[heads], np.minimum(s.lo[heads], left[heads]), np.maximum(s.hi[tails], right[tails]), s.doc[heads])


def compress_pairs(s: Symbols, before: np.ndarray, after: np.ndarray, salt: int) -> Symbols:
    """One symbol for each left-handed symbol and the right-handed one behind it; names decide the hand."""
    right = (mixed(s.name, 100 + salt) & np.uint64(1)).astype(bool)
    opens = np.zeros(len(right), bool)
    opens[:-1] = ~right[:-1] & right[1:] & (s.doc[1:] == s.doc[:-1])
    closes = np.roll(opens, 1)
    left_lo, _ = s._beside(-1, before, before + 1)
    _, right_hi = s._beside(1, after - 1, after)
    lo = np.where(~opens & right, np.minimum(s.lo, left_lo), s.lo)
    hi = np.where(opens | ~right, np.maximum(s.hi, right_hi), s.hi)
    name = s.name.copy()
    at = np.flatnonzero(opens)
    name[at] = mixed(s.name[at] * np.uint64(_BASE) + mixed(s.name[at + 1], 23), 29)
    lo[at] = np.minimum(s.lo[at], s.lo[at + 1])
    keep = ~closes
    return Symbols(name[keep], s.at[keep], lo[keep], hi[keep], s.doc[keep])


def _first_least(order: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each ``[start, end)`` that is not empty, the first index of its least ``order``."""
    best = np.arange(len(order))
    out = np.zeros(len(start), np.int64)
    length, step = end - start, 1
    while True:
        now = np.flatnonzero((length >= step) & (length < 2 * step))
        a, b = best[start[now]], best[end[now] - step]
        out[now] = np.where(order[b] < order[a], b, a)
        step *= 2
        if step > length.max(initial=0):
            return out
        half = step // 2
        a, b = best[: len(best) - half], best[half:]
        best = np.where(order[b] < order[a], b, a)


@dataclass
class Groups:
    """Runs of windows, by first window ``lo`` and last ``hi``, that have their least interior symbol in common."""

    lo: np.ndarray
    hi: np.ndarray
    doc: np.ndarray
    name: np.ndarray
    span: np.ndarray


def analyse(names: np.ndarray, offsets: np.ndarray, length: int, rounds: int) -> Groups:
    """Groups of the windows of ``length`` words of documents that lie one after another from ``offsets``.

    Each round names runs and then pairs of symbols. A window's interior symbols are those whose ``[lo, hi)`` it
    holds; the one with the least hash of those words is its anchor, so equal windows have equal anchors in equal
    places. A window without interior symbols is a group of its own, named by a second hash of its words. ``span`` names
    all words of the group's windows and the anchor's place in them.
    """
    n_docs = len(offsets) - 1
    sizes = np.diff(offsets)
    doc_of = np.repeat(np.arange(n_docs), sizes)
    at = np.arange(len(names))
    before, after = offsets[:-1] - 1, offsets[1:] + 1
    s = Symbols(names, at, at, at + 1, doc_of)
    for k in range(rounds):
        s = compress_pairs(compress_runs(s, before, after), before, after, k)
    starts = at[(offsets[1:][doc_of] - at) >= length]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Groups(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    run = RunHash(names, 0)
    fits = (s.lo >= offsets[s.doc]) & (s.hi <= offsets[s.doc + 1]) & (s.hi - s.lo <= length)
    s = Symbols(s.name[fits], s.at[fits], s.lo[fits], s.hi[fits], s.doc[fits])
    key = mixed(run(s.lo, s.hi) ^ mixed((s.at - s.lo).astype(np.uint64), 31))
    p, q = np.searchsorted(s.lo, starts), np.searchsorted(s.hi, starts + length, "right")
    inside = q > p
    anchor = np.full(len(starts), -1)
    if inside.any():
        anchor[inside] = _first_least(key, p[inside], q[inside])
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (doc_of[starts[1:]] != doc_of[starts[:-1]])
    heads = np.flatnonzero(new)
    lo, hi = starts[heads], starts[np.append(heads[1:], len(starts)) - 1]
    a = anchor[heads]
    span = run(lo, hi + length)
    has = a >= 0
    name = np.zeros(len(lo), np.uint64) if has.all() else RunHash(names, 3)(lo, hi + length)
    if inside.any():
        name[has] = key[a[has]]
        span[has] = mixed(span[has] ^ mixed((s.at[a[has]] - lo[has]).astype(np.uint64), 41))
    return Groups(lo, hi, doc_of[lo], name, span)


def _chunks(batches: Iterator[pa.RecordBatch], in_order: bool) -> Iterator[tuple[list[dict], list[list[bytes]], np.ndarray, np.ndarray]]:
    """Rows with their words, all words' names and the rows' offsets, for whole documents of about CHUNK_WORDS words."""

    def done(rows: list[dict]):
        if in_order:
            rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
        words = [r.pop("words") for r in rows]
        return rows, words, word_names([w for d in words for w in d]), np.cumsum([0, *map(len, words)])

    rows, n = [], 0
    for b in batches:
        columns = [b.column(i) for i in range(b.num_columns)]
        for i in range(b.num_rows):
            row = {name: column[i].as_py() for name, column in zip(b.schema.names, columns, strict=True)}
            row["words"] = (row.pop("text") or "").encode("utf-8", "surrogatepass").split()
            rows.append(row)
            n += len(row["words"])
            if n >= CHUNK_WORDS:
                yield done(rows)
                rows, n = [], 0
    if rows:
        yield done(rows)


def _first_of_each(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Index of the first of each different pair."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    return order[new]


_signed = lambda x: pa.array(np.ascontiguousarray(x).view(np.int64))


def _rows_of(ids: list, which: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64()).take(pa.array(which))


def first_groups(docs: DataFrame, length: int, rounds: int) -> DataFrame:
    """``doc_id, firsts``: by document the starts of the groups that no earlier group equals, and whether other groups share the anchor.

    Tasks send a row for each different group of a chunk, the earliest; so an anchor that any number of documents
    share costs a row a chunk, and a copied document nothing but its original's rows.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, names, offsets in _chunks(batches, in_order=True):
            g = analyse(names, offsets, length, rounds)
            first = _first_of_each(g.name, g.span)
            ids = _rows_of([r["doc_id"] for r in rows], g.doc[first])
            yield pa.RecordBatch.from_arrays([_signed(g.name[first]), _signed(g.span[first]), ids, pa.array((g.lo - offsets[g.doc])[first].astype(np.int32))], ["name", "span", "doc_id", "pos"])

    rows = docs.select("doc_id", "text").mapInArrow(found, "name long, span long, doc_id long, pos int").repartition("name")
    spans = rows.groupBy("name", "span").agg(F.min(F.struct("doc_id", "pos")).alias("first"))
    firsts = spans.select("first.*", (F.count("*").over(Window.partitionBy("name")) > 1).alias("shared"))
    return firsts.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "shared")).alias("firsts"))


def _marks(rows: list[dict], column: str, offsets: np.ndarray, size: int, where=lambda x: True) -> np.ndarray:
    out = np.zeros(size, bool)
    at = [offsets[i] + p for i, r in enumerate(rows) for p in where(r[column] or ())]
    out[np.array(at, np.int64)[np.array(at, np.int64) < size] if at else []] = True
    return out


def _judged(rows: list[dict], names: np.ndarray, offsets: np.ndarray, length: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Over all words: windows whose whole group is a repeat, and windows that must be compared by themselves."""
    g = analyse(names, offsets, length, rounds)
    first = _marks(rows, "firsts", offsets, len(names) + 1, lambda x: [f["pos"] for f in x])
    shared = _marks(rows, "firsts", offsets, len(names) + 1, lambda x: [f["pos"] for f in x if f["shared"]])
    repeat, open_ = np.zeros(len(names) + 1, np.int64), np.zeros(len(names) + 1, np.int64)
    for out, chosen in ((repeat, ~first[g.lo]), (open_, shared[g.lo])):
        np.add.at(out, g.lo[chosen], 1)
        np.add.at(out, g.hi[chosen] + 1, -1)
        np.cumsum(out, out=out)
    return repeat[:-1] > 0, open_[:-1] > 0


def first_windows(docs: DataFrame, firsts: DataFrame, length: int, rounds: int) -> DataFrame:
    """``doc_id, windows``: by document the starts of the windows in groups that share an anchor with other groups and that no earlier window equals."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, names, offsets in _chunks(batches, in_order=True):
            _, open_ = _judged(rows, names, offsets, length, rounds)
            at = np.flatnonzero(open_)
            one, two = RunHash(names, 1)(at, at + length), RunHash(names, 2)(at, at + length)
            first = _first_of_each(one, two)
            doc = np.searchsorted(offsets, at[first], "right") - 1
            ids = _rows_of([r["doc_id"] for r in rows], doc)
            yield pa.RecordBatch.from_arrays([_signed(one[first]), _signed(two[first]), ids, pa.array((at[first] - offsets[doc]).astype(np.int32))], ["one", "two", "doc_id", "pos"])

    open_ = firsts.where(F.exists("firsts", lambda f: f["shared"])).withColumnRenamed("doc_id", "_id")
    rows = docs.join(open_, docs["doc_id"].eqNullSafe(F.col("_id"))).select("doc_id", "text", "firsts").mapInArrow(found, "one long, two long, doc_id long, pos int")
    first = rows.groupBy("one", "two").agg(F.min(F.struct("doc_id", "pos")).alias("first")).select("first.*")
    return first.groupBy("doc_id").agg(F.collect_list("pos").alias("windows"))


def remove_repeats(docs: DataFrame, length: int = 20, rounds: int = 2) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of each row of ``docs(doc_id, text)``: its words without the repeated ones, space-joined.

    A word goes if it lies in a window of ``length`` words that also starts earlier: in a document of smaller doc_id
    or earlier in its own. Rounds of recompression give each window an anchor; equal groups of windows are found by
    the anchor and all their words, and only windows of groups that differ but share an anchor are compared one by
    one. All of it is exact but for chance agreement of hashes: 64 bits of a group's words among groups of the same
    anchor (whose own words another 64 bits name), 128 bits of a window's words where windows are compared one by one.

    Null texts have no words; documents of fewer than ``length`` words lose none; a null doc_id comes before all
    others; rows that repeat a doc_id are one document listed several times (windows at the same place of it are
    not earlier than each other). Other columns are ignored; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    firsts = materialize(first_groups(docs, length, rounds), "groups")
    windows = materialize(first_windows(docs, firsts, length, rounds), "windows")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, words, names, offsets in _chunks(batches, in_order=False):
            repeat, open_ = _judged(rows, names, offsets, length, rounds)
            repeat |= open_ & ~_marks(rows, "windows", offsets, len(names) + 1, lambda x: x)[:-1]
            gone = np.zeros(len(names) + 1, np.int64)
            at = np.flatnonzero(repeat)
            np.add.at(gone, at, 1)
            np.add.at(gone, at + length, -1)
            gone = np.cumsum(gone)[:-1] > 0
            texts, removed = [], []
            for i, w in enumerate(words):
                mask = gone[offsets[i] : offsets[i + 1]]
                removed.append(int(mask.sum()))
                texts.append(b" ".join([x for x, g in zip(w, mask.tolist(), strict=True) if not g] if removed[-1] else w).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array(np.diff(offsets).astype(np.int64)), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    f, w = firsts.withColumnRenamed("doc_id", "_f"), windows.withColumnRenamed("doc_id", "_w")
    joined = docs.join(f, docs["doc_id"].eqNullSafe(F.col("_f")), "left").join(w, docs["doc_id"].eqNullSafe(F.col("_w")), "left")
    return joined.select("doc_id", "text", "firsts", "windows").mapInArrow(kept, "doc_id long, n_words long, n_removed long, text string")


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op7_substring": op7_substring}
SQL = {
    "op7_substring": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
rep AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM rep, (SELECT unnest(range(20)) AS k)),
by_doc AS (
  SELECT doc_id, list(i) AS g FROM gone GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.i) AS t FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN by_doc USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
}
