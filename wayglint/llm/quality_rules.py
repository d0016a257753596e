"""Quality rules: counts of a text, and the log-likelihood ratio of its hashed n-grams. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_side, words_of

#: Buckets that words and word pairs are hashed to; the model is one number a bucket, so its size is fixed.
BUCKETS = 1 << 15
#: N-grams that each bucket is taken to have had before, as many of them in the target as its share of all.
PRIOR = 8.0
#: Standard deviations below the mean score of trusted texts at which the verdict cuts: by Chebyshev's inequality at most
#: 1 in 36 of texts like them falls below, whatever the distribution.
SPREADS = 6.0
#: Nats per n-gram for the cut where fewer than two trusted texts give no spread.
THRESHOLD = -0.2
#: Fixed rules of the base verdict.
MIN_WORDS, MAX_REPEATED_PERCENT, SYMBOLS = 10, 20, "#*$%&|<>"


def _buckets(hashes: Column, n: Column, buckets: int) -> Column:
    """The bucket of each word, and of each pair of neighbours, from the words' hashes."""
    one = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    two = F.when(n >= 2, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.pmod(F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)), F.lit(buckets)).cast("int")))
    return F.concat(one, F.coalesce(two, F.array().cast("array<int>")))


def _hashed(text: Column, keep: list[Column], docs: DataFrame) -> DataFrame:
    """``keep``, the text's words and their hashes, each computed once."""
    d = docs.select(*keep, words_of(text).alias("w"))
    return d.select(*[F.col(c) for c in d.columns], F.size("w").alias("n"), F.transform("w", lambda w: F.xxhash64(w)).alias("h"))


def _trusted(trusted: DataFrame) -> DataFrame:
    return small_side(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).dropna().distinct().withColumn("trusted", F.lit(1)))


def _mean_ratio(ratio: list[float]) -> Column:
    """The mean of ``ratio`` over the words and pairs of ``h, n``; 0 without words."""
    table = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    total = F.aggregate(_buckets(F.col("h"), F.col("n"), len(ratio)), F.lit(0.0), lambda s, b: s + F.get(table, b))
    return F.when(F.col("n") > 0, total / (2 * F.col("n") - 1)).otherwise(F.lit(0.0))


def fit_ratio(docs: DataFrame, ids: DataFrame, buckets: int = BUCKETS) -> tuple[list[float], list[float]]:
    """ln(p_target / p_raw) of each bucket; p_raw of all of ``docs``, p_target of those in ``ids(doc_id, trusted)``.

    The second list has the same with one n-gram of each bucket's target taken off: what a trusted text would meet
    if it were not trusted. Each bucket gets PRIOR n-grams more, in the target its share of them, so that rare ones say little.

    One pass over the texts, in which each task sends a row a bucket at most. The driver gets ``buckets`` rows.
    """
    rows = docs.select("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).join(ids, "doc_id", "left")
    h = _hashed(F.col("text"), [F.coalesce("trusted", F.lit(0)).alias("t")], rows)
    counts = h.select("t", F.explode(_buckets(F.col("h"), F.col("n"), buckets)).alias("b")).groupBy("b").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    total = {r.b: (r.raw, r.target) for r in counts.collect()}
    raw, target = sum(x for x, _ in total.values()), sum(x for _, x in total.values())
    if not target:
        return [0.0] * buckets, [0.0] * buckets
    share = target / raw
    of = [total.get(b, (0, 0)) for b in range(buckets)]
    log = lambda r, t: math.log((t + PRIOR * share) / (r + PRIOR)) - math.log(share)
    return [log(r, t) for r, t in of], [log(r, max(t - 1, 0)) for r, t in of]


def fit_threshold(docs: DataFrame, ids: DataFrame, held: list[float]) -> float:
    """SPREADS standard deviations below the mean of what trusted texts would score if they were not trusted.

    Scores shrink as more n-grams share a bucket, and their spread with them, so the cut follows the corpus's size.
    Texts of fewer than MIN_WORDS words, which fail anyway, have no say. One row reaches the driver.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
    scored = _hashed(F.col("text"), [], rows).where(F.col("n") >= MIN_WORDS).select(_mean_ratio(held).alias("llr"))
    mean, spread = scored.agg(F.avg("llr"), F.stddev("llr")).first()
    return THRESHOLD if spread is None else mean - SPREADS * spread


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``w, n, h`` and the base counts of each row of ``docs``.

    Windows of five words that a text repeats are found only where it has fewer different windows than windows;
    they are sorted, not paired, so that one very long text costs little more than many short ones.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = _hashed(text, [*[F.col(c) for c in keep], text.alias("_text")], docs)
    window = F.transform(F.sequence(F.lit(0), F.col("n") - 5), lambda i: F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(5)]))
    d = d.withColumn("_win", F.when(F.col("n") >= 5, window).otherwise(F.array().cast("array<long>")))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.withColumn("_lines", lines)
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    d = d.withColumn("_by_hash", F.when(repeats, F.array_sort(F.transform("_win", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    same = lambda x, i, k: F.get(F.col("_by_hash"), i + k)["h"].eqNullSafe(x["h"])
    at = F.transform(F.filter("_by_hash", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])
    d = d.withColumn("_at", F.array_sort(at))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).cast("long").alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(5).cast("long"), i - s["last"])).alias("n"), i.cast("long").alias("last")),
        lambda s: s["n"],
    )
    return d.select(
        *keep, "w", "n", "h",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, llr, base_failed, kept`` of each row.

    llr is the sum of ln(p_target / p_raw) over the text's hashed words and word pairs, over their number (0 for a
    text of no words, and everywhere if no document is trusted). A document is kept if it passes the base rules
    (at least 10 words, at most 20 % of them in repeated windows) and its llr is at least ``threshold``, by
    default that of ``fit_threshold``. Null texts count as empty; rows of null doc_id and repeated rows are scored like any other; other columns are ignored.
    """
    ids = _trusted(trusted)
    ratio, held = fit_ratio(docs, ids, buckets)
    if threshold is None:
        threshold = fit_threshold(docs, ids, held)
    d = base_counts(docs.select("doc_id", "text"), ["doc_id"])
    d = d.withColumn("llr", _mean_ratio(ratio))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", failed.alias("base_failed"), (~failed & (F.col("llr") >= threshold)).alias("kept")
    )


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), trusted)


QUERIES = {"op1_quality_rules": op1_quality_rules}
SQL: dict[str, str] = {}
