"""Quality classifier: a sparse rule ensemble over text statistics, compiled to Spark columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_side, words_of

#: Labelled rows that a fit uses at most, those of the least hash; the driver holds their statistics.
SAMPLE_ROWS = 6_000
#: Score from which a document is predicted good.
CUT = 0.7

STATISTICS = (
    "words", "mean_word", "longest_word", "distinct_words", "repeated_next", "words_a_line", "distinct_lines",
    "upper", "digits", "symbols", "bars", "marks", "exclamations", "stops", "symbol_words", "pairs",
)


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and a column of type double for each of STATISTICS, from ``docs.text`` alone; null counts as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(*keep, text.alias("_t"), words_of(text).alias("_w"))
    d = d.select(*keep, "_t", "_w", F.size("_w").cast("double").alias("_n"), F.greatest(F.length("_t"), F.lit(1)).cast("double").alias("_c"), F.filter(F.split("_t", "\n"), lambda x: F.length(x) > 0).alias("_l"))
    a_word, a_line = F.greatest("_n", F.lit(1.0)), F.greatest(F.size("_l"), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count("_t", F.lit(pattern)) / F.col("_c")
    next_same = F.size(F.filter(F.zip_with(F.slice("_w", 2, 1 << 30), "_w", lambda x, y: x == y), lambda x: F.coalesce(x, F.lit(False))))
    return d.select(
        *keep,
        F.col("_n").alias("words"),
        (F.length(F.array_join("_w", "")) / a_word).alias("mean_word"),
        F.coalesce(F.aggregate("_w", F.lit(0), lambda s, w: F.greatest(s, F.length(w))), F.lit(0)).cast("double").alias("longest_word"),
        (F.size(F.array_distinct("_w")) / a_word).alias("distinct_words"),
        (next_same / a_word).alias("repeated_next"),
        (F.col("_n") / a_line).alias("words_a_line"),
        (F.size(F.array_distinct("_l")) / a_line).alias("distinct_lines"),
        share(r"\p{Lu}").alias("upper"),
        share("[0-9]").alias("digits"),
        share("[#*$%&<>@~^]").alias("symbols"),
        share(r"\|").alias("bars"),
        share("[.,;:?]").alias("marks"),
        share("!").alias("exclamations"),
        share(r"[.?] ").alias("stops"),
        (F.regexp_count("_t", F.lit(r"[^\p{L}\p{N}\x20\x09-\x0D.,;:?'\"-](?=[\x20\x09-\x0D]|$)")) / a_word).alias("symbol_words"),
        (F.regexp_count("_t", F.lit(r"([#*$%&<>!|])\1")) / a_word).alias("pairs"),
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, is above, threshold)``, and its weight in the score."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for j, above, at in self.terms:
            out &= (x[:, j] > at) == above
        return out

    def column(self) -> Column:
        cond = F.lit(True)
        for j, above, at in self.terms:
            c = F.col(STATISTICS[j])
            cond = cond & (c > F.lit(at) if above else c <= F.lit(at))
        return F.when(cond, F.lit(self.weight)).otherwise(F.lit(0.0))


def _best_split(x: np.ndarray, g: np.ndarray, columns: np.ndarray, least: int) -> tuple[int, float] | None:
    best, found = 1e-12, None
    total, n = g.sum(), len(g)
    for j in columns:
        order = np.argsort(x[:, j], kind="stable")
        v = x[order, j]
        left = np.cumsum(g[order])[:-1]
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
        if not ok.any():
            continue
        gain = np.where(ok, left**2 / k + (total - left) ** 2 / (n - k), -np.inf) - total**2 / n
        i = int(gain.argmax())
        if gain[i] > best:
            best, found = gain[i], (int(j), float((v[i] + v[i + 1]) / 2))
    return found


def _tree_paths(x: np.ndarray, g: np.ndarray, rng: np.random.Generator, depth: int, least: int, terms: tuple = ()) -> list[tuple[tuple, float, np.ndarray]]:
    """``(path, mean of g, rows)`` of each node below the root of a tree that is fit to ``g`` by squares."""
    if depth == 0 or len(g) < 2 * least:
        return []
    columns = rng.permutation(x.shape[1])[: max(4, x.shape[1] // 2)]
    if (split := _best_split(x, g, columns, least)) is None:
        return []
    j, at = split
    out = []
    for above in (False, True):
        rows = np.flatnonzero((x[:, j] > at) == above)
        path = (*terms, (j, above, at))
        out.append((path, float(g[rows].mean()), rows))
        out += [(p, m, rows[r]) for p, m, r in _tree_paths(x[rows], g[rows], rng, depth - 1, least, path)]
    return out


def _lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 1500) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise the mean logistic loss plus ``penalty`` times the weights' absolute sum (FISTA)."""
    n, k = r.shape
    ones = r.sum(axis=0)
    gram = np.block([[np.array([[float(n)]]), ones[None, :]], [ones[:, None], r.T @ r]])
    step = 4.0 / max(1e-9, np.linalg.eigvalsh(gram)[-1] / n)
    w, z, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z[0] + r @ z[1:], -40, 40)))
        grad = np.concatenate([[np.mean(p - y)], r.T @ (p - y) / n])
        new = z - step * grad
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        done = np.abs(new - w).max() < 1e-7
        w, t = new, t_new
        if done:
            break
    return float(w[0]), w[1:]


@dataclass(frozen=True)
class RuleEnsemble:
    """A score: the logistic function of an intercept and the weights of the rules that hold."""

    intercept: float
    rules: tuple[Rule, ...]

    def column(self) -> Column:
        total = F.lit(self.intercept)
        for r in self.rules:
            total = total + r.column()
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 4e-4, seed: int = 11) -> RuleEnsemble:
    """Boosted trees on halves of the rows give paths, each a rule; lasso logistic regression keeps the few it needs.

    Without rows the score is one half, with one class only it is that class's smoothed share.
    """
    n, good = len(y), float(y.sum())
    prior = (good + 1) / (n + 2)
    if good in (0.0, float(n)):
        return RuleEnsemble(math.log(prior / (1 - prior)), ())
    rng = np.random.default_rng(seed)
    f = np.full(n, math.log(prior / (1 - prior)))
    paths: dict[tuple, None] = {}
    for _ in range(trees):
        rows = np.sort(rng.permutation(n)[: max(2, n // 2)])
        g = y - 1 / (1 + np.exp(-f))
        nodes = _tree_paths(x[rows], g[rows], rng, depth, max(2, n // 400))
        for path, mean, _ in nodes:
            paths[tuple(sorted(path))] = None
            if not any(p != path and p[: len(path)] == path for p, _, _ in nodes):
                f += np.where(Rule(path).holds(x), 2.0 * mean, 0.0)
    held: dict[bytes, Rule] = {}
    for path in paths:
        held.setdefault(np.packbits(Rule(path).holds(x)).tobytes(), Rule(path))
    rules = list(held.values())
    r = np.column_stack([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b in held]).astype(float) if held else np.zeros((n, 0))
    intercept, weights = _lasso_logistic(r, y, penalty)
    return RuleEnsemble(round(intercept, 6), tuple(Rule(rule.terms, round(float(w), 6)) for rule, w in zip(rules, weights, strict=True) if abs(w) > 1e-4))


def held_out(doc_id: Column) -> Column:
    """Rows of the third of four folds by crc32 of the doc_id's digits; no label of theirs is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Fits on at most ``most`` labelled rows outside the held-out fold, those of the least hash of doc_id.

    Labels that are null, neither 0 nor 1, or contradict each other for a doc_id are not used.
    """
    usable = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
    agreed = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z").select("doc_id", "y")
    sample = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small_side(sample, most), "doc_id")
    one = statistics(rows, "doc_id", "y").groupBy("doc_id", "y").agg(F.min(F.struct(*STATISTICS)).alias("x")).select("doc_id", "y", "x.*")
    table = one.toArrow().sort_by("doc_id")
    return fit(np.column_stack([table[c].to_numpy() for c in STATISTICS]).astype(float), table["y"].to_numpy().astype(float))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs``, from the statistics of its whole text only.

    Null, empty and blank texts are scored like others, by statistics of zero; a null doc_id is not held out; rows
    that repeat a doc_id are scored each by its own text. Other columns of either table are ignored.
    """
    model = train(docs, labels)
    scored = statistics(docs, "doc_id").select("doc_id", model.column().alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def accept(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``, with the columns of ``docs``."""
    model = train(docs, labels)
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = statistics(docs.select(kept, F.col("text").alias("text")), "_row")
    return rows.where(model.column() >= cut).select("_row.*")


def op2_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op2_rule_ensemble": op2_rule_ensemble}
SQL: dict[str, str] = {}
