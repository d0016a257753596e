"""Secret scans: fixed patterns, and sliding-window entropy of long strings. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds, in the order in which equal starts are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"[0-9a-f]{32,}+"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
ASSIGN_VALUE = 8


@dataclass(frozen=True)
class CharClass:
    """A class of characters, and the bits per character from which a window of it looks random."""

    kind: str
    alphabet: str
    pattern: str
    bits: float


DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 20
CLASSES = (
    CharClass("entropy_hex", DIGITS + "abcdefABCDEF", r"[0-9a-fA-F]{20,}+", 3.1),
    CharClass("entropy_base64", DIGITS + UPPER + LOWER + "+/_=-", r"[A-Za-z0-9+/_=-]{20,}+", 3.9),
)
#: Candidates that are no secrets by their shape (words and names, numbers, UUIDs), and stretches that hold documented examples.
ALLOW_SHAPE = r"^[A-Za-z_/=+-]+$|^[0-9_/=+-]+$|^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
ALLOW_EXAMPLE = r"(?i:example|xxxx|0123456789|abcdefghij)"
#: Sums that are carried along in one go; n of them take about n * STRIDE / 2 steps of copying.
STRIDE = 256
#: Bits a character's count takes in a packed word, and counts in one.
COUNT_BITS, PACKED = 5, 12


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(values: Column) -> Column:
    return F.aggregate(values, F.array().cast("array<bigint>"), lambda done, x: F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + x)))


def running_sums(values: Column) -> Column:
    """The sum of ``values`` (longs) up to each one; stretches of STRIDE are summed alone, then moved by what lies before."""

    def moved(scans: Column) -> Column:
        totals = _scan(F.transform(scans, lambda a: F.get(a, F.size(a) - 1)))
        return _let(totals, lambda t: F.flatten(F.transform(scans, lambda a, i: F.transform(a, lambda x: x + F.coalesce(F.get(t, i - 1), F.lit(0))))))

    cut = lambda v: F.transform(F.sequence(F.lit(0), F.size(v) - 1, F.lit(STRIDE)), lambda at: _scan(F.slice(v, at + 1, F.lit(STRIDE))))
    return _let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(_let(cut(v), moved)))


def _spans(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of the matches, from the lengths of what lies between them (code points)."""
    all_, values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    length = lambda x: F.length(x).cast("bigint")
    widths = F.transform(all_, length)
    steps = lambda w: F.zip_with(F.slice(F.transform(F.split(text, pattern, -1), length), F.lit(1), F.size(w)), w, lambda a, b: a + b)
    of = lambda m: F.transform(m["values"], lambda v, i: F.struct((F.get(m["ends"], i) - F.get(m["widths"], i)).alias("start"), F.get(m["ends"], i).alias("end"), v.alias("value")))
    found = _let(widths, lambda w: _let(F.struct(w.alias("widths"), running_sums(steps(w)).alias("ends"), values.alias("values")), of))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))


def _outside(runs: Column, taken: Column, least: int) -> Column:
    """What of ``runs`` (disjoint, in order) no span of ``taken`` covers, in pieces of ``least`` characters or more.

    Starts and ends of both are sorted together; running sums tell how many of each are open behind every one.
    """
    event = lambda at, run, span: F.struct(at.alias("at"), F.lit(run).cast("bigint").alias("run"), F.lit(span).cast("bigint").alias("span"))
    events = F.array_sort(F.concat(
        F.transform(runs, lambda s: event(s["start"], 1, 0)), F.transform(runs, lambda s: event(s["end"], -1, 0)),
        F.transform(taken, lambda s: event(s["start"], 0, 1)), F.transform(taken, lambda s: event(s["end"], 0, -1)),
    ))
    open_ = lambda e: F.struct(
        e["at"].alias("at"), running_sums(e["run"]).alias("run"), running_sums(e["span"]).alias("span"),
        running_sums(F.transform(e["run"], lambda r: F.greatest(r, F.lit(0)))).alias("nth"),
    )

    def pieces(o: Column) -> Column:
        free = F.filter(F.sequence(F.lit(0), F.size(o["at"]) - 2), lambda i: (F.get(o["run"], i) > 0) & (F.get(o["span"], i) == 0) & (F.get(o["at"], i + 1) - F.get(o["at"], i) >= least))
        return F.transform(free, lambda i: _let(F.get(runs, (F.get(o["nth"], i) - 1).cast("int")), lambda r: _cut(r, F.get(o["at"], i), F.get(o["at"], i + 1))))

    return F.when((F.size(runs) == 0) | (F.size(taken) == 0), runs).otherwise(_let(events, lambda e: _let(open_(e), pieces)))


def _cut(run: Column, start: Column, end: Column) -> Column:
    value = run["value"].substr((start - run["start"] + 1).cast("int"), (end - start).cast("int"))
    return F.struct(start.alias("start"), end.alias("end"), value.alias("value"))


def _times_log(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def hot_range(value: Column, of: CharClass, window: int = WINDOW) -> Column:
    """``struct<first, last>``: from the first to behind the last window of ``value`` that reaches the class's bits.

    Counts of the window's characters are carried along, packed into a few whole numbers; each step adds one to the
    count of the character that enters, takes one off that of the one that leaves, and changes the sum of
    count * log2(count) by their terms only. first is -1 if no window reaches the bits.
    """
    if window >= 1 << COUNT_BITS:
        raise ValueError("a window's counts must fit their bits")
    words = -(-len(of.alphabet) // PACKED)
    places = F.transform(F.split(value, ""), lambda c: (F.position(c, F.lit(of.alphabet)) - 1).cast("int"))
    init = F.struct(*[F.lit(0).cast("bigint").alias(f"w{k}") for k in range(words)], F.lit(0.0).alias("sum"), F.lit(0).alias("i"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    shift = lambda c: (c % PACKED) * COUNT_BITS
    word = lambda c: F.floor(c / PACKED).cast("int")

    def count(s: Column, c: Column) -> Column:
        held = F.get(F.array(*[s[f"w{k}"] for k in range(words)]), word(c))
        return F.call_function("shiftright", held, shift(c)).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))

    def moved(s: Column, c: Column, out: Column) -> Column:
        """The state after ``c`` came in, and after ``out``, if it isn't null, went."""
        n_in, n_out = count(s, c), count(s, out)
        less = F.when(out.isNotNull(), _times_log(n_out - 1) - _times_log(n_out)).otherwise(F.lit(0.0))
        total = F.when(out.eqNullSafe(c), s["sum"]).otherwise(s["sum"] - _times_log(n_in) + _times_log(n_in + 1) + less)
        one = F.lit(1).cast("bigint")
        step = lambda k: s[f"w{k}"] + F.when(word(c) == k, F.call_function("shiftleft", one, shift(c))).otherwise(F.lit(0)) - F.when(word(out) == k, F.call_function("shiftleft", one, shift(out))).otherwise(F.lit(0))
        return F.struct(*[step(k).alias(f"w{k}") for k in range(words)], total.alias("sum"), s["i"].alias("i"), s["first"].alias("first"), s["last"].alias("last"))

    def judged(s: Column) -> Column:
        hot = (s["i"] >= window - 1) & (F.round(F.log2(F.lit(float(window))) - s["sum"] / window, 9) >= of.bits)
        first = F.when(hot & (s["first"] < 0), s["i"] - (window - 1)).otherwise(s["first"])
        return F.struct(*[s[f"w{k}"].alias(f"w{k}") for k in range(words)], s["sum"].alias("sum"), (s["i"] + 1).alias("i"), first.alias("first"), F.when(hot, s["i"] + 1).otherwise(s["last"]).alias("last"))

    step = lambda p: lambda s, c: _let(moved(s, c, F.get(p, s["i"] - window)), judged)
    return _let(places, lambda p: F.aggregate(p, init, step(p), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))))


def _random(pieces: Column, of: CharClass) -> Column:
    """``array<struct<start, kind, end>>``: the random stretch of each piece that has one, but for those on the allow-list."""
    hot = lambda s: _let(hot_range(s["value"], of), lambda h: F.when(h["first"] >= 0, _cut(s, s["start"] + h["first"], s["start"] + h["last"])))
    stretches = F.transform(F.filter(pieces, lambda s: ~s["value"].rlike(ALLOW_SHAPE)), hot)
    kept = F.filter(stretches, lambda s: s.isNotNull() & ~s["value"].rlike(ALLOW_SHAPE) & ~s["value"].rlike(ALLOW_EXAMPLE))
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(of.kind)).alias("kind"), s["end"].alias("end")))


def _for_class(of: CharClass):
    return lambda pieces: _random(pieces, of)


def _listed(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_spans, all_spans`` of each row; spans are ``struct<start, kind, end>``.

    Spans count code points from 0, ends exclusive, and are sorted by start and kind. Base kinds are leftmost and
    non-overlapping each; assignments of fewer than 8 characters are dropped after matching. The entropy kinds add to
    them: runs of 20 or more characters of a class, less what base spans (and for base64, hex stretches) cover of them,
    give the stretch from the first to the last of their windows of 20 that reach the class's bits, unless the shape of
    the run or stretch, or an example in the stretch, is on the allow-list. Null and empty texts have no spans; a text
    may be of any length and hold any number of matches, at about the same cost each; null doc_ids and repeated rows
    are scanned like any other; an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", text.alias("_text"))
    d = d.select("doc_id", _spans(F.col("_text"), ASSIGN, 2).alias("assign"), _spans(F.col("_text"), ACCESS).alias("access"), _spans(F.col("_text"), HEX).alias("hex"), *[_spans(F.col("_text"), c.pattern).alias(c.kind) for c in CLASSES])
    d = d.withColumn("assign", F.filter("assign", lambda s: F.length(s["value"]) >= ASSIGN_VALUE))
    shaped = lambda name: F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(name)).alias("kind"), s["end"].alias("end")))
    d = d.withColumn("base", F.array_sort(F.concat(shaped("assign"), shaped("access"), shaped("hex"))))
    taken = F.col("base")
    for c in CLASSES:
        new = _let(_outside(F.col(c.kind), taken, WINDOW), _for_class(c))
        d = d.withColumn(f"_all_{c.kind}", F.when(F.size(c.kind) == 0, taken).otherwise(F.concat(taken, new)))
        taken = F.col(f"_all_{c.kind}")
    n = lambda name: F.size(name).cast("long").alias(f"n_{name}")
    return d.select("doc_id", n("assign"), n("access"), n("hex"), F.col("base").alias("base_spans"), F.array_sort(taken).alias("all_spans"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"), _listed(F.col("all_spans")).alias("spans"))


QUERIES = {"op10_secrets": op10_secrets}
SQL: dict[str, str] = {}
