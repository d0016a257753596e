"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, small_side, words_of

#: Ranks are 52-bit numbers, searched in steps of so many bits; a step's bins per source are bounded by 2 ** bits.
RANK_BITS, STEP_BITS = 52, 12
#: Documents at most that close the gap between a source's ordered sample and its target.
CLOSING = 3
#: Share of its target by which a source may miss it before its order goes on past documents that do not fit.
MISS = 0.01


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``sizes(src, source, source_size)``, a row a source, with its ``target`` in words.

    Sources by code point, null last, weigh ``weights`` in turn. Targets are in proportion to the weights and sum
    to ``share`` of all words, but none is above ``most`` times its source's words: with sources in the order in
    which they reach that limit, the level (words per weight) is that of the first prefix held at its limits
    which leaves the next source below its own, the highest such level.
    """
    n = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (n % len(weights) + 1).cast("int"))
    by_limit = Window.orderBy("limit_at", F.col("source").isNull(), "source")
    before, everything = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    t = t.withColumn("limit_at", F.col("limit") / F.col("weight"))
    held, weight_held = F.coalesce(F.sum("limit").over(before), F.lit(0.0)), F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * F.lit(float(share)) - held) / (F.sum("weight").over(everything) - weight_held)
    t = t.withColumn("level", level)
    t = t.withColumn("level", F.max(F.when(F.col("level") <= F.col("limit_at"), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("level") * F.col("weight")))
    return t.select("src", "source", "source_size", target.alias("target"))


def _told_apart(docs: DataFrame, low: Column) -> DataFrame:
    """``docs`` as ``row``, a struct, with ``tie``: empty, or what tells rows apart that share a doc_id or have none.

    Such rows get the hash of their columns, and equal ones a number besides: they are grouped with their count and
    laid out again, in stretches, so that no task holds a group of copies, and whichever of them is which.
    """
    names = docs.columns
    hashable = [F.to_json(F.struct(F.col(f"`{f.name}`").alias("v"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), low.alias("id"), F.col("doc_id").isNull().alias("no_id"), F.xxhash64(*hashable).alias("hash"))
    shared = docs.select(low.alias("id")).groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | (F.col("id") == -(1 << 63))).select("id")
    if shared.isEmpty():
        return d.select("row", "id", F.lit("").alias("tie"))
    shared = small_side(materialize(shared, "shared"))
    groups = d.join(shared, "id", "left_semi").groupBy("id", "hash").agg(F.first("row").alias("row"), F.count("*").alias("n"))
    stretch = 10_000
    spread = groups.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(stretch).cast("bigint"))))
    several = spread.where(F.col("n") > stretch).repartition(F.col("id"), F.col("hash"), F.col("at"))
    spread = spread.where(F.col("n") <= stretch).unionByName(several)
    each = spread.withColumn("nth", F.explode(F.sequence("at", F.least(F.col("n"), F.col("at") + stretch) - 1)))
    tied = each.select("row", "id", F.concat_ws(":", F.lit(""), "hash", "nth").alias("tie"))
    return d.join(shared, "id", "left_anti").select("row", "id", F.lit("").alias("tie")).unionByName(tied)


def _inclusion(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``src, common``: the factor of each source's preferred odds with which the expected words meet its budget.

    A document's odds of inclusion are common * sqrt(size + 1). Sizes are put together in 64 bins for each doubling,
    and the factor is found by halving, so a source is a row of a few thousand numbers at most.
    """
    size = F.col("size").cast("double")
    bins = rows.groupBy("src", F.floor(F.log2(size + 1) * 64).alias("bin")).agg(F.sum("size").cast("double").alias("words"), F.sqrt(F.avg(size) + 1).alias("root"))
    of = bins.where("words > 0").groupBy("src").agg(F.collect_list(F.struct("words", "root")).alias("bins")).join(targets.select("src", "budget", "source_size"), "src")
    expected = lambda c: F.aggregate("bins", F.lit(0.0), lambda total, b: total + b["words"] * c * b["root"] / (1 + c * b["root"]))
    middle = lambda s: (s["low"] + s["high"]) / 2
    short = lambda s: expected(F.pow(F.lit(2.0), middle(s))) < F.col("budget")
    halved = lambda s: F.transform(F.array(short(s)), lambda less: F.struct(F.when(less, middle(s)).otherwise(s["low"]).alias("low"), F.when(less, s["high"]).otherwise(middle(s)).alias("high")))[0]
    found = F.aggregate(F.sequence(F.lit(1), F.lit(60)), F.struct(F.lit(-60.0).alias("low"), F.lit(60.0).alias("high")), lambda s, _: halved(s), lambda s: F.pow(F.lit(2.0), middle(s)))
    return of.select("src", F.when(F.col("budget") <= 0, 0.0).otherwise(found).alias("common"))


def _rank(doc_id: Column, tie: Column, size: Column, seed: int) -> Column:
    """Random odds over preferred odds, brought to (0, 1) and then to whole numbers; the least come first.

    A source's common factor of the odds (see ``_inclusion``) would divide all its ranks alike and leave their order as it is.
    """
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), tie)
    u = (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    odds = u / (1 - u) / F.sqrt(size + 1)
    return F.floor(odds / (1 + odds) * F.lit(float(1 << RANK_BITS))).cast("long")


def _cuts(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``src, cut_rank, cut_id``: the last ``(rank, id)`` of each source with which the words stay within its budget.

    Bins of the rank's highest bits are summed first, then those of the next bits inside the bin where the budget
    runs out, so that no task ever holds a source: at the end about one row in 2 ** 24 of it is ordered.
    """
    left = budgets.select("src", F.col("budget").alias("room"), F.lit(0).cast("long").alias("prefix"))
    inside, shift = rows, RANK_BITS
    for _ in range(2):
        shift -= STEP_BITS
        binned = inside.withColumn("bin", F.shiftright("rank", shift)).groupBy("src", "bin").agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("src").orderBy("bin"))
        at = binned.withColumn("upto", upto).join(small_side(left.select("src", "room")), "src").where("upto > room")
        found = at.groupBy("src").agg(F.min(F.struct("bin", (F.col("room") - F.col("upto") + F.col("words")).alias("room"))).alias("m"))
        full = left.join(found, "src", "left_anti").select("src", F.lit(None).cast("long").alias("bin"), "room")
        left = materialize(found.select("src", "m.bin", "m.room").unionByName(full), "cuts")
        small = small_side(left.where("bin is not null").select("src", "bin"))
        inside = inside.join(small, "src").where(F.shiftright("rank", shift) == F.col("bin")).drop("bin")
    upto = F.sum("size").over(Window.partitionBy("src").orderBy("rank", "id"))
    fits = inside.withColumn("upto", upto).join(small_side(left.select("src", "room")), "src").where("upto <= room").groupBy("src").agg(F.max(F.struct("rank", "id")).alias("m"))
    last = left.join(fits, "src", "left")
    top = F.when(F.col("bin").isNull(), F.lit(1 << 62)).otherwise(F.coalesce(F.col("m.rank"), F.shiftleft("bin", shift) - 1))
    return last.select("src", top.alias("cut_rank"), F.coalesce(F.when(F.col("bin").isNotNull(), F.col("m.id")), F.lit((1 << 63) - 1)).alias("cut_id"))


def _fill(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """``src, gap, fill``: what is left of each source's ``gap`` when its order goes on after ``(cut_rank, cut_id)``
    past documents that do not fit, until none is left to try, and the stretches ``(after, upto, most)`` of that
    order in which all documents of at most ``most`` words are taken. A round finds one stretch of every source.
    """
    at, key = "struct<rank:bigint,id:bigint>", F.struct("rank", "id")
    cut = F.struct(F.col("cut_rank").alias("rank"), F.col("cut_id").alias("id"))
    fill = F.array().cast(f"array<struct<after:{at},upto:{at},most:double>>")
    state = gaps.select("src", F.col("gap").cast("double").alias("gap"), cut.alias("after"), fill.alias("fill"))
    while True:
        state = materialize(state, "fill", instead_of=state)
        going = state.where("after is not null and gap > 0").select("src", "gap", "after")
        if going.isEmpty():
            return state.select("src", "gap", "fill")
        fitting = rows.join(small_side(going), "src").where((key > F.col("after")) & (F.col("size") > 0) & (F.col("size") <= F.col("gap"))).select("src", "id", "size", "rank")
        cuts = _cuts(fitting, going.select("src", F.col("gap").alias("budget"))).select("src", cut.alias("upto"))
        inside = key <= F.col("upto")
        sums = fitting.join(small_side(cuts), "src").groupBy("src").agg(F.sum(F.when(inside, F.col("size"))).alias("words"), F.min(F.when(~inside, key)).alias("next"))
        step = F.array(F.struct("after", "upto", F.col("gap").alias("most")))
        state = state.join(cuts, "src", "left").join(sums, "src", "left").select(
            "src", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"), F.col("next").alias("after"), F.when(F.col("words") > 0, F.concat("fill", step)).otherwise(F.col("fill")).alias("fill")
        )


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """``docs`` with ``size, source_size, target, inclusion, copies, taken``: how often the mix takes each document.

    Every document of a source gets the whole copies in target / source_size. The words still wanted are a Pareto
    order sample: each document has an inclusion probability, ``inclusion``, whose odds are in proportion to the root
    of its size and with which the expected words are those wanted; documents go by random odds over these odds, and are
    taken whole as long as the words fit. Beyond the Pareto draw, up to three documents whose sizes close the rest best
    are taken. Where that misses the target by over MISS, the order goes on past documents that do not fit, if that ends
    nearer. A document is taken at most whole copies + 1 times, which is within ``most``, rounded up. The random number
    is a digest of the seed and doc_id, so reruns agree, however the rows lie.

    Null texts have size 0, a null source is a source of its own (the last); texts may be of any length. Rows that share
    a doc_id, or have none, are drawn one by one by their columns, equal rows by a number besides, so that ties do not
    move a source off its target. An empty table stays empty. Columns of ``docs`` named like the new ones are replaced.
    """
    new = ("size", "source_size", "target", "inclusion", "copies", "taken")
    low = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    apart = _told_apart(docs, low)
    src = F.coalesce(F.concat(F.lit("s"), F.col("row.source").cast("string")), F.lit("n"))
    size = F.size(words_of(F.col("row.text"))).cast("long")
    sized = apart.select(src.alias("src"), F.col("row.source").cast("string").alias("source"), "id", size.alias("size"), _rank(F.col("row.doc_id"), F.col("tie"), size, seed).alias("rank"))
    rows = materialize(sized, "sizes")

    totals = rows.groupBy("src").agg(F.max("source").alias("source"), F.sum("size").alias("source_size"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + 1e-12).cast("long")
    targets = source_targets(totals, weights, share, most).withColumn("whole", whole)
    targets = materialize(targets.withColumn("budget", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))), "targets")
    cuts = _cuts(rows.select("src", "id", "size", "rank"), targets.where("budget > 0"))
    in_sample = F.struct("rank", "id") <= F.struct(F.col("cut_rank"), F.col("cut_id"))
    judged = rows.join(small_side(cuts), "src").withColumn("in_sample", in_sample)
    sums = judged.where("in_sample").groupBy("src").agg(F.sum("size").alias("words"))
    one = F.struct("rank", "id", "size")
    empty = F.array().cast("array<struct<rank:bigint,id:bigint,size:bigint>>")
    left = cuts.join(targets, "src").join(sums, "src", "left").select("src", (F.col("budget") - F.coalesce("words", F.lit(0))).alias("gap"), empty.alias("closing"))
    left = first = materialize(left, "gaps")
    for _ in range(CLOSING):
        fitting = judged.where("not in_sample and size > 0").join(small_side(left), "src").withColumn("off", F.abs(F.col("gap") - F.col("size")))
        fitting = fitting.where("off < gap").where(~F.array_contains("closing", one))
        best = fitting.groupBy("src").agg(F.min(F.struct("off", "rank", "id", "size")).alias("m"))
        found = F.array(F.struct("m.rank", "m.id", "m.size"))
        left = left.join(best, "src", "left").select("src", (F.col("gap") - F.coalesce("m.size", F.lit(0))).alias("gap"), F.when(F.col("m").isNotNull(), F.concat("closing", found)).otherwise(F.col("closing")).alias("closing"))
        left = materialize(left, "gaps")
    missed = left.join(targets.select("src", "target"), "src").where(F.abs("gap") > F.col("target") * MISS).select("src")
    filled = _fill(rows, first.select("src", "gap").join(missed, "src").join(cuts, "src")).withColumnRenamed("gap", "fill_gap")
    nearer = F.coalesce(F.abs("fill_gap") < F.abs("gap"), F.lit(False))
    left = left.join(filled, "src", "left").select("src", F.when(nearer, empty).otherwise(F.col("closing")).alias("closing"), F.when(nearer, F.col("fill")).alias("fill"))
    fates = targets.join(_inclusion(rows, targets), "src", "left").join(cuts, "src", "left").join(left, "src", "left").drop("source")
    fates = materialize(fates, "fates")

    kept = [c for c in docs.columns if c.lower() not in new]
    d = apart.select("row", src.alias("src"), "id", size.alias("size"), _rank(F.col("row.doc_id"), F.col("tie"), size, seed).alias("rank"))
    at = F.struct("rank", "id")
    filling = F.exists("fill", lambda x: (at > x["after"]) & (at <= x["upto"]) & (F.col("size") > 0) & (F.col("size") <= x["most"]))
    extra = (at <= F.struct("cut_rank", "cut_id")) | F.coalesce(F.array_contains("closing", one), F.lit(False)) | F.coalesce(filling, F.lit(False))
    d = d.join(small_side(fates), "src").withColumn("copies", F.col("whole") + F.coalesce(extra, F.lit(False)).cast("long"))
    odds = F.coalesce("common", F.lit(0.0)) * F.sqrt(F.col("size") + 1)
    d = d.withColumn("inclusion", odds / (1 + odds)).withColumn("taken", F.col("copies") * F.col("size"))
    return d.select(*[F.col(f"row.`{c}`") for c in kept], *new)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op4_mixing": op4_mixing}
SQL = {
    "op4_mixing": r"""
WITH sized AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS size
  FROM documents),
ranked AS (
  SELECT *, (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM sized),
keyed AS (
  SELECT * EXCLUDE u, floor(o / (1 + o) * 4503599627370496.0)::BIGINT AS r
  FROM (SELECT *, u / (1 - u) / sqrt(size + 1) AS o FROM ranked)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS lim FROM sources),
levels AS (
  SELECT *, lim / weight AS lim_at,
         ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
           - coalesce(sum(lim) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
         / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE)) AS lev
  FROM weighed),
targets AS (
  SELECT source, source_size, coalesce(least(lim, max(lev) FILTER (lev <= lim_at) OVER () * weight), lim) AS target FROM levels),
budgets AS (
  SELECT *, floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END + 1e-12)::BIGINT AS whole FROM targets),
running AS (
  SELECT k.*, b.source_size, b.target, b.whole, greatest(b.target - b.whole * b.source_size, 0.0) AS budget,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.r, k.doc_id) AS upto
  FROM keyed k JOIN budgets b ON k.source IS NOT DISTINCT FROM b.source),
sampled AS (
  SELECT *, budget > 0 AND upto <= budget AS s, budget - coalesce(max(upto) FILTER (upto <= budget) OVER (PARTITION BY source), 0) AS gap FROM running),
""" + "".join(f"""c{k} AS (
  SELECT * EXCLUDE (s, gap), coalesce(s OR n = 1, s) AS s, gap - coalesce(max(size) FILTER (n = 1) OVER (PARTITION BY source), 0) AS gap
  FROM (SELECT *, CASE WHEN ok THEN row_number() OVER (PARTITION BY source ORDER BY NOT ok, abs(gap - size), r, doc_id, size) END AS n
        FROM (SELECT * EXCLUDE n, NOT s AND budget > 0 AND size > 0 AND abs(gap - size) < gap AS ok FROM {'(SELECT *, 0 AS n FROM sampled)' if k == 1 else f'(SELECT * EXCLUDE ok FROM c{k - 1})'}))),
""" for k in (1, 2, 3)) + """
taken AS (SELECT * FROM c3)
SELECT doc_id, size, source_size, target, (size * (whole + s::INT))::BIGINT AS taken FROM taken
"""
}
