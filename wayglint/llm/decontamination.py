"""Benchmark decontamination: size-partitioned MinHash containment search, verified. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, small_side

#: Words are runs of letters, marks and digits in lower case, so that case and punctuation don't hide a passage.
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD), "")


def _places(words: Column, length: int) -> Column:
    """Where the text's shingles start, from 0; a text of fewer words is one shingle, one of none has none."""
    last = F.greatest(F.size(words) - length, F.lit(0))
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hash_at(hashes: Column, i: Column, length: int) -> Column:
    """The hash of the shingle that starts at ``i``, from its words' hashes (null past the end)."""
    return F.xxhash64(*[F.get(hashes, i + k) for k in range(length)])


def _with_words(rows: DataFrame, *keep: str) -> DataFrame:
    rows = rows.select(*keep, _words(F.col("text")).alias("w"))
    return rows.select(*keep, "w", F.transform("w", lambda w: F.xxhash64(w)).alias("wh"))


def shingles_of(rows: DataFrame, *keep: str, length: int = 5) -> DataFrame:
    """``keep, shingle, h``: a row for each shingle of each row of ``rows``, repeats included, space-joined, and its hash."""
    one = lambda i: F.struct(F.array_join(F.slice("w", i + 1, length), " ").alias("shingle"), _hash_at(F.col("wh"), i, length).alias("h"))
    return _with_words(rows, *keep).select(*keep, F.inline(F.transform(_places(F.col("w"), length), one)))


def benchmark_shingles(items: DataFrame, length: int = 5) -> DataFrame:
    """``item_id, shingle, h, m``: each different shingle of ``items(item_id, text)``, and how many its item has.

    Rows that repeat an item_id add up to one item; rows of null item_id or of no words have no shingles.
    """
    rows = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    s = shingles_of(rows, "item_id", length=length).distinct()
    return s.join(s.groupBy("item_id").agg(F.count("*").alias("m")), "item_id")


def _needed(size: Column, containment: float) -> Column:
    return F.ceil(F.round(size * F.lit(containment), 6))


def sketches(shingles: DataFrame, containment: float = 0.8) -> DataFrame:
    """``item_id, h``: of each item its least shingle hashes, as many as its size class needs.

    Items are partitioned by size into classes of up to 2, 4, 8, ... shingles. A text that holds the share
    ``containment`` of an item lacks at most size - ceil(containment * size) of its shingles; one hash more than
    that, for the largest size of the class, and at least one of them must be in the text. So no candidate is lost.
    """
    size = F.pow(F.lit(2.0), F.ceil(F.round(F.log2("m"), 9)))
    hashes = (size - _needed(size, containment) + 1).cast("int")
    least = shingles.groupBy("item_id", hashes.alias("k")).agg(F.array_sort(F.collect_set("h")).alias("all"))
    return least.select("item_id", F.explode(F.slice("all", F.lit(1), F.col("k"))).alias("h"))


def contaminated(docs: DataFrame, items: DataFrame, length: int = 5, containment: float = 0.8) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shared, n_shingles, containment`` of each text and benchmark item it contains.

    A text contains an item if it has at least ``containment`` of the item's different five-word shingles, wherever
    they stand. Candidates are the texts that hold one of the item's least shingle hashes; for those the shingles
    themselves are compared. The benchmark's tables are broadcast up to a checked number of rows, and joined by
    shuffling the shingle hashes beyond it. A document's repeated shingles count once, so a passage repeated or
    shared by any number of documents costs a row a document. Rows that repeat both doc_id and text are one row of
    the result; null and empty texts contain nothing; a null doc_id is kept as null; empty tables give no rows.
    """
    shingles = benchmark_shingles(items, length)
    wanted = small_side(sketches(shingles, containment))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    places = F.transform(_places(F.col("w"), length), lambda i: _hash_at(F.col("wh"), i, length))
    hashed = _with_words(d, "doc_id", "text_hash").select("doc_id", "text_hash", F.explode(places).alias("h"))
    candidates = materialize(hashed.join(wanted, "h").select("doc_id", "text_hash", "item_id").distinct(), "candidates")

    texts = of_rows(d, candidates).dropDuplicates(["doc_id", "text_hash"])
    own = shingles_of(texts, "doc_id", "text_hash", length=length).select("doc_id", "text_hash", "shingle")
    hits = own.join(small_side(shingles.select("shingle", "item_id", "m")), "shingle").distinct()
    shared = hits.groupBy("doc_id", "text_hash", "item_id").agg(F.count("*").alias("n_shared"), F.max("m").alias("n_shingles"))
    found = shared.where(F.col("n_shared") >= _needed(F.col("n_shingles"), containment))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_shingles"))


def of_rows(rows: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose doc_id and text_hash are (or with ``left_anti``, are not) among ``keys``; null ids are equal."""
    k = keys.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return rows.join(small_side(k), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), how)


def decontaminate(docs: DataFrame, items: DataFrame, length: int = 5, containment: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item, with the columns of ``docs``."""
    found = materialize(contaminated(docs, items, length, containment), "contaminated")
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    k = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(small_side(k), F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (text_hash == F.col("_hash")), "left_anti")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


QUERIES = {"op5_decontamination": op5_decontamination}
SQL = {
    "op5_decontamination": r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM dw WHERE len(w) > 0)),
bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
m AS (SELECT item_id, count(*) AS m FROM bs GROUP BY item_id)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, any_value(m)::BIGINT AS n_shingles, count(*)::DOUBLE / any_value(m) AS containment
FROM ds JOIN bs USING (s) JOIN m USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(round(any_value(m) * 0.8::DOUBLE, 6))
"""
}
