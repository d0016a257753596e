"""A corpus pipeline of five training-data operators: from raw documents to token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayglint.llm import decontamination, mixing, rule_ensemble, simhash, tokens
from wayglint.llm.common import materialize


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fit to the labels of the kept rows, scores below the cut go.

    Null and empty texts are scored like any other; rows that repeat share their verdict; with no labels to learn from,
    or one class only, the fitted score is constant. An empty table stays empty; other columns pass unread.
    """
    return rule_ensemble.accept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of least doc_id stays; ties go by fingerprint and hashes.

    Null and empty texts are near duplicates of one another. Rows of null doc_id stay. Texts that share a doc_id are
    judged one by one; of equal rows one stays.
    """
    return simhash.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go.

    Null and empty texts contain none; repeated rows share their fate; an empty benchmark removes nothing.
    """
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Documents of no words come as often as their source's whole copies or its draw say. Rows that share a doc_id, or have
    none, are drawn one by one. Columns named like the mix's own keep the document's values.
    """
    mixed = mixing.mix(docs.select(*[F.col(f"`{c}`") for c in ("doc_id", "text", "source")], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_own")))
    repeated = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(f"_own.`{c}`").alias(c) for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Written as token blocks and read back: a row for each document that the mix holds, with its place and checksum.

    Null and empty texts have the end id alone; copies follow one another; an empty table gives no rows.
    """
    import public_tokenizers

    return tokens.token_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_classifier", classify), ("simhash_dedup", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("token_output", tokenize)]

#: The classifier's fit and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
