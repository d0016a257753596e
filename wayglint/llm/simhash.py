"""SimHash near-dedup: pigeonhole blocks, verified Hamming distance, components in Spark."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, hex16, materialize, small_side, spread_join
from .graph import connected_components

#: Blocks a fingerprint is cut into, and blocks that a key joins, by the most fingerprints that the keys suit.
#: With four differing bits at most, (blocks - joined) blocks are never all touched, so each choice is exact.
KEYS = ((4_000_000, 6, 2), (250_000_000, 7, 3), (1 << 62, 8, 4))
#: Comparisons in one block beyond which the block is split again.
SPLIT = 1_000_000


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned 64-bit SimHash of a text: the majority bits of its shingles' XXH64 (seed 42), repeats included.

    A-Z count as lower case; a text of fewer words is one shingle; one of no words, or null, has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32).tolist()
        starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(line)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, text_hash: Column | None = None) -> DataFrame:
    """``doc_id, fp`` (signed long) of each row, and its ``text_hash`` if one is given."""
    bounded_batches(docs.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in b.column(1).to_pylist()), "<u8", b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view("<i8")), *b.columns[2:]], ["doc_id", "fp", *b.schema.names[2:]])

    rows = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    if text_hash is None:
        return docs.select(*rows).mapInArrow(of, "doc_id long, fp long")
    return docs.select(*rows, text_hash.alias("text_hash")).mapInArrow(of, "doc_id long, fp long, text_hash long")


def _blocks(fp: Column, blocks: int) -> list[tuple[Column, int]]:
    """Each block of the bits with its width."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    return [(F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)), b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def _packed(start: Column, parts: list[tuple[Column, int]]) -> Column:
    for part, width in parts:
        start = F.shiftleft(start, width).bitwiseOR(part)
    return start


def block_keys(fp: Column, blocks: int, joined: int) -> Column:
    """An array of ``struct<key, rest>`` for each choice of ``joined`` blocks: fingerprints that agree in them share the key; rest has the other bits."""
    cut = _blocks(fp, blocks)
    return F.array(*[
        F.struct(_packed(F.lit(n).cast("long"), [cut[i] for i in chosen]).alias("key"), _packed(F.lit(0).cast("long"), [c for i, c in enumerate(cut) if i not in chosen]).alias("rest"))
        for n, chosen in enumerate(combinations(range(blocks), joined))
    ])


def _split_keys(key: Column, rest: Column, blocks: int, joined: int, distance: int) -> Column:
    """Keys for a block that is split again: close fingerprints agree in one of ``distance`` + 1 parts of the bits outside of the block."""
    bits = 64 - joined * (64 // blocks)  # no choice of blocks leaves more
    bounds = [bits * i // (distance + 1) for i in range(distance + 2)]
    return F.array(*[F.xxhash64(key, F.lit(n), F.shiftrightunsigned(rest, a).bitwiseAND(F.lit((1 << (b - a)) - 1))) for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))])


def _close(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def link(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """``distinct(fp)``, each fingerprint once, to ``(node, component)`` of those within ``distance`` of another.

    Blocks: first each member of a block is held against one leader of it, another leader for each choice of
    blocks, which joins large groups of near copies in linear time. Then, in the blocks that still span several
    components, all members outside the block's largest component are held against all others, so that no link
    between components is lost and no pair within a component is made. A block where that takes over SPLIT
    comparisons, as of many short texts that are alike but not close, is split by its other bits first, with no link lost.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the block choices are exact for a distance of 0 to 4")
    total = distinct.count()
    blocks, joined = next((b, j) for most, b, j in KEYS if total <= most)
    keys = distinct.select("fp", F.inline(block_keys(F.col("fp"), blocks, joined))).drop("rest")
    leaders = keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("fp", "key").alias("h"), F.col("fp").alias("leader"))).alias("m"), F.count("*").alias("n"))
    leaders = leaders.where("n > 1").select("key", "m.leader")
    near = keys.join(leaders, "key").where(F.col("fp") != F.col("leader")).where(_close("fp", "leader", distance))
    first = materialize(connected_components(near.select(F.col("fp").alias("u"), F.col("leader").alias("v"))), "components")

    named = distinct.join(first.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))
    members = materialize(named.select("fp", "component", F.inline(block_keys(F.col("fp"), blocks, joined))), "members")
    sizes = members.groupBy("key", "component").count()
    major = sizes.groupBy("key").agg(F.max(F.struct("count", "component")).alias("m"), F.count("*").alias("n"), F.sum("count").alias("all")).where("n > 1")
    split = (F.col("all") - F.col("m.count")) * F.col("all") > SPLIT
    major = major.select("key", F.col("m.component").alias("major"), split.alias("split"))
    held = members.join(major, "key")
    held = held.withColumn("keys", F.when(F.col("split"), _split_keys(F.col("key"), F.col("rest"), blocks, joined, distance)).otherwise(F.array("key")))
    held = held.select("component", "major", "fp", "key", F.explode("keys").alias("part"))
    rest = held.where("component <> major").select("key", "part", F.col("fp").alias("fp_a"), F.col("component").alias("u"))
    others = held.select("key", "part", F.col("fp").alias("fp_b"), F.col("component").alias("v"))
    across = rest.join(others, ["key", "part"]).where(F.col("u") != F.col("v")).where(_close("fp_a", "fp_b", distance)).select("u", "v")
    second = connected_components(across).select(F.col("node").alias("component"), F.col("component").alias("final"))

    joined_up = spread_join(named, second, "component", "fp", "left")
    return joined_up.select(F.col("fp").alias("node"), F.coalesce("final", "component").alias("component"))


def _components(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, component, component_id`` of each fingerprint; an unlinked one is its own component."""
    copies = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    members = copies.join(link(copies.select("fp"), distance).withColumnRenamed("node", "fp"), "fp")
    several = members.groupBy("component").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    named = spread_join(members, several.withColumn("shared", F.lit(True)), "component", "fp", "left")
    return named.select("fp", "component", F.when(F.col("shared"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of ``docs(doc_id, text)``; other columns are ignored.

    component_id is the least doc_id that can be reached over links of at most ``distance`` differing bits. Equal
    fingerprints are one node however many copies there are. Null, empty and blank texts have fingerprint zero;
    a text may be of any length. Rows without doc_id take part but never name a component (null if no row of it has
    one); repeated rows give repeated rows; an empty table gives an empty result.
    """
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    named = _components(prints, distance).select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def _hash_of(column: str, kind: T.DataType) -> Column:
    """A column that can be hashed: maps as JSON."""
    return F.to_json(F.struct(F.col(f"`{column}`").alias("v"))) if "map" in kind.simpleString() else F.col(f"`{column}`")


def deduplicate(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The rows of ``docs`` without all but one document of each group of near duplicates, the least doc_id.

    Rows without doc_id stay, as nothing names them. Rows may repeat a doc_id: each text of it belongs to the group
    that its fingerprint is in, so one that is unlike all others stays; of a group's least doc_id the text of least
    fingerprint, then of least hash, stays, and of rows that repeat both the one whose columns have the least hash.
    """
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    named = docs.where("doc_id is not null")
    prints = materialize(fingerprints(named, shingle, text_hash), "fingerprints")
    first = F.min(F.struct("doc_id", "fp", "text_hash"))
    texts = prints.groupBy("fp").agg(first.alias("first")).join(_components(prints, distance), "fp")
    keep = materialize(texts.groupBy("component").agg(F.min("first").alias("k")).select("k.doc_id", "k.text_hash"), "keep")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    by_hash = F.xxhash64(*[_hash_of(f.name, f.dataType) for f in docs.schema.fields]).alias("row_hash")
    on = ["doc_id", "text_hash"]
    kept = named.select(row, by_hash, F.col("doc_id").cast("long").alias("doc_id"), text_hash.alias("text_hash")).join(keep, on, "left_semi")
    repeated = prints.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1").select(*on)
    if not repeated.isEmpty():
        repeated = small_side(materialize(repeated, "repeated"))
        one = kept.join(repeated, on, "left_semi").groupBy(*on).agg(F.min_by("row", "row_hash").alias("row"))
        kept = kept.join(repeated, on, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*").unionByName(docs.where("doc_id is null"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_simhash": op3_simhash}
SQL: dict[str, str] = {}
