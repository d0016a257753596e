"""Token-ID output: documents as one sequence of ids, in blocks of transposed, zstandard-compressed planes."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import bounded_batches, shared_path

#: Unicode's White_Space, by which the tokenizer's own pattern tells white space.
WHITE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Cuts that the tokenizer makes anyway: before the single space that leads a run, and round white space.
RUNS = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: A word alone, or behind one line end: what a text of single spaces and line ends falls into.
PLAIN = re.compile(f"\n?[^{WHITE}]+")
#: Words whose ids a worker remembers (about 200 bytes each), words encoded in one string, and characters cut at once.
REMEMBERED, TOGETHER, AT_ONCE = 1_200_000, 50, 4_000_000

BLOCK_SCHEMA = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("start_in_part", T.LongType()),
    T.StructField("n_ids", T.IntegerType()),
    T.StructField("planes", T.ArrayType(T.BinaryType())),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("rows", T.ArrayType(T.LongType())),
    T.StructField("segments", T.ArrayType(T.IntegerType())),
    T.StructField("lengths", T.ArrayType(T.IntegerType())),
    T.StructField("ends", T.ArrayType(T.BooleanType())),
])

class Encoder:
    """Ids of whole texts by the tokenizers library, which sees each new word once; a worker remembers a word's ids.

    A text of single spaces and line ends is cut at its spaces and before its line ends. A piece that starts with a
    line end stands for that and a word, any other for a space and a word, so that pieces are keys as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        line_end = self._ids(["\n"])[0]
        self.line_end = int(line_end[0]) if len(line_end) == 1 else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # words of the generation before, each kept on if it comes up again

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> None:
        """Remembers the ids of new plain pieces, many in one string: each brings a line end, whose id parts them."""
        groups = [new[i : i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        lines = ["".join([p if p[0] == "\n" else "\n " + p for p in g]) for g in groups]
        for group, ids in zip(groups, self._ids(lines), strict=True):
            starts = np.flatnonzero(ids == self.line_end).tolist()
            if len(starts) == len(group):
                data = ids.tobytes()
                for p, a, z in zip(group, starts, [*starts[1:], len(ids)], strict=True):
                    self.known[p] = data[4 * a + 4 * (p[0] != "\n") : 4 * z]
            else:
                for p, own in zip(group, self._ids([p if p[0] == "\n" else " " + p for p in group]), strict=True):
                    self.known[p] = own.tobytes()

    def _by_runs(self, texts: list[str]) -> list[bytes]:
        """Texts with other white space, run by run, each different run once in one call."""
        runs = [RUNS.findall(t) for t in texts]
        different = list({r for found in runs for r in found})
        ids = {r: own.tobytes() for r, own in zip(different, self._ids(different), strict=True)}
        return [b"".join([ids[r] for r in found]) for found in runs]

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        group, held = [], 0
        for t in texts:
            group.append(t)
            held += len(t)
            if held >= AT_ONCE:
                yield from self._encode(group)
                group, held = [], 0
        yield from self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if self.line_end is None or any(s in t for s in self.special)]
        for i, ids in zip(whole, self._ids([texts[i] for i in whole]), strict=True):
            out[i] = ids.tobytes()
        pieces = {i: ("\n" + t).replace("\n", " \n").split(" ")[1:] for i, t in enumerate(texts) if t and out[i] is None}
        seen = set().union(*pieces.values())
        if len(self.known) > REMEMBERED // 2:
            self.known, self.older = {}, self.known
        missing = seen.difference(self.known)
        self.known.update({p: self.older[p] for p in missing if p in self.older})
        self._learn([p for p in missing if p not in self.known and PLAIN.fullmatch(p)])
        odd = []
        for i, found in pieces.items():
            try:
                out[i] = b"".join(map(self.known.__getitem__, found))[4:]  # less the line end put in front
            except KeyError:
                odd.append(i)
        for i, ids in zip(odd, self._by_runs([texts[i] for i in odd]), strict=True):
            out[i] = ids
        return [ids or b"" for ids in out]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, kind: str = "byte", level: int = 3) -> list[bytes]:
    """The block's planes, lowest first: plane k has byte (or bit) k of each id. Planes that are all zero at the top go."""
    squeeze = zstandard.ZstdCompressor(level=level).compress
    top = int(ids.max()) if len(ids) else 0
    as_bytes = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [squeeze(np.ascontiguousarray(as_bytes[:, k]).tobytes()) for k in range((top.bit_length() + 7) // 8)]
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return [squeeze(np.packbits(bits[:, k], bitorder="little").tobytes()) for k in range(top.bit_length())]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    if kind == "byte":
        out = np.zeros((n, 4), np.uint8)
        for k, plane in enumerate(planes):
            out[:, k] = np.frombuffer(expand(plane), np.uint8)
        return out.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), np.uint8)
    for k, plane in enumerate(planes):
        bits[:, k] = np.unpackbits(np.frombuffer(expand(plane), np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class _Blocks:
    """Fills blocks of a fixed number of ids from the documents of one partition, in their order."""

    def __init__(self, part: int, size: int, kind: str):
        self.part, self.size, self.kind = part, size, kind
        self.number = self.before = self.row = 0
        self._clear()

    def _clear(self) -> None:
        self.held, self.n = [], 0
        self.segments: list[tuple] = []

    def add(self, doc_id: int | None, data: bytes) -> Iterator[dict]:
        at, piece = 0, 0
        total = len(data) // 4
        while at < total:
            take = min(total - at, self.size - self.n)
            self.held.append(data[4 * at : 4 * (at + take)])
            self.segments.append((doc_id, self.row, piece, take, at + take == total))
            self.n += take
            at += take
            piece += 1
            if self.n == self.size:
                yield self.close()
        self.row += 1

    def close(self) -> dict:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        doc_ids, rows, pieces, lengths, ends = map(list, zip(*self.segments, strict=True))
        out = {"part": self.part, "block": self.number, "start_in_part": self.before, "n_ids": self.n, "planes": to_planes(ids, self.kind), "doc_ids": doc_ids, "rows": rows, "segments": pieces, "lengths": lengths, "ends": ends}
        self.number += 1
        self.before += self.n
        self._clear()
        return out


_ARROW_BLOCKS = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("start_in_part", pa.int64()), ("n_ids", pa.int32()), ("planes", pa.list_(pa.binary())),
    ("doc_ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("segments", pa.list_(pa.int32())), ("lengths", pa.list_(pa.int32())), ("ends", pa.list_(pa.bool_())),
])


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, block: int = 65_536, kind: str = "byte") -> None:
    """Writes the ids of ``docs(doc_id, text)``, each document's followed by ``end_id``, to ``path``.

    Documents go in ascending doc_id order (null first, repeated ids by text). The file format is a Parquet
    table, so that any store Spark writes to will do and lost tasks are repeated by Spark's commit protocol. A
    row is a block of ``block`` ids (the last of a part may have fewer): its compressed planes, and its entry of
    the chunk index: part and block number, the ids of the part before it, and for each document in the block
    its id, its row in the part, which piece of the document this is, how many ids, and whether it ends here.
    Parts follow one another in doc_id order. Null and empty texts have the end id alone; an empty table gives
    no blocks. Other columns are ignored.
    """
    bounded_batches(docs.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([end_id], "<u4").tobytes()
        out = _Blocks(TaskContext.get().partitionId(), block, kind)
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                for row in out.add(doc_id, ids + end):
                    yield pa.RecordBatch.from_pylist([row], _ARROW_BLOCKS)
        if out.n:
            yield pa.RecordBatch.from_pylist([out.close()], _ARROW_BLOCKS)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, kind: str = "byte") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of each document of a written table, ids as little-endian 32-bit binary."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                data = from_planes(r["planes"], r["n_ids"], kind).tobytes()
                cuts = np.cumsum([0, *r["lengths"]])
                yield pa.RecordBatch.from_pydict({
                    "part": [r["part"]] * len(r["rows"]), "row": r["rows"], "doc_id": r["doc_ids"], "segment": r["segments"],
                    "start": cuts[:-1] + (r["base"] + r["start_in_part"]), "n": r["lengths"], "ends": r["ends"],
                    "ids": [data[4 * a : 4 * z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)],
                }, schema=_ARROW_SEGMENTS)

    found = blocks.join(bases, "part").mapInArrow(segments, "part int, row long, doc_id long, segment int, start long, n int, ends boolean, ids binary")
    whole = found.where("segment = 0 and ends").select("doc_id", "start", F.col("n").cast("long").alias("n_tokens"), "ids")
    cut = found.where("not (segment = 0 and ends)").groupBy("part", "row", "doc_id").agg(
        F.min("start").alias("start"), F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("segment", "ids"))).alias("pieces")
    )
    joined = F.aggregate("pieces", F.lit(b""), lambda so_far, p: F.concat(so_far, p["ids"]))
    return whole.unionByName(cut.select("doc_id", "start", "n_tokens", joined.alias("ids")))


_ARROW_SEGMENTS = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("doc_id", pa.int64()), ("segment", pa.int32()), ("start", pa.int64()), ("n", pa.int32()), ("ends", pa.bool_()), ("ids", pa.binary())])


def token_digests(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes ``docs`` to the shared folder, reads them back: ``doc_id, start, n_tokens, ids_crc32`` of each row."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    write_tokens(docs, tokenizer_path, path, **options)
    back = read_tokens(spark, path, options.get("kind", "byte"))
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {"op6_tokens": op6_tokens}
SQL: dict[str, str] = {}
