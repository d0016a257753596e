import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from wayglint.llm import tokens
from wayglint.llm.tokens import Encoder, from_planes, read_tokens, to_planes, token_digests, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "B", " ", "  ", "\n", "\t", "\x85", "\xa0", chr(0x2003), chr(0x3000), "\x1c", "'s", "'re", "1", "23", "é", "!", chr(0x200B), "<|endoftext|>", "<|endof", "漢", "\r\n", chr(0x301), "😀", "\x00"]


def test_encoder_equals_the_library():
    r, library, encode = random.Random(1), Tokenizer.from_file(PATH), Encoder(PATH)
    for _ in range(400):
        texts = ["".join(r.choices(PIECES, k=r.randint(0, 12))) for _ in range(49)]
        texts.append("".join([*r.choices(["a", "Bc", "é", "'s", "1", "23!"], k=5), *r.choices([" x", "\ny", " 2\n", "\n"], k=r.randint(0, 4))]))
        for t, ids in zip(texts, encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)
    assert list(encode([])) == []


def test_encoder_forgets_in_bounds(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 20)
    monkeypatch.setattr(tokens, "AT_ONCE", 50)
    r, library, encode = random.Random(3), Tokenizer.from_file(PATH), Encoder(PATH)
    for _ in range(40):
        texts = [" ".join(f"w{r.randint(0, 60)}" for _ in range(12)) for _ in range(3)]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encode.known) <= 10 + 36 and len(encode.older) <= 10 + 36


def test_planes_round_trip():
    r = np.random.default_rng(0)
    for kind in ("byte", "bit"):
        for ids in (np.zeros(0), np.zeros(5), r.integers(0, 50257, 999), r.integers(0, 1 << 32, 64)):
            assert (from_planes(to_planes(ids.astype("<u4"), kind), len(ids), kind) == ids).all()


def test_written_and_read_back(spark, tmp_path):
    r, library = random.Random(2), Tokenizer.from_file(PATH)
    rows = [(3 * d % 97, " ".join(r.choices(["one", "Two", "three.\nFour", "é漢", " "], k=r.randint(0, 60)))) for d in range(97)]
    rows += [(200, None), (201, ""), (202, "long " * 5000), (None, "no id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, start string, n_tokens int").repartition(6)
    rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want, start = [], 0
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    for options in ({}, {"block": 100, "kind": "bit"}):
        got = token_digests(docs, PATH, **options).orderBy("start").collect()
        assert [(x.doc_id, x.start, x.n_tokens, x.ids_crc32) for x in got] == want
    write_tokens(docs, PATH, str(tmp_path / "t"), block=64)
    assert spark.read.parquet(str(tmp_path / "t")).agg({"n_ids": "sum"}).first()[0] == start
    assert sum(len(x.ids) for x in read_tokens(spark, str(tmp_path / "t")).collect()) == 4 * start


def test_empty_table(spark):
    assert token_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
