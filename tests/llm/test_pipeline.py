import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from test_simhash import slow_components
from wayglint.llm.mixing import mix
from wayglint.llm.rule_ensemble import statistics, train

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_dedup", "decontamination", "mixing", "token_output"]

    first = stages["quality_classifier"](spark, docs, SF).cache()
    model = train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = {r.doc_id: r.s for r in statistics(docs, "doc_id").select("doc_id", model.column().alias("s")).collect()}
    assert {r.doc_id for r in first.collect()} == {d for d, s in scored.items() if s >= 0.7}

    second = stages["simhash_dedup"](spark, first, SF).cache()
    kept = [(r.doc_id, r.text) for r in first.collect()]
    assert {r.doc_id for r in second.collect()} == {c for d, _, c in slow_components(kept) if d == c}

    third = stages["decontamination"](spark, second, SF).cache()
    items = [tuple(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    five = lambda w: {w[i : i + 5] for i in range(max(1, len(w) - 4))}
    for r in third.collect():
        have = five(tuple(r.text.lower().split()))
        assert not any(len(five(i) & have) >= 0.8 * len(five(i)) for i in items)
    assert 0 < third.count() <= second.count()

    fourth = stages["mixing"](spark, third, SF).cache()
    assert first.columns == second.columns == third.columns == fourth.columns == docs.columns
    taken = Counter(r.doc_id for r in fourth.collect())
    assert taken == Counter({r.doc_id: r.copies for r in mix(third).collect() if r.copies})

    last = stages["token_output"](spark, fourth, SF).orderBy("start").collect()
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for r, d in zip(last, sorted(taken.elements()), strict=True):
        ids = np.array([*library.encode(rows[d].text, add_special_tokens=False).ids, 0], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_run_equals_the_stages_and_takes_odd_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (9_000_000, None, "en", None, None)], docs.schema)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    docs.unionByName(odd).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    docs.limit(0).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
