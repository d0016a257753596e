import random
import re

from wayglint.llm.quality_rules import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(2)
    out = [None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 3000, "é # ü|<> $\n\né # ü|<> $", "a\x0bb\x85c d", "\n".join(["same line"] * 9)]
    for _ in range(200):
        out.append("".join(r.choice("abc") + r.choice([" ", " ", "\n", "  ", "#"]) for _ in range(r.randint(0, 90))))
    return out


def test_counts_match_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(d, t, "z") for d, t in rows] + [(None, "a b", "z"), (5, "a b", "z")], "doc_id long, text string, w string")
    got = quality_rules(docs, spark.createDataFrame([(4,), (None,)], "doc_id long")).collect()
    assert len(got) == len(rows) + 2
    want = {(d, *slow(t)) for d, t in rows}
    assert want <= {(x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) for x in got}
    for x in got:
        assert x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words)
        assert not (x.kept and x.base_failed)


def test_ratio_parts_target_from_raw(spark):
    good = [(i, " ".join(random.Random(i).choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=60))) for i in range(60)]
    bad = [(100 + i, " ".join(random.Random(i).choices("QQ! WW! EE! RR! TT! YY! UU! II! OO! PP!".split(), k=60))) for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    got = {x.doc_id: x for x in quality_rules(docs, docs.where("doc_id < 30")).collect()}
    assert all(got[d].kept for d, _ in good if not got[d].base_failed)
    assert not any(got[d].kept for d, _ in bad)
    assert quality_rules(docs.limit(0), docs.limit(0)).collect() == []
    assert all(x.llr == 0 for x in quality_rules(docs, docs.limit(0)).collect())


def test_bad_share_is_rejected_at_two_sizes(spark):
    """Where n-grams share buckets, scores shrink; the cut has to follow."""
    plain, noise = [f"w{i}" for i in range(100)], [f"q{i}!" for i in range(5)]
    for size in (300, 1500):
        r = random.Random(size)
        text = lambda bad: " ".join(r.sample(w := r.choices(plain, k=45) + r.choices(noise if bad else plain, k=15), len(w)))
        d = spark.createDataFrame([(i, text(i % 5 == 0)) for i in range(size)], "doc_id long, text string").repartition(4)
        got = {x.doc_id: x.kept for x in quality_rules(d, d.where("doc_id % 5 in (1, 2)").select("doc_id"), buckets=256).collect()}
        assert sum(got[i] for i in range(0, size, 5)) <= 0.02 * size / 5, size
        assert sum(got[i] for i in range(size) if i % 5) >= 0.97 * size * 4 / 5, size
