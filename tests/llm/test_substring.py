import random

import numpy as np

from wayglint.llm.substring import analyse, remove_repeats, word_names


def slow(rows, length):
    """Removed words by comparing every window with all that start earlier."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, out = set(), {}
    for i in order:
        words = (rows[i][1] or "").split()
        gone = set()
        for s in range(len(words) - length + 1):
            w = tuple(words[s : s + length])
            if w in seen:
                gone.update(range(s, s + length))
            seen.add(w)
        out[i] = (rows[i][0], len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    return sorted(out.values(), key=str)


def make_rows(r):
    passages = [[r.choice("abcdefghij") * r.randint(1, 3) for _ in range(r.randint(18, 70))] for _ in range(8)]
    rows = []
    for d in range(150):
        words = []
        for _ in range(r.randint(0, 5)):
            kind = r.random()
            if kind < 0.4:
                p = r.choice(passages)
                a = r.randint(0, len(p) // 2)
                words += p[a : r.randint(a, len(p))]
            elif kind < 0.6:
                words += [r.choice("ab")] * r.randint(1, 60)
            elif kind < 0.75:
                words += [r.choice("xy"), r.choice("xyz")] * r.randint(1, 30)
            else:
                words += [r.choice("abcdefghijklmnop") for _ in range(r.randint(1, 60))]
        rows.append((7 * d % 151, r.choice([" ", "\n", "  "]).join(words)))
    return rows


def test_matches_brute_force(spark):
    rows = make_rows(random.Random(3))
    rows += [(500, None), (501, ""), (502, " \n"), (None, rows[3][1]), (503, "É " * 50 + "ß"), (504, "q w " * 4000)]
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, firsts string, pos int").repartition(5)
    for length, rounds in ((20, 2), (7, 3)):
        got = sorted(((x.doc_id, x.n_words, x.n_removed, x.text) for x in remove_repeats(docs, length, rounds).collect()), key=str)
        assert got == slow(rows, length)


def test_repeated_rows_and_empty_table(spark):
    t = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, t), (1, t), (2, t)], "doc_id long, text string")
    assert sorted((x.doc_id, x.n_removed) for x in remove_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 30)]
    assert remove_repeats(docs.limit(0)).collect() == []


def test_equal_windows_have_equal_anchors():
    r = random.Random(9)
    docs = [[w.encode() for w in t.split()] for _, t in make_rows(r)]
    offsets = np.cumsum([0, *map(len, docs)])
    words = [w for d in docs for w in d]
    g = analyse(word_names(words), offsets, 20, 2)
    by_window = {}
    for lo, hi, doc, name in zip(g.lo, g.hi, g.doc, g.name, strict=True):
        assert offsets[doc] <= lo <= hi <= offsets[doc + 1] - 20
        for s in range(lo, hi + 1):
            assert by_window.setdefault(tuple(words[s : s + 20]), name) == name
    assert (g.hi - g.lo + 1).sum() == sum(max(0, len(d) - 19) for d in docs)
