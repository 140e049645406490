import random

import numpy as np

from lodewerk.llm import suffixdedup as s


def brute(rows, n):
    """{(doc, position)} of every word that stands in a window of n words which occurs before."""
    seen, gone = set(), set()
    for doc, text in sorted({(d, t) for d, t in rows if d is not None and t is not None}):
        words = text.split()
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            if w in seen:
                gone |= {(doc, j) for j in range(i, i + n)}
            seen.add(w)
    return gone


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") * r.randrange(1, 5)
    shared = [[word() for _ in range(r.randrange(8, 40))] for _ in range(6)]
    rows = []
    for d in range(120):
        text = []
        for _ in range(r.randrange(0, 5)):
            text += r.choice(shared) if r.random() < 0.4 else [word() for _ in range(r.randrange(1, 60))]
        if r.random() < 0.1:
            text += [word()] * 50
        rows.append((d, " ".join(text)))
    return rows + [(200 + d, t) for d, t in rows[:20]] + rows[:5]


def test_sort_is_lexicographic():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 3, 400), np.zeros(60, np.int64), rng.integers(0, 3, 100)])
    starts = np.arange(len(ids) - 20)
    order, shared = s.sort_suffixes(ids, starts, 20)
    lines = [tuple(ids[i : i + 20]) for i in order]
    assert lines == sorted(lines)
    for i in range(1, len(lines)):
        n = next((k for k in range(20) if lines[i][k] != lines[i - 1][k]), 20)
        assert n == shared[i]


def test_a_collision_is_no_repeat(monkeypatch):
    """With hashes that are all equal nothing but the words decides."""
    ids = np.array([1, 2, 3, 4, 9, 2, 3, 4, 1, 2, 3, 4])
    monkeypatch.setattr(s.ta, "window_hashes", lambda t, w: np.zeros(len(t) - w + 1, np.uint64))
    monkeypatch.setattr(s, "common", lambda p, i, a, b, most: np.full(len(a), most))
    got = s.repeats(ids, None, np.array([0, 4, 8]), np.arange(3), 4)
    assert got.tolist() == [False, False, True]


def test_find_equals_brute_force(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        got = set()
        for r in s.find(docs, min_words=12).collect():
            cover = {(r.doc_id, j) for j in range(r.first_word, r.end_word)}
            assert not cover & got
            got |= cover
        assert got == brute(rows, 12)


def test_cases(spark):
    p = " ".join(f"w{i}" for i in range(60))
    rows = [(1, p, 9, "k"), (2, "head " + p + "  tail\n", 9, "k"), (3, p, 9, None), (None, p, 9, "k"), (4, None, None, "k"), (5, "", 0, "k"), (6, "short text", 1, "k"), (7, " ".join(f"v{i}" for i in range(200_000)), 1, "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, mark string")
    out = {r.doc_id: r for r in s.remove(docs).collect()}
    assert set(out) == {1, 2, None, 4, 5, 6, 7}
    assert out[1].text == p and out[2].text == "head tail\n" and out[2].n_chars == 10 and out[4].text is None and out[None].text == p
    assert len(out[7].text) == len(rows[7][1])
    assert s.remove(docs.limit(0)).count() == 0 == s.find(docs.limit(0)).count()


def test_columns_with_the_names_used_inside(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"a {passage}", 5, 6, 7, "x"), (2, f"{passage} b", 5, 6, 7, None), (None, passage, 1, 1, 1, "y")], "doc_id bigint, text string, _id int, _mark int, _cut int, _EXTRA string")
    got = s.remove(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, len(r.text.split()), r._id, r._EXTRA or "") for r in got.collect()) == [(0, 60, 1, "y"), (1, 61, 5, "x"), (2, 1, 5, "")]
