import math
import random
from collections import Counter

import numpy as np
import pytest

from lodewerk.llm import loglm as m


def corpus(n=150, seed=4):
    r = random.Random(seed)
    return [(i, " ".join(r.choice("abcdefghij") * min(4, 1 + int(r.expovariate(1.0))) for _ in range(r.choice([1, 2, 30, 60])))) for i in range(n)]


def brute(rows, min_count=2):
    """With dictionaries in place of the filter."""
    counts = [Counter() for _ in range(3)]
    for _, t in rows:
        w = (t or "").split()
        for n in (1, 2, 3):
            counts[n - 1].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total, kinds = sum(counts[0].values()), len(counts[0])

    def c(g):
        n = counts[len(g) - 1][g]
        if not n or (len(g) > 1 and n < min_count):
            return 0.0
        level = int(math.log2(n)) + 1
        return (2 ** (level - 1) + 2**level - 1) / 2

    out = {}
    for i, t in rows:
        w, s = (t or "").split(), 0.0
        for k in range(len(w)):
            p = (c((w[k],)) + 1) / (total + kinds + 1)
            for n in (1, 2):
                if k >= n and (h := c(tuple(w[k - n : k]))) > 0:
                    p = m.WEIGHT * min(c(tuple(w[k - n : k + 1])), h) / h + (1 - m.WEIGHT) * p
            s += math.log2(p)
        if w:
            out[i] = s
    return out


def test_close_to_exact_counts(spark):
    rows = corpus()
    want = brute(rows)
    got = {r.doc_id: r for r in m.scores(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert set(got) == set(want)
    off = np.array([abs(got[i].log2_prob - want[i]) / got[i].words for i in want])
    assert np.mean(off) < 0.1 and np.mean(off < 0.02) > 0.1
    assert got[0].perplexity == pytest.approx(2 ** (-got[0].log2_prob / got[0].words))


def test_exact_where_no_probe_errs(spark, monkeypatch):
    """A roomy filter reads each count's level as it is."""
    names = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000).astype(np.uint64))
    counts = np.random.default_rng(2).integers(1, 1000, len(names))
    monkeypatch.setattr(m, "BITS_EACH", 400)
    cells = m.make_segment([(names, counts)])
    read = m.probe(names, cells, np.zeros(len(names), np.int64), np.full(len(names), len(cells)))
    assert (read >= m.level_of(counts)).all() and (read == m.level_of(counts)).mean() > 0.999
    monkeypatch.undo()
    cells = m.make_segment([(names, counts)])
    other = np.unique(np.random.default_rng(3).integers(0, 1 << 40, 20000).astype(np.uint64))
    assert (m.probe(other, cells, np.zeros(len(other), np.int64), np.full(len(other), len(cells))) > 0).mean() < 0.06


def test_without_broadcast_the_same(spark):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string").repartition(3)
    a = {r.doc_id: round(r.log2_prob, 9) for r in m.scores(docs).collect()}
    b = {r.doc_id: round(r.log2_prob, 9) for r in m.scores(docs, max_broadcast=0).collect()}
    assert a == b


def test_cases(spark):
    rows = [(1, "a b", 1.0), (1, "a b", 1.0), (None, "a", 1.0), (2, None, 1.0), (3, " \n", 1.0), (4, "x " * 300_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, perplexity double")
    got = m.scores(docs).collect()
    assert sorted((r.doc_id, r.words) for r in got) == [(1, 2), (1, 2), (4, 300_000)]
    assert all(np.isfinite(r.perplexity) for r in got)
    assert m.scores(docs.limit(0)).count() == 0


def test_ngrams_that_occur_once_count(spark, tmp_path):
    """Counts without a cut-off against brute force, on texts whose n-grams are mostly single."""
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(60))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows, min_count=1)
    got = {r.doc_id: r for r in m.scores(spark.read.parquet(f"{tmp_path}/documents.parquet"), min_count=1).collect()}
    off = np.array([abs(got[i].log2_prob - want[i]) / got[i].words for i in want])
    assert np.mean(off) < 0.1


def leave_one_out(rows):
    """As the query scores, with dictionaries: one is taken off every quantised count."""
    counts = [Counter() for _ in range(3)]
    for _, t in rows:
        w = t.split()
        for n in (1, 2, 3):
            counts[n - 1].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    total, kinds = sum(counts[0].values()), len(counts[0])

    def c(g):
        n = counts[len(g) - 1][g]
        if not n:
            return 0.0
        level = int(math.log2(n)) + 1
        return max(0.0, (2 ** (level - 1) + 2**level - 1) / 2 - 1)

    out = {}
    for i, t in rows:
        w, s = t.split(), 0.0
        for k in range(len(w)):
            p = (c((w[k],)) + 1) / (total + kinds + 1)
            for n in (1, 2):
                if k >= n and (h := c(tuple(w[k - n : k]))) > 0:
                    p = m.WEIGHT * min(c(tuple(w[k - n : k + 1])), h) / h + (1 - m.WEIGHT) * p
            s += math.log2(p)
        out[i] = s
    return out


def mixed():
    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(200)}" for _ in range(r.choice([1, 2, 60])))) for i in range(80)]
    return rows + [(100 + i, rows[i][1]) for i in range(10)]


def test_scoring_equals_brute_force_where_no_probe_errs():
    """With the exact level of every n-gram in place of the filter, each document has the score of the dictionaries."""
    import pyarrow as pa
    from lodewerk.llm import textarrays as ta

    rows = mixed()
    ((_, words),) = ta.words_of(pa.array([t for _, t in rows]))
    names = np.concatenate([x for x, _ in m.ngrams(words, 60)])
    known, times = np.unique(names, return_counts=True)
    total, kinds = len(words), len(np.unique(words.hashes()))
    got = m.score_rows(words, 60, total, kinds, 1.0, lambda x: m.level_of(times[np.searchsorted(known, x)]))
    want = leave_one_out(rows)
    assert got.tolist() == pytest.approx([want[i] for i, _ in rows], rel=1e-9)


@pytest.mark.parametrize("max_broadcast", [m.MAX_BROADCAST, 0])
def test_the_query_is_close_to_brute_force(spark, max_broadcast):
    """The filter errs for about one n-gram in 22; most documents have the exact score."""
    rows, want = mixed(), leave_one_out(mixed())
    got = {r.doc_id: r for r in m.scores(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), min_count=1, discount=1.0, max_broadcast=max_broadcast).collect()}
    off = np.array([abs(got[i].log2_prob - want[i]) / got[i].words for i in want])
    assert set(got) == set(want) and np.mean(off) < 0.2 and np.mean(off < 1e-6) > 0.6


def test_texts_that_stand_twice_score_apart(spark, tmp_path):
    """Every text is new but those that stand there twice; the model tells them apart though all n-grams count."""
    r = random.Random(3)
    rows = [(i, " ".join(f"w{int(r.expovariate(0.02))}" for _ in range(r.choice([30, 80, 200])))) for i in range(300)]
    rows += [(1000 + i, rows[i][1]) for i in range(30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.log2_prob / r.words for r in m.query(spark, str(tmp_path)).collect()}
    twice = [got[i] for i in got if i < 30 or i >= 1000]
    once = [got[i] for i in got if 30 <= i < 1000]
    assert np.mean([a > b for a in twice for b in once]) > 0.99
