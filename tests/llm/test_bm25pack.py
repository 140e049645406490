import math
import random
from collections import Counter

import numpy as np
import pytest

from lodewerk.llm import bm25pack as p
from lodewerk.llm import textarrays as ta


def corpus(n=150, seed=5):
    r = random.Random(seed)
    return [(i, " ".join(r.choice("abcdefghijklmnopqrstuvwxyz") * r.choice([1, 1, 2, 3]) for _ in range(r.choice([1, 3, 10, 25, 70, 200])))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def lists(spark, rows, window, every, keep, block_seeds=p.BLOCK_SEEDS):
    """What the index returns, by seed."""
    keyed = ta.keyed(frame(spark, rows))
    sizes = [len(t.split()) for _, t in rows]
    seeds = p.seeds_of(keyed, window, every)
    name = {r.pack_id: r.doc_id for r in seeds.collect()}
    out = {}
    for r in p.neighbours(keyed, seeds.filter("room > 0").selectExpr("*", "cast(null as binary) as df"), len(rows), sum(sizes) / len(rows), keep, every, block_seeds)[0].collect():
        out.setdefault(name[r.pack_id], []).append((r.score, r.tie, r.doc_id, r.words))
    return {s: sorted(x, reverse=True) for s, x in out.items()}


def brute_scores(rows):
    bags = {i: Counter(t.split()) for i, t in rows}
    size = {i: sum(b.values()) for i, b in bags.items()}
    n, mean = len(rows), sum(size.values()) / len(rows)
    df = Counter(w for b in bags.values() for w in b)

    def score(s, d):
        return sum(round(p.UNIT * (math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * bags[d][w] * (p.K1 + 1) / (bags[d][w] + p.K1 * (1 - p.B + p.B * size[d] / mean)))) for w in bags[s] if w in bags[d])

    return score, size


@pytest.mark.parametrize("block_seeds", [p.BLOCK_SEEDS, 3])
@pytest.mark.parametrize("common", [p.COMMON, 4])
def test_the_index_returns_the_best_documents_of_the_whole_corpus(spark, block_seeds, common, monkeypatch):
    """Recall against brute force is 1, whatever the blocks and whether terms are columns or postings."""
    monkeypatch.setattr(p, "COMMON", common)
    rows, window, every, keep = corpus(), 300, 5, 6
    got = lists(spark, rows, window, every, keep, block_seeds)
    score, size = brute_scores(rows)
    for s in range(0, len(rows), every):
        fits = sorted((score(s, d) for d, _ in rows if d % every and size[d] <= window - size[s] and score(s, d) > 0), reverse=True)[:keep]
        mine = got.get(s, [])
        assert [x[0] for x in mine] == pytest.approx(fits, abs=2)  # a rounding to the even side
        assert all(abs(score(s, d) - x) <= 2 for x, _, d, _ in mine)


def brute_windows(found, rows, window, every, keep, least):
    """The same lists dealt out one by one; {seed: [neighbours]}; lists are longer than ever asked for."""
    size = {i: len(t.split()) for i, t in rows}
    room = {s: window - ((size[s] - 1) % window + 1) for s in size if s % every == 0}
    got, used, asking = {s: [] for s in room}, set(), set(room)
    while asking:
        listed = {s: [x for x in found.get(s, []) if x[3] <= room[s]][:keep] for s in asking}
        pairs = {(s, x) for s, xs in listed.items() for x in xs if x[2] not in used}
        while pairs:
            best = {}
            for s, x in pairs:
                if x[2] not in best or (x[0], x[1]) > best[x[2]][1][:2]:
                    best[x[2]] = (s, x)
            for s in room:
                for x in sorted((x for t, x in best.values() if t == s), reverse=True):
                    if x[3] <= room[s]:
                        got[s].append(x[2])
                        used.add(x[2])
                        room[s] -= x[3]
            pairs = {(s, x) for s, x in pairs if x[2] not in used and x[3] <= room[s]}
        asking = {s for s in asking if room[s] and len(listed[s]) >= keep and sum(x[2] not in used or x[2] in got[s] for x in listed[s]) < least}
        keep *= 4
    return got


def check(spark, rows, window, every, keep, least):
    all_of = lists(spark, rows, window, every, len(rows))
    want = brute_windows(all_of, rows, window, every, keep, least)
    got = p.windows(frame(spark, rows), window, every, keep, least).collect()
    place = {}
    for r in sorted(got, key=lambda r: (r.pack_id, r.place)):
        place.setdefault(r.pack_id, []).append(r)
    mine = {}
    for pieces in place.values():
        if pieces[0].doc_id % every == 0:
            mine.setdefault(pieces[0].doc_id, []).extend(r.doc_id for r in pieces[1:])
    assert mine == want
    whole(rows, got, window)
    return mine


def whole(rows, got, window):
    places = [(r.doc_id, w) for r in got for w in range(r.first_word, r.first_word + r.words)]
    assert sorted(places) == sorted((i, w) for i, t in rows for w in range(len(t.split())))
    load = Counter()
    for r in got:
        load[r.pack_id] += r.words
    assert max(load.values()) <= window
    assert len({(r.pack_id, r.place) for r in got}) == len(got)


def test_windows_equal_brute_force(spark):
    assert any(check(spark, corpus(), 300, 5, 6, 2).values())


def test_seeds_in_a_group_of_copies_share_it_out(spark):
    """Lists of two, thirty seeds and copies: those whose lists go to others ask again."""
    rows = corpus(40, 3) + [(i, "same words here and there") for i in range(40, 140)]
    assert sum(map(len, check(spark, rows, 30, 4, 2, 2).values())) > 60


def test_other_documents_stand_with_their_copies(spark):
    rows = [(51 + 50 * i, " ".join(f"{k}w{j}" for j in range(20))) for k in range(12) for i in range(k, 120, 12)]
    got = p.windows(spark.createDataFrame(rows, "doc_id bigint, text string"), window=100).collect()
    text = dict(rows)
    by = {}
    for r in got:
        by.setdefault(r.pack_id, set()).add(text[r.doc_id])
    assert np.mean([len(x) for x in by.values()]) < 2
    whole(rows, got, 100)


def test_terms_round_trip():
    terms = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 1000).astype(np.uint64))
    a, b = p.unpack_terms(p.pack_terms(terms, np.arange(1000)))
    assert (a == terms).all() and (b == np.arange(1000)).all()
    assert len(p.unpack_terms(p.pack_terms(terms[:0], np.arange(0)))[0]) == 0


def test_cases(spark):
    rows = [(50, "a b", 7), (50, "a b", 7), (50, "a c", 7), (1, "a b", 7), (1, "a b", 7), (None, "a", 7), (2, None, 7), (3, "", 7), (0, " \n", 7), (4, "x " * 200_000, None), (100, "y a " * 100_000, None), (-50, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, room bigint").withColumn("words", __import__("pyspark").sql.functions.lit(1)).withColumnRenamed("room", "pack_id")
    got = p.windows(docs).collect()
    assert Counter(r.doc_id for r in got) == {50: 3, 1: 2, 4: 98, 100: 98, -50: 1}
    whole([(i, t) for i, t, _ in rows if i is not None and t], got, p.WINDOW)
    assert p.windows(docs.limit(0)).count() == 0
    assert p.windows(docs.filter("doc_id = 1")).count() == 2
