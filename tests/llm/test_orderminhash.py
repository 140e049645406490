import random

import numpy as np
import pytest

from lodewerk.llm import orderminhash as o


def edit(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_banded_alignment_is_exact():
    r = random.Random(1)
    pairs, most = [], []
    for _ in range(600):
        a = [r.randrange(5) for _ in range(r.randrange(0, 40))]
        b = [x if r.random() > 0.2 else 9 for x in a if r.random() > 0.1] if r.random() < 0.6 else [r.randrange(5) for _ in range(r.randrange(0, 40))]
        pairs.append((np.array(a, np.uint32), np.array(b, np.uint32)))
        most.append(r.randrange(0, 30))
    got = o.distances(pairs, np.array(most))
    assert got.tolist() == [min(edit(list(a), list(b)), m + 1) for (a, b), m in zip(pairs, most, strict=True)]


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklmno") for _ in range(r.choice([1, 2, 3])))
    rows = []
    for _ in range(60):
        base = [word() for _ in range(r.choice([5, 8, 15, 40, 90, 150]))]
        for _ in range(r.choice([1, 1, 2, 5, 12])):
            rate = r.choice([0, 0.02, 0.05, 0.1, 0.25])
            copy = [x for w in base if r.random() > rate / 3 for x in ([word()] if r.random() < rate / 3 else [w, word()] if r.random() < rate / 3 else [w])]
            rows.append((len(rows), " ".join(copy)))
    return rows


@pytest.mark.parametrize("seed", [3])
def test_groups_against_all_pairs(spark, seed):
    rows = corpus(seed)
    got = {r.doc_id: r.group_id for r in o.groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    near = []
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            x, y = a.split(), rows[j][1].split()
            n = max(len(x), len(y))
            if min(len(x), len(y)) >= o.THRESHOLD * n and edit(x, y) <= (1 - o.THRESHOLD) * n + 1e-9:
                near.append((j, i))
                a_, b_ = sorted((root(i), root(j)))
                parent[b_] = a_
    found = sum(got.get(i, -1) == got.get(j, -2) for i, j in near)
    assert found >= 0.97 * len(near) > 100
    for i, g in got.items():  # nothing joins that single links don't
        assert root(i) == root(g)


def test_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, "a b c", "x"), (None, "a b c", "x"), (3, None, "x"), (4, None, "x"), (5, "", "x"), (6, "", "x"), (7, long, "x"), (8, long + " tail", "x"), (9, "one", None), (10, " \n", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, group_id string")
    assert sorted(map(tuple, o.groups(docs).collect())) == [(1, 1), (2, 1), (5, 5), (6, 5), (7, 7), (8, 7)]
    assert sorted((r.doc_id or 0) for r in o.one_of_each(docs).collect()) == [0, 1, 1, 3, 4, 5, 7, 9, 10]
    assert o.groups(docs.limit(0)).count() == 0


def test_columns_with_the_names_used_inside(spark):
    docs = spark.createDataFrame([(1, "a b c", 1, 2), (2, "a b c", 1, 2)], "doc_id bigint, text string, _extra int, __Extra int")
    got = o.one_of_each(docs)
    assert got.columns == docs.columns and [r.doc_id for r in got.collect()] == [1]


def test_a_threshold_that_parts_kinds_is_refused(spark):
    with pytest.raises(ValueError):
        o.groups(spark.createDataFrame([], "doc_id bigint, text string"), 0.4)


def test_edits_that_lie_evenly_apart(spark):
    """Every fifth word replaced, so similarity is 0.8 and few runs of words stay: most such pairs are found."""
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(60):
        base = [word() for _ in range(200)]
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(word() if k % 5 == 4 else w for k, w in enumerate(base)))]
    got = {r.doc_id: r.group_id for r in o.groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()}
    assert sum(got.get(2 * i + 1) == 2 * i for i in range(60)) >= 0.75 * 60
