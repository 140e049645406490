import random

import numpy as np

from lodewerk.llm import decontaminate as d


def brute(docs, items, n):
    """The longest common run of words of every document and item, where it has n words; its first place in each."""
    out = set()
    for i, text in docs:
        for j, item in items:
            if None in (i, text, j, item):
                continue
            a, b, best = text.split(), item.split(), (0, 0, 0)
            for p in range(len(a)):
                for q in range(len(b)):
                    k = 0
                    while p + k < len(a) and q + k < len(b) and a[p + k] == b[q + k]:
                        k += 1
                    best = min(best, (-k, p, q))
            if -best[0] >= n:
                out.add((i, j, -best[0], best[1], best[2]))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdef")
    items = [(j, " ".join(word() for _ in range(r.choice([2, 6, 12, 25])))) for j in range(12)]
    docs = []
    for i in range(60):
        text = [word() for _ in range(r.choice([0, 3, 20, 40]))]
        if r.random() < 0.4:
            item = r.choice(items)[1].split()
            a = r.randrange(len(item))
            text += item[a:] + [word() for _ in range(r.randrange(4))]
        docs.append((i, " ".join(text)))
    return docs, items


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    tokens = np.concatenate([rng.integers(1, 4, 300), np.ones(40, np.int64)]).astype(np.uint32)
    order, _ = d.suffix_array(tokens, 500)
    suffixes = [tuple(tokens[i:]) for i in order]
    assert suffixes == sorted(suffixes)


def test_matches_equal_brute_force(spark):
    for seed in (1, 2):
        docs, items = corpus(seed)
        left = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
        right = spark.createDataFrame(items, "item_id bigint, text string")
        want = brute(docs, items, 5)
        assert want and {tuple(r) for r in d.find(left, right, 5).collect()} == want
        assert {tuple(r) for r in d.find(left, right, 5, max_broadcast=60).collect()} == want
        assert {r.doc_id for r in d.remove(left, right, 5, max_broadcast=60).collect()} == {i for i, _ in docs} - {w[0] for w in want}


def test_cases(spark):
    p = "one two three four five six seven eight"
    rows = [(1, p, 1), (1, p, 1), (2, "x " * 200_000 + p + " y", 1), (None, p, 1), (3, None, 1), (4, "", 1), (5, p.replace("four", "4"), None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, item_id bigint")
    bench = spark.createDataFrame([(7, p), (7, p), (8, "too short"), (None, p), (9, None), (10, "")], "item_id bigint, text string")
    assert sorted((r.doc_id, r.item_id, r.doc_word) for r in d.find(docs, bench).distinct().collect()) == [(1, 7, 0), (2, 7, 200_000)]
    assert sorted((r.doc_id or 0) for r in d.remove(docs, bench).collect()) == [3, 4, 5]
    assert d.remove(docs, bench).columns == docs.columns
    assert d.find(docs.limit(0), bench).count() == 0 == d.find(docs, bench.limit(0)).count()
    assert d.remove(docs, bench.limit(0)).count() == len(rows)
