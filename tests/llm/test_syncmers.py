import random

import numpy as np
import pyarrow as pa

from lodewerk.llm import syncmers as s
from lodewerk.llm import textarrays as ta


def brute(text, k, n):
    """Positions of the closed syncmers, with each run of n words hashed on its own."""
    words = text.split()

    def value(i):
        data, offsets = ta.flat(pa.array([" ".join(words[i : i + n])]))
        return int(ta.window_hashes(ta.Words(data, offsets).hashes(), n)[0])

    out = []
    for i in range(len(words) - k + 1):
        inner = [value(j) for j in range(i, i + k - n + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out


def texts(seed=1):
    r = random.Random(seed)
    return [" ".join(r.choice("abcdef") * r.randrange(1, 4) for _ in range(r.choice([0, 3, 20, 90]))) for _ in range(25)]


def test_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in s.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"), 8, 3).collect()}
    for i, t in rows:
        assert list(got[i].positions) == brute(t, 8, 3)
        assert got[i].words == len(t.split()) and len(got[i].hashes) == len(got[i].positions)


def test_anchors_are_context_free_and_dense(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(200)]
    rows = [(1, " ".join([word() for _ in range(37)] + passage)), (2, " ".join(passage + [word() for _ in range(9)]))]
    prints = s.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = s.match(prints.filter("doc_id = 1"), prints.filter("doc_id = 2")).collect()
    assert [(f.left_id, f.right_id, f.shift) for f in found] == [(1, 2, -37)]
    at = np.array(prints.filter("doc_id = 2").first().positions)
    assert found[0].anchors == (at <= 200 - s.K).sum()
    assert np.diff(at).max() <= s.K - s.S + 1


def test_cases(spark):
    rows = [(1, None, "x"), (None, "a b", "x"), (2, "", "x"), (3, "w " * 300_000, "x"), (3, "w " * 300_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, positions string")
    out = s.fingerprints(docs).collect()
    assert sorted((r.doc_id or 0, r.words, len(r.positions)) for r in out) == [(0, 2, 0), (1, 0, 0), (2, 0, 0), (3, 300_000, 299_985), (3, 300_000, 299_985)]
    assert s.fingerprints(docs.limit(0)).count() == 0
