import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodewerk.llm import urlfilter as u


def test_features_equal_their_definitions():
    urls = ["http://www.a-b.example.com/en/12/x.html?p=1&q=abc=", "", "https://x.org", "a/b/c", "http://h.com/?u=http://z/y/1"]
    hosts = ["www.a-b.example.com", "", "x.org", "a", "h.com"]
    got = u.lexical(pa.array(urls), pa.array(hosts))
    for url, host, x in zip(urls, hosts, got, strict=True):
        n, path = len(url), url.split("?")[0]
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values())
        query = url.split("?", 1)[1] if "?" in url else ""
        want = [n, len(host), max(path.count("/") - 2, 0), sum(c.isdigit() for c in url) / max(n, 1), entropy, query.count("="), host.count("-"), host.count(".")]
        assert np.allclose(x[:8], want)


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 5))
    y = ((x[:, 1] > 0.6) & (x[:, 3] < 0.5) | (x[:, 0] > 0.9)).astype(float)
    model = u.grow(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_hosts_that_were_not_labelled(spark):
    """Trained without two bad hosts, it still finds them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    labelled = u.labels_by_host(pages)
    held = F.col("url").rlike("free-bets|ads-track") | (F.pmod(F.xxhash64("url"), F.lit(5)) == 0)
    got = u.score(pages.filter(held), u.train(labelled.filter(~held))).join(labelled.distinct(), "url").select("label", "blocked").toPandas()
    assert (got.label == got.blocked.astype(int)).mean() > 0.97
    assert got.blocked[got.label == 1].mean() > 0.9


def test_cases(spark):
    rows = [(1, None, 9), (2, "", 9), (None, "http://casino.example.com/1", 9), (3, "http://a.example.com/" + "x" * 500_000, None), (3, "http://a.example.com/1", 9), (3, "http://a.example.com/1", 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, score bigint")
    got = u.score(pages, u.train(u.labels_by_host(pages))).collect()
    assert len(got) == 6
    assert [(r.score, r.blocked) for r in got if r.url is None] == [(None, False)]
    assert len({r.score for r in got if r.url == "http://a.example.com/1"}) == 1
    empty = pages.limit(0)
    assert u.score(empty, u.train(u.labels_by_host(empty))).count() == 0
    assert u.score(pages, u.train(u.labels_by_host(empty))).count() == 6
