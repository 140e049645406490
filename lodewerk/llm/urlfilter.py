"""URL filter: gradient-boosted trees on lexical features.

Features of a URL: its length and its host's, depth of the path, digit ratio,
entropy of its characters, parameters, hyphens and dots of the host, longest
run of letters or digits, and statistics of its host's suffix (the last two
labels): the smoothed rate of bad labels and how many URLs have it, over all
labelled URLs.  Trees are grown by histograms on logistic loss; at most
``max_sample`` labelled URLs, the least by hash, are used to grow them, and the
rate of a row's own suffix leaves out the fifth of the rows it belongs to.

``query`` takes labels from a list of host words (``BAD_HOSTS``): a URL is
labelled bad if its host has one of them, and not bad otherwise.

Results by case: a null URL has a null score and isn't blocked; an empty one is
scored like any other; repeated rows have equal scores; with labels of one kind
alone, or none, the score is their smoothed rate; an empty table gives no rows.
Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta

BAD_HOSTS = ("casino", "pills", "bets", "ads-track", "porn", "xxx", "viagra", "lottery", "jackpot", "payday", "torrent", "warez")
MAX_SAMPLE = 20_000
THRESHOLD = 0.5
TREES, DEPTH, RATE, BINS, LEAST_ROWS = 40, 3, 0.3, 32, 10
PRIOR = 20.0
FOLDS = 5
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)"
NAMES = ("length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "dots", "longest_run", "suffix_rate", "suffix_count")
_DIGIT, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _count(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[offsets[1:]] - total[offsets[:-1]]


def lexical(urls: pa.Array, hosts: pa.Array) -> np.ndarray:
    """A row of the features but those of the suffix for each URL."""
    (data, offsets), (host, host_offsets) = ta.flat(urls), ta.flat(hosts)
    n, size = len(urls), np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    entropy = np.zeros(n)
    for lo in range(0, n, 4096):
        hi = min(n, lo + 4096)
        part = slice(offsets[lo], offsets[hi])
        share = np.bincount((row[part] - lo) * 256 + data[part], minlength=(hi - lo) * 256).reshape(-1, 256) / np.maximum(size[lo:hi], 1)[:, None]
        entropy[lo:hi] = -(share * np.log2(np.where(share > 0, share, 1.0))).sum(axis=1)
    query = np.zeros(len(data) + 1, np.int64)
    query[1:] = np.cumsum(data == 63)
    after = query[1:] > query[offsets[:-1]][row] if len(data) else np.zeros(0, bool)
    path = ~after & (data == 47)
    # runs of letters or of digits
    kind = np.where(_DIGIT[data], 1, np.where(_LETTER[data], 2, 0))
    new = np.ones(len(data), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    longest = np.zeros(n, np.int64)
    runs = np.where(kind[heads] > 0, np.diff(np.append(heads, len(data))), 0)
    np.maximum.at(longest, row[heads], runs)
    given = np.where(_count(data == 63, offsets) > 0, _count(after & (data == 61), offsets), 0)
    return np.column_stack([size, np.diff(host_offsets), np.maximum(_count(path, offsets) - 2, 0), _count(_DIGIT[data], offsets) / np.maximum(size, 1), entropy, given, _count(host == 45, host_offsets), _count(host == 46, host_offsets), longest]).astype(float)


@dataclass
class Trees:
    """Boosted trees, each complete to DEPTH: features and cuts by node, values by leaf."""

    start: float
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total, at = np.full(len(x), self.start), np.arange(len(x))
        for feature, cut, value in zip(self.features, self.cuts, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[at, feature[node]] > cut[node])
            total += value[node - (2**DEPTH - 1)]
        return total

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosting on logistic loss; splits by gain over histograms of quantiles."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Trees(float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])  # bin b: at most edge b
    raw = np.full(len(y), model.start)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, cut, node = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf), np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            gain_best, split = np.full(width, 1e-6), np.full(width, -1)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key, m = (node - first) * (len(e) + 1) + bins[:, f], width * (len(e) + 1)
                gs, hs, ns = (np.bincount(key, w, m).reshape(width, -1) for w in (g, h, None))
                gl, hl, nl = (np.cumsum(v, axis=1)[:, :-1] for v in (gs, hs, ns))
                gt, ht, nt = gs.sum(1)[:, None], hs.sum(1)[:, None], ns.sum(1)[:, None]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = -1
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > gain_best
                gain_best, split = np.where(better, value, gain_best), np.where(better, top, split)
                feature[first : first + width] = np.where(better, f, feature[first : first + width])
            for k in range(width):
                if split[k] >= 0:
                    cut[first + k] = edges[feature[first + k]][split[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - (2**DEPTH - 1)
        value = RATE * np.bincount(leaf, g, 2**DEPTH) / (np.bincount(leaf, h, 2**DEPTH) + 1)
        model.features.append(feature)
        model.cuts.append(cut)
        model.values.append(value)
        raw += value[leaf]
    return model


def _parts(urls: DataFrame) -> DataFrame:
    """With _url, _host and _suffix: the last two labels of the host."""
    host = F.lower(F.regexp_extract(F.col("_url"), HOST, 1))
    return urls.withColumn("_host", host).withColumn("_suffix", F.substring_index("_host", ".", -2))


def train(labelled: DataFrame, max_sample: int = MAX_SAMPLE) -> tuple[Trees, DataFrame, float]:
    """From labelled URLs (url, label 0/1): trees, statistics by suffix (_suffix, _bad, _all), the rate of all."""
    rows = _parts(labelled.filter("url is not null and label is not null").select(F.col("url").alias("_url"), F.col("label").cast("double").alias("label")))
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64("_url"), F.lit(FOLDS)))
    folds = rows.groupBy("_suffix", "_fold").agg(F.sum("label").alias("_bad"), F.count("*").alias("_all"))
    suffixes = folds.groupBy("_suffix").agg(F.sum("_bad").alias("_bad"), F.sum("_all").alias("_all"))
    overall = rows.agg(F.coalesce(F.avg("label"), F.lit(0.0)).alias("r")).first().r
    sample = ta.least_by_hash(rows, max_sample, "_url").join(suffixes, "_suffix").join(folds.withColumnsRenamed({"_bad": "_own_bad", "_all": "_own"}), ["_suffix", "_fold"])
    got = sample.select("_url", "_host", "label", (F.col("_bad") - F.col("_own_bad")).alias("_bad"), (F.col("_all") - F.col("_own")).alias("_all"), F.col("_all").alias("_count")).toPandas().sort_values(["_url", "label"])
    y = got.label.to_numpy(float)
    if not len(y):
        return Trees(float(np.log(0.5))), suffixes, overall
    bad, count = got._bad.to_numpy(float), got._all.to_numpy(float)
    x = np.column_stack([lexical(pa.array(got._url, pa.string()), pa.array(got._host, pa.string())), (bad + PRIOR * overall) / (count + PRIOR), got._count.to_numpy(float)])
    return grow(x, y), suffixes, overall


def score(pages: DataFrame, model: tuple[Trees, DataFrame, float], threshold: float = THRESHOLD) -> DataFrame:
    """(page_id, url, score, blocked) of every page."""
    trees, suffixes, overall = model

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, hosts = batch.column(1), batch.column(2)
            bad, count = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (3, 4))
            x = np.column_stack([lexical(urls, hosts), (bad + PRIOR * overall) / (count + PRIOR), count])
            got = np.round(trees.predict(x), 6)
            none = np.asarray(urls.is_null())
            yield pa.RecordBatch.from_arrays([batch.column(0), urls, pa.array(got, pa.float64(), mask=none), pa.array((got >= threshold) & ~none)], ["page_id", "url", "score", "blocked"])

    rows = _parts(pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("_url"))).join(suffixes, "_suffix", "left")
    return rows.select("page_id", "_url", "_host", F.coalesce("_bad", F.lit(0.0)).alias("_bad"), F.coalesce("_all", F.lit(0)).alias("_all")).mapInArrow(scan, "page_id bigint, url string, score double, blocked boolean")


def labels_by_host(pages: DataFrame, words: tuple[str, ...] = BAD_HOSTS) -> DataFrame:
    """(url, label): bad if the host has one of the words."""
    host = F.lower(F.regexp_extract("url", HOST, 1))
    return pages.filter("url is not null").select("url", host.rlike("|".join(w.replace("-", r"\-") for w in words)).cast("int").alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return score(pages, train(labels_by_host(pages)))
