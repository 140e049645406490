"""Benchmark decontamination with suffix arrays over the training text.

Every shard of the corpus (whole documents, about a million words) gets a
suffix array of its words.  All suffixes of all test items are binary-searched
in it at once, one word deeper at a time; what remains at depth ``min_words``
are verbatim matches, which are then extended as far as they go and compared
word for word.  Shards need nothing from one another, so the text is read once
and never shuffled.  The test suffixes are broadcast in groups of at most
``max_broadcast`` bytes, one scan of the corpus for each group.

Results by case: a null or empty text matches nothing, and ``remove`` keeps
such rows; rows with a null id are not in the result of ``find``, while
``remove`` goes by their text; items of fewer than ``min_words`` words never
match; repeated rows match like any other; an empty corpus or benchmark gives
no rows.  Extra columns are ignored by ``find`` and kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta

MIN_WORDS = 8
SHARD_BYTES = 4 << 20
MAX_BROADCAST = 64 << 20
GROWTH = 6  # bytes of arrays for each byte of an item
MATCHES = "doc_id bigint, item_id bigint, match_words bigint, doc_word bigint, item_word bigint"


def suffix_array(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a uint32 sequence in the order of their first ``depth`` tokens at least, and the sorted keys of their first two.

    Prefix doubling: only suffixes that are still tied are sorted again.
    """
    n = len(tokens)
    key = tokens.astype(np.uint64) << np.uint64(32)
    key[:-1] |= tokens[1:].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    known = 2
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = group, -1
    tied = np.zeros(n, bool)
    tied[1:] = ~new[1:]
    tied[:-1] |= ~new[1:]
    slots = np.flatnonzero(tied)
    while len(slots) and known < depth:
        suffixes = order[slots]
        head, tail = rank[suffixes], rank[np.minimum(suffixes + known, n)] + 1
        by = np.argsort((head.astype(np.uint64) << np.uint64(32)) | tail.astype(np.uint64), kind="stable")
        suffixes, head, tail = suffixes[by], head[by], tail[by]
        order[slots] = suffixes
        new = np.ones(len(slots), bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        rank[suffixes] = np.maximum.accumulate(np.where(new, slots, 0))
        tied = np.zeros(len(slots), bool)
        tied[1:] = ~new[1:]
        tied[:-1] |= ~new[1:]
        slots, known = slots[tied], known * 2
    return order, sorted_key


def narrow(tokens: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within ranges of a suffix array, the parts whose token at ``depth`` is as wanted: many binary searches at once."""

    def bound(right: bool) -> np.ndarray:
        lo, hi = low.copy(), high.copy()
        while True:
            go = lo < hi
            if not go.any():
                return lo
            mid = (lo + hi) >> 1
            at = order[np.minimum(mid, len(order) - 1)] + depth
            value = np.where(at < len(tokens), tokens[np.minimum(at, len(tokens) - 1)], 0)
            less = go & ((value <= wanted) if right else (value < wanted))
            lo = np.where(less, mid + 1, lo)
            hi = np.where(go & ~less, mid, hi)

    return bound(False), bound(True)


class Benchmark:
    """The words of the test items with the starts of all suffixes of ``min_words`` or more."""

    def __init__(self, items: list[tuple[int, str]], min_words: int):
        self.ids = np.array([i for i, _ in items], np.int64)
        blob = pa.array([t for _, t in items], pa.string())
        data, offsets = ta.flat(blob)
        words = ta.Words(data, offsets)
        self.tokens = token(words.hashes())
        self.data, self.begin, self.end = data.copy(), words.start.astype(np.int32), words.end.astype(np.int32)
        self.item, self.first = words.row.astype(np.int32), words.first
        self.stop = words.first[1:][words.row].astype(np.int32) if len(words) else np.zeros(0, np.int32)
        self.starts = np.flatnonzero(self.stop - np.arange(len(words)) >= min_words)
        self.longest = int(words.counts.max(initial=0))
        self.min_words = min_words


    def word(self, i: int) -> bytes:
        return bytes(self.data[self.begin[i] : self.end[i]])


def token(hashes: np.ndarray) -> np.ndarray:
    """32-bit tokens above 0; 0 stands for the end of a document."""
    return np.maximum(hashes >> np.uint64(32), np.uint64(1)).astype(np.uint32)


def search(words: ta.Words, bench: Benchmark) -> list[tuple[int, int, int, int, int]]:
    """(row, item, words matched, first word in the row, first word in the item): the longest match of each row and item, the earliest if several."""
    if not len(words) or not len(bench.starts):
        return []
    # an end mark after each document keeps matches inside it
    place = np.arange(len(words)) + words.row
    tokens = np.zeros(len(words) + len(words.counts), np.uint32)
    tokens[place] = token(words.hashes())
    order, keys = suffix_array(tokens, max(bench.longest, 2))
    starts = bench.starts
    pair = (bench.tokens[starts].astype(np.uint64) << np.uint64(32)) | bench.tokens[starts + 1]
    low, high = np.searchsorted(keys, pair, "left"), np.searchsorted(keys, pair, "right")
    for depth in range(2, bench.min_words):
        alive = low < high
        starts, low, high = starts[alive], low[alive], high[alive]
        if not len(starts):
            return []
        low, high = narrow(tokens, order, low, high, depth, bench.tokens[starts + depth])
    alive = low < high
    starts, low, high = starts[alive], low[alive], high[alive]
    counts = high - low
    test, train = np.repeat(starts, counts), order[ta.ranges(low, counts)]
    maximal = (train == 0) | (test == bench.first[bench.item[test]])
    maximal |= tokens[np.maximum(train - 1, 0)] != bench.tokens[np.maximum(test - 1, 0)]
    test, train = test[maximal], train[maximal]
    length, growing = np.full(len(test), bench.min_words), np.ones(len(test), bool)
    while growing.any():
        more = growing & (test + length < bench.stop[test])
        t, d = np.minimum(test + length, len(bench.tokens) - 1), np.minimum(train + length, len(tokens) - 1)
        growing = more & (train + length < len(tokens)) & (bench.tokens[t] == tokens[d])
        length = length + growing
    back = np.full(len(tokens), -1)
    back[place] = np.arange(len(words))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, w, n in zip(test.tolist(), back[train].tolist(), length.tolist(), strict=True):
        row, item = int(words.row[w]), int(bench.item[t])
        found = 0  # the tokens are hashes: count the words that are really equal
        while found < n and bench.word(t + found) == bytes(words.data[words.start[w + found] : words.end[w + found]]):
            found += 1
        if found >= bench.min_words:
            entry = (-found, w - int(words.first[row]), t - int(bench.first[item]))
            best[row, item] = min(best.get((row, item), entry), entry)
    return [(row, item, -n, at, of) for (row, item), (n, at, of) in sorted(best.items())]


def _groups(bench: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    """The items in groups that take at most ``most`` bytes as arrays, about ``GROWTH`` times their text; one of them is on the driver at a time."""
    items = bench.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("bigint"), "text")
    group, held = [], 0
    for row in items.toLocalIterator():
        size = GROWTH * len(row.text.encode())
        if held and held + size > most:
            yield group
            group, held = [], 0
        group.append((row.item_id, row.text))
        held += size
    yield group


def find(docs: DataFrame, bench: DataFrame, min_words: int = MIN_WORDS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The longest verbatim match of every document with every test item, where it has ``min_words`` words or more."""
    spark = docs.sparkSession
    results = []
    for items in _groups(bench, max_broadcast):
        shared = spark.sparkContext.broadcast(Benchmark(items, max(2, min_words)))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for lo, words in ta.words_of(batch.column(1), SHARD_BYTES):
                    if found := search(words, shared.value):
                        rows = np.array(found, np.int64)
                        yield pa.RecordBatch.from_arrays([ta.ints(c) for c in (ids[lo + rows[:, 0]], shared.value.ids[rows[:, 1]], rows[:, 2], rows[:, 3], rows[:, 4])], ["doc_id", "item_id", "match_words", "doc_word", "item_word"])

        results.append(docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, MATCHES))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def remove(docs: DataFrame, bench: DataFrame, min_words: int = MIN_WORDS, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The documents without those that hold a passage of the benchmark; columns as they were. One scan, no shuffle."""
    spark = docs.sparkSession
    for items in _groups(bench, max_broadcast):
        shared = spark.sparkContext.broadcast(Benchmark(items, max(2, min_words)))
        place = docs.columns.index("text")

        def scan(batches: Iterator[pa.RecordBatch], shared=shared, place=place) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for lo, words in ta.words_of(batch.column(place), SHARD_BYTES):
                    keep[[lo + m[0] for m in search(words, shared.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(ta.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
