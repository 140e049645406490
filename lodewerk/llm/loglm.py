"""Language-model scores from a log-frequency Bloom filter.

Counts of all n-grams of one to three words over the whole corpus are quantised
to powers of two: an n-gram of count c has the levels 1 to 1 + floor(log2 c),
and each of them is put into one Bloom filter.  Reading a count means probing
for level 1, 2, ... until a probe fails; errors can only raise a level, by one
with the filter's error rate (about 1 in 22), by two with its square.
Probabilities interpolate the orders: P(w|uv) = l c(uvw)/c(uv) + (1-l) P(w|v),
down to (c(w) + 1) / (N + V + 1).  ``discount`` is taken off every count before
that, down to 0.  The query keeps all n-grams and discounts 1: a word is
predicted from all *other* occurrences of its n-grams, so that what stands only
once tells nothing about itself and the lower orders decide.  ``scores`` by
itself discounts nothing and leaves out n-grams of two and three words that
occur less than ``min_count`` times.

The filter is made in shards, by n-gram, and grows with the corpus.  Up to
``max_broadcast`` bytes it is broadcast; beyond that n-grams travel to the
shards and their levels back, with the same result.  N-grams are named by
hashes with 6 bits more than it takes to number the bytes of the texts, which
are several times as many.

A *word* is what stands between white space; n-grams don't cross documents.
Results by case: rows with a null id, text or without words have no score;
repeated rows count as often as they stand there and have a row each; an empty
table gives no rows.  Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import cut
from . import textarrays as ta

ORDERS = 3
MIN_COUNT = 2
WEIGHT = 0.7  # of an order against those below it
BITS_EACH = 7  # of filter for a level of an n-gram
MAX_BROADCAST = 256 << 20
COUNT_BYTES = 2 << 20
SHARD_BYTES = 8 << 20
MAX_LEVEL = 48
U64 = np.uint64
SCORES = "doc_id bigint, words bigint, log2_prob double, perplexity double"


def ngrams(words: ta.Words, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order the names of its n-grams and the word at which each ends."""
    hashes, out = words.hashes(), []
    at = np.arange(len(hashes))
    for n in range(1, ORDERS + 1):
        ends = at[at - words.first[words.row] >= n - 1]
        name = hashes[ends - n + 1]
        for k in range(n - 2, -1, -1):
            name = ta.mix(name * U64(0x9FB21C651E98DF25) + hashes[ends - k])
        out.append((ta.mix(name + U64(n)) >> U64(64 - bits), ends))
    return out


def pack(names: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted names as differences and their counts, by byte planes."""
    gaps = np.diff(names, prepend=U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.compress(gaps + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = len(raw) // 12
    gaps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view("<u8").ravel()
    return np.cumsum(gaps, dtype=np.uint64), np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def shard_of(names: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shards are ranges of names."""
    return ((names >> U64(bits - 20)) * U64(shards)) >> U64(20)


def _slots(names: np.ndarray, level: int, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit cell of a level of n-grams and the four bits in it."""
    h = ta.mix(names + U64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    mask = np.zeros(len(h), U64)
    for k in range(4):
        mask |= U64(1) << ((h >> U64(6 * k)) & U64(63))
    return ((h >> U64(24)) % np.asarray(size).astype(U64)).astype(np.int64), mask


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1]  # 1 + floor(log2)


def make_segment(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The filter of n-grams with their counts."""
    levels = [level_of(c) for _, c in parts]
    cells = np.zeros(max(64, int(sum(x.sum() for x in levels)) * BITS_EACH // 64), U64)
    for (names, _), top in zip(parts, levels, strict=True):
        for level in range(1, int(top.max(initial=0)) + 1):
            cell, mask = _slots(names[top >= level], level, len(cells))
            np.bitwise_or.at(cells, cell, mask)
    return cells


def probe(names: np.ndarray, cells: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The level of each n-gram: probes until one fails."""
    found = np.zeros(len(names), np.int64)
    live, level = np.flatnonzero(size > 0), 1
    while len(live) and level <= MAX_LEVEL:
        cell, mask = _slots(names[live], level, size[live])
        live = live[(cells[base[live] + cell] & mask) == mask]
        found[live] = level
        level += 1
    return found


def expected(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; level 0 is count 0."""
    return np.where(levels > 0, (2.0 ** (levels - 1) + 2.0**levels - 1) / 2, 0.0)


def score_rows(words: ta.Words, bits: int, total: int, kinds: int, discount: float, levels: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of the binary logarithms of the words' probabilities, by row; ``levels`` reads those of distinct n-grams."""
    counts = []
    for names, ends in ngrams(words, bits):
        distinct, place = np.unique(names, return_inverse=True)
        got = np.zeros(len(words))
        got[ends] = np.maximum(expected(levels(distinct)) - discount, 0.0)[place]
        counts.append(got)
    prob = (counts[0] + 1) / (total + kinds + 1)
    for n in range(1, ORDERS):
        history = np.zeros(len(words))
        history[1:] = counts[n - 1][:-1]
        deep = np.arange(len(words)) - words.first[words.row] >= n
        known = deep & (history > 0)
        ratio = np.minimum(counts[n], history) / np.where(known, history, 1.0)
        prob = np.where(known, WEIGHT * ratio + (1 - WEIGHT) * prob, prob)
    sums = np.concatenate([[0.0], np.cumsum(np.log2(prob))])
    return sums[words.first[1:]] - sums[words.first[:-1]]


def _rows(ids: np.ndarray, words: ta.Words, logs: np.ndarray) -> list[pa.Array]:
    has = np.flatnonzero(words.counts)
    n = words.counts[has]
    return [ta.ints(ids[has]), ta.ints(n), pa.array(logs[has]), pa.array(2.0 ** (-logs[has] / n))]


def count(keyed: DataFrame, bits: int, shards: int, min_count: int) -> DataFrame:
    """(shard, segment, cells, total, kinds): the filter's segments with the number of words and of different words in each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in ta.words_of(batch.column(2), COUNT_BYTES):
                runs = []
                for names, _ in ngrams(words, bits):
                    names = np.sort(names)
                    heads = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
                    times, names = np.diff(np.append(heads, len(names))), names[heads]
                    runs.append((names, times, shard_of(names, bits, shards)))
                used = np.unique(np.concatenate([s for _, _, s in runs]))
                columns = []
                for names, times, shard in runs:
                    bounds = zip(np.searchsorted(shard, used), np.searchsorted(shard, used, "right"), strict=True)
                    columns.append([pack(names[a:b], times[a:b]) for a, b in bounds])
                yield pa.RecordBatch.from_arrays([ta.ints(used), *(pa.array(c, pa.binary()) for c in columns)], ["shard", *(f"n{i + 1}" for i in range(ORDERS))])

    def add_up(table: pa.Table) -> pa.Table:
        parts, total, kinds = [], 0, 0
        for n in range(1, ORDERS + 1):
            got = [unpack(x) for x in table.column(f"n{n}").to_pylist()]
            names, times = np.concatenate([a for a, _ in got]), np.concatenate([c for _, c in got])
            order = np.argsort(names, kind="stable")
            names, times = names[order], times[order]
            heads = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]])) if len(names) else np.zeros(0, np.int64)
            times = np.add.reduceat(times, heads) if len(heads) else times[:0]
            if n == 1:
                total, kinds = int(times.sum()), len(heads)
            keep = times >= (min_count if n > 1 else 1)
            parts.append((names[heads][keep], times[keep]))
        cells = make_segment(parts)
        return pa.table({"shard": table.column("shard").slice(0, 1), "segment": pa.array([cells.tobytes()], pa.binary()), "cells": ta.ints(np.array([len(cells)])), "total": ta.ints(np.array([total])), "kinds": ta.ints(np.array([kinds]))})

    columns = ", ".join(f"n{i + 1} binary" for i in range(ORDERS))
    return keyed.mapInArrow(scan, f"shard bigint, {columns}").groupBy("shard").applyInArrow(add_up, "shard bigint, segment binary, cells bigint, total bigint, kinds bigint")


def scores(docs: DataFrame, min_count: int = MIN_COUNT, max_broadcast: int = MAX_BROADCAST, discount: float = 0.0) -> DataFrame:
    """(doc_id, words, log2_prob, perplexity) of every document, under a model of all of them."""
    keyed = ta.keyed(docs)
    text = ta.text_bytes(docs)
    shards = ta.buckets_for(text, SHARD_BYTES)
    bits = min(64, max(32, text.bit_length() + 6))  # there are fewer n-grams than bytes
    segments = cut(count(keyed, bits, shards, min_count))
    docs.sparkSession.sparkContext._jvm.System.gc()  # the driver lets go of the counts' shuffle files, which nothing reads again
    made = segments.agg(F.sum("cells").alias("cells"), F.sum("total").alias("total"), F.sum("kinds").alias("kinds")).first()
    total, kinds = made.total or 0, made.kinds or 0
    if 8 * (made.cells or 0) > max_broadcast:
        return _scores_by_shuffle(keyed, segments, bits, shards, total, kinds, discount)
    base, size, whole, at = np.zeros(shards, np.int64), np.zeros(shards, np.int64), np.zeros(made.cells or 0, U64), 0
    for row in segments.select("shard", "segment").toLocalIterator():
        cells = np.frombuffer(row.segment, U64)
        base[row.shard], size[row.shard] = at, len(cells)
        whole[at : at + len(cells)] = cells
        at += len(cells)
    shared = docs.sparkSession.sparkContext.broadcast((base, size, whole))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, size, cells = shared.value

        def levels(names: np.ndarray) -> np.ndarray:
            shard = shard_of(names, bits, shards).astype(np.int64)
            return probe(names, cells, base[shard], size[shard])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, words in ta.words_of(batch.column(2)):
                logs = score_rows(words, bits, total, kinds, discount, levels)
                yield pa.RecordBatch.from_arrays(_rows(ids[lo : lo + len(words.counts)], words, logs), ["doc_id", "words", "log2_prob", "perplexity"])

    return keyed.mapInArrow(scan, SCORES)


def _scores_by_shuffle(keyed: DataFrame, segments: DataFrame, bits: int, shards: int, total: int, kinds: int, discount: float) -> DataFrame:
    """The same without a broadcast: blocks of text send their n-grams to the shards of the filter and get levels."""

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            _, offsets = ta.flat(batch.column(2))
            for lo, hi in ta.blocks(offsets, COUNT_BYTES):
                data, inner = ta.flat(batch.column(2).slice(lo, hi - lo))
                blob = zstandard.compress(ta.pack(ids[lo:hi], inner, data), 1)
                yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["text"])

    def words_of(blob: bytes) -> tuple[np.ndarray, ta.Words]:
        ids, offsets, data = ta.unpack(zstandard.decompress(blob))
        return ids, ta.Words(data, offsets)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                names = np.unique(np.concatenate([x for x, _ in ngrams(words_of(blob)[1], bits)]))
                bounds = np.searchsorted(shard_of(names, bits, shards), np.arange(shards + 1).astype(U64))
                used = np.flatnonzero(np.diff(bounds))
                parts = [pack(names[bounds[s] : bounds[s + 1]], np.zeros(bounds[s + 1] - bounds[s], np.int64)) for s in used]
                yield pa.RecordBatch.from_arrays([ta.ints(used), ta.ints(np.full(len(used), number)), pa.array(parts, pa.binary())], ["shard", "block", "names"])

    def answer(asked: pa.Table, segment: pa.Table) -> pa.Table:
        cells, out = np.frombuffer(segment.column("segment")[0].as_py(), U64), []
        for blob in asked.column("names").to_pylist():
            names, _ = unpack(blob)
            out.append(pack(names, probe(names, cells, np.zeros(len(names), np.int64), np.full(len(names), len(cells)))))
        return pa.table({"block": asked.column("block"), "levels": pa.array(out, pa.binary())})

    def finish(mine: pa.Table, answers: pa.Table) -> pa.Table:
        ids, words = words_of(mine.column("text")[0].as_py())
        parts = [unpack(x) for x in answers.column("levels").to_pylist()]
        names, found = np.concatenate([np.zeros(0, U64), *(a for a, _ in parts)]), np.concatenate([np.zeros(0, np.int64), *(b for _, b in parts)])
        order = np.argsort(names)
        names, found = names[order], found[order]
        logs = score_rows(words, bits, total, kinds, discount, lambda distinct: found[np.searchsorted(names, distinct)])
        return pa.table(_rows(ids, words, logs), ["doc_id", "words", "log2_prob", "perplexity"])

    texts = cut(keyed.mapInArrow(block, "text binary").select(F.monotonically_increasing_id().alias("block"), "text"))
    asked = texts.mapInArrow(ask, "shard bigint, block bigint, names binary")
    levels = asked.groupBy("shard").cogroup(segments.select("shard", "segment").groupBy("shard")).applyInArrow(answer, "block bigint, levels binary")
    return texts.groupBy("block").cogroup(levels.groupBy("block")).applyInArrow(finish, SCORES)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(ta.documents(spark, sf_dir), min_count=1, discount=1.0)
