"""Whole Arrow batches of text as numpy arrays: words, 64-bit hashes and packed blobs.

A *word* is a maximal run of bytes other than ASCII white space.  All hashes
are polynomial modulo 2**64 over random byte values, so the hash of any run of
words follows from prefix sums; they are equal in every process.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
BLOCK_BYTES = 1 << 20
_rng = np.random.default_rng(20_240_607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE, _WORD_BASE = U64(0x9E3779B97F4A7C15), U64(0xD1342543DE82EF95)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: np.uint64):
        self.bases = (base, U64(pow(int(base), -1, 1 << 64)))
        self.tables = [np.ones(1, U64), np.ones(1, U64)]

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        for k, base in enumerate(self.bases):
            t = self.tables[k]
            while len(t) < n:
                t = np.concatenate([t, t * U64(pow(int(base), len(t), 1 << 64))])
            self.tables[k] = t
        return self.tables[0], self.tables[1]


_bytes_powers, _words_powers = _Powers(_BASE), _Powers(_WORD_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit of the result depends on every bit of h."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without copies, and where each row starts (one more than rows). Nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes; a longer row makes a block of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


class Words:
    """Words of consecutive rows: bytes ``start:end`` of ``data``, row, hash; row r has words first[r]:first[r+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.data, self.offsets = data, offsets
        gap = separators[data]
        begins, ends = ~gap, ~gap
        begins[1:] &= gap[:-1]
        ends[:-1] &= gap[1:]
        full = np.flatnonzero(np.diff(offsets) > 0)
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        begins[heads] = ~gap[heads]
        ends[tails] = ~gap[tails]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)
        power, self._inverse = _bytes_powers.get(len(data) + 1)
        self._prefix = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE[data] * power[: len(data)], out=self._prefix[1:])

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the words, or of the byte ranges given."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mix((self._prefix[end] - self._prefix[start]) * self._inverse[start])


def words_of(column: pa.Array, size: int = BLOCK_BYTES, separators: np.ndarray = SPACE) -> Iterator[tuple[int, Words]]:
    """(first row, its Words) for blocks of whole rows."""
    data, offsets = flat(column)
    for lo, hi in blocks(offsets, size):
        yield lo, Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], separators)


def prefix_hashes(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix polynomial hashes of a token sequence (one longer), the powers, and their inverses."""
    power, inverse = _words_powers.get(len(tokens) + 1)
    prefix = np.zeros(len(tokens) + 1, U64)
    np.cumsum(tokens * power[: len(tokens)], out=prefix[1:])
    return prefix, power, inverse


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` tokens, by position; empty if there is none."""
    if len(tokens) < width:
        return np.zeros(0, U64)
    prefix, _, inverse = prefix_hashes(tokens)
    n = len(tokens) - width + 1
    return mix((prefix[width:] - prefix[:n]) * inverse[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    if len(values) < width:
        return values[:0]
    span, low = 1, values
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return low if span == width else np.minimum(low[: len(values) - width + 1], low[width - span :][: len(values) - width + 1])


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The concatenation of arange(start, start + count)."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)


def pack(*arrays: np.ndarray) -> bytes:
    return pickle.dumps(arrays, 5)


def unpack(blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(blob)


def split_by(bucket: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts rows by bucket, and where each bucket starts (n + 1)."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n + 1))


def fresh(columns: list[str], *names: str) -> list[str]:
    """Each name with so many underscores before it that no column has it, in whatever case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_bytes(docs: DataFrame) -> int:
    """The bytes of all texts: one scan of one column."""
    return docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("n")).first().n or 0


def buckets_for(size: int, each: int = 8 << 20, least: int = 12) -> int:
    """How many buckets a shuffle of so many bytes needs so that each covers about ``each`` of them."""
    return max(least, -(-size // each))


def least_by_hash(rows: DataFrame, n: int, column: str) -> DataFrame:
    """The n rows with the least hash of a column: a sample that doesn't depend on order or partitions.

    Rows above a bound that lets through somewhat more than n go first, so what
    reaches one place doesn't grow with the number of partitions.
    """
    hashed = rows.withColumn("_h", F.shiftrightunsigned(F.xxhash64(column), 1))
    share = (n + 4 * n**0.5 + 16) / max(rows.count(), 1)
    while True:
        part = hashed.filter(F.col("_h") <= int(share * 2.0**63)) if share < 1 else hashed
        if share >= 1 or part.count() >= n:
            return part.orderBy("_h", column).limit(n).drop("_h")
        share *= 2


def ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, mark, text) and more: rows that have an id, with a hash of the text by which equal ids are told apart."""
    return docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
