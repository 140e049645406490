"""Near duplicates by Order MinHash, verified by banded alignment.

A k-mer here is ``k`` consecutive words, labelled with its occurrence number in
the document.  Each of ``SKETCHES`` hash functions picks the ``PICK`` least
labelled k-mers and keeps them in the order in which they stand in the text, so
equal picks speak for a small edit distance and not just for common words.
Documents with an equal pick are candidates; a candidate pair is a near copy if
1 - (word edit distance) / (words of the longer) is ``threshold`` or more, the
distance found by alignment within a band as wide as the threshold allows.
Groups are the connected components of all such pairs.

Every candidate pair within a bucket is either aligned or already joined by a
chain of aligned pairs: first each member is aligned with the least member of
its bucket, then all members of a bucket that are still apart with one another.

Short documents (to ``SHORT`` words) are also sketched with 2-mers, long ones
(from ``SHORT`` / 2) with 3-mers; lengths of a near pair differ so little that
they have one kind in common; so a threshold below 0.5 is refused.

Results by case: rows with a null id are in no group and stay; null texts are
in no group; equal texts, empty ones too, are one group; texts without words
have no near copies but equal ones; repeated ids count as one document with the
least text by digest as its text.  An empty table gives no rows.  Other columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components, cut
from . import textarrays as ta

THRESHOLD = 0.8
SKETCHES = 40
PICK = 2
SHORT = 40
MAX_BROADCAST = 32 << 20
U64 = np.uint64
_rng = np.random.default_rng(77)
_XOR = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)
_MUL = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_TOP = U64(0xFFFFFFFFFFFFFFFF)


def labelled(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many equal ones stand before it in its row)."""
    key = ta.mix(hashes ^ (row.astype(U64) * U64(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(key))
    occurrence = np.empty(len(key), U64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(U64)
    return ta.mix(hashes + occurrence * U64(0xD6E8FEB86659FD93))


def picks(values: np.ndarray, counts: np.ndarray, kind: int, sketches: int = SKETCHES) -> np.ndarray:
    """A sketches x rows matrix: hashes of the PICK least values in text order, for rows of ``counts`` values (none empty)."""
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    row = np.repeat(np.arange(len(counts)), counts)
    out = np.empty((sketches, len(counts)), U64)
    for j in range(sketches):
        h = (values ^ _XOR[j]) * _MUL[j]
        h ^= h >> U64(32)
        chosen, places = [], []
        for _ in range(PICK):
            least = np.minimum.reduceat(h, starts)
            at = np.flatnonzero(h == least[row])
            first = np.full(len(counts), len(h))
            np.minimum.at(first, row[at], at)
            chosen.append(least)
            places.append(first)
            h[at] = _TOP
        order = np.argsort(np.stack(places), axis=0, kind="stable")
        ordered = np.take_along_axis(np.stack(chosen), order, axis=0)
        total = np.full(len(counts), U64(j * 2 + kind))
        for part in ordered:
            total = ta.mix(total * U64(0xA24BAED4963EE407) + part)
        out[j] = total
    return out


def sketches_of(words: ta.Words, sketches: int = SKETCHES) -> list[np.ndarray]:
    """For each row its sketch values (none for a row without words)."""
    hashes, n = words.hashes(), len(words.counts)
    found: list[list[np.ndarray]] = [[] for _ in range(n)]
    for kind, (k, low, high) in enumerate(((2, 1, SHORT), (3, SHORT // 2, None))):
        rows = np.flatnonzero((words.counts >= low) & (words.counts <= (high or words.counts.max(initial=0))))
        if not len(rows):
            continue
        counts = np.maximum(words.counts[rows] - k + 1, 1)
        at = ta.ranges(words.first[rows], counts)
        kmer = hashes[at]
        for i in range(1, k):  # a row of fewer than k words has one k-mer, its words to the end
            inside = at + i < np.repeat(words.first[rows + 1], counts)
            kmer = ta.mix(kmer * U64(0x9FB21C651E98DF25) + np.where(inside, hashes[np.minimum(at + i, len(hashes) - 1)], U64(0)))
        made = picks(labelled(kmer, np.repeat(np.arange(len(rows)), counts)), counts, kind, sketches)
        for i, r in enumerate(rows):
            found[r].append(made[:, i])
    return [np.concatenate(x) if x else np.zeros(0, U64) for x in found]


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, mark, sketch, words, tokens): one row per document with id and text; tokens packed, mark a part of the digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for lo, words in ta.words_of(batch.column(2)):
                n = len(words.counts)
                tokens = (words.hashes() >> U64(32)).astype(np.uint32)
                blobs = [press.compress(tokens[a:b].tobytes()) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
                sketches = [x.view(np.int64) for x in sketches_of(words)]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in sketches])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*sketches, np.zeros(0, np.int64)])))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), batch.column(3).slice(lo, n), lists, ta.ints(words.counts), pa.array(blobs, pa.binary())], ["doc_id", "digest", "mark", "sketch", "words", "tokens"])

    has = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return has.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(F.col("text"), 256)).alias("digest"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("mark")).mapInArrow(scan, "doc_id bigint, digest binary, mark bigint, sketch array<bigint>, words bigint, tokens binary")


def distances(pairs: list[tuple[np.ndarray, np.ndarray]], most: np.ndarray) -> np.ndarray:
    """The edit distances of pairs of token sequences, or ``most`` + 1 where they are more.

    Common ends are stripped and pairs that must differ too much by their words
    alone set aside; the others are aligned many at a time in a band that
    widens fourfold up to ``most``.
    """
    result = np.empty(len(pairs), np.int64)
    rest: list[tuple[np.ndarray, np.ndarray]] = []
    todo = []
    for i, (a, b) in enumerate(pairs):
        a, b = _strip(a, b)
        gap = len(b) - len(a)
        if not len(a) or gap > most[i]:
            result[i] = min(gap, most[i] + 1)
        else:
            rest.append((a, b))
            todo.append(i)
    places = np.array(todo, np.int64)
    if not len(places):
        return result
    limit = most[places]
    alive = _word_bound(rest, limit) <= limit
    result[places[~alive]] = limit[~alive] + 1
    left, band = np.flatnonzero(alive), 12
    while len(left):
        size = np.array([len(rest[i][0]) for i in left])
        left = left[np.argsort(-size, kind="stable")]
        gap = np.array([len(rest[i][1]) - len(rest[i][0]) for i in left])
        wide = gap <= band
        now, again = left[wide], [left[~wide]]
        lo = 0
        while lo < len(now):
            each = 2 * len(rest[now[lo]][0]) + 4 * band + 3
            hi = lo + max(1, (1 << 20) // each)
            part = now[lo:hi]
            found = _banded([rest[i] for i in part], band)
            done = (found <= band) | (band >= limit[part])
            result[places[part[done]]] = np.minimum(found, limit[part] + 1)[done]
            again.append(part[~done])
            lo = hi
        left = np.concatenate(again)
        band *= 4
    return result


def _strip(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without what both begin and end with; the shorter first."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(np.argmin(same))
    a, b = a[head:], b[head:]
    n = min(len(a), len(b))
    if n:
        same = a[::-1][:n] == b[::-1][:n]
        tail = n if same.all() else int(np.argmin(same))
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    return (a, b) if len(a) <= len(b) else (b, a)


def _word_bound(pairs: list[tuple[np.ndarray, np.ndarray]], limit: np.ndarray, buckets: int = 4096) -> np.ndarray:
    """A lower bound of each distance: words of the longer without a partner in the shorter, whatever their order."""
    out = np.empty(len(pairs), np.int64)
    for lo in range(0, len(pairs), 64):
        part = pairs[lo : lo + 64]
        counts = []
        for side in (0, 1):
            tokens = np.concatenate([p[side] for p in part])
            row = np.repeat(np.arange(len(part)), [len(p[side]) for p in part])
            counts.append(np.bincount(row * buckets + (tokens & np.uint32(buckets - 1)).astype(np.int64), minlength=len(part) * buckets).reshape(len(part), buckets))
        out[lo : lo + 64] = np.array([len(p[1]) for p in part]) - np.minimum(*counts).sum(axis=1)
    return out


def _banded(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """The cost of the best alignment of each pair that keeps within ``band`` of the diagonal; exact where it is ``band`` or less.

    Pairs come with the shorter sequence first and the longest such first.
    """
    rows, width = np.array([len(a) for a, _ in pairs]), 2 * band + 1
    n, longest = len(pairs), max(len(b) for _, b in pairs)
    left = np.zeros((n, rows[0]), np.int64)
    right = np.full((n, max(longest, rows[0]) + width), -1, np.int64)
    for i, (a, b) in enumerate(pairs):
        left[i, : len(a)] = a
        right[i, band : band + len(b)] = b
    slope = np.arange(width, dtype=np.int32)
    row = np.repeat(np.where(slope >= band, slope - band, 1 << 28).astype(np.int32)[None], n, axis=0)
    live = n
    for i in range(rows[0]):  # cell c of row i stands for i words of a and i + c - band of b
        while rows[live - 1] <= i:
            live -= 1
        old = row[:live]
        new = old + (right[:live, i : i + width] != left[:live, i, None])
        np.minimum(new[:, :-1], old[:, 1:] + 1, out=new[:, :-1])
        new -= slope
        np.minimum.accumulate(new, axis=1, out=new)
        new += slope
        row[:live] = new
    end = np.array([len(b) - len(a) + band for a, b in pairs])
    return row[np.arange(n), end].astype(np.int64)


def bounded(df: DataFrame, width: int) -> DataFrame:
    """With a hint to broadcast it if its rows of ``width`` bytes are within ``MAX_BROADCAST``; else joins shuffle both sides."""
    return F.broadcast(df) if df.count() * width <= MAX_BROADCAST else df


def similar(pairs: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (src, src_mark, dst, dst_mark) those (src, dst) that alignment confirms.

    Tokens are shuffled once for each document that is compared with a src: the
    rows of a src come in one after another, its own tokens first, and need no
    more memory than a batch however many there are.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        at, mine = None, np.zeros(0, np.uint32)
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for lo in range(0, batch.num_rows, 1024):
                part, rows, compared = batch.slice(lo, 1024), [], []
                srcs, dsts, blobs = (part.column(c).to_pylist() for c in range(3))
                for i, (src, dst, blob) in enumerate(zip(srcs, dsts, blobs, strict=True)):
                    own = np.frombuffer(unpress.decompress(blob), np.uint32)
                    if dst is None:
                        at, mine = src, own
                    elif at == src:
                        rows.append(lo + i)
                        compared.append((mine, own))
                longer = np.array([max(len(a), len(b)) for a, b in compared], np.int64)
                most = ((1 - threshold) * longer + 1e-9).astype(np.int64)
                keep[np.array(rows, np.int64)] = distances(compared, most) <= most
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["src", "dst"]).filter(pa.array(keep))

    ends = pairs.select("src", F.col("dst").alias("other"), F.col("dst").alias("doc_id"), F.col("dst_mark").alias("mark"))
    own = pairs.select("src", F.lit(None).cast("bigint").alias("other"), F.col("src").alias("doc_id"), F.col("src_mark").alias("mark")).distinct()
    sides = bounded(cut(ends.unionByName(own)), 32)
    rows = tokens.join(sides, ["doc_id", "mark"]).select("src", F.col("other").alias("dst"), "tokens")
    return rows.repartition("src").sortWithinPartitions(F.col("src"), F.col("dst").asc_nulls_first()).mapInArrow(align, "src bigint, dst bigint")


def crossings(members: DataFrame, tokens: DataFrame, threshold: float) -> DataFrame:
    """Of (pick, rep, mark, words, part) the near pairs (src, dst) of one bucket and different parts.

    Tokens go once to each bucket of their document, so the shuffle grows with
    the members and not with their pairs; pairs are set aside by their lengths
    and by their words, which rules out no near one, and the rest aligned.
    Pairs with the least member have been aligned before.
    """
    spread = 256

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        ids: list[tuple[int, int]] = []
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        bucket: list[tuple[int, int, bytes]] = []
        held = None

        def close() -> pa.RecordBatch:
            most = np.array([int((1 - threshold) * max(len(a), len(b)) + 1e-9) for a, b in pairs], np.int64)
            near = distances(pairs, most) <= most
            found = np.array(ids, np.int64).reshape(-1, 2)[near]
            ids.clear()
            pairs.clear()
            return pa.RecordBatch.from_arrays([ta.ints(found.min(axis=1)), ta.ints(found.max(axis=1))], ["src", "dst"])

        def settle() -> Iterator[pa.RecordBatch]:
            bucket.sort(key=lambda x: x[0])
            own = [np.frombuffer(unpress.decompress(x[2]), np.uint32) for x in bucket]
            rep, part, size = np.array([x[0] for x in bucket]), np.array([x[1] for x in bucket]), np.array([len(x) for x in own])
            counts = np.stack([np.bincount(x & np.uint32(spread - 1), minlength=spread) for x in own]).astype(np.int32)
            for i in range(1, len(bucket) - 1):
                longer = np.maximum(size[i], size[i + 1 :])
                j = np.flatnonzero((part[i + 1 :] != part[i]) & (rep[i + 1 :] != rep[i]) & (np.minimum(size[i], size[i + 1 :]) >= threshold * longer - 1e-9))
                longer, j = longer[j], j + i + 1
                shared = np.minimum(counts[i], counts[j]).sum(axis=1)
                for k in j[longer - shared <= (1 - threshold) * longer + 1e-9].tolist():
                    ids.append((int(rep[i]), int(rep[k])))
                    pairs.append((own[i], own[k]))
                    if len(pairs) >= 1024:
                        yield close()
            bucket.clear()

        for batch in batches:
            picks, reps, parts, blobs = (batch.column(c).to_pylist() for c in range(4))
            for pick, rep, part, blob in zip(picks, reps, parts, blobs, strict=True):
                if pick != held and bucket:
                    yield from settle()
                held = pick
                bucket.append((rep, part, blob))
        if bucket:
            yield from settle()
        if pairs:
            yield close()

    sides = bounded(cut(members.select("pick", F.col("rep").alias("doc_id"), "mark", "part")), 40)
    rows = tokens.join(sides, ["doc_id", "mark"]).select("pick", F.col("doc_id").alias("rep"), "part", "tokens")
    return rows.repartition("pick").sortWithinPartitions("pick").mapInArrow(cross, "src bigint, dst bigint").distinct()


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, group_id) of all documents that have near copies; the group's id is its least document id."""
    if threshold < 0.5:
        raise ValueError("lengths of a near pair may differ twofold at most, else they have no kind of k-mers in common")
    signed = cut(signatures(docs))
    tokens = signed.select("doc_id", "mark", "tokens")
    # a repeated id counts once; of equal texts one is sketched on
    once = signed.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    texts = signed.groupBy("digest").agg(F.first("sketch").alias("sketch"), F.first("words").alias("words"), F.first("mark").alias("mark"))
    reps = once.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    exact = once.join(reps, "digest").filter("doc_id <> rep").select(F.col("rep").alias("src"), F.col("doc_id").alias("dst"))
    bands = reps.join(texts, "digest").select("rep", "mark", "words", F.explode("sketch").alias("pick"))
    bucket = Window.partitionBy("pick")
    # one shuffle: each member of a bucket of several learns the least
    members = bands.withColumn("least", F.min(F.struct("rep", "mark", "words")).over(bucket)).withColumn("high", F.max("rep").over(bucket))
    members = cut(members.filter("least.rep < high").select("pick", "rep", "mark", "words", "least"))

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs of which the lengths allow it, each once."""
        return pairs.filter(F.least("src_words", "dst_words") >= threshold * F.greatest("src_words", "dst_words") - 1e-9).select("src", "src_mark", "dst", "dst_mark").distinct()

    def end(name: str, of: str = "") -> list:
        return [F.col(f"{of}rep").alias(name), F.col(f"{of}mark").alias(f"{name}_mark"), F.col(f"{of}words").alias(f"{name}_words")]

    star = close(members.filter("rep > least.rep").select(*end("src", "least."), *end("dst")))
    first = cut(similar(star, tokens, threshold))
    parts = cut(connected_components(first))
    named = members.drop("least").join(bounded(parts.select(F.col("id").alias("rep"), "component"), 16), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
    named = named.withColumn("p", F.min("part").over(bucket)).withColumn("q", F.max("part").over(bucket)).filter("p < q").drop("p", "q")
    second = crossings(named, tokens, threshold)
    edges = exact.unionByName(parts.select(F.col("id").alias("src"), F.col("component").alias("dst"))).unionByName(second)
    return connected_components(edges).select(F.col("id").alias("doc_id"), F.col("component").alias("group_id"))


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that have a near copy of lesser id; columns as they were."""
    (name,) = ta.fresh(docs.columns, "_extra")
    extra = groups(docs, threshold).filter("doc_id <> group_id").select(F.col("doc_id").alias(name))
    return docs.join(extra, F.col("doc_id").cast("bigint") == F.col(name), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(ta.documents(spark, sf_dir))
