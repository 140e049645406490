"""Passages of ``MIN_WORDS`` words or more that occur twice, by a hash-compared suffix sort.

Two suffixes are compared in logarithmic time: prefix polynomial hashes and a
binary search give their common extension, the word after it decides.  With
that comparison suffixes are sorted by mergesort; neighbours that agree in
``min_words`` words are repeats, and each is compared word for word with the
first of its class, so that no collision of hashes counts.

The sort is sharded by content.  Every run of ``min_words`` words belongs to
the least hash among its ``GRAM``-word runs, so equal runs meet in one shard
wherever they stand, and no run is missed.  A first pass marks the hashes that
occur twice in a Bloom filter of bounded size (false positives cost only
shuffle); a second sends the text around them to the shards, packed.  Equal
stretches are sorted once.

The first occurrence by (document id, position) of each passage stays, all
others are removed, in the same document too.  A *word* is what stands between
white space.  Results by case: rows with a null id or text hold no passages and
stay as they are; texts of fewer than ``min_words`` words too; repeated rows
(equal id and text) count as one document; ids that stand for several texts
are told apart by a hash of the text; an empty table gives no rows.  ``remove``
keeps all columns, brings ``n_chars`` up to date if there is one, and drops
documents of which no word is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textarrays as ta

MIN_WORDS = 50
GRAM = 10
BLOCK_BYTES = 2 << 20
MAX_FILTER = 64 << 20
U64 = np.uint64


def common(prefix: np.ndarray, inverse: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many words the suffixes at a and b have in common, ``most`` at most, by binary search on prefix hashes; wrong only if hashes collide."""
    length = np.zeros(len(a), np.int64)
    step = 1 << (most.bit_length() - 1)
    scale_a, scale_b = inverse[a], inverse[b]
    base_a, base_b = prefix[a], prefix[b]
    while step:
        tried = length + step
        fits = tried <= most
        reach = np.where(fits, tried, 0)
        equal = fits & ((prefix[a + reach] - base_a) * scale_a == (prefix[b + reach] - base_b) * scale_b)
        length = np.where(equal, tried, length)
        step >>= 1
    return length


def sort_suffixes(ids: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts in the order of the ``depth`` words that follow each, and the words each has in common with the one before it.

    Two words make a first key; suffixes that tie on it go through mergesort,
    all groups of ties and all pairs of runs at a time.
    """
    prefix, _, inverse = ta.prefix_hashes(ids.astype(U64) + U64(1))
    key = (ids[starts].astype(U64) << U64(32)) | ids[starts + 1].astype(U64)
    by = np.argsort(key, kind="stable")
    order, key = starts[by], key[by]
    new = np.ones(len(order), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    size = np.diff(np.append(head, len(order)))
    width = 1
    while True:
        at = np.flatnonzero(size[group] > width)
        if not len(at):
            break
        first, total = head[group[at]], size[group[at]]
        local = at - first
        run = local // width
        low = np.minimum((run ^ 1) * width, total)
        high = np.minimum(low + width, total)
        left, mine, base = (run & 1) == 0, order[at], low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            x, y = mine[open_], order[first[open_] + mid]
            shared = common(prefix, inverse, x, y, depth)
            tie = shared >= depth
            reach = np.where(tie, 0, shared)
            before = np.where(tie, ~left[open_], ids[y + reach] < ids[x + reach])  # y stands before x
            low[open_[before]] = mid[before] + 1
            high[open_[~before]] = mid[~before]
        order[first + (run & ~1) * width + (local - run * width) + (low - base)] = mine
        width *= 2
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        shared[1:] = common(prefix, inverse, order[1:], order[:-1], depth)
    return order, shared


def word_ids(words: ta.Words) -> np.ndarray:
    """A number for each word, equal for equal words only: hashes name the words, and all bytes are compared with the first of the name."""
    _, first, ids = np.unique(words.hashes(), return_index=True, return_inverse=True)
    size = words.end - words.start
    model = first[ids]
    same = size == size[model]
    row = np.repeat(np.arange(len(words)), np.where(same, size, 0))
    at = ta.ranges(words.start[same], size[same])
    other = at - words.start[row] + words.start[model[row]]
    differ = words.data[at] != words.data[other]
    same[row[differ]] = False
    odd = np.flatnonzero(~same)  # a collision: such a word is like no other
    ids[odd] = len(first) + np.arange(len(odd))
    return ids.astype(np.int64)


def stretches(words: ta.Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows with one least hash: (that hash, first window, windows, whether it stands there twice), windows named by their first word."""
    gram = min(GRAM, min_words)
    grams = ta.window_hashes(words.hashes(), gram)
    least = ta.sliding_min(grams, min_words - gram + 1)
    start = np.arange(len(least))
    inside = start + min_words <= words.first[words.row[: len(least)] + 1]
    start = start[inside]
    if not len(start):
        return np.zeros(0, U64), start, start, start > 0
    least = least[start]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (least[1:] != least[:-1])
    heads = np.flatnonzero(new)
    least, windows = least[heads], np.diff(np.append(heads, len(start)))
    start, span = start[heads], windows + min_words - gram
    equal = grams[ta.ranges(start, span)] == np.repeat(least, span)
    return ta.mix(least), start, windows, np.add.reduceat(equal, np.cumsum(span) - span) > 1


def shard_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return (((hashes >> U64(32)) * U64(n)) >> U64(32)).astype(np.int64)


def _bits(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    a = ta.mix(hashes)
    return (a % U64(bits)).astype(np.int64), (ta.mix(a) % U64(bits)).astype(np.int64)


def repeated_filter(keyed: DataFrame, min_words: int, shards: int, size: int) -> bytes:
    """A Bloom filter of the least hashes that occur twice, of ``size`` bytes, a segment for each shard."""
    each = max(1, size // shards)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in ta.words_of(batch.column(2), BLOCK_BYTES):
                hashes, _, _, twice = stretches(words, min_words)
                hashes = np.sort(np.concatenate([hashes, hashes[twice]]))
                third = np.zeros(len(hashes), bool)
                third[2:] = hashes[2:] == hashes[:-2]
                hashes = hashes[~third]
                bounds = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
                used = np.flatnonzero(np.diff(bounds))
                yield pa.RecordBatch.from_arrays([ta.ints(used), pa.array([hashes[bounds[s] : bounds[s + 1]].tobytes() for s in used], pa.binary())], ["shard", "part"])

    def segment(table: pa.Table) -> pa.Table:
        hashes = np.sort(np.concatenate([np.frombuffer(x, U64) for x in table.column("part").to_pylist()]))
        twice = np.unique(hashes[1:][hashes[1:] == hashes[:-1]])
        bits = np.zeros(each * 8, bool)
        for at in _bits(twice, each * 8):
            bits[at] = True
        return pa.table({"shard": table.column("shard").slice(0, 1), "bits": pa.array([zstandard.compress(np.packbits(bits).tobytes(), 1)], pa.binary())})

    found = keyed.mapInArrow(scan, "shard bigint, part binary").groupBy("shard").applyInArrow(segment, "shard bigint, bits binary")
    whole = bytearray(each * shards)
    for row in found.toLocalIterator():
        whole[row.shard * each : (row.shard + 1) * each] = zstandard.decompress(bytes(row.bits))
    return bytes(whole)


def repeats(ids: np.ndarray, first: np.ndarray, starts: np.ndarray, owner: np.ndarray, min_words: int) -> np.ndarray:
    """Of window starts (grouped by stretch) those that repeat an earlier one; ``owner`` orders occurrences."""
    again = np.zeros(len(starts), bool)
    hashes = ta.window_hashes(ids.astype(U64) + U64(1), min_words)[starts]
    by = np.argsort(hashes, kind="stable")
    equal = hashes[by][1:] == hashes[by][:-1]
    maybe = np.zeros(len(starts), bool)
    maybe[by[1:][equal]] = maybe[by[:-1][equal]] = True
    window = np.flatnonzero(maybe)  # only these can have a common extension of min_words
    if not len(window):
        return again
    order, shared = sort_suffixes(ids, starts[window], min_words)
    index = window[np.argsort(starts[window], kind="stable")][np.searchsorted(np.sort(starts[window]), order)]
    new = shared < min_words
    new[0] = True
    label = np.cumsum(new) - 1
    ranked = np.lexsort((owner[index], label))
    lead = index[ranked][np.flatnonzero(np.diff(np.append(-1, label[ranked])))]
    member, model = index, lead[label]
    for lo in range(0, len(member), 1 << 16):
        a, b = starts[member[lo : lo + (1 << 16)]], starts[model[lo : lo + (1 << 16)]]
        same = (ids[a[:, None] + np.arange(min_words)] == ids[b[:, None] + np.arange(min_words)]).all(axis=1)
        again[member[lo : lo + (1 << 16)]] = same & (a != b)
    return again


def _spans(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, windows: np.ndarray, texts: list[bytes], min_words: int) -> tuple[np.ndarray, ...]:
    """(doc_id, mark, first word, end) of what repeats among the stretches of a shard."""
    # equal stretches, verified byte for byte by the dictionary, are sorted once
    names: dict[bytes, int] = {}
    name = np.array([names.setdefault(t, len(names)) for t in texts], np.int64)
    by = np.lexsort((start, mark, doc, name))
    doc, mark, start, windows, name = doc[by], mark[by], start[by], windows[by], name[by]
    fresh = np.ones(len(name), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] != start[:-1])
    doc, mark, start, windows, name = doc[fresh], mark[fresh], start[fresh], windows[fresh], name[fresh]
    lead = np.ones(len(name), bool)
    lead[1:] = name[1:] != name[:-1]
    copies = ~lead
    data = np.frombuffer(b"".join(names), np.uint8)
    words = ta.Words(data, np.concatenate([[0], np.cumsum([len(t) for t in names])]))
    ids = word_ids(words)
    count = windows[lead]  # by name
    starts = ta.ranges(words.first[:-1], count)
    stretch = np.repeat(np.arange(len(count)), count)
    at = np.flatnonzero(lead)[stretch]
    position = start[at] + starts - words.first[stretch]
    rank = np.empty(len(at), np.int64)
    rank[np.lexsort((position, mark[at], doc[at]))] = np.arange(len(at))
    again = repeats(ids, words.first, starts, rank, min_words)
    new = again.copy()
    new[1:] &= ~(again[:-1] & (stretch[1:] == stretch[:-1]))
    last = again.copy()
    last[:-1] &= ~(again[1:] & (stretch[1:] == stretch[:-1]))
    a, b = np.flatnonzero(new), np.flatnonzero(last)
    return (
        np.concatenate([doc[copies], doc[at[a]]]),
        np.concatenate([mark[copies], mark[at[a]]]),
        np.concatenate([start[copies], position[a]]),
        np.concatenate([start[copies] + windows[copies] - 1, position[b]]) + min_words,
    )


def find(docs: DataFrame, min_words: int = MIN_WORDS, max_filter: int = MAX_FILTER) -> DataFrame:
    """(doc_id, mark, first_word, end_word): the words that repeat an earlier passage, disjoint stretches by document; ``mark`` tells texts of one id apart."""
    keyed = ta.keyed(docs)
    spark = docs.sparkSession
    text = ta.text_bytes(docs)
    shards = ta.buckets_for(text)
    size = min(max(text // 100, 1 << 16), max_filter)
    each = max(1, size // shards)
    shared = spark.sparkContext.broadcast(repeated_filter(keyed, min_words, shards, size))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, words in ta.words_of(batch.column(2), BLOCK_BYTES):
                hashes, start, windows, _ = stretches(words, min_words)
                shard = shard_of(hashes, shards)
                keep = np.ones(len(hashes), bool)
                for at in _bits(hashes, each * 8):
                    keep &= (bits[shard * each + (at >> 3)] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
                start, windows, shard = start[keep], windows[keep], shard[keep]
                order, bounds = ta.split_by(shard, shards)
                row = words.row[start]
                begin, end = words.start[start], words.end[start + windows + min_words - 2]
                used, blobs = np.flatnonzero(np.diff(bounds)), []
                for s in used:
                    mine = order[bounds[s] : bounds[s + 1]]
                    text = words.data[ta.ranges(begin[mine], end[mine] - begin[mine])]
                    blobs.append(press.compress(ta.pack(ids[lo + row[mine]], marks[lo + row[mine]], (start[mine] - words.first[row[mine]]).astype(np.int32), windows[mine].astype(np.int32), (end[mine] - begin[mine]).astype(np.int32), text)))
                yield pa.RecordBatch.from_arrays([ta.ints(used), pa.array(blobs, pa.binary())], ["shard", "part"])

    def sort(table: pa.Table) -> pa.Table:
        unpress = zstandard.ZstdDecompressor()
        parts, texts = [], []
        for x in table.column("part").to_pylist():
            doc, mark, start, windows, size, text = ta.unpack(unpress.decompress(x))
            ends, raw = np.cumsum(size).tolist(), text.tobytes()
            texts += [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            parts.append((doc, mark, start.astype(np.int64), windows.astype(np.int64)))
        out = _spans(*(np.concatenate(x) for x in zip(*parts, strict=True)), texts, min_words)
        return pa.table([ta.ints(c) for c in out], ["doc_id", "mark", "first_word", "end_word"])

    spans = keyed.mapInArrow(scan, "shard bigint, part binary").groupBy("shard").applyInArrow(sort, "doc_id bigint, mark bigint, first_word bigint, end_word bigint")
    order = Window.partitionBy("doc_id", "mark").orderBy("first_word", "end_word")
    begins = (F.col("first_word") > F.coalesce(F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))).cast("int")
    numbered = spans.withColumn("begins", begins).withColumn("n", F.sum("begins").over(order))
    return numbered.groupBy("doc_id", "mark", "n").agg(F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word")).drop("n")


def remove(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the words that repeat an earlier passage."""
    id_, mark, gone = ta.fresh(docs.columns, "_id", "_mark", "_cut")
    spans = find(docs, min_words).groupBy("doc_id", "mark").agg(F.array_sort(F.collect_list(F.struct("first_word", "end_word"))).alias(gone)).select(F.col("doc_id").alias(id_), F.col("mark").alias(mark), gone)
    joined = docs.join(spans, (F.col("doc_id").cast("bigint") == F.col(id_)) & (F.xxhash64("text") == F.col(mark)), "left").drop(id_, mark)
    place, names = docs.columns.index("text"), docs.columns
    count = names.index("n_chars") if "n_chars" in names else None
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column(place), batch.column(len(names))
            keep = np.ones(batch.num_rows, bool)
            changed: dict[int, str] = {}
            for i in np.flatnonzero(np.asarray(cuts.is_valid())):
                raw = np.frombuffer(texts[i].as_py().encode(), np.uint8)
                words = ta.Words(raw, np.array([0, len(raw)]))
                stays = np.ones(len(raw), bool)
                for c in cuts[i].as_py():
                    stop = words.start[c["end_word"]] if c["end_word"] < len(words) else len(raw)
                    stays[words.start[c["first_word"]] : stop] = False
                changed[i] = raw[stays].tobytes().decode()
                keep[i] = bool(changed[i].strip())
            columns = list(batch.columns[: len(names)])
            if changed:
                values = texts.to_pylist()
                for i, t in changed.items():
                    values[i] = t
                columns[place] = pa.array(values, texts.type)
                if count is not None and kinds["n_chars"] in ("bigint", "int"):
                    sizes = columns[count].to_pylist()
                    for i, t in changed.items():
                        sizes[i] = len(t)
                    columns[count] = pa.array(sizes, columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep))

    return joined.mapInArrow(cut, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(ta.documents(spark, sf_dir)).drop("mark")
