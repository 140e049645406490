"""Lexical retrieval packing: context windows filled with BM25 neighbours.

*Seeds* are the documents whose id is divisible by ``EVERY``; each opens a
window.  All seeds are searched against all other documents of the corpus, in
blocks of seeds: a scan counts the document frequencies of the block's terms, a
second one scores.  Each task of that scan holds an inverted index of its shard,
batch by batch, restricted to the block's terms.  The few terms that cost most
(frequent ones) are columns of a matrix product, the others postings, so every
document that has any word of a seed is scored, exactly.  Scores are sums of
BM25 impacts in steps of 1/64.

A seed gets its best ``keep`` neighbours that fit its window.  A document listed
by several seeds goes to the one for which it scores best, and seeds fill their
windows from the best document on as long as one fits; what a seed declines may
go to the next one, until nobody wants anything.  A seed that lost so many
neighbours to others that fewer than ``LEAST`` of its list were free asks for a
list four times as long, until none does.  Equal scores are ordered by a hash of
seed and document, so that seeds within a large group of copies share it out.

All other documents follow in windows of their own kind: in order of the least
hash of their words, under which copies and near copies stand together, by range
partitions, each document in the first open window that has room for it.

Every document is in one window.  A document longer than a window fills windows
of its own; what is left of it opens the next.

Shuffled are lists of neighbours and a short row for each document, never the
text.  The driver and a broadcast hold one block of at most ``BLOCK_SEEDS`` seeds
or ``BLOCK_TERMS`` terms (and one seed at least).  The work of the search is
seeds times documents.

Sizes are counted in words (what stands between white space).  Results by case:
rows without an id, text or word have no place in a window; repeated rows are
as many documents, of which one at most is a seed or neighbour; ``mark``, a hash
of the text, tells rows of one id apart; an empty table gives no rows.  Other
columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import cut
from . import textarrays as ta

WINDOW = 2048
EVERY = 50
K1, B = 1.2, 0.75
UNIT = 64.0
KEEP = 32
LEAST = 8
COMMON = 512  # terms that are columns
BLOCK_SEEDS = 8192
BLOCK_TERMS = 4 << 20
BATCH = 1024
OPEN = 16  # windows open at a time among the other documents
U64 = np.uint64
PLACES = "pack_id bigint, place bigint, doc_id bigint, first_word bigint, words bigint"
KNOWN = "pack_id bigint, df binary"
PAIRS = "pack_id bigint, doc_id bigint, mark bigint, words bigint, score bigint, tie bigint"


def pack_terms(terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted 48-bit terms and their counts, by byte planes."""
    planes = terms.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 5::-1].T.tobytes()
    return zstandard.compress(np.uint32(len(terms)).tobytes() + planes + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_terms(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    n = int(raw[:4].view(np.uint32)[0])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 5::-1] = raw[4 : 4 + 6 * n].reshape(6, n).T
    return wide.view("<u8").ravel(), np.ascontiguousarray(raw[4 + 6 * n :].reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _blocks(column: pa.Array) -> Iterator[tuple[int, ta.Words]]:
    for at in range(0, len(column), BATCH):
        for lo, words in ta.words_of(column.slice(at, BATCH)):
            yield at + lo, words


def term_of(words: ta.Words) -> np.ndarray:
    return words.hashes() >> U64(16)


def bags(words: ta.Words, terms: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the different terms of each row, in that order."""
    order = np.lexsort((terms, row))
    terms, row = terms[order], row[order]
    new = np.ones(len(terms), bool)
    new[1:] = (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(new)
    return row[heads], terms[heads], np.diff(np.append(heads, len(terms)))


def sizes_of(keyed: DataFrame) -> DataFrame:
    """(doc_id, mark, words, key, n): a short row for each document that has words; key is the least hash of them, n how often the row stands there."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in _blocks(batch.column(2)):
                rows = np.flatnonzero(words.counts)
                if len(rows):
                    key = np.minimum.reduceat(ta.mix(words.hashes() ^ U64(0x5851F42D4C957F2D)), words.first[rows])
                    ids, marks = (batch.column(i).slice(lo, len(words.counts)).take(pa.array(rows)) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([ids, marks, ta.ints(words.counts[rows]), pa.array((key >> U64(1)).astype(np.int64))], ["doc_id", "mark", "words", "key"])

    rows = keyed.mapInArrow(scan, "doc_id bigint, mark bigint, words bigint, key bigint")
    return rows.groupBy("doc_id", "mark").agg(F.first("words").alias("words"), F.first("key").alias("key"), F.count("*").alias("n"))


def seeds_of(keyed: DataFrame, window: int, every: int) -> DataFrame:
    """(pack_id, doc_id, mark, first_word, words, room, terms): the pieces that seeds fill by themselves; the last of each has what room is left and the terms."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in _blocks(batch.column(2)):
                rows = np.flatnonzero(words.counts)
                row, terms, times = bags(words, term_of(words), words.row)
                bounds = np.searchsorted(row, np.arange(len(words.counts) + 1))
                blobs = [pack_terms(terms[bounds[r] : bounds[r + 1]], times[bounds[r] : bounds[r + 1]]) for r in rows]
                ids, marks = (batch.column(i).slice(lo, len(words.counts)).take(pa.array(rows)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, marks, ta.ints(words.counts[rows]), pa.array(blobs, pa.binary())], ["doc_id", "mark", "words", "terms"])

    found = keyed.filter(F.col("doc_id") % every == 0).mapInArrow(scan, "doc_id bigint, mark bigint, words bigint, terms binary")
    once = found.groupBy("doc_id", "mark").agg(F.first("words").alias("size"), F.first("terms").alias("terms"))
    last = F.floor((F.col("size") - 1) / window)
    pieces = once.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).withColumn("first_word", F.col("piece") * window)
    held = F.least(F.lit(window).cast("bigint"), F.col("size") - F.col("first_word"))
    ends = F.col("piece") == last
    pieces = pieces.select("doc_id", "mark", "first_word", held.alias("words"), F.when(ends, window - held).alias("room"), F.when(ends, F.col("terms")).alias("terms"))
    return cut(pieces.withColumn("pack_id", F.monotonically_increasing_id()))


@dataclass
class Block:
    """Some seeds: their ids, what room each has, their terms in order, and for each term the seeds that have it."""

    pack: np.ndarray
    name: np.ndarray  # a hash of a seed's id and mark
    room: np.ndarray
    terms: np.ndarray
    first: np.ndarray
    seed: np.ndarray
    df: np.ndarray | None = None  # in how many documents each term stands, once that is known


def _block(rows: list) -> Block:
    parts = [unpack_terms(bytes(r.terms))[0] for r in rows]
    terms, place = np.unique(np.concatenate([np.zeros(0, U64), *parts]), return_inverse=True)
    seed = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    order = np.argsort(place, kind="stable")
    name = hash_of(np.array([r.doc_id for r in rows], np.int64), np.array([r.mark for r in rows], np.int64))
    df = None
    if rows[0].df is not None:
        df = np.zeros(len(terms), np.int64)
        df[place] = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(zstandard.decompress(bytes(r.df)), np.int64) for r in rows)])
    return Block(np.array([r.pack_id for r in rows], np.int64), name, np.array([r.room for r in rows], np.int64), terms, np.searchsorted(place[order], np.arange(len(terms) + 1)), seed[order], df)


def blocks_of(seeds: DataFrame, most: int) -> Iterator[Block]:
    """The seeds in blocks; one is on the driver at a time."""
    rows, held = [], 0
    for row in seeds.select("pack_id", "doc_id", "mark", "room", "terms", "df").toLocalIterator():
        rows.append(row)
        held += len(row.terms) // 4
        if len(rows) >= most or held >= BLOCK_TERMS:
            yield _block(rows)
            rows, held = [], 0
    if rows:
        yield _block(rows)


def hash_of(ids: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return ta.mix(ta.mix(ids.astype(np.int64).view(U64) + U64(0x9E3779B97F4A7C15)) ^ marks.astype(np.int64).view(U64))


class Lexicon:
    """Sorted 48-bit terms with a table of where those with the same first bits begin: they are hashes, so there are few of each."""

    def __init__(self, terms: np.ndarray):
        bits = max(1, int(len(terms)).bit_length() + 1)
        self.terms, self.shift = terms, U64(48 - bits)
        self.starts = np.searchsorted(terms >> self.shift, np.arange((1 << bits) + 1).astype(U64)).astype(np.int32)

    def locate(self, terms: np.ndarray) -> np.ndarray:
        """Where each term stands among the known ones, or -1."""
        out = np.full(len(terms), -1, np.int64)
        slot = (terms >> self.shift).astype(np.int64)
        at, end = self.starts[slot], self.starts[slot + 1]
        live = np.flatnonzero(at < end)
        while len(live):
            here = at[live]
            same = self.terms[here] == terms[live]
            out[live[same]] = here[same]
            live = live[~same]
            at[live] += 1
            live = live[at[live] < end[live]]
        return out


def counted(row: np.ndarray, term: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the different terms of each row, in that order; terms are numbers below ``terms``."""
    key = np.sort(row * max(terms, 1) + term)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    heads = np.flatnonzero(new)
    row, term = np.divmod(key[heads], max(terms, 1))
    return row, term, np.diff(np.append(heads, len(key)))


def frequencies(keyed: DataFrame, terms: np.ndarray, tasks: int) -> np.ndarray:
    """In how many documents each term stands."""
    shared = keyed.sparkSession.sparkContext.broadcast(terms)
    each = 1 << 16

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        sums = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for _, words in _blocks(batch.column(2)):
                at = lexicon.locate(term_of(words))
                hit = np.flatnonzero(at >= 0)
                sums += np.bincount(counted(words.row[hit], at[hit], len(sums))[1], minlength=len(sums))
        for c in range(0, len(sums), each):
            part = sums[c : c + each]
            if part.any():
                yield pa.RecordBatch.from_arrays([ta.ints(np.array([c])), pa.array([part.tobytes()], pa.binary())], ["chunk", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("sums").to_pylist())
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(len(terms), np.int64)
    kinds = "chunk bigint, sums binary"
    for r in keyed.coalesce(tasks).mapInArrow(scan, kinds).groupBy("chunk").applyInArrow(add, kinds).toLocalIterator():
        part = np.frombuffer(bytes(r.sums), np.int64)
        out[r.chunk : r.chunk + len(part)] = part
    shared.destroy()
    return out


class Best:
    """The ``keep`` best documents of each seed so far, by score and tie."""

    def __init__(self, seeds: int, keep: int):
        self.keep, self.least = keep, np.ones(seeds, np.float32)
        self.found = [np.zeros(0, np.int64) for _ in range(6)]  # seed, score, tie, doc_id, mark, words
        self.new: list[list[np.ndarray]] = []
        self.held = 0

    def add(self, *columns: np.ndarray) -> None:
        self.new.append(list(columns))
        self.held += len(columns[0])
        if self.held > max(100_000, len(self.found[0])):
            self.settle()

    def settle(self) -> None:
        columns = [np.concatenate(x) for x in zip(self.found, *self.new, strict=True)]
        order = np.lexsort((-columns[2], -columns[1], columns[0]))
        columns = [c[order] for c in columns]
        seed = columns[0]
        heads = np.searchsorted(seed, seed)
        # rows that stand there several times are one document
        same = np.zeros(len(seed), bool)
        same[1:] = (seed[1:] == seed[:-1]) & (columns[3][1:] == columns[3][:-1]) & (columns[4][1:] == columns[4][:-1])
        rank = np.cumsum(~same)
        rank = rank - rank[heads]
        stays = ~same & (rank < self.keep)
        full = ~same & (rank == self.keep - 1)
        self.least[seed[full]] = columns[1][full]
        self.found = [c[stays] for c in columns]
        self.new, self.held = [], 0


def score_batch(words: ta.Words, sizes: np.ndarray, lexicon: Lexicon, columns: np.ndarray, postings: tuple, idf: np.ndarray, mean: float) -> np.ndarray:
    """The scores of all seeds of the block (rows) with the documents of the batch."""
    matrix, rare_first, rare_seed = postings
    at = lexicon.locate(term_of(words))
    hit = np.flatnonzero(at >= 0)
    doc, term, times = counted(words.row[hit], at[hit], len(idf))
    impact = np.rint(UNIT * idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * sizes[doc] / mean))).astype(np.float32)
    dense = columns[term] >= 0
    mine = np.zeros((len(sizes), matrix.shape[1]), np.float32)
    mine[doc[dense], columns[term[dense]]] = impact[dense]
    scores = matrix @ mine.T
    doc, term, impact = doc[~dense], term[~dense], impact[~dense]
    n = rare_first[term + 1] - rare_first[term]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) - np.repeat((ends - n - rare_first[term]).astype(np.int32), n)
    cells = rare_seed[at] * np.int32(len(sizes)) + np.repeat(doc.astype(np.int32), n)
    np.add.at(scores.reshape(-1), cells, np.repeat(impact, n))
    return scores


def search(keyed: DataFrame, block: Block, number: int, mean: float, keep: int, every: int, tasks: int) -> DataFrame:
    """(pack_id, doc_id, mark, words, score, tie): for each seed of the block its best documents that fit and are no seeds, by shard."""
    df = block.df
    useful = np.flatnonzero(df > 1)  # a term of one document finds nothing
    n = np.diff(block.first)
    seed = block.seed[ta.ranges(block.first[useful], n[useful])]
    block = Block(block.pack, block.name, block.room, block.terms[useful], np.concatenate([[0], np.cumsum(n[useful])]), seed)
    df, n = df[useful].astype(float), n[useful]
    idf = np.log1p((number - df + 0.5) / (df + 0.5))
    columns = np.full(len(df), -1)
    frequent = np.argsort(-df * n, kind="stable")[:COMMON]
    columns[frequent] = np.arange(len(frequent))
    shared = keyed.sparkSession.sparkContext.broadcast((block, idf, columns))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, idf, columns = shared.value
        seeds = len(block.pack)
        term = np.repeat(np.arange(len(idf)), np.diff(block.first))
        dense = columns[term] >= 0
        matrix = np.zeros((seeds, max(1, int((columns >= 0).sum()))), np.float32)
        matrix[block.seed[dense], columns[term[dense]]] = 1
        postings = matrix, np.searchsorted(term[~dense], np.arange(len(idf) + 1)), block.seed[~dense].astype(np.int32)
        lexicon = Lexicon(block.terms)
        best, room, most = Best(seeds, keep), block.room.astype(np.int32)[:, None], int(block.room.max(initial=0))
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, words in _blocks(batch.column(2)):
                here = slice(lo, lo + len(words.counts))
                sizes = words.counts.astype(np.int32)
                scores = score_batch(words, sizes, lexicon, columns, postings, idf, mean)
                scores[(sizes[None, :] > room) | ((ids[here] % every == 0) | (sizes == 0) | (sizes > most))[None, :]] = 0
                bar = best.least
                if not len(best.found[0]) and scores.shape[1] > keep:
                    bar = np.maximum(bar, np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep])
                cells = np.flatnonzero(scores.reshape(-1) >= np.repeat(bar, len(sizes)))
                seed, doc = cells // len(sizes), cells % len(sizes)
                doc_id, mark = ids[here][doc], marks[here][doc]
                tie = ta.mix(block.name[seed] ^ hash_of(doc_id, mark)).view(np.int64)
                best.add(seed, scores.reshape(-1)[cells].astype(np.int64), tie, doc_id, mark, sizes[doc].astype(np.int64))
                if bar is not best.least:
                    best.settle()
        best.settle()
        seed, score, tie, doc_id, mark, size = best.found
        yield pa.RecordBatch.from_arrays([ta.ints(c) for c in (block.pack[seed], doc_id, mark, size, score, tie)], ["pack_id", "doc_id", "mark", "words", "score", "tie"])

    return keyed.coalesce(tasks).mapInArrow(scan, PAIRS)


def neighbours(keyed: DataFrame, seeds: DataFrame, number: int, mean: float, keep: int = KEEP, every: int = EVERY, block_seeds: int = BLOCK_SEEDS) -> tuple[DataFrame, DataFrame]:
    """(pack_id, doc_id, mark, words, score, tie): the best ``keep`` documents of each seed that fit its room, of the whole corpus; and (pack_id, df) where frequencies had to be counted."""
    spark = keyed.sparkSession
    tasks = max(2, 2 * spark.sparkContext.defaultParallelism)
    lists, known = [], []
    for block in blocks_of(seeds, block_seeds):
        if block.df is None:
            block.df = frequencies(keyed, block.terms, tasks)
            known.append(_known(spark, block))
        shards = search(keyed, block, number, mean, keep, every, tasks)
        packed = shards.groupBy("pack_id").agg(F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("score", "tie", "doc_id", "mark", "words")))), 1, keep).alias("best"))  # keep a task
        lists.append(cut(packed.select("pack_id", F.inline("best")).select("pack_id", "doc_id", "mark", "words", "score", "tie")))
    return _all(lists, spark, PAIRS), _all(known, spark, KNOWN)


def _all(parts: list[DataFrame], spark: SparkSession, kinds: str) -> DataFrame:
    out = parts[0] if parts else spark.createDataFrame([], kinds)
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _known(spark: SparkSession, block: Block) -> DataFrame:
    """(pack_id, df): the frequencies of each seed's terms, in their order, for later lists."""
    terms = np.repeat(np.arange(len(block.df)), np.diff(block.first))
    order = np.argsort(block.seed, kind="stable")
    df, bounds = block.df[terms[order]], np.searchsorted(block.seed[order], np.arange(len(block.pack) + 1))
    blobs = [zstandard.compress(df[a:b].astype(np.int64).tobytes(), 1) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return cut(spark.createDataFrame(pa.table([ta.ints(block.pack), pa.array(blobs, pa.binary())], ["pack_id", "df"])))


def assign(pairs: DataFrame, rooms: DataFrame, turn: int) -> tuple[DataFrame, DataFrame, int]:
    """(pack_id, doc_id, mark, words, turn, place) of what seeds take, the room (pack_id, room) that is left, and the next turn."""
    spark = pairs.sparkSession
    taken = None
    take = F.expr(
        "aggregate(offers, named_struct('room', room, 'got', cast(array() as array<struct<score:bigint,tie:bigint,doc_id:bigint,mark:bigint,words:bigint>>)), "
        "(a, x) -> if(x.words <= a.room, named_struct('room', a.room - x.words, 'got', concat(a.got, array(x))), a))"
    )
    while pairs.head(1):
        best = pairs.groupBy("doc_id", "mark").agg(F.max(F.struct("score", "tie", "pack_id", "words")).alias("b")).select("b.pack_id", F.struct("b.score", "b.tie", "doc_id", "mark", "b.words").alias("x"))
        offers = best.groupBy("pack_id").agg(F.reverse(F.array_sort(F.collect_list("x"))).alias("offers"))  # one list at most
        filled = cut(offers.join(rooms, "pack_id").select("pack_id", take.alias("a")).select("pack_id", "a.room", "a.got"))
        got = filled.select("pack_id", F.posexplode("got").alias("place", "x")).select("pack_id", "x.doc_id", "x.mark", "x.words", F.lit(turn).alias("turn"), "place")
        rooms = cut(rooms.join(filled.select("pack_id", F.col("room").alias("left")), "pack_id", "left").select("pack_id", F.coalesce("left", "room").alias("room")))
        taken = got if taken is None else taken.unionByName(got)
        pairs = cut(pairs.join(got.select("doc_id", "mark"), ["doc_id", "mark"], "left_anti").join(rooms.withColumnRenamed("room", "left"), "pack_id").filter("words <= left").drop("left"))
        turn += 1
    none = spark.createDataFrame([], "pack_id bigint, doc_id bigint, mark bigint, words bigint, turn int, place int")
    return taken if taken is not None else none, rooms, turn


def fill(rest: DataFrame, window: int) -> DataFrame:
    """Windows of the documents (doc_id, mark, words, key, n) that are in no seed's window, in order of key, id and mark."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (1 << 62) | ((task.partitionId() if task else 0) << 33)
        ready: list[list[int]] = []  # pack, room, place
        for batch in batches:
            out: list[tuple[int, int, int, int, int]] = []
            for doc, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                done = 0
                while size - done > window:
                    out.append((number, 0, doc, done, window))
                    number, done = number + 1, done + window
                need = size - done
                slot = next((w for w in ready if w[1] >= need), None)
                if slot is None:
                    slot = [number, window, 0]
                    number += 1
                    ready.append(slot)
                    if len(ready) > OPEN:
                        ready.remove(min(ready, key=lambda w: w[1]))
                out.append((slot[0], slot[2], doc, done, need))
                slot[1] -= need
                slot[2] += 1
            table = np.array(out, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([ta.ints(table[:, i]) for i in range(5)], ["pack_id", "place", "doc_id", "first_word", "words"])

    each = rest.filter("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).select("doc_id", "mark", "words", "key")
    return each.repartitionByRange("key", "doc_id", "mark").sortWithinPartitions("key", "doc_id", "mark").mapInArrow(scan, PLACES)


def windows(docs: DataFrame, window: int = WINDOW, every: int = EVERY, keep: int = KEEP, least: int = LEAST, block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(pack_id, place, doc_id, first_word, words): the pieces of each window in order."""
    keyed = ta.keyed(docs)
    held = cut(sizes_of(keyed))
    total = held.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("words")).alias("words")).first()
    if not total.n:
        return docs.sparkSession.createDataFrame([], PLACES)
    number, mean = total.n, total.words / total.n
    seeds = seeds_of(keyed, window, every)
    rooms = cut(seeds.filter("room is not null").select("pack_id", "room"))
    asking, turn, taken, known = seeds.filter("room > 0").withColumn("df", F.lit(None).cast("binary")), 1, None, None
    while asking.head(1):
        lists, counts = neighbours(keyed, asking, number, mean, keep, every, block_seeds)
        known = counts if known is None else known
        free = lists if taken is None else lists.join(taken.select("doc_id", "mark"), ["doc_id", "mark"], "left_anti")
        got, rooms, turn = assign(cut(free), rooms, turn)
        taken = cut(got if taken is None else taken.unionByName(got))
        # a full list of which too little was free
        lost = lists.join(taken.select("doc_id", "mark", F.col("pack_id").alias("winner")), ["doc_id", "mark"], "left")
        counted = lost.groupBy("pack_id").agg(F.count("*").alias("listed"), F.sum((F.col("winner").isNull() | (F.col("winner") == F.col("pack_id"))).cast("int")).alias("free"))
        short = counted.filter((F.col("listed") >= keep) & (F.col("free") < least)).join(rooms.filter("room > 0"), "pack_id").select("pack_id", "room")
        asking = cut(seeds.filter("room > 0").drop("room").join(short, "pack_id").join(known, "pack_id"))
        keep *= 4
    own = seeds.select("pack_id", F.lit(0).cast("bigint").alias("place"), "doc_id", "first_word", "words")
    if taken is None:
        rest = held
    else:
        turns = taken.groupBy("pack_id").agg(F.array_sort(F.collect_list(F.struct("turn", "place", "doc_id", "words"))).alias("got"))  # a window's documents
        own = own.unionByName(turns.select("pack_id", F.posexplode("got").alias("at", "x")).select("pack_id", (F.col("at") + 1).cast("bigint").alias("place"), "x.doc_id", F.lit(0).cast("bigint").alias("first_word"), "x.words"))
        rest = held.join(taken.select("doc_id", "mark", F.lit(1).alias("used")), ["doc_id", "mark"], "left").withColumn("n", F.col("n") - F.coalesce("used", F.lit(0))).drop("used")
    rest = rest.withColumn("n", F.col("n") - (F.col("doc_id") % every == 0).cast("int"))
    return own.unionByName(fill(rest, window))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows(ta.documents(spark, sf_dir))
