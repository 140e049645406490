"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers are composed into one automaton when the module is loaded:
the lexicon's word classes pass through negation (an insult or threat within
three words of a negation is void), threats ("we will hurt ...", "kill
yourself"), reported speech (a clause with a verb of saying counts a tenth) and
target (an insult in a clause that addresses somebody counts double), and the
scorer gives what is left its weight.  Reported speech and target are guessed
at the start of a clause and accepted only if the guess comes true, so words
may stand in any order; a clause's score is that of its best accepted path.

Clauses end at . ! ? ; or a line end.  Case, digits and punctuation don't
matter.  A document is toxic if its clauses' scores add up to ``THRESHOLD``:
one insult does that unless it is negated or reported.  Of clauses below
``FAINT``, which only report, the strongest alone counts.

No word list covers all languages and dialects, so the lexicon transducer also
takes *stems*, learned by ``learn`` from labelled documents: beginnings of words
that toxic documents have far more often than clean ones.  A stem found weighs
the logarithm of the ratio of its rates, and goes through negation, report and
target like an insult; a document is charged for what of it would stand by
chance in as many words, so that one rare coincidence in a long clean text
counts for nothing.  At most ``LABELLED`` labelled documents are looked at, those
with the least hashes of their ids; scoring covers all documents.

Results by case: null and empty texts score 0 and are kept; rows with a null id
are scored like others; equal rows score alike; an empty table gives no rows.
``reject`` keeps every column as it is.  ``learn`` ignores rows with a null id,
text or label and takes copies and near copies once, the least id's; without labels of both kinds, or where
no stem is significant, it gives no stems and the word list decides alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import cut
from . import textarrays as ta

THRESHOLD = 0.5
FAINT = 0.4
LABELLED = 20_000  # labelled documents to learn from, at most
STEM_BYTES = range(3, 9)
STEMS = 64
SUPPORT, RATIO, SIGNIFICANT = 5, 8.0, 4.0  # toxic texts with a stem; its rate there against clean texts; standard deviations, of texts and of occurrences
DOUBT = 2.0  # occurrences in clean texts that the sample may have missed
EVIDENCE = 6.0  # log-likelihood ratio that makes a document toxic by its stems
#: word classes: other, insult, word that is an insult only at times, threatening verb, target, first person, modal, negation, verb of saying, learned stem
OTHER, INSULT, SLUR, VERB, TARGET, FIRST, MODAL, NOT, SAY, LEARNED = "oiavtfmnsx"
LEXICON = {
    INSULT: "idiot idiots idiotic moron morons moronic imbecile imbeciles loser losers scum scumbag scumbags stupid disgusting worthless pathetic bastard bastards bitch bitches asshole assholes dumbass retard retarded filth filthy vermin subhuman degenerate dimwit halfwit cretin "
    "dummkopf vollidiot trottel arschloch abschaum schwachkopf wichser hurensohn missgeburt crétin imbécile connard connards connasse salaud salope abruti débile ordure enculé idiota imbécil estúpido estúpida gilipollas cabrón pendejo escoria basura subnormal",
    SLUR: "clown clowns trash garbage pig pigs rat rats snake parasite parasites fool fools dumb ugly ridiculous dumm wertlos stupide inutile asqueroso",
    VERB: "kill hurt murder stab shoot strangle beat destroy crush slaughter bomb rape töten umbringen verprügeln tuer frapper égorger matar golpear destruir",
    TARGET: "you your yours yourself yourselves u ur he him his she her they them their du dich dir dein deine ihr euch tu te toi vous votre tú ti tus usted ustedes",
    FIRST: "i we ich wir je nous yo nosotros",
    MODAL: "will shall gonna going must werde werden vais allons voy vamos ll",
    NOT: "not no never neither nor without hardly isn aren wasn weren don doesn didn ain cannot nicht kein keine keinen keiner nie niemals pas jamais aucun nunca jamás tampoco",
    SAY: "said says say saying wrote writes claimed claims called calls quoted quote reported alleged accused sagte sagt schrieb nannte behauptete dit écrit appelé prétend dijo dice escribió llamó",
}
#: what the scorer gives: aimed and plain insults and slurs, threats; in reported speech a tenth
#: those of learned stems are multiples of the stem's own weight
WEIGHTS = {"I": 2.0, "i": 1.0, "A": 1.5, "a": 0.5, "K": 3.0, "Q": 0.2, "q": 0.1, "R": 0.15, "r": 0.05, "k": 0.3, "X": 1.5, "x": 1.0, "Y": 0.15, "y": 0.1}
SYMBOLS = "oiavtfmnsx,"


@dataclass
class Fst:
    """A weighted letter-to-letter transducer: arcs[state][in] = [(out, weight, state)]; weights add along a path, the best path counts."""

    starts: list
    arcs: dict = field(default_factory=dict)
    finals: dict = field(default_factory=dict)

    def arc(self, state, symbol: str, out: str, to, weight: float = 0.0) -> None:
        self.arcs.setdefault(state, {}).setdefault(symbol, []).append((out, weight, to))


def compose(a: Fst, b: Fst) -> Fst:
    """First a, then b."""
    made = Fst([(p, q) for p in a.starts for q in b.starts])
    todo, seen = list(made.starts), set(made.starts)
    while todo:
        p, q = state = todo.pop()
        if p in a.finals and q in b.finals:
            made.finals[state] = a.finals[p] + b.finals[q]
        for symbol, arcs in a.arcs.get(p, {}).items():
            for mid, w, to in arcs:
                for out, v, end in b.arcs.get(q, {}).get(mid, []):
                    made.arc(state, symbol, out, (to, end), w + v)
                    if (to, end) not in seen:
                        seen.add((to, end))
                        todo.append((to, end))
    return made


def negation(scope: int = 3) -> Fst:
    t = Fst([0], finals=dict.fromkeys(range(scope + 1), 0.0))
    for left in range(scope + 1):
        for s in SYMBOLS:
            to = scope if s == NOT else 0 if s == "," else max(left - 1, 0)
            t.arc(left, s, "o" if left and s in "iavx" else s, to)
    return t


def threats() -> Fst:
    """A verb is a threat (K) after a first person and a modal; or the target after it is (K), as in "kill yourself"."""
    t = Fst(["-"], finals=dict.fromkeys(["-", "f2", "f1", "m3", "m2", "m1", "v"], 0.0))
    later = {"f2": "f1", "m3": "m2", "m2": "m1"}
    for state in t.finals:
        for s in SYMBOLS:
            out, to = s, later.get(state, "-")
            if s == FIRST:
                to = "f2"
            elif s == MODAL and state[0] in "fm":
                to = "m3"
            elif s == VERB:
                out, to = ("K", "-") if state[0] == "m" else ("o", "v")
            elif s == TARGET and state == "v":
                out, to = "K", "-"
            t.arc(state, s, out, to)
    return t


def reported() -> Fst:
    t = Fst(["direct", "maybe"], finals={"direct": 0.0, "said": 0.0})
    for s in (*SYMBOLS, "K"):
        if s != SAY:
            t.arc("direct", s, s, "direct")
        quiet = {"i": "q", "a": "r", "K": "k", "x": "y"}.get(s, s)
        for state in ("maybe", "said"):
            t.arc(state, s, quiet, "said" if s == SAY else state)
    return t


def target() -> Fst:
    t = Fst(["none", "maybe"], finals={"none": 0.0, "hit": 0.0})
    for s in (*SYMBOLS, "K", "q", "r", "k", "y"):
        if s != TARGET:
            t.arc("none", s, s, "none")
        aimed = {"i": "I", "a": "A", "q": "Q", "r": "R", "x": "X", "y": "Y"}.get(s, s)
        for state in ("maybe", "hit"):
            t.arc(state, s, aimed, "hit" if s in (TARGET, "K", "k") else state)
    return t


def scorer() -> Fst:
    t = Fst([0], finals={0: 0.0})
    for s in (*SYMBOLS, *"KqrkIAQRyXY"):
        t.arc(0, s, s, 0, WEIGHTS.get(s, 0.0))
    return t


class Grammar:
    """The composed automaton as tables: for each start one path at most, state 0 is dead."""

    def __init__(self, *parts: Fst):
        whole = parts[0]
        for part in parts[1:]:
            whole = compose(whole, part)
        states = {s: i + 1 for i, s in enumerate(dict.fromkeys([*whole.starts, *whole.arcs, *whole.finals]))}
        n = len(SYMBOLS) - 1
        step, weight = np.zeros((len(states) + 1, n + 1), np.int32), np.zeros((len(states) + 1, n + 1))
        for s, i in states.items():
            for symbol, arcs in whole.arcs.get(s, {}).items():
                assert len(arcs) == 1, "the parts are deterministic but for their starts"
                step[i, SYMBOLS.index(symbol)], weight[i, SYMBOLS.index(symbol)] = states[arcs[0][2]], arcs[0][1]
        # a word with a comma before it is one symbol more; both steps in one
        mid = step[:, n]
        self.step = np.concatenate([step[:, :n], step[mid][:, :n]], axis=1)
        self.weight = np.concatenate([weight[:, :n], weight[:, n : n + 1] + weight[mid][:, :n]], axis=1)
        self.final = np.full(len(states) + 1, -np.inf)
        for s, w in whole.finals.items():
            self.final[states[s]] = w
        self.starts = [states[s] for s in whole.starts]

    def score(self, symbols: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The score of each clause, which is symbols[first : first + count]."""
        return self.paths(symbols, first, counts, np.zeros(len(symbols)))[0]

    def paths(self, symbols: np.ndarray, first: np.ndarray, counts: np.ndarray, strength: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score of each clause by its words and by its stems, which weigh ``strength``, on the path where both together are best."""
        best, stems = np.full(len(counts), -np.inf), np.zeros(len(counts))
        order = np.argsort(-counts, kind="stable")
        first, counts = first[order], counts[order]
        for start in self.starts:
            state, total, learned = np.full(len(counts), start), np.zeros(len(counts)), np.zeros(len(counts))
            for i in range(int(counts.max(initial=0))):
                live = int(np.searchsorted(-counts, -i, "left"))  # those with more than i words
                s, own = symbols[first[:live] + i], strength[first[:live] + i]
                w = self.weight[state[:live], s]
                total[:live] += np.where(own > 0, 0.0, w)
                learned[:live] += own * w
                state[:live] = self.step[state[:live], s]
            total += self.final[state]
            better = total + learned > best[order] + stems[order]
            best[order[better]], stems[order[better]] = total[better], learned[better]
        return best, stems


GRAMMAR = Grammar(negation(), threats(), reported(), target(), scorer())

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAPS = np.ones(256, bool)  # words are letters
_GAPS[97:123] = _GAPS[128:] = False
_END, _COMMA = np.zeros(256, bool), np.zeros(256, bool)
_END[[10, 13, 33, 46, 59, 63]] = True
_COMMA[44] = True


def _lexicon() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = {w: SYMBOLS.index(s) for s, text in LEXICON.items() for w in text.split()}
    data, offsets = ta.flat(pa.array(list(words), pa.string()))
    hashes = ta.Words(data, offsets, _GAPS).hashes()
    order = np.argsort(hashes)
    maybe = np.zeros(1 << 16, bool)
    maybe[hashes & np.uint64(0xFFFF)] = True
    return hashes[order], np.array(list(words.values()))[order], maybe


_HASHES, _CLASSES, _MAYBE = _lexicon()
_BAD = np.zeros(len(SYMBOLS), bool)
_BAD[[SYMBOLS.index(s) for s in (INSULT, SLUR, VERB, LEARNED)]] = True


@dataclass
class Stems:
    """What ``learn`` adds to the lexicon: beginnings of words, what each weighs, and its rate in toxic texts."""

    texts: list[bytes] = field(default_factory=list)
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __post_init__(self):
        data, offsets = ta.flat(pa.array(self.texts, pa.binary()))
        hashes = ta.Words(data, offsets, _GAPS).hashes(offsets[:-1], offsets[1:]) if self.texts else np.zeros(0, np.uint64)
        sizes = np.array([len(t) for t in self.texts], np.int64)
        self.by_size = {int(k): np.flatnonzero(sizes == k)[np.argsort(hashes[sizes == k])] for k in np.unique(sizes)}
        self.hashes = hashes

    def of(self, words: ta.Words) -> np.ndarray:
        """For each word the number of the stem that it begins with, or -1."""
        out = np.full(len(words), -1)
        for size, mine in self.by_size.items():
            long = np.flatnonzero(words.end - words.start >= size)
            found = words.hashes(words.start[long], words.start[long] + size)
            keys = self.hashes[mine]
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            hit = keys[at] == found
            out[long[hit]] = mine[at[hit]]
        return out


NO_STEMS = Stems()


def _classes(words: ta.Words) -> np.ndarray:
    """The word classes by the word list."""
    hashes = words.hashes()
    maybe = np.flatnonzero(_MAYBE[hashes & np.uint64(0xFFFF)])
    at = np.minimum(np.searchsorted(_HASHES, hashes[maybe]), len(_HASHES) - 1)
    known = _HASHES[at] == hashes[maybe]
    symbols = np.zeros(len(words), np.int64)
    symbols[maybe[known]] = _CLASSES[at[known]]
    return symbols


def clauses(data: np.ndarray, offsets: np.ndarray, stems: Stems = NO_STEMS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, score by words, score by stems) of every clause with an insult, a threatening verb or a stem; and by row what its stems are charged."""
    data = _LOWER[data]
    words = ta.Words(data, offsets, _GAPS)
    symbols = _classes(words)
    strength, charge = np.zeros(len(words)), np.zeros(len(offsets) - 1)
    if stems.texts:
        stem = stems.of(words)
        at = np.flatnonzero((stem >= 0) & (symbols == 0))
        symbols[at], strength[at] = SYMBOLS.index(LEARNED), stems.weight[stem[at]]
        held = np.unique(words.row[at] * len(stems.texts) + stem[at])
        np.add.at(charge, held // len(stems.texts), stems.rate[held % len(stems.texts)])
        charge *= words.counts
    bad = np.flatnonzero(_BAD[symbols])
    if not len(bad):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), charge
    ends, commas = np.cumsum(_END[data]), np.flatnonzero(_COMMA[data])
    clause = ends[words.start] + words.row  # ends grow within a row, rows part the rest
    heads = np.flatnonzero(np.concatenate([[True], (clause[1:] != clause[:-1]) | (words.row[1:] != words.row[:-1])]))
    mine = np.unique(np.searchsorted(heads, bad, "right") - 1)
    first = heads[mine]
    counts = np.concatenate([heads, [len(words)]])[mine + 1] - first
    inside = ta.ranges(first, counts)
    before = inside[~np.isin(inside, first)]
    paused = before[np.searchsorted(commas, words.start[before]) > np.searchsorted(commas, words.end[before - 1])]
    symbols[paused] += len(SYMBOLS) - 1
    return words.row[first], *GRAMMAR.paths(symbols, first, counts, strength), charge


def _scores(column: pa.Array, stems: Stems = NO_STEMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every row the sum of its clauses' scores, how many have one, and the greatest."""
    data, offsets = ta.flat(column)
    n = len(column)
    total, count, most = np.zeros(n), np.zeros(n, np.int64), np.zeros(n)
    for lo, hi in ta.blocks(offsets):
        row, plain, learned, charge = clauses(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], stems)
        faint, evidence = np.zeros(hi - lo), np.zeros(hi - lo)
        np.add.at(total, row + lo, np.where(plain >= FAINT, plain, 0.0))
        np.maximum.at(faint, row, np.where(plain < FAINT, plain, 0.0))
        np.add.at(evidence, row, learned)
        total[lo:hi] += faint + np.maximum(evidence - charge, 0.0) * THRESHOLD / EVIDENCE
        score = plain + learned * THRESHOLD / EVIDENCE
        np.add.at(count, row + lo, score > 0)
        np.maximum.at(most, row + lo, score)
    return total, count, most


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (toxic, text), by block: for each stem and label how often it stands there (a text counts 2 in 100 words at most), in how many texts, and their words."""
    for batch in batches:
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = ta.flat(batch.column(1))
        for lo, hi in ta.blocks(offsets):
            block = _LOWER[data[offsets[lo] : offsets[hi]]]
            words = ta.Words(block, offsets[lo : hi + 1] - offsets[lo], _GAPS)
            free = np.flatnonzero(_classes(words) == 0)
            for size in STEM_BYTES:
                at = free[words.end[free] - words.start[free] >= size]
                cut = words.start[at] + size
                at = at[(cut == words.end[at]) | (block[np.minimum(cut, len(block) - 1)] & 0xC0 != 0x80)]  # not within a letter
                if not len(at):
                    continue
                hashes = words.hashes(words.start[at], words.start[at] + size)
                order = np.lexsort((words.row[at], hashes))
                at, hashes = at[order], hashes[order]
                row = words.row[at]
                new = np.ones(len(at), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
                heads = np.flatnonzero(new)
                times = np.minimum(np.diff(np.append(heads, len(at))), 1 + words.counts[row[heads]] // 50)
                label, held = labels[lo + row[heads]], words.counts[row[heads]]
                _, model, name = np.unique(hashes[heads], return_index=True, return_inverse=True)
                place = at[heads[model]]
                columns = [np.bincount(name, weights=w * (label == y), minlength=len(model)) for y in (1, 0) for w in (times, np.ones(len(heads)), held)]
                stems = [block[words.start[p] : words.start[p] + size].tobytes() for p in place]
                yield pa.RecordBatch.from_arrays([pa.array(stems, pa.binary()), *(ta.ints(c) for c in columns)], ["stem", *COUNTED])


COUNTED = ["times1", "texts1", "words1", "times0", "texts0", "words0"]


def _unlike(texts: DataFrame) -> np.ndarray:
    """The ids of texts without copies and near copies: of those that have a least hash of three-word windows in common, by one of three hash functions after the other, one."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, words in ta.words_of(batch.column(1)):
                hashes, n = words.hashes(), len(words.counts)
                window = hashes.copy()
                for i in (1, 2):
                    inside = np.minimum(np.arange(len(hashes)) + i, words.first[words.row + 1] - 1)
                    window = ta.mix(window * np.uint64(0x9FB21C651E98DF25) + hashes[inside])
                keys = []
                for salt in range(3):
                    least = np.zeros(n, np.uint64)
                    rows = np.flatnonzero(words.counts)
                    if len(rows):
                        least[rows] = np.minimum.reduceat(ta.mix(window + np.uint64(salt)), words.first[rows])
                    keys.append(pa.array(least.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), *keys], ["doc_id", "a", "b", "c"])

    rows = np.array(sorted(tuple(r) for r in texts.select("doc_id", "text").mapInArrow(sketch, "doc_id bigint, a bigint, b bigint, c bigint").collect()), np.int64).reshape(-1, 4)
    for column in (1, 2, 3):
        rows = rows[np.sort(np.unique(rows[:, column], return_index=True)[1])]
    return rows[:, 0]


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED) -> Stems:
    """The stems that tell labelled toxic documents from clean ones, from at most ``rows`` labelled documents.

    One scan of the ids and of the labelled texts; counts are added up by stem,
    and only those of significant stems come to the driver.
    """
    known = labels.filter("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = ta.least_by_hash(known, rows, "doc_id")
    texts = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")
    texts = cut(texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")))
    apart = docs.sparkSession.createDataFrame(pa.table({"doc_id": ta.ints(_unlike(texts))}))
    texts = texts.join(F.broadcast(apart), "doc_id").select("toxic", "text")
    n = {r.toxic: (r.n, r.words) for r in texts.groupBy("toxic").agg(F.count("*").alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("words")).collect()}
    if len(n) < 2:
        return NO_STEMS
    (clean, clean_words), (toxic, toxic_words) = n[0], n[1]
    sums = texts.mapInArrow(_stem_counts, "stem binary, " + ", ".join(f"{c} bigint" for c in COUNTED)).groupBy("stem").agg(*(F.sum(c).alias(c) for c in COUNTED))
    p1, p0 = F.col("times1") / F.col("words1"), (F.col("times0") + DOUBT) / F.lit(clean_words)
    share = (F.col("texts1") + F.col("texts0")) / F.lit(clean + toxic)
    above = F.col("texts1") / F.lit(toxic) - F.col("texts0") / F.lit(clean)
    far = above / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / clean + 1 / toxic))
    chance = p0 * F.lit(toxic_words)
    more = (F.col("times1") - chance) / F.sqrt(F.col("times1") + chance)
    picked = sums.filter((more >= SIGNIFICANT) & (F.col("texts1") >= max(SUPPORT, toxic // 100)) & (p1 >= RATIO * p0) & (far >= SIGNIFICANT))
    best = picked.select("stem", p1.alias("rate"), F.log(p1 / p0).alias("weight"), (F.col("texts1") * F.log(p1 / p0)).alias("gain")).orderBy(F.desc("gain"), "stem").limit(64 * STEMS).collect()
    chosen: list = []
    for r in best:  # a stem that begins another, or begins with it, counts the same words
        stem = bytes(r.stem)
        if len(chosen) < STEMS and not any(stem.startswith(c[0]) or c[0].startswith(stem) for c in chosen):
            chosen.append((stem, r.weight, r.rate))
    return Stems([c[0] for c in chosen], np.array([c[1] for c in chosen]), np.array([c[2] for c in chosen]))


def score(docs: DataFrame, stems: Stems = NO_STEMS) -> DataFrame:
    """(doc_id, score, clauses, strongest) of every document: its score, how many clauses have one, and the greatest of them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, count, most = _scores(batch.column(1), stems)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(total, 6)), ta.ints(count), pa.array(most)], ["doc_id", "score", "clauses", "strongest"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id bigint, score double, clauses bigint, strongest double")


def reject(docs: DataFrame, threshold: float = THRESHOLD, stems: Stems = NO_STEMS) -> DataFrame:
    """The documents that are not toxic; columns as they were. One scan, no shuffle."""
    place = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(np.round(_scores(batch.column(place), stems)[0], 6) < threshold))

    return docs.mapInArrow(scan, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxic documents, by the word list and the stems that the labels teach."""
    docs = ta.documents(spark, sf_dir)
    return score(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))).filter(F.col("score") >= THRESHOLD)
