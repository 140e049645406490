"""Main text of HTML pages as a maximum-scoring subsequence.

A page is a sequence of words, which score positive, and tags, which score
negative by their name; the content is the contiguous region with the greatest
sum, found in one scan.  Weights come from labelled pages, those that mark
their content with one ``article`` element: a perceptron compares the best
region with the marked one and shifts weights, averaged over all steps.  The
label tag itself has no weight, so the weights hold for pages without it.  At
most ``max_labelled`` pages, the least by hash, are used for the fit.

Comments, scripts, styles and the like are dropped as a whole.  Of several best
regions the first counts.  Results by case: a page with null or empty html or
without words has the text "" and score 0; rows without an id and repeated rows
are extracted like others; without labelled pages ``DEFAULT`` weights hold; an
empty table gives no rows.  Other columns don't matter.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textarrays as ta

LABEL = "article"
MAX_LABELLED = 2000
ROUNDS = 8
WORD, LEAST = "word", 0.05
DEFAULT = {WORD: 1.0, "": -3.0, "p": -1.0, "/p": -1.0, "b": -0.5, "/b": -0.5, "i": -0.5, "/i": -0.5, "em": -0.5, "/em": -0.5, "a": -2.0, "/a": -2.0, "div": -10.0, "/div": -10.0, "nav": -20.0, "/nav": -20.0, "footer": -20.0, "/footer": -20.0}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|head|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<![^>]*>|<(/?[a-zA-Z][a-zA-Z0-9]*)[^>]*>", re.S | re.I)
_BLOCKS = {"p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "blockquote", "pre", "ul", "ol", "table"}


def _open_ended(m: re.Match) -> bool:
    """Whether what is dropped as a whole goes on behind the match for want of its end."""
    if m[0].startswith("<!--"):
        return not m[0][4:].endswith("-->")
    return bool(m[1]) and not re.search(rf"</{m[1]}\s*>\Z", m[0], re.I)


def tokens(page: str) -> list[tuple[str, int, int, int]]:
    """(tag name or "", words, begin, end): tags, and the texts between them; what is dropped is left out."""
    # what stands behind the last ">" has no tag, so no search for the end of one runs to the page's end in vain
    out, at, last = [], 0, page.rfind(">") + 1
    for m in _TOKEN.finditer(page, 0, last):
        if m.start() > at:
            out.append(("", len(page[at : m.start()].split()), at, m.start()))
        if m[2]:
            out.append((m[2].lower(), 0, m.start(), m.end()))
        at = m.end()
        if at == last and _open_ended(m):
            return out  # never closed: dropped with all that follows
    end = page.find("<!--", max(at, last))
    end = len(page) if end < 0 else end
    if at < end:
        out.append(("", len(page[at:end].split()), at, end))
    return out


def best(parts: list[tuple[str, int, int, int]], weights: dict[str, float]) -> tuple[float, int, int]:
    """The greatest sum of consecutive parts, and which they are (first, end); 0 and none if no sum is above 0."""
    other, word = weights[""], weights[WORD]
    total, begin, top, first, end = 0.0, 0, 0.0, 0, 0
    for i, (tag, words, _, _) in enumerate(parts):
        if total <= 0:
            total, begin = 0.0, i
        total += words * word if not tag else 0.0 if tag.lstrip("/") == LABEL else weights.get(tag, other)
        if total > top:
            top, first, end = total, begin, i + 1
    return top, first, end


def features(parts: list[tuple[str, int, int, int]]) -> Counter:
    out: Counter = Counter()
    for tag, words, _, _ in parts:
        if not tag:
            out[WORD] += words
        elif tag.lstrip("/") != LABEL:
            out[tag] += 1
    return out


def fit(pages: list[str], rounds: int = ROUNDS) -> dict[str, float]:
    """Weights by a perceptron with averaging; words stay positive, tags negative."""
    labelled = []
    for page in pages:
        parts = tokens(page)
        marks = [i for i, p in enumerate(parts) if p[0].lstrip("/") == LABEL]
        if len(marks) == 2 and any(p[1] for p in parts[marks[0] + 1 : marks[1]]):
            labelled.append((parts, marks[0] + 1, marks[1]))
    if not labelled:
        return DEFAULT
    weights: dict[str, float] = defaultdict(lambda: -1.0, {WORD: 1.0, "": -3.0})
    total: Counter = Counter()
    steps = 0
    for _ in range(rounds):
        for parts, first, end in labelled:
            for tag, *_ in parts:
                weights[tag]  # a tag that was seen has a weight of its own
            _, a, b = best(parts, weights)
            want, got = features(parts[first:end]), features(parts[a:b])
            size = max(want[WORD], 1)
            for name in want | got:
                shift = want[name] - got[name]
                if shift:
                    changed = weights[name] + (0.01 * shift / size if name == WORD else 0.5 * shift)
                    weights[name] = max(changed, LEAST) if name == WORD else min(changed, -LEAST)
            steps += 1
            for name, w in weights.items():
                total[name] += w
    # a tag's average counts from its first page on as if it had had its weight from the start
    return {name: max(t / steps, LEAST) if name == WORD else min(t / steps, -LEAST) for name, t in total.items()} | {"": DEFAULT[""]}


def region(page: str | None, weights: dict[str, float]) -> tuple[str, int, float]:
    """(text, words, score) of a page's content."""
    parts = tokens(page or "")
    score, first, end = best(parts, weights)
    pieces = []
    for tag, _, a, b in parts[first:end]:
        if not tag:
            pieces.append(html.unescape(page[a:b]))
        elif tag.lstrip("/") in _BLOCKS:
            pieces.append("\n")
    lines = (" ".join(line.split()) for line in "".join(pieces).split("\n"))
    text = "\n".join(line for line in lines if line)
    return text, len(text.split()), score


def train(pages: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[str, float]:
    """Weights from the labelled pages; the sample is the ``max_labelled`` least by hash."""
    marked = pages.filter(F.col("html").contains(f"<{LABEL}")).select("html")
    return fit([r.html for r in ta.least_by_hash(marked, max_labelled, "html").collect()])


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(page_id, words, score, text) of every page. One scan, no shuffle."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                made = [region(page, weights) for page in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.float64()), pa.array([m[0] for m in made], pa.string())], ["page_id", "words", "score", "text"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(scan, "page_id bigint, words bigint, score double, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, train(pages))
