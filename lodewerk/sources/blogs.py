"""Blogs: which posts matter, what is in their sections, and drafts of incidents from them.

Most blogs are read by the generic tables and patterns of ``posts``; some have
sections of their own.  ``PARSERS`` is open: a function of a page's HTML that
gives (type, value, filename, context) rows is one more blog.  Pages are parsed
in Arrow batches by an event parser, each on its own, so there is no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from ..functions import words as W
from ..operators.index import keep_first
from . import posts as P

GENERIC = ("blackfog", "bleepingcomputer", "corvus", "coveware", "dfir_report", "emsisoft", "eset", "greynoise", "horizon3", "malwarebytes", "microsoft_sec", "polyswarm", "project_zero", "proofpoint", "rapid7", "red_canary", "secureworks", "sekoia", "sonatype", "talos", "tenable", "unit42", "watchtowr", "phylum")
ROWS = "url string, type string, value string, filename string, context string"
Row = tuple[str, str, str, str]
_IP = re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}\b")
_SHA256 = re.compile(r"\b[0-9a-fA-F]{64}\b")
_HASH_LINE = re.compile(r"^-?\s*(SHA256|SHA1|MD5)\s*:?\s+([0-9a-fA-F]{32,64})\s*$", re.I)
_HEX = re.compile(r"^[0-9a-fA-F]+$")
WIZ_TYPES = {"domain": "domain", "c2 domain": "domain", "ip": "ip", "ip address": "ip", "c2 ip": "ip", "url": "url", "sha256": "sha256", "sha-256": "sha256", "sha1": "sha1", "sha-1": "sha1", "md5": "md5", "file": "file_name", "service": "service", "persistence": "linux_persistence"}


class Sections(HTMLParser):
    """A page as (h2, h3, label, tag, text) blocks in order: headings and labels (bold text) hold for what follows them."""

    BLOCKS = {"p", "li", "td", "th", "tr", "pre", "div", "table", "h1", "h2", "h3", "ul", "ol", "br"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str, str, str, str]] = []
        self.h2 = self.h3 = self.label = ""
        self.stack: list[str] = []
        self.text: list[str] = []
        self.kind = ""
        self.bold: list[str] | None = None
        self.skip = 0

    def flush(self) -> None:
        text = "".join(self.text).strip()
        self.text = []
        if not text:
            return
        if self.kind == "h2":
            self.h2, self.h3, self.label = text.lower(), "", ""
        elif self.kind == "h3":
            self.h3, self.label = text.lower(), ""
        else:
            self.blocks.append((self.h2, self.h3, self.label, self.kind, text))

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        if tag in self.BLOCKS:
            self.flush()
            self.kind = tag
        if tag in ("b", "strong") and self.kind not in ("li", "td", "h2", "h3"):
            self.flush()
            self.bold = []

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        if tag in ("b", "strong") and self.bold is not None:
            self.label = "".join(self.bold).strip()
            self.bold = None
        if tag in self.BLOCKS:
            self.flush()
            self.kind = ""

    def handle_data(self, data):
        if not self.skip:
            (self.text if self.bold is None else self.bold).append(data)

    @classmethod
    def of(cls, page: str) -> list[tuple[str, str, str, str, str]]:
        parser = cls()
        parser.feed(page)
        parser.close()
        parser.flush()
        return parser.blocks


def undefang(text: str) -> str:
    return re.sub(r"\[\.\]|\(\.\)|\{\.\}", ".", text).replace("hxxps://", "https://").replace("hxxp://", "http://")


def network(text: str) -> Iterator[Row]:
    """A URL, an address, or a word with a dot."""
    value = undefang(text.strip())
    if value.startswith(("http://", "https://")):
        yield "url", value.split()[0], "", ""
    elif found := _IP.search(value):
        yield "ip", found[0], "", ""
    elif "." in value and " " not in value:
        yield "domain", value, "", ""


def _of_length(value: str) -> str:
    return {64: "sha256", 40: "sha1", 32: "md5"}.get(len(value), "") if _HEX.match(value) else ""


def _in_section(page: str, *names: str) -> list[tuple[str, str, str, str, str]]:
    return [b for b in Sections.of(page) if any(n in b[0] for n in names)]


def socket(page: str) -> Iterator[Row]:
    """Headings of the third level switch between files (bold text names the file of the hashes that follow), network and packages; lines that say not to block are skipped."""
    for _, h3, label, _, text in _in_section(page, "indicators of compromise"):
        for line in text.split("\n"):
            line = line.strip()
            if "do not block" in line.lower() or not line:
                continue
            if "file" in h3 or "hash" in h3:
                if m := _HASH_LINE.match(line):
                    yield m[1].lower(), m[2].lower(), label, ""
            elif "network" in h3 or "domain" in h3 or "ip" in h3:
                yield from network(line.lstrip("- "))
    said = " ".join(b[4] for b in Sections.of(page) if "attribution" in b[0] or "threat actor" in b[0])
    if m := re.search(r"(?i)(?:campaign|operation|cluster|actor|group)\s*:?\s*([A-Z][A-Za-z0-9][A-Za-z0-9 \-]{2,38})", said):
        yield "campaign_marker", m[1].strip(), "", ""


def _item(section: str, text: str, network_words: tuple[str, ...], fallback: bool) -> Iterator[Row]:
    low = section.lower()
    if "file" in low or "hash" in low:
        if m := _SHA256.search(text):
            yield "sha256", m[0].lower(), text[: m.start()].strip(" :-–—\t"), ""
        else:
            yield "file_name", text, "", ""
    elif any(w in low for w in network_words):
        yield from network(text)
    elif "package" in low or "npm" in low:
        yield ("git_dep", text, "", "") if text.startswith("github:") else ("package", text, "", "")
    elif "campaign" in low or "marker" in low:
        yield "campaign_marker", text, "", ""
    elif undefang(text).startswith(("http://", "https://")):
        yield "url", undefang(text).split()[0], "", ""
    elif fallback and (m := _SHA256.search(text)):
        yield "sha256", m[0].lower(), text[: m.start()].strip(" :-–—\t"), ""


def aikido(page: str) -> Iterator[Row]:
    """Bold or third-level labels say what the list items that follow them are."""
    for _, h3, label, kind, text in _in_section(page, "indicators of compromise"):
        if kind == "li":
            yield from _item(label or h3, text, ("network", "c2", "domain"), False)


def stepsecurity(page: str) -> Iterator[Row]:
    """As aikido, from a heading of either level with the phrase or "ioc" on, with wider words for networks."""
    for b in Sections.of(page):
        if any(w in h for h in b[:2] for w in ("indicators of compromise", "ioc")) and b[3] == "li":
            yield from _item(b[2] or b[1], b[4], ("network", "c2", "domain", "ip", "url"), True)


def wiz(page: str) -> Iterator[Row]:
    """Within the section of indicators: rows of two cells by their type; third-level headings name the package they belong to."""
    cells: list[str] = []
    for _, h3, _, kind, text in _in_section(page, "indicators of compromise"):
        if kind not in ("td", "th"):
            cells = []
            for m in re.finditer(r"[0-9A-Za-z-]+(?:\[\.\][0-9A-Za-z-]+)+", text):
                yield "domain", undefang(m[0]), "", h3
            continue
        cells.append(text)
        if len(cells) == 2:
            a, b = cells
            cells = []
            if (known := _of_length(b)) and a.lower() not in WIZ_TYPES:
                yield known, b.lower(), a, h3
            elif kind_ := WIZ_TYPES.get(a.lower()):
                yield kind_, undefang(b), "", h3
            elif kind_ := WIZ_TYPES.get(b.lower()):
                yield kind_, undefang(a), "", h3


def elastic_labs(page: str) -> Iterator[Row]:
    """Names of YARA rules in code blocks, beside what the generic reader finds."""
    for block in re.findall(r"(?is)<pre\b.*?</pre>", page):
        for name in re.findall(r"\brule\s+([A-Za-z_][A-Za-z0-9_]*)\s*(?:\{|&#123;)", block):
            yield "yara_rule", name, "", ""


PARSERS: dict[str, Callable[[str], Iterator[Row]]] = {"socket": socket, "aikido": aikido, "stepsecurity": stepsecurity, "wiz": wiz, "elastic_labs": elastic_labs}
ALSO_GENERIC = ("elastic_labs",)


def relevant(title: Column, description: Column, include: tuple[str, ...] = W.SUPPLY_WORDS, exclude: tuple[str, ...] = ()) -> Column:
    text = F.concat_ws(" ", title, description)
    return W.any_of(text, include) & ~W.any_of(text, exclude)


def sectioned(pages: DataFrame, parser: Callable[[str], Iterator[Row]]) -> DataFrame:
    """(url, type, value, filename, context) of pages (url, html), each row once. One scan."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part, out = batch.slice(lo, 64), []
                for url, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    out += [(url, *row) for row in dict.fromkeys(parser(page or ""))]
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(5)], ["url", "type", "value", "filename", "context"])

    return pages.select(F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(scan, ROWS)


def parse(pages: DataFrame, blog: str) -> DataFrame:
    """Indicators of a blog's pages by its own reader, or by the generic one."""
    generic = P.indicators(pages).select("url", "type", "value", F.coalesce("filename", F.lit("")).alias("filename"), F.lit("").alias("context"))
    if blog not in PARSERS:
        return generic
    own = sectioned(pages, PARSERS[blog])
    return own.unionByName(generic).dropDuplicates(["url", "type", "value"]) if blog in ALSO_GENERIC else own


def merge_packages(primary: DataFrame, generic: DataFrame) -> DataFrame:
    """Packages (url, ecosystem, name, version) of both, the first reader's winning, by lower-case ecosystem and name."""
    both = primary.withColumn("_at", F.lit(0)).unionByName(generic.withColumn("_at", F.lit(1))).withColumn("_key", F.lower(F.concat_ws("|", "ecosystem", "name")))
    return keep_first(both, ["url", "_key"], ["_at", "name"]).drop("_at", "_key")


def drafts(posts: DataFrame, indicators: DataFrame, packages: DataFrame, source: str) -> DataFrame:
    """Drafts of incidents from posts (url, title, published): indicators of the kinds that incidents have, packages, ids that stay; posts with neither give none."""
    weight = K.SOURCE_WEIGHTS.get(source, 0.0)
    kinds = ("domain", "ip", "url", "sha256", "sha1", "md5", "file_name", "service", "macos_persistence", "linux_persistence", "git_dep", "campaign_marker")
    by = indicators.filter(F.col("type").isin(*kinds)).groupBy("url").agg(F.array_sort(F.collect_set(F.struct("type", "value", "filename"))).alias("iocs"))  # a page's indicators
    named = packages.groupBy("url").agg(F.array_sort(F.collect_set(F.struct("ecosystem", "name", "version"))).alias("packages"))
    rows = posts.join(by, "url", "left").join(named, "url", "left").filter("iocs is not null or packages is not null")
    return rows.select(W.post_id(F.lit(source), F.col("url"), F.col("title")).alias("id"), F.lit(source).alias("source"), F.col("title").alias("description"), "published", F.array("url").alias("references"), "iocs", "packages", F.lit(weight).alias("confidence"))


def feed_posts(spark: SparkSession, path: str, since: str | None = None, tag: str = "item") -> DataFrame:
    """(title, description, link, published, categories) of a landed RSS or Atom feed (tag "entry"); older posts go, those without a date stay."""
    schema = "title string, description string, summary string, link string, pubDate string, published string, updated string, category array<string>"
    rows = spark.read.schema(schema).option("rowTag", tag).xml(path)
    stamp = F.coalesce(F.try_to_timestamp(F.regexp_replace(F.regexp_replace("pubDate", r"^[A-Za-z]+,\s*", ""), r"\s(GMT|UTC?|Z)$", " +0000"), F.lit("d MMM yyyy HH:mm:ss Z")), E.rfc3339(F.col("published")), E.rfc3339(F.col("updated")))
    rows = rows.select("title", F.coalesce("description", "summary", F.lit("")).alias("description"), "link", stamp.alias("published"), F.coalesce("category", F.array().cast("array<string>")).alias("categories"))
    return rows if since is None else rows.filter(F.col("published").isNull() | (F.col("published") >= F.lit(since).cast("timestamp")))


def route(posts: DataFrame, rules: list[dict], never: tuple[str, ...] = ()) -> DataFrame:
    """Posts once for each module whose words they have: rules are {module, include, exclude}; any of ``never`` and no module gets them."""
    text = F.lower(F.concat_ws(" ", "title", F.array_join("categories", " ")))
    found = [F.when(W.any_of(text, r["include"]) & ~W.any_of(text, r.get("exclude", ())), F.lit(r["module"])) for r in rules]
    return posts.filter(~W.any_of(text, never)).withColumn("module", F.explode(F.array_distinct(F.array_compact(F.array(*found)))))


def post_drafts(posts: DataFrame, source: str) -> DataFrame:
    """Drafts from routed posts (module, title, description, link)."""
    return posts.select(W.draft_id(F.col("module"), F.lit(source), F.col("title")).alias("id"), "module", W.draft_description(F.col("title"), F.col("description")).alias("description"), F.lit("unknown").alias("attack_type"), F.lit("medium").alias("severity"), F.array("link").alias("references"))
