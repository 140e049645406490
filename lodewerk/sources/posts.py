"""Indicators and packages from the HTML of blog posts.

The tables and lists are read by Column expressions: rows are found by regular
expressions on the mark-up and exploded, so posts stay inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import words as W
from ..operators.index import keep_first

TYPES = {
    "c2 domain": "domain", "domain": "domain", "hostname": "domain", "c2 ip": "ip", "ip": "ip", "ip address": "ip", "ipv4": "ip", "payload url": "url", "url": "url", "sha256": "sha256", "sha-256": "sha256", "sha1": "sha1", "sha-1": "sha1", "md5": "md5",
    "service name": "service", "macos persistence": "launch_agent", "linux persistence": "systemd", "runtime artifact": "file_name", "file name": "file_name", "filename": "file_name", "path": "file_path", "file path": "file_path", "package": "package",
}
_HASH_LENGTHS = {64: "sha256", 40: "sha1", 32: "md5"}


def visible(html: Column) -> Column:
    """The text without scripts, styles and tags; entities of the mark-up are undone."""
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), "(?s)<[^>]*>", " ")
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(c))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def hash_type(value: Column) -> Column:
    out = F.lit(None).cast("string")
    for n, name in _HASH_LENGTHS.items():
        out = F.when(value.rlike(f"^[0-9a-fA-F]{{{n}}}$"), name).otherwise(out)
    return out


def table_rows(posts: DataFrame) -> DataFrame:
    """(url, type, value, filename) from tables headed (File, Hash), (Type, Indicator) or (Indicator, Type)."""
    tables = posts.select("url", F.posexplode(F.regexp_extract_all("html", F.lit("(?is)<table\\b.*?</table>"), F.lit(0))).alias("t", "table"))
    rows = tables.select("url", "t", F.posexplode(F.regexp_extract_all("table", F.lit("(?is)<tr\\b.*?</tr>"), F.lit(0))).alias("r", "row"))
    cells = rows.select("url", "t", "r", F.transform(F.regexp_extract_all("row", F.lit("(?is)<t[hd]\\b[^>]*>.*?</t[hd]>"), F.lit(0)), lambda c: visible(c)).alias("cells")).filter("size(cells) >= 2")
    pair = cells.select("url", "t", "r", F.col("cells")[0].alias("a"), F.col("cells")[1].alias("b"))
    head = pair.filter("r = 0").select("url", "t", F.lower("a").alias("ha"), F.lower("b").alias("hb"))
    body = pair.filter("r > 0").join(head, ["url", "t"])
    names = F.create_map(*[F.lit(x) for item in TYPES.items() for x in item])
    file_row, typed, turned = (F.col("ha") == "file") & (F.col("hb") == "hash"), (F.col("ha") == "type") & (F.col("hb") == "indicator"), (F.col("ha") == "indicator") & (F.col("hb") == "type")
    kind = F.when(file_row, hash_type(F.col("b"))).when(typed, F.try_element_at(names, F.lower("a"))).when(turned, F.try_element_at(names, F.lower("b")))
    value = F.when(turned, F.col("a")).otherwise(F.col("b"))
    return body.select("url", kind.alias("type"), E.undefang(value).alias("value"), F.when(file_row, F.col("a")).alias("filename")).filter("type is not null and value <> ''")


def text_indicators(posts: DataFrame) -> DataFrame:
    """(url, type, value, filename) from the visible text: defanged domains, addresses, hashes."""
    text = visible(F.col("html"))

    def of(kind: str, pattern: str) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value")))

    every = F.concat(of("domain", r"\b[A-Za-z0-9-]+(?:\[\.\][A-Za-z0-9-]+)+\b"), of("ip", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"), *(of(k, rf"\b[a-fA-F0-9]{{{n}}}\b") for n, k in _HASH_LENGTHS.items()))
    found = posts.select("url", F.explode(every).alias("x")).select("url", "x.type", E.undefang(F.col("x.value")).alias("value"))
    kind = F.when((F.col("type") == "domain") & F.col("value").rlike(r"^[0-9.]+$"), "ip").otherwise(F.col("type"))
    return found.select("url", kind.alias("type"), "value", F.lit(None).cast("string").alias("filename"))


def indicators(posts: DataFrame) -> DataFrame:
    """Clean indicators of posts (url, html), tables before text, each (type, value) once."""
    both = table_rows(posts).withColumn("pos", F.lit(0)).unionByName(text_indicators(posts).withColumn("pos", F.lit(1)))
    clean = both.withColumn("value", E.normalize_ioc(F.col("type"), F.col("value"))).filter("value is not null")
    return keep_first(clean, ["url", "type", "value"], ["pos", F.desc_nulls_last("filename")]).drop("pos")


def _mention(name: Column, version: Column) -> Column:
    return F.struct(F.lower(F.regexp_replace(name, "[.,;!?]+$", "")).alias("name"), F.coalesce(version, F.lit("")).alias("version"))


def package_mentions(posts: DataFrame) -> DataFrame:
    """(url, ecosystem, name, version) of packages that a post installs or pins; the first version that isn't empty wins."""
    text = visible(F.col("html"))
    patterns = {
        "npm": (r"(?i)npm (?:install|i) (@?[a-z0-9][a-z0-9._/-]*)(?:@([0-9][0-9A-Za-z.+-]*))?", r"(@[a-z0-9-]+/[a-z0-9._-]+)(?:[@ ]v?([0-9]+\.[0-9][0-9A-Za-z.+-]*))?"),
        "pypi": (r"(?i)pip3? install ([a-z0-9][a-z0-9._-]*)(?:==([0-9][0-9A-Za-z.]*))?", r"\b([A-Za-z][A-Za-z0-9._-]*)==([0-9][0-9A-Za-z.]*)"),
    }
    lists = []
    for ecosystem, expressions in ((F.lit(e), x) for e, x in patterns.items()):
        for e in expressions:
            names, versions = (F.regexp_extract_all(text, F.lit(e), F.lit(g)) for g in (1, 2))
            lists.append(F.transform(F.zip_with(names, versions, _mention), lambda m: F.struct(ecosystem.alias("ecosystem"), m["name"].alias("name"), m["version"].alias("version"))))
    rows = posts.select("url", F.posexplode(F.concat(*lists)).alias("pos", "p")).select("url", "pos", "p.*").filter(~E.false_package(F.col("name")))
    return rows.groupBy("url", "ecosystem", "name").agg(F.coalesce(F.min_by("version", F.when(F.col("version") != "", F.col("pos"))), F.lit("")).alias("version"))


def http_indicators(code: DataFrame) -> DataFrame:
    """(id, type, value, confidence) from exploit code (id, text): paths, user agents, bodies and parameters; the first of a (type, value) counts."""
    return code.select("id", F.explode(W.code_indicators(F.col("text"))).alias("x")).select("id", "x.*")
