"""Attribution: which actors an incident names, outright or in passing, and what an actor's incidents add up to.

Aliases are a dimension: ``MAX_ALIASES`` bytes of them at most are shipped to
the workers as one automaton that reads each text once, however many aliases
there are.  More than that go in several parts, one scan of the texts each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONG = 6  # aliases of so many bytes are sought anywhere, shorter ones as words
EXPLICIT, INFERRED = 0.90, 0.65
MAX_ALIASES = 16 << 20
SLICE = 256  # texts whose matches are held at once


def alias_index(profiles: DataFrame) -> DataFrame:
    """(alias, slug): names and aliases in lower case; of several profiles with one alias the last by slug has it."""
    every = profiles.select("slug", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("alias"))
    return every.filter("alias <> ''").groupBy(F.lower("alias").alias("alias")).agg(F.max("slug").alias("slug"))


def lookup(rows: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """(id, slug): rows whose column is an alias, in whatever case."""
    return rows.select("id", F.lower(column).alias("alias")).filter("alias <> ''").join(aliases, "alias").select("id", "slug").distinct()


def _parts(aliases: DataFrame, most: int) -> Iterator[list[tuple[str, str]]]:
    part, held = [], 0
    for row in aliases.select("alias", "slug").toLocalIterator():
        part.append((row.alias, row.slug))
        held += len(row.alias.encode()) + len(row.slug.encode())
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def text_matches(texts: DataFrame, aliases: DataFrame, most: int = MAX_ALIASES) -> DataFrame:
    """(id, slug) of texts (id, text) that hold an alias, in whatever case: long ones anywhere, short ones as words. One scan of the texts.

    Null texts match nothing; repeated matches count once in a row.
    """
    out = None
    for part in _parts(aliases, most):
        shared = texts.sparkSession.sparkContext.broadcast(part)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tree, short = ahocorasick.Automaton(), {}
            for alias, slug in shared.value:
                if len(alias.encode()) >= LONG:
                    tree.add_word(alias, slug)
                else:
                    short[alias] = slug
            tree.make_automaton()
            words = re.compile(r"\b(" + "|".join(sorted(map(re.escape, short), key=len, reverse=True)) + r")\b", re.ASCII) if short else None
            for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
                ids, slugs = [], []
                for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text = text.as_py()  # one text at a time is an object of Python
                    low = (text or "").lower()
                    found = {slug for _, slug in tree.iter(low)} if len(tree) else set()
                    if words:
                        found |= {short[w] for w in words.findall(low)}
                    ids += [id_] * len(found)
                    slugs += sorted(found)
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(slugs, pa.string())], ["id", "slug"])

        kind = texts.schema["id"].dataType.simpleString()
        here = texts.select("id", F.col("text").cast("string").alias("text")).mapInArrow(scan, f"id {kind}, slug string")
        out = here if out is None else out.unionByName(here)
    if out is None:
        return texts.select("id", F.lit("").alias("slug")).limit(0)
    return out


def attribute(incidents: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, module, slug, match, confidence): actors that an incident names as its actor, campaign or group, else those in its id, description or references."""
    fields = incidents.select("id", F.explode(F.array("actor", "campaign", "group")).alias("named"))
    explicit = lookup(fields, "named", aliases).withColumn("explicit", F.lit(1))
    text = F.concat_ws(" ", F.col("id").cast("string"), "description", "references")
    inferred = text_matches(incidents.select("id", text.alias("text")), aliases).withColumn("explicit", F.lit(0))
    both = explicit.unionByName(inferred).groupBy("id", "slug").agg(F.max("explicit").alias("explicit"))
    named = both.select("id", "slug", F.when(F.col("explicit") == 1, "explicit").otherwise("inferred").alias("match"), F.when(F.col("explicit") == 1, EXPLICIT).otherwise(INFERRED).alias("confidence"))
    return named.join(incidents.select("id", "module"), "id").select("id", "module", "slug", "match", "confidence")


def with_actors(incidents: DataFrame, links: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, actor, actor_ids): the actor that an incident has, else the name of its surest actor (the least slug of several); all slugs in order."""
    named = links.join(profiles.select("slug", "name"), "slug")
    by = named.groupBy("id").agg(F.min_by("name", F.struct(-F.col("confidence"), "slug")).alias("first"), F.array_join(F.array_sort(F.collect_set("slug")), ",").alias("actor_ids"))
    joined = incidents.select("id", "actor").join(by, "id", "left")
    return joined.select("id", F.when(F.col("actor") != "", F.col("actor")).otherwise(F.coalesce("first", F.lit(""))).alias("actor"), F.coalesce("actor_ids", F.lit("")).alias("actor_ids"))


def actor_indicators(links: DataFrame, indicators: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """(slug, kind, value): the distinct domains, addresses and hashes of an actor's incidents, with those known before; addresses keep their case."""
    kind = F.when(F.col("type").isin("domain", "ip"), F.col("type")).when(F.col("type").isin("sha256", "sha1", "md5"), "hash")
    found = links.select("id", "slug").join(indicators.select("id", kind.alias("kind"), F.when(F.col("type") == "ip", F.col("value")).otherwise(F.lower("value")).alias("value")), "id")
    out = found.filter("kind is not null and value is not null").select("slug", "kind", "value")
    return (out if before is None else out.unionByName(before.select("slug", "kind", "value"))).distinct()


def profiles_of(objects: DataFrame) -> DataFrame:
    """Actor profiles from a bundle's objects (type, id, name, aliases, description, source, target): groups with the techniques and tools that they use."""
    from ..functions import words as W

    groups = objects.filter("type = 'intrusion-set'").select("id", W.tag_slug(F.col("name")).alias("slug"), "name", F.filter(F.array_distinct("aliases"), lambda a: (a != "") & (F.lower(a) != F.lower("name"))).alias("aliases"), W.actor_type(F.col("description")).alias("kind"), W.truncate(F.col("description"), 500, "...").alias("description"))
    used = objects.filter("type = 'relationship' and relation = 'uses'").select(F.col("source").alias("id"), F.col("target"))
    ends = objects.filter("type in ('attack-pattern', 'malware', 'tool')").select(F.col("id").alias("target"), F.col("type").alias("what"), F.col("name").alias("used"))
    pairs = used.join(ends, "target").groupBy("id", "what", "used").agg(F.count("*").alias("_n"))
    lists = pairs.groupBy("id").agg(*(F.array_join(F.array_sort(F.collect_set(F.when(F.col("what").isin(*kinds), F.col("used")))), ",").alias(name) for name, kinds in (("techniques", ("attack-pattern",)), ("software", ("malware", "tool")))))  # a group's own uses
    return groups.join(lists, "id", "left").select("slug", "name", "aliases", "kind", "description", F.coalesce("techniques", F.lit("")).alias("techniques"), F.coalesce("software", F.lit("")).alias("software"))
