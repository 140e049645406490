"""Incidents as STIX 2.1 bundles: objects and relationships in long form, their checks, and documents of bounded size.

Ids follow from type and seed, so equal objects of several incidents have one
id.  The time of making is a parameter: the same input gives the same output.
An object's row has its bundle (the incident), and columns that its type has no
use for are null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import words as W
from .index import keep_first
from .pairs import spread

NAMESPACE = "lodewerk:stix:"
LEVELS = {"low": 0.40, "medium": 0.65, "high": 0.85}
MALWARE_TYPES = {"ransomware": "ransomware", "backdoor": "backdoor", "credential-theft": "spyware", "worm": "worm"}
FIXED = {"file_name": 0.70, "file_path": 0.70, "service": 0.75, "launch_agent": 0.80, "systemd": 0.80}
COLUMNS = {"bundle": "string", "id": "string", "type": "string", "name": "string", "description": "string", "confidence": "int", "pattern": "string", "reference": "string", "kind": "string", "relation": "string", "source_ref": "string", "target_ref": "string"}
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def stix_id(kind: str, seed: Column) -> Column:
    return F.concat(F.lit(f"{kind}--"), E.uuid5(F.concat(F.lit(f"{NAMESPACE}{kind}:"), seed)))


def pattern(kind: Column, value: Column) -> Column:
    """What an indicator looks for; quotes and backslashes of values are escaped."""
    safe = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))

    def of(path: str) -> Column:
        return F.concat(F.lit(f"[{path} = '"), safe, F.lit("']"))

    out = F.when(kind == "domain", of("domain-name:value")).when((kind == "ip") & value.contains(":"), of("ipv6-addr:value")).when(kind == "ip", of("ipv4-addr:value")).when(kind == "url", of("url:value"))
    out = out.when(kind == "sha256", of("file:hashes.'SHA-256'")).when(kind == "sha1", of("file:hashes.'SHA-1'")).when(kind == "md5", of("file:hashes.MD5")).when(kind == "service", of("process:name"))
    return out.when(kind.isin("file_name", "file_path", "launch_agent", "systemd"), of("file:name"))


def _rows(source: DataFrame, of: str, seed: Column, name: Column, **more: Column) -> DataFrame:
    given = {"bundle": F.col("id").cast("string"), "id": stix_id(of, seed), "type": F.lit(of), "name": name, **more}
    return source.select(*(given[c].cast(t).alias(c) if c in given else F.lit(None).cast(t).alias(c) for c, t in COLUMNS.items()))


def _relations(source: DataFrame, relation: str, src: Column, dst: Column) -> DataFrame:
    return _rows(source, "relationship", F.concat_ws(":", src, F.lit(relation), dst), F.lit(None), relation=F.lit(relation), source_ref=src, target_ref=dst)


def objects(incidents: DataFrame, indicators: DataFrame, techniques: DataFrame, profiles: DataFrame) -> DataFrame:
    """All objects and relationships of incidents (id, attack_type, osv_id, ghsa_id, campaign, actor, level, description).

    Indicators are (id, type, value, confidence), techniques (id, technique,
    name), profiles (slug, name, description) with the actor's name in any case.
    Names of files and the like have fixed confidences.  Rows are spread first:
    objects are many times the bytes of what they are made of, so tasks by bytes
    read would hold millions of objects when these are sorted.
    """
    indicators, techniques = spread(indicators, "id"), spread(techniques, "id")
    inc = spread(incidents, "id").withColumn("campaign", F.coalesce("campaign", F.lit(""))).withColumn("actor", F.coalesce("actor", F.lit("")))
    vuln_name = F.coalesce(F.nullif("osv_id", F.lit("")), F.nullif("ghsa_id", F.lit("")))
    address = F.when(F.col("osv_id") != "", F.concat(F.lit("https://osv.dev/vulnerability/"), "osv_id")).otherwise(F.concat(F.lit("https://github.com/advisories/"), "ghsa_id"))
    named, acted = inc.filter("campaign <> ''"), inc.filter("actor <> ''")
    level = W.stix_confidence(E.lookup(F.lower(F.coalesce("level", F.lit(""))), LEVELS))
    family = F.create_map(*[F.lit(x) for item in MALWARE_TYPES.items() for x in item])
    campaign, malware, actor = stix_id("campaign", F.col("campaign")), stix_id("malware", F.col("campaign")), stix_id("threat-actor", F.col("actor"))
    known = acted.join(profiles.select(F.lower("name").alias("_actor"), "slug", F.col("name").alias("profile"), F.col("description").alias("about")), F.lower("actor") == F.col("_actor"))
    group = stix_id("intrusion-set", F.col("slug"))
    uses = techniques.join(named.select("id", "campaign"), "id")
    technique = stix_id("attack-pattern", F.col("technique"))
    found = indicators.withColumn("pattern", pattern(F.col("type"), F.col("value"))).filter("pattern is not null").join(inc.select("id", "campaign"), "id")
    ioc = stix_id("indicator", F.concat(F.col("id").cast("string"), F.lit(":"), "pattern"))
    sure = W.stix_confidence(F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for item in FIXED.items() for x in item]), F.col("type")), F.col("confidence")))
    parts = [
        _rows(inc, "identity", F.lit("lodewerk"), F.lit("lodewerk"), kind=F.lit("system")),
        _rows(inc.filter(vuln_name.isNotNull()), "vulnerability", vuln_name, vuln_name, description=F.col("description"), reference=address),
        _rows(named, "campaign", F.col("campaign"), F.col("campaign"), description=F.col("description"), confidence=level),
        _rows(named, "malware", F.col("campaign"), F.col("campaign"), kind=F.coalesce(F.try_element_at(family, F.col("attack_type")), F.lit("trojan"))),
        _relations(named, "uses", campaign, malware),
        _rows(acted, "threat-actor", F.col("actor"), F.col("actor"), kind=F.lit("criminal")),
        _relations(acted.filter("campaign <> ''"), "attributed-to", campaign, actor),
        _rows(known, "intrusion-set", F.col("slug"), F.col("profile"), description=F.col("about")),
        _relations(known, "part-of", actor, group),
        _rows(techniques, "attack-pattern", F.col("technique"), F.col("name"), reference=W.technique_address(F.col("technique")), kind=F.lit("initial-access")),
        _relations(uses, "uses", campaign, technique),
        _rows(found, "indicator", F.concat(F.col("id").cast("string"), F.lit(":"), "pattern"), F.concat_ws(": ", "type", "value"), confidence=sure, pattern=F.col("pattern"), kind=F.lit("malicious-activity")),
        _relations(found.filter("campaign <> ''"), "indicates", ioc, campaign),
    ]
    return reduce(DataFrame.unionByName, parts)


def once(made: DataFrame) -> DataFrame:
    """Each object once, as its first bundle has it."""
    return keep_first(made, ["id"], ["bundle", "type"])


def invalid(made: DataFrame, within: tuple[str, ...] = ("bundle",)) -> DataFrame:
    """(bundle, id, problem): missing names and patterns, ids of a wrong form, ends that are no object of the same bundle (of all, if ``within`` is empty)."""
    kind = F.col("type")
    tail = F.expr("substring(id, length(type) + 3)")
    needs = kind.isin("identity", "campaign", "attack-pattern", "vulnerability", "indicator")
    checks = F.array(
        F.when(~F.coalesce(F.startswith("id", F.concat("type", F.lit("--"))), F.lit(False)) | ~F.coalesce(tail.rlike(UUID), F.lit(False)), F.lit("bad id")),
        F.when(needs & (F.coalesce("name", F.lit("")) == ""), F.lit("no name")),
        F.when((kind == "indicator") & (F.coalesce("pattern", F.lit("")) == ""), F.lit("no pattern")),
        F.when(kind.isin("malware", "threat-actor", "indicator") & (F.coalesce("kind", F.lit("")) == ""), F.lit("no types")),
        F.when((kind == "relationship") & (F.coalesce("relation", F.lit("")) == ""), F.lit("no relation")),
    )
    bad = made.select("bundle", "id", F.explode(checks).alias("problem")).filter("problem is not null")
    known = made.select(*within, F.col("id").alias("_end")).distinct()
    ends = F.array(*(F.struct(F.lit(f"{end} unknown").alias("problem"), F.col(end).alias("_end")) for end in ("source_ref", "target_ref")))
    lost = made.filter("type = 'relationship'").select("bundle", "id", F.inline(ends)).join(known, [*within, "_end"], "left_anti")  # both ends meet what is known at once
    return bad.unionByName(lost.select("bundle", "id", "problem"))


def documents(made: DataFrame, now: str) -> DataFrame:
    """(id, json): each object as JSON, with its times; keys without a value are left out."""
    stamp = F.lit(now)
    names = {"name": "name", "description": "description", "confidence": "confidence", "pattern": "pattern", "relationship_type": "relation", "source_ref": "source_ref", "target_ref": "target_ref"}
    whole = F.struct("type", "id", F.lit("2.1").alias("spec_version"), stamp.alias("created"), stamp.alias("modified"), *(F.col(c).alias(n) for n, c in names.items()),
        F.when(F.col("type") == "indicator", "stix").alias("pattern_type"), F.when(F.col("type") == "indicator", stamp).alias("valid_from"), F.when(F.col("type") == "indicator", F.array("kind")).alias("indicator_types"),
        F.when(F.col("type") == "malware", F.array("kind")).alias("malware_types"), F.when(F.col("type") == "malware", True).alias("is_family"), F.when(F.col("type") == "threat-actor", F.array("kind")).alias("threat_actor_types"), F.when(F.col("type") == "identity", F.col("kind")).alias("identity_class"),
        F.when(F.col("reference").isNotNull(), F.array(F.struct(F.lit("lodewerk").alias("source_name"), F.col("reference").alias("url")))).alias("external_references"))
    return made.select("id", F.to_json(whole).alias("json"))
