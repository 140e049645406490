"""Queries of records in long form: entity resolution in full, gates, feeds, attribution, ids, repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import entities, resolve
from .catalogue import query
from .views import INC, incidents

# views: an incident's packages, references and indicators, in order

PKGS = """pk AS (SELECT id, user_id AS component, 0 AS pos, ecosystem, package AS name, 'v' || (id % 5) AS version FROM inc
  UNION ALL SELECT id, user_id, 1, 'NPM', 'pkg-' || (id % 7), 'w' || (id % 3) FROM inc)"""
REFS = """rf AS (SELECT id, user_id AS component, 0 AS pos, 'https://r.example/' || (id % 13) AS ref FROM inc UNION ALL SELECT id, user_id, 1, 'https://r.example/' || (id % 5) FROM inc)"""
IOCS = """io AS (SELECT id, user_id AS component, 0 AS pos, ioc_type AS type, ioc AS value, source, confidence FROM inc
  UNION ALL SELECT id, user_id, 1, 'url', (CASE id % 2 WHEN 0 THEN 'http://H' ELSE 'http://h' END) || (user_id % 50) || '.bad/' || (id % 3), source, confidence FROM inc
  UNION ALL SELECT id, user_id, 2, 'domain', (CASE id % 3 WHEN 0 THEN 'D' ELSE 'd' END) || (user_id % 20) || '.evil-' || (id % 4) || '.net', source, confidence FROM inc)"""
RICH = """rich AS (SELECT *, user_id AS component, package || repeat('x', CAST(id % 4 AS INT)) AS description, CASE id % 3 WHEN 0 THEN 'OSV-' || id ELSE '' END AS osv_id, CASE id % 4 WHEN 0 THEN 'GHSA-' || id ELSE '' END AS ghsa_id,
  value > 300 AS exploited, value % 2 < 1 AS public, id % 5 = 0 AS patched, 'V' || id AS vector, CASE id % 4 WHEN 0 THEN 'rce' || (id % 8) ELSE '' END AS exploit_type, CASE id % 6 WHEN 1 THEN 'https://patch/' || id ELSE '' END AS patch_url FROM inc)"""


def _of(d_or_rows: DataFrame, *parts: tuple) -> DataFrame:
    out = None
    for part in parts:
        rows = d_or_rows.select("id", F.col("user_id").alias("component"), *part)
        out = rows if out is None else out.unionByName(rows)
    return out


def packages_of(inc: DataFrame) -> DataFrame:
    return _of(inc, (F.lit(0).alias("pos"), "ecosystem", F.col("package").alias("name"), F.expr("concat('v', id % 5)").alias("version")), (F.lit(1).alias("pos"), F.lit("NPM").alias("ecosystem"), F.expr("concat('pkg-', id % 7)").alias("name"), F.expr("concat('w', id % 3)").alias("version")))


def references_of(inc: DataFrame) -> DataFrame:
    return _of(inc, (F.lit(0).alias("pos"), F.expr("concat('https://r.example/', id % 13)").alias("ref")), (F.lit(1).alias("pos"), F.expr("concat('https://r.example/', id % 5)").alias("ref")))


def indicators_of(inc: DataFrame) -> DataFrame:
    url = F.expr("concat(if(id % 2 = 0, 'http://H', 'http://h'), user_id % 50, '.bad/', id % 3)")
    domain = F.expr("concat(if(id % 3 = 0, 'D', 'd'), user_id % 20, '.evil-', id % 4, '.net')")
    return _of(inc, (F.lit(0).alias("pos"), F.col("ioc_type").alias("type"), F.col("ioc").alias("value"), "source", "confidence"), (F.lit(1).alias("pos"), F.lit("url").alias("type"), url.alias("value"), "source", "confidence"), (F.lit(2).alias("pos"), F.lit("domain").alias("type"), domain.alias("value"), "source", "confidence"))


def rich(spark, d) -> DataFrame:
    return incidents(spark, d).selectExpr(
        "*", "user_id as component", "concat(package, repeat('x', cast(id % 4 as int))) as description", "if(id % 3 = 0, concat('OSV-', id), '') as osv_id", "if(id % 4 = 0, concat('GHSA-', id), '') as ghsa_id",
        "value > 300 as exploited", "value % 2 < 1 as public", "id % 5 = 0 as patched", "concat('V', id) as vector", "if(id % 4 = 0, concat('rce', id % 8), '') as exploit_type", "if(id % 6 = 1, concat('https://patch/', id), '') as patch_url",
    )


# entity resolution

_KEYS = """keys AS (SELECT 'pkg:' || lower(ecosystem || '/' || name) AS key, id FROM pk UNION SELECT 'campaign:' || lower(campaign), id FROM inc WHERE campaign <> '' UNION SELECT 'cve:' || lower(cve), id FROM inc UNION SELECT 'ioc:' || lower(value), id FROM io WHERE value IS NOT NULL)"""


@query(f"WITH {INC}, {PKGS}, {IOCS}, {_KEYS} SELECT key, count(*) AS n, min(id) AS first_id FROM keys GROUP BY 1")
def merge_keys(spark, d):
    inc = incidents(spark, d)
    return entities.merge_keys(inc, packages_of(inc), indicators_of(inc)).groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


_EVENTS = """ev AS (SELECT event_id AS id, ts AS start_ts, CASE event_id % 3 WHEN 0 THEN 'wiz' WHEN 1 THEN 'socket' ELSE 'osv' END AS source, CASE event_id % 5 WHEN 0 THEN 'Camp ' || (event_id // 72) ELSE '' END AS campaign FROM events),
 epk AS (SELECT id, 'p' || (id // 4) AS name FROM ev), eio AS (SELECT id, 'a' || (id // 6) AS value FROM ev UNION SELECT id, 'b' || (id // 12) FROM ev UNION SELECT id, 'c' || (id // 18) FROM ev),
 trusted AS (SELECT *, source IN ('wiz', 'socket') AS ok FROM ev)"""
_EVENT_EDGES = """ee AS (SELECT a.id AS src, b.id AS dst FROM epk a JOIN epk b ON a.name = b.name AND a.id < b.id UNION SELECT a.id, b.id FROM ev a JOIN ev b ON a.campaign = b.campaign AND a.campaign <> '' AND a.id < b.id
 UNION SELECT a.id, b.id FROM eio x JOIN eio y ON x.value = y.value AND x.id < y.id JOIN trusted a ON a.id = x.id JOIN trusted b ON b.id = y.id WHERE abs(epoch_us(a.start_ts) - epoch_us(b.start_ts)) <= 7 * 86400000000
 GROUP BY 1, 2 HAVING count(*) >= CASE WHEN bool_and(a.ok AND b.ok) THEN 1 ELSE 2 END)"""


@query(f"""WITH RECURSIVE {_EVENTS}, {_EVENT_EDGES}, two AS (SELECT src, dst FROM ee UNION ALL SELECT dst, src FROM ee), walk AS (SELECT src AS a, dst AS b FROM two UNION SELECT walk.a, two.dst FROM walk JOIN two ON walk.b = two.src)
SELECT id, least(id, coalesce(min(b), id)) AS component FROM ev LEFT JOIN walk ON id = a GROUP BY id""")
def event_components(spark, d):
    ev = incidents(spark, d).selectExpr("id", "start_ts", "element_at(array('wiz', 'socket', 'osv'), cast(id % 3 + 1 as int)) as source", "if(id % 5 = 0, concat('Camp ', id div 72), '') as campaign")
    packages = ev.selectExpr("id", "'npm' as ecosystem", "concat('p', id div 4) as name")
    values = ev.selectExpr("id", "start_ts", "source", "'domain' as type", "explode(array(concat('a', id div 6), concat('b', id div 12), concat('c', id div 18))) as value")
    return resolve.components(ev, entities.event_edges(ev, packages, values))


_SOURCES = "(SELECT component, string_agg(source, ',' ORDER BY nth) AS sources, count(*) AS ns, max(c) AS best FROM (SELECT component, source, min(id) AS nth, max(confidence) AS c FROM rich GROUP BY 1, 2) GROUP BY 1)"
_FIELDS = f"""SELECT component, base_id, members, severity, description, osv_id, ghsa_id, campaign, sources, round(least(best + least(0.08 * (ns - 1), 0.2), 0.98), 6) AS confidence FROM (
 SELECT component, min(id) AS base_id, count(*) AS members, CASE max(CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity,
 arg_max(description, strlen(description) * 100000000 - id) AS description, coalesce(arg_min(osv_id, id) FILTER (osv_id <> ''), '') AS osv_id, coalesce(arg_min(ghsa_id, id) FILTER (ghsa_id <> ''), '') AS ghsa_id, coalesce(arg_min(campaign, id) FILTER (campaign <> ''), '') AS campaign FROM rich GROUP BY 1) JOIN {_SOURCES} USING (component)"""


@query(f"WITH {INC}, {RICH} {_FIELDS}")
def survivor_fields(spark, d):
    return entities.fields(rich(spark, d))


@query(f"WITH {INC}, {RICH} SELECT * FROM ({_FIELDS}) ORDER BY CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC, base_id LIMIT 1")
def best_of_groups(spark, d):
    return entities.best_of_groups(entities.fields(rich(spark, d)))


@query(f"WITH {INC}, {REFS}, x AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY id, pos) AS nth FROM rf) SELECT component, ref, min(nth) AS nth FROM x WHERE nth <= 20 GROUP BY 1, 2")
def survivor_references(spark, d):
    return entities.references(references_of(incidents(spark, d)))


@query(f"WITH {INC}, {PKGS}, x AS (SELECT *, row_number() OVER (PARTITION BY component, lower(ecosystem || '|' || name) ORDER BY id, pos) AS n FROM pk) SELECT component, ecosystem, name, version AS versions FROM x WHERE n = 1")
def survivor_packages(spark, d):
    return entities.packages(packages_of(incidents(spark, d)))


@query(f"""WITH {INC}, {IOCS}, k AS (SELECT *, CASE type WHEN 'ip' THEN value ELSE lower(value) END AS key FROM io WHERE value IS NOT NULL), s AS (SELECT component, type, key, source, min(id * 10 + pos) AS nth, max(confidence) AS c FROM k GROUP BY ALL),
 u AS (SELECT component, type, key, string_agg(source, ',' ORDER BY nth) AS sources, count(*) AS ns, max(c) AS best FROM s GROUP BY ALL), f AS (SELECT component, type, key, arg_min(value, id * 10 + pos) AS value, arg_min(confidence, id * 10 + pos) AS own, count(*) AS n FROM k GROUP BY ALL)
SELECT component, type, value, n, sources, round(CASE WHEN n > 1 THEN least(best + least(0.08 * (ns - 1), 0.2), 0.98) ELSE own END, 6) AS confidence FROM f JOIN u USING (component, type, key)""")
def survivor_indicators(spark, d):
    return entities.indicators(indicators_of(incidents(spark, d)))


@query(f"""WITH {INC}, {RICH} SELECT component, arg_min(cve, id) AS cve, bool_or(exploited) AS exploited, bool_or(public) AS public, bool_or(patched) AS patched, round(max(cvss), 6) AS cvss, arg_min(vector, id) FILTER (cvss = top) AS vector,
 coalesce(arg_min(exploit_type, id) FILTER (exploit_type <> ''), '') AS exploit_type, coalesce(arg_min(patch_url, id) FILTER (patch_url <> ''), '') AS patch_url FROM (SELECT *, max(cvss) OVER (PARTITION BY component) AS top FROM rich WHERE module = 'cve') GROUP BY 1""")
def survivor_cve(spark, d):
    return entities.cve_extension(rich(spark, d).filter("module = 'cve'"))
