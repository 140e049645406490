"""Queries of gates, text functions, feeds, attribution, ids, enrichment and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from ..functions import gates as G
from ..functions import words as W
from ..operators import actors, enrich, feeds, ids, repair
from .catalogue import _HOST_SQL, _listed, query
from .records import IOCS, PKGS, RICH, indicators_of, packages_of, rich
from .views import INC, NOW, PKG, incidents, now, packages, table



def _double(sql: str, column: str = "confidence") -> str:
    """The SQL with a column of decimal literals as doubles."""
    return f"SELECT * REPLACE (CAST({column} AS DOUBLE) AS {column}) FROM ({sql})"


# gates

_VALUES = f"""v AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'domain' WHEN 1 THEN 'ip' WHEN 2 THEN 'url' ELSE 'sha256' END AS type, CASE page_id % 8 WHEN 0 THEN replace({_HOST_SQL}, 'example.', 'ex-') || '.net' WHEN 1 THEN '203.0.113.' || (page_id % 300) WHEN 2 THEN url WHEN 3 THEN 'abc'
 WHEN 4 THEN 'Upper' || page_id || '.com' WHEN 5 THEN '10.0.0.' || (page_id % 9) WHEN 6 THEN 'http://10.1.2.' || (page_id % 9) || '/x' ELSE 'def' END AS value FROM pages)"""
_BAD_DOMAIN = f"""(NOT contains(x, '.') OR regexp_extract(lower(x), '[^.]*$', 0) IN ({_listed(K.RESERVED_TLDS + K.FILE_EXTENSIONS)}) OR lower(x) IN ({_listed(K.BENIGN_DOMAINS)}) OR regexp_matches(lower(x), '[.]({'|'.join(s.replace('.', '[.]') for s in K.BENIGN_SUFFIXES)})$'))"""
_BAD_IP = f"(x IN ({_listed(K.RESOLVERS)}) OR x LIKE '10.%' OR x LIKE '127.%' OR x LIKE '192.168.%' OR x LIKE '169.254.%')"
_V4 = r"'^(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])([.](25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$'"
_VALID = f"""CASE type WHEN 'domain' THEN value = lower(value) AND NOT regexp_matches(value, {_V4}) AND contains(value, '.') AND NOT regexp_matches(value, '[ \\t:/\\\\@,;=]') AND regexp_matches(value, '[.][a-z]{{2,24}}$') AND NOT {_BAD_DOMAIN.replace('(x', '(value').replace(' x ', ' value ')}
 WHEN 'ip' THEN regexp_matches(value, {_V4}) AND NOT {_BAD_IP.replace('x ', 'value ')} WHEN 'url' THEN host = '' OR NOT ({_BAD_DOMAIN.replace('(x', '(host').replace(' x ', ' host ')} OR {_BAD_IP.replace('x ', 'host ')}) ELSE true END"""


def _values(spark, d):
    host = F.concat(F.replace(E.url_host(F.col("url")), F.lit("example."), F.lit("ex-")), F.lit(".net"))
    text = F.expr("case page_id % 8 when 1 then concat('203.0.113.', page_id % 300) when 2 then url when 3 then 'abc' when 4 then concat('Upper', page_id, '.com') when 5 then concat('10.0.0.', page_id % 9) when 6 then concat('http://10.1.2.', page_id % 9, '/x') else 'def' end")
    return table(spark, d, "pages").select("page_id", F.expr("element_at(array('domain', 'ip', 'url', 'sha256'), cast(page_id % 4 + 1 as int))").alias("type"), F.when(F.col("page_id") % 8 == 0, host).otherwise(text).alias("value"))


@query(f"WITH {_VALUES}, h AS (SELECT *, {_HOST_SQL.replace('(url', '(value')} AS host FROM v) SELECT page_id, type, value, {_VALID} AS valid FROM h")
def feed_validity(spark, d):
    return _values(spark, d).withColumn("valid", G.feed_entry(F.col("type"), F.col("value")))


@query(f"""WITH {INC} SELECT id FROM inc WHERE module IN ('cve', 'malware') AND (module <> 'cve' OR value > 400 OR id % 11 = 0 OR cvss >= 9 OR campaign <> '')""")
def cve_quality(spark, d):
    rows = incidents(spark, d).filter("module in ('cve', 'malware')")
    return rows.filter(G.cve_quality(F.col("module") == "cve", F.col("value") > 400, F.col("id") % 11 == 0, F.col("cvss"), (F.col("campaign") != "").cast("int"))).select("id")


@query(f"""WITH {INC} SELECT id FROM inc WHERE severity IN ('high', 'critical') AND package IN ('Pkg-1', 'Pkg-2', 'Pkg-3', 'Pkg-5', 'Pkg-8') AND (id % 3 = 0 OR coalesce(value > 450, false))""")
def os_package_gate(spark, d):
    images = spark.createDataFrame([(f"Pkg-{n}",) for n in (1, 2, 3, 5, 8)], "package string").withColumn("in_images", F.lit(True))
    rows = incidents(spark, d).join(images, "package", "left")
    return rows.filter(G.os_package(F.col("severity"), F.coalesce("in_images", F.lit(False)), F.col("id") % 3 == 0, F.col("value") > 450)).select("id")


@query(f"""WITH {INC}, t AS (SELECT id, CASE WHEN id % 97 = 0 THEN 2 WHEN user_id % 2 = 1 THEN 0 WHEN value > 480 THEN 1 WHEN cvss >= 9 THEN 2 WHEN cvss >= 7 AND id % 3 = 0 THEN 3 ELSE 0 END AS tier FROM inc WHERE module = 'container') SELECT id, tier FROM t WHERE tier > 0""")
def container_tiers(spark, d):
    rows = incidents(spark, d).filter("module = 'container'")
    return rows.select("id", G.container_tier(F.col("user_id") % 2 == 0, F.col("value") > 480, F.col("cvss"), F.col("id") % 3 == 0, F.col("id") % 97 == 0).alias("tier")).filter("tier > 0")


@query(f"""WITH {INC}, {IOCS}, c AS (SELECT id, count(*) FILTER (type = 'domain') AS domains, count(*) FILTER (type = 'ip') AS ips, count(*) FILTER (type NOT IN ('domain', 'ip', 'url')) AS hashes FROM (SELECT component AS id, type, value FROM io WHERE value IS NOT NULL) GROUP BY 1)
SELECT id, CASE WHEN domains > 100 OR ips > 100 OR hashes > 300 OR domains + ips + hashes > 400 THEN 'drafts' ELSE 'clean' END AS goes_to FROM c""")
def circuit_breaker_split(spark, d):
    kinds = indicators_of(incidents(spark, d)).filter("value is not null").groupBy(F.col("component").alias("id")).agg(F.count_if(F.col("type") == "domain").alias("domains"), F.count_if(F.col("type") == "ip").alias("ips"), F.count_if(~F.col("type").isin("domain", "ip", "url")).alias("hashes"))
    return kinds.select("id", F.when(G.anomalous(F.col("domains"), F.col("ips"), F.col("hashes")), "drafts").otherwise("clean").alias("goes_to"))


@query(f"""WITH {INC}, x AS (SELECT id, CASE WHEN id % 4 = 0 THEN [] ELSE [confidence - 0.4, value / 1000] END AS c, CASE id % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'low' ELSE 'odd' END AS level FROM inc)
SELECT id, round(CASE WHEN coalesce(list_max(c), 0) > 0 THEN list_max(c) WHEN level = 'High' THEN 0.9 WHEN level = 'low' THEN 0.4 ELSE 0 END, 6) AS best, coalesce(list_max(c) >= 0.6, false) AS sure FROM x""")
def confidence_gate(spark, d):
    c = F.when(F.col("id") % 4 == 0, F.array().cast("array<double>")).otherwise(F.array(F.col("confidence") - 0.4, F.col("value") / 1000))
    level = F.expr("element_at(array('High', 'low', 'odd'), cast(id % 3 + 1 as int))")
    return incidents(spark, d).select("id", F.round(G.best_confidence(c, level), 6).alias("best"), G.sure_indicator(c).alias("sure"))


@query(f"""WITH {INC} SELECT id, module, id % 3 > 0 OR id % 5 > 2 AS signal, ecosystem = 'npm' AND id % 7 = 0 AS own_rules, coalesce(id % 6 <> 4, true) AS searchable, source NOT IN ('osv') AS backfill FROM inc""")
def record_gates(spark, d):
    ecosystems = F.when((F.col("ecosystem") == "npm") & (F.col("id") % 7 == 0), F.array(F.lit("npm"), F.lit("huggingface"))).otherwise(F.array("ecosystem"))
    return incidents(spark, d).select("id", "module", G.draft_signal(F.col("id") % 3, F.greatest(F.col("id") % 5 - 2, F.lit(0))).alias("signal"), G.has_own_rules(ecosystems).alias("own_rules"), G.searchable(F.col("id") % 6).alias("searchable"), G.in_backfill(F.when(F.col("source") == "osv", "maven").otherwise(F.col("source"))).alias("backfill"))


@query(f"""WITH {INC}, c AS (SELECT id, start_ts FROM inc WHERE severity IN ('critical', 'high') OR (module = 'supply' AND severity = 'medium') OR campaign <> '' OR epoch_us(start_ts) // 1000000 > epoch_us(TIMESTAMP '{NOW}') // 1000000 - 20 * 86400) SELECT id FROM c ORDER BY start_ts DESC NULLS LAST, id LIMIT 500""")
def rule_eligible(spark, d):
    from ..operators import index

    return index.curated(incidents(spark, d), now(), 20).orderBy(F.desc_nulls_last("start_ts"), "id").limit(500).select("id")


# text functions


@query(r"""SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS tag, regexp_replace(substr(regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40), '-+$', '') AS title,
 regexp_replace(lower(url), '[^a-z0-9-]', '-', 'g') AS plain, regexp_replace(regexp_replace(regexp_replace(lower(url), '[^a-z0-9-]', '-', 'g'), '-{2,}', '-', 'g'), '^-+|-+$', '', 'g') AS id, regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g') AS file,
 CASE WHEN length(url) > 30 THEN substr(url, 1, 30) || '...' ELSE url END AS cut, replace(url || '''s', '''', '''''') AS quoted FROM pages""")
def slug_variants(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", W.tag_slug(u).alias("tag"), W.title_slug(u).alias("title"), W.plain_slug(u).alias("plain"), W.id_slug(u).alias("id"), W.file_name(u).alias("file"), W.truncate(u, 30, "...").alias("cut"), W.yaml_quoted(F.concat(u, F.lit("'s"))).alias("quoted"))


_SLUG40 = "regexp_replace(substr(regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 40), '-+$', '')"


@query(f"""WITH x AS (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN '!!' ELSE 'New Attack: ' || substr(url, 8, 60) END AS t FROM pages)
SELECT page_id, 'talos-' || CASE WHEN {_SLUG40} <> '' THEN {_SLUG40} || '-' ELSE '' END || substr(sha256(url), 1, 8) AS post_id, substr('cve-draft-talos-' || regexp_replace(regexp_replace(regexp_replace(lower(t), '[^a-z0-9-]', '-', 'g'), '-{{2,}}', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS draft_id,
 CASE WHEN page_id % 3 = 0 THEN t ELSE url END AS description FROM x""")
def post_ids(spark, d):
    t = F.when(F.col("page_id") % 5 == 0, "!!").otherwise(F.concat(F.lit("New Attack: "), F.substring("url", 8, 60)))
    about = F.when(F.col("page_id") % 3 == 0, F.when(F.col("page_id") % 2 == 0, "").otherwise(F.repeat("url", 30))).otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", W.post_id(F.lit("talos"), F.col("url"), t).alias("post_id"), W.draft_id(F.lit("cve"), F.lit("Talos"), t).alias("draft_id"), W.draft_description(t, about).alias("description"))


def _any_sql(words, text="lower(text)"):
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


@query(f"""SELECT doc_id, {_any_sql(W.SUPPLY_WORDS)} AS relevant, string_agg(e, ',' ORDER BY e) AS ecosystems FROM (SELECT doc_id, text || CASE doc_id % 9 WHEN 0 THEN ' NPM' WHEN 1 THEN ' Pom.XML and go get' ELSE '' END AS text FROM documents)
 LEFT JOIN (VALUES {', '.join(f"('{e}')" for e in W.ECOSYSTEM_WORDS)}) w(e) ON CASE e {' '.join(f"WHEN '{e}' THEN {_any_sql(ws)}" for e, ws in W.ECOSYSTEM_WORDS.items())} END GROUP BY 1, 2""")
def post_relevance(spark, d):
    text = F.concat("text", F.expr("case doc_id % 9 when 0 then ' NPM' when 1 then ' Pom.XML and go get' else '' end"))
    found = F.array_compact(F.array(*(F.when(W.any_of(text, words), e) for e, words in sorted(W.ECOSYSTEM_WORDS.items()))))
    return table(spark, d, "documents").select("doc_id", W.any_of(text, W.SUPPLY_WORDS).alias("relevant"), F.when(F.size(found) > 0, F.array_join(found, ",")).alias("ecosystems"))


_REFS = "['https://nvd.nist.gov/' || id, 'https://github.com/advisories/' || id, 'https://x.example/' || id, 'https://socket.dev/' || (id % 7), 'https://github.com/a/' || id, 'https://y.example/a', 'https://y.example/b', 'https://osv.dev/' || id, 'https://z/1', 'https://z/2', 'https://z/3', 'https://z/4', 'https://z/5', 'https://z/6', 'https://wiz.io/' || id, 'https://z/7', 'https://z/8']"
_TIER = "CASE WHEN contains(r, 'cisa.gov') OR contains(r, 'nvd.nist.gov') OR contains(r, 'osv.dev') THEN 0 WHEN contains(r, 'socket.dev') OR contains(r, 'wiz.io') THEN 1 WHEN contains(r, 'github.com/advisories') THEN 2 WHEN contains(r, 'github.com') THEN 3 ELSE 4 END"


@query(f"""WITH {INC}, x AS (SELECT id, unnest({_REFS}[1:CASE WHEN id % 2 = 0 THEN 17 ELSE 5 END]) AS r, unnest(range(1, CASE WHEN id % 2 = 0 THEN 18 ELSE 6 END)) AS n FROM inc WHERE module = 'malware'), y AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {_TIER}, n) AS nth, count(*) OVER (PARTITION BY id) AS many FROM x)
SELECT id, string_agg(r, ' ' ORDER BY CASE WHEN many > 15 THEN nth ELSE n END) AS refs FROM y WHERE nth <= 15 GROUP BY 1""")
def reference_ranking(spark, d):
    refs = F.expr("slice(array(concat('https://nvd.nist.gov/', id), concat('https://github.com/advisories/', id), concat('https://x.example/', id), concat('https://socket.dev/', id % 7), concat('https://github.com/a/', id), 'https://y.example/a', 'https://y.example/b', concat('https://osv.dev/', id), 'https://z/1', 'https://z/2', 'https://z/3', 'https://z/4', 'https://z/5', 'https://z/6', concat('https://wiz.io/', id), 'https://z/7', 'https://z/8'), 1, if(id % 2 = 0, 17, 5))")
    return incidents(spark, d).filter("module = 'malware'").select("id", F.array_join(W.best_references(refs), " ").alias("refs"))


@query(f"""WITH {INC}, x AS (SELECT id, CASE id % 3 WHEN 0 THEN 'Lazarus' ELSE '' END AS actor, campaign, CASE id % 4 WHEN 0 THEN 'short' WHEN 1 THEN 'Incident: something long' ELSE 'A  description' || chr(10) || 'of ' || package END AS d, strftime(start_ts, '%Y-%m-%dT%H:%M:%SZ') AS s, source, CASE id % 5 WHEN 0 THEN 0.0 ELSE 0.75 END AS c FROM inc)
SELECT id, concat_ws(chr(10) || '  ', CASE WHEN actor <> '' AND campaign <> '' THEN 'Associated with ' || actor || ' (' || campaign || ' campaign).' WHEN actor <> '' THEN 'Associated with ' || actor || '.' WHEN campaign <> '' THEN 'Associated with ' || campaign || ' campaign.' END,
 CASE WHEN id % 4 > 1 THEN regexp_replace(d, '\\s+', ' ', 'g') END, 'First observed: ' || substr(s, 1, 10) || '.', CASE WHEN c > 0 THEN 'Confidence: 75% (' || source || ').' END) AS text FROM x""")
def rule_descriptions(spark, d):
    actor = F.when(F.col("id") % 3 == 0, "Lazarus").otherwise("")
    about = F.expr("case id % 4 when 0 then 'short' when 1 then 'Incident: something long' else concat('A  description\n', 'of ', package) end")
    start = F.concat(F.date_format("start_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return incidents(spark, d).select("id", W.rich_description(actor, F.col("campaign"), about, start, F.array("source"), F.when(F.col("id") % 5 == 0, 0.0).otherwise(0.75)).alias("text"))


_CODE = """(CASE page_id % 4 WHEN 0 THEN '''uri'' => ''/cgi-bin/' || page_id || '.cgi?x=1'', ''data'' => "cmd=whoami' || page_id || '"' WHEN 1 THEN 'open("/etc/passwd"); get("/admin/login' || page_id || '"); get("/admin/login' || page_id || '")' WHEN 2 THEN '''User-Agent'' => ''Evil Agent ' || page_id || '''; x ?shell=calc.exe&y' ELSE 'nothing here' END)"""


@query(_double(f"""WITH x AS (SELECT page_id, {_CODE} AS code FROM pages) SELECT page_id, t.type, t.value, t.confidence FROM x, (SELECT unnest(CASE page_id % 4
 WHEN 0 THEN [{{'type': 'url_pattern', 'value': '/cgi-bin/' || page_id || '.cgi?x=1', 'confidence': 0.8}}, {{'type': 'request_body_pattern', 'value': 'cmd=whoami' || page_id, 'confidence': 0.7}}]
 WHEN 1 THEN [{{'type': 'url_pattern', 'value': '/admin/login' || page_id, 'confidence': 0.6}}] WHEN 2 THEN [{{'type': 'user_agent', 'value': 'Evil Agent ' || page_id, 'confidence': 0.8}}, {{'type': 'request_body_pattern', 'value': 'shell=calc.exe', 'confidence': 0.5}}] ELSE [] END) AS t)"""))
def code_indicators(spark, d):
    code = F.expr("""case page_id % 4 when 0 then concat("'uri' => '/cgi-bin/", page_id, ".cgi?x=1', 'data' => \\"cmd=whoami", page_id, '"') when 1 then concat('open("/etc/passwd"); get("/admin/login', page_id, '"); get("/admin/login', page_id, '")') when 2 then concat("'User-Agent' => 'Evil Agent ", page_id, "'; x ?shell=calc.exe&y") else 'nothing here' end""")
    return table(spark, d, "pages").select("page_id", F.explode(W.code_indicators(code)).alias("t")).select("page_id", "t.type", "t.value", F.col("t.confidence").cast("double").alias("confidence"))


@query(f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'ip' WHEN 1 THEN 'domain' WHEN 2 THEN NULL ELSE 'url' END AS type, CASE page_id % 4 WHEN 0 THEN '203.0.113.' || (page_id % 200) WHEN 1 THEN 'evil' || page_id || '.bad' WHEN 2 THEN NULL ELSE 'http://evil' || page_id || '.bad/x' END AS value,
 'https://raw.githubusercontent.com/a/b/main/' || page_id AS raw, 'http://h' || page_id AS fixed, 'https://attack.mitre.org/techniques/T1195/00' || (page_id % 9) AS technique, CASE page_id % 3 WHEN 0 THEN 57 ELSE 100 END AS stix, 'tool' AS name, CASE page_id % 2 WHEN 0 THEN '1.' || page_id ELSE '' END AS version FROM pages""")
def small_functions(spark, d):
    raw = F.expr("case page_id % 4 when 0 then concat('c2 at 203.0.113[.]', page_id % 200) when 1 then concat('evil', page_id, '[.]bad') when 2 then 'plain words' else concat('hxxp://evil', page_id, '[.]bad/x') end")
    kind = W.network_kind(raw)
    title = W.title_parts(F.concat(F.lit("tool"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" 1."), "page_id")).otherwise("")))
    return table(spark, d, "pages").select(
        "page_id", kind["type"].alias("type"), kind["value"].alias("value"), W.raw_address(F.concat(F.lit("https://github.com/a/b/blob/main/"), "page_id")).alias("raw"), W.one_slash(F.concat(F.lit("http:/h"), "page_id")).alias("fixed"),
        W.technique_address(F.concat(F.lit("T1195.00"), F.col("page_id") % 9)).alias("technique"), W.stix_confidence(F.when(F.col("page_id") % 3 == 0, 0.5799).otherwise(1.2)).alias("stix"), title["name"].alias("name"), title["version"].alias("version"),
    )


# feeds


@query(f"""WITH {INC}, {IOCS}, o AS (SELECT lower(value) AS value FROM io WHERE type = 'domain' AND id % 3 = 0 UNION ALL SELECT value FROM io WHERE type = 'domain' AND id % 3 <> 0)
SELECT DISTINCT value FROM o WHERE value IS NOT NULL AND value = lower(value) AND NOT contains(value, ':') AND regexp_matches(value, '[.][a-z]{{2,24}}$')""")
def feed_lines(spark, d):
    found = indicators_of(incidents(spark, d)).filter("type = 'domain'")
    return feeds.append_lines(found.filter("id % 3 = 0").select(F.lower("value").alias("value")), found.filter("id % 3 <> 0"), G.feed_domain)


@query(f"""WITH {INC}, {IOCS}, n AS (SELECT type, value, id % 50 AS incident_id, id FROM io WHERE value IS NOT NULL), old AS (SELECT type, value, incident_id, 'old' AS origin FROM n WHERE id % 4 = 0 AND (type = 'sha256' OR (type = 'url') OR (type = 'domain' AND value = lower(value) AND regexp_matches(value, '[.]net$')))), u AS (SELECT *, 0 AS at0 FROM old UNION ALL SELECT type, value, incident_id, 'new', 1 FROM n WHERE id % 4 <> 0)
SELECT type, value, incident_id, min_by(origin, at0) AS origin FROM u GROUP BY 1, 2, 3""")
def feed_unified(spark, d):
    found = indicators_of(incidents(spark, d)).filter("value is not null").select("type", "value", (F.col("id") % 50).alias("incident_id"), "id")
    return feeds.append_unified(found.filter("id % 4 = 0").select("type", "value", "incident_id", F.lit("old").alias("origin")), found.filter("id % 4 <> 0").select("type", "value", "incident_id", F.lit("new").alias("origin")))


@query(f"""WITH {INC}, t AS (SELECT id, 'repo-' || (user_id % 9) AS repository, unnest(['1.' || (id % 4), 'latest']) AS tag, confidence FROM inc WHERE module = 'container'), u AS (SELECT 0 AS at0, 'container_image' AS type, 'repo-1' AS repository, 'latest' AS tag, 9 AS tier, id AS incident_id, 0.5 AS confidence FROM inc WHERE module = 'container' AND id % 2 = 0
 UNION ALL SELECT 1, 'container_image', repository, tag, 2, id, confidence FROM t UNION ALL SELECT 2, 'container_image_eol', 'repo-' || (user_id % 9), '1.0', 2, id, NULL FROM inc WHERE module = 'container' AND id % 5 = 0)
SELECT repository, tag, incident_id, min_by(type, at0) AS type, CAST(min_by(tier, at0) AS INT) AS tier, round(arg_min_null(confidence, at0), 6) AS confidence FROM u GROUP BY 1, 2, 3""")
def image_feed(spark, d):
    inc = incidents(spark, d).filter("module = 'container'").withColumn("repository", F.expr("concat('repo-', user_id % 9)")).withColumn("incident_id", F.col("id")).withColumn("tier", F.lit(2))
    there = inc.filter("id % 2 = 0").select(F.lit("container_image").alias("type"), F.lit("repo-1").alias("repository"), F.lit("latest").alias("tag"), F.lit(9).alias("tier"), "incident_id", F.lit(0.5).alias("confidence"))
    images = inc.withColumn("tags", F.array(F.expr("concat('1.', id % 4)"), F.lit("latest")))
    return feeds.image_feed(there, images, inc.filter("id % 5 = 0").withColumn("cycle", F.lit("1.0"))).withColumn("confidence", F.round("confidence", 6))


@query(f"""WITH {INC}, {IOCS}, v AS (SELECT CASE WHEN type = 'domain' AND id % 10 = 0 THEN '203.0.113.' || (id % 200) ELSE value END AS value, type FROM io), k AS (SELECT CASE WHEN type = 'domain' AND regexp_matches(value, {_V4}) THEN 'ip' ELSE type END AS feed, value FROM v)
SELECT DISTINCT feed, value FROM k WHERE CASE feed WHEN 'ip' THEN regexp_matches(value, {_V4}) WHEN 'domain' THEN value = lower(value) AND NOT contains(value, ':') AND regexp_matches(value, '[.]net$') ELSE feed = 'sha256' AND value IS NOT NULL END""")
def feed_export(spark, d):
    found = indicators_of(incidents(spark, d))
    return feeds.export(found.withColumn("value", F.when((F.col("type") == "domain") & (F.col("id") % 10 == 0), F.expr("concat('203.0.113.', id % 200)")).otherwise(F.col("value"))))


# attribution

_ACTORS = (("lazarus", "Lazarus", ("onthtion", "erndtion")), ("fool", "Idiot", ("moron",)), ("article", "the", ("thion",)), ("geist", "unggeist", ("scum",)), ("camp-four", "Campaign 4", ("Campaign 8",)))
_AL = "al AS (SELECT lower(a) AS alias, slug FROM (VALUES " + ", ".join(f"('{s}', '{a}')" for s, n, x in _ACTORS for a in (n, *x)) + ") t(slug, a))"
_HIT = "CASE WHEN strlen(alias) >= 6 THEN contains(t, alias) ELSE regexp_matches(t, '\\b' || alias || '\\b') END"


def _profiles(spark):
    return spark.createDataFrame([(s, n, list(a)) for s, n, a in _ACTORS], "slug string, name string, aliases array<string>")


@query(f"WITH {_AL}, x AS (SELECT doc_id AS id, lower(text) AS t FROM documents) SELECT DISTINCT id, slug FROM x, al WHERE {_HIT}")
def actor_mentions(spark, d):
    return actors.text_matches(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), actors.alias_index(_profiles(spark)))


_LINKS = f"""{_AL}, tx AS (SELECT id, module, campaign, lower(id || ' ' || package || CASE id % 7 WHEN 0 THEN ' by Lazarus' WHEN 1 THEN ' a fool is a moron' ELSE '' END || ' https://r/' || CASE id % 11 WHEN 0 THEN 'scum' ELSE 'x' END) AS t FROM inc),
 lk AS (SELECT id, module, slug, max(e) AS e FROM (SELECT id, module, slug, 1 AS e FROM tx JOIN al ON lower(campaign) = alias UNION ALL SELECT id, module, slug, 0 FROM tx, al WHERE {_HIT}) GROUP BY 1, 2, 3)"""


def _linked(spark, d):
    text = F.concat("package", F.expr("case id % 7 when 0 then ' by Lazarus' when 1 then ' a fool is a moron' else '' end"))
    inc = incidents(spark, d).select("id", "module", "campaign", F.when(F.col("id") % 5 == 0, "Somebody").otherwise("").alias("actor"), F.lit("").alias("group"), text.alias("description"), F.concat(F.lit("https://r/"), F.when(F.col("id") % 11 == 0, "scum").otherwise("x")).alias("references"))
    return inc, actors.attribute(inc, actors.alias_index(_profiles(spark)))


@query(_double(f"WITH {INC}, {_LINKS} SELECT id, module, slug, CASE e WHEN 1 THEN 'explicit' ELSE 'inferred' END AS match, CASE e WHEN 1 THEN 0.9 ELSE 0.65 END AS confidence FROM lk"))
def actor_attribution(spark, d):
    return _linked(spark, d)[1]


@query(f"""WITH {INC}, {_LINKS}, g AS (SELECT id, arg_min(n, (CASE e WHEN 1 THEN 'a' ELSE 'b' END) || slug) AS n, string_agg(DISTINCT slug, ',' ORDER BY slug) AS s FROM lk JOIN (VALUES {', '.join(f"('{s}', '{n}')" for s, n, _ in _ACTORS)}) p(slug, n) USING (slug) GROUP BY 1)
SELECT inc.id, CASE WHEN inc.id % 5 = 0 THEN 'Somebody' ELSE coalesce(n, '') END AS actor, coalesce(s, '') AS actor_ids FROM inc LEFT JOIN g ON inc.id = g.id""")
def actor_fields(spark, d):
    inc, links = _linked(spark, d)
    return actors.with_actors(inc, links, _profiles(spark))


@query(f"""WITH {INC}, {IOCS}, {_LINKS} SELECT DISTINCT slug, CASE type WHEN 'sha256' THEN 'hash' ELSE type END AS kind, CASE type WHEN 'ip' THEN value ELSE lower(value) END AS value FROM lk JOIN io ON lk.id = io.id WHERE type <> 'url' AND value IS NOT NULL""")
def actor_indicators(spark, d):
    return actors.actor_indicators(_linked(spark, d)[1], indicators_of(incidents(spark, d)))


@query(_double(f"""WITH {INC}, a AS (SELECT id, module, campaign AS actor, CASE id % 4 WHEN 0 THEN 0.9 WHEN 1 THEN 0.7 WHEN 2 THEN 0.4 ELSE 0.6 END AS c FROM inc WHERE campaign <> ''), h AS (SELECT actor, min(id) AS src_id, arg_min(c, id) AS c0 FROM a GROUP BY 1 HAVING count(DISTINCT module) > 1)
SELECT actor, src_id, id AS dst_id, greatest(c, c0) AS confidence FROM a JOIN h USING (actor) WHERE id <> src_id"""))
def actor_links(spark, d):
    return enrich.actor_links(incidents(spark, d).select("id", "module", F.col("campaign").alias("actor"), F.expr("element_at(array('high', 'Medium', 'low', ''), cast(id % 4 + 1 as int))").alias("level")))


# ids


@query(f"""WITH {INC}, r AS (SELECT module, year(start_ts) AS year, 'S' || lpad(CAST(id AS VARCHAR), 8, '0') AS source_id, id FROM inc), old AS (SELECT module, year, source_id, 9990 + row_number() OVER (PARTITION BY module, year ORDER BY id) AS seq FROM r WHERE id % 10 = 0),
 l AS (SELECT module, year, max(seq) AS last FROM old GROUP BY 1, 2), n AS (SELECT module, year, source_id, row_number() OVER (PARTITION BY module, year ORDER BY source_id) AS k FROM r WHERE id % 10 <> 0), every AS (SELECT module, year, source_id, coalesce(last, 0) + k AS seq FROM n LEFT JOIN l USING (module, year) UNION ALL SELECT * FROM old)
SELECT module, year, source_id, seq, 'lw-' || module || '-' || year || '-' || CASE WHEN seq < 1000 THEN lpad(CAST(seq AS VARCHAR), 4, '0') ELSE CAST(seq AS VARCHAR) END AS public_id FROM every""")
def registry_ids(spark, d):
    from pyspark.sql import Window

    rows = incidents(spark, d).select("module", F.year("start_ts").alias("year"), F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("source_id"), "id")
    old = rows.filter("id % 10 = 0").withColumn("seq", 9990 + F.row_number().over(Window.partitionBy("module", "year").orderBy("id"))).drop("id")
    return ids.assign(rows.drop("id"), old)


@query(f"""WITH {INC}, r AS (SELECT module, year(start_ts) AS year, id AS source_id, id * 2 AS seq FROM inc WHERE id % 3 <> 0), m AS (SELECT module, year(start_ts) AS year, id AS source_id, id * 3 AS seq FROM inc WHERE id % 2 = 0), u AS (SELECT *, 1 AS at0 FROM r UNION ALL SELECT *, 0 FROM m), x AS (SELECT module, year, source_id, arg_min(seq, at0) AS seq FROM u GROUP BY 1, 2, 3)
SELECT module, year, max(seq) AS counter, count(*) AS n FROM x GROUP BY 1, 2""")
def registry_merge(spark, d):
    rows = incidents(spark, d).select("module", F.year("start_ts").alias("year"), F.col("id").alias("source_id"))
    merged = ids.merge_registries(rows.filter("source_id % 3 <> 0").withColumn("seq", F.col("source_id") * 2), rows.filter("source_id % 2 = 0").withColumn("seq", F.col("source_id") * 3))
    return ids.counters(merged).join(merged.groupBy("module", "year").agg(F.count("*").alias("n")), ["module", "year"])


@query(f"WITH {INC} SELECT id, CASE WHEN user_id % 3 = 0 THEN 'lw-' || user_id ELSE 'u' || user_id END AS ref FROM inc")
def id_rewrite(spark, d):
    rows = incidents(spark, d).select("id", F.concat(F.lit("u"), "user_id").alias("ref"), "user_id")
    mapping = rows.filter("user_id % 3 = 0").select(F.col("ref").alias("old"), F.concat(F.lit("lw-"), "user_id").alias("new")).distinct()
    return ids.rewrite(rows.drop("user_id"), "ref", mapping)


# enrichment


@query(f"WITH {INC} SELECT id, CASE WHEN id % 5 = 0 THEN 'curated' ELSE 'bulk' END AS origin FROM inc WHERE id % 5 = 0 OR id % 3 = 0")
def curated_first(spark, d):
    rows = incidents(spark, d).select("id")
    return enrich.curated_first(rows.filter("id % 5 = 0").withColumn("origin", F.lit("curated")), rows.filter("id % 5 = 0 or id % 3 = 0").withColumn("origin", F.lit("bulk")))


@query(f"WITH {INC} SELECT 'rule-' || id AS file, id AS incident_id FROM inc WHERE id % 7 = 0")
def stale_rules(spark, d):
    rows = incidents(spark, d).select("id")
    return enrich.stale_rules(rows.select(F.concat(F.lit("rule-"), "id").alias("file"), F.col("id").alias("incident_id")), rows.filter("id % 7 <> 0"))


@query(f"WITH {INC} SELECT 'lw-cve-2024-' || id || '-ioc-' || module || '.yaml' AS file, 'lw-cve-2024-' || id AS id FROM inc WHERE id % 2 = 0")
def rule_files_to_incidents(spark, d):
    rows = incidents(spark, d)
    return enrich.rules_to_incidents(rows.select(F.concat(F.lit("lw-cve-2024-"), "id", F.lit("-ioc-"), "module", F.lit(".yaml")).alias("file")), rows.filter("id % 2 = 0").select(F.concat(F.lit("lw-cve-2024-"), "id").alias("id")).unionByName(rows.select(F.lit("lw-cve").alias("id"))))


_CACHE = f"""ca AS (SELECT DISTINCT type, value, 'i' || strlen(value) AS info, TIMESTAMP '{NOW}' - INTERVAL 1 DAY * (strlen(value) % 3 * 10 + 1) AS fetched FROM io WHERE type IN ('ip', 'domain') AND value IS NOT NULL AND strlen(value) % 2 = 1)"""


def _cache(found):
    some = found.filter("type in ('ip', 'domain') and value is not null and length(value) % 2 = 1").select("type", "value").distinct()
    return some.withColumn("info", F.concat(F.lit("i"), F.length("value"))).withColumn("fetched", F.expr(f"timestamp_ntz '{NOW}' - make_interval(0, 0, 0, length(value) % 3 * 10 + 1)")).withColumn("related", F.when(F.col("type") == "domain", F.array(F.concat(F.lit("www."), "value"), F.lit("d1.evil-1.net"))))


@query(f"WITH {INC}, {IOCS}, {_CACHE} SELECT DISTINCT type, value FROM io WHERE type IN ('ip', 'domain') AND value IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ca WHERE ca.type = io.type AND ca.value = io.value AND fetched > TIMESTAMP '{NOW}' - INTERVAL 7 DAY)")
def indicators_to_look_up(spark, d):
    found = indicators_of(incidents(spark, d))
    return enrich.to_look_up(found, _cache(found), now(), 7)


@query(f"""WITH {INC}, {IOCS}, {_CACHE}, j AS (SELECT io.*, info FROM io LEFT JOIN ca ON io.type = ca.type AND io.value = ca.value), r AS (SELECT DISTINCT id, type, unnest(['www.' || value, 'd1.evil-1.net']) AS value FROM j WHERE type = 'domain' AND info IS NOT NULL)
SELECT id, type, value, source, confidence, info FROM j UNION ALL SELECT id, type, value, 'crt.sh', 0.55, NULL FROM r WHERE NOT EXISTS (SELECT 1 FROM io WHERE io.type = 'domain' AND io.id = r.id AND io.value = r.value)""")
def indicators_with_cache(spark, d):
    found = indicators_of(incidents(spark, d)).drop("component", "pos")
    return enrich.with_cache(found, _cache(found))


@query(f"""WITH {INC}, e AS (SELECT cve, CASE id % 3 WHEN 0 THEN 'webapps' WHEN 1 THEN 'local' ELSE 'dos' END AS kind, 'url_pattern' AS type, '/x' || (id % 5) AS value FROM inc WHERE module = 'malware') SELECT id, inc.cve, n AS traits FROM inc JOIN (SELECT cve, count(DISTINCT value) AS n FROM e WHERE kind = 'webapps' GROUP BY 1) t ON inc.cve = t.cve WHERE module = 'cve' AND id % 4 <> 0""")
def exploit_traits(spark, d):
    inc = incidents(spark, d)
    exploits = inc.filter("module = 'malware'").select(F.upper("cve").alias("cve"), F.expr("element_at(array('webapps', 'local', 'dos'), cast(id % 3 + 1 as int))").alias("kind"), F.lit("url_pattern").alias("type"), F.expr("concat('/x', id % 5)").alias("value"))
    return enrich.exploit_traits(inc.filter("module = 'cve'").select("id", "cve", (F.col("id") % 4 == 0).cast("int").alias("traits")), exploits)


_OS = """op AS (SELECT id, unnest([cve, 'cve-2024-' || (id % 300)]) AS cve FROM inc WHERE module = 'supply'), cn AS (SELECT id, cve FROM inc WHERE module = 'container'), pr AS (SELECT op.id AS a, cn.id AS b, min(op.cve) AS cve FROM op JOIN cn ON op.cve = cn.cve GROUP BY 1, 2)"""


def _os(spark, d):
    inc = incidents(spark, d)
    return inc, (inc.filter("module = 'supply'").select("id", F.explode(F.array("cve", F.expr("concat('cve-2024-', id % 300)"))).alias("cve")), inc.filter("module = 'container'").select("id", "cve"))


@query(_double(f"WITH {INC}, {_OS} SELECT a AS src_id, b AS dst_id, 'os-packages' AS src_module, cve, 0.9 AS confidence FROM pr UNION ALL SELECT b, a, 'container', cve, 0.9 FROM pr"))
def os_container_links(spark, d):
    return enrich.os_links(*_os(spark, d)[1])


@query(_double(f"WITH {INC}, {_OS} SELECT DISTINCT b AS id, package || '/' || 'v' || (inc.id % 5) AS value, 0.85 AS confidence FROM pr JOIN inc ON inc.id = a"))
def installed_packages(spark, d):
    inc, sides = _os(spark, d)
    return enrich.installed_packages(*sides, packages_of(inc).filter("pos = 0"))


@query(f"""WITH {PKG}, k AS (SELECT o_orderkey AS id, p_name AS name, p_type AS ecosystem FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey) SELECT id, count(*) AS packages, max(weekly) AS top, CAST(sum(weekly) AS BIGINT) AS total,
 CASE WHEN max(weekly) >= 1000000 THEN 'critical' WHEN max(weekly) >= 100000 THEN 'high' WHEN max(weekly) >= 10000 THEN 'medium' WHEN max(weekly) >= 1000 THEN 'low' ELSE 'negligible' END AS rating FROM k JOIN pkg USING (name, ecosystem) GROUP BY 1""")
def impact_summary(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("ecosystem"))
    return enrich.impact(table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("id"), "name", "ecosystem"), packages(spark, d))


# repair


@query(f"""WITH {INC}, x AS (SELECT id, CASE id % 10 WHEN 0 THEN '' ELSE 'malware' END AS attack_type, CASE WHEN value < 20 THEN '' ELSE package END AS description, id % 2 AS packages, id % 3 AS refs, id % 130 AS domains, id % 70 AS ips, id % 400 AS hashes FROM inc)
SELECT id, unnest(list_filter([CASE WHEN attack_type = '' THEN 'no attack_type' END, CASE WHEN description = '' THEN 'no description' END, CASE WHEN packages = 0 AND refs = 0 THEN 'no package, no reference' END, CASE WHEN domains > 100 THEN 'domains' WHEN ips > 100 THEN 'ips' WHEN hashes > 300 THEN 'hashes' WHEN domains + ips + hashes > 400 THEN 'indicators' END], lambda p: p IS NOT NULL)) AS problem FROM x""")
def record_violations(spark, d):
    rows = incidents(spark, d).select("id", F.when(F.col("id") % 10 == 0, "").otherwise("malware").alias("attack_type"), "severity", F.when(F.col("value") < 20, "").otherwise(F.col("package")).alias("description"), (F.col("id") % 2).alias("packages"), (F.col("id") % 3).alias("refs"), (F.col("id") % 130).alias("domains"), (F.col("id") % 70).alias("ips"), (F.col("id") % 400).alias("hashes"))
    return repair.violations(rows)


_RAWS = "rw AS (SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN 'domain' WHEN 1 THEN 'ip' WHEN 2 THEN 'url' ELSE 'domain' END AS type, CASE event_id % 8 WHEN 0 THEN '203.0.113.' || (user_id % 200) || '.' WHEN 1 THEN '10.0.0.' || (user_id % 9) WHEN 2 THEN 'http://evil' || user_id || '.bad/x' WHEN 3 THEN 'evil' || user_id || '.bad.' WHEN 4 THEN 'evil' || user_id || '.bad' WHEN 5 THEN '198.51.100.' || (user_id % 200) WHEN 6 THEN 'ftp://e.bad' ELSE 'evil' || user_id || '.bad' END AS value FROM events)"


def _raws(spark, d):
    value = F.expr("case event_id % 8 when 0 then concat('203.0.113.', user_id % 200, '.') when 1 then concat('10.0.0.', user_id % 9) when 2 then concat('http://evil', user_id, '.bad/x') when 3 then concat('evil', user_id, '.bad.') when 4 then concat('evil', user_id, '.bad') when 5 then concat('198.51.100.', user_id % 200) when 6 then 'ftp://e.bad' else concat('evil', user_id, '.bad') end")
    return table(spark, d, "events").select(F.col("event_id").alias("id"), F.expr("element_at(array('domain', 'ip', 'url', 'domain'), cast(event_id % 4 + 1 as int))").alias("type"), value.alias("value"))


@query(f"WITH {_RAWS} SELECT id, CASE WHEN type = 'domain' AND regexp_matches(rtrim(value, '.'), '^[0-9]+([.][0-9]+){{3}}$') THEN 'ip' ELSE type END AS type, CASE WHEN type = 'url' THEN value ELSE rtrim(value, '.') END AS value FROM rw WHERE CASE WHEN type = 'url' THEN value LIKE 'http%' ELSE value NOT LIKE '10.%' END")
def migrate_indicators(spark, d):
    return repair.migrate_indicators(_raws(spark, d))


@query(f"WITH {_RAWS} SELECT type, count(*) FILTER (event8 IN (1, 6)) AS removed, count(*) FILTER (event8 = 9) AS changed FROM (SELECT *, id % 8 AS event8 FROM rw WHERE id % 8 NOT IN (0, 3)) GROUP BY 1")
def scrub_removals(spark, d):
    return repair.removals(repair.scrub(_raws(spark, d).filter("id % 8 not in (0, 3)")))


@query(f"WITH {INC} SELECT id FROM inc WHERE module <> 'cve' AND id % 3 = 0 AND (id % 8 = 1 OR id % 8 = 6)")
def empty_records(spark, d):
    records = incidents(spark, d).select("id", (F.col("module") == "cve").alias("has_extension"))
    return repair.empty_records(records, records.filter("id % 3 <> 0"), repair.scrub(_raws(spark, d))).select("id")


@query(f"""WITH {INC}, p AS (SELECT id, CASE id % 6 WHEN 0 THEN 'malware' WHEN 1 THEN 'two words' WHEN 2 THEN 'ends.' ELSE package END AS name, CASE id % 5 WHEN 0 THEN '' ELSE ecosystem END AS ecosystem FROM inc) SELECT id, name, ecosystem FROM p
 WHERE ecosystem <> '' AND NOT (regexp_matches(name, '\\s') OR regexp_matches(name, '[.,;!?]$') OR lower(name) IN ({_listed(K.NO_PACKAGES)}))""")
def migrate_packages(spark, d):
    rows = incidents(spark, d).select("id", F.expr("case id % 6 when 0 then 'malware' when 1 then 'two words' when 2 then 'ends.' else package end").alias("name"), F.when(F.col("id") % 5 == 0, "").otherwise(F.col("ecosystem")).alias("ecosystem"))
    return repair.migrate_packages(rows)


@query(f"""WITH {INC}, m AS (SELECT module, count(*) AS n, CAST(count(*) * CASE module WHEN 'cve' THEN 1.05 ELSE 1.001 END AS BIGINT) AS listed, CASE module WHEN 'container' THEN count(*) * 101 ELSE 5 END AS rules FROM inc GROUP BY 1 UNION ALL SELECT 'gone', 0, 0, 3)
SELECT module, unnest(list_filter([CASE WHEN n = 0 AND rules > 0 THEN 'orphan rules' END, CASE WHEN n > 0 AND listed > 0 AND abs(listed - n) * 100 > listed THEN 'drift' END, CASE WHEN module = 'malware' THEN 'no index' END, CASE WHEN module = 'supply' THEN 'no lookup' END, CASE WHEN n > 0 AND rules > 100 * n THEN 'too many rules' END], lambda p: p IS NOT NULL)) AS problem FROM m""")
def module_checks(spark, d):
    by = incidents(spark, d).groupBy("module").agg(F.count("*").alias("records"))
    by = by.select("module", "records", F.round(F.col("records") * F.when(F.col("module") == "cve", 1.05).otherwise(1.001)).cast("bigint").alias("listed"), F.when(F.col("module") == "container", F.col("records") * 101).otherwise(5).alias("rules")).unionByName(spark.sql("select 'gone' as module, 0L as records, 0L as listed, 3L as rules"))
    return repair.cross_checks(by.select("module", "records", "listed", (F.col("module") == "malware").alias("index_missing"), (F.col("module") == "supply").alias("lookup_missing"), "rules", F.lit(0).alias("feed")))


@query(f"""WITH {INC} SELECT 'violations' AS "check", count(*) AS n FROM inc WHERE id % 10 = 0 UNION ALL SELECT 'bad ids', count(*) FROM inc WHERE id % 4 = 0""")
def doctor_report(spark, d):
    rows = incidents(spark, d)
    records = rows.select("id", F.when(F.col("id") % 10 == 0, "").otherwise("x").alias("attack_type"), F.lit("low").alias("severity"), F.lit("d").alias("description"), F.lit(1).alias("packages"), F.lit(1).alias("refs"), *(F.lit(0).alias(c) for c in ("domains", "ips", "hashes")))
    rule = rows.select(F.when(F.col("id") % 4 == 0, F.lit("no-uuid")).otherwise(E.uuid5(F.col("id").cast("string"))).alias("rule_id"), F.lit("t").alias("title"), F.lit("test").alias("status"), F.lit("low").alias("level"), F.lit("x").alias("logsource"), F.lit("selection").alias("condition"))
    return repair.report(**{"violations": repair.violations(records), "bad ids": repair.lint_rules(rule)})


@query(f"WITH {INC}, {RICH}, x AS (SELECT *, CASE WHEN id % 2 = 0 THEN '' ELSE 'known' END AS given FROM rich) SELECT id, CASE WHEN given <> '' THEN given ELSE CASE module WHEN 'supply' THEN 'supply-chain' WHEN 'malware' THEN 'malware' WHEN 'ransomware' THEN 'ransomware' ELSE 'vulnerability' END END AS attack_type FROM x")
def default_attack_type(spark, d):
    return repair.default_attack(rich(spark, d).withColumn("attack_type", F.when(F.col("id") % 2 == 0, "").otherwise("known"))).select("id", "attack_type")
