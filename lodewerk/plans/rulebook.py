"""Queries of rules, bundles, shards and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import bundles, dialects, generate, index, links, pairs, repair, rules, shards
from .catalogue import query
from .more import _profiles
from .records import IOCS, PKGS, RICH, indicators_of, packages_of, rich
from .views import INC, incidents, table

_NS = generate.NAMESPACE


def _uuid(seed: str) -> str:
    h = f"sha1(from_hex('{E.URL_SPACE}') || encode({seed}))"
    return f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr({h}, 17, 1)) AS INT) % 4 + 1, 1) || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"


def _rule_incidents(spark, d):
    """Incidents with arrays for every layer, by their number."""
    def some(n, *values):
        return F.when(F.col("id") % n == 0, F.array(*(F.lit(v) if isinstance(v, str) else v for v in values))).otherwise(F.array().cast("array<string>"))

    inc = pairs.spread(incidents(spark, d))
    host = F.concat(F.lit("evil"), "user_id", F.lit(".bad"))
    return inc.select(
        "id", "module", "severity", "cvss", (F.col("value") > 480).alias("exploited"), (F.col("id") % 3 == 0).alias("ransomware"), F.when(F.col("id") % 4 == 0, "fam").otherwise("").alias("family"), F.when(F.col("module") == "cve", F.col("cve")).alias("cve"), (F.col("id") % 2 == 0).alias("sure"),
        some(5, "lock").alias("lockfiles"), some(7, "a.js").alias("files"), some(2, host, "localhost").alias("domains"), some(3, "203.0.113.9", "10.0.0.1").alias("ips"), some(8, "ftp://x").alias("urls"), some(6, "SHA256=ab").alias("hashes"), some(9, "svc").alias("services"), some(11, "/unit").alias("systemd"), some(13, "seed").alias("seed_nodes"),
        some(10, "BEH-001", "BEH-005", "BEH-999").alias("behaviours"), some(12, "mtx").alias("mutexes"), some(14, "pipe").alias("pipes"), some(15, "run").alias("registry_keys"), some(16, "note.txt").alias("notes"), some(17, "rclone").alias("tools"), some(18, "agent").alias("user_agents"), some(19, "/x").alias("patterns"),
        some(20, "r:1").alias("images"), some(21, "r:2").alias("eol_images"), some(22, "a/b").alias("actions"), some(23, "m/n").alias("models"), some(46, "m/n").alias("downgraded_models"),
    )


_RULES = f"""r AS (SELECT *, id % 2 = 0 AS sure, id % 3 = 0 AS ransom, value > 480 AS hot FROM inc), g AS (
 SELECT id, 'exposure' AS layer, 'lockfile' AS subtype, 'selection' AS condition FROM r WHERE id % 5 = 0 UNION ALL SELECT id, 'exposure', 'file_presence', 'selection' FROM r WHERE id % 7 = 0
 UNION ALL SELECT id, 'ioc', 'network', concat_ws(' or ', 'selection_domain', CASE WHEN id % 3 = 0 THEN 'selection_ip' END) FROM r WHERE sure UNION ALL SELECT id, 'ioc', 'hashes', 'selection' FROM r WHERE sure AND id % 6 = 0
 UNION ALL SELECT id, 'ioc', 'persistence', concat_ws(' or ', CASE WHEN id % 9 = 0 THEN 'selection_service' END, CASE WHEN id % 11 = 0 THEN 'selection_linux' END) FROM r WHERE sure AND (id % 9 = 0 OR id % 11 = 0) UNION ALL SELECT id, 'ioc', 'session', 'selection_seed' FROM r WHERE sure AND id % 13 = 0
 UNION ALL SELECT id, 'hunting', 'BEH-001', 'selection' FROM r WHERE id % 10 = 0 UNION ALL SELECT id, 'hunting', 'BEH-005', 'selection_process and not filter_registry' FROM r WHERE id % 10 = 0
 UNION ALL SELECT id, 'malware', 'mutex', 'selection' FROM r WHERE id % 12 = 0 UNION ALL SELECT id, 'malware', 'named_pipe', 'selection' FROM r WHERE id % 14 = 0 UNION ALL SELECT id, 'malware', 'registry', 'selection' FROM r WHERE id % 15 = 0 UNION ALL SELECT id, 'malware', 'proc_injection', 'selection and not filter_legit' FROM r WHERE id % 4 = 0
 UNION ALL SELECT id, 'ransomware', s, c FROM r, (VALUES ('shadow_copy', '1 of selection_*', 1), ('recovery_inhibit', 'selection_bcdedit', 1), ('log_clear', '1 of selection_*', 1), ('mass_rename', 'selection', 1), ('ransom_note', 'selection', 16), ('exfil_tools', 'selection', 17)) t(s, c, n) WHERE ransom AND module <> 'ransomware' AND id % n = 0
 UNION ALL SELECT id, 'cve', 'scanner_ua', 'selection' FROM r WHERE id % 18 = 0 UNION ALL SELECT id, 'cve', 'http_pattern', 'selection' FROM r WHERE id % 19 = 0
 UNION ALL SELECT id, 'cve', s, c FROM r, (VALUES ('web_shell', 'selection_webroot and not filter_legit'), ('web_outbound', 'selection and not filter_update'), ('post_exploit', 'selection')) t(s, c) WHERE module = 'cve' AND (id % 18 = 0 OR id % 19 = 0)
 UNION ALL SELECT id, 'container', 'vuln', 'selection' FROM r WHERE id % 20 = 0 AND (coalesce(cvss >= 7, false) OR hot) UNION ALL SELECT id, 'container', 'eol', 'selection' FROM r WHERE id % 21 = 0 AND (coalesce(cvss >= 7, false) OR hot)
 UNION ALL SELECT id, 'supply', 'github_actions_compromised', 'selection' FROM r WHERE id % 22 = 0 UNION ALL SELECT id, 'supply', 'hf_malicious_model', 'selection_model_ref' FROM r WHERE id % 23 = 0 UNION ALL SELECT id, 'supply', 'hf_format_downgrade', 'selection_model_ref and selection_binary_ext' FROM r WHERE id % 46 = 0)"""


@query(f"WITH {INC}, {_RULES} SELECT id AS incident_id, layer, subtype, condition, {_uuid(chr(39) + _NS + chr(39) + ' || id || ' + chr(39) + ':' + chr(39) + ' || layer || ' + chr(39) + ':' + chr(39) + ' || subtype')} AS rule_id FROM g")
def rules_generated(spark, d):
    return generate.rules(_rule_incidents(spark, d)).select("incident_id", "layer", "subtype", "condition", "rule_id")


@query(f"WITH {INC}, {_RULES} SELECT dialect, layer, count(*) AS n FROM g, (VALUES {', '.join(f'({chr(39)}{x}{chr(39)})' for x in dialects.DEFAULT)}) t(dialect) WHERE dialect NOT IN ('suricata', 'snort') OR (layer = 'ioc' AND subtype IN ('network', 'session')) GROUP BY 1, 2")
def rules_compiled(spark, d):
    made = generate.rules(_rule_incidents(spark, d))
    return dialects.compiled(made, keep=("layer",)).groupBy("dialect", "layer").agg(F.count("*").alias("n"))


@query(f"""WITH {INC}, {_RULES} SELECT id AS incident_id, 'title: exposure lockfile' || chr(10) || 'id: ' || {_uuid(chr(39) + _NS + chr(39) + ' || id || ' + chr(39) + ':exposure:lockfile' + chr(39))} || chr(10) || 'description: |' || chr(10) || '  Incident: ' || id || chr(10) || 'logsource:' || chr(10) || '  category: file_event' || chr(10) || '  product: any' || chr(10)
 || 'detection:' || chr(10) || '  selection:' || chr(10) || '    TargetFilename|contains:' || chr(10) || '      - ''lock''' || chr(10) || '  condition: selection' || chr(10) || 'level: ' || severity || chr(10) AS text FROM inc WHERE id % 5 = 0""")
def rules_rendered(spark, d):
    made = generate.rules(_rule_incidents(spark, d)).filter("subtype = 'lockfile'")
    return generate.rendered(made).select("incident_id", "text")


@query(f"WITH {INC} SELECT id, 'import \"hash\"' || chr(10) || chr(10) || 'rule r_' || id || ' {{' || chr(10) || '  strings:' || chr(10) || '    $d0 = \"evil' || user_id || '.bad\" ascii wide' || chr(10) || '  condition:' || chr(10) || '    ' || CASE WHEN id % 2 = 0 THEN 'hash.sha256(0, filesize) == \"ab' || id || '\" or ' ELSE '' END || 'any of ($d*)' || chr(10) || '}}' || chr(10) AS text FROM inc WHERE confidence >= 0.9")
def yara_rules(spark, d):
    rows = incidents(spark, d).select("id", F.when(F.col("confidence") >= 0.9, F.col("confidence")).otherwise(0.5).alias("confidence"), F.when(F.col("id") % 2 == 0, F.array(F.concat(F.lit("AB"), "id"))).otherwise(F.array().cast("array<string>")).alias("sha256"), F.array(F.concat(F.lit("evil"), "user_id", F.lit(".bad"))).alias("domains"), F.array().cast("array<string>").alias("ips"))
    return dialects.yara(rows)


@query(f"""WITH {INC} SELECT CASE WHEN id % 4 = 0 THEN 'no-uuid' ELSE {_uuid("CAST(id AS VARCHAR)")} END AS rule_id, unnest(list_filter([CASE WHEN id % 6 = 0 THEN 'no title' END, CASE WHEN id % 4 = 0 THEN 'bad id' END, CASE WHEN id % 5 = 0 THEN 'bad status' END, CASE WHEN id % 7 = 0 THEN 'no condition' END], lambda p: p IS NOT NULL)) AS problem FROM inc""")
def rule_lint(spark, d):
    rows = incidents(spark, d).select(F.when(F.col("id") % 4 == 0, "no-uuid").otherwise(E.uuid5(F.col("id").cast("string"))).alias("rule_id"), F.when(F.col("id") % 6 == 0, "").otherwise("t").alias("title"), F.when(F.col("id") % 5 == 0, "done").otherwise("test").alias("status"), F.lit("low").alias("level"), F.lit("x").alias("logsource"), F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise("selection").alias("condition"))
    return repair.lint_rules(rows)


SHADOW_RULE = {"title": "Words of a kind", "logsource": {"category": "process"}, "detection": {"selection_a": {"url|contains|all": ["example", "page"]}, "selection_b": {"url|endswith": [".html", "-1"]}, "filter_x": {"url|contains": "bets"}, "condition": "1 of selection_* and not filter_x"}}


@query("SELECT page_id FROM pages WHERE ((contains(lower(url), 'example') AND contains(lower(url), 'page')) OR ends_with(lower(url), '.html') OR ends_with(lower(url), '-1')) AND NOT contains(lower(url), 'bets')")
def sigma_exec_quantities(spark, d):
    return rules.hits(SHADOW_RULE, table(spark, d, "pages")).select("page_id")


# bundles


def _stix_inputs(spark, d):
    inc = rich(spark, d).withColumn("attack_type", F.when(F.col("module") == "ransomware", "ransomware").otherwise("malware")).withColumn("actor", F.when(F.col("id") % 3 == 0, "LAZARUS").when(F.col("id") % 3 == 1, "Nobody").otherwise("")).withColumn("level", F.expr("element_at(array('high', 'low', ''), cast(id % 3 + 1 as int))"))
    techniques = inc.filter("id % 4 = 0").select("id", F.expr("concat('T1195.00', id % 3)").alias("technique"), F.lit("Supply").alias("name"))
    return inc, indicators_of(inc).drop("component", "pos"), techniques, _profiles(spark).withColumn("description", F.lit("about"))


def _id(kind: str, seed: str) -> str:
    return f"('{kind}--' || " + _uuid(f"'{bundles.NAMESPACE}{kind}:' || {seed}") + ")"


def _rel(src: str, relation: str, dst: str) -> str:
    return _id("relationship", f"{src} || ':{relation}:' || {dst}")


_PATTERN = "('[' || CASE type WHEN 'domain' THEN 'domain-name:value' WHEN 'ip' THEN CASE WHEN contains(value, ':') THEN 'ipv6-addr:value' ELSE 'ipv4-addr:value' END WHEN 'url' THEN 'url:value' ELSE 'file:hashes.''SHA-256''' END || ' = ''' || value || ''']')"
_STIX = f"""s AS (SELECT *, CASE id % 3 WHEN 0 THEN 'LAZARUS' WHEN 1 THEN 'Nobody' ELSE '' END AS actor FROM rich), f AS (SELECT io.*, campaign, {_PATTERN} AS pattern FROM io JOIN (SELECT id, campaign FROM inc) c USING (id) WHERE value IS NOT NULL),
o AS (SELECT id AS bundle, 'identity' AS type, {_id('identity', "'lodewerk'")} AS id FROM s UNION ALL SELECT id, 'vulnerability', {_id('vulnerability', "coalesce(nullif(osv_id, ''), ghsa_id)")} FROM s WHERE osv_id <> '' OR ghsa_id <> '' UNION ALL SELECT id, 'campaign', {_id('campaign', 'campaign')} FROM s WHERE campaign <> ''
 UNION ALL SELECT id, 'malware', {_id('malware', 'campaign')} FROM s WHERE campaign <> '' UNION ALL SELECT id, 'relationship', {_rel(_id('campaign', 'campaign'), 'uses', _id('malware', 'campaign'))} FROM s WHERE campaign <> '' UNION ALL SELECT id, 'threat-actor', {_id('threat-actor', 'actor')} FROM s WHERE actor <> ''
 UNION ALL SELECT id, 'relationship', {_rel(_id('campaign', 'campaign'), 'attributed-to', _id('threat-actor', 'actor'))} FROM s WHERE actor <> '' AND campaign <> '' UNION ALL SELECT id, 'intrusion-set', {_id('intrusion-set', "'lazarus'")} FROM s WHERE actor = 'LAZARUS' UNION ALL SELECT id, 'relationship', {_rel(_id('threat-actor', 'actor'), 'part-of', _id('intrusion-set', "'lazarus'"))} FROM s WHERE actor = 'LAZARUS'
 UNION ALL SELECT id, 'attack-pattern', {_id('attack-pattern', "'T1195.00' || (id % 3)")} FROM s WHERE id % 4 = 0 UNION ALL SELECT id, 'relationship', {_rel(_id('campaign', 'campaign'), 'uses', _id('attack-pattern', "'T1195.00' || (id % 3)"))} FROM s WHERE id % 4 = 0 AND campaign <> ''
 UNION ALL SELECT id, 'indicator', {_id('indicator', "id || ':' || pattern")} FROM f UNION ALL SELECT id, 'relationship', {_rel(_id('indicator', "id || ':' || pattern"), 'indicates', _id('campaign', 'campaign'))} FROM f WHERE campaign <> '')"""


@query(f"WITH {INC}, {RICH}, {IOCS}, {_STIX} SELECT CAST(bundle AS VARCHAR) AS bundle, type, id FROM o")
def stix_objects(spark, d):
    return bundles.objects(*_stix_inputs(spark, d)).select("bundle", "type", "id")


@query(f"WITH {INC}, {RICH}, {IOCS}, {_STIX} SELECT type, count(DISTINCT id) AS n FROM o GROUP BY 1")
def stix_once(spark, d):
    return bundles.once(bundles.objects(*_stix_inputs(spark, d))).groupBy("type").agg(F.count("*").alias("n"))


@query(f"""WITH {INC}, {RICH}, {IOCS}, {_STIX} SELECT CAST(bundle AS VARCHAR) AS bundle, id, p.problem FROM o, (SELECT unnest(CASE WHEN type = 'malware' THEN ['no types'] WHEN type = 'campaign' AND bundle % 8 = 0 THEN ['bad id'] ELSE [] END) AS problem) p
 UNION ALL SELECT CAST(id AS VARCHAR), {_rel(_id('campaign', 'campaign'), 'uses', _id('malware', 'campaign'))}, 'source_ref unknown' FROM s WHERE campaign <> '' AND id % 8 = 0 UNION ALL SELECT CAST(id AS VARCHAR), {_rel(_id('campaign', 'campaign'), 'attributed-to', _id('threat-actor', 'actor'))}, 'source_ref unknown' FROM s WHERE actor <> '' AND campaign <> '' AND id % 8 = 0
 UNION ALL SELECT CAST(id AS VARCHAR), {_rel(_id('campaign', 'campaign'), 'uses', _id('attack-pattern', "'T1195.00' || (id % 3)"))}, 'source_ref unknown' FROM s WHERE id % 8 = 0 AND campaign <> '' UNION ALL SELECT CAST(id AS VARCHAR), {_rel(_id('indicator', "id || ':' || pattern"), 'indicates', _id('campaign', 'campaign'))}, 'target_ref unknown' FROM f WHERE campaign <> '' AND id % 8 = 0""".replace("SELECT CAST(bundle AS VARCHAR) AS bundle, id, p.problem", "SELECT CAST(bundle AS VARCHAR) AS bundle, CASE WHEN type = 'campaign' AND bundle % 8 = 0 THEN 'campaign--x' ELSE id END AS id, p.problem"))
def stix_invalid(spark, d):
    made = bundles.objects(*_stix_inputs(spark, d))
    broken = (F.col("type") == "campaign") & (F.col("bundle").cast("bigint") % 8 == 0)
    made = made.withColumn("kind", F.when(F.col("type") != "malware", F.col("kind"))).withColumn("id", F.when(broken, "campaign--x").otherwise(F.col("id")))
    return bundles.invalid(made)


# documents and shards

_LINE = "id || ' ' || package || repeat('y', CAST(id % 40 AS INT))"


@query(f"WITH {INC}, l AS (SELECT id, module, {_LINE} AS line FROM inc) SELECT id, module, CAST(floor(coalesce(sum(strlen(line) + 1) OVER (PARTITION BY module ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 4096) AS BIGINT) AS shard FROM l")
def size_bounded_shards(spark, d):
    rows = incidents(spark, d).select("id", "module", F.expr("concat(id, ' ', package, repeat('y', cast(id % 40 as int)))").alias("line"))
    return shards.size_bounded(rows, ["module"], ["id"], "line", 4096).select("id", "module", "shard")


@query(f"""WITH {INC}, {IOCS}, {PKGS}, s AS (SELECT id, CASE WHEN source = 'osv' THEN 'osv' ELSE source || ',osv' END AS sources FROM inc), e AS (SELECT id, min_by(ecosystem, pos) AS ecosystem, count(*) AS packages FROM pk GROUP BY 1), i AS (SELECT id, count(*) AS indicators, count(*) FILTER (type <> 'url') AS shown FROM io WHERE value IS NOT NULL GROUP BY 1)
SELECT inc.id, module, severity, sources, e.ecosystem, packages, indicators, shown, strftime(start_ts, '%Y-%m-%d') AS published FROM inc JOIN s USING (id) JOIN e USING (id) JOIN i USING (id)""")
def incident_summaries(spark, d):
    inc = incidents(spark, d)
    return index.summaries(inc.withColumn("sources", F.array(F.lit("osv"))), packages_of(inc), indicators_of(inc))


@query(f"""WITH {INC}, r AS (SELECT source, module AS run, CASE WHEN min(id) % 3 = 0 THEN 'timeout' END AS error, count(*) FILTER (value > 60) AS rows FROM inc GROUP BY 1, 2)
SELECT CASE WHEN error IS NOT NULL THEN 'errored' WHEN rows = 0 THEN 'empty' ELSE 'ok' END AS status, count(*) AS sources, string_agg(source || '/' || run, ',' ORDER BY source || '/' || run) AS names FROM r GROUP BY 1""")
def fetch_health(spark, d):
    runs = incidents(spark, d).groupBy(F.concat_ws("/", "source", "module").alias("source")).agg(F.min("id").alias("m"), F.count_if(F.col("value") > 60).alias("rows"))
    return index.health(runs.select("source", "rows", F.when(F.col("m") % 3 == 0, "timeout").alias("error")))


@query(f"""WITH {INC}, {IOCS} SELECT source, count(DISTINCT id) AS articles, count(DISTINCT id) FILTER (id % 3 = 0) AS matched, count(*) FILTER (type = 'domain') AS domain, count(*) FILTER (type = 'ip') AS ip, count(*) FILTER (type = 'url') AS url FROM io WHERE value IS NOT NULL GROUP BY 1""")
def probe_summary(spark, d):
    found = indicators_of(incidents(spark, d)).filter("value is not null")
    return index.probe(found.select("source", "id", (F.col("id") % 3 == 0).alias("matched"), "type"), ("domain", "ip", "url"))


@query(f"""WITH {INC}, {IOCS}, v AS (SELECT io.value, m.module, io.id FROM io JOIN (SELECT id, module FROM inc) m USING (id) WHERE type <> 'url' AND value IS NOT NULL), h AS (SELECT value, min(id) AS hub, arg_min(module, id) AS hub_module FROM v GROUP BY 1 HAVING count(DISTINCT module) > 1)
SELECT DISTINCT value, hub AS src_id, id AS dst_id, hub_module AS src_module, module AS dst_module FROM v JOIN h USING (value) WHERE id <> hub""")
def cross_domain_incidents(spark, d):
    inc = incidents(spark, d)
    return links.cross_domain(indicators_of(inc).filter("type <> 'url'").join(inc.select("id", "module"), "id"))
