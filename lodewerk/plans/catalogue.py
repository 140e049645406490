"""All queries by name with SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import exprs as E
from ..operators import entities, index, links, resolve, rules, stix, typosquat
from ..streaming import upsert
from .views import INC, NOW, PKG, incidents, now, packages, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with SQL for it."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _listed(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# shared indicators, links, claims

_FEED = """SELECT ioc_type, ioc, count(DISTINCT module) AS modules, count(DISTINCT id) AS incidents, round(max(confidence), 6) AS confidence,
  count(DISTINCT module) > 1 AS cross_domain,
  round(CASE WHEN count(DISTINCT module) > 1 THEN least(max(confidence) + 0.08 * (count(DISTINCT module) - 1), 0.98) ELSE max(confidence) END, 6) AS boosted
  FROM inc WHERE ioc IS NOT NULL GROUP BY 1, 2"""


@query(f"WITH {INC} {_FEED}")
def combined_feed(spark, d):
    return links.combined_feed(incidents(spark, d))


@query(f"WITH {INC} SELECT * FROM ({_FEED}) WHERE cross_domain")
def shared_iocs(spark, d):
    return links.combined_feed(incidents(spark, d)).filter("cross_domain")


@query(f"""WITH {INC}, x AS (SELECT ioc, count(DISTINCT module) AS n, string_agg(DISTINCT module, ',' ORDER BY module) AS modules FROM inc WHERE ioc IS NOT NULL GROUP BY 1)
SELECT id, inc.ioc, modules, round(least(confidence + 0.08 * (n - 1), 0.98), 6) AS boosted FROM inc JOIN x ON inc.ioc = x.ioc WHERE n > 1""")
def cross_module_boost(spark, d):
    return links.cross_module_sources(incidents(spark, d))


@query(f"""WITH {INC} SELECT DISTINCT a.id AS src_id, a.module AS src_module, b.id AS dst_id, b.module AS dst_module FROM inc a JOIN inc b ON a.ioc = b.ioc AND a.id < b.id
WHERE abs(epoch_us(a.start_ts) - epoch_us(b.start_ts)) <= 7 * 86400000000""")
def link_shared_infra(spark, d):
    return links.shared_infrastructure(incidents(spark, d))


@query(f"""WITH {INC}, c AS (SELECT campaign, min(id) AS hub, max(confidence) AS conf FROM inc WHERE campaign <> '' GROUP BY 1 HAVING count(DISTINCT module) > 1)
SELECT hub AS src_id, id AS dst_id, inc.campaign, round(conf, 6) AS confidence FROM inc JOIN c ON inc.campaign = c.campaign WHERE id <> hub""")
def link_shared_actor(spark, d):
    return links.shared_actor(incidents(spark, d))


@query(f"""WITH {INC}, p AS (SELECT a.id AS a, b.id AS b, upper(a.cve) AS cve FROM inc a JOIN inc b ON upper(a.cve) = upper(b.cve) WHERE a.module = 'cve' AND b.module = 'container')
SELECT a AS src_id, b AS dst_id, cve FROM p UNION SELECT b, a, cve FROM p""")
def link_cve_bidirectional(spark, d):
    return links.cve_links(incidents(spark, d))


@query("SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS n FROM orders) WHERE n = 1")
def claim_priority_dedup(spark, d):
    return links.claim(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), "o_custkey", "o_orderpriority", "o_orderkey")


@query(f"""WITH {PKG} SELECT p_partkey AS id, p_name AS name, weekly, CASE WHEN weekly >= 1000000 THEN 'critical' WHEN weekly >= 100000 THEN 'high' WHEN weekly >= 10000 THEN 'medium' WHEN weekly >= 1000 THEN 'low' ELSE 'negligible' END AS impact
FROM part JOIN pkg ON p_name = name AND p_type = ecosystem""")
def popularity_join(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("ecosystem"))
    return links.popularity(rows, packages(spark, d)).select("id", "name", "weekly", "impact")


_ALIASES = {"ontion": "onset", "thtion": "thorn", "the": "article", "ereing": "ering", "idiot": "fool", "unggeist": "geist"}


@query(f"""WITH a AS (SELECT unnest([{_listed(_ALIASES)}]) AS alias, unnest([{_listed(_ALIASES.values())}]) AS slug)
SELECT DISTINCT doc_id AS id, slug FROM documents, a WHERE CASE WHEN length(alias) >= 6 THEN contains(lower(text), alias) ELSE regexp_matches(lower(text), '(?:^|[^a-z0-9_])' || alias || '(?:$|[^a-z0-9_])') END""")
def actor_text_match(spark, d):
    aliases = spark.createDataFrame(list(_ALIASES.items()), "alias string, slug string")
    return links.alias_matches(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), aliases)


# entity resolution

_EDGES = """edges AS (SELECT a.id AS src, b.id AS dst FROM inc a JOIN inc b ON a.ioc = b.ioc AND a.id < b.id
  WHERE abs(epoch_us(a.start_ts) - epoch_us(b.start_ts)) <= 7 * 86400000000 GROUP BY 1, 2
  HAVING count(DISTINCT a.ioc) >= CASE WHEN bool_and(a.source IN ('wiz', 'socket', 'aikido', 'stepsecurity') AND b.source IN ('wiz', 'socket', 'aikido', 'stepsecurity')) THEN 1 ELSE 2 END)"""
_REACH = f"""{_EDGES}, two AS (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges), walk AS (SELECT src AS a, dst AS b FROM two UNION SELECT walk.a, two.dst FROM walk JOIN two ON walk.b = two.src)"""


@query(f"WITH {INC}, {_EDGES} SELECT src, dst FROM edges")
def merge_edges_7d(spark, d):
    return resolve.event_edges(incidents(spark, d))


@query(f"WITH RECURSIVE {INC}, {_REACH} SELECT id, least(id, coalesce(min(b), id)) AS component FROM inc LEFT JOIN walk ON id = a GROUP BY id")
def merge_components(spark, d):
    rows = incidents(spark, d)
    return resolve.components(rows, _chains(rows))


def _chains(rows: DataFrame) -> DataFrame:
    """Edges with the components of ``merge_edges_7d``, fewer than rows."""
    packages = rows.select("id", F.lit("").alias("ecosystem"), F.lit("").alias("name")).limit(0)
    return entities.event_edges(rows.withColumn("campaign", F.lit("")), packages, rows.select("id", "start_ts", "source", F.col("ioc_type").alias("type"), F.col("ioc").alias("value")))


@query(f"""WITH RECURSIVE {INC}, {_REACH}, named AS (SELECT id, least(id, coalesce(min(b), id)) AS component FROM inc LEFT JOIN walk ON id = a GROUP BY id),
j AS (SELECT component, inc.*, package || ' ' || campaign AS description, CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS rank FROM inc JOIN named USING (id)),
g AS (SELECT component, count(*) AS members, min_by(module, id) AS module, max(rank) AS rank, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(DISTINCT source) AS n, max(confidence) AS best, min(start_ts) AS first_seen FROM j GROUP BY 1),
t AS (SELECT component, description FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY strlen(description) DESC, id) AS r FROM j) WHERE r = 1)
SELECT component, members, module, CASE rank WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity, description, sources, round(least(best + least(0.08 * (n - 1), 0.2), 0.98), 6) AS confidence, first_seen FROM g JOIN t USING (component)""")
def merge_survivors(spark, d):
    rows = incidents(spark, d).withColumn("description", F.concat_ws(" ", "package", "campaign"))
    return resolve.survivors(rows, resolve.components(rows, _chains(rows)))


@query("""WITH RECURSIVE k AS (SELECT DISTINCT l_suppkey AS s, l_partkey % 500 AS p FROM lineitem WHERE l_quantity >= 49), e AS (SELECT DISTINCT a.s AS a, b.s AS b FROM k a JOIN k b ON a.p = b.p),
w AS (SELECT a, b FROM e UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a) SELECT a AS id, min(b) AS component FROM w GROUP BY 1""")
def supplier_components(spark, d):
    keys = table(spark, d, "lineitem").filter("l_quantity >= 49").select((F.col("l_partkey") % 500).cast("string").alias("key"), F.col("l_suppkey").alias("id")).distinct()
    return resolve.components(keys.select("id").distinct(), resolve.star_edges(keys))


@query("""WITH RECURSIVE k AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem), e AS (SELECT DISTINCT a.s AS a, b.s AS b FROM k a JOIN k b ON a.p = b.p),
w AS (SELECT a, b FROM e UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a) SELECT a AS id, min(b) AS component FROM w GROUP BY 1""")
def supplier_components_all(spark, d):
    keys = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("key"), F.col("l_suppkey").alias("id")).distinct()
    return resolve.components(keys.select("id").distinct(), resolve.star_edges(keys))


@query(f"""WITH {PKG}, a AS (SELECT DISTINCT ecosystem, replace(lower(name), ' ', CASE WHEN length(name) % 2 = 0 THEN '' ELSE '-' END) AS name, weekly FROM pkg),
s AS (SELECT x.ecosystem, x.name, y.name AS target, y.weekly, levenshtein(x.name, y.name) AS d, translate(x.name, '01345', 'oleas') AS f, translate(y.name, '01345', 'oleas') AS g,
 starts_with(x.name, y.name || '-') OR ends_with(x.name, '-' || y.name) OR starts_with(y.name, x.name || '-') OR ends_with(y.name, '-' || x.name) AS added FROM a x JOIN a y ON x.ecosystem = y.ecosystem AND x.name <> y.name),
m AS (SELECT *, CASE WHEN f = g THEN 0.99 WHEN added THEN 0.85 WHEN greatest(length(name), length(target)) >= 4 AND ((length(target) >= 5 AND d <= 2) OR (length(target) >= 4 AND d = 1)) THEN round(1 - d / greatest(length(name), length(target)), 12) ELSE 0 END AS score FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY ecosystem, name ORDER BY score DESC, weekly DESC, target) AS r FROM m WHERE score >= 0.8)
SELECT ecosystem, name, target, weekly, round(score, 6) AS score FROM t WHERE r = 1""")
def typosquat_best(spark, d):
    names = packages(spark, d).select("ecosystem", F.when(F.length("name") % 2 == 0, F.regexp_replace(F.lower("name"), " ", "")).otherwise(F.regexp_replace(F.lower("name"), " ", "-")).alias("name"), "weekly").distinct()
    return typosquat.best_matches(names.select("ecosystem", "name").distinct(), names).drop("technique")


# scores, gates, bins

_AGE = f"epoch_us(TIMESTAMP '{NOW}') // 1000000 - epoch_us(start_ts) // 1000000"


@query(f"""WITH {INC}, s AS (SELECT user_id, count(DISTINCT source) AS n, max(confidence) AS best FROM inc GROUP BY 1)
SELECT user_id, n AS sources, round(least(best + least(0.08 * (n - 1), 0.2), 0.98), 6) AS confidence FROM s""")
def confidence_score(spark, d):
    sources = incidents(spark, d).groupBy("user_id").agg(F.sort_array(F.collect_set("source")).alias("s"))
    return sources.select("user_id", F.size("s").cast("bigint").alias("sources"), F.round(E.confidence(F.col("s")), 6).alias("confidence"))


@query(f"""WITH {INC}, x AS (SELECT id, CASE WHEN a > 180 * 86400 THEN least(confidence, 0.4) WHEN a > 90 * 86400 THEN least(confidence, 0.7) ELSE confidence END AS c FROM (SELECT id, confidence, ({_AGE}) * 4 AS a FROM inc))
SELECT id, round(c, 6) AS decayed, CASE WHEN c >= 0.85 THEN 'stable' WHEN c >= 0.6 THEN 'test' WHEN c >= 0.4 THEN 'experimental' ELSE 'deprecated' END AS status FROM x""")
def decay_status(spark, d):
    rows = incidents(spark, d)
    old = F.timestamp_seconds(F.unix_seconds(now().cast("timestamp")) - 4 * (F.unix_seconds(now().cast("timestamp")) - F.unix_seconds(F.col("start_ts").cast("timestamp"))))
    c = E.decay(F.col("confidence"), old, now())
    return rows.select("id", F.round(c, 6).alias("decayed"), E.status(c).alias("status"))


@query(f"""WITH {INC} SELECT user_id, CASE max(CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END) WHEN 4 THEN 'critical' WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS severity FROM inc GROUP BY 1""")
def severity_rollup(spark, d):
    return incidents(spark, d).groupBy("user_id").agg(E.severity_label(F.max(E.severity_rank(F.col("severity")))).alias("severity"))


@query(f"""WITH {PKG} SELECT name, ecosystem, weekly, CASE WHEN weekly >= 1000000 THEN 'critical' WHEN weekly >= 100000 THEN 'high' WHEN weekly >= 10000 THEN 'medium' WHEN weekly >= 1000 THEN 'low' ELSE 'negligible' END AS impact FROM pkg""")
def impact_rating(spark, d):
    return packages(spark, d).withColumn("impact", E.impact_rating(F.col("weekly")))


@query(f"WITH {INC} SELECT id, severity, cvss FROM inc WHERE module <> 'cve' OR cvss >= 9 OR campaign <> '' OR user_id % 7 = 0")
def cve_gate(spark, d):
    rows = incidents(spark, d)
    return rows.filter((F.col("module") != "cve") | (F.col("cvss") >= 9) | (F.col("campaign") != "") | (F.col("user_id") % 7 == 0)).select("id", "severity", "cvss")


@query(f"""WITH {INC} SELECT id, CASE WHEN user_id % 10 = 0 THEN 1 WHEN cvss >= 9 THEN 2 WHEN cvss >= 7 AND user_id % 3 = 0 THEN 3 ELSE 0 END AS tier FROM inc WHERE module = 'container' AND (user_id % 10 = 0 OR cvss >= 9 OR (cvss >= 7 AND user_id % 3 = 0))""")
def container_tier(spark, d):
    tier = F.when(F.col("user_id") % 10 == 0, 1).when(F.col("cvss") >= 9, 2).when((F.col("cvss") >= 7) & (F.col("user_id") % 3 == 0), 3).otherwise(0)
    return incidents(spark, d).filter("module = 'container'").select("id", tier.alias("tier")).filter("tier > 0")


@query(f"""WITH {INC} SELECT user_id, count(*) FILTER (ioc_type = 'ip') AS ips, count(*) FILTER (ioc_type = 'domain') AS domains, count(*) FILTER (ioc_type = 'sha256') AS hashes,
 count(*) FILTER (ioc_type = 'ip') > 100 OR count(*) FILTER (ioc_type = 'domain') > 100 OR count(*) FILTER (ioc_type = 'sha256') > 300 OR count(*) > 400 AS anomalous FROM inc GROUP BY 1""")
def circuit_breaker(spark, d):
    by = incidents(spark, d).groupBy("user_id").agg(*[F.count_if(F.col("ioc_type") == k).alias(n) for k, n in (("ip", "ips"), ("domain", "domains"), ("sha256", "hashes"))])
    return by.withColumn("anomalous", (F.col("ips") > 100) | (F.col("domains") > 100) | (F.col("hashes") > 300) | (F.col("ips") + F.col("domains") + F.col("hashes") > 400))


_IP = "((CASE event_id % 6 WHEN 0 THEN 10 WHEN 1 THEN 172 WHEN 2 THEN 192 WHEN 3 THEN 8 WHEN 4 THEN 127 ELSE 203 END) || '.' || (CASE event_id % 6 WHEN 3 THEN 8 WHEN 2 THEN 168 ELSE user_id % 40 END) || '.' || (event_id % 9) || '.' || (event_id % 9))"


@query(f"""WITH x AS (SELECT event_id AS id, {_IP} AS ip FROM events) SELECT id, ip, ip IN ({_listed(K.RESOLVERS)}) OR ip LIKE '10.%' OR ip LIKE '127.%' OR ip LIKE '192.168.%' OR ip LIKE '169.254.%'
 OR (ip LIKE '172.%' AND CAST(split_part(ip, '.', 2) AS INT) BETWEEN 16 AND 31) AS blocked FROM x""")
def ip_blocklist(spark, d):
    ip = F.expr(_IP)
    return table(spark, d, "events").select(F.col("event_id").alias("id"), ip.alias("ip"), E.blocked_ip(ip).alias("blocked"))


_HOST_SQL = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)"


@query(f"SELECT page_id, {_HOST_SQL} AS host FROM pages")
def url_host(spark, d):
    return table(spark, d, "pages").select("page_id", E.url_host(F.col("url")).alias("host"))


_NAME_SQL = f"CASE page_id % 4 WHEN 0 THEN {_HOST_SQL} WHEN 1 THEN 'sub.' || split_part({_HOST_SQL}, '.', 1) || '.workers' WHEN 2 THEN split_part({_HOST_SQL}, '.', 1) || '.exe' ELSE replace({_HOST_SQL}, 'example.', 'ex-') || '.net' END"


@query(f"""WITH x AS (SELECT page_id, {_NAME_SQL} AS domain FROM pages) SELECT page_id, domain, NOT contains(domain, '.') OR regexp_extract(lower(domain), '[^.]*$', 0) IN ({_listed(K.RESERVED_TLDS + K.FILE_EXTENSIONS)})
 OR lower(domain) IN ({_listed(K.BENIGN_DOMAINS)}) OR regexp_matches(lower(domain), '[.]({'|'.join(s.replace('.', '[.]') for s in K.BENIGN_SUFFIXES)})$') AS blocked FROM x""")
def domain_filter(spark, d):
    host = E.url_host(F.col("url"))
    first = F.split_part(host, F.lit("."), F.lit(1))
    name = F.when(F.col("page_id") % 4 == 0, host).when(F.col("page_id") % 4 == 1, F.concat(F.lit("sub."), first, F.lit(".workers"))).when(F.col("page_id") % 4 == 2, F.concat(first, F.lit(".exe"))).otherwise(F.concat(F.replace(host, F.lit("example."), F.lit("ex-")), F.lit(".net")))
    return table(spark, d, "pages").select("page_id", name.alias("domain"), E.blocked_domain(name).alias("blocked"))


@query(r"SELECT doc_id, len(x) AS n, list_aggregate(list_sort(list_distinct(x)), 'string_agg', ',') AS ips FROM (SELECT doc_id, regexp_extract_all(text, '\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b') AS x FROM documents) WHERE len(x) > 0")
def ioc_ip_extract(spark, d):
    found = F.regexp_extract_all("text", F.lit(r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"), F.lit(0))
    return table(spark, d, "documents").withColumn("x", found).filter("size(x) > 0").select("doc_id", F.size("x").cast("bigint").alias("n"), F.array_join(F.sort_array(F.array_distinct("x")), ",").alias("ips"))


@query(r"SELECT doc_id, kind, value FROM (SELECT doc_id, unnest(regexp_extract_all(text, '\b[a-f0-9]{32,64}\b')) AS value FROM documents), (VALUES (32, 'md5'), (40, 'sha1'), (64, 'sha256')) k(n, kind) WHERE length(value) = n GROUP BY ALL")
def ioc_hash_extract(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"\b[a-f0-9]{32,64}\b"), F.lit(0))).alias("value"))
    kind = F.when(F.length("value") == 32, "md5").when(F.length("value") == 40, "sha1").when(F.length("value") == 64, "sha256")
    return found.select("doc_id", kind.alias("kind"), "value").filter("kind is not null").distinct()


@query(f"""SELECT DISTINCT w, length(w) > 100 OR w = '' OR regexp_matches(w, '[.,;!?]$') OR lower(w) IN ({_listed(K.NO_PACKAGES)}) AS no_package FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE NOT regexp_matches(w, '\\s')""")
def package_mentions(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("w")).filter(~F.col("w").rlike(r"\s")).distinct()
    return words.select("w", E.false_package(F.col("w")).alias("no_package"))


_ROUTES = {"supply": ("license", "copyright"), "malware": ("idiot", "moron"), "cve": ("token", "password"), "container": ("@",)}


@query(f"""SELECT doc_id, module FROM ({' UNION ALL '.join(f"SELECT doc_id, '{m}' AS module FROM documents WHERE ({' OR '.join(f"contains(lower(text), '{w}')" for w in ws)}) AND NOT contains(lower(text), 'subscribe')" for m, ws in _ROUTES.items())})""")
def router(spark, d):
    text = F.lower("text")
    modules = F.array_compact(F.array(*[F.when(F.exists(F.array(*map(F.lit, ws)), lambda w: F.contains(text, w)), F.lit(m)) for m, ws in _ROUTES.items()]))
    return table(spark, d, "documents").filter(~F.contains(text, F.lit("subscribe"))).select("doc_id", F.explode(modules).alias("module"))


# indexes, listings, rollups

@query(f"""WITH {INC} SELECT coalesce(module, 'total') AS module, count(*) AS incidents, count(DISTINCT ioc) AS iocs, count(*) FILTER (severity = 'critical') AS critical FROM inc GROUP BY ROLLUP (module)""")
def module_stats_rollup(spark, d):
    return index.module_stats(incidents(spark, d))


@query(f"WITH {INC} SELECT campaign, min_by(module, id) AS module, round(min_by(confidence, id), 6) AS confidence, count(*) AS incidents, min(start_ts) AS first_seen, max(start_ts) AS last_seen FROM inc WHERE campaign <> '' GROUP BY 1")
def campaign_rollup(spark, d):
    return index.campaigns(incidents(spark, d))


@query(f"WITH {INC} SELECT id, module, severity, start_ts FROM inc ORDER BY start_ts DESC NULLS LAST, id LIMIT 20")
def recent_topk(spark, d):
    return index.recent(incidents(spark, d))


@query(f"WITH {INC} SELECT id, severity, module FROM inc WHERE severity IN ('critical', 'high') OR (module = 'supply' AND severity = 'medium') OR campaign <> '' OR epoch_us(start_ts) // 1000000 > epoch_us(TIMESTAMP '{NOW}') // 1000000 - 20 * 86400")
def curated_listing(spark, d):
    return index.curated(incidents(spark, d), now(), 20).select("id", "severity", "module")


@query(f"""WITH {INC} SELECT id, CASE WHEN campaign <> '' THEN 'campaign:' || replace(lower(campaign), ' ', '-') || ' ' ELSE '' END || 'module:' || module || ' severity:' || severity AS tags, 'pkg' AS shard, strftime(start_ts, '%Y-%m-%d') AS published FROM inc""")
def search_projection(spark, d):
    return index.search_rows(incidents(spark, d))


@query(f"WITH {INC} SELECT lower(ecosystem) || '/' || lower(package) AS key, count(*) AS n, string_agg(id, ',' ORDER BY id) AS items FROM inc GROUP BY 1")
def by_package_index(spark, d):
    return index.inverted(incidents(spark, d), F.concat(F.lower("ecosystem"), F.lit("/"), F.lower("package")), F.col("id"))


@query(f"WITH {INC} SELECT upper(cve) AS key, count(*) AS n, string_agg(id, ',' ORDER BY id) AS items FROM inc GROUP BY 1")
def by_cve_index(spark, d):
    return index.inverted(incidents(spark, d), F.upper("cve"), F.col("id"))


@query(f"WITH {INC} SELECT id, 'lw-' || module || '-' || year(start_ts) || '-' || format('{{:06d}}', row_number() OVER (PARTITION BY module, year(start_ts) ORDER BY id)) AS public_id FROM inc")
def assign_ids(spark, d):
    return index.assign_ids(incidents(spark, d))


@query(f"WITH {INC} SELECT id, package, severity, previous FROM (SELECT *, lag(severity) OVER (PARTITION BY package ORDER BY start_ts, id) AS previous FROM inc) WHERE previous <> severity")
def prev_value_change(spark, d):
    return index.previous_values(incidents(spark, d), "package", ["start_ts", "id"], "severity").filter("previous <> severity").select("id", "package", "severity", "previous")


@query(f"WITH {INC} SELECT id, package, value, previous FROM (SELECT *, lag(value) OVER (PARTITION BY package ORDER BY start_ts, id) AS previous FROM inc) WHERE value > 50 AND value > 3 * previous")
def size_spike(spark, d):
    return index.previous_values(incidents(spark, d), "package", ["start_ts", "id"], "value").filter("value > 50 and value > 3 * previous").select("id", "package", "value", "previous")


@query(f"""WITH {INC}, u AS (SELECT ioc_type, ioc, id, 0 AS pos FROM inc WHERE id % 2 = 0 UNION ALL SELECT ioc_type, ioc, id, 1 FROM inc WHERE id % 3 = 0)
SELECT ioc_type, ioc, id, min(pos) AS pos FROM u WHERE ioc IS NOT NULL AND ioc_type <> 'sha256' GROUP BY 1, 2, 3""")
def feed_union_dedup(spark, d):
    rows = incidents(spark, d).select("ioc_type", "ioc", "id")
    both = rows.filter("id % 2 = 0").withColumn("pos", F.lit(0)).unionByName(rows.filter("id % 3 = 0").withColumn("pos", F.lit(1)))
    return index.keep_first(both.filter("ioc is not null and ioc_type <> 'sha256'"), ["ioc_type", "ioc", "id"], ["pos"])


@query(f"""WITH {INC}, u AS (SELECT ioc_type, ioc, id, 0 AS pos FROM inc WHERE id % 2 = 0 UNION ALL SELECT ioc_type, ioc, id, 1 FROM inc WHERE id % 2 <> 0 OR id % 3 = 0)
SELECT ioc_type, ioc, id, min(pos) AS pos FROM u WHERE ioc IS NOT NULL GROUP BY 1, 2, 3""")
def feed_union_dedup_all(spark, d):
    rows = incidents(spark, d).select("ioc_type", "ioc", "id")
    both = rows.filter("id % 2 = 0").withColumn("pos", F.lit(0)).unionByName(rows.filter("id % 2 <> 0 or id % 3 = 0").withColumn("pos", F.lit(1)))
    return index.keep_first(both.filter("ioc is not null"), ["ioc_type", "ioc", "id"], ["pos"])


@query(f"WITH {INC}, k AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') SELECT id, user_id FROM inc WHERE id NOT IN (SELECT o_orderkey FROM k)")
def dangling_refs(spark, d):
    return index.dangling(incidents(spark, d).select("id", "user_id"), table(spark, d, "orders").filter("o_orderstatus = 'F'"), "id", "o_orderkey")


@query(f"""WITH {INC}, a AS (SELECT module, count(*) AS incidents FROM inc GROUP BY 1), b AS (SELECT module, count(*) AS entries FROM (SELECT DISTINCT module, ioc FROM inc) GROUP BY 1)
SELECT module, incidents, entries, abs(incidents - entries) > 0.01 * incidents AS drift FROM a JOIN b USING (module)""")
def consistency_report(spark, d):
    rows = incidents(spark, d)
    return index.consistency(rows, rows.select("module", "ioc").distinct())


@query(f"WITH {INC} SELECT source, CASE WHEN max(cvss) >= 9 THEN 'ok' ELSE 'empty' END AS state, count(*) AS n FROM inc GROUP BY 1")
def source_health(spark, d):
    return incidents(spark, d).groupBy("source").agg(F.when(F.max("cvss") >= 9, "ok").otherwise("empty").alias("state"), F.count("*").alias("n"))


@query(f"""WITH {INC}, h AS (SELECT id, sha256(package || chr(10) || cve || chr(10) || severity) AS hash FROM inc), o AS (SELECT id, CASE WHEN id % 10 = 0 THEN 'old' ELSE hash END AS hash FROM h WHERE id % 7 <> 0)
SELECT h.id, h.hash FROM h LEFT JOIN o ON h.id = o.id WHERE o.id IS NULL OR o.hash <> h.hash""")
def incremental_regen(spark, d):
    now_ = incidents(spark, d).select("id", E.content_hash(F.col("package"), F.col("cve"), F.col("severity")).alias("hash"))
    cached = now_.filter("id % 7 <> 0").withColumn("hash", F.when(F.col("id") % 10 == 0, "old").otherwise(F.col("hash")))
    return index.changed(now_, cached)


# text functions

@query("SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, coalesce(nullif(regexp_extract(lower(url), '^[a-z0-9]+', 0), ''), 'misc') AS shard, sha256(url) AS hash FROM pages")
def slug_and_shard(spark, d):
    return table(spark, d, "pages").select("page_id", E.slug(F.col("url")).alias("slug"), E.shard_key(F.col("url")).alias("shard"), E.content_hash(F.col("url")).alias("hash"))


_SHA = f"sha1(from_hex('{E.URL_SPACE}') || encode(url))"


@query(f"""WITH x AS (SELECT page_id, {_SHA} AS h FROM pages) SELECT page_id, u AS uuid, CAST(('0x' || substr(u, 1, 8)) AS BIGINT) % 9000000 + 1000000 AS sid FROM (SELECT page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
 || substr('89ab', CAST(('0x' || substr(h, 17, 1)) AS INT) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS u FROM x)""")
def uuid5_and_sid(spark, d):
    u = E.uuid5(F.col("url"))
    return table(spark, d, "pages").select("page_id", u.alias("uuid"), E.sid(u).alias("sid"))


_STAMP = "(CASE event_id % 4 WHEN 0 THEN '2024-01-05T10:20:30Z' WHEN 1 THEN '2024-02-06T01:00:00+02:00' WHEN 2 THEN '2024-02-06 01:00:00' ELSE '2023-12-31T23:30:00-05:00' END)"


@query(f"SELECT event_id AS id, epoch_us(CASE WHEN event_id % 4 <> 2 THEN CAST({_STAMP} AS TIMESTAMPTZ) END) // 1000000 AS seconds, CASE event_id % 4 WHEN 0 THEN 2024 WHEN 1 THEN 2024 WHEN 3 THEN 2024 END AS year FROM events")
def rfc3339(spark, d):
    t = E.rfc3339(F.expr(_STAMP))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), F.unix_seconds(t).alias("seconds"), F.year(F.to_utc_timestamp(t, F.current_timezone())).alias("year"))


_RAW = "(CASE event_id % 5 WHEN 0 THEN 'at 203.0.113.' || (user_id % 200) || ' today' WHEN 1 THEN 'http://evil' || user_id || '.bad/x y' WHEN 2 THEN 'ftp://evil' || user_id || '.bad' WHEN 3 THEN 'host' || user_id || '.exe' ELSE ' host' || user_id || '.bad ' END)"
_KIND = "(CASE event_id % 5 WHEN 0 THEN 'ip' WHEN 1 THEN 'url' WHEN 2 THEN 'url' ELSE 'domain' END)"


@query("SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN '203.0.113.' || (user_id % 200) WHEN 1 THEN 'http://evil' || user_id || '.bad/x' WHEN 4 THEN 'host' || user_id || '.bad' END AS value FROM events")
def ioc_normalize(spark, d):
    return table(spark, d, "events").select(F.col("event_id").alias("id"), E.normalize_ioc(F.expr(_KIND), F.expr(_RAW)).alias("value"))


_VECTORS = {"CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H": 9.8, "CVSS:3.1/AV:N/AC:L/PR:N/UI:R/S:U/C:L/I:N/A:N": 4.3, "CVSS:3.1/AV:L/AC:H/PR:H/UI:N/S:U/C:N/I:N/A:N": 0.0, "7.5": 7.5, "junk": 0.0}


@query(f"SELECT event_id AS id, [{', '.join(str(v) for v in _VECTORS.values())}][CAST(event_id % 5 AS INT) + 1] :: DOUBLE AS score FROM events")
def cvss_base(spark, d):
    text = F.element_at(F.array(*map(F.lit, _VECTORS)), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), E.cvss3_base(text).alias("score"))


# rules and graph export

NETWORK_RULE = {"title": "Suspicious hosts", "logsource": {"category": "network"}, "detection": {"hosts": {"url|contains": ["casino", "bets"]}, "deep": {"url|endswith": ".html", "url|startswith": "https://"}, "known": {"url|contains": "theron"}, "condition": "(hosts or deep) and not known"}}
EVENT_RULE = {"title": "Large errors", "logsource": {"category": "process"}, "detection": {"kind": {"event_type": ["Error", "purchase"]}, "large": {"value|gte": 60.0}, "condition": "kind and large or not kind and not large and vip", "vip": {"user_id": [7, 8]}}}


@query("SELECT page_id, url FROM pages WHERE (contains(lower(url), 'casino') OR contains(lower(url), 'bets') OR (ends_with(lower(url), '.html') AND starts_with(lower(url), 'https://'))) AND NOT contains(lower(url), 'theron')")
def sigma_exec_network(spark, d):
    return rules.hits(NETWORK_RULE, table(spark, d, "pages")).select("page_id", "url")


@query("WITH x AS (SELECT *, event_type IN ('error', 'purchase') AS k, value >= 60 AS l FROM events) SELECT event_id, event_type, value FROM x WHERE (k AND l) OR (NOT k AND NOT l AND user_id IN (7, 8))")
def sigma_exec_not_filter(spark, d):
    return rules.hits(EVENT_RULE, table(spark, d, "events")).select("event_id", "event_type", "value")


@query(f"""WITH {INC}, n AS (SELECT DISTINCT ioc_type, ioc, CAST(('0x' || substr(sha1(ioc), 1, 8)) AS BIGINT) % 9000000 + 1000000 AS sid FROM inc WHERE ioc_type IN ('ip', 'domain') AND ioc IS NOT NULL)
SELECT ioc, sid, CASE ioc_type WHEN 'domain' THEN 'alert dns any any -> any any (msg:"' || ioc || '"; dns.query; content:"' || ioc || '"; nocase; sid:' || sid || '; rev:1;)' ELSE 'alert ip any any -> ' || ioc || ' any (msg:"' || ioc || '"; sid:' || sid || '; rev:1;)' END AS rule FROM n""")
def network_rules(spark, d):
    return rules.network_rules(incidents(spark, d).filter("ioc is not null"))


_OBJECTS = """SELECT 'vulnerability' AS type, upper(cve) AS name FROM inc UNION SELECT 'campaign', campaign FROM inc WHERE campaign <> '' UNION SELECT 'indicator', ioc_type || ':' || ioc FROM inc"""


@query(f"WITH {INC} {_OBJECTS}")
def stix_fanout(spark, d):
    return stix.objects(incidents(spark, d)).select("type", "name")


@query(f"""WITH {INC}, r AS (SELECT DISTINCT ioc_type || ':' || ioc AS source_name, 'indicates' AS relation, campaign AS target_name FROM inc WHERE campaign <> '' UNION SELECT campaign, 'targets', upper(cve) FROM inc WHERE campaign <> ''),
o AS (SELECT name FROM ({_OBJECTS}) WHERE type <> 'campaign' OR name <> 'Campaign 4') SELECT * FROM r WHERE source_name NOT IN (SELECT name FROM o) OR target_name NOT IN (SELECT name FROM o)""")
def stix_dangling(spark, d):
    rows = incidents(spark, d)
    return stix.unresolved(stix.relationships(rows), stix.objects(rows).filter("name <> 'Campaign 4'"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS begins, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def windowed_counts(spark, d):
    counted = upsert.windowed_counts(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    return counted.withColumn("begins", F.col("begins").cast("timestamp_ntz"))


@query(f"WITH {INC} SELECT package, id, start_ts FROM (SELECT *, row_number() OVER (PARTITION BY package ORDER BY start_ts DESC, id DESC) AS n FROM inc) WHERE n = 1")
def keyed_upsert(spark, d):
    rows = incidents(spark, d).select("package", "id", "start_ts").withColumn("o", F.struct("start_ts", "id"))
    half = F.col("id") % 2 == 0
    return upsert.merge(upsert.merge(rows.filter(half).limit(0), rows.filter(half), "package", "o"), rows.filter(~half), "package", "o").drop("o")


from . import records  # noqa: E402, F401  (registers its queries)
from . import more  # noqa: E402, F401
from . import rulebook  # noqa: E402, F401
from . import registry  # noqa: E402, F401
