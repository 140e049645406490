"""Queries of registry anomalies over the driver's tables in the roles of registry rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import typosquat
from ..sources import registries as R
from .catalogue import _listed, query
from .views import PKG, packages, table


@query("""WITH v AS (SELECT 'pkg-' || user_id AS name, 'v' || event_id AS version, epoch_us(ts) AS published, CAST(floor(coalesce(value, 0) * 10000) AS BIGINT) AS size, event_id % 17 = 0 AS hooked FROM events),
w AS (SELECT *, lag(size) OVER (PARTITION BY name ORDER BY published, version) AS previous, row_number() OVER (PARTITION BY name ORDER BY published DESC, version DESC) AS n FROM v)
SELECT name, 'npm' AS ecosystem, CASE WHEN hooked THEN 'install_hook' ELSE 'size_spike' END AS reason FROM w WHERE n = 1 AND (hooked OR (size > 512000 AND size > 3 * previous))""")
def registry_npm(spark, d):
    e = table(spark, d, "events")
    scripts = F.when(F.col("event_id") % 17 == 0, F.create_map(F.lit("prepare"), F.lit("x"))).otherwise(F.create_map(F.lit("test"), F.lit("x")))
    return R.npm(e.select(F.concat(F.lit("pkg-"), "user_id").alias("name"), F.concat(F.lit("v"), "event_id").alias("version"), F.unix_micros(F.col("ts").cast("timestamp")).alias("published"), F.floor(F.coalesce("value", F.lit(0.0)) * 10000).cast("bigint").alias("size"), scripts.alias("scripts")))


_ABOUT = "(CASE doc_id % 9 WHEN 0 THEN ' a Stealer that can EXFIL' WHEN 4 THEN ' keylogger' ELSE '' END)"


@query(f"""WITH u AS (SELECT 'pkg' || doc_id AS name, lower('pkg' || doc_id || ' 1.0 ' || substr(text, 1, 200) || {_ABOUT}) AS t FROM documents), h AS (SELECT name, list_filter([{_listed(R.PYPI_WORDS)}], lambda w: contains(t, w)) AS words FROM u)
SELECT name, 'pypi' AS ecosystem, array_to_string(words, ',') AS reason FROM h WHERE len(words) > 0""")
def registry_words(spark, d):
    docs = table(spark, d, "documents")
    about = F.concat(F.substring("text", 1, 200), F.expr(f"case doc_id % 9 when 0 then ' a Stealer that can EXFIL' when 4 then ' keylogger' else '' end"))
    return R.pypi(docs.select(F.concat(F.lit("pkg"), "doc_id", F.lit(" 1.0")).alias("title"), about.alias("description")))


_CRATES = ["serd", "tokio", "toklo", "hyper-x", "clap2", "zzz", "lo", "dieselx", "axun"]


@query(f"""WITH c AS (SELECT DISTINCT name, about FROM (SELECT event_id, [{_listed(_CRATES)}][CAST(event_id % 9 AS INT) + 1] AS name, CASE event_id % 50 WHEN 7 THEN 'a Backdoor and stealer' ELSE '' END AS about FROM events)), t AS (SELECT name, about, list_filter([{_listed(R.CRATE_WORDS)}], lambda w: contains(lower(name || ' ' || about), w)) AS words,
 list_filter([{_listed(R.CRATE_NAMES)}], lambda k: name <> k AND ((length(k) >= 5 AND levenshtein(name, k) <= 2) OR (length(k) >= 3 AND levenshtein(name, k) = 1))) AS near FROM c)
SELECT name, 'cargo' AS ecosystem, CASE WHEN len(words) > 0 THEN 'keyword ' || words[1] ELSE 'near ' || near[1] END AS reason FROM t WHERE len(words) > 0 OR len(near) > 0""")
def registry_crates(spark, d):
    names = F.element_at(F.array(*map(F.lit, _CRATES)), (F.col("event_id") % 9 + 1).cast("int"))
    return R.crates(table(spark, d, "events").select(names.alias("name"), F.when(F.col("event_id") % 50 == 7, "a Backdoor and stealer").otherwise("").alias("description")).distinct())


@query(f"""WITH e AS (SELECT event_id AS i FROM events) SELECT CASE i % 3 WHEN 0 THEN 'org.apache.' WHEN 1 THEN 'commons-' ELSE 'me.' END || i || ':a' || (i % 10) AS name, 'maven' AS ecosystem, 'namespace' AS reason FROM e WHERE i % 3 < 2 AND i % 4 = 0
UNION ALL SELECT 'n' || i, 'nuget', 'build hook B' || i || '.Targets' FROM e WHERE i % 5 = 0 UNION ALL SELECT 'g' || i, 'rubygems', 'executables' FROM e WHERE i % 6 = 0
UNION ALL SELECT p || i, 'go', 'reserved' FROM (SELECT i, ['golang.org/x', 'google.golang.org/x', 'gopkg.in/go-x', 'github.com/x'][CAST(i % 4 AS INT) + 1] AS p FROM e) WHERE p <> 'github.com/x'
UNION ALL SELECT 'h' || i, 'hex', 'b' || (i % 2) || ' to a' FROM e WHERE i % 7 = 0 UNION ALL SELECT 'c' || i, 'composer', 'hook' FROM e WHERE i % 8 IN (0, 1) UNION ALL SELECT 'p' || i, 'pub', 'publisher' FROM e WHERE i % 9 IN (0, 3, 6)""")
def registry_patterns(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("i"))
    made = [
        R.maven(e.select(F.expr("concat(element_at(array('org.apache.', 'commons-', 'me.'), cast(i % 3 + 1 as int)), i)").alias("group"), F.expr("concat('a', i % 10)").alias("artifact"), F.expr("if(i % 4 = 0, '1', '1.0.0')").alias("version"))),
        R.nuget(e.select(F.expr("concat('n', i)").alias("name"), F.expr("if(i % 5 = 0, array('a.dll', concat('B', i, '.Targets')), array('a.dll'))").alias("entries"))),
        R.rubygems(e.select(F.expr("concat('g', i)").alias("name"), F.expr("if(i % 6 = 0, array('x'), cast(array() as array<string>))").alias("executables"))),
        R.go(e.select(F.expr("concat(element_at(array('golang.org/x', 'google.golang.org/x', 'gopkg.in/go-x', 'github.com/x'), cast(i % 4 + 1 as int)), i)").alias("path"))),
        R.hex_pm(e.select(F.expr("concat('h', i)").alias("name"), F.expr("array(named_struct('publisher', 'a'), named_struct('publisher', if(i % 7 = 0, concat('b', i % 2), 'a')))").alias("releases"))),
        R.packagist(e.select(F.expr("concat('c', i)").alias("name"), F.expr("case i % 8 when 0 then '{\"post-install-cmd\": 1}' when 1 then '{\"Post-Root-Package-Install\": 1}' else '{\"require\": 1}' end").alias("composer"))),
        R.pub(e.select(F.expr("concat('p', i)").alias("name"), F.expr("element_at(array('a.xyz', 'b.com', 'c.dev', 'd.online', 'e.org', 'f.net', 'G.SPACE', 'h.io', 'i.co'), cast(i % 9 + 1 as int))").alias("publisher"))),
    ]
    return reduce(DataFrame.unionByName, made)


@query("SELECT DISTINCT 'actions/a' || user_id AS name, 'v1' AS tag, 'old' || user_id AS old, 'new' || user_id AS sha, 'critical' AS severity FROM events WHERE user_id % 4 = 0")
def moved_tags(spark, d):
    e = table(spark, d, "events").select("user_id").distinct()
    current = e.select(F.concat(F.lit("actions/a"), "user_id").alias("name"), F.lit("v1").alias("tag"), F.expr("concat(if(user_id % 4 < 2, 'new', 'old'), user_id)").alias("sha"))
    stored = e.filter("user_id % 4 <> 1").select(F.concat(F.lit("actions/a"), "user_id").alias("name"), F.lit("v1").alias("tag"), F.concat(F.lit("old"), "user_id").alias("sha"))
    return R.changed_tags(current, stored)


@query(f"""WITH {PKG}, a AS (SELECT DISTINCT ecosystem, replace(lower(name), ' ', CASE WHEN length(name) % 2 = 0 THEN '' ELSE '-' END) AS name, weekly FROM pkg), q AS (SELECT DISTINCT ecosystem, CASE length(name) % 4 WHEN 0 THEN replace(name, 'o', '0') WHEN 1 THEN substr(name, 2) WHEN 2 THEN 'x' || substr(name, 2) ELSE name || '-js' END AS name FROM a),
s AS (SELECT x.ecosystem, x.name, y.name AS target, y.weekly, levenshtein(x.name, y.name) AS d, translate(x.name, '01345', 'oleas') AS f, translate(y.name, '01345', 'oleas') AS g,
 starts_with(x.name, y.name || '-') OR ends_with(x.name, '-' || y.name) OR starts_with(y.name, x.name || '-') OR ends_with(y.name, '-' || x.name) AS added FROM q x JOIN a y ON x.ecosystem = y.ecosystem AND x.name <> y.name),
m AS (SELECT *, CASE WHEN f = g THEN 0.99 WHEN added THEN 0.85 WHEN greatest(length(name), length(target)) >= 4 AND ((length(target) >= 5 AND d <= 2) OR (length(target) >= 4 AND d = 1)) THEN round(1 - d / greatest(length(name), length(target)), 12) ELSE 0 END AS score FROM s),
t AS (SELECT *, row_number() OVER (PARTITION BY ecosystem, name ORDER BY score DESC, weekly DESC, target) AS r FROM m WHERE score >= 0.8)
SELECT ecosystem, name, target, round(score, 6) AS score, CASE WHEN f = g THEN 'homoglyph' WHEN added THEN 'addition' WHEN d = 1 AND length(name) <> length(target) THEN 'omission' WHEN d = 2 AND length(name) = length(target) AND len(list_filter(range(1, length(name) + 1), lambda i: substr(name, i, 1) <> substr(target, i, 1))) = 2 THEN 'swap' ELSE 'substitution' END AS technique FROM t WHERE r = 1""")
def typosquat_technique(spark, d):
    popular = packages(spark, d).select("ecosystem", F.when(F.length("name") % 2 == 0, F.regexp_replace(F.lower("name"), " ", "")).otherwise(F.regexp_replace(F.lower("name"), " ", "-")).alias("name"), "weekly").distinct()
    new = popular.select("ecosystem", F.expr("case length(name) % 4 when 0 then replace(name, 'o', '0') when 1 then substring(name, 2) when 2 then concat('x', substring(name, 2)) else concat(name, '-js') end").alias("name")).distinct()
    return typosquat.best_matches(new, popular).drop("weekly")
