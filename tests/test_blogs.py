"""Readers of blogs, knowledge bases and state on small pages, files and tables."""

import json

import pytest
from pyspark.sql import functions as F

from lodewerk.sources import blogs as B
from lodewerk.sources import knowledge as N
from lodewerk.sources import landed
from lodewerk.streaming import state as S

H = "ab" * 32


def rows(name, page):
    return [r[:3] for r in B.PARSERS[name](page)]


def test_socket_sections():
    page = f"""<h2>Intro</h2><p>evil[.]bad</p><h2>Indicators of Compromise (IOCs)</h2><h3>File Hashes</h3><p><b>drop.js</b></p><pre>- SHA256 {H}
SHA1: {'c' * 40}</pre><h3>Network Indicators</h3><p>hxxps://c2[.]bad/x y</p><p>203.0.113.7</p><p>fine.example do not block</p><h2>Attribution</h2><p>Campaign: Silent Wolf</p>"""
    assert rows("socket", page) == [("sha256", H, "drop.js"), ("sha1", "c" * 40, "drop.js"), ("url", "https://c2.bad/x", ""), ("ip", "203.0.113.7", ""), ("campaign_marker", "Silent Wolf", "")]


def test_labels_say_what_items_are():
    page = f"""<h2>Indicators Of Compromise</h2><p><strong>Files</strong></p><ul><li>setup.mjs: {H}</li><li>other.js</li></ul><p><b>Network</b></p><ul><li>c2[.]bad</li></ul><h3>Packages</h3><ul><li>github:a/b</li><li>left-pad</li></ul><h2>End</h2><ul><li>no[.]more</li></ul>"""
    assert rows("aikido", page) == [("sha256", H, "setup.mjs"), ("file_name", "other.js", ""), ("domain", "c2.bad", ""), ("git_dep", "github:a/b", ""), ("package", "left-pad", "")]
    assert rows("aikido", "<ul><li>c2[.]bad</li></ul>") == []
    assert rows("stepsecurity", f"<h2>x</h2><h3>IOC list</h3><ul><li>{H}</li></ul>") == [("sha256", H, "")]


def test_wiz_and_rule_names():
    page = f"<h2>Indicators of compromise</h2><h3>left-pad</h3><table><tr><td>C2 domain</td><td>c2[.]bad</td></tr><tr><td>a.js</td><td>{H}</td></tr></table><p>also d[.]bad</p>"
    assert list(B.wiz(page)) == [("domain", "c2.bad", "", "left-pad"), ("sha256", H, "a.js", "left-pad"), ("domain", "d.bad", "", "left-pad")]
    assert rows("elastic_labs", "<pre>rule Evil_One { strings: }</pre>") == [("yara_rule", "Evil_One", "")]
    assert all(not list(f("")) and not list(f("<h2>Indicators of compromise")) for f in B.PARSERS.values())


def test_from_pages_to_drafts(spark):
    pages = spark.createDataFrame([("u1", f"<h2>Indicators of compromise</h2><p><b>Files</b></p><ul><li>x {H}</li><li>x {H}</li></ul>"), ("u2", "<p>nothing</p>"), ("u3", None)], "url string, html string")
    found = B.parse(pages, "aikido")
    assert [(r.url, r.type, r.value) for r in found.collect()] == [("u1", "sha256", H)]
    assert B.parse(pages, "talos").columns == found.columns
    posts = pages.select("url", F.lit("A Title").alias("title"), F.lit(None).cast("timestamp").alias("published"))
    packages = spark.createDataFrame([("u3", "npm", "x", "1")], "url string, ecosystem string, name string, version string")
    made = {r.references[0]: r for r in B.drafts(posts, found, packages, "aikido").collect()}
    assert set(made) == {"u1", "u3"} and made["u1"].id.startswith("aikido-a-title-") and made["u3"].iocs is None
    both = B.merge_packages(packages, spark.createDataFrame([("u3", "NPM", "X", "2"), ("u3", "npm", "y", "")], "url string, ecosystem string, name string, version string"))
    assert sorted((r.name, r.version) for r in both.collect()) == [("x", "1"), ("y", "")]


def test_feeds_are_routed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("""<rss><channel><item><title>New npm backdoor</title><description>d</description><link>l1</link><pubDate>Mon, 01 Jan 2024 00:00:00 +0000</pubDate><category>Ransomware</category></item>
<item><title>Old npm news</title><link>l2</link><pubDate>Sun, 01 Jan 2023 00:00:00 +0000</pubDate></item><item><title>npm webinar</title><link>l3</link></item></channel></rss>""")
    posts = B.feed_posts(spark, f"{tmp_path}/feed.xml", "2023-06-01")
    assert sorted(r.link for r in posts.collect()) == ["l1", "l3"]
    rules = [{"module": "supply", "include": ("npm",)}, {"module": "ransomware", "include": ("ransom",), "exclude": ("webinar",)}, {"module": "cve", "include": ("cve-",)}]
    routed = B.route(posts, rules, ("webinar",))
    assert sorted((r.link, r.module) for r in routed.collect()) == [("l1", "ransomware"), ("l1", "supply")]
    assert {r.id for r in B.post_drafts(routed, "Talos").collect()} == {"supply-draft-talos-new-npm-backdoor", "ransomware-draft-talos-new-npm-backdoor"}
    assert [r.ok for r in posts.select(B.relevant(F.col("title"), F.col("description"), exclude=("webinar",)).alias("ok")).collect()] == [True, False]


def test_os_packages(spark):
    affected = spark.createDataFrame([("Alpine 3.20", "a", "CVE-1"), ("alpine 3.19", "b", "cve-1"), ("Red Hat CPE", "c", "CVE-1"), ("Wolfi", "d", "CVE-2"), ("Red Hat 9", "e", "CVE-2")], "bucket string, package string, cve string")
    meta = spark.createDataFrame([("CVE-1", "x", "high", "2024-01-01T00:00:00Z", 9.1, 5.0), ("CVE-9", "y", "low", None, None, 4.0)], "cve string, description string, severity string, last_modified string, cvss3 double, cvss2 double")
    got = {r.cve: r for r in N.os_packages(affected, meta).collect()}
    assert got["CVE-1"].file_names == ["alpine:3.19", "alpine:3.20", "red hat cpe:"] and got["CVE-1"].cvss == 9.1 and got["CVE-1"].id == "trivy-cve1"
    assert got["CVE-2"].file_names == ["redhat/ubi9:9", "wolfi:"] and got["CVE-2"].cvss == 0.0
    assert [r.cve for r in N.os_packages(affected, meta, "2025-01-01").collect()] == ["CVE-2"]


def test_ends_of_life_and_popular(spark):
    cycles = spark.createDataFrame([("python", "3.7", "2023-06-27"), ("python", "3.12", "2028-10-31"), ("node", "18", "false")], "product string, cycle string, eol string")
    uses = spark.createDataFrame([(1, "python", "3.7.4"), (2, "python", "3.12.1"), (3, "node", "18"), (4, "perl", "5.8.1"), (5, None, None)], "n int, product string, version string")
    got = {r.n: (r.ended, r.end) for r in N.at_end_of_life(uses, cycles, F.lit("2024-01-01")).collect()}
    assert got == {1: (True, "2023-06-27"), 2: (False, "2028-10-31"), 3: (False, ""), 4: (False, ""), 5: (False, "")}
    top = N.popular_packages(spark.createDataFrame([("a", 5_200_000), ("b", 52), ("c", None)], "name string, total bigint"), "nuget", 2)
    assert [(r.name, r.weekly, r.impact) for r in top.collect()] == [("a", 100_000, "high"), ("b", 1, "negligible")]
    assert N.popular_packages(uses.withColumn("name", F.lit("x")), "maven").count() == 0


def test_landed_knowledge(spark, tmp_path):
    (tmp_path / "t.json").write_text(json.dumps({"name": "CVE-2024-1", "document": "d", "score": 3.2, "created": "2024-01-01T00:00:00Z"}))
    (r,) = landed.read(spark, "attackerkb", f"{tmp_path}/t.json").collect()
    assert (r.id, r.severity, r.exploited) == ("attackerkb-cve-2024-1", "high", True)
    (tmp_path / "v.json").write_text(json.dumps({"id": "SNYK:1", "title": "t", "packageName": "p", "version": "<2", "severity": "odd", "publicationTime": "2024-01-01T00:00:00Z", "references": [{"url": ""}, {"url": "u"}]}))
    (r,) = landed.read(spark, "snyk", f"{tmp_path}/v.json").collect()
    assert (r.id, r.severity, r.references) == ("snyk-snyk-1", "low", ["u"]) and r.packages[0].affected_versions == ["<2"]
    assert landed.read(spark, "snyk", f"{tmp_path}/v.json", "2025-01-01").count() == 0
    with pytest.raises(KeyError):
        landed.read(spark, "nobody", "x")


def test_packages_are_looked_up(spark):
    advisories = spark.createDataFrame([("a1", [("x", "npm", None)]), ("a2", [("y", "npm", None), ("x", "npm", None)]), ("a3", [("z", "npm", None)])], "id string, packages array<struct<name:string,ecosystem:string,affected_versions:array<string>>>").withColumn("published", F.lit(None).cast("timestamp"))
    wanted = spark.createDataFrame([("NPM", "x"), ("npm", "x"), ("npm", "q")], "ecosystem string, name string")
    assert sorted(r.id for r in N.enrich_packages(wanted, advisories).collect()) == ["a1", "a2"]


def test_cursors_and_tokens(spark):
    cursors = spark.createDataFrame([("cve", "2024-01-01T00:00:00Z"), ("supply", "2024-02-01T00:00:00Z")], "module string, cursor string")
    modules = spark.createDataFrame([("cve",), ("malware",)], "module string")
    assert {(r.module, r.since) for r in S.since(modules, cursors).collect()} == {("cve", "2024-01-01T00:00:00Z"), ("malware", S.EPOCH)}
    assert {r.since for r in S.since(modules, cursors, "2020").collect()} == {"2020"}
    runs = spark.createDataFrame([("cve", True, 0), ("supply", True, 1), ("malware", False, 0)], "module string, persisted boolean, errors int")
    assert {(r.module, r.cursor) for r in S.commit(cursors, runs, "2024-03-01").collect()} == {("cve", "2024-03-01"), ("supply", "2024-02-01T00:00:00Z")}
    assert {r.cursor for r in S.commit(cursors, runs, "2024-03-01", "2020").collect()} == {"2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"}
    kinds = "source string, sequence bigint, etag string, commit string, seen string"
    old, new = spark.createDataFrame([("npm", 9, "e1", None, "1"), ("pypi", None, "p", None, "1")], kinds), spark.createDataFrame([("npm", 7, None, "c", "2")], kinds)
    assert {tuple(r) for r in S.merge_tokens(old, new).collect()} == {("npm", 9, "e1", "c", "2"), ("pypi", None, "p", None, "1")}
    cache = spark.createDataFrame([("a", "2024-01-01"), ("b", "2023-01-01"), ("c", None)], "value string, fetched string").withColumn("fetched", F.col("fetched").cast("timestamp"))
    assert [r.value for r in S.expire(cache, F.lit("2024-01-05"), 7).collect()] == ["a"]


def test_look_ups_are_saved_as_they_go(spark, tmp_path):
    spark.createDataFrame([("ip", "1"), ("ip", "1"), ("ip", "2")], "type string, value string").write.json(f"{tmp_path}/in")
    source = spark.readStream.schema("type string, value string").json(f"{tmp_path}/in")
    S.look_up_stream(source, f"{tmp_path}/cache", lambda keys: keys.withColumn("info", F.concat(F.lit("i"), "value")), f"{tmp_path}/check").awaitTermination()
    assert sorted((r.value, r.info) for r in spark.read.parquet(f"{tmp_path}/cache").collect()) == [("1", "i1"), ("2", "i2")]
