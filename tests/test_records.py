"""Entities, attribution, names, rules and dialects against plain Python on small inputs."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from lodewerk.functions import gates as G
from lodewerk.functions import words as W
from lodewerk.operators import actors, bundles, dialects, entities, generate, resolve, rules, typosquat


def test_names_two_edits_apart_meet(spark):
    r = random.Random(1)
    names = {"".join(r.choice("abc") for _ in range(r.randrange(1, 14))) for _ in range(120)} | {"é1", "é12", "日本語", "日本"}
    d = spark.createDataFrame([(x,) for x in names], "a string")
    met = d.select("a", F.explode(typosquat.probe_keys(F.col("a"))).alias("k")).join(d.select(F.col("a").alias("b"), F.explode(typosquat.segment_keys(F.col("a"))).alias("k")), "k")
    got = {(x.a, x.b) for x in met.filter("levenshtein(a, b) <= 2").distinct().collect()}

    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, old = [i], row
            for j, k in enumerate(y, 1):
                row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (c != k)))
        return row[-1]

    assert got == {(x, y) for x, y in itertools.product(names, names) if abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2}


def test_events_have_the_components_of_all_pairs(spark):
    r = random.Random(2)
    rows = [(i, 86_400 * r.randrange(60), r.choice(["wiz", "socket", "osv"]), r.choice(["", "", "", f"C{r.randrange(9)}"]), sorted({f"v{r.randrange(60)}" for _ in range(r.randrange(4))}), r.choice([None, f"P{r.randrange(60)}"])) for i in range(120)]
    inc = spark.createDataFrame([(i, t, s, c) for i, t, s, c, _, _ in rows], "id bigint, t bigint, source string, campaign string").withColumn("start_ts", F.timestamp_seconds("t"))
    values = spark.createDataFrame([(i, "domain", v) for i, *_, vs, _ in rows for v in vs] + [(0, "domain", None)], "id bigint, type string, value string")
    packages = spark.createDataFrame([(i, "npm", p) for i, *_, p in rows], "id bigint, ecosystem string, name string")
    got = {x.id: x.component for x in resolve.components(inc, entities.event_edges(inc, packages, values)).collect()}
    parent = {i: i for i, *_ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(rows, 2):
        near = abs(a[1] - b[1]) <= 7 * 86_400
        shared = len(set(a[4]) & set(b[4]))
        need = 1 if {a[2], b[2]} <= set(resolve.TRUSTED) else 2
        if (a[3] and a[3] == b[3]) or (a[5] and a[5] == b[5]) or (near and shared >= need):
            x, y = sorted((root(a[0]), root(b[0])))
            parent[y] = x
    assert got == {i: root(i) for i in parent}


@pytest.mark.parametrize("brought", [False, True])
def test_shared_indicators_of_odd_rows(spark, brought):
    """Missing times and sources, repeated indicators, one indicator in several stretches of time, gaps of a week to the microsecond."""
    r = random.Random(4)
    week = 7 * 86_400_000_000
    rows = [(i, r.choice([None, 0, week, week + 1, 3 * week, r.randrange(4 * week)]), r.choice(["wiz", "socket", "osv", "", None]), [r.choice("uvwxyzUV") + str(r.randrange(8)) for _ in range(r.randrange(5))]) for i in range(90)]
    inc = spark.createDataFrame([(i, t, s) for i, t, s, _ in rows], "id bigint, t bigint, source string").selectExpr("id", "timestamp_micros(t) as start_ts", "source", "'' as campaign")
    values = spark.createDataFrame([(i, "domain", v) for i, *_, vs in rows for v in vs] + [(None, "domain", "u1"), (1, "domain", ""), (2, "domain", None)], "id bigint, type string, value string")
    if brought:
        values = values.join(inc.select("id", "start_ts", "source"), "id", "left")
    packages = spark.createDataFrame([], "id bigint, ecosystem string, name string")
    edges = {tuple(sorted((x.src, x.dst))) for x in entities.event_edges(inc, packages, values).collect()}
    low = {i: {v.lower() for v in vs} for i, *_, vs in rows}
    pairs = {
        (a[0], b[0])
        for a, b in itertools.combinations(rows, 2)
        if None not in (a[1], b[1]) and abs(a[1] - b[1]) <= week and len(low[a[0]] & low[b[0]]) >= (1 if {a[2], b[2]} <= set(resolve.TRUSTED) else 2)
    }
    assert edges <= pairs  # no edge that isn't a pair, and the same components

    def least(some):
        name = {i: i for i, *_ in rows}
        while (new := {i: min([name[i], *(name[b if a == i else a] for a, b in some if i in (a, b))]) for i in name}) != name:
            name = new
        return name

    assert least(edges) == least(pairs)


def test_three_records_of_one_package(spark):
    """The worst severity, both references, a domain that two sources have, an address that one has."""
    inc = spark.createDataFrame([(1, 1, "wiz", "high", "short", "", "", ""), (2, 1, "osv", "critical", "a longer text", "OSV-1", "", "Camp"), (3, 3, "nvd", "odd", "x", "", "G", "")], "component int, id int, source string, severity string, description string, osv_id string, ghsa_id string, campaign string")
    inc = inc.selectExpr("id as component", "component as id", "source", "severity", "description", "osv_id", "ghsa_id", "campaign")
    got = {r.component: r for r in entities.fields(inc).collect()}
    assert (got[1].severity, got[1].description, got[1].sources, got[1].osv_id, got[1].campaign, got[1].members, got[1].base_id) == ("critical", "a longer text", "wiz,osv", "OSV-1", "Camp", 2, 1)
    assert got[1].confidence == 0.98 and got[3].severity == "medium"
    assert entities.best_of_groups(entities.fields(inc)).first().component == 1
    io = spark.createDataFrame([(1, 1, 0, "domain", "Evil.bad", "wiz", 0.9), (1, 2, 0, "domain", "evil.bad", "osv", 0.95), (1, 2, 1, "ip", "203.0.113.1", "osv", 0.5), (1, 2, 2, "ip", None, "osv", 0.5)], "component int, id int, pos int, type string, value string, source string, confidence double")
    assert {(r.type, r.value, r.sources, r.confidence, r.n) for r in entities.indicators(io).collect()} == {("domain", "Evil.bad", "wiz,osv", 0.98, 2), ("ip", "203.0.113.1", "osv", 0.5, 1)}


def test_aliases_in_parts(spark):
    texts = spark.createDataFrame([(1, "the ZINC oxide"), (2, "zincoxide"), (3, "by Lazarus-Group now"), (4, None), (5, ""), (6, "apt28 apt2 x_zinc")], "id bigint, text string")
    aliases = actors.alias_index(spark.createDataFrame([("z", "Zinc", ["APT2"]), ("l", "Lazarus-Group", None), ("x", "", ["apt28"]), ("y", "Zinc", [])], "slug string, name string, aliases array<string>"))
    want = {(1, "z"), (3, "l"), (6, "z"), (6, "x")}
    for most in (1, 1 << 20):
        assert {tuple(r) for r in actors.text_matches(texts, aliases, most).collect()} == want
    assert actors.text_matches(texts, aliases.limit(0)).count() == 0


RULE = {"title": "A rule", "id": "12345678-9abc-5def-8123-456789abcdef", "level": "high", "tags": ["attack.t1059", "attack.initial_access"], "logsource": {"category": "network_connection"}, "detection": {"sel": {"DestinationHostname|contains": ["evil.bad", "c2.bad"], "DestinationIp": "203.0.113.9"}, "out": {"Image|endswith": "\\ok.exe"}, "condition": "sel and not out"}}


def test_dialects():
    made = {d: f(RULE) for d, f in dialects.COMPILERS.items()}
    assert json.loads(made["sentinel"])["properties"]["tactics"] == ["InitialAccess"] and json.loads(made["sentinel"])["properties"]["severity"] == "High"
    assert 'level="12"' in made["wazuh"] and 'negate="yes"' in made["wazuh"] and "evil\\.bad|c2\\.bad" in made["wazuh"]
    assert made["chronicle"].startswith("rule a_rule_89abcdef {") and "ok" not in made["chronicle"]
    assert made["suricata"].count("alert dns") == 2 and made["suricata"].count("alert ip") == 1 and f"sid:{0x12345678 % 9_000_000 + 1_000_000};" in made["suricata"]
    assert made["snort"].count("alert tcp") == made["snort"].count("alert udp") == 2
    assert [(i["type"], i["value"]) for i in json.loads(made["falcon"])["indicators"]] == [("domain", "evil.bad"), ("domain", "c2.bad"), ("ipv4", "203.0.113.9")]
    assert "has_any" in made["kql"] and "ILIKE" in made["aql"] and "-(" in made["datadog"]
    with pytest.raises(ValueError):
        rules.translate({"title": "x", "detection": {"s": {"a|re": "b.*"}, "condition": "s"}}, "splunk")
    assert "a >= 3" in rules.translate({"title": "x", "detection": {"s": {"a|gte": 3}, "condition": "s"}}, "kql")
    with pytest.raises(ValueError):
        rules.predicate({"title": "x", "detection": {"s": {"a": 1}, "condition": "1 of t*"}})


def test_every_template_compiles_and_runs(spark):
    """All selections of all templates as predicates over an event table, and in every dialect that can say them."""
    inc = spark.createDataFrame([(1, "malware", "high", 9.8, True, True, "fam", "CVE-1", True)], "id bigint, module string, severity string, cvss double, exploited boolean, ransomware boolean, family string, cve string, sure boolean")
    for name in generate.ARRAYS:
        value = {"domains": "evil.bad", "ips": "203.0.113.9", "urls": "http://evil.bad/x", "hashes": "SHA256=ab"}.get(name, f"{name}1")
        inc = inc.withColumn(name, F.array(*map(F.lit, generate.BEHAVIOURS)) if name == "behaviours" else F.array(F.lit(value)))
    made = generate.rules(inc)
    got = made.collect()
    assert len(got) == len(generate.TEMPLATES) - 4 + len(generate.BEHAVIOURS) and len({r.rule_id for r in got}) == len(got)
    for r in got:
        detection = {"condition": r.condition}
        for x in r.fields:
            detection.setdefault(x.selection, {})[x.field] = list(x["values"])
        columns = {k.split("|")[0] for s, f in detection.items() if s != "condition" for k in f}
        events = spark.range(1).select(*(F.lit("nothing").alias(c) for c in columns))
        if not any("-" in c for c in columns):
            assert events.filter(rules.predicate({"title": "t", "detection": detection})).count() == 0
    by = {(r.dialect): r.n for r in dialects.compiled(made).groupBy("dialect").agg(F.count("*").alias("n")).collect()}
    assert set(by) == set(dialects.DEFAULT) and by["kql"] == len(got)
    assert "1 of selection_*" in {r.condition for r in got}
    assert generate.rules(inc.withColumn("module", F.lit("ransomware")).withColumn("sure", F.lit(False)).withColumn("cvss", F.lit(None).cast("double")).withColumn("exploited", F.lit(None).cast("boolean"))).filter("layer in ('ransomware', 'ioc', 'container')").count() == 0
    text = generate.rendered(made).filter("subtype = 'network'").first().text
    assert "condition: selection_domain or selection_ip or selection_url" in text and "      - 'evil.bad'" in text
    assert rules.predicate(generate.unpinned_action("a/b")) is not None


def test_bundles(spark):
    inc = spark.createDataFrame([(1, "ransomware", "OSV-1", "", "Camp", "lazarus", "high", "d"), (2, "x", "", "", "", "", None, None)], "id bigint, attack_type string, osv_id string, ghsa_id string, campaign string, actor string, level string, description string")
    io = spark.createDataFrame([(1, "domain", "it's.bad", 0.579), (1, "ip", "::1", 1.0), (1, "file_name", "x.exe", 0.1), (1, "odd", "y", 0.1), (2, "sha256", "ab", None)], "id bigint, type string, value string, confidence double")
    techniques = spark.createDataFrame([(1, "T1195.002", "Supply")], "id bigint, technique string, name string")
    profiles = spark.createDataFrame([("lazarus", "Lazarus", "about")], "slug string, name string, description string")
    made = bundles.objects(inc, io, techniques, profiles)
    assert bundles.invalid(made).count() == 0
    patterns = {r.pattern: r.confidence for r in made.filter("type = 'indicator'").collect()}
    assert patterns == {"[domain-name:value = 'it\\'s.bad']": 57, "[ipv6-addr:value = '::1']": 100, "[file:name = 'x.exe']": 70, "[file:hashes.'SHA-256' = 'ab']": 0}
    assert made.filter("type = 'malware'").first().kind == "ransomware" and made.filter("type = 'campaign'").first().confidence == 85
    assert {r.bundle for r in bundles.invalid(made.filter("type <> 'campaign'")).collect()} == {"1"}
    assert bundles.once(made).filter("type = 'identity'").count() == 1
    docs = [json.loads(r.json) for r in bundles.documents(made, "2024-01-01T00:00:00Z").collect()]
    assert all(d["spec_version"] == "2.1" and d["created"] == "2024-01-01T00:00:00Z" for d in docs) and {"relationship_type", "source_ref"} <= set(next(d for d in docs if d["type"] == "relationship"))


def test_gates_and_words_on_odd_values(spark):
    rows = spark.createDataFrame([(None,), ("",), ("1.2.3.4",), ("256.1.1.1",), ("01.2.3.4",), ("2001:db8::1",), ("a.b",), ("Ab.com",), ("x.toolongtld" + "d" * 30,), ("evil-host.net",), ("e:vil.net",)], "v string")
    assert [tuple(r) for r in rows.select(G.is_ip(F.col("v")), G.feed_domain(F.col("v"))).collect()] == [(False, False), (False, False), (True, False), (False, False), (False, False), (True, False), (False, False), (False, False), (False, False), (False, True), (False, False)]
    one = spark.range(1)
    assert one.select(W.truncate(F.lit("añb"), 2, "...")).first()[0] == "a..." and one.select(W.truncate(F.lit("añb"), 3)).first()[0] == "añ"
    assert one.select(W.plain_slug(F.lit("A ñ-b"))).first()[0] == "a----b" and one.select(W.id_slug(F.lit("-A  ñ b-"))).first()[0] == "a-b"
    assert one.select(W.rule_name(F.lit("My: Rule!"), F.lit("aa-bb12345678"))).first()[0] == "my_rule_12345678" and one.select(W.rule_name(F.lit("!"), F.lit("x"))).first()[0] == "rule_x"
    assert one.select(W.campaign_name(F.lit("Attribution: campaign: Silent Wolf, again"))).first()[0] == "Silent Wolf"
    assert one.select(W.embedded_id(F.lit("x\nIncident: lw-1\ty"))).first()[0] == "lw-1" and one.select(W.embedded_category(F.lit("a:\n  category: dns\n"))).first()[0] == "dns"
    assert one.select(W.actor_type(F.lit("A State-Sponsored group"))).first()[0] == "nation-state" and one.select(W.actor_type(F.lit(None).cast("string"))).first()[0] == "unknown"


def test_rules_of_one_shape_are_read_once(spark, monkeypatch):
    """Texts as each compiler makes them of a plain rule, columns that are kept, one translation for many rules and few shapes remembered."""
    rows = [(i, "l", "s", f"0000000{i % 10}-9abc-5def-8123-456789abcdef", "dns" if i % 2 else "process", "any", "a and not b", [("a", "DestinationHostname|contains", [f"h{i % 3}é\"", "x"]), ("b", "Image", ["y"]), ("a", "z|re" if i % 5 == 0 else "z", ["q"])], "high") for i in range(300)]
    made = spark.createDataFrame(rows, "incident_id bigint, layer string, subtype string, rule_id string, category string, product string, condition string, fields array<struct<selection: string, field: string, values: array<string>>>, level string").coalesce(1)
    want = []
    for i, layer, subtype, rule_id, category, product, condition, fields, level in rows:
        detection = {"condition": condition}
        for s, f, v in fields:
            detection.setdefault(s, {})[f] = v
        for d in dialects.COMPILERS:
            if d not in dialects.ONLY_NETWORK or category in dialects.NETWORK:
                try:
                    text = dialects.COMPILERS[d]({"title": f"{layer} {subtype} {i}", "id": rule_id, "level": level, "logsource": {"category": category, "product": product}, "detection": detection})
                except ValueError:
                    continue
                want += [(rule_id, d, text, i)] if text else []
    for most in (1, 4096):
        monkeypatch.setattr(dialects, "MAX_SHAPES", most)
        assert sorted(map(tuple, dialects.compiled(made, tuple(dialects.COMPILERS), ("incident_id",)).collect())) == sorted(want)
    calls = []
    monkeypatch.setattr(dialects.R, "translate", lambda rule, d: calls.append(d) or "x")
    shared = dialects.Detection({"condition": "a", "a": {"f": ["v"]}})
    for _ in range(3):
        assert dialects.COMPILERS["kql"]({"title": "t", "detection": shared}) == "x"
        dialects.sentinel({"title": "t", "detection": shared})
    assert calls == ["kql"]


def test_aliases_in_slices_of_a_batch(spark, monkeypatch):
    """Every text of a batch is read, whatever the slices in which it is held."""
    texts = spark.range(7, numPartitions=1).select("id", F.when(F.col("id") != 4, F.concat(F.lit("by ZINC and Lazarus-Group "), "id")).alias("text"))
    aliases = spark.createDataFrame([("zinc", "z"), ("lazarus-group", "l")], "alias string, slug string")
    for size in (1, 3, 7, 256):
        monkeypatch.setattr(actors, "SLICE", size)
        assert sorted(map(tuple, actors.text_matches(texts, aliases).collect())) == [(i, s) for i in range(7) if i != 4 for s in "lz"]


def test_ids_of_ids_stay_small(spark):
    """A relationship's id has two ids in it: its hash is named a few times only, and it is that of Python."""
    import uuid

    seed = F.concat_ws(":", bundles.stix_id("indicator", F.col("v")), F.lit("indicates"), bundles.stix_id("campaign", F.col("v")))
    made = spark.createDataFrame([("é1",), ("",), (None,)], "v string").select("v", bundles.stix_id("relationship", seed).alias("id"))
    assert made._jdf.queryExecution().analyzed().toString().count("sha1(") < 20

    def of(kind, x):
        return f"{kind}--{uuid.uuid5(uuid.NAMESPACE_URL, f'{bundles.NAMESPACE}{kind}:{x}')}"

    got = {r.v: r.id for r in made.collect()}
    assert all(got[v] == of("relationship", f"{of('indicator', v)}:indicates:{of('campaign', v)}") for v in ("é1", ""))
    assert got[None] == of("relationship", "indicator--:indicates:campaign--")


def test_both_ends_meet_what_is_known_at_once(spark):
    """Ends that are null, in another bundle only, or the relationship itself; one join and no object made twice for it."""
    def row(bundle, id, source, target):
        return (bundle, id, "relationship", "uses", source, target)

    rows = [("1", "a", "x", None, None, None), ("2", "b", "x", None, None, None), row("1", "r", "a", "b"), row("1", "r", "a", "b"), row("2", "s", None, "s"), row(None, "t", "t", "a")]
    made = spark.createDataFrame(rows, "bundle string, id string, type string, relation string, source_ref string, target_ref string").selectExpr("*", "'n' as name", "'p' as pattern", "'k' as kind")
    near, far = (sorted((tuple(r) for r in bundles.invalid(made, w).filter("problem <> 'bad id'").collect()), key=repr) for w in (("bundle",), ()))
    lost = [("1", "r", "target_ref unknown")] * 2 + [("2", "s", "source_ref unknown")]
    assert near == sorted([*lost, (None, "t", "source_ref unknown"), (None, "t", "target_ref unknown")], key=repr) and far == [("2", "s", "source_ref unknown")]
    assert bundles.invalid(made)._jdf.queryExecution().optimizedPlan().toString().count("LeftAnti") == 1


def test_no_task_makes_the_objects_of_all_incidents(spark):
    """Rows that lie in one partition: their objects come from many, and each counts once."""
    inc = spark.range(0, 4000, numPartitions=1).selectExpr("id", "'x' as attack_type", "concat('OSV-', id) as osv_id", "'' as ghsa_id", "'Camp' as campaign", "'lazarus' as actor", "'high' as level", "'d' as description")
    io = inc.selectExpr("id", "'domain' as type", "concat(id, '.bad') as value", "0.5D as confidence")
    profiles = spark.createDataFrame([("lazarus", "Lazarus", "about")], "slug string, name string, description string")
    made = bundles.objects(inc, io, inc.filter("id % 2 = 0").selectExpr("id", "'T1195' as technique", "'Supply' as name"), profiles)
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # what puts small tables in one place
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        most = {r.type: r.n for r in made.groupBy("type", F.spark_partition_id()).count().groupBy("type").agg(F.max("count").alias("n")).collect()}
    finally:
        for k in off:
            spark.conf.unset(k)
    assert max(most[t] for t in ("identity", "indicator", "campaign", "vulnerability")) < 1000
    assert {r.type: r.n for r in bundles.once(made).groupBy("type").agg(F.count("*").alias("n")).collect()} == {"identity": 1, "vulnerability": 4000, "campaign": 1, "malware": 1, "threat-actor": 1, "intrusion-set": 1, "attack-pattern": 1, "indicator": 4000, "relationship": 4004}
