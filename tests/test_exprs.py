import random
import uuid

import pytest
from pyspark.sql import functions as F

from lodewerk.functions import exprs as E
from lodewerk.operators import index, links, resolve, rules, typosquat
from lodewerk.operators.components import connected_components
from lodewerk.streaming import upsert


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("sources", "score"), [([], 0.30), (["osv"], 0.95), (["corvus", "snyk"], 0.86), (["osv", "ghsa"], 0.98), (["nobody"], 0.0)])
def test_confidence(spark, sources, score):
    assert one(spark, E.confidence(F.array(*map(F.lit, sources)).cast("array<string>"))) == pytest.approx(score)


@pytest.mark.parametrize(("kind", "raw", "value"), [("ip", "203.0.113.5 (c2)", "203.0.113.5"), ("ip", "10.1.2.3", None), ("ip", "8.8.8.8", None), ("url", "https://evil.bad/a note", "https://evil.bad/a"), ("url", "ftp://evil.bad", None), ("url", "http://192.168.0.1/x", None), ("domain", "a b.com", None), ("domain", "malware.exe", None), ("domain", "abc.workers", None), ("domain", "abc.workers.dev", "abc.workers.dev"), ("md5", "d41d8cd98f00b204e9800998ecf8427e", None), ("other", " x ", "x"), ("domain", "", None)])
def test_normalize(spark, kind, raw, value):
    assert one(spark, E.normalize_ioc(F.lit(kind), F.lit(raw))) == value


@pytest.mark.parametrize(("ip", "blocked"), [("172.16.0.1", True), ("172.32.0.1", False), ("::1", True), ("fe80::1", True), ("2001:db8::1", False), ("999.1.1.1", False), ("face.example.org", False), ("9.9.9.9", True)])
def test_blocked_ip(spark, ip, blocked):
    assert one(spark, E.blocked_ip(F.lit(ip))) is blocked


def test_uuid_and_small_functions(spark):
    assert one(spark, E.uuid5(F.lit("http://x/é"))) == str(uuid.uuid5(uuid.NAMESPACE_URL, "http://x/é"))
    assert one(spark, E.slug(F.lit(" Lock Bit 3.0!"))) == "lock-bit-3-0"
    assert one(spark, E.undefang(F.lit("hxxps://evil[.]bad"))) == "https://evil.bad"
    assert one(spark, E.shard_key(F.lit("@scope/x"))) == "misc"
    assert one(spark, E.rfc3339(F.lit("2024-01-01 00:00:00"))) is None
    assert one(spark, E.cvss3_base(F.lit("CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H"))) == 10.0
    assert one(spark, E.severity_label(F.lit(0))) == "medium"
    assert [one(spark, E.false_package(F.lit(x))) for x in ("the", "left-pad", "a b", "end.", "")] == [True, False, True, True, True]


@pytest.mark.parametrize(("a", "b", "score", "technique"), [("reqeusts", "requests", 0.75, "swap"), ("request", "requests", 0.875, "omission"), ("rеquests", "requests", 0.99, "homoglyph"), ("@x/lodash", "lodash", 0.95, "prefix_scope"), ("lodash-utils", "lodash", 0.85, "addition"), ("abc", "abd", 0.0, "")])
def test_similarity(spark, a, b, score, technique):
    got = one(spark, E.similarity(F.lit(a), F.lit(b)))
    assert (got.score, got.technique) == (pytest.approx(score), technique)


def test_typosquat_best(spark):
    popular = spark.createDataFrame([("npm", "lodash", 100), ("npm", "lodas", 5), ("pypi", "requests", 50)], "ecosystem string, name string, weekly bigint")
    names = spark.createDataFrame([("npm", "lodahs"), ("npm", "lodash"), ("npm", "lodash-x"), ("pypi", "lodash"), ("npm", "l0dash")], "ecosystem string, name string")
    got = {r.name: (r.target, r.technique) for r in typosquat.best_matches(names, popular).collect()}
    assert got == {"lodahs": ("lodas", "omission"), "lodash": ("lodas", "omission"), "lodash-x": ("lodash", "addition"), "l0dash": ("lodash", "homoglyph")}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (200, 100), (None, 3)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 200: 100}
    assert connected_components(spark.createDataFrame([], "src bigint, dst bigint")).count() == 0


def _least(edges):
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {x: root(x) for x in parent}


def test_neighbouring_ids_need_no_rounds(spark):
    edges = [(i, i + 1) for i in range(4000, 4300)] + [(i, i + 2) for i in range(9000, 9100)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src bigint, dst bigint"), max_rounds=1).collect()}
    assert got == _least(edges)


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_components_of_any_ids_and_chunks(spark, chunk):
    r = random.Random(chunk)
    near, far = [r.randrange(-9000, 9000) for _ in range(150)], [r.choice([-1, 1]) * r.randrange(1 << 62) for _ in range(90)] + [-(1 << 63), (1 << 63) - 1]
    edges = [(r.choice(x), r.choice(y)) for x, y in ((near, near), (far, far), (far, far)) for _ in range(60)] + [(-8191, x) for x in far[:9]] + [(i, i + 1) for i in range(20_000, 20_040)]
    edges = [e for e in edges + edges[:30] if e[0] != e[1]]
    found = connected_components(spark.createDataFrame(edges, "src bigint, dst bigint").repartition(5), chunk=chunk).collect()
    assert len(found) == len({x for e in edges for x in e}) and {x.id: x.component for x in found} == _least(edges)


def test_components_keep_the_type_of_ids(spark):
    ints = connected_components(spark.createDataFrame([(3, 2), (2, 1)], "src int, dst int"))
    assert ints.schema["id"].dataType.typeName() == ints.schema["component"].dataType.typeName() == "integer"
    assert {tuple(r) for r in ints.collect()} == {(1, 1), (2, 1), (3, 1)}
    assert {tuple(r) for r in connected_components(spark.createDataFrame([("c", "b"), ("b", "a")], "src string, dst string")).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}


def test_merge_is_transitive_and_stars_are_few(spark):
    keys = spark.createDataFrame([("camp", 1), ("camp", 2), ("pkg", 2), ("pkg", 3), ("", 4), (None, 5)], "key string, id bigint")
    assert resolve.star_edges(keys).count() == 2
    rows = spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")
    assert {r.id: r.component for r in resolve.components(rows, resolve.star_edges(keys)).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}


RULE = {"title": "t", "logsource": {"category": "dns"}, "detection": {"a": {"q|endswith": [".bad", ".evil"], "n": 1}, "b": {"q|contains": "ok"}, "condition": "a and not b"}}


def test_rules(spark):
    rows = spark.createDataFrame([("x.BAD", 1), ("ok.bad", 1), ("x.bad", 2), (None, 1)], "q string, n int")
    assert [r.q for r in rules.hits(RULE, rows).collect()] == ["x.BAD"]
    assert rules.translate(RULE, "splunk") == 'sourcetype=dns (q IN ("*.bad", "*.evil") AND n="1") AND NOT (q="*ok*")'
    assert rules.translate(RULE, "aql") == "SELECT * FROM dns WHERE ((q ILIKE '%.bad' OR q ILIKE '%.evil') AND n ILIKE '1') AND NOT (q ILIKE '%ok%') LAST 24 HOURS"
    for d in rules.DIALECTS:
        assert rules.translate(RULE, d)
    for bad in ("a and", "(a", "a b", "a and )"):
        with pytest.raises((ValueError, KeyError)):
            rules.predicate(RULE | {"detection": RULE["detection"] | {"condition": bad}})


def test_aliases_and_guards(spark):
    texts = spark.createDataFrame([(1, "The LazarusGroup did"), (2, "apt by ta5"), (3, "chapter"), (4, None)], "id bigint, text string")
    aliases = spark.createDataFrame([("lazarus", "lazarus"), ("apt", "apt1"), ("ta5", "ta5")], "alias string, slug string")
    assert sorted(map(tuple, links.alias_matches(texts, aliases).collect())) == [(1, "lazarus"), (2, "apt1"), (2, "ta5")]
    index.shrink_guard(1000, 1)
    with pytest.raises(ValueError):
        index.shrink_guard(2000, 900)


def test_stream_is_idempotent(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, v bigint"
    for i, rows in enumerate(([("a", 1), ("b", 1)], [("a", 2), ("c", 1)], [("a", 1)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        upsert.upsert_stream(spark.readStream.schema(schema).parquet(source), target, "k", "v", str(tmp_path / "cp")).awaitTermination()
        assert upsert.latest(spark, target, i).count() == (2, 3, 3)[i]
    assert sorted(map(tuple, upsert.latest(spark, target, 2).collect())) == [("a", 2), ("b", 1), ("c", 1)]


def test_windowed_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    upsert.windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("w").collect())) == sorted(map(tuple, upsert.windowed_counts(events).collect()))
