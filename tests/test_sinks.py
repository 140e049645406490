"""Outputs of bounded size, documents, drafts and rewrites, read back."""

import json
import os

from pyspark.sql import functions as F

from lodewerk.operators import ids, shards
from lodewerk.sources import sinks


def test_shards_are_bounded_and_whole(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 3}" if i % 4 else "hot", i, f"line {i} " + "x" * (i % 50)) for i in range(500)] + [("hot", 1000, None)], "key string, id int, line string")
    counts = {(r.key, r.shard): (r.rows, r.bytes) for r in sinks.write_shards(rows, f"{tmp_path}/s", ["key"], ["id"], "line", 1000).collect()}
    assert max(b for _, b in counts.values()) < 1000 + 60 and len(counts) > 15
    got = spark.read.text(f"{tmp_path}/s").filter("value <> ''")
    assert sorted(r.value for r in got.collect()) == sorted(r.line for r in rows.filter("line is not null").collect())
    # within a key shards follow one another in order
    for key in ("hot", "k1"):
        last = -1
        for n in sorted(s for k, s in counts if k == key):
            here = [int(r.value.split()[1]) for r in spark.read.text(f"{tmp_path}/s/key={key}/shard={n}").filter("value <> ''").collect()]
            assert min(here) > last
            last = max(here)
    sinks.write_shards(rows.filter("key = 'hot'"), f"{tmp_path}/s", ["key"], ["id"], "line", 100_000)
    assert {d for d in os.listdir(f"{tmp_path}/s") if d.startswith("key=")} == {"key=hot"}
    assert shards.size_bounded(rows.limit(0), ["key"], ["id"], "line").count() == 0


def test_documents(spark, tmp_path):
    head = spark.sql("select 'cve' as module, 3 as total")
    sinks.write_document(head, f"{tmp_path}/d", incidents=spark.createDataFrame([(1, "a"), (2, 'q"')], "id int, name string").coalesce(1), campaigns=spark.sql("select 1 as x").limit(0))
    assert json.loads(spark.read.text(f"{tmp_path}/d").first().value) == {"module": "cve", "total": 3, "incidents": [{"id": 1, "name": "a"}, {"id": 2, "name": 'q"'}], "campaigns": []}


def test_nothing_is_written_twice(spark, tmp_path):
    rows = spark.createDataFrame([("a", "1"), ("b", "2")], "id string, hash string")
    path = f"{tmp_path}/t"
    assert sinks.write_if_changed(rows, path, "id") == 2
    assert sinks.write_if_changed(rows, path, "id") == 0
    assert sinks.write_if_changed(spark.read.parquet(path).withColumn("hash", F.lit("3")), path, "id") == 4
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", "3"), ("b", "3")]
    drafts = spark.createDataFrame([("x", "2024-05-01"), ("y", None)], "id string, published string").withColumn("published", F.col("published").cast("timestamp"))
    assert sinks.write_drafts(drafts, f"{tmp_path}/drafts") == 2
    more = drafts.unionByName(drafts.filter("id = 'x'").withColumn("id", F.lit("z")))
    assert sinks.write_drafts(more, f"{tmp_path}/drafts") == 1 and sinks.write_drafts(more, f"{tmp_path}/drafts") == 0
    assert sorted((r.id, str(r.year)) for r in spark.read.json(f"{tmp_path}/drafts").collect()) == [("x", "2024"), ("y", "unknown"), ("z", "2024")]


def test_old_files(spark, tmp_path):
    (tmp_path / "2023" / "deep").mkdir(parents=True)
    for name in ("a.yaml", "2023/b.yaml", "2023/c.txt", "2023/deep/d.yaml", "new.yaml"):
        (tmp_path / name).write_text("x")
        if name != "new.yaml":
            os.utime(tmp_path / name, (1_600_000_000, 1_600_000_000))
    got = sorted(r.path.rsplit("/", 1)[1] for r in sinks.stale_files(spark, str(tmp_path), "2021-01-01").collect())
    assert got == ["a.yaml", "b.yaml"]


def test_ids_grow_beyond_their_digits(spark):
    old = spark.createDataFrame([("cve", 2024, "s", 999_999)], "module string, year int, source_id string, seq bigint")
    rows = spark.createDataFrame([("cve", 2024, s) for s in ("s", "t", "u", "u")] + [("cve", None, "v")], "module string, year int, source_id string")
    got = {r.source_id: r.public_id for r in ids.assign(rows, old, digits=6).collect()}
    assert got["s"] == "lw-cve-2024-999999" and got["t"] == "lw-cve-2024-1000000" and got["u"] == "lw-cve-2024-1000001"
    again = ids.assign(rows, ids.assign(rows, old, digits=6).select("module", "year", "source_id", "seq"), digits=6)
    assert {r.source_id: r.public_id for r in again.filter("source_id <> 'v'").collect()} == {k: v for k, v in got.items() if k != "v"}
    many = spark.range(5000).selectExpr("'m' as module", "2024 as year", "lpad(id, 8, '0') as source_id")
    assert [r.seq for r in ids.assign(many, None).orderBy("source_id").collect()] == list(range(1, 5001))
