"""Links of all pairs: those of plain Python, on odd rows, without a shuffle of the pairs."""

import pytest
from pyspark.sql import functions as F

from lodewerk.operators import enrich, links, pairs


def shuffled(spark, run):
    """Rows that a run wrote to shuffles."""
    context = spark.sparkContext

    def stages():
        found = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())}

    before = set(stages())
    made = run()
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return made, sum(n for i, n in stages().items() if i not in before)


@pytest.mark.parametrize("block", [2, 512])
def test_cve_links_of_odd_rows(spark, monkeypatch, block):
    """Ids in both modules and thrice, null ids and CVEs, another module, CVEs in either case."""
    monkeypatch.setattr(pairs, "BLOCK", block)
    rows = [(i, ["cve", "container", "supply"][i % 3], f"{'cC'[i % 2]}ve-{i % 4}") for i in range(40)] + [(1, "cve", "cve-1"), (1, "container", "CVE-1"), (2, "cve", "cve-1"), (2, "container", "cve-1"), (2, "cve", "cve-1"), (None, "cve", "cve-1"), (99, "cve", None)]
    got = sorted(map(tuple, links.cve_links(spark.createDataFrame(rows, "id bigint, module string, cve string")).collect()), key=repr)
    one, other = ([(i, c.upper()) for i, m, c in rows if m == module and c] for module in ("cve", "container"))
    want = {(a, b, c) for a, c in one for b, d in other if c == d}
    assert got == sorted(want | {(b, a, c) for a, b, c in want}, key=repr)


def test_cve_links_are_not_shuffled(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, "cve").otherwise("container").alias("module"), F.lit("cve-1").alias("cve"))
    n, moved = shuffled(spark, lambda: links.cve_links(rows).count())
    assert n == 500_000 and moved < 10_000


@pytest.mark.parametrize("block", [2, 512])
def test_os_links_have_the_least_cve(spark, monkeypatch, block):
    """Incidents with several CVEs in common, repeated rows, null ids and CVEs."""
    monkeypatch.setattr(pairs, "BLOCK", block)
    packages = [(i, f"c{(i * k) % 7}") for i in range(15) for k in range(1, 4)] + [(3, "c3"), (3, "c3"), (None, "c1"), (4, None)]
    containers = [(i, f"c{(i + k) % 7}") for i in range(100, 112) for k in range(i % 3 + 1)] + [(100, "c2"), (3, "c3"), (None, "c1"), (101, None)]
    by: dict = {}
    for a, c in packages:
        for b, d in containers:
            if c == d and c:
                by[a, b] = min(by.get((a, b), c), c)
    want = [x for (a, b), c in by.items() for x in ((a, b, "os-packages", c, 0.9), (b, a, "container", c, 0.9))]
    got = enrich.os_links(*(spark.createDataFrame(rows, "id bigint, cve string") for rows in (packages, containers)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_os_links_are_not_shuffled(spark):
    packages, containers = (spark.range(n, n + 500).select("id", F.explode(F.array(F.lit("c1"), F.lit("c2"))).alias("cve")) for n in (0, 1000))
    made, moved = shuffled(spark, lambda: enrich.os_links(packages, containers).groupBy("cve").count().collect())
    assert [tuple(r) for r in made] == [("c1", 500_000)] and moved < 20_000


def test_installed_packages_meet_by_cve(spark):
    """The values of the packages that a container shares a CVE with, without a row for each pair of both."""
    packages = spark.range(600).select("id", F.lit("c1").alias("cve")).unionByName(spark.createDataFrame([(1, "c2"), (2, None)], "id bigint, cve string"))
    containers = spark.range(1000, 1600).select("id", F.lit("c1").alias("cve")).unionByName(spark.createDataFrame([(2000, "c2"), (2000, "c2"), (2001, "c9"), (2002, None)], "id bigint, cve string"))
    versions = packages.select("id", F.lit("p").alias("name"), F.concat(F.lit("v"), F.col("id") % 2).alias("version")).filter("id <> 3")
    made, moved = shuffled(spark, lambda: enrich.installed_packages(packages, containers, versions).collect())
    assert {tuple(r) for r in made} == {(i, f"p/v{k}", 0.85) for i in range(1000, 1600) for k in (0, 1)} | {(2000, "p/v1", 0.85)}
    assert len(made) == 1201 and moved < 20_000
