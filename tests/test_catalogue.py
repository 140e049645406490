"""Every query of the catalogue against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from lodewerk.plans import catalogue

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(D):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{D}/{f}'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(columns), sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


def test_all_have_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got, want = catalogue.QUERIES[name](spark, D), duck.sql(catalogue.ORACLES[name])
    assert rows(got.columns, map(tuple, got.collect())) == rows(want.columns, want.fetchall())


def test_entry_works_without_the_corpus_operators(monkeypatch):
    import builtins
    import sys

    import __spark_entry__

    real = builtins.__import__

    def gone(name, glob=None, loc=None, fromlist=(), level=0):
        if name.startswith("lodewerk.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return real(name, glob, loc, fromlist, level)

    for name in [m for m in sys.modules if m.startswith("lodewerk.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", gone)
    assert set(__spark_entry__.queries()) == set(catalogue.QUERIES)
    assert set(__spark_entry__.oracle_sql()) == set(catalogue.ORACLES)


def test_every_supplier_and_incident_enters(spark):
    """Components by union-find over all lines, and every incident with an indicator in the union of the feeds."""
    lines = spark.read.parquet(f"{D}/lineitem.parquet").select("l_suppkey", "l_partkey").distinct().collect()
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in lines:
        parent[root(("p", r.l_partkey))] = root(("s", r.l_suppkey))
    groups = {}
    for kind, x in list(parent):
        if kind == "s":
            groups.setdefault(root(("s", x)), set()).add(x)
    want = {x: min(g) for g in groups.values() for x in g}
    assert {r.id: r.component for r in catalogue.QUERIES["supplier_components_all"](spark, D).collect()} == want
    every = {r.id for r in catalogue.incidents(spark, D).filter("ioc is not null").collect()}
    assert {r.id for r in catalogue.QUERIES["feed_union_dedup_all"](spark, D).collect()} == every
