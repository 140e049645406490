"""What one entity keeps of all the records that describe it, and which records do.

Records come in long form: a row for each package, reference and indicator of an
incident, with the incident's ``id`` and its place ``pos`` in it.  Order within
a group is that of (id, pos).  Values are aggregated by key before anything is
collected, so a list has as many elements as there are distinct sources or as
its cap allows, however many records are in a group.

Null keys take no part; groups of one keep their values as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from .resolve import TRUSTED, star_edges

MAX_REFERENCES = 20


def merge_keys(incidents: DataFrame, packages: DataFrame, indicators: DataFrame) -> DataFrame:
    """(key, id): what makes incidents candidates for one entity: packages, campaign, CVE and indicators, in lower case."""

    def of(rows: DataFrame, kind: str, value: Column, when: Column) -> DataFrame:
        return rows.filter(F.coalesce(when, F.lit(False))).select(F.concat(F.lit(kind), F.lower(value)).alias("key"), "id")

    keys = of(packages, "pkg:", F.concat_ws("/", "ecosystem", "name"), (F.col("name") != "") & (F.col("ecosystem") != ""))
    keys = keys.unionByName(of(incidents, "campaign:", F.col("campaign"), F.col("campaign") != ""))
    keys = keys.unionByName(of(incidents, "cve:", F.col("cve"), F.col("cve") != ""))
    return keys.unionByName(of(indicators, "ioc:", F.col("value"), F.col("value") != "")).distinct()


def shared_edges(rows: DataFrame, days: int) -> DataFrame:
    """Of (ioc, id, at, trusted), times in microseconds, edges whose components are those of all pairs so many days apart at most that share two indicators, or one if both are trusted.

    An edge joins neighbours in time of a key; two rows of a key within that
    time are joined by such a chain.  Keys are an indicator, for trusted rows,
    and two indicators of one incident.  Indicators are numbered once, by their
    stretches without a longer gap, and only the numbers make pairs; a row that
    is alone in its stretch has no part in any.
    """
    span = days * 86_400_000_000
    order = Window.partitionBy("ioc").orderBy("at", "id", F.desc("trusted"))
    before, after = F.lag("at").over(order), F.lead("at").over(order)
    near = F.coalesce(F.col("at") - F.col("before") <= span, F.lit(False))
    rows = rows.filter("id is not null and at is not null").withColumn("before", before).withColumn("after", after).withColumn("again", F.coalesce((F.lag("id").over(order) == F.col("id")) & (F.col("before") == F.col("at")), F.lit(False)))
    # after the sort, so a repeated task gives the same numbers
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("code", F.max(F.when(~near, F.col("row"))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.filter(~F.col("again") & (near | F.coalesce(F.col("after") - F.col("at") <= span, F.lit(False)))).select("id", "at", "trusted", "code")
    rows = rows.withColumn("all", F.collect_list("code").over(Window.partitionBy("id", "at")))  # an incident's indicators
    keyed = rows.select("id", "at", "code", F.explode(F.expr("filter(all, c -> c > code or c = code and trusted)")).alias("second"))
    chain = Window.partitionBy("code", "second").orderBy("at", "id")
    keyed = keyed.select("id", "at", F.lag("id").over(chain).alias("src"), F.lag("at").over(chain).alias("before"))
    return keyed.filter((F.col("src") != F.col("id")) & (F.col("at") - F.col("before") <= span)).select("src", F.col("id").alias("dst"))


def event_edges(incidents: DataFrame, packages: DataFrame, indicators: DataFrame, days: int = 7) -> DataFrame:
    """Edges whose components are the events: incidents with a package or a campaign in common, or so many days apart at most with two indicators in common, one if both sources are trusted.

    Two indicators of one incident make a key; a circuit breaker on the number
    of indicators bounds those, and only indicators of several incidents count.
    Indicators that bring their incident's ``start_ts`` and ``source`` aren't
    joined for them.  An edge may be repeated.
    """
    same = packages.filter("name <> '' and ecosystem <> ''").select(F.lower(F.concat_ws("/", F.lit("pkg"), "ecosystem", "name")).alias("key"), "id")
    same = same.unionByName(incidents.filter("campaign <> ''").select(F.lower(F.concat_ws(":", F.lit("campaign"), "campaign")).alias("key"), "id"))
    found = indicators.filter("value <> ''")
    if not {"start_ts", "source"} <= set(found.columns):
        found = found.select("id", "type", "value").join(incidents.select("id", "start_ts", "source"), "id")
    ioc = F.concat_ws(":", F.when(F.col("type").isin("ip", "domain", "url"), F.col("type")).otherwise("hash"), F.when(F.col("type") == "ip", F.col("value")).otherwise(F.lower("value")))
    dated = found.select(ioc.alias("ioc"), "id", F.unix_micros(F.col("start_ts").cast("timestamp")).alias("at"), F.coalesce(F.col("source").isin(*TRUSTED), F.lit(False)).alias("trusted"))
    return star_edges(same).unionByName(shared_edges(dated, days))


def _first(column: str, present: str) -> Column:
    """The value of the least id that has one."""
    return F.expr(f"min_by({column}, id) filter (where {present})")


def fields(incidents: DataFrame) -> DataFrame:
    """By component: base id, worst severity, longest description, all sources in order and the confidence that they give, the first OSV id, GHSA id and campaign."""
    worst = E.severity_label(F.max(E.severity_rank(F.col("severity")))).alias("severity")
    longest = F.max_by("description", F.struct(F.octet_length("description"), -F.col("id"))).alias("description")
    one = incidents.groupBy("component").agg(F.min("id").alias("base_id"), F.count("*").alias("members"), worst, longest, *(F.coalesce(_first(c, f"{c} <> ''"), F.lit("")).alias(c) for c in ("osv_id", "ghsa_id", "campaign")))
    return one.join(ordered_union(incidents, "source", "sources"), "component", "left").withColumn("confidence", F.round(E.confidence(F.split("sources", ",")), 6))


def ordered_union(rows: DataFrame, column: str, name: str) -> DataFrame:
    """(component, name): the distinct values of a column with few of them, in order of first occurrence, with commas."""
    firsts = rows.filter(F.col(column) != "").groupBy("component", column).agg(F.min("id").alias("at"))
    lists = firsts.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", column))).alias("x"))  # a row for each distinct value
    return lists.select("component", F.array_join(F.transform("x", lambda v: v[column]), ",").alias(name))


def references(rows: DataFrame, most: int = MAX_REFERENCES) -> DataFrame:
    """(component, nth, ref): the first ``most`` references of a component, of which repeated ones count once."""
    order = Window.partitionBy("component").orderBy("id", "pos")
    first = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most)
    return first.groupBy("component", "ref").agg(F.min("nth").alias("nth"))


def packages(rows: DataFrame) -> DataFrame:
    """(component, ecosystem, name, versions): packages by lower-case ecosystem and name; the first one's spelling and versions stay."""
    key = F.lower(F.concat_ws("|", "ecosystem", "name")).alias("key")
    one = rows.groupBy("component", key).agg(F.min_by(F.struct("ecosystem", "name", "version"), F.struct("id", "pos")).alias("x"))
    return one.select("component", "x.ecosystem", "x.name", F.col("x.version").alias("versions"))


def indicators(rows: DataFrame) -> DataFrame:
    """(component, type, value, n, sources, confidence): indicators by value; sources are united, and where several records have one the confidence is that of all sources."""
    key = F.when(F.col("type") == "ip", F.col("value")).otherwise(F.lower("value")).alias("key")
    by_source = rows.filter("value is not null").groupBy("component", "type", key, "source").agg(F.min(F.struct("id", "pos")).alias("at"), F.min_by(F.struct("value", "confidence"), F.struct("id", "pos")).alias("x"), F.count("*").alias("n"))
    one = by_source.groupBy("component", "type", "key").agg(F.min_by("x", "at").alias("x"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "source"))).alias("s"))  # a row for each source
    sources = F.filter(F.transform("s", lambda v: v["source"]), lambda v: v != "")
    merged = F.when(F.col("n") > 1, E.confidence(sources)).otherwise(F.col("x.confidence"))
    return one.select("component", "type", "x.value", "n", F.array_join(sources, ",").alias("sources"), F.round(merged, 6).alias("confidence"))


def cve_extension(rows: DataFrame) -> DataFrame:
    """By component: flags that any record sets, the greatest CVSS with its vector (the first such), the first exploit type and patch."""
    top = F.max_by(F.struct("cvss", "vector"), F.struct("cvss", -F.col("id")))
    return rows.groupBy("component").agg(
        F.min_by("cve", "id").alias("cve"),
        *(F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in ("exploited", "public", "patched")),
        top.alias("x"),
        *(F.coalesce(_first(c, f"{c} <> ''"), F.lit("")).alias(c) for c in ("exploit_type", "patch_url")),
    ).select("component", "cve", "exploited", "public", "patched", F.round("x.cvss", 6).alias("cvss"), "x.vector", "exploit_type", "patch_url")


def best_of_groups(merged: DataFrame) -> DataFrame:
    """Of merged groups the one of the highest severity, the first if several."""
    return merged.orderBy(F.desc(E.severity_rank(F.col("severity"))), "base_id").limit(1)
