"""Detection rules: selections as predicates over events, and as text in the dialects of other engines."""

from __future__ import annotations

import fnmatch
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIALECTS = ("kql", "splunk", "eql", "logscale", "aql", "datadog")
_WORD = re.compile(r"\(|\)|[^\s()]+")


def _match(field: Column, modifier: str, values: list) -> Column:
    every = modifier.endswith("|all")  # all values rather than one
    modifier = modifier.removesuffix("|all")
    text = field.cast("string")
    one = {
        "": lambda v: F.lower(text) == str(v).lower(),
        "contains": lambda v: F.lower(text).contains(str(v).lower()),
        "startswith": lambda v: F.lower(text).startswith(str(v).lower()),
        "endswith": lambda v: F.lower(text).endswith(str(v).lower()),
        "re": lambda v: text.rlike(str(v)),
        "gte": lambda v: field >= F.lit(v),
        "lt": lambda v: field < F.lit(v),
    }
    if modifier not in one:
        raise ValueError(f"modifier {modifier}")
    return F.coalesce(reduce((lambda a, b: a & b) if every else (lambda a, b: a | b), [one[modifier](v) for v in values]), F.lit(False))


def _values(value) -> list:
    return value if isinstance(value, list) else [value]


def selection(fields: dict) -> Column:
    """All fields, each with any of its values; ``name|modifier`` names field and comparison."""
    parts = []
    for name, value in fields.items():
        field, _, modifier = name.partition("|")
        parts.append(_match(F.col(field), modifier, _values(value)))
    return reduce(lambda a, b: a & b, parts)


def parse(condition: str, leaf, both, either, no, names=()):
    """A condition of names, quantities of them, and, or, not and parentheses; not binds first, then and."""
    words = _WORD.findall(condition)

    def of(i):
        """``1 of name*`` and ``all of name*``, ``them`` being all selections."""
        found = [n for n in names if words[i + 2].lower() == "them" or fnmatch.fnmatchcase(n, words[i + 2])]
        if not found:
            raise ValueError(f"no selection {words[i + 2]} in {condition}")
        return reduce(either if words[i] == "1" else both, [leaf(n) for n in found]), i + 3

    def alternatives(i):
        left, i = terms(i)
        while i < len(words) and words[i].lower() == "or":
            right, i = terms(i + 1)
            left = either(left, right)
        return left, i

    def terms(i):
        left, i = factor(i)
        while i < len(words) and words[i].lower() == "and":
            right, i = factor(i + 1)
            left = both(left, right)
        return left, i

    def factor(i):
        if i >= len(words):
            raise ValueError(f"condition ends early: {condition}")
        if words[i].lower() == "not":
            inner, i = factor(i + 1)
            return no(inner), i
        if words[i].lower() in ("1", "all") and i + 2 < len(words) and words[i + 1].lower() == "of":
            return of(i)
        if words[i] == "(":
            inner, i = alternatives(i + 1)
            if i >= len(words) or words[i] != ")":
                raise ValueError(f"missing parenthesis: {condition}")
            return inner, i + 1
        return leaf(words[i]), i + 1

    made, i = alternatives(0)
    if i != len(words):
        raise ValueError(f"can't read {words[i]} in {condition}")
    return made


def predicate(rule: dict) -> Column:
    """The rule as a condition on a table's columns: Catalyst prunes and pushes it like any other."""
    detection = rule["detection"]
    return parse(detection["condition"], lambda name: selection(detection[name]), lambda a, b: a & b, lambda a, b: a | b, lambda a: ~a, _names(detection))


def _names(detection: dict) -> list[str]:
    return [n for n in detection if n != "condition"]


def hits(rule: dict, events: DataFrame) -> DataFrame:
    return events.filter(predicate(rule)).withColumn("rule", F.lit(rule["title"]))


def _quoted(v, mark: str) -> str:
    return mark + str(v).replace("\\", "\\\\").replace(mark, "\\" + mark) + mark


def _term(dialect: str, field: str, modifier: str, values: list) -> str:
    """One comparison as text; comparisons that a dialect can't say are refused."""
    if modifier.endswith("|all"):
        one = [_term(dialect, field, modifier.removesuffix("|all"), [v]) for v in values]
        return f"({(' and ' if dialect in ('kql', 'eql', 'logscale') else ' AND ').join(one)})"
    if modifier in ("gte", "lt"):
        if dialect == "splunk" or dialect in ("kql", "eql", "logscale", "aql"):
            return " and ".join(f"{field} {'>=' if modifier == 'gte' else '<'} {v}" for v in values).replace(" and ", " AND " if dialect in ("splunk", "aql") else " and ")
        return f"@{field}:{'>=' if modifier == 'gte' else '<'}{values[0]}"
    if modifier == "re" and dialect != "kql":
        text = {"eql": f"{field} regex~ ({', '.join(_quoted(v, chr(34)) for v in values)})", "aql": " OR ".join(f"{field} IMATCHES {_quoted(v, chr(39))}" for v in values), "logscale": " or ".join(f"{field}=/{v}/i" for v in values)}
        if dialect not in text:
            raise ValueError(f"{dialect} has no regular expressions for {field}")
        return text[dialect]
    if dialect == "kql":
        if modifier == "contains":
            return f"{field} has {_quoted(values[0], chr(34))}" if len(values) == 1 else f"{field} has_any ({', '.join(_quoted(v, chr(34)) for v in values)})"
        verb = {"startswith": "startswith", "endswith": "endswith", "re": "matches regex"}.get(modifier)
        if verb:
            return " or ".join(f"{field} {verb} {_quoted(v, chr(34))}" for v in values)
        return f"{field} in~ ({', '.join(_quoted(v, chr(34)) for v in values)})"
    star = {"contains": "*{}*", "startswith": "{}*", "endswith": "*{}"}.get(modifier, "{}")
    if dialect == "splunk":
        return f"{field} IN ({', '.join(_quoted(star.format(v), chr(34)) for v in values)})" if len(values) > 1 else f"{field}={_quoted(star.format(values[0]), chr(34))}"
    if dialect == "eql":
        return f"{field} like~ ({', '.join(_quoted(star.format(v), chr(34)) for v in values)})"
    if dialect == "aql":
        percent = {"contains": "%{}%", "startswith": "{}%", "endswith": "%{}"}.get(modifier, "{}")
        return " OR ".join(f"{field} ILIKE {_quoted(percent.format(v), chr(39))}" for v in values)
    if dialect == "logscale":
        return " or ".join(f"{field}={_quoted(star.format(v), chr(34))}" for v in values)
    return f"@{field}:({' OR '.join(star.format(v) for v in values)})"


def translate(rule: dict, dialect: str) -> str:
    """The rule's condition as text of a dialect."""
    if dialect not in DIALECTS:
        raise ValueError(f"dialect {dialect}")
    low = dialect in ("kql", "eql", "logscale")
    conj, disj, no = ("and", "or", "not ") if low else ("AND", "OR", "NOT ")
    if dialect == "datadog":
        no = "-"
    detection = rule["detection"]

    def leaf(name: str) -> str:
        parts = []
        for key, value in detection[name].items():
            field, _, modifier = key.partition("|")
            term = _term(dialect, field, modifier, _values(value))
            parts.append(f"({term})" if re.search(r" (?:or|OR) ", term) else term)
        return f"({f' {conj} '.join(parts)})"

    body = parse(detection["condition"], leaf, lambda a, b: f"{a} {conj} {b}", lambda a, b: f"({a} {disj} {b})", lambda a: f"{no}{a}", _names(detection))
    table = rule.get("logsource", {}).get("category", "events")
    return {
        "kql": f"{table}\n| where {body}\n| limit 1000",
        "splunk": f"sourcetype={table} {body}",
        "eql": f"any where {body}",
        "aql": f"SELECT * FROM {table} WHERE {body} LAST 24 HOURS",
    }.get(dialect, body)


def network_rules(iocs: DataFrame) -> DataFrame:
    """(sid, rule): a signature of a network sensor for each domain and address."""
    value = F.col("ioc")
    n = F.conv(F.substring(F.sha1(value), 1, 8), 16, 10).cast("bigint") % 9_000_000 + 1_000_000
    text = F.when(F.col("ioc_type") == "domain", F.format_string('alert dns any any -> any any (msg:"%s"; dns.query; content:"%s"; nocase; sid:%d; rev:1;)', value, value, n)).otherwise(F.format_string('alert ip any any -> %s any (msg:"%s"; sid:%d; rev:1;)', value, value, n))
    return iocs.filter(F.col("ioc_type").isin("ip", "domain")).select("ioc", n.alias("sid"), text.alias("rule")).distinct()
