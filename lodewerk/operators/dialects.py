"""More dialects of detection rules, signatures of indicators, and rules compiled for every engine at once.

``COMPILERS`` is open: a function of a rule (title, id, level, tags, logsource,
detection) under a new name is one more engine.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R

NETWORK = ("network_connection", "dns", "dns_query", "firewall", "proxy")
SEVERITY = {"critical": "High", "high": "High", "medium": "Medium", "low": "Low", "informational": "Informational"}
WAZUH_LEVEL = {"critical": 15, "high": 12, "medium": 8, "low": 4, "informational": 2}
WAZUH_FIELDS = {"Image": "win.eventdata.image", "CommandLine": "win.eventdata.commandLine", "ParentImage": "win.eventdata.parentImage", "TargetFilename": "win.eventdata.targetFilename", "DestinationHostname": "win.eventdata.destinationHostname", "DestinationIp": "win.eventdata.destinationIp", "Hashes": "win.eventdata.hashes"}
CHRONICLE_FIELDS = {"Image": "principal.process.file.full_path", "CommandLine": "target.process.command_line", "ParentImage": "principal.process.parent_process.file.full_path", "TargetFilename": "target.file.full_path", "DestinationHostname": "target.hostname", "DestinationIp": "target.ip", "Hashes": "target.file.sha256"}
MIN_YARA = 0.70
MAX_SHAPES = 4096  # detections that a worker remembers


class Detection(dict):
    """Selections and condition that many rules have in common, and what was made of them."""

    def __init__(self, *given):
        super().__init__(*given)
        self.made: dict = {}


def _once(rule: dict, name: str, make: Callable[[], object]):
    """What follows from the detection and the log source alone: made once for rules that share them (see ``compiled``)."""
    if not isinstance(rule["detection"], Detection):
        return make()
    made = rule["detection"].made
    if name not in made:
        try:
            made[name] = make()
        except ValueError as no:
            made[name] = no
    if isinstance(made[name], ValueError):
        raise made[name]
    return made[name]


def _translated(rule: dict, dialect: str) -> str:
    return _once(rule, dialect, lambda: R.translate(rule, dialect))


def fields_of(rule: dict) -> Iterator[tuple[str, str, str, list]]:
    """(selection, field, modifier, values), fields of a selection in order of their names."""
    for name in R._names(rule["detection"]):
        for key in sorted(rule["detection"][name]):
            field, _, modifier = key.partition("|")
            yield name, field, modifier, [str(v) for v in R._values(rule["detection"][name][key])]


def negated(rule: dict) -> set[str]:
    """The selections that a condition excludes."""
    return set(re.findall(r"\bnot\s+\(?\s*([A-Za-z0-9_]+)", rule["detection"]["condition"]))


def _regex(modifier: str, values: list[str]) -> str:
    kind = modifier.split("|")[0]
    one = [v if kind == "re" else {"startswith": "^{}", "endswith": "{}$", "contains": "{}"}.get(kind, "^{}$").format(re.escape(v)) for v in values]
    return "(?i)" + ("|".join(one) if len(one) < 2 or "all" not in modifier else "".join(f"(?=.*{x})" for x in one))


def sentinel(rule: dict) -> str:
    """A scheduled analytics rule around the KQL of the condition."""
    tactics = sorted({t.removeprefix("attack.").replace("-", " ").replace("_", " ").title().replace(" ", "") for t in rule.get("tags", []) if t.startswith("attack.") and not re.match(r"attack\.[tgs]\d", t)})
    return json.dumps({"kind": "Scheduled", "name": rule.get("id", ""), "properties": {"displayName": rule["title"], "severity": SEVERITY.get(rule.get("level", "medium"), "Medium"), "query": _translated(rule, "kql"), "queryFrequency": "PT1H", "queryPeriod": "PT1H", "triggerOperator": "GreaterThan", "triggerThreshold": 0, "tactics": tactics}}, sort_keys=True)


def number_of(rule_id: str, base: int = 100_000, size: int = 900_000) -> int:
    """A number from an id's hexadecimal digits, read one after another."""
    return base + int(re.sub("[^0-9a-f]", "", rule_id.lower()) or "0", 16) % size


def wazuh(rule: dict) -> str:
    """One rule with a pattern for each field, all of which must hold; the condition isn't expressed, and excluded selections are negated."""

    def patterns() -> list[str]:
        out = negated(rule)
        return [f'    <field name="{escape(WAZUH_FIELDS.get(f, f))}" type="pcre2"{" negate=" + chr(34) + "yes" + chr(34) if s in out else ""}>{escape(_regex(m, v))}</field>' for s, f, m, v in fields_of(rule)]

    lines = [f'  <rule id="{number_of(rule.get("id", ""))}" level="{WAZUH_LEVEL.get(rule.get("level", "medium"), 8)}">']
    lines += _once(rule, "wazuh", patterns)
    return "\n".join(['<group name="lodewerk,">', *lines, f"    <description>{escape(rule['title'])}</description>", "  </rule>", "</group>"])


def chronicle(rule: dict) -> str:
    """A YARA-L rule of the selections that aren't excluded, all of which must hold."""
    name = re.sub(r"[^0-9a-z]+", "_", rule["title"].lower()).strip("_") or "rule"
    suffix = rule.get("id", "").replace("-", "")[-8:]
    events = _once(rule, "chronicle", lambda: [f"    re.regex($e.{CHRONICLE_FIELDS.get(f, f)}, `{_regex(m, v)}`)" for s, f, m, v in fields_of(rule) if s not in negated(rule)])
    return "\n".join([f"rule {name}_{suffix} {{", "  meta:", f'    severity = "{SEVERITY.get(rule.get("level", "medium"), "Medium").upper()}"', "  events:", *events, "  condition:", "    $e", "}"])


def _hosts(rule: dict) -> tuple[list[str], list[str]]:
    def found() -> tuple[list[str], list[str]]:
        names, addresses = [], []
        for s, f, _, v in fields_of(rule):
            if s not in negated(rule):
                (names if f == "DestinationHostname" else addresses if f == "DestinationIp" else []).extend(v)
        return names, addresses

    return _once(rule, "hosts", found)


def _sid(rule_id: str, nth: int) -> int:
    return int(rule_id.replace("-", "")[:8] or "0", 16) % 9_000_000 + 1_000_000 + nth


def suricata(rule: dict) -> str:
    names, addresses = _hosts(rule)
    title = rule["title"].replace('"', "'")
    made = [f'alert dns any any -> any any (msg:"{title}"; dns.query; content:"{n}"; nocase; sid:{{}}; rev:1;)' for n in names] + [f'alert ip any any -> {a} any (msg:"{title}"; sid:{{}}; rev:1;)' for a in addresses]
    return "\n".join(m.format(_sid(rule.get("id", ""), i)) for i, m in enumerate(made))


def snort(rule: dict) -> str:
    """For each host name a rule for TCP and one for UDP, for each address one."""
    names, addresses = _hosts(rule)
    title = rule["title"].replace('"', "'")
    made = [f'alert {p} any any -> any any (msg:"{title}"; content:"{n}"; nocase; sid:{{}}; rev:1;)' for n in names for p in ("tcp", "udp")] + [f'alert ip any any -> {a} any (msg:"{title}"; sid:{{}}; rev:1;)' for a in addresses]
    return "\n".join(m.format(_sid(rule.get("id", ""), i)) for i, m in enumerate(made))


def falcon(rule: dict, action: str = "detect") -> str:
    """Indicators of a rule as custom ones: domains, addresses of both kinds, MD5 and SHA-256."""
    names, addresses = _hosts(rule)
    rows = [("domain", n) for n in names] + [("ipv6" if ":" in a else "ipv4", a) for a in addresses]
    for s, f, _, values in fields_of(rule):
        if f == "Hashes" and s not in negated(rule):
            rows += [(k.lower(), h) for k, _, h in (v.partition("=") for v in values) if k.lower() in ("md5", "sha256")]
    return json.dumps({"indicators": [{"type": k, "value": v, "action": action, "severity": rule.get("level", "medium"), "description": rule["title"]} for k, v in rows]}, sort_keys=True)


COMPILERS: dict[str, Callable[[dict], str]] = {
    **{d: (lambda rule, d=d: _translated(rule, d)) for d in R.DIALECTS},
    "sentinel": sentinel,
    "wazuh": wazuh,
    "chronicle": chronicle,
    "suricata": suricata,
    "snort": snort,
    "falcon": falcon,
}
ONLY_NETWORK = ("suricata", "snort")
OPTIONAL = ("falcon", "datadog")  # left out unless asked for
DEFAULT = tuple(d for d in COMPILERS if d not in OPTIONAL)


def compiled(made: DataFrame, dialects: tuple[str, ...] = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """(rule_id, dialect, text) and what columns to keep: every rule (see ``generate.rules``) for every engine, network sensors for network rules only; no text, no row.

    A scan with a small cross product inside: rules aren't shuffled.  What
    follows from selections, condition and log source is made once for all
    rules that share them, as far as a worker remembers.
    """
    unknown = set(dialects) - set(COMPILERS)
    if unknown:
        raise ValueError(f"dialects {sorted(unknown)}")
    own = ("rule_id", "dialect", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes: dict[str, tuple[dict, Detection]] = {}
        for batch in batches:
            ids, names, texts, at = [], [], [], []
            columns = (batch.column(i).to_pylist() for i in range(6))
            for i, (incident, layer, subtype, rule_id, level, shape) in enumerate(zip(*columns, strict=True)):
                if shape not in shapes:
                    if len(shapes) >= MAX_SHAPES:
                        shapes.clear()
                    read = json.loads(shape)
                    detection = Detection({"condition": read.get("condition")})
                    for x in read["fields"]:
                        detection.setdefault(x["selection"], {})[x["field"]] = x["values"]
                    shapes[shape] = {"category": read.get("category"), "product": read.get("product")}, detection
                source, detection = shapes[shape]
                rule = {"title": f"{layer} {subtype} {incident}", "id": rule_id, "level": level, "logsource": source, "detection": detection}
                for d in dialects:
                    if d not in ONLY_NETWORK or source["category"] in NETWORK:
                        try:
                            text = COMPILERS[d](rule)
                        except ValueError:  # a comparison that the engine can't say
                            continue
                        if text:
                            ids.append(rule_id)
                            names.append(d)
                            texts.append(text)
                            at.append(i)
            kept = batch.select(list(range(6, batch.num_columns))).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.string()) for x in (ids, names, texts)), *kept.columns], [*own, *keep])

    shape = F.to_json(F.struct("category", "product", "condition", "fields"))
    types = "".join(f", `{c}` {made.schema[c].dataType.simpleString()}" for c in keep)
    return made.select("incident_id", "layer", "subtype", "rule_id", "level", shape, *(F.col(c).alias(f"_kept_{c}") for c in keep)).mapInArrow(scan, f"rule_id string, dialect string, text string{types}")


def yara(incidents: DataFrame) -> DataFrame:
    """(id, text): a YARA rule for each incident (id, sha256, domains, ips, confidence of the surest) with indicators of 0.70 or more; two addresses or more need two hits."""
    sure = incidents.filter(F.coalesce(F.col("confidence") >= MIN_YARA, F.lit(False)))

    def strings(column: str, mark: str) -> Column:
        return F.transform(column, lambda v, i: F.concat(F.lit(f"    ${mark}"), i.cast("string"), F.lit(' = "'), F.replace(v, F.lit('"'), F.lit('\\"')), F.lit('" ascii wide')))

    hashes = F.transform("sha256", lambda h: F.concat(F.lit('hash.sha256(0, filesize) == "'), F.lower(h), F.lit('"')))
    parts = F.array_compact(F.concat(hashes, F.array(F.when(F.size("domains") > 0, F.lit("any of ($d*)")), F.when(F.size("ips") > 1, F.lit("2 of ($i*)")).when(F.size("ips") == 1, F.lit("any of ($i*)")))))
    body = F.concat(strings("domains", "d"), strings("ips", "i"))
    text = F.concat(F.lit('import "hash"\n\nrule '), F.regexp_replace(F.concat(F.lit("r_"), F.col("id").cast("string")), "[^A-Za-z0-9_]", "_"), F.lit(" {\n"), F.when(F.size(body) > 0, F.concat(F.lit("  strings:\n"), F.array_join(body, "\n"), F.lit("\n"))).otherwise(""), F.lit("  condition:\n    "), F.array_join(parts, " or "), F.lit("\n}\n"))
    return sure.withColumn("_n", F.size(parts)).filter("_n > 0").select("id", text.alias("text"))
