"""Rules from incidents: a table of templates, each a log source, selections and a condition; an incident gives a row for each that it has values for.

Layers and when they apply: exposure (signatures of lock files, files that are
there), indicators (network, hashes, persistence, messenger; only with an
indicator of confidence 0.60 or more, and only values that the normaliser
leaves), hunting (by behaviour), malware, ransomware (but not for claims of the
module of that name), CVE, container (CVSS 7 or more, or exploited), and the
ecosystems that have rules of their own.

Absent values give no rule: null and empty arrays count as none.  Behaviours
without a template, and the credential template that nobody ever wrote, give
none either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..functions import gates as G
from ..functions import words as W

NAMESPACE = "lodewerk:rule:"
BEHAVIOURS = {"BEH-001": "memory_read", "BEH-002": "manager_network", "BEH-005": "manager_network", "BEH-007": "manager_network", "BEH-003": "persistence_creation", "BEH-004": "persistence_creation", "BEH-006": "destructive_command"}
_SHELLS = [r"\powershell.exe", r"\pwsh.exe"]
_WEB = [r"\httpd.exe", r"\nginx.exe", r"\w3wp.exe"]
_MANAGERS = ["cargo", "node", "npm", "pip"]

#: (layer, subtype): category, product, selections {name: {field|modifier: values or column}}, condition (None: any selection that has values)
TEMPLATES: dict[tuple[str, str], tuple[str, str, dict, str | None]] = {
    ("exposure", "lockfile"): ("file_event", "any", {"selection": {"TargetFilename|contains": "lockfiles"}}, "selection"),
    ("exposure", "file_presence"): ("file_event", "any", {"selection": {"TargetFilename|contains": "files"}}, "selection"),
    ("ioc", "network"): ("network_connection", "any", {"selection_domain": {"DestinationHostname|contains": "domains"}, "selection_ip": {"DestinationIp|contains": "ips"}, "selection_url": {"DestinationHostname|contains": "urls"}}, None),
    ("ioc", "hashes"): ("file_event", "any", {"selection": {"Hashes|contains": "hashes"}}, "selection"),
    ("ioc", "persistence"): ("file_event", "any", {"selection_service": {"TargetFilename|contains": "services"}, "selection_macos": {"TargetFilename|contains": "launch_agents"}, "selection_linux": {"TargetFilename|contains": "systemd"}}, None),
    ("ioc", "session"): ("network_connection", "any", {"selection_seed": {"DestinationHostname|contains": "seed_nodes"}, "selection_fileserver": {"DestinationHostname|contains": "file_servers"}, "selection_recipient": {"CommandLine|contains": "recipients"}}, None),
    ("hunting", "memory_read"): ("process_access", "linux", {"selection": {"TargetImage|contains": ["/proc/"], "TargetImage|endswith": ["/mem"], "SourceImage|contains": ["node", "npm"]}}, "selection"),
    ("hunting", "manager_network"): ("network_connection", "any", {"selection_process": {"Image|contains": [*_MANAGERS, "pip3"]}, "filter_registry": {"DestinationHostname|contains": ["crates.io", "files.pythonhosted.org", "pypi.org", "registry.npmjs.org", "static.crates.io"]}}, "selection_process and not filter_registry"),
    ("hunting", "persistence_creation"): ("file_event", "any", {"selection_launchagent": {"TargetFilename|contains": [f"{p}/Library/Launch{k}/" for p, k in (("", "Agents"), ("", "Daemons"), ("~", "Agents"))], "ParentImage|contains": _MANAGERS}, "selection_systemd": {"TargetFilename|contains": [f"{p}/systemd/{k}/" for p, k in (("/etc", "system"), ("/usr/lib", "system"), ("~/.config", "user"))], "ParentImage|contains": _MANAGERS}}, "selection_launchagent or selection_systemd"),
    ("hunting", "destructive_command"): ("process_creation", "linux", {"selection_rm": {"Image|endswith": ["/rm", "/shred"], "CommandLine|contains": ["--force", "-fr", "-rf"], "ParentImage|contains": ["bash", "node", "npm", "sh"]}, "selection_shred": {"Image|endswith": ["/shred"], "ParentImage|contains": ["node", "npm"]}}, "selection_rm or selection_shred"),
    ("malware", "mutex"): ("create_remote_thread", "windows", {"selection": {"EventID": ["17"], "PipeName|contains": "mutexes"}}, "selection"),
    ("malware", "named_pipe"): ("pipe_created", "windows", {"selection": {"EventID|contains": ["17", "18"], "PipeName|contains": "pipes"}}, "selection"),
    ("malware", "registry"): ("registry_set", "windows", {"selection": {"EventID": ["13"], "TargetObject|contains": "registry_keys"}}, "selection"),
    ("malware", "proc_injection"): ("process_access", "windows", {"selection": {"EventID": ["10"], "TargetImage|endswith": [r"\lsass.exe", r"\svchost.exe"], "GrantedAccess|contains": ["0x1010", "0x1410", "0x1438", "0x143a"]}, "filter_legit": {"SourceImage|contains": ["\\Windows\\SysWOW64\\", "\\Windows\\System32\\"]}}, "selection and not filter_legit"),
    ("ransomware", "shadow_copy"): ("process_creation", "windows", {"selection_vssadmin": {"Image|endswith": [r"\vssadmin.exe"], "CommandLine|contains|all": ["delete", "shadows"]}, "selection_wmic": {"Image|endswith": [r"\wmic.exe"], "CommandLine|contains|all": ["delete", "shadowcopy"]}, "selection_powershell": {"Image|endswith": _SHELLS, "CommandLine|contains": ["Get-WmiObject Win32_ShadowCopy"]}}, "1 of selection_*"),
    ("ransomware", "recovery_inhibit"): ("process_creation", "windows", {"selection_bcdedit": {"Image|endswith": [r"\bcdedit.exe"], "CommandLine|contains": ["bootstatuspolicy ignoreallfailures", "recoveryenabled no"]}}, "selection_bcdedit"),
    ("ransomware", "log_clear"): ("process_creation", "windows", {"selection_wevtutil": {"Image|endswith": [r"\wevtutil.exe"], "CommandLine|contains": [" cl ", " clear-log "]}, "selection_powershell": {"Image|endswith": _SHELLS, "CommandLine|contains": ["Clear-EventLog"]}}, "1 of selection_*"),
    ("ransomware", "mass_rename"): ("file_rename", "windows", {"selection": {"TargetFilename|endswith": "renames"}}, "selection"),
    ("ransomware", "ransom_note"): ("file_creation", "windows", {"selection": {"TargetFilename|endswith": "notes"}}, "selection"),
    ("ransomware", "exfil_tools"): ("process_creation", "windows", {"selection": {"Image|endswith": "tool_images", "CommandLine|contains": ["copy", "sync", "upload"]}}, "selection"),
    ("cve", "scanner_ua"): ("webserver", "any", {"selection": {"cs-user-agent|contains": "user_agents"}}, "selection"),
    ("cve", "http_pattern"): ("webserver", "any", {"selection": {"cs-uri-query|contains": "patterns"}}, "selection"),
    ("cve", "web_shell"): ("file_creation", "windows", {"selection_webroot": {"TargetFilename|contains": ["/var/www/", "\\htdocs\\", "\\inetpub\\wwwroot\\", "\\www\\"], "TargetFilename|endswith": [".asp", ".aspx", ".jsp", ".jspx", ".php"]}, "filter_legit": {"Image|contains": _WEB}}, "selection_webroot and not filter_legit"),
    ("cve", "web_outbound"): ("network_connection", "windows", {"selection": {"Image|contains": [*_WEB, r"\java.exe", r"\php-cgi.exe", r"\php.exe", r"\tomcat"], "Initiated": ["true"], "DestinationPort|contains": ["443", "4444", "80", "8080"]}, "filter_update": {"DestinationIp|startswith": ["10.", "127.", "192.168."]}}, "selection and not filter_update"),
    ("cve", "post_exploit"): ("process_creation", "windows", {"selection": {"ParentImage|contains": [*_WEB, r"\java.exe", r"\php.exe"], "Image|endswith": [rf"\{x}.exe" for x in ("bitsadmin", "certutil", "cmd", "curl", "powershell", "wget")]}}, "selection"),
    ("container", "vuln"): ("container_image_pull", "any", {"selection": {"Image|contains": "images"}}, "selection"),
    ("container", "eol"): ("container_image_pull", "any", {"selection": {"Image|startswith": "eol_prefixes"}}, "selection"),
    ("supply", "github_actions_compromised"): ("github_actions_workflow", "github", {"selection": {"uses|contains": "action_refs"}}, "selection"),
    ("supply", "hf_malicious_model"): ("process_creation", "linux", {"selection_model_ref": {"CommandLine|contains": "models"}}, "selection_model_ref"),
    ("supply", "hf_format_downgrade"): ("process_creation", "linux", {"selection_model_ref": {"CommandLine|contains": "downgraded_models"}, "selection_binary_ext": {"CommandLine|contains": [".bin", ".pt"]}}, "selection_model_ref and selection_binary_ext"),
}
ARRAYS = ("lockfiles", "files", "domains", "ips", "urls", "hashes", "services", "launch_agents", "systemd", "seed_nodes", "file_servers", "recipients", "behaviours", "mutexes", "pipes", "registry_keys", "notes", "tools", "user_agents", "patterns", "images", "eol_images", "actions", "models", "downgraded_models")


def unpinned_action(action: str) -> dict:
    """The rule for a workflow that uses an action by a mutable tag: for a trusted one, on demand; incidents don't give it."""
    return {"title": f"Mutable tag of {action}", "level": "informational", "logsource": {"category": "github_actions_workflow", "product": "github"}, "detection": {"selection": {"uses|re": f"^{action}@v[0-9]"}, "condition": "selection"}}


def rule_id(incident: Column, layer: str, subtype: Column) -> Column:
    return E.uuid5(F.concat(F.lit(NAMESPACE), incident.cast("string"), F.lit(f":{layer}:"), subtype))


def _has(name: str) -> Column:
    return F.size(name) > 0


def prepared(incidents: DataFrame) -> DataFrame:
    """Incidents with all arrays that templates read: absent ones empty, indicators normalised, names put together."""
    out = incidents
    for name in ARRAYS:
        out = out.withColumn(name, F.coalesce(F.col(name), F.array().cast("array<string>")) if name in incidents.columns else F.array().cast("array<string>"))
    for name, kind in (("domains", "domain"), ("ips", "ip"), ("urls", "url")):
        out = out.withColumn(name, F.array_compact(F.transform(name, _cleaned(kind))))
    out = out.withColumn("renames", F.concat("notes", F.array(*map(F.lit, (".encrypted", ".locked", ".ransom")))))
    out = out.withColumn("tool_images", F.transform("tools", lambda t: F.concat(F.lit("\\"), t, F.lit(".exe"))))
    out = out.withColumn("action_refs", F.transform("actions", lambda a: F.concat(a, F.lit("@"))))
    return out.withColumn("eol_prefixes", F.flatten(F.transform("eol_images", lambda i: F.array(F.concat(i, F.lit(".")), F.concat(i, F.lit("-"))))))


def _cleaned(kind: str):
    return lambda v: E.normalize_ioc(F.lit(kind), v)


def _applies() -> dict[tuple[str, str], Column]:
    sure = F.coalesce(F.col("sure"), F.lit(False))
    ransom = F.coalesce(F.col("ransomware"), F.lit(False)) & (F.col("module") != "ransomware")
    web = (F.coalesce(F.col("cve"), F.lit("")) != "") & (_has("user_agents") | _has("patterns"))
    serious = F.coalesce(F.col("cvss") >= 7, F.lit(False)) | F.coalesce(F.col("exploited"), F.lit(False))
    out = {}
    for key, (_, _, selections, condition) in TEMPLATES.items():
        layer, subtype = key
        sources = [v for fields in selections.values() for v in fields.values() if isinstance(v, str)]
        has = [_has("notes" if s == "renames" else s) for s in sources]
        values = F.lit(True)
        if has and condition is None:
            values = has[0]
            for h in has[1:]:
                values = values | h
        elif has and subtype != "mass_rename":
            values = has[0]
        gate = {"ioc": sure, "ransomware": ransom, "container": serious}.get(layer, F.lit(True))
        if key == ("malware", "proc_injection"):
            gate = F.coalesce(F.col("family"), F.lit("")) != ""
        if key in (("cve", "web_shell"), ("cve", "web_outbound"), ("cve", "post_exploit")):
            gate = web
        if layer == "hunting":
            values = F.arrays_overlap("behaviours", F.array(*(F.lit(b) for b, t in BEHAVIOURS.items() if t == subtype)))
        out[key] = gate & values
    return out


def rules(incidents: DataFrame) -> DataFrame:
    """(incident_id, layer, subtype, rule_id, category, product, fields, condition, level): the rules of incidents; fields are (selection, field, values).

    A behaviour gives a rule each, named by the behaviour.  Arrays may be
    absent; id, module, severity, cvss, exploited, ransomware, family, cve and
    sure (an indicator of 0.60 or more) are read where a layer needs them.
    """
    rows, applies, made = prepared(incidents), _applies(), []
    for (layer, subtype), (category, product, selections, condition) in TEMPLATES.items():
        fields = []
        for name, items in selections.items():
            for field, values in items.items():
                held = F.col(values) if isinstance(values, str) else F.array(*map(F.lit, values))
                fields.append(F.struct(F.lit(name).alias("selection"), F.lit(field).alias("field"), held.alias("values")))
        chosen = F.filter(F.array(*fields), lambda x: F.size(x["values"]) > 0)
        said = F.lit(condition) if condition else W.condition([(name, F.col(next(iter(items.values())))) for name, items in selections.items()])
        mine = [b for b, t in BEHAVIOURS.items() if t == subtype] if layer == "hunting" else [subtype]
        for name in mine:
            when = applies[layer, subtype] & F.array_contains("behaviours", name) if layer == "hunting" else applies[layer, subtype]
            made.append(F.when(when, F.struct(F.lit(layer).alias("layer"), F.lit(name).alias("subtype"), F.lit(category).alias("category"), F.lit(product).alias("product"), chosen.alias("fields"), said.alias("condition"))))
    level = F.coalesce(F.nullif(F.lower(F.col("severity")), F.lit("")), F.lit("medium"))
    each = rows.select(F.col("id").alias("incident_id"), level.alias("level"), F.explode(F.array_compact(F.array(*made))).alias("r")).select("incident_id", "r.*", "level")
    name = F.concat(F.lit(NAMESPACE), F.col("incident_id").cast("string"), F.lit(":"), "layer", F.lit(":"), "subtype")
    return each.withColumn("rule_id", E.uuid5(name))


def rendered(made: DataFrame) -> DataFrame:
    """The rules with ``text``: YAML whose values are quoted."""

    def quoted(value: Column) -> Column:
        return F.concat(F.lit("      - '"), W.yaml_quoted(value), F.lit("'"))

    def lines(x: Column) -> Column:
        return F.concat(F.lit("    "), x["field"], F.lit(":\n"), F.array_join(F.transform(x["values"], quoted), "\n"))

    def block(name: Column) -> Column:
        return F.concat(F.lit("  "), name, F.lit(":\n"), F.array_join(F.transform(F.filter("fields", lambda x: x["selection"] == name), lines), "\n"))

    names = F.array_distinct(F.transform("fields", lambda x: x["selection"]))
    head = F.concat(F.lit("title: "), "layer", F.lit(" "), "subtype", F.lit("\nid: "), "rule_id", F.lit("\ndescription: |\n  Incident: "), F.col("incident_id").cast("string"), F.lit("\nlogsource:\n  category: "), "category", F.lit("\n  product: "), "product", F.lit("\ndetection:\n"))
    return made.withColumn("text", F.concat(head, F.array_join(F.transform(names, block), "\n"), F.lit("\n  condition: "), "condition", F.lit("\nlevel: "), "level", F.lit("\n")))


def eligible(incidents: DataFrame, confidences: str = "confidences") -> DataFrame:
    """Incidents with ``sure``, from the array of their indicators' confidences."""
    return incidents.withColumn("sure", G.sure_indicator(F.col(confidences)))
