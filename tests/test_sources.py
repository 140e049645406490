import json

import pytest

from lodewerk.sources import landed, sinks


@pytest.fixture
def land(tmp_path):
    def write(name, *rows):
        (tmp_path / name).mkdir()
        for i, r in enumerate(rows):
            (tmp_path / name / f"{i}.json").write_text(r if isinstance(r, str) else json.dumps(r))
        return str(tmp_path / name)

    return write


def test_osv(spark, land):
    base = {"id": "MAL-1", "modified": "2024-02-01T00:00:00Z", "affected": [{"package": {"name": "x", "ecosystem": "PyPI"}, "versions": ["1"]}, {"package": {"name": "", "ecosystem": "npm"}}]}
    path = land("osv", base | {"severity": [{"type": "CVSS_V3", "score": "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H"}]}, base | {"id": "MAL-2", "affected": []}, base | {"id": "MAL-3", "modified": "2023-01-01T00:00:00Z"}, base | {"id": "MAL-4", "affected": [{"package": {"name": "y", "ecosystem": "Alpine:v3"}}], "database_specific": {"severity": "moderate"}}, "{broken")
    got = {r.id: r for r in landed.read(spark, "osv", path, "2024-01-01").collect()}
    assert set(got) == {"pypi-osv-MAL-1", "alpine:v3-osv-MAL-4"}
    one = got["pypi-osv-MAL-1"]
    assert (one.severity, [p.name for p in one.packages], one.references) == ("critical", ["x"], ["https://osv.dev/vulnerability/MAL-1"])
    assert got["alpine:v3-osv-MAL-4"].severity == "medium"


def test_vulnerability_feeds(spark, land):
    cve = lambda i, text, score: {"cve": {"id": i, "published": "2024-01-01T00:00:00Z", "descriptions": [{"lang": "es", "value": "no"}, {"lang": "en", "value": text}], "metrics": {"cvssMetricV31": [{"cvssData": {"baseScore": score}}]} if score else {}}}
    nvd = land("nvd", {"vulnerabilities": [cve("A", "bad", 9.1), cve("B", "** REJECT ** x", 9.0), cve("C", "mild", 5.0), cve("D", "unscored", 0)]})
    assert sorted((r.id, r.severity, r.description) for r in landed.nvd(spark, nvd).collect()) == [("nvd-A", "critical", "bad"), ("nvd-D", "low", "unscored")]
    kev = land("kev", {"vulnerabilities": [{"cveID": "CVE-1", "vulnerabilityName": "n", "shortDescription": "d", "dateAdded": "2024-01-02", "knownRansomwareCampaignUse": "Known", "notes": "https://a ; b"}]})
    r = landed.kev(spark, kev).first()
    assert (r.id, r.exploited, r.campaign, r.references, r.severity) == ("cisa-CVE-1", True, "ransomware", ["https://a"], "critical")
    ghsa = land("ghsa", {"ghsa_id": "GHSA-1", "severity": "HIGH", "summary": "s", "published_at": "2024-01-01T00:00:00Z", "vulnerabilities": [{"package": {"ecosystem": "npm", "name": "p"}, "vulnerable_version_range": ">= 1, < 2"}]})
    r = landed.ghsa(spark, ghsa).first()
    assert (r.id, r.severity, r.packages[0].affected_versions) == ("npm-ghsa-GHSA-1", "high", [">= 1", "< 2"])


def test_claims_urls_samples(spark, land, tmp_path):
    claim = {"group_name": "Lock Bit", "post_title": "CafÃ©  Ltd", "country": "FR", "published": "2024-03-01 10:00:00.123456", "post_url": "http:/x.onion/1"}
    got = landed.ransomware_claims(spark, land("claims", [claim, claim, claim | {"post_title": ""}])).collect()
    assert len(got) == 1 and got[0].id == "ransomware_live-lock-bit-caf-ltd-20240301"
    assert got[0].description.endswith("Café Ltd; country: FR") and got[0].iocs[0].value == "http://x.onion/1"
    (tmp_path / "u.csv").write_text('# id\n"1","2024-01-01 00:00:00","http://Evil.bad:80/x","online","","RedLine","exe","r"\n"2","2024-01-01 00:00:00","http://e.bad","offline"\n"3","2024-01-01 00:00:00","http://f.bad","online"\n')
    got = sorted(landed.malicious_urls(spark, str(tmp_path / "u.csv")).collect())
    assert [(r.id, r.campaign, [i.value for i in r.iocs]) for r in got] == [("urlhaus-1", "RedLine", ["http://Evil.bad:80/x", "evil.bad"]), ("urlhaus-3", None, ["http://f.bad", "f.bad"])]
    r = landed.malware_samples(spark, land("s", {"sha256_hash": "AB" * 32, "md5_hash": "c" * 32, "first_seen": "2024-01-01 00:00:00", "signature": "Trojan"})).first()
    assert (r.id, r.campaign, [i.type for i in r.iocs]) == ("malware_bazaar-" + "ab" * 8, None, ["sha256", "md5"])


def test_cycles_and_models(spark, land):
    path = land("eol", *({"product": "nodejs", "cycle": c, "eol": e} for c, e in (("18", "2024-05-01"), ("16", "2020-05-01"), ("99", "2999-01-01"), ("x", "false"))))
    assert [r.id for r in landed.end_of_life(spark, path, "2023-01-01", "2025-01-01").collect()] == ["container-eol-nodejs-18-2024"]
    path = land("hf", *({"id": i, "siblings": [{"rfilename": f} for f in fs]} for i, fs in (("a/b", ["m.safetensors", "m.bin"]), ("a/c", ["X.PT", "y.bin"]), ("a/d", ["m.safetensors"]))))
    got = {r.id: r for r in landed.model_files(spark, path).collect()}
    assert set(got) == {"huggingface-a-b", "huggingface-a-c"} and got["huggingface-a-b"].attack_type == "model_poisoning" and len(got["huggingface-a-c"].iocs) == 2
    with pytest.raises(KeyError):
        landed.read(spark, "nothing", path)


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", "y")], "id string, module string")
    sinks.write_modules(rows, str(tmp_path / "m"))
    sinks.write_modules(rows.filter("module = 'y'"), str(tmp_path / "m"))
    assert sorted((r.id, r.module) for r in spark.read.json(str(tmp_path / "m")).collect()) == [("a", "x"), ("b", "x"), ("c", "y")]
    sinks.write_lines(rows.unionAll(rows), "id", str(tmp_path / "t"))
    assert [r.value for r in spark.read.text(str(tmp_path / "t")).collect()] == ["a", "b", "c"]
    assert sum(r.lines for r in sinks.line_counts(spark, str(tmp_path / "t")).collect()) == 3
    assert sinks.manifest(spark, str(tmp_path / "t")).filter("length(sha256) = 64 and bytes > 0").count() >= 1
