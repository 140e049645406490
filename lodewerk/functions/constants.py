"""Tables that are part of the semantics: weights, thresholds, allow and deny lists."""

from __future__ import annotations


def _table(text: str) -> dict[str, float]:
    return {name: float(value) for value, names in (line.split(maxsplit=1) for line in text.strip().splitlines()) for name in names.split()}


SOURCE_WEIGHTS = _table(
    """
    0.70 corvus
    0.75 blackfog coveware deps_dev
    0.78 malwarebytes polyswarm snyk
    0.80 aikido microsoft_sec ransomware_live stepsecurity tenable
    0.82 greynoise horizon3 phylum proofpoint sekoia sonatype vulncheck watchtowr
    0.83 attackerkb
    0.85 emsisoft ossf rapid7 red_canary talos
    0.87 eset unit42
    0.88 elastic_labs secureworks
    0.90 cisa dfir_report msrc socket wiz
    0.92 nvd project_zero
    0.95 ghsa osv
    """
)
MODULES = ("supply", "malware", "ransomware", "cve", "container", "os-packages")
SEVERITIES = ("low", "medium", "high", "critical")
DECAY = ((180, 0.40), (90, 0.70))
STATUS = ((0.85, "stable"), (0.60, "test"), (0.40, "experimental"))
IMPACT = ((1_000_000, "critical"), (100_000, "high"), (10_000, "medium"), (1_000, "low"))
RESERVED_TLDS = "corp example home internal intranet invalid lan local localdomain localhost test".split()
FILE_EXTENSIONS = (
    "7z bash bat bin bmp cmd cpl dat dll doc docx drv elf exe gif go gz hta ico img inf iso java jpeg jpg js json lnk log ocx pdf php png ppt pptx ps1 py rar rb reg scr svg sys tar tgz tmp ts vbs xls xlsx xml yaml yml zip zsh"
).split()
BENIGN_DOMAINS = sorted(
    """
    abuse.ch ajax.googleapis.com amazon.com any.run app.any.run apple.com archive.org attack.mitre.org bazaar.abuse.ch bitbucket.org blogspot.com
    browserling.com cdn.jsdelivr.net cdn.skypack.dev cdnjs.cloudflare.com censys.io centos.org cloudflare.com code.jquery.com console.aws.amazon.com
    console.cloud.google.com crates.io cve.mitre.org cve.org debian.org developer.mozilla.org discord.com docs.docker.com docs.github.com
    docs.python.org docs.rs drive.google.com elastic.co en.wikipedia.org example.com example.net example.org exploit-db.com feodotracker.abuse.ch
    fonts.googleapis.com fonts.gstatic.com github.com gitlab.com google.com hub.docker.com hybrid-analysis.com ipinfo.io learn.microsoft.com
    linkedin.com lobste.rs medium.com microsoft.com mitre.org news.ycombinator.com npmjs.com nvd.nist.gov outlook.com owasp.org
    packetstormsecurity.com pkg.go.dev portal.azure.com pypi.org raw.githubusercontent raw.githubusercontent.com reddit.com redhat.com
    registry.npmjs.org sans.org schema.org seclists.org shodan.io slack.com sourceforge.net stackoverflow.com status.github.com substack.com t.co
    tria.ge twitter.com ubuntu.com unpkg.com urlhaus.abuse.ch urlscan.io virustotal.com w3.org web.archive.org wikipedia.org wordpress.com
    www.amazon.com www.apple.com www.cloudflare.com www.github.com www.gitlab.com www.google.com www.linkedin.com www.medium.com www.microsoft.com
    www.npmjs.com www.pypi.org www.reddit.com www.stackoverflow.com www.twitter.com www.wordpress.com www.x.com www.youtube.com x.com youtube.com
    zohomail.com
    """.split()
)
BENIGN_SUFFIXES = "blockscout.com ceye dnslog incometax nanguanglu nnnwin qpon quidoaehse shlowcarbon trycloudflare tyk workers worf xidyuyedg zap".split()
RESOLVERS = "1.0.0.1 1.1.1.1 8.8.4.4 8.8.8.8 9.9.9.9".split()
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: 10/8, 127/8, 169.254/16, 172.16/12, 192.168/16; ::1, fc00::/7, fe80::/10
PRIVATE_V4 = rf"^(?:(?:10|127)\.{_OCTET}|169\.254|172\.(?:1[6-9]|2[0-9]|3[01])|192\.168)\.{_OCTET}\.{_OCTET}$"
PRIVATE_V6 = "^(?:::1$|0*(?::0*)*:0*1$|f[cd][0-9a-f]{2}:|fe[89ab][0-9a-f]:)"
EMPTY_HASHES = {
    "sha256": "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
    "sha1": "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "md5": "d41d8cd98f00b204e9800998ecf8427e",
}
NO_PACKAGES = sorted(
    """
    a about above add admin after again against all also an and any are as at back be because been being below both break but by can case class
    continue could count def default did div do does each else error even export false for from func function get github.com had has have he height
    her here him his how href http https i id if import in index into is it its just key length let like may me might module more most must my new no
    none nor not now null of off old on one only onto or our out over own password per req require res result return run see set shall she should
    since size so some span status still struct style such switch than that the their them then there these they this those to token true try two
    type under unless until up upon us use user value version very via vs was we well were what when where which while who whom why width will with
    would yet you your
    """.split()
)
HOMOGLYPHS = ("оОаесрухіı01345", "ooaecpyxiioleas")
CVSS = {
    "AV": {"N": 0.85, "A": 0.62, "L": 0.55, "P": 0.2},
    "AC": {"L": 0.77, "H": 0.44},
    "PR": {"N": 0.85, "L": 0.62, "H": 0.27},
    "PR changed": {"N": 0.85, "L": 0.68, "H": 0.50},
    "UI": {"N": 0.85, "R": 0.62},
    "CIA": {"N": 0.0, "L": 0.22, "H": 0.56},
}
