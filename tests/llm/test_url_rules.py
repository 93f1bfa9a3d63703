import re

from duebook.llm import url_rules
from duebook.llm.url_rules import PATTERN_RULES, SITE_RULES, Rule

URLS = [
    "http://EXAMPLE.net/en/1", "http://a.example.net/en", "http://xexample.net/en/", "https://net/", "https://net",
    "http://a.b.org/fr/x?y#z", "ftp://org/fr/", "http://org.com/fr/", "x://example.com/de/1#f", "no scheme", "", None,
    "http://h/?q=/login/", "http://h/login/", "http://h/LOGIN/", "http://blog.x.org/es/2", "http://h/docs/login/",
    "http://h/search/a/page/2", "a://b://c/d", "http://h\nx/tag/", "http://h/a.zip", "http://user@net:80/", "http://net/en/",
]


def plain(url, rules):
    """Every rule against every URL."""
    match = re.match(r"(?s)(?:.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    sites = [
        r for r in rules if r.kind == "site"
        for h, _, p in [r.text.partition("/")]
        if match and (host == h or host.endswith("." + h)) and path.startswith("/" + p)
    ]
    best = max(sites, key=lambda r: len(r.text), default=None)
    patterns = {
        r.verdict for r in rules
        if match and r.kind == "pattern" and re.search(".*".join(map(re.escape, r.text.split("*"))), host + path)
    }
    verdict = best.verdict if best else "allow" if "allow" in patterns or not patterns else "block"
    return host, path, best.text if best else None, verdict


def test_against_every_rule(spark):
    rules = (*SITE_RULES, *PATTERN_RULES, Rule("*zip", "block"), Rule("se", "block"))
    rows = [(i, u, "r", "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "r", "h"), (None, URLS[3], None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string, host string")
    found = url_rules.judged(df, rules).select("row.page_id", "row.url", "host", "path", "rule", "verdict").collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, rules), r


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    assert url_rules.judged(df, []).first().verdict == "allow"
    assert url_rules.judged(df.limit(0), SITE_RULES).isEmpty()


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("u1", "example"), ("u2", "example"), ("u1", "net"), ("u2", "en"), ("u3", "net"), ("u4", "net")], "url string, token string")
    table = url_rules.rule_table(spark, [Rule("example.net/en/", "block", "site"), Rule("*x", "block")])
    assert {r.rule: r.token for r in url_rules.filed(table, urls).collect()} == {"example.net/en/": "en", "*x": ""}
    assert url_rules.literal_tokens(Rule("ads*track/x-y", "block")) == ["x"]
