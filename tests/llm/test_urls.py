from __future__ import annotations

import re

import pytest

from checks.compare import canonical, oracle_connection
from feedloom.llm import url_filters as urls
from feedloom.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import ordered, tuples

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["page_id", "host", "path", "rule", "verdict", "pattern"]
ODD = [
    None, "", "nothing", "http://", "://x.org/", "http://EXAMPLE.org/en/1", "http://a.example.org/en/12?x", "http://example.org/en/2",
    "http://example.org", "http://example.org?/es/", "http://notexample.org/es/", "http://x.com/FR/", "http://x.com/fr/#a?b", "http://com/de/",
    "http://xcom/de/", "http://x.net/?page=2&ref=y", "http://x.net/es/?page=2&ref=y", "http://x.net/a\n?page=1\n&ref=", "HTTP://X.NET/ES?PAGE=1&REF=",
    "http://x.net/a?utm_source=feed", "http://x.net/a?utm_source=feeds", "http://www.spam-farm.net/a", "http://xspam-farm.net/a", "http://x.net/spam-farm.",
    "a://b://c.org/x", "http://user@example.org:80/es/", "http://é.example.org/es/ü", "http://x.org/" + "a/" * 50_000 + "?page=1&ref=2", "http://x.net/es",
]


def brute(rows, hosts, patterns):
    """Every rule on every URL, without tokens."""
    out = []
    for page_id, url in rows:
        host, path = "", ""
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        if found:
            host = "".join(c.lower() if c.isascii() else c for c in found[1])
            path = found[2]
        fits = [r for r in hosts if found and ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        lowered = "".join(c.lower() if c.isascii() else c for c in url or "")
        matches = [p for p in patterns if url is not None and re.search(p.regex(), lowered, re.S)]
        if fits:
            longest = max(fits, key=lambda r: len(r.text))
            out.append((page_id, host, path, longest.text, longest.verdict, None))
        elif matches:
            first = min(matches, key=lambda p: (p.verdict == "block", p.text))
            out.append((page_id, host, path, None, first.verdict, first.text))
        else:
            out.append((page_id, host, path, None, "allow", None))
    return ordered(out)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "h", "v", 1) for i, u in enumerate(ODD)] + [(None, ODD[5], "h", "v", 1), (3, ODD[7], None, None, None), (3, ODD[7], None, None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, token int").repartition(3)


def test_matches_brute_force(pages):
    rows = [(r.page_id, r.url) for r in pages.collect()]
    assert tuples(urls.judge_pages(pages), *COLUMNS) == brute(rows, urls.HOST_RULES, urls.PATTERN_RULES)


def test_matches_sql(spark):
    with oracle_connection(SMALL) as connection:
        theirs = connection.sql(ORACLES["op13_url_filters"]).df()
    assert canonical(QUERIES["op13_url_filters"](spark, SMALL).toPandas()) == canonical(theirs)
    assert set(theirs["verdict"]) == {"allow", "block"} and theirs["pattern"].notna().any() and theirs["rule"].notna().any()


def test_rules_are_filed_under_their_rarest_token(pages):
    holders = urls.token_holders(pages, "url", ["example", "org", "es", "page"])
    assert holders["org"] > holders["es"]
    index = urls.RuleIndex(urls.HOST_RULES, urls.PATTERN_RULES, holders)
    assert "es" in index.filed and not index.always
    # A URL without the token never reaches the rule's expression.
    assert {r.text for r, _ in index.candidates("http://a.net/xx/")} == set()


def test_tokens_are_whole():
    assert urls.HostRule("block", "example.org", "/en/1").tokens() == {"example", "org", "en"}
    assert urls.HostRule("block", "example.org").tokens() == {"example", "org"}
    assert urls.PatternRule("block", "||ads*track^png|").tokens() == {"png"}
    assert urls.PatternRule("block", "banner").tokens() == set()


def test_many_rules_and_rules_without_tokens(spark, pages):
    hosts = [urls.HostRule("block" if i % 2 else "allow", f"h{i}.net", f"/p{i}/") for i in range(500)]
    patterns = [urls.PatternRule("block", "utm"), urls.PatternRule("allow", "|http:*.net/a?"), urls.PatternRule("block", "^de^|")]
    rows = [(i, f"http://www.h{i}.net/p{i}/x") for i in range(0, 500, 7)] + [(r.page_id, r.url) for r in pages.collect()]
    df = spark.createDataFrame(rows, "page_id long, url string")
    assert tuples(urls.filter_urls(df, hosts, patterns), *COLUMNS) == brute(rows, hosts, patterns)


def test_no_pages(spark):
    assert urls.judge_pages(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_too_many_rules_are_refused(pages, monkeypatch):
    monkeypatch.setattr(urls, "MOST_RULES", 3)
    with pytest.raises(ValueError):
        urls.judge_pages(pages)
