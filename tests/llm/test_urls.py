"""Allow and block rules: the trie against a plain search through all rules."""

import re

import pytest

from tallyweave.llm import urls as U
from tallyweave.llm.queries import QUERIES, URL_RULES

RULES = [
    *URL_RULES, U.Rule("block", "Bad.example.org"), U.Rule("allow", "bad.example.org"), U.Rule("allow", "bad.example.org", "/ok/"),
    U.Rule("block", "net", "/a/b"), U.Rule("allow", "net", "/a/bc"), U.Rule("block", "x.net", ""),
]
URLS = [
    None, "", "no scheme", "http://", "http://org", "HTTP://Org/", "a://example.org/es/", "a://example.org/es", "a://w.example.org/en/12?q=/es/",
    "a://notexample.org/es/x", "a://example.org#/es/", "a://example.org?x=://com/de/", "a://COM/de/x", "a://a.b.com/fr/", "a://com/fr",
    "a://bad.example.org", "a://bad.example.org/ok/x", "a://BAD.EXAMPLE.ORG/ok", "a://net/a/bcd", "a://net/a/b", "a://net/a", "a://x.net/a/bc",
    "a://x.net/a\nb", "a://ÄÖ.org/ü", "a://.org/", "a://org./", "a://h/" + "s/" * 20_000, "x" * 50_000, "a://org/", "a://org/",
]


def plain(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if f".{host}".endswith(f".{r.host.lower()}") and path.startswith(r.path)]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"))
    return host, path, best.name, best.verdict


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def test_query_against_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    want = sorted(((r["page_id"], *plain(r["url"], URL_RULES)) for r in pages), key=str)
    assert rows_of(QUERIES["op10_urls"](spark, sf)) == want


@pytest.mark.parametrize("rules", [RULES, [], RULES[:1]])
@pytest.mark.parametrize("default", ["allow", "block"])
def test_awkward_addresses(spark, rules, default):
    given = [(None if i % 7 == 0 else i, u) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame([(k, u, "h", "r", "p") for k, u in given], "page_id long, url string, host string, rule string, path string")
    want = sorted(((k, *plain(u, rules, default)) for k, u in given), key=str)
    assert rows_of(U.judge_urls(pages, rules, default=default)) == want


def test_empty_table(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


@pytest.mark.parametrize("rule", [U.Rule("maybe", "org"), U.Rule("allow", "org", "path")])
def test_rules_that_say_nothing_are_refused(rule):
    with pytest.raises(ValueError):
        U.UrlTrie([rule])
