"""URL rules against trying every rule on every url."""

from __future__ import annotations

import random

from clickweave.llm import url_filter

PAGES = "page_id LONG, url STRING, rule INT, HOST INT"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, default)
    return host, path, rule, verdict


def check(spark, urls, rules, **settings):
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in urls], PAGES).repartition(2)
    table = spark.createDataFrame(rules, url_filter.RULE_SCHEMA)
    got = url_filter.judge(pages, table, keep=["page_id"], **settings)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(i, *brute(u, rules)) for i, u in urls]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def urls():
    rng = random.Random(3)
    hosts = ["example.org", "A.Example.ORG", "xexample.org", "org", "com", "b.com", "", "x..com",
             "example.org:80", "É.org", "net"]
    paths = ["", "/", "/es", "/es/", "/es/x", "/en/1", "/en/12/3", "/en//1", "/fr/?a/b", "/de/#x",
             "?q=/es/", "#f", "//", "/en/1/2/3"]
    found = [f"http{rng.choice(['', 's'])}://{h}{p}" for h in hosts for p in paths]
    found += [None, "", "://", "no scheme/org/", "a://b://org/x", "x\n://org/\n", "http://" + "a." * 999
              + "org/" + "s/" * 9999]
    return list(enumerate(found)) + [(0, found[0]), (None, found[1])]


def test_given_rules(spark):
    check(spark, urls(), url_filter.RULES)
    check(spark, urls(), url_filter.RULES, max_rules=2)


def test_many_rules(spark):
    rng = random.Random(4)
    rules = {}
    for _ in range(60):
        host = rng.choice(["org", "com", "example.org", "a.example.org", "b.com", ""])
        path = "".join(rng.choice(["/", "e", "s", "/en", "/1"]) for _ in range(rng.randint(0, 5)))
        rules[host, path] = rng.choice(["allow", "block"])
    check(spark, urls(), [(h, p, v) for (h, p), v in rules.items()])
    check(spark, urls(), [(h, p, v) for (h, p), v in rules.items()], max_rules=2)


def test_blocking_wins_and_empty_tables(spark):
    assert url_filter.Trie([("a", "/", "block"), ("a", "/", "allow")]).match("a", "/") == ("a/", "block")
    check(spark, urls(), [])
    check(spark, [], url_filter.RULES)
