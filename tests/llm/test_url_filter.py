"""URL rules against brute force, by the trie and by the join; clashing names and repeated rows."""

from __future__ import annotations

import random
from collections import Counter

from strandline.llm import url_filter


def brute(host, path, rules, default):
    fits = [(len(h), len(p), h + p, v) for h, p, v in rules if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, default)


def cases(seed=1, n=400):
    rng = random.Random(seed)
    names, parts = ["a", "b", "example", "net", "org", ""], ["", "x", "xy", "x/y", "/", "/x", "/x/", "/x/y", "/x/yz/", "//", "/x//y"]
    host = lambda: ".".join(rng.choice(names) for _ in range(rng.randrange(1, 5)))
    rules = [(host(), rng.choice(parts), rng.choice(["allow", "block"])) for _ in range(60)] + [("", "/x/y", "block"), ("net", "/x", "allow"), ("net", "/x", "block")]
    urls = [f"http://{host()}{rng.choice(parts[4:])}{rng.choice(['', 'z', '?q=/x', '#/x/y', '/x/y/z'])}" for _ in range(n)]
    return rules, [*urls, None, "", "no scheme", "x://", "http://NET/x", "a://net/" + "x/" * 4000, *urls[:20]]


def check(spark, monkeypatch, as_table):
    rules, urls = cases()
    names = "page_id long, url string, _m string, m string, M_ string, _id long, _h string, key string, `a.b` string, host string, verdict int"
    if spark.conf.get("spark.sql.caseSensitive") == "false":
        assert len({x.split()[0].lower() for x in names.split(", ")}) == 11
    pages = spark.createDataFrame([(k, u, "m", "n", "o", 77, "h", "k", "dot", "old", 5) for k, u in enumerate(urls)], names)
    given = spark.createDataFrame(rules, "host string, path string, verdict string") if as_table else rules
    out = url_filter.judge(pages, given, default="review")
    assert out.columns == ["page_id", "url", "_m", "m", "M_", "_id", "_h", "key", "a.b", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert Counter(r.page_id for r in rows) == Counter(range(len(urls)))
    for r in rows:
        assert (r._m, r.m, r["M_"], r._id, r._h, r.key, r["a.b"]) == ("m", "n", "o", 77, "h", "k", "dot")
        assert (r.rule, r.verdict) == brute(r.host, r.path, rules, "review")


def test_trie_is_brute_force(spark, monkeypatch):
    check(spark, monkeypatch, as_table=False)


def test_trie_from_a_table(spark, monkeypatch):
    check(spark, monkeypatch, as_table=True)


def test_join_is_brute_force(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "TRIE_RULES", 5)
    check(spark, monkeypatch, as_table=False)
    check(spark, monkeypatch, as_table=True)


def test_no_rules_and_no_pages(spark):
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, empty).collect()] == [(1, "http://a.net/", "a.net", "/", None, "allow")]
    assert url_filter.judge(pages.where("page_id > 1"), url_filter.RULES).count() == 0
