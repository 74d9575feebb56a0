"""Rules on addresses: longest match, edges, and the same by brute force."""

import itertools

from pyspark.sql import functions as F

from shelfmark.llm.urls import Trie, judge_urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "a.org", "/fr/x"), ("block", "", "/bad/")]


def brute(host, path):
    fits = [(len(h.split(".")) if h else 0, len(p), h + p, v) for v, h, p in RULES if (not h or host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return (best[3], best[2]) if best else None


def test_the_trie_equals_brute_force():
    trie = Trie(RULES)
    hosts = ["", "net", "x.net", "example.net", "w.example.net", "badexample.net", "example.com", "org", "a.org", "b.a.org", "a..net", ".net", "x.net:80"]
    paths = ["", "/", "/en", "/en/", "/en/1", "/de/", "/de/x/y", "/fr/", "/fr/x", "/fr/xy/z", "/fr/y", "/bad/", "/bad/x", "//en/"]
    for host, path in itertools.product(hosts, paths):
        assert trie.longest(host, path) == brute(host, path), (host, path)


def test_addresses_of_a_table(spark):
    urls = ["https://WWW.Example.NET/en/1?x=/de/", "no scheme", None, "", "http://x.net", "http://x.net?q", "ftp://e.example.com/de/\nx", "a://b://c/d", "http://x.net/"]
    rows = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls + urls[:1])], "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(rows, RULES[:4]).collect()}
    assert found[0] == ("www.example.net", "/en/1", "example.net/en/", "allow") == found[9]
    assert found[1] == found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == ("x.net", "", None, "allow") and found[5] == ("x.net", "", None, "allow")
    assert found[6][1] == "/de/\nx" and found[6][3] == "block" and found[7][0] == "b:" and found[8] == ("x.net", "/", "net/", "block")
    kept = judge_urls(rows.withColumn("_found", F.lit(7)), RULES[:4])
    assert {r["_found"] for r in kept.collect()} == {7} and {r.page_id: r.verdict for r in kept.collect()} == {k: x[3] for k, x in found.items()}
    assert judge_urls(rows.limit(0), RULES).count() == 0 and judge_urls(rows, []).filter("verdict = 'allow'").count() == 10
