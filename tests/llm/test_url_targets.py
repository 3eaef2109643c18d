"""How pages name other addresses, and decisions of aliases against a loop over random graphs."""

from __future__ import annotations

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from uttermill.llm import url_filter
from uttermill.llm.queries import RULES

PAGE = "http://h.org/a/b/c.html?x=1"
CANONICAL = [
    ('<link rel="canonical" href="?p=2">', "http://h.org/a/b/c.html?p=2"),
    ('<link rel="canonical" href="../d">', "http://h.org/a/d"),
    ('<link rel="canonical" href="./../../../../d/./e/..">', "http://h.org/d/"),
    ('<link rel="canonical" href="/q?a=1&amp;b=2&#38;c=&#x26;">', "http://h.org/q?a=1&b=2&c=&"),
    ('<link data-href="/no" rel=canonical href=/yes>', "http://h.org/yes"),
    ('<!-- <link rel="canonical" href="/no"> --><link href="/yes" rel="alternate Canonical">', "http://h.org/yes"),
    ('<script>"<link rel=canonical href=/no>"</script>', None),
    ('<link rel="canonical" href="mailto:z">', None),
    ('<link rel="canonical" href="">', None),
    ('<link rel="canonical" href="//K.Org:80">', "http://k.org/"),
    ('<link rel="canonical" href="HTTPS://u:p@K.org:443/x#y">', "https://k.org/x"),
    ('<base href="/deep/er/"><link title="a>b" rel="canonical" href="f">', "http://h.org/deep/er/f"),
    ('<link rel="stylesheet" href="/no"><link rel="canonical" href="/one"><link rel="canonical" href="/two">', "http://h.org/one"),
    ("<meta http-equiv=Refresh content='0; URL=\"n.html\"'>", "http://h.org/a/b/n.html"),
    ('<meta content="3;&#110;" http-equiv="refresh">', "http://h.org/a/b/n"),
    ('<meta http-equiv="refresh" content="5">', None),
    ('<meta name="refresh" content="0; url=/no">', None),
    ('<linkage rel="canonical" href="/no">', None),
    ('<link rel="canonical" href="/&#x1F600;&nope;&#xD800;">', "http://h.org/\U0001f600&nope;&"),
    ('<link rel="canonical" href="/a&#0;">', "http://h.org/a&"),
    ("<link " + "x='>' " * 20_000 + 'rel="canonical" href="/far">', "http://h.org/far"),
    ("", None), (None, None), ("<link", None),
]


def test_targets(spark):
    pages = spark.createDataFrame([(i, PAGE, html) for i, (html, _) in enumerate(CANONICAL)], "page_id long, url string, html string")
    named = pages.select("page_id", F.explode(url_filter.page_targets(F.col("url"), F.col("html"))).alias("to"))
    got = {r.page_id: r.node for r in named.select("page_id", url_filter._node(F.col("to")).alias("node")).where("node is not null").collect()}
    assert {i: got.get(i) for i in range(len(CANONICAL))} == {i: want for i, (_, want) in enumerate(CANONICAL)}
    assert url_filter.page_edges(pages).count() == sum(want is not None for _, want in CANONICAL)


def test_relative_addresses_equal_the_standard_library(spark):
    rnd = random.Random(2)
    rows = []
    for _ in range(300):
        base = "http://h.org/" + "/".join(rnd.choices("ab", k=rnd.randint(1, 3))) + rnd.choice(["", "/", "?q"])
        rows.append((base, rnd.choice(["", "/", "//k.net/"]) + "/".join(rnd.choices(["..", ".", "c", "d"], k=rnd.randint(1, 6))) + rnd.choice(["", "/", "?r"])))
    frame = spark.createDataFrame(rows, "base string, to string")
    nodes = frame.select(url_filter._node(url_filter._absolute(F.col("base"), F.col("to"))).alias("n")).collect()
    assert [r.n for r in nodes] == [urljoin("http://k.net/", b[7:]) if b.startswith("//") else urljoin(a, b) for a, b in rows]


def _decide(url):
    host, _, path = url.split("://", 1)[1].partition("/")
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and ("/" + path).startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]))[2] if fits else None


@pytest.mark.parametrize("seed", [1, 2])
def test_aliases_against_a_loop(spark, seed):
    rnd = random.Random(seed)
    hosts = ["www.example.com/en", "example.com/en", "free.org", "n.net/es", "n.net/fr", "n.net", "own.org"]
    urls = [f"http://{rnd.choice(hosts)}/{i}" for i in range(150)]
    pages, edges = [], []
    for i, url in enumerate(urls):
        html = "<p>"
        if rnd.random() < 0.3:
            to = rnd.choice(urls)
            html = rnd.choice(['<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0;url={}">']).format(to)
            edges.append((url, to))
        pages += [(i, url, html)] * (1 + (i % 40 == 0))
    log = [(rnd.choice(urls), rnd.choice([*urls, "http://far.net/es/1", "http://far.org/"])) for _ in range(25)] + [(None, urls[0]), ("x", urls[1])]
    reach = {u: {u} for u in [*urls, "http://far.net/es/1", "http://far.org/"]}
    for a, b in edges + log[:25]:
        both = reach[a] | reach[b]
        for u in both:
            reach[u] = both
    want = {}
    for i, url in enumerate(urls):
        fates = {_decide(u) for u in reach[url]}
        want[i] = (_decide(url) or ("allow" if "allow" in fates else "block" if "block" in fates else "allow"), min(reach[url]) if len(reach[url]) > 1 else None)
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "rule": F.lit(2), "node": F.lit(3)})
    out = url_filter.judge_urls(frame, RULES, redirects=spark.createDataFrame(log, "a string, b string")).collect()
    assert len(out) == len(pages)
    assert {r.page_id: (r.verdict, r.alias_of) for r in out} == want
    assert len({v for v, a in want.values() if a}) == 2


def test_empty_pages(spark):
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.judge_urls(nothing, RULES).count() == 0
    rows = [(None, None, None), (1, "", "<link rel=canonical href=/x>"), (2, "http://", "<link rel=canonical href=http:///x>"), (2, "http://", None)]
    out = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES).collect()
    assert [(r.host, r.path, r.rule, r.verdict, r.alias_of) for r in out] == [("", "", None, "allow", None)] * 4
