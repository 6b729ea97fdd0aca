"""Sitemaps as streams, selectors through the index, and the overview in one pass."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from newsflow.sources import feeds, html


def every(raw):
    return [e for some in feeds.entries(raw) for e in some]


def test_entries():
    raw = '﻿ \n<?xml version="1.0" encoding="latin-1"?><x:urlset><!-- c --><x:url><x:loc> https://a/é?x=1&amp;y=2 </x:loc><image:image><image:loc>https://img</image:loc></image:image><x:lastmod>2025</x:lastmod></x:url><url><loc><![CDATA[b]]></loc></url><URL><loc/></URL><sitemap><loc>s</loc></sitemap></x:urlset>'.encode()
    assert every(raw) == [("url", 1, "https://a/é?x=1&y=2", "2025", None), ("url", 2, "b", None, None), ("url", 3, None, None, None), ("sitemap", 4, "s", None, None)]
    for bad in (b"", b"  ", b"no xml", b"<urlset>", b"<a>&nbsp;</a>"):
        assert every(bad) == []
    broken = b"<urlset><url><loc>a</loc></url><url><loc>b</loc></url><url><loc>c</lo"
    assert [e[2] for e in every(broken)] == ["a", "b"]


@pytest.mark.parametrize("chunk", (1, 7, 1 << 16))
def test_chunks_cut_anywhere(chunk, monkeypatch):
    raw = "<urlset>".encode() + "".join(f"<url><loc>https://ü/{i}</loc><lastmod>{i}</lastmod></url>" for i in range(50)).encode() + b"</urlset>"
    monkeypatch.setattr(feeds, "CHUNK", chunk)
    monkeypatch.setattr(feeds, "BATCH", 7)
    assert [(e[1], e[2], e[3]) for e in every(raw)] == [(i + 1, f"https://ü/{i}", str(i)) for i in range(50)]


def test_a_million_links_in_bounded_memory():
    entry = b"<url><loc>https://example.org/some/page</loc></url>"
    raw = b"<urlset>" + entry * 1_000_000 + b"</urlset>"
    n = most = 0
    tracemalloc.start()
    for some in feeds.entries(raw):
        n, most = n + len(some), max(most, len(some))
        if n > 100_000:  # the rest without tracing, which is slow
            break
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * feeds.BATCH and peak < 20_000_000
    assert sum(map(len, feeds.entries(raw))) == 1_000_000


def test_read_entries_keeps_columns(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "<urlset><url><loc>https://a</loc></url><url><loc>mailto:x</loc></url></urlset>", None), (3, "<sitemapindex><sitemap><loc>https://b</loc></sitemap></sitemapindex>", "z")]
    df = spark.createDataFrame(rows, "id long, body string, more string")
    got = sorted(map(tuple, feeds.read_entries(df).select("id", "more", "kind", "place", "loc").collect()), key=str)
    assert got == [(3, "z", "sitemap", 1, "https://b"), (3, None, "url", 1, "https://a"), (3, None, "url", 2, "mailto:x")]
    assert [r.result_link for r in feeds.read_links(df).collect()] == ["https://a"] and feeds.read_entries(df.limit(0)).count() == 0


def plain_select(root, selector):
    return [n for n in root.walk() if any(html._reaches(n, steps) for steps in html.compile_selector(selector))]


def test_index_finds_what_a_walk_finds():
    rng = random.Random(2)
    tags, classes = ["div", "p", "span", "a", "li", "ul", "time"], ["a", "b", "c d", "d"]
    page = "".join(rng.choice([f"<{t} class='{rng.choice(classes)}' id='i{rng.randint(0, 5)}' data-x='{rng.choice('xyz')}{rng.choice('xyz')}'>t", f"</{t}>", f"<{t}>"]) for t in rng.choices(tags, k=400))
    root = html.parse(page)
    selectors = ["div", "*", ".a", ".c.d", "#i3", "p.a > span", "div .d, p", "a[data-x]", "[data-x=xy]", "[data-x^=x]", "[data-x$='z'] li", "[data-x*=y].a", "ul li, ul > li, *", "div p span", ".none", "x{", "p#i1.a[data-x]", "a,,b", ""]
    for s in selectors:
        assert html.select(root, s) == plain_select(root, s), s
        assert html.select(root, html.compile_selector(s)) == plain_select(root, s)
    for node in list(root.walk())[:40]:
        assert html.select(node, "p, .a") == plain_select(node, "p, .a")


def test_overview_shuffles_its_measures_once(spark):
    from newsflow.operators import reports

    key = "layer_1_url_id"
    t = spark.createDataFrame([(1, "u", "a", True), (1, "u", "b", True), (1, "w", None, True), (2, "u", "a", False)], f"{key} long, requested_url string, http_status_message string, retry_flag boolean")
    other = spark.createDataFrame([(1, "u", "a", True), (1, "w", "a", True), (2, "u", "b", True)], t.schema)
    progress = spark.createDataFrame([(1, "excluded_by_date"), (2, "response_error"), (2, None)], f"{key} long, processing_status string")
    errors = spark.createDataFrame([(1, "xml_parse_error"), (1, "input_out_of_range"), (2, "excluded_string"), (2, None)], f"{key} long, error_category string")
    sites = spark.createDataFrame([(1, "one"), (2, "two"), (3, "none")], f"{key} long, name string")
    out = reports.sitemap_overview(sites, t, t.limit(0), other, progress, errors, t, other)
    got = {r[key]: r.asDict() for r in out.collect()}
    assert got[1] | {"name": "one", "total_links_for_domain": 3, "total_links_excluded_by_date": 2, "total_errors": 1, "total_verified_errors_before_retry": 3, "total_verified_errors_after_retry": 1, "total_unsolved_errors": 1, "total_links_excluded": 2, "total_urlsets": 2} == got[1]
    assert got[2] | {"total_errors": 1, "total_links_excluded_by_string": 1, "total_progression_entries": 2, "total_unsolved_errors": 0} == got[2]
    assert all(v == 0 for k, v in got[3].items() if k.startswith("total"))
    big = spark.range(10).select(F.col("id").alias(key))
    plan = out.join(big, key)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [layer_1_url_id") == 2  # the measures, and the URLs of both logs
