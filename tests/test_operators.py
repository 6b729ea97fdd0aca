"""State folds, routing, sitemaps, HTML, cleaning and the workbench on hand-made cases."""

import gc
import gzip
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.operators import extract, lifecycle, relational, reports, responses, runlog, sitemaps, workbench
from newsflow.plans import run_queries
from newsflow.sources import html, tables


def test_streaks(spark):
    codes = [500, 500, 403, 200, 403, 404, 403]
    log = spark.createDataFrame([("d", i, c) for i, c in enumerate(codes)], "domain string, i int, status int")
    marked = log.withColumn("a", responses.analyze(F.lit(False), F.col("status"), F.lit("valid"))).select("*", "a.action", "a.analysis")
    got = responses.health_streaks(marked, "domain", ["i"], "action", "analysis").orderBy("i").collect()
    assert [r.streak for r in got] == [1, 2, 1, 0, 1, 0, 1]


def test_health_fold(spark):
    for n, want in ((9, (3, 2, 0, "rotate")), (10, (1, 3, 0, "block")), (11, (1, 3, 1, "block"))):
        log = spark.createDataFrame([("d", i, "retry", "http_error_500") for i in range(n)], "domain string, i int, action string, reason string")
        r = responses.domain_health(log, "domain", ["i"], "action", "reason", level=1).first()
        assert (r.streak, r.kills, r.blocked, r.decision) == want
        state = (0, None, 0, 0)
        for _ in range(n):
            state = responses.transition(state, "retry", "http_error_500", 1)
        assert (r.streak, r.last_reason, r.kills, r.blocked) == state


def test_route(spark):
    rows = [("d", "t", None, "output"), (None, "t", None, "error"), (None, "t", False, "parse_error"), ("d", None, True, "error"), ("d", " ", False, "parse_error")]
    df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, d string, t string, p boolean")
    got = df.select("i", responses.route(F.lit("<p>"), F.lit(True), F.lit(False), F.col("d"), F.col("t"), F.col("p")).alias("r")).orderBy("i").collect()
    assert [r.r.route for r in got] == [r[3] for r in rows]


def test_priority(spark):
    one = spark.createDataFrame([(1, "u/1")], "id int, url string")
    got = lifecycle.priority_dedup({n: one.withColumn("url", F.concat("url", F.lit("/" * (i % 2)))) for i, n in enumerate(lifecycle.PRIORITY)}).collect()
    assert [(r.url, r.status) for r in got] == [("u/1", "final_data")]


def test_null_safe(spark):
    df = spark.createDataFrame([(None, None), ("a", None), ("a", "a")], "x string, y string")
    assert reports.agreement(df, {"f": ("x", "y")}).where("field = 'f'").first().pct == 66.67


def test_paywall_length(spark):
    df = spark.createDataFrame([("x" * n,) for n in (299, 300, 500, 501)] + [(None,)], "t string")
    assert [r[0] for r in df.select(extract.paywall_by_length(F.col("t"))).collect()] == [False, True, True, False, False]


def test_paywall_markers_of_a_domain(spark):
    pages = spark.createDataFrame([(1, "https://www.a.de/x", "<div class='wall'>"), (2, "https://b.de/x", "<div class='wall'>"), (3, "https://b.de/y", "<meta content='locked'>"), (4, "https://c.de/", "<p class='paywall'>"), (5, "https://a.de/", "<p class='paywall'>"), (6, None, "<p data-paywall>")], "id int, url string, html string")
    markers = spark.createDataFrame([("a.de", "css", ".wall"), ("a.de", "css", ".other"), ("b.de", "meta", "locked")], "domain string, type string, marker string")
    got = {r.id: r.x.paywall_marker for r in extract.extract(pages, paywall=markers).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False, 6: True}
    assert {r.id: r.x.paywall_marker for r in extract.extract(pages).collect()} == {1: False, 2: False, 3: False, 4: True, 5: True, 6: True}


def test_run_abort(spark):
    b, x = "date_before_range", "scraped"
    rows = [("g", i, s, False, None) for i, s in enumerate([b, b, x, b, b, b])] + [("g", 6, None, False, None), ("g", 7, None, True, "scraped"), ("g", 8, None, False, "xml_error"), ("h", 0, None, False, None), (None, 0, b, False, None), (None, 1, b, False, None), (None, 2, b, None, None)]
    df = spark.createDataFrame(rows, "g string, i int, pagination_group_status string, processed boolean, processing_status string")
    got = {(r.g, r.i): (r.processed, r.processing_status, r.pagination_group_status) for r in sitemaps.run_abort(df, "g", "i").collect()}
    assert all(got["g", i] == (True, "excluded_by_date", "aborted") for i in range(7))
    assert got["g", 7] == (True, "scraped", None) and got["g", 8] == (False, "xml_error", None) and got["h", 0] == (False, None, None) and got[None, 0] == (False, None, b)


def test_run_abort_by_plain_runs(spark, monkeypatch):
    """Random groups with rows of one place and rows without a group against plain runs; one task a few rows."""
    dice = random.Random(5)
    rows = [(s, g, dice.choice([*range(12), None]), dice.choice(["date_before_range"] * 3 + ["scraped", None]), dice.choice([True, False, None]), dice.choice(["xml_error", "scraped", None])) for s in range(3) for g in (*range(8), None) for _ in range(9)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, s int, g int, i int, pagination_group_status string, processed boolean, processing_status string")
    want = {}
    for key in {r[:2] for r in rows}:
        run, longest, of = 0, 0, [(k, r) for k, r in enumerate(rows) if r[:2] == key]
        for at in sorted({r[2] for _, r in of}, key=lambda x: -1 if x is None else x):
            here = [r[3] == "date_before_range" for _, r in of if r[2] == at]
            run = (run if all(here) else 0) + sum(here)
            longest = max(longest, run)
        for k, r in of:
            gone = key[1] is not None and longest >= 3 and not r[4] and r[5] != "xml_error"
            want[k] = (True, "excluded_by_date", "aborted") if gone else (r[4], r[5], r[3])
    monkeypatch.setattr(relational, "TASK_BYTES", 1024, raising=False)
    found = sitemaps.run_abort(df, ["s", "g"], "i")
    assert {r.id: (r.processed, r.processing_status, r.pagination_group_status) for r in found.collect()} == want
    assert found.rdd.getNumPartitions() >= 10


def test_groups_are_one_parents(spark):
    rows = [(f"https://{s}.de/sitemap-{i}.xml", s, s) for s in "abcdef" for i in (1,)] + [(f"https://g.de/sitemap-{i}.xml", "g", "p") for i in range(9, 3, -1)] + [("https://g.de/sitemap.xml", "g", "p"), ("https://g.de/sitemap-1.xml", "g", "q")]
    df = spark.createDataFrame(rows, "url string, root string, parent string")
    got = {(r.url, r.parent): (r.pagination_group, r.pagination_index) for r in sitemaps.pagination_groups(df, "url", ["root", "parent"]).collect()}
    assert {k for k, v in got.items() if v[0]} == {(f"https://g.de/sitemap-{i}.xml", "p") for i in range(4, 10)}
    assert [got[f"https://g.de/sitemap-{i}.xml", "p"][1] for i in range(4, 10)] == [1, 2, 3, 4, 5, 6]
    tree = spark.createDataFrame([("a", "p", "g", 1, "sitemapindex", "valid_up"), ("b", "p", "g", 2, "urlset", "valid_up"), ("c", "q", "g", 1, "urlset", "valid_up"), ("d", "q", None, None, "sitemapindex", None)], "url string, parent string, pagination_group string, pagination_index int, root_tag string, pagination_group_status string")
    got = {r.url: (r.pagination_group, r.pagination_group_status) for r in sitemaps.dissolve_groups(tree, parent=["parent"]).collect()}
    assert got == {"a": (None, "dissolved"), "b": (None, "dissolved"), "c": ("g", "valid_up"), "d": (None, None)}


def test_log_rows_of_wide_texts(spark, monkeypatch):
    """Texts that are small when compressed are ranged by their bytes, and numbered on without a gap."""
    monkeypatch.setattr(relational, "TASK_BYTES", 40_000, raising=False)
    log = spark.createDataFrame([(7, "x")], "id long, body string")
    new = spark.range(200).select((199 - F.col("id")).alias("ts"), F.repeat(F.lit("a "), 1000).alias("body"))
    assert [r.id for r in runlog.log_rows(log, new, ["ts"], "id").orderBy("id").collect()] == list(range(8, 208))
    found = relational.numbered(new, ["ts"], "n").withColumn("file", F.input_file_name())
    assert all(r.n == r.ts + 1 for r in found.select("n", "ts").collect())
    assert found.groupBy("file").count().agg(F.max("count")).first()[0] <= 60


def test_pages_leave_nothing_behind():
    """A batch's pages go one by one: without the collector no tree stays, and every slice's values come back in order."""
    nodes = lambda: sum(isinstance(o, html.Node) for o in gc.get_objects())
    pages = [f"<div id=a><p class=b>{i}<p>x</div>" if i % 9 else None for i in range(3 * extract.SLICE + 7)]
    gc.collect()
    gc.disable()
    try:
        had = nodes()

        def one(page):
            if (root := html.parse(page)) is None:
                return []
            out = html.search(root, ["#a > .b"])
            root.free()
            return out

        got = extract._in_slices(one, pa.list_(pa.string()), pa.array(pages))
        assert nodes() <= had + 2
    finally:
        gc.enable()
    assert got.to_pylist() == [[str(i)] if i % 9 else [] for i in range(len(pages))]
    assert extract._in_slices(one, pa.list_(pa.string()), pa.array([], pa.string())).to_pylist() == []


def test_tables_row_by_row():
    """Random broken markup: rows taken while reading are those of the tree, nested tables too; the tree of a long page is never there."""
    dice = random.Random(3)
    parts = [f"<{s}{t}>" for t in ("table", "tr", "td", "th", "ul", "li", "p", "div", "b", "tbody") for s in ("", "", "/")] + ["<br>", "<img>", "<table/>", "<tr/>", "x ", "&amp;", "\n", "<!-- c -->", "<script>a<td></script>", "<![x"]
    for n in range(3000):
        page = "".join(dice.choices(parts, k=dice.randrange(1, 60)))
        assert html.page_tables(page) == html.tables(html.parse(page) or html.Node("#root", {}, None)), (n, page)
    page = "<p>a<table>" + "".join(f"<tr><td> {i} <td><b>name {i}</b>\n" for i in range(20_000)) + "</table>"
    tracemalloc.start()
    assert len(html.page_tables(page)[0]) == 20_000
    assert tracemalloc.get_traced_memory()[1] < 12 * len(page)
    tracemalloc.stop()


def test_log_rows_move_no_long_texts(spark, monkeypatch):
    """The bodies of the response log are made after the sort: what is numbered holds none. Blank ones are null."""
    moved, tasks_for = [], relational.tasks_for
    monkeypatch.setattr(relational, "tasks_for", lambda df: moved.append(df) or tasks_for(df))
    found = run_queries.q_response_log(spark, "/root/testdata/sf0.001")
    assert len(moved) == 1 and "body_snippet" not in moved[0].columns
    assert found.agg(F.min(F.length("body_snippet"))).first()[0] == 2000
    log, new = spark.createDataFrame([(7, "x")], "id long, body string"), spark.createDataFrame([(2, "b"), (1, " "), (3, None)], "ts long, word string")
    assert sorted(map(tuple, runlog.log_rows(log, new, ["ts"], "id", {"body": F.repeat("word", 3)}).collect())) == [(8, None), (9, "bbb"), (10, None)]


def test_large_groups_by_ranges(spark, monkeypatch):
    """Groups beyond the limit, of null parents too, with repeated files and files without a number; more rows go to more tasks."""
    rows = [(f"https://a.de/{name}-{i * 7 % 40}.xml", parent) for name in ("x", "y") for parent in ("p", "q", None) for i in range(60)]
    rows += [(f"https://a.de/{name}.xml", parent) for name in ("x", "y") for parent in ("p", None)] + [(f"https://a.de/z-{i}.xml", "p") for i in range(6)] + [("https://a.de/only-1.xml", "p")]
    df = spark.createDataFrame(rows, "url string, parent string")
    want, members = {}, {}
    for url, parent in rows:
        name, _, number = url.removeprefix("https://a.de/").removesuffix(".xml").partition("-")
        members.setdefault((parent, name), []).append((int(number) if number else 99, url))
    for (parent, name), of in members.items():
        numbers = [n for n, _ in of if n != 99]
        for i, (n, url) in enumerate(sorted(of), 1):
            want.setdefault((url, parent), []).append((f"{name}.xml", i) if len(numbers) >= 5 and n != 99 else (None, None))
    for large in (10, 61, 1000):
        monkeypatch.setattr(sitemaps, "LARGE_GROUP", large, raising=False)
        found = sitemaps.pagination_groups(df, "url", "parent")
        got: dict = {}
        for r in found.collect():
            got.setdefault((r.url, r.parent), []).append((r.pagination_group, r.pagination_index))
        assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    monkeypatch.setattr(relational, "TASK_BYTES", 4096)
    assert sitemaps.pagination_groups(df, "url", "parent").rdd.getNumPartitions() >= 10


def plain_roll_up(rows):
    """url, parent, status, tag -> status, progress of each, from the leaves up."""
    kids = {}
    for u, p, *_ in rows:
        kids.setdefault(p, []).append(u)
    of, found = {r[0]: r for r in rows}, {}

    def over(s):
        return 2 if s in sitemaps.DONE else 1 if s in sitemaps.FAILED else 0

    for u in reversed(sorted(of, key=lambda u: depth(of, u))):
        below = [over(found[k][0]) for k in kids.get(u, ())]
        if below or of[u][3] == "sitemapindex":
            s = "in_progress" if not below or min(below) == 0 else "all_child_links_processed" if min(below) == 2 else "all_processed_some_errors"
            found[u] = (s, f"{sum(b > 0 for b in below)} of {len(below)}")
        else:
            found[u] = (of[u][2], None)
    return found


def depth(of, u):
    return 0 if of[u][1] not in of else 1 + depth(of, of[u][1])


def test_roll_up_at_any_depth(spark):
    import random

    rng = random.Random(5)
    chain = [(f"c{i}", f"c{i - 1}" if i else None, "subsitemap_sorted", "sitemapindex") for i in range(60)] + [("leaf", "c59", "scraped", "urlset"), ("bad", "c30", "xml_error", None)]
    bush = [("b0", None, "subsitemap_sorted", "sitemapindex")] + [(f"b{i}", f"b{rng.randint(max(0, i - 9), i - 1)}", rng.choice(["scraped", "scraped", "excluded_by_date", "response_error", "in_progress"]), rng.choice(["urlset", "urlset", None, "sitemapindex"])) for i in range(1, 150)]
    rows = chain + bush
    df = spark.createDataFrame([(*r, "one") for r in rows] + [(u, p, "scraped", None, "two") for u, p, _, _ in chain], "url string, parent_url string, processing_status string, root_tag string, root_url string")
    got = {(r.root_url, r.url): (r.processing_status, r.subsitemap_progress) for r in sitemaps.roll_up(df).collect()}
    assert {u: v for (root, u), v in got.items() if root == "one"} == plain_roll_up(rows)
    assert got["two", "c0"] == ("all_child_links_processed", "1 of 1") and len(got) == len(rows) + len(chain)
    for bad in ([("a", "b"), ("b", "a")], [("a", "a")]):
        with pytest.raises(ValueError):
            sitemaps.roll_up(spark.createDataFrame([(*r, "scraped") for r in bad], "url string, parent_url string, processing_status string"))
    orphan = sitemaps.roll_up(spark.createDataFrame([("a", "gone", "scraped")], "url string, parent_url string, processing_status string")).first()
    assert orphan.processing_status == "scraped" and orphan.subsitemap_progress is None
    assert sitemaps.roll_up(df.limit(0)).count() == 0


def test_walk_goes_on_where_it_stopped(spark, tmp_path):
    index = lambda *c: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in c) + "</sitemapindex>"
    rows = [("r", 200, index("a", "b")), ("q", 200, index("b", "r")), ("a", 200, index("c", "r")), ("b", 404, None), ("c", 200, "<urlset/>")]
    responses = spark.createDataFrame(rows, "url string, status int, body string")
    roots = spark.createDataFrame([("r",), ("q",)], "url string")
    want = sorted(map(tuple, sitemaps.walk(roots, responses).collect()), key=str)
    path = str(tmp_path / "walk")
    assert sitemaps.walk(roots, responses, path, most_levels=1).count() == 2
    (tmp_path / "walk" / "level-1").mkdir()  # an attempt that was not committed
    (tmp_path / "walk" / "level-1" / "part-0.parquet").write_bytes(b"broken")
    assert sitemaps.walk(roots, responses, path, most_levels=1).count() == 6
    assert sorted(map(tuple, sitemaps.walk(roots, responses, path).collect()), key=str) == want
    assert sorted(map(tuple, sitemaps.walk(roots, responses.limit(0), path).collect()), key=str) == want  # nothing is fetched again


def test_xml(spark):
    xml = '<?xml version="1.0"?><!-- c --><sm:urlset xmlns:sm="x"><url><loc>https://a/1?x=1&amp;y=2</loc></url><url><loc><![CDATA[https://a/2]]></loc><lastmod>2025-01-02</lastmod></url><url><loc>mailto:x</loc></url></sm:urlset>'
    r = spark.createDataFrame([(xml,)], "x string").select(sitemaps.root_tag(F.col("x")).alias("tag"), sitemaps.links(F.col("x")).alias("l"), sitemaps.locations(F.col("x")).alias("all")).first()
    assert r.tag == "urlset" and [x.result_link for x in r.l] == ["https://a/1?x=1&y=2", "https://a/2"] and r.l[0].date is None and str(r.l[1].date) == "2025-01-02" and len(r.all) == 3
    for bad in ("", "no xml", None):
        assert spark.createDataFrame([(bad,)], "x string").select(sitemaps.root_tag(F.col("x"))).first()[0] is None


def test_walk_goes_to_the_end(spark):
    index = lambda *c: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in c) + "</sitemapindex>"
    rows = [(f"s{i}", 200, index(f"s{i + 1}", "s0")) for i in range(23)] + [("s23", 200, "<urlset></urlset>")]
    got = sitemaps.walk(spark.createDataFrame([("s0",)], "url string"), spark.createDataFrame(rows, "url string, status int, body string")).collect()
    assert {(r.url, r.parent_url, r.depth) for r in got} == {("s0", None, 0)} | {(f"s{i}", f"s{i - 1}", i) for i in range(1, 24)} and len(got) == 24


def test_master_status(spark):
    tree = spark.createDataFrame([("a", "scraped"), ("a", "excluded_by_date"), ("b", "response_error"), ("c", "in_progress"), ("c", "scraped"), ("d", "scraped"), ("e", "scraped"), ("e", "xml_error")], "root_url string, processing_status string")
    log = spark.createDataFrame([("d", True), ("a", False)], "root_url string, retry_flag boolean")
    got = {r.root_url: r.input_processing_status for r in sitemaps.master_status(tree, log).collect()}
    assert got == {"a": "fully_processed", "b": "total_error", "c": "in_progress", "d": "partially_processed_and_moved_to_retry", "e": "fully_processed"}


PAGE = """<html><head><title>T &amp; x</title><meta name=author content="A"><script type="application/ld+json">{bad</script>
<script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","datePublished":"2025-01-02","headline":"H","author":[{"name":"X"},"Y"]}]}</script></head>
<body><nav><a href=#>n</a></nav><article class="main art:icle"><p>One<br>two <b>three<p>Anzeige<p class="x y">A longer paragraph of text.</article>
<div id=c data-k="v1 v2"><ul><li>1<li>2</ul></div><table><tr><td>a<td>b<tr><td>c</table></body>"""


def test_selectors():
    root = html.parse(PAGE)
    texts = lambda s: [n.text() for n in html.select(root, s)]
    assert texts("title") == ["T & x"] and texts("article > p.x") == ["A longer paragraph of text."] and texts("body li") == ["1", "2"] and texts("ul > li") == ["1", "2"]
    assert texts("article p")[0] == "One\ntwo three" and texts("#c li, title") == ["T & x", "1", "2"]
    assert len(html.select(root, ".art\\:icle")) == 1 and len(html.select(root, "[data-k~=v2]")) == 1 and len(html.select(root, "div[data-k*='1 v']")) == 1 and not html.select(root, "body > p")
    assert html.search(root, ["meta[name=author]"], ["content"]) == ["A"] and html.search(root, ["h1", "li"], every=False, most=1) == ["1"]
    assert html.search(root, ["article p"], exclude=["b"]) and html.tables(root) == [[["a", "b"], ["c"]]]
    assert html.parse(" ") is None and html.parse("<![x") is not None and html.select(html.parse("<p>"), "???") == []


def test_fields():
    root = html.parse(PAGE)
    got = extract.fields(root, extract.DEFAULT_RULES)
    assert got == {"date_time": "2025-01-02", "author": "X, Y", "headline": "H", "text": "One\ntwo three\nAnzeige\nA longer paragraph of text."}
    assert extract.paragraphs(root) == ["A longer paragraph of text."]
    assert not extract.is_bot_page(root, extract.DEFAULT_BOT) and extract.is_bot_page(html.parse("<title>Access Denied</title>"), extract.DEFAULT_BOT)


def test_extract_edges(spark):
    pages = spark.createDataFrame([(1, PAGE, "https://a.de/x"), (2, None, None), (3, "", "u"), (4, "<" * 5000, "u")], "id int, html string, url string")
    got = {r.id: r.x for r in extract.extract(pages).collect()}
    assert got[1].parsed and not got[2].parsed and not got[3].parsed and got[1].title == "T & x"
    assert extract.extract(pages.limit(0)).count() == 0


def test_markers(spark):
    rows = [("a", "paywalled", '<div class="paywall-x"><p id="premium1">'), ("a", "free", '<div class="paywall-x">'), ("a", "paywalled", '<meta content="Plus only"><i data-abo=1>')]
    got = {(r.type, r.marker) for r in extract.exclusive_markers(spark.createDataFrame(rows, "domain string, label string, html string")).collect()}
    assert got == {("css", "p#premium1"), ("css", "i[data-abo]"), ("meta", "Plus only")}
    domains = spark.createDataFrame([("a", None), ("b", "no_paywall"), ("c", "all_paywall"), ("d", None), ("e", None)], "domain string, paywall_url string")
    mined, fixed = (spark.createDataFrame(x, "domain string, marker string") for x in ([("a", "m"), ("d", "m")], [("d", "f")]))
    assert {r.domain: r.rule for r in extract.resolve_paywall_rules(domains, mined, fixed).collect()} == {"a": "mined", "b": "no_paywall", "c": "all_paywall", "d": "hardcoded", "e": "no_samples"}


def test_agency_text(spark):
    df = spark.createDataFrame([("h", "d", None, None), ("h", None, None, None)], "h string, d string, t string, a string")
    got = [tuple(r[0]) for r in df.select(extract.agency_text(F.col("h"), F.col("d"), F.col("t"), F.col("a"))).collect()]
    assert got == [("h", "dpa"), (None, None)]


def test_workbench(spark):
    rules = spark.createDataFrame([("prod", "a", "headline", 1, "css", ["h1"], []), ("prod", "b", "headline", 1, "css", ["h2"], [])], workbench.RULE_TABLE)
    box = workbench.sandbox(rules)
    change = spark.createDataFrame([("x", "a", "headline", 1, "css", ["h3"], [])], workbench.RULE_TABLE)
    edited = workbench.edit(box, change)
    of = lambda t, v, d: [r.selectors for r in t.where((F.col("version") == v) & (F.col("domain") == d)).collect()]
    assert of(edited, "local", "a") == [["h3"]] and of(edited, "prod", "a") == [["h1"]]
    assert of(workbench.apply(edited, "a"), "prod", "a") == [["h3"]] and of(workbench.reset(edited, "a"), "local", "a") == [["h1"]]
    pages = spark.createDataFrame([(1, "https://a/x", "<h3>Good</h3><time datetime='2025'></time><p>t</p>")], "id int, url string, html string")
    parsed = workbench.reparse(pages, edited)
    assert parsed.first().x.headline == "Good" and parsed.first().paywall is False


def test_sources(spark, tmp_path):
    raw = spark.createDataFrame([(bytearray(gzip.compress(b"<urlset/>")),), (bytearray(b"plain"),), (None,)], "b binary")
    assert [r[0] for r in raw.select(tables.gunzip(F.col("b"))).collect()] == ["<urlset/>", "plain", None]
    path = str(tmp_path / "t")
    assert tables.ensure_table(spark, path, "id long, name string").count() == 0
    tables.append_aligned(spark.createDataFrame([("7", "n", 1), ("x", "m", 2)], "id string, name string, more int"), path)
    assert sorted(map(tuple, tables.ensure_table(spark, path, "id long").collect()), key=str) == [(7, "n"), (None, "m")]
    (tmp_path / "c.csv").write_text("domain;url\na;b\n")
    assert tables.read_csv(spark, str(tmp_path / "c.csv"), "domain string, url string", ";").first().url == "b"
    tables.write_by_domain(spark.createDataFrame([("a", 1), ("b", 2)], "domain string, v int"), str(tmp_path / "d"))
    tables.write_by_domain(spark.createDataFrame([("a", 3)], "domain string, v int"), str(tmp_path / "d"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "d")).select("domain", "v").collect())) == [("a", 3), ("b", 2)]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
