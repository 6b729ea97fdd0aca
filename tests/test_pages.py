"""The queries over pages against a plain reading of the pages by patterns, row for row."""

import html as entities
import re
from collections import Counter

import duckdb
import pytest

from newsflow.functions import urls
from newsflow.operators import extract
from newsflow.plans import catalog
from newsflow.sources.html import parse
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.01"


def bare(page):
    """The page without comments, scripts and styles."""
    return re.sub(r"(?is)<!--.*?-->|<(script|style|noscript|template)\b.*?</\1\s*>", "", page)


def text(part):
    return re.sub(r"\s+", " ", entities.unescape(re.sub(r"(?s)<[^>]+>", " ", part))).strip()


def paragraphs(page, inside=None):
    page = bare(page)
    parts = re.findall(rf"(?is)<{inside}\b[^>]*>(.*?)</{inside}\s*>", page) if inside else [page]
    return [text(p) for part in parts for p in re.findall(r"(?is)<p\b[^>]*>(.*?)(?=</p\s*>|<p\b|</?(?:div|article|section|ul|body|main|nav|footer|h[1-6])\b|$)", part)]


def plain(t):
    """Letters only: how blanks fall between inline elements is not compared."""
    return re.sub(r"\s", "", t or "")


@pytest.fixture(scope="module")
def pages(spark):
    return {r.page_id: r for r in spark.read.parquet(f"{DIR}/pages.parquet").withColumn("domain", urls.domain_key(urls.extract_domain(F.col("url")))).collect()}


def test_paragraphs(spark, pages):
    got: dict = {}
    for r in catalog.queries()["q_paragraphs"](spark, DIR).orderBy("page_id", "n").collect():
        got.setdefault(r.page_id, []).extend([r.paragraph] if r.paragraph else [])
    for i, r in pages.items():
        want = [p for p in paragraphs(r.html) if len(p) > 20 and p != "Anzeige"]
        assert [plain(p) for p in got[i]] == [plain(p) for p in want], i


def test_fields(spark, pages):
    for r in catalog.queries()["q_html_fields"](spark, DIR).collect():
        page = pages[r.page_id].html
        h1, title = (re.search(rf"(?is)<{t}\b[^>]*>(.*?)</{t}\s*>", bare(page)) for t in ("h1", "title"))
        want = next((text(m[1]) for m in (h1, title) if m and text(m[1])), None)
        assert plain(r.headline) == plain(want), r.page_id
        body = [p for p in paragraphs(page, "article") if p] or [p for p in paragraphs(page) if p]
        assert abs((r.text_length or 0) - len("\n".join(body))) <= len(body) + 2, r.page_id


def test_title_as_its_sql(spark, tmp_path):
    """Entities that the SQL leaves, cut ones, blanks of several kinds, case, several titles and none."""
    titles = ["a &quot;b&quot;", "cut &amp", "&amp;lt; &lt;b&gt;", " a\t\n b ", "\u00a0a\u00a0b\u3000", "\x0ba\x0b", "", "   ", "<b>x</b>", "$1 \\\\", "&#228;"]
    rows = [(i, f"<html><title lang='de'>{t}</title><p>x</p><title>second</title>") for i, t in enumerate(titles)]
    rows += [(90, None), (91, ""), (92, "<p>none"), (93, "<title>open"), (94, "<TITLE>A</TITLE>"), (95, "<!-- <title>c</title> --><title>d</title>"), (96, "<titles>e</title>")]
    spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("https://a.de/")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    for path, d in ((f"{tmp_path}/pages.parquet/*.parquet", tmp_path), ("/root/testdata/sf0.1/pages.parquet", "/root/testdata/sf0.1")):
        con.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{path}'")
        want = dict(con.sql(catalog.oracle_sql()["q_html_title"]).fetchall())
        assert {r.page_id: r.title for r in catalog.queries()["q_html_title"](spark, str(d)).collect()} == want


def test_report(spark, pages):
    got = {r.domain: r for r in catalog.queries()["q_pages_report"](spark, DIR).collect()}
    dated = {r.page_id for r in catalog.queries()["q_html_fields"](spark, DIR).where("date_time is not null").collect()}
    total, full = Counter(), Counter()
    for i, r in pages.items():
        total[r.domain] += 1
        full[r.domain] += bool([p for p in paragraphs(r.html) if p]) and (i in dated or i % 3 != 0)
    assert {k: r.input_links for k, r in got.items()} == dict(total)
    assert {k: r.n_processed for k, r in got.items()} == {k: full[k] for k in total}


def test_exclusive_markers(spark, pages):
    own: dict = {}
    for i, r in pages.items():
        if i % 5 != 1:
            label = "paywalled" if i % 2 == 0 else "free"
            host = re.sub(r"^www\.", "", re.match(r"(?:\w+://)?([^/:?#]*)", r.url)[1].lower())
            own.setdefault((host, label), set()).update({("css", f"div.paywall-{i % 3}"), ("css", "div[data-plus]")})
    want = {(h, *m) for (h, label), ms in own.items() if label == "paywalled" for m in ms - own.get((h, "free"), set())}
    got = {(r.domain, r.type, r.marker) for r in catalog.queries()["q_exclusive_markers"](spark, DIR).collect()}
    added = {x for x in got if re.fullmatch(r"div\.paywall-\d|div\[data-plus\]", x[2])}
    assert added == want


#: Marks in a page behind which nothing may get lost: declarations, comments, ends of scripts, references.
MARKS = ["", "<![foo]>", "<![ CDATA[x]]>", "<![if x>", "<!-- x --!>", "<!-->", "<!--->", "<!-- x -- >", "<script>x</script y>", "<style>x</style/>", "<script>'</p></'</script\n>", f"<i title='&#{65:05000};'></i>", f"<i>&#{'9' * 5000};</i>"]


def test_whole_pages(spark, tmp_path):
    """Title, headline, text and lengths of every page, also behind marks that the parser raises at or sees no end of, and of paragraphs outside a body."""
    page = "<title>The title</title><h1>Head &amp; line</h1><article><p>one</p>{}<p>two</p><!-- y --><script>x</script><style>x</style><![endif]><p>three</p></article>"
    rows = [(i, page.format(m)) for i, m in enumerate(MARKS)] + [(90, None), (91, " "), (92, "<p>ä\U0001f600"), (93, "<body><p>a</body><p>b")]
    spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("https://a.de/")).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in catalog.queries()["q_html_fields"](spark, str(tmp_path)).collect()}
    names = ("title", "headline", "text", "title_length", "headline_length", "text_length")
    for i, mark in enumerate(MARKS):
        assert [got[i][n] for n in names] == ["The title", "Head & line", "one\ntwo\nthree", 9, 11, 13], mark[:20]
    assert [[got[i][n] for n in names] for i in (90, 91, 92, 93)] == [[None] * 6, [None] * 6, [None, None, "ä\U0001f600", None, None, 2], [None, None, "a\nb", None, None, 3]]


def test_fields_are_whole(spark, pages):
    got = catalog.queries()["q_html_fields"](spark, DIR).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        title = re.search(r"(?is)<title\b[^>]*>(.*?)</title\s*>", bare(pages[r.page_id].html))
        assert plain(r.title) == plain(text(title[1]))
        assert (r.title_length, r.headline_length, r.text_length) == (len(r.title), len(r.headline), len(r.text))


def test_json_ld_is_whole():
    """One object under @graph, a number of many digits and a script that ends with the page; one nested too deep is passed over."""
    script = "<script type='application/ld+json'>{}</script>".format
    bodies = ['{"@graph": {"headline": "H"}}', f'{{"n": {"9" * 5000}, "headline": "H"}}', '{"headline": "</i>H"}']
    got = [extract.fields(parse(p), extract.DEFAULT_RULES)["headline"] for p in (*map(script, bodies), script(bodies[0]).removesuffix("</script>"), script("[" * 100000 + "]" * 100000) + script(bodies[0]))]
    assert got == ["H", "H", "</i>H", "H", "H"]
