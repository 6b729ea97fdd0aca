"""Pages as files, and re-parsing by fingerprints of rules."""

import os

import pytest
from pyspark.sql import functions as F

from newsflow.operators import workbench
from newsflow.sources import page_files

PAGES = [("a/b:c d", "<p>\r\n one\n\n"), ("ü", "two\r"), ("x%2F", ""), ("n", None), ("..", "dots")]


def held(spark, path):
    return sorted((r.name, r.html) for r in page_files.load(spark, path).collect())


def test_round_trip(spark, tmp_path):
    for path in (str(tmp_path / "one"), f"file://{tmp_path}/two"):
        page_files.export(spark.createDataFrame(PAGES, "name string, html string"), path)
        assert held(spark, path) == sorted((n, h or "") for n, h in PAGES)
        page_files.export(spark.createDataFrame([("n", "new"), ("m", "more")], "name string, html string"), path, mode="append")
        assert len(held(spark, path)) == len(PAGES) + 1 and ("n", "new") in held(spark, path)
        page_files.export(spark.createDataFrame([("only", "1")], "name string, html string"), path)
        assert held(spark, path) == [("only", "1")]
    assert len(os.listdir(tmp_path / "one")) == 1 and held(spark, str(tmp_path / "none")) == []


def test_bad_names_raise_and_leave_the_pages(spark, tmp_path):
    path = str(tmp_path / "p")
    page_files.export(spark.createDataFrame([("a", "1")], "name string, html string"), path)
    for rows in ([("b", "2"), (None, "3")], [("b", "2"), ("b", "3")]):
        with pytest.raises(Exception, match="name"):
            page_files.export(spark.createDataFrame(rows, "name string, html string").coalesce(1), path)
        assert ("a", "1") in held(spark, path)
    named = page_files.unique_names(spark.createDataFrame([(i, n) for i, n in enumerate(["a", "a", "a-2", "a", "b"])], "i int, name string"), "name", ["i"])
    assert sorted(tuple(r) for r in named.select("i", "name").collect()) == [(0, "a"), (1, "a-2~"), (2, "a-2"), (3, "a-3"), (4, "b")]


def rule(version, domain, selector, field="headline"):
    return (version, domain, field, 1, "css", [selector], [])


def test_only_changed_pages_are_parsed(spark):
    html = "<h1>one</h1><h2>two</h2>"
    pages = spark.createDataFrame([(i, f"https://{s}.de/{i}", html) for i, s in enumerate("aabbbc")], "id long, url string, html string")
    rules = [rule("local", "*", "h1"), rule("local", "b.de", "h2"), rule("prod", "a.de", "h2")]
    frame = lambda some: spark.createDataFrame(some, workbench.RULE_TABLE)
    show = lambda df: sorted((r.id, r.x.headline) for r in df.collect())
    first = workbench.reparse_changed(pages, frame(rules)).cache()
    assert show(first) == show(workbench.reparse(pages, frame(rules))) == [(0, "one"), (1, "one"), (2, "two"), (3, "two"), (4, "two"), (5, "one")]
    assert workbench.changed(pages, frame(rules[::-1]), first).count() == 0
    for edited, want in (([*rules, rule("local", "a.de", "h2")], {0, 1}), (rules[:1], {2, 3, 4}), ([rule("local", "*", "h2"), rules[1]], {0, 1, 2, 3, 4, 5}), ([*rules, rule("prod", "b.de", "p")], set())):
        assert {r.id for r in workbench.changed(pages, frame(edited), first).collect()} == want
        assert show(workbench.reparse_changed(pages, frame(edited), first)) == show(workbench.reparse(pages, frame(edited)))
    more = pages.unionByName(pages.limit(1).withColumns({"id": F.lit(9).cast("long"), "url": F.lit("https://c.de/9")}))
    assert {r.id for r in workbench.changed(more, frame(rules), first).collect()} == {9}
    assert workbench.reparse_changed(more, frame(rules), first).count() == 7
