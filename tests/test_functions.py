"""Hand-made cases of URL and date functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsflow.functions import dates, urls

CASES = [
    ("/2025/01/15/a", "ymd", "in_range"), ("/2025-02-28-a", "ymd", "in_range"), ("/20241231-a", "ymd_compact", "out_of_range"), ("/15-02-2025/a", "dmy", "in_range"), ("/a-15022025", "dmy_compact", "in_range"),
    ("/archiv/2/2025", "month_year", "in_range"), ("/2025-03/x", "ym", "out_of_range"), ("/sm-202501.xml", "ym_compact", "in_range"), ("/januar2025", "monthname_year", "in_range"), ("/2025august", "ym_monthname", "out_of_range"),
    ("/2025/x", "year_only", "in_range"), ("/2024/x", "year_only", "out_of_range"), ("/artikel-12345678", "none", "no_date"), ("/31132024x", "none", "no_date"), ("/12312024", "none", "no_date"), (None, "none", "no_date"), ("", "none", "no_date"),
    ("/mai2025", "monthname_year", "out_of_range"), ("/2025feb", "ym_monthname", "in_range"), ("/2025märz", "ym_monthname", "out_of_range"),
]


def test_url_dates(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(CASES)], "i int, url string")
    got = {r.i: (r.f.pattern, r.f.reason) for r in df.select("i", dates.url_date(F.col("url"), "2025-01-01", "2025-02-23").alias("f")).collect()}
    assert [got[i] for i in range(len(CASES))] == [(p, r) for _, p, r in CASES]


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("build", "value", "want"),
    [
        (urls.extract_domain, "https://www.a-b.de/x/y", "a-b"), (urls.domain_key, "blog.x.example.net", "blog"), (urls.trim_slash, "u/1/", "u/1"), (urls.ensure_suffix, "a", "a.de"), (urls.ensure_suffix, "a.de", "a.de"),
        (urls.robots_sitemaps, "SITEMAP: https://x/a.xml\nsitemap:https://x/a.xml\nDisallow: /", ["https://x/a.xml"]), (urls.host, "HTTP://User@WWW.Ex.org:80/p?q#f", "ex.org"), (urls.path, "https://a.de", ""), (urls.path, "https://a.de/b/c?x", "/b/c"),
        (urls.pagination_key, "https://x/name-12.xml", "name.xml"), (urls.pagination_number, "https://x/name-12.xml", 12), (urls.pagination_number, "https://x/name.xml", None), (urls.relative_rule, "https://www.a.de/b/c", "b/c"),
        (dates.iso_date, "2025-01-02T10:00:00Z", dt.date(2025, 1, 2)), (dates.iso_date, "2025-1-2", None), (dates.iso_date, "x", None), (dates.iso_date, "2025-13-02", None), (dates.stamp_date, "20250102101010", dt.date(2025, 1, 2)), (dates.stamp_date, "x", None),
        (dates.http_date, "Tue, 05 Mar 2024 10:00:00 GMT", dt.datetime(2024, 3, 5, 10)), (dates.german_datetime, "05.03.2024, 11:00 Uhr", dt.datetime(2024, 3, 5, 10)), (dates.german_datetime, "5.7.2024 - 12:30", dt.datetime(2024, 7, 5, 10, 30)), (dates.iso_datetime, "2024-03-05T11:00:00+01:00", dt.datetime(2024, 3, 5, 10)),
    ],
)
def test_values(spark, build, value, want):
    got = one(spark, value, build)
    if isinstance(got, dt.datetime):
        got = got.astimezone(dt.UTC).replace(tzinfo=None)
    assert got == want


def test_urlset_range(spark):
    day = lambda s: dt.date.fromisoformat(s)
    for value, want in (([], ("no_lastmod_found", None)), ([day("2025-01-05"), day("2024-01-01"), None], ("in_range", day("2025-01-05"))), ([day("2024-01-01")], ("out_of_range", None))):
        assert tuple(one(spark, value, lambda x: dates.urlset_range(x, "2025-01-01", "2025-02-23"), "array<date>")) == want
