"""Stores laid out by URL: results of the plain operators, and plans without a shuffle of the stores."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from newsflow.operators import buckets, lifecycle


def table(spark, rows):
    return spark.createDataFrame(rows, "id long, url string")


ROWS = {
    "final_data": [(1, "a"), (2, "b/"), (3, None), (9, "b")], "parse_error": [(4, "b"), (5, "c/"), (6, None)],
    "error": [(7, "c"), (8, "d")], "retry": [(10, "a/"), (11, "e"), (12, "e/"), (13, None)],
}


@pytest.fixture
def stores(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {n: buckets.lay_out(table(spark, rows), f"s_{n}_{uuid.uuid4().hex}", str(tmp_path / n), 4) for n, rows in ROWS.items()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    df.collect()
    return re.findall(r"Exchange hashpartitioning[^\n]*", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def test_priority(spark, stores):
    plain = lifecycle.priority_dedup({n: table(spark, rows) for n, rows in ROWS.items()})
    found = buckets.priority(stores)
    assert sorted(map(tuple, found.select("id", "url", "status").collect()), key=str) == sorted(map(tuple, plain.select("id", "url", "status").collect()), key=str)
    with_url = buckets.priority({n: s.where("url is not null") for n, s in stores.items()}).where("url is not null")
    # what is shuffled are rows without a URL only
    assert len(exchanges(with_url)) <= 1


def test_flags_and_unseen_shuffle_the_run_only(spark, stores, tmp_path):
    links = table(spark, [(i, u) for i, u in enumerate(["a", "b", "c", "d", "e", "f", None])])
    laid = buckets.lay_out(links, f"s_links_{uuid.uuid4().hex}", str(tmp_path / "links"), 4)
    found = buckets.flags(laid, stores)
    got = {r.url: (r.processed, r.parse_error, r.error, r.retry) for r in found.collect()}
    assert got == {"a": (True, False, False, True), "b": (True, True, False, False), "c": (False, True, True, False), "d": (False, False, True, False), "e": (False, False, False, True), "f": (False,) * 4, None: (False,) * 4}
    assert exchanges(found) == []
    run = table(spark, [(1, "a/"), (2, "x"), (3, None), (4, "d")])
    new = buckets.unseen(run, list(stores.values()))
    assert {r.id for r in new.collect()} == {2, 3} and len(exchanges(new)) == 1


def test_attached_again(spark, stores, tmp_path):
    again = buckets.attach(spark, f"again_{uuid.uuid4().hex}", str(tmp_path / "error"), "id long, url string", 4)
    assert {(r.id, r.url) for r in again.collect()} == {(7, "c"), (8, "d")}
    assert exchanges(again.groupBy("url").agg(F.count("id").alias("n"))) == []
