"""Stores that are committed in batches, and tables by domain."""

import os

import pytest
from pyspark.sql import functions as F

from newsflow.operators import runlog
from newsflow.sources import commits, tables

NAMES = runlog.STORES


def chunk(spark, ids):
    return {name: spark.createDataFrame([(i, f"{name}{i}") for i in ids], "id long, url string") for name in NAMES}


def ids_of(spark, root, name):
    return sorted(r.id for r in commits.read(spark, root, name).collect())


def test_flush_after_a_failure_gives_each_row_once(spark, tmp_path):
    root = str(tmp_path / "run")
    good = chunk(spark, [1, 2])
    bad = dict(good)
    bad[NAMES[3]] = good[NAMES[3]].withColumn("url", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        runlog.flush(spark, bad, root, "chunk_001")
    assert len(os.listdir(f"{root}/data")) >= 3 and commits.commits(spark, root) == []
    with pytest.raises(ValueError):
        commits.read(spark, root, NAMES[0])
    assert commits.read(spark, root, NAMES[0], "id long").count() == 0
    assert runlog.flush(spark, good, root, "chunk_001")
    assert not runlog.flush(spark, chunk(spark, [8, 9]), root, "chunk_001")
    assert all(ids_of(spark, root, n) == [1, 2] for n in NAMES)
    assert runlog.flush(spark, chunk(spark, [3]), root, "chunk_002") and runlog.flush(spark, chunk(spark, [3]), root)
    assert all(ids_of(spark, root, n) == [1, 2, 3, 3] for n in NAMES)


def test_compaction(spark, tmp_path):
    root = str(tmp_path / "run")
    for i in range(4):
        runlog.flush(spark, chunk(spark, [i]), root, f"b{i}")
    reader = commits.read(spark, root, "error")
    assert commits.compact(spark, root, "error") and not commits.compact(spark, root, "error")
    assert ids_of(spark, root, "error") == [0, 1, 2, 3] == sorted(r.id for r in reader.collect())
    assert commits.sweep(spark, root, "error") == 4 and commits.sweep(spark, root, "error") == 0
    assert not runlog.flush(spark, chunk(spark, [0]), root, "b0")  # a replaced batch is still known
    runlog.flush(spark, chunk(spark, [7]), root, "b7")
    assert ids_of(spark, root, "error") == [0, 1, 2, 3, 7] and ids_of(spark, root, "retry") == [0, 1, 2, 3, 7]


def test_later_batches_are_cast(spark, tmp_path):
    root = str(tmp_path / "run")
    commits.commit(spark, {"a": spark.createDataFrame([(1, "x")], "id long, name string")}, root, "one")
    commits.commit(spark, {"a": spark.createDataFrame([("2", 5), ("y", 6)], "id string, more int")}, root, "two")
    assert sorted(map(tuple, commits.read(spark, root, "a").collect()), key=str) == [(1, "x"), (2, None), (None, None)]
    with pytest.raises(ValueError):
        commits.commit(spark, {}, root, "../three")


DOMAINS = ["a.de", "host:8080", "a/b", None, "007", "7", "null", "", "x=y", "100%", "d_7", "__HIVE_DEFAULT_PARTITION__", "ü.de", " "]


def rows(spark, some):
    return spark.createDataFrame(some, "url string, v int, domain string")


def held(spark, path):
    return sorted(map(tuple, tables.read_by_domain(spark, path).select("domain", "url", "v").collect()), key=str)


def files(path):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_domains_survive_merges(spark, tmp_path):
    path, want = str(tmp_path / "d"), {}
    nobody = rows(spark, []).select("url")
    for turn in range(10):
        some = [(f"u{turn % 4}", turn, x) for x in DOMAINS[turn % 3 :: 2]] + [("same", turn, DOMAINS[turn])]
        for u, v, x in some:
            want.setdefault((x, u), v)
        before = files(path)
        tables.merge_by_domain(spark, rows(spark, some), path, nobody)
        assert held(spark, path) == sorted(((x, u, v) for (x, u), v in want.items()), key=str)
        hit = {tables._folder_of(spark, "null" if x is None else f"d_{x}") for _, _, x in some}
        after = files(path)
        assert {k: v for k, v in before.items() if k.split("/")[-2] not in hit} == {k: v for k, v in after.items() if k.split("/")[-2] not in hit}
    for x in DOMAINS:
        assert sorted(r.url for r in tables.read_by_domain(spark, path, [x]).collect()) == sorted(u for d, u in want if d == x)
    # a URL that is done in one domain stays in the others
    tables.merge_by_domain(spark, rows(spark, []), path, spark.createDataFrame([("u0", None), ("u0", "7")], "url string, domain string"))
    for x in (None, "7"):
        want.pop((x, "u0"), None)
    assert held(spark, path) == sorted(((x, u, v) for (x, u), v in want.items()), key=str)
    # done everywhere: folders that are empty go, the table and its columns stay
    tables.merge_by_domain(spark, rows(spark, []), path, spark.createDataFrame([(u,) for _, u in want] + [(None,)], "url string"))
    assert held(spark, path) == [] and not [f for f in os.listdir(path) if f.startswith(tables.PART)]
    tables.merge_by_domain(spark, rows(spark, [("n", 1, "a.de"), (None, 2, "a.de"), (None, 3, "a.de")]), path, nobody)
    assert held(spark, path) == [("a.de", "n", 1), ("a.de", None, 2)]
    tables.merge_by_domain(spark, rows(spark, []), path, spark.createDataFrame([(None,)], "url string"))
    assert held(spark, path) == [("a.de", "n", 1)]


def test_new_columns_and_types(spark, tmp_path):
    path = str(tmp_path / "d")
    tables.merge_by_domain(spark, spark.createDataFrame([("u", 7, 1)], "url string, domain long, v int"), path, rows(spark, []).select("url"))
    tables.merge_by_domain(spark, spark.createDataFrame([("w", "8", "x")], "url string, domain string, name string"), path, rows(spark, []).select("url"))
    got = tables.read_by_domain(spark, path)
    assert got.dtypes == [("url", "string"), ("domain", "bigint"), ("v", "int"), ("name", "string")]
    assert sorted(map(tuple, got.collect())) == [("u", 7, 1, None), ("w", 8, None, "x")]


@pytest.mark.parametrize("moves", (0, 1, 2))
def test_cut_off_merge_is_finished(spark, tmp_path, monkeypatch, moves):
    path, nobody = str(tmp_path / "d"), rows(spark, []).select("url")
    tables.merge_by_domain(spark, rows(spark, [("u", 1, "a"), ("u", 1, "b"), ("u", 1, "c")]), path, nobody)
    finish = tables.finish_merge
    monkeypatch.setattr(tables, "finish_merge", lambda *_: False)
    tables.merge_by_domain(spark, rows(spark, [("w", 2, "a"), ("w", 2, "b")]), path, spark.createDataFrame([("u", "c")], "url string, domain string"))
    monkeypatch.setattr(tables, "finish_merge", finish)
    # what a first call did before it was lost: some folders are moved already
    parts = sorted(f for f in os.listdir(f"{path}.merge/rows") if f.startswith(tables.PART))
    for name in parts[:moves]:
        os.rename(f"{path}/{name}", str(tmp_path / f"old-{name}"))
        os.rename(f"{path}.merge/rows/{name}", f"{path}/{name}")
    assert held(spark, path) == [("a", "u", 1), ("a", "w", 2), ("b", "u", 1), ("b", "w", 2)] and not os.path.exists(f"{path}.merge")
    assert not tables.finish_merge(spark, path)


def test_large_domain_becomes_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    path = str(tmp_path / "d")
    tables.merge_by_domain(spark, spark.range(1000).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("v"), F.lit("hot").alias("domain")), path, rows(spark, []).select("url"))
    assert len(files(path)) >= 10 and tables.read_by_domain(spark, path).count() == 1000


def test_chunk_is_computed_once(spark, tmp_path):
    routed = spark.createDataFrame([(1, "d", "u", "t", "2024", "a", "h", "x", False, "<p>", r, "why", "c") for r in ("output", "retry", "error", "parse_error")], "id long, domain string, url string, timestamp_scraped string, date_time string, author string, headline string, text string, paywall boolean, html_content string, route string, reason string, from_chunk string")
    log = spark.createDataFrame([(1, 10, "d", "u", "c", 429)], "request_id long, response_id long, domain string, url string, from_chunk string, status_code int")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    root = str(tmp_path / "run")
    assert runlog.flush_chunk(spark, routed.mapInArrow(counted, routed.schema), log, root, "c1")
    assert not runlog.flush_chunk(spark, routed, log, root, "c1")
    assert seen.value == 4 and [commits.read(spark, root, n).count() for n in NAMES] == [1] * 6
    assert commits.read(spark, root, "retry").first().response_id == 10


def test_retry_candidates_by_any_predicate(spark):
    links = spark.createDataFrame([(i, "d", f"u{i}", i % 2 == 0, i % 3) for i in range(9)], "id long, domain string, url string, retry boolean, tries int")
    stores = {"final_data": spark.createDataFrame([], "id long, domain string, url string, date_time string, text string"), "retry": links.select("id", "domain", "url")}
    found = links.select("url", F.lit("text").alias("text"), F.lit("2024").alias("date_time"))
    for candidates, want in ((None, {0, 2, 4, 6, 8}), ("tries = 1", {1, 4, 7}), (F.col("tries") > 1, {2, 5, 8})):
        got, failed = runlog.retry_run(links, found, stores, None, candidates=candidates)
        assert {r.id for r in got["final_data"].collect()} == want and failed.count() == 0
