"""Health of domains on streams: two runs are one fold, state from a batch, state that ends."""

from newsflow.operators import responses
from newsflow.streaming import state

LOG = "domain string, ts long, event_id long, action string, reason string"


def events(start, n, domain="a", action="retry"):
    return [(domain, i, i, action, "http_error_500") for i in range(start, start + n)]


def run(spark, tmp_path, rows, name, **how):
    """One run over a folder of files: what the updates say last of each domain."""
    folder, found = tmp_path / name, {}
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(str(folder))

    def keep(batch, _):
        found.update({r.domain: (r.streak, r.last_reason, r.kills, r.blocked) for r in batch.collect()})

    with state.state_on_disk(spark):
        stream = state.domain_health(spark.readStream.schema(LOG).parquet(str(folder)), **how)
        stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / f"{name}-state")).trigger(availableNow=True).start().awaitTermination()
    return found


def fold(spark, rows, level=1):
    found = responses.domain_health(spark.createDataFrame(rows, LOG), "domain", ["ts", "event_id"], "action", "reason", level)
    return {r.domain: (r.streak, r.last_reason, r.kills, r.blocked) for r in found.collect()}


def test_two_runs_are_one_fold(spark, tmp_path):
    cut = 4
    rows = events(0, 7) + events(7, 1, action="parse") + events(8, 6) + events(0, 11, "b") + events(3, 2, "c", "parse")
    first, second = ([r for r in rows if (r[1] < cut) == early] for early in (True, False))
    want = fold(spark, rows)
    got = run(spark, tmp_path, first, "halves") | run(spark, tmp_path, second, "halves")
    assert got == want
    # the first half by a batch
    initial = responses.domain_health(spark.createDataFrame(first, LOG), "domain", ["ts", "event_id"], "action", "reason", 1)
    assert fold(spark, first) | run(spark, tmp_path, second, "from-batch", initial=initial) == want


def test_state_ends(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # by the clock there is always another batch
    try:
        assert run(spark, tmp_path, events(0, 2), "short", keep_ms=1)["a"][0] == 2
        assert run(spark, tmp_path, events(2, 1), "short", keep_ms=1)["a"][0] == 1
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
