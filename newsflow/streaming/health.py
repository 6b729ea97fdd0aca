"""Streaming forms of the log operators: extensions, since the reference works on logs in batches only."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from newsflow.operators.responses import transition

HEALTH = "domain string, streak long, last_reason string, kills long, blocked long"


def domain_health(log: DataFrame, level: int = 1) -> DataFrame:
    """Health state per domain after each micro-batch (update mode); the transition is that of the batch fold.

    log: domain, ts, event_id, action, reason. State is four small values per domain. Events of one
    micro-batch are folded in order of (ts, event_id).
    """
    import pandas as pd

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (0, None, 0, 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for action, reason in zip(rows["action"], rows["reason"], strict=True):
            now = transition(tuple(now), action, reason, level)
        state.update(now)
        yield pd.DataFrame([(key[0], *now)], columns=["domain", "streak", "last_reason", "kills", "blocked"])

    return log.groupBy("domain").applyInPandasWithState(fold, HEALTH, "streak long, last_reason string, kills long, blocked long", "update", "NoTimeout")


def response_counts(log: DataFrame, ts: str = "ts", label: str = "analysis", window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Responses per tumbling window and label; events later than the watermark are left out."""
    return log.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), label).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), label, "n")


def first_seen(log: DataFrame, key: str, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The first row per key, with state dropped behind the watermark."""
    return log.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])
