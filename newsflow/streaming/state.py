"""Health of domains on a stream with state that can begin from a batch and that ends (an extension)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from newsflow.operators.responses import transition
from newsflow.streaming.health import HEALTH

STATE = StructType([StructField("streak", LongType()), StructField("last_reason", StringType()), StructField("kills", LongType()), StructField("blocked", LongType())])
PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams that are started inside keep their state in RocksDB, which this kind of state needs; the setting before comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


class _Health(StatefulProcessor):
    def __init__(self, level: int, keep_ms: int | None):
        self.level, self.keep_ms = level, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("health", STATE, ttlDurationMs=self.keep_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.iloc[0]
        self.state.update((int(row["streak"]), None if row["last_reason"] is None or row["last_reason"] != row["last_reason"] else str(row["last_reason"]), int(row["kills"]), int(row["blocked"])))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        now = tuple(self.state.get()) if self.state.exists() else (0, None, 0, 0)
        # what the fold needs of a micro-batch's events, in order
        frames = pd.concat([f[["ts", "event_id", "action", "reason"]] for f in rows]).sort_values(["ts", "event_id"])
        for action, reason in zip(frames["action"], frames["reason"], strict=True):
            now = transition(now, action, reason, self.level)
        self.state.update(now)
        yield pd.DataFrame([(key[0], *now)], columns=["domain", "streak", "last_reason", "kills", "blocked"])

    def close(self) -> None:
        pass


def domain_health(log: DataFrame, level: int = 1, initial: DataFrame | None = None, keep_ms: int | None = None) -> DataFrame:
    """Health state per domain after each micro-batch (update mode); start the query inside ``state_on_disk``.

    log: domain, ts, event_id, action, reason; events come in order from one micro-batch to the next.
    initial: domain, streak, last_reason, kills, blocked, a row per domain, as the batch fold
    gives them: the stream goes on from there. keep_ms: a domain that is silent for so long (by the
    clock) starts anew, and its state goes; with availableNow such a stream ends only where
    spark.sql.streaming.noDataMicroBatches.enabled is false. The size of a micro-batch bounds what a task holds of one domain.
    """
    return log.groupBy("domain").transformWithStateInPandas(
        statefulProcessor=_Health(level, keep_ms), outputStructType=HEALTH, outputMode="Update", timeMode="None" if keep_ms is None else "ProcessingTime",
        initialState=None if initial is None else initial.select("domain", "streak", "last_reason", "kills", "blocked").groupBy("domain"),
    )
