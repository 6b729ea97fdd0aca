"""Response classification, domain health and routing, as columns and folds over a response table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Aggressiveness level -> (error limit, kill limit); null kills: never blocked.
LEVELS = {1: (3, 3), 2: (5, 5), 3: (10, 10), 4: (20, 15), 5: (30, None)}
DEFAULT_LEVEL = (5, 5)
SESSIONS = 10


def analyze(failed: Column, status: Column, parse_outcome: Column) -> Column:
    """Struct of action and analysis of an article response (G1)."""
    bad = F.concat(F.lit("http_error_"), status.cast("string"))
    analysis = F.when(failed, "network_error").when(status.isNull(), "invalid_response").when(status == 200, parse_outcome).otherwise(bad)
    action = (
        F.when(failed | status.isNull(), "retry").when((status == 200) & (parse_outcome == "bot_detected"), "retry").when(status == 200, "parse")
        .when(status.isin(404, 410), "error").otherwise("retry")
    )
    return F.struct(action.alias("action"), analysis.alias("analysis"))


def sitemap_category(status: Column) -> Column:
    """hard, soft or other block indication of a sitemap response."""
    return F.when(status.isNull() | status.isin(401, 403, 407), "hard_block_indication").when(status.isin(406, 408, 429, 503), "soft_block_indication").otherwise("other_error")


def block_streaks(log: DataFrame, keys: list[str], order: list[str], status: str, limit: int = 10) -> DataFrame:
    """Consecutive responses of one category per key (G3): category, streak, action_taken, retry_flag. A 200 breaks a streak."""
    category = F.when(F.col(status) == 200, "ok").otherwise(sitemap_category(F.col(status)))
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = log.withColumn("category", category).withColumn("__new", F.when(F.col("category").eqNullSafe(F.lag("category").over(w)), 0).otherwise(1))
    numbered = marked.withColumn("__run", F.sum("__new").over(w))
    streak = F.row_number().over(Window.partitionBy(*keys, "__run").orderBy(*order)).cast("long")
    counted = numbered.withColumn("streak", F.when(F.col("category") == "ok", F.lit(0).cast("long")).otherwise(streak)).drop("__new", "__run")
    action = F.when((F.col("category") == "soft_block_indication") & (F.col("streak") > limit), "soft_block_handling").when((F.col("category") != "soft_block_indication") & (F.col("streak") > limit), "hard_block").otherwise("logged")
    return counted.withColumn("action_taken", action).withColumn("retry_flag", F.col("category").isin("hard_block_indication", "soft_block_indication"))


def health_streaks(log: DataFrame, key: str, order: list[str], action: str, reason: str) -> DataFrame:
    """Streak of equal retry reasons per domain after each event (G4); everything that is no retry sets it to 0."""
    w = Window.partitionBy(key).orderBy(*order)
    state = F.when(F.col(action) == "retry", F.col(reason))
    marked = log.withColumn("__s", state)
    new = F.when(F.col("__s").eqNullSafe(F.lag("__s").over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = marked.withColumn("__new", new).withColumn("__run", F.sum("__new").over(w))
    streak = F.row_number().over(Window.partitionBy(key, "__run").orderBy(*order)).cast("long")
    return numbered.withColumn("streak", F.when(F.col("__s").isNull(), F.lit(0).cast("long")).otherwise(streak)).drop("__s", "__new", "__run")


def transition(state: tuple[int, str | None, int, int], action: str, reason: str, level: int) -> tuple[int, str | None, int, int]:
    """One event of the health state (streak, reason, kills, blocked events): the one definition that batch and stream share."""
    streak, last, kills, blocked = state
    errors, most = LEVELS.get(level, DEFAULT_LEVEL)
    if most is not None and kills >= most:
        return streak, last, kills, blocked + 1
    if streak >= errors:
        streak, last, kills = 0, None, kills + 1
        if kills >= SESSIONS:  # no session is left; the event does not happen
            return streak, last, kills, blocked + 1
    if action != "retry":
        return 0, None, kills, blocked
    return (streak + 1 if reason == last else 1), reason, kills, blocked


def domain_health(log: DataFrame, key: str, order: list[str], action: str, reason: str, level: int = 1) -> DataFrame:
    """Final streak, last reason, kills, blocked events and decision per domain.

    A kill resets the streak on which it depends, so this is a fold in order: events are sorted inside
    partitions by domain and streamed through ``transition``, with one state in memory at a time.
    """
    errors, most = LEVELS.get(level, DEFAULT_LEVEL)
    events = log.select(F.col(key).alias("k"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(action).alias("a"), F.col(reason).alias("r"))
    sorted_ = events.repartition("k").sortWithinPartitions("k", *[f"o{i}" for i in range(len(order))]).select("k", "a", "r")

    def fold(batches):
        now, n, state, begun = None, 0, (0, None, 0, 0), False
        for batch in batches:
            out = []
            for k, a, r in zip(batch.column("k").to_pylist(), batch.column("a").to_pylist(), batch.column("r").to_pylist(), strict=True):
                if not begun or k != now:
                    if begun:
                        out.append((now, n, *state))
                    now, n, state, begun = k, 0, (0, None, 0, 0), True
                n, state = n + 1, transition(state, a, r, level)
            yield _batch(out, batch.schema.field("k").type)
            last = batch.schema.field("k").type
        if begun:
            yield _batch([(now, n, *state)], last)

    schema = T.StructType([T.StructField("k", log.schema[key].dataType), *T._parse_datatype_string("n long, streak long, last string, kills long, blocked long").fields])
    state = sorted_.mapInArrow(fold, schema)
    decision = F.when(F.col("kills") >= most, "block") if most is not None else F.when(F.col("kills") >= SESSIONS, "block")
    decision = decision.when(F.col("streak") >= errors, "rotate").otherwise("proceed")
    return state.select(F.col("k").alias(key), F.col("n").alias("n_events"), "streak", F.col("last").alias("last_reason"), "kills", "blocked", decision.alias("decision"))


def _batch(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    types = (key_type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    columns = [list(c) for c in zip(*rows, strict=True)] or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["k", "n", "streak", "last", "kills", "blocked"])


def route(html: Column, parsed: Column, bot: Column, date_time: Column, text: Column, paywall: Column) -> Column:
    """Struct of route and reason of a fetched article (G10). A null paywall goes to error, like a true one."""
    full = date_time.isNotNull() & F.nullif(F.trim(text), F.lit("")).isNotNull()
    reason = (
        F.when(F.coalesce(html, F.lit("")) == "", "empty_html_content").when(~parsed, "html_parse_failed").when(bot, "bot_detected").when(full, "valid")
        .when(F.coalesce(paywall, F.lit(True)), "paywalled_content_or_missing_fields").otherwise("parsing_failed_no_paywall")
    )
    target = F.when(reason == "valid", "output").when(reason == "bot_detected", "retry").when(reason == "parsing_failed_no_paywall", "parse_error").otherwise("error")
    return F.struct(target.alias("route"), reason.alias("reason"))
