"""A run over a chunk of links: choosing the links, and what their responses leave in logs and stores.

Fetched responses are an input table. A routed response (``responses.route``) goes to one of four sinks;
with the request and the response log these are the six stores of a run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsflow.operators.lifecycle import priority_dedup
from newsflow.operators.relational import aligned, numbered, round_robin, sample, stratified_sample, union_fill
from newsflow.operators.responses import LEVELS

#: The columns of the stores.
FINAL = ("id", "domain", "url", "timestamp_scraped", "date_time", "author", "headline", "text", "paywall")
ERROR = ("id", "domain", "url", "error_reason")
STORES = ("request_log", "response_log", "final_data", "retry", "error", "parse_error")
SNIPPET = 2000


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def eligible(links: DataFrame, skip_retry: bool = False, skip_parse_error: bool = False) -> DataFrame:
    """Links that are neither processed nor in error, and by choice not to be retried or re-parsed."""
    keep = ~_flag("processed") & ~_flag("error")
    for skip, name in ((skip_retry, "retry"), (skip_parse_error, "parse_error")):
        keep = keep & ~_flag(name) if skip else keep
    return links.where(keep)


def chunk(links: DataFrame, size: int, seed: str = "", **skip: bool) -> DataFrame:
    """The next ``size`` eligible links, proportional by domain, with seq and turn: sorted by both, domains take turns."""
    return round_robin(stratified_sample(eligible(links, **skip), "domain", "id", size, seed), "domain", "id", seed)


def pending(links: DataFrame, flag: str = "parse_error", value: bool = True) -> DataFrame:
    """id, domain and url of links whose flag has a value, for a table partitioned by domain."""
    return links.where(_flag(flag) == value).select("id", "domain", "url")


def _without_blanks(df: DataFrame) -> DataFrame:
    return df.select(*[(F.when(F.trim(F.col(f.name)) != "", F.col(f.name)) if f.dataType.simpleString() == "string" else F.col(f.name)).alias(f.name) for f in df.schema.fields])


def log_rows(log: DataFrame, new: DataFrame, order: list[str], id_col: str, texts: dict[str, Column] | None = None) -> DataFrame:
    """Rows to append to a log (B11, B12): numbered on from its largest id in the given order, in its columns and types; blank texts and what is missing are null.

    texts: long columns that are made from those of ``new`` once the rows are numbered, so that the sort moves none of them.
    """
    last = log.agg(F.coalesce(F.max(id_col).cast("long"), F.lit(0)).alias("__last"))
    rows = numbered(_without_blanks(new).drop(id_col), order, "__n")
    rows = (_without_blanks(rows.withColumns(texts)) if texts else rows).crossJoin(F.broadcast(last))  # one row
    return aligned(rows.withColumn(id_col, F.col("__n") + F.col("__last")).drop("__n", "__last"), log)


def snippet(text: Column, most: int = SNIPPET) -> Column:
    """The first characters of a header or body, as logs keep them."""
    return F.substring(text, 1, most)


def sinks(routed: DataFrame, response_log: DataFrame, chunk_col: str = "from_chunk") -> dict[str, DataFrame]:
    """final_data, retry, error and parse_error rows of routed responses.

    routed: FINAL columns, html_content, route, reason and the chunk. A retry row carries the ids of the
    latest response to its URL in its chunk, if the log has one.
    """
    to = lambda name: routed.where(F.col("route") == name)
    latest = response_log.groupBy("url", chunk_col).agg(F.max_by(F.struct("request_id", "response_id", "status_code"), "response_id").alias("__l"))
    again = to("retry").join(latest, ["url", chunk_col], "left")
    return {
        "final_data": to("output").select(*FINAL),
        "retry": again.select("__l.request_id", "__l.response_id", "id", "domain", "url", "timestamp_scraped", chunk_col, "__l.status_code", F.col("reason").alias("retry_reason")),
        "error": to("error").select("id", "domain", "url", F.col("reason").alias("error_reason")),
        "parse_error": to("parse_error").select(*FINAL, "html_content"),
    }


def flush(spark: SparkSession, tables: dict[str, DataFrame], root: str, batch: str | None = None) -> bool:
    """The tables of a chunk appended to their stores under root, all or none.

    ``batch`` names the chunk: a flush that failed can be run again, and one that is committed is not
    repeated (False). Without a name every call is a batch of its own. ``commits.read`` reads the stores.
    """
    from newsflow.sources import commits

    return commits.commit(spark, tables, root, batch or uuid.uuid4().hex)


def flush_chunk(spark: SparkSession, routed: DataFrame, log: DataFrame, root: str, batch: str, chunk_col: str = "from_chunk") -> bool:
    """A chunk's log rows and sinks flushed as one batch. ``routed`` and ``log`` (request_id, response_id, domain, url, the chunk, status_code) are computed once each, however many stores get rows of them."""
    from newsflow.sources import commits
    from newsflow.sources.tables import materialize

    if commits.committed(spark, root, batch):
        return False
    routed, log = materialize(routed, "routed"), materialize(log, "log")
    requests = log.select(F.col("request_id").alias("id"), "url")
    responses = log.select(F.col("request_id").alias("id"), "response_id", "url")
    return flush(spark, sinks(routed, log, chunk_col) | {"request_log": requests, "response_log": responses}, root, batch)


def gone_links(response_log: DataFrame) -> DataFrame:
    """URLs that ever answered 410."""
    return response_log.where("status_code = 410").select("url").distinct()


def last_known(log: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Per key the last value of each column that is not null."""
    return log.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns])


def all_blocked(states: DataFrame, level: int) -> DataFrame:
    """One row, stop: whether every domain has used up its kills (G8); no domain: false."""
    most = LEVELS[level][1]
    out = F.lit(False) if most is None else F.coalesce(F.bool_and(F.col("kills") >= most), F.lit(False))
    return states.agg(out.alias("stop"))


def within_budget(log: DataFrame, key: str, order: list[str], status: str, most: int = 20, most_soft: int = 15, soft: str | None = None, errors: int = 5) -> DataFrame:
    """The requests of a visit that its budget allows (G22): the first ``most`` (fewer where ``soft`` holds), up to ``errors`` failures in a row."""
    w = Window.partitionBy(key).orderBy(*order)
    bad = F.when(F.col(status) == 200, 0).otherwise(1)
    marked = log.withColumn("__n", F.row_number().over(w)).withColumn("__bad", bad)
    # the last success before a row tells how many failures in a row end with it
    good = F.coalesce(F.max(F.when(F.col("__bad") == 0, F.col("__n"))).over(w), F.lit(0))
    marked = marked.withColumn("__streak", F.col("__n") - good)
    before = F.coalesce(F.max("__streak").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    limit = F.when(F.col(soft), most_soft).otherwise(most) if soft else F.lit(most)
    return marked.withColumn("__b", before).where((F.col("__n") <= limit) & (F.col("__b") < errors)).drop("__n", "__bad", "__streak", "__b")


def merge_extractions(ours: DataFrame, theirs: DataFrame, key: str = "url", columns: tuple[str, ...] = ("date_time", "author", "headline", "text")) -> DataFrame:
    """Our extraction with what it lacks from a second one, field by field (A16); blank is lacking."""
    b = theirs.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    filled = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c))
    joined = ours.join(b, key, "left")
    return joined.withColumns({c: F.coalesce(filled(c), filled(f"__{c}")) for c in columns}).drop(*[f"__{c}" for c in columns])


def retry_run(links: DataFrame, extracted: DataFrame, stores: dict[str, DataFrame], most: int | None = 300, seed: str = "", candidates: Column | str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The retry workflow (J7): of the links that are candidates (by any predicate over their columns; else those flagged for retry), ``most`` at random (None: all) are extracted a second time; what has a text and a date joins final_data and leaves the other stores. Returns the stores and the failures (url, reason)."""
    wanted = _flag("retry") if candidates is None else F.expr(candidates) if isinstance(candidates, str) else candidates
    chosen = links.where(wanted).select("id", "domain", "url")
    chosen = chosen if most is None else sample(chosen, "url", most, seed)
    tried = chosen.join(extracted, "url", "left")
    valid = F.coalesce((F.trim("text") != "") & F.col("date_time").isNotNull(), F.lit(False))
    good = tried.where(valid)
    failed = tried.where(~valid).select("url", F.when(F.col("text").isNull(), "not extracted").when(F.trim("text") == "", "empty text").otherwise("no date").alias("reason"))
    return store_final(stores, good), failed


def store_final(stores: dict[str, DataFrame], good: DataFrame) -> dict[str, DataFrame]:
    """The stores after parsed rows have joined final_data: each URL in the store of highest priority."""
    final = union_fill(stores["final_data"], good.select(*[c for c in good.columns if c in stores["final_data"].columns]))
    every = priority_dedup(stores | {"final_data": final})
    return {name: every.where(F.col("status") == name).select(*df.columns) for name, df in stores.items()}
