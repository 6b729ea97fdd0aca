"""Progress, completeness and agreement reports: one pass over their tables each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.relational import union_fill


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in per cent, rounded half to even."""
    return F.bround(part / whole * 100, digits)


def progress(links: DataFrame, domain: str = "domain") -> DataFrame:
    """Per domain the links by flag, what remains and the progress rate (H2, H3)."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    counts = links.groupBy(F.col(domain).alias("domain")).agg(
        F.count(F.lit(1)).alias("input_links"), F.count_if(flag("processed")).alias("n_processed"), F.count_if(flag("error")).alias("n_error"), F.count_if(flag("parse_error")).alias("n_parse_error"),
        F.count_if(~flag("processed") & ~flag("error") & ~flag("parse_error")).alias("n_remaining"),
    )
    return counts.withColumn("progress_rate", percent(F.col("n_processed") + F.col("n_error"), F.col("input_links")))


def long_shares(report: DataFrame) -> DataFrame:
    """The progress report as one row per domain and status with its share, in a fixed order of statuses (H4)."""
    names = ("n_processed", "n_error", "n_parse_error", "n_remaining")
    shares = report.select("domain", *[percent(F.col(n), F.col("input_links")).alias(n[2:]) for n in names])
    long = shares.unpivot("domain", [n[2:] for n in names], "status", "share")
    return long.withColumn("ordinal", F.array_position(F.array(*[F.lit(n[2:]) for n in names]), F.col("status")))


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table under its label, for a comparison (H5)."""
    return union_fill(*[t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("label"), "n") for name, t in tables.items()])


def parse_error_overview(report: DataFrame) -> DataFrame:
    """Domains of the progress report that have parse errors, with their share."""
    return report.where("n_parse_error > 0").select("domain", "input_links", "n_parse_error", percent(F.col("n_parse_error"), F.col("input_links")).alias("pct_parse_error"))


def sitemap_presence(found: DataFrame) -> DataFrame:
    """How many domains have a sitemap and how many have none."""
    per = found.groupBy("domain_url").agg(F.bool_or(F.col("sitemap_URL").isNotNull()).alias("has"))
    return per.agg(F.count_if("has").alias("with_sitemap"), F.count_if(~F.col("has")).alias("without_sitemap"))


def pattern_counts(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Per named pattern how many texts match it, and the share (H20); a text may match several."""
    counts = df.agg(F.count(F.lit(1)).alias("__all"), *[F.count_if(F.coalesce(F.col(text).rlike(p), F.lit(False))).alias(n) for n, p in patterns.items()])
    return counts.unpivot("__all", list(patterns), "pattern", "n").select("pattern", "n", percent(F.col("n"), F.col("__all")).alias("pct"))


#: The measures of a sitemap's overview.
MEASURES = (
    "total_links_for_domain", "total_valid_links", "total_urlsets", "total_progression_entries", "total_links_excluded_by_date", "total_links_excluded_by_string",
    "total_errors", "total_verified_errors_before_retry", "total_verified_errors_after_retry", "total_unsolved_errors",
)


def sitemap_overview(sitemaps: DataFrame, links: DataFrame, valid: DataFrame, urlsets: DataFrame, progression: DataFrame, errors: DataFrame, log: DataFrame, retry_log: DataFrame, key: str = "layer_1_url_id") -> DataFrame:
    """The eleven measures of each sitemap.

    Every table becomes rows of (key, counts), all of them one union with one aggregation, which is
    combined before its only shuffle, however many tables there are and however large one sitemap is.
    What compares the two logs is aggregated by sitemap and URL first. No table is joined but the list of sitemaps.
    """
    from newsflow.operators.relational import union_fill

    category, status = F.col("error_category"), F.col("processing_status")
    one = F.lit(1).cast("long")
    rows = lambda df, **counts: df.select(key, *[F.when(c, one).alias(n) for n, c in counts.items()])
    every = F.lit(True)
    # the messages of a URL that both logs flag: some agree, some differ
    tried = union_fill(*[t.where("retry_flag").select(key, "requested_url", F.col("http_status_message").alias(name)) for t, name in ((log, "a"), (retry_log, "b"))])
    messages = tried.groupBy(key, "requested_url").agg(F.collect_set("a").alias("a"), F.collect_set("b").alias("b")).where((F.size("a") > 0) & (F.size("b") > 0))
    measured = union_fill(
        rows(links, total_links_for_domain=every), rows(valid, total_valid_links=every), rows(urlsets, total_urlsets=every),
        rows(progression, total_progression_entries=every, total_links_excluded_by_date=status == "excluded_by_date", total_errors=status == "response_error"),
        rows(errors, total_links_excluded_by_date=category == "input_out_of_range", total_links_excluded_by_string=category == "excluded_string", total_errors=category.isin("xml_parse_error", "unsupported_root_tag")),
        rows(log, total_verified_errors_before_retry=F.col("retry_flag")),
        rows(messages, total_verified_errors_after_retry=F.arrays_overlap("a", "b"), total_unsolved_errors=F.size(F.array_union("a", "b")) > 1),
    )
    sums = measured.groupBy(key).agg(*[F.sum(m).alias(m) for m in MEASURES])
    out = sitemaps.join(sums, key, "left").na.fill(0, list(MEASURES))
    return out.withColumn("total_links_excluded", F.col("total_links_excluded_by_date") + F.col("total_links_excluded_by_string"))


def summary(df: DataFrame, label: Column, missing: str = "unknown") -> DataFrame:
    """Rows and share of the total per label; null has a label of its own (H8)."""
    counts = df.groupBy(F.coalesce(label, F.lit(missing)).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("__all")))).select("label", "n", percent(F.col("n"), F.col("__all")).alias("pct"))  # one row


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the share of rows that are neither null nor blank."""
    filled = df.agg(*[F.count(F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))).alias(c) for c in columns], F.count(F.lit(1)).alias("__all"))
    return filled.unpivot("__all", columns, "field", "n_filled").select("field", "n_filled", percent(F.col("n_filled"), F.col("__all")).alias("pct"))


def agreement(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Share of rows on which two extractions agree, per field and over all fields; two nulls agree."""
    same = {name: F.col(a).eqNullSafe(F.col(b)).cast("int") for name, (a, b) in pairs.items()}
    rates = df.agg(*[F.bround(F.avg(x) * 100, 2).alias(n) for n, x in same.items()], F.bround(F.avg(sum(same.values(), F.lit(0)) / len(same)) * 100, 2).alias("overall"))
    return rates.unpivot([], [*pairs, "overall"], "field", "pct")


def deltas(before: DataFrame, after: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Measures of two tables and their differences, one row per measure (H9)."""
    a, b = (t.agg(*[m.alias(n) for n, m in measures.items()]).unpivot([], list(measures), "measure", v) for t, v in ((before, "before"), (after, "after")))
    return a.join(b, "measure").withColumn("delta", F.col("after") - F.col("before"))
