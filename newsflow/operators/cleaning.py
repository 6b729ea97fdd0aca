"""Exclusion rules with an audit trail: exact URLs, path patterns per host, special rules per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions.urls import has_any, host, path, path_pattern, relative_rule, slashes
from newsflow.operators.relational import first_per_key

RULES = "domain string, kind string, pattern string"


def path_patterns(rules: DataFrame) -> DataFrame:
    """(domain, pattern): one pattern per host out of its path rules."""
    own = rules.where("kind = 'path'").withColumn("pattern", relative_rule(F.col("pattern")))
    grouped = own.groupBy("domain").agg(F.array_sort(F.collect_list("pattern")).alias("paths"))
    return grouped.select("domain", path_pattern(F.col("domain"), F.col("paths")).alias("pattern"))


def special_hit(url: Column, kind: Column, pattern: Column) -> Column:
    """Whether a special rule holds: rlike on the URL, or the number of path segments or of slashes."""
    segments = F.size(F.filter(F.split(path(url), "/"), lambda x: x != ""))
    return F.when(kind == "rlike", F.regexp_like(url, pattern)).when(kind == "segments", segments == pattern.try_cast("int")).when(kind == "slashes", slashes(url) == pattern.try_cast("long")).otherwise(False)


def clean(articles: DataFrame, exact: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """articles with ``reason``: exact_match, path_rule, special_rule or null, the first that holds.

    ``rules`` (domain, kind, pattern) are joined by host, so each row meets the rules of its own host
    only; Spark broadcasts them while they are small and shuffles by host beyond that.
    """
    rows = articles.withColumn("__host", host(F.col(url)))
    listed = exact.select(F.col(url).alias("__exact")).distinct()
    joined = rows.join(listed, F.col(url) == F.col("__exact"), "left")
    paths = path_patterns(rules).withColumnsRenamed({"domain": "__host", "pattern": "__path"})
    special = rules.where("kind <> 'path'").groupBy(F.col("domain").alias("__host")).agg(F.collect_list(F.struct("kind", "pattern")).alias("__special"))
    joined = joined.join(paths, "__host", "left").join(special, "__host", "left")
    by_rule = F.coalesce(F.exists("__special", lambda r: special_hit(F.col(url), r["kind"], r["pattern"])), F.lit(False))
    reason = F.when(F.col("__exact").isNotNull(), "exact_match").when(F.coalesce(F.regexp_like(F.col(url), F.col("__path")), F.lit(False)), "path_rule").when(by_rule, "special_rule")
    return joined.withColumn("reason", reason).drop("__host", "__exact", "__path", "__special")


def archive(old: DataFrame, discarded: DataFrame, deleted_at: Column) -> DataFrame:
    """The archive of discarded rows after another run: one row per URL, the older one wins."""
    both = old.withColumn("__age", F.lit(0)).unionByName(discarded.withColumn("deleted_at", deleted_at).withColumn("__age", F.lit(1)), allowMissingColumns=True)
    return first_per_key(both, ["url"], ["__age", "deleted_at"]).drop("__age")


def tiers(df: DataFrame, link: str, content: str, rules: dict[str, list[str]], dynamic: list[str], excluded: list[str]) -> DataFrame:
    """df with ``filtered_because``: the first tier that applies, or null."""
    url = F.col(link)
    reason = (
        F.when(has_any(url, rules["media"]), "media_sitemaps").when(has_any(url, rules["irrelevant"]), "irrelevant_sitemaps")
        .when(F.coalesce(F.col(content).rlike("(?i)<!doctype html"), F.lit(False)), "html contents").when(has_any(url, dynamic), "dynamic websites")
        .when(url.isin(excluded), "excluded_sitemaps").when(url.isNull(), "missing sitemap URL").when(F.col(content).isNull(), "missing sitemap content")
    )
    return df.withColumn("filtered_because", reason)
