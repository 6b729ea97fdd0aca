"""Finding the sitemaps of domains in a table of fetched responses (url, status, body)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions.urls import robots_sitemaps
from newsflow.operators.relational import union_fill

#: Where robots.txt is looked for, the first that answers wins.
PROTOCOLS = ("http://", "https://", "https://www.")


def robots(domains: DataFrame, responses: DataFrame) -> DataFrame:
    """domain_url, robots_txt, robots_txt_content: per domain the candidate of highest priority that answered 200."""
    tried = domains.select("domain_url", F.posexplode(F.array(*[F.concat(F.lit(p), "domain_url", F.lit("/robots.txt")) for p in PROTOCOLS])).alias("p", "url"))
    hits = tried.join(responses.where("status = 200").select("url", "body"), "url")
    best = hits.groupBy("domain_url").agg(F.min_by(F.struct("url", "body"), "p").alias("b"))
    return domains.select("domain_url").join(best, "domain_url", "left").select("domain_url", F.col("b.url").alias("robots_txt"), F.col("b.body").alias("robots_txt_content"))


def declared(found: DataFrame) -> DataFrame:
    """A row per sitemap that a robots.txt names; domains without one keep a row with null."""
    listed = found.withColumn("s", robots_sitemaps(F.col("robots_txt_content")))
    n = F.coalesce(F.size("s"), F.lit(0))
    check = F.when(n <= 0, "no sitemap").when(n == 1, "one sitemap").otherwise("multiple sitemaps")
    return listed.select("domain_url", check.alias("sitemap_check"), F.explode_outer("s").alias("sitemap_URL"))


def typical(domains: DataFrame, responses: DataFrame, paths: DataFrame) -> DataFrame:
    """domain_url, typical_URL for every usual path that answered 200. paths: a short table of paths (path), the caller's; Spark sends it to the domains if its size allows that."""
    tried = domains.crossJoin(paths.select("path")).select("domain_url", F.concat(F.lit("https://"), "domain_url", "path").alias("url"))
    return tried.join(responses.where("status = 200").select("url").distinct(), "url", "left_semi").select("domain_url", F.col("url").alias("typical_URL"))


def merge(named: DataFrame, guessed: DataFrame) -> DataFrame:
    """Declared sitemaps, and the usual ones of domains that declare none."""
    missing = named.where("sitemap_URL is null").select("domain_url").distinct()
    extra = missing.join(guessed, "domain_url").select("domain_url", F.lit("found typical sitemap").alias("sitemap_check"), F.col("typical_URL").alias("sitemap_URL"))
    kept = named.join(extra.select("domain_url").distinct(), "domain_url", "left_anti")
    return kept.unionByName(extra)


def step_summary(steps: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per step its rows and how many have a value in the step's result column."""
    return union_fill(*[df.agg(F.count(F.lit(1)).alias("total"), F.count(c).alias("successful")).withColumn("step", F.lit(name)) for name, (df, c) in steps.items()])
