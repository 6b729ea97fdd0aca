"""Editing extraction rules on stored pages: rule versions, upserts, re-parsing, promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.functions.urls import host
from newsflow.operators.extract import extract, paywall_decision
from newsflow.operators.lifecycle import priority_dedup, status_flags

RULE_TABLE = "version string, domain string, field string, priority int, kind string, selectors array<string>, attributes array<string>"


def sandbox(rules: DataFrame) -> DataFrame:
    """Production rules and a copy of them under version local."""
    prod = rules.where("version = 'prod'")
    return prod.unionByName(prod.withColumn("version", F.lit("local")))


def edit(rules: DataFrame, changes: DataFrame) -> DataFrame:
    """rules with local rules replaced per (domain, field) by the changes; bot rules (field ``bot``) hold for every domain and are replaced as a whole."""
    changes = changes.withColumn("domain", F.when(F.col("field") == "bot", "*").otherwise(F.col("domain")))
    keys = changes.select("domain", "field").distinct().withColumn("version", F.lit("local"))
    return rules.join(keys, ["version", "domain", "field"], "left_anti").unionByName(changes.withColumn("version", F.lit("local")))


def apply(rules: DataFrame, domain: str) -> DataFrame:
    """Local rules of a domain become its production rules; the rest stays."""
    kept = rules.where(~((F.col("version") == "prod") & (F.col("domain") == domain)))
    return kept.unionByName(rules.where((F.col("version") == "local") & (F.col("domain") == domain)).withColumn("version", F.lit("prod")))


def reset(rules: DataFrame, domain: str) -> DataFrame:
    """Production rules of a domain become its local rules."""
    kept = rules.where(~((F.col("version") == "local") & (F.col("domain") == domain)))
    return kept.unionByName(rules.where((F.col("version") == "prod") & (F.col("domain") == domain)).withColumn("version", F.lit("local")))


def reparse(pages: DataFrame, rules: DataFrame, version: str = "local") -> DataFrame:
    """Stored pages parsed again by the rules of a version. Local parses know no unknown paywall: it is false there."""
    own = [(r.domain, r.field, r.priority, r.kind, list(r.selectors), list(r.attributes)) for r in rules.where(F.col("version") == version).toLocalIterator()]
    found = extract(pages, rules=own or None)
    known = F.lit(True) if version == "local" else F.lit(None).cast("boolean")
    return found.withColumn("paywall", paywall_decision(F.lit(None).cast("boolean"), known, F.coalesce("x.paywall_marker", F.lit(False))))


def fingerprints(rules: DataFrame, version: str = "local") -> DataFrame:
    """domain and fingerprint of the rules in force for it, its own and those for all; ``*`` has that of domains without rules of their own."""
    mine = rules.where(F.col("version") == version).select("domain", F.sha2(F.to_json(F.struct("domain", "field", "priority", "kind", "selectors", "attributes")), 256).alias("h"))
    # the rules of one domain, some dozens
    each = mine.groupBy("domain").agg(F.concat_ws(",", F.sort_array(F.collect_list("h"))).alias("own"))
    common = each.where("domain = '*'").agg(F.coalesce(F.max("own"), F.lit("")).alias("common"))  # one row
    named = each.where("domain <> '*'").unionByName(rules.sparkSession.createDataFrame([("*", "")], "domain string, own string"))
    return named.crossJoin(F.broadcast(common)).select("domain", F.sha2(F.concat("own", F.lit("|"), "common"), 256).alias("rules_fingerprint"))


def _in_force(pages: DataFrame, rules: DataFrame, version: str, url: str) -> DataFrame:
    """pages with the fingerprint of the rules that hold for each."""
    told = fingerprints(rules, version)
    common = told.where("domain = '*'").select(F.col("rules_fingerprint").alias("__common"))  # one row
    own = told.where("domain <> '*'").select(F.col("domain").alias("__domain"), F.col("rules_fingerprint").alias("__own"))
    found = pages.withColumn("__domain", host(F.col(url))).join(own, "__domain", "left").crossJoin(F.broadcast(common))
    return found.withColumn("rules_fingerprint", F.coalesce("__own", "__common")).drop("__domain", "__own", "__common")


def changed(pages: DataFrame, rules: DataFrame, parsed: DataFrame, key: str = "url", version: str = "local", url: str = "url") -> DataFrame:
    """The pages that ``parsed`` lacks or has by other rules than those in force; pages whose key is null are always among them."""
    return _in_force(pages, rules, version, url).join(parsed.select(key, "rules_fingerprint"), [key, "rules_fingerprint"], "left_anti")


def reparse_changed(pages: DataFrame, rules: DataFrame, parsed: DataFrame | None = None, key: str = "url", version: str = "local", url: str = "url") -> DataFrame:
    """What ``reparse`` gives for all pages, with the fingerprint of the rules beside each; only pages whose rules have changed since ``parsed`` (an earlier result) are parsed (J3, J6). A page is one that has a key of its own and does not change under it."""
    if parsed is None:
        return reparse(_in_force(pages, rules, version, url), rules, version)
    kept = parsed.join(_in_force(pages, rules, version, url).select(key, "rules_fingerprint"), [key, "rules_fingerprint"], "left_semi")
    return kept.unionByName(reparse(changed(pages, rules, parsed, key, version, url), rules, version))


def load(parse_error: DataFrame, domain: str) -> DataFrame:
    """The parse errors of a domain."""
    return parse_error.where(F.col("domain") == domain)


def show(rules: DataFrame, domain: str, version: str = "local") -> DataFrame:
    """The rules that a version has for a domain, with those for all, in the order in which they are tried."""
    return rules.where((F.col("version") == version) & F.col("domain").isin(domain, "*")).orderBy(F.col("domain") == "*", "field", "priority")


def promote(final: DataFrame, parse_error: DataFrame, parsed: DataFrame) -> dict[str, DataFrame]:
    """Re-parsed rows with a date and a text join final_data and leave parse_error; failures stay."""
    given = [c for c in ("id", "domain", "url", "timestamp_scraped") if c in parsed.columns]
    good = parsed.where("x.date_time is not null and nullif(trim(x.text), '') is not null").select(*given, "x.date_time", "x.author", "x.headline", "x.text", "paywall")
    every = priority_dedup({"final_data": final.unionByName(good, allowMissingColumns=True), "parse_error": parse_error})
    return {s: every.where(F.col("status") == s).drop("status") for s in ("final_data", "parse_error")}


def fill_results(links: DataFrame, stores: dict[str, DataFrame], parsed: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """The stores after promotion and the links with flags by them."""
    after = stores | promote(stores["final_data"], stores["parse_error"], parsed)
    return after, status_flags(links, after)
