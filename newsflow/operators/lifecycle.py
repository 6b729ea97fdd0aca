"""What happens to the four status tables: priority de-duplication, flags, schema checks, purges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions.urls import trim_slash
from newsflow.operators.relational import union_fill

#: Which table keeps a URL that several hold: the first.
PRIORITY = ("final_data", "parse_error", "error", "retry")


def priority_dedup(tables: dict[str, DataFrame], order: str = "id") -> DataFrame:
    """All tables in one, column ``status``: each URL (without trailing slash) once, in the table of highest priority."""
    parts = [tables[name].withColumn("status", F.lit(name)).withColumn("__p", F.lit(p)) for p, name in enumerate(PRIORITY) if name in tables]
    every = union_fill(*parts).withColumn("url", trim_slash(F.col("url")))
    w = Window.partitionBy("url").orderBy("__p", order)
    return every.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__p")


def status_flags(links: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """links with processed, parse_error, error and retry by membership of their URL in the tables (G12): one join for all four."""
    names = {"final_data": "processed", "parse_error": "parse_error", "error": "error", "retry": "retry"}
    marked = [t.select("url").withColumn("status", F.lit(name)) for name, t in tables.items()]
    found = union_fill(*marked).groupBy("url").agg(*[F.max((F.col("status") == n).cast("int")).alias(f"__{f}") for n, f in names.items()])
    joined = links.drop(*names.values()).join(found, "url", "left")
    return joined.select("*", *[F.coalesce(F.col(f"__{f}") == 1, F.lit(False)).alias(f) for f in names.values()]).drop(*[f"__{f}" for f in names.values()])


def append_new(target: DataFrame, source: DataFrame, key: str = "url") -> DataFrame:
    """target and those rows of source whose key it lacks; keys that are null are never equal and stay."""
    return union_fill(target, source.join(target.select(key), key, "left_anti"))


def upsert(old: DataFrame, new: DataFrame, key: str, immutable: tuple[str, ...] = ()) -> DataFrame:
    """Rows by key: new values where they are not null, old ones else; immutable columns keep what was first set."""
    rest = [c for c in old.columns if c != key]
    a, b = old.alias("a"), new.alias("b")
    pick = [F.coalesce(*(F.col(f"{s}.{c}") for s in ("ab" if c in immutable else "ba"))).alias(c) for c in rest]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), *pick)


def purge_domain(df: DataFrame, domain: str, url_col: str = "url", domain_col: str = "domain") -> DataFrame:
    """df without rows of one domain, by domain or by URL; null is another domain."""
    hit = F.coalesce(F.col(domain_col) == domain, F.lit(False)) | F.coalesce(F.col(url_col).rlike(rf"^https?://(?:www\.)?{domain.replace('.', '[.]')}(?:[./]|$)"), F.lit(False))
    return df.where(~hit)


def schema_report(df: DataFrame, codebook: list[tuple[str, str, str | None]]) -> DataFrame:
    """Per codebook column: position and type as found, and values outside the ``;``-list of allowed ones. Reports, never raises."""
    spark = df.sparkSession
    found = {f.name: (i + 1, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)}
    checked = [(i + 1, name, kind, allowed) for i, (name, kind, allowed) in enumerate(codebook)]
    counts = df.agg(*[F.sum((F.col(n).isNotNull() & ~F.col(n).cast("string").isin([x.strip() for x in a.split(";")])).cast("long")).alias(n) for _, n, _, a in checked if a and n in found] or [F.lit(0).alias("__none")])
    rows = [(i, name, kind, found.get(name, (None, None))[1], found.get(name, (None,))[0] == i) for i, name, kind, _ in checked]
    report = spark.createDataFrame(rows, "position long, column_name string, expected_type string, found_type string, in_place boolean")
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in counts.columns]), F.array(*[F.col(c).cast("long") for c in counts.columns])))
    bad = counts.select(pairs.alias("column_name", "bad_values"))
    return report.join(bad, "column_name", "left").select("position", "column_name", "expected_type", "found_type", "in_place", F.coalesce("bad_values", F.lit(0).cast("long")).alias("bad_values"))
