"""Stores laid out by URL: what a run asks of them needs no shuffle of what they hold.

A store is a Parquet table in buckets of its URL, without trailing slashes, sorted inside each. Stores
with equal numbers of buckets join, anti-join and de-duplicate bucket by bucket; the rows of a new
run, which are few, are the only ones that are shuffled. Spark knows the layout by the table's entry in
its catalog: ``lay_out`` makes it, ``attach`` makes it again for files that are there, as in a new session.

Defined results: rows without a URL are one key, as in ``lifecycle.priority_dedup``, and have no flags;
of several rows of one URL in a store the first by ``order`` stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions.urls import trim_slash
from newsflow.operators.lifecycle import PRIORITY, priority_dedup
from newsflow.operators.relational import first_per_key, union_fill

KEY = "url"
#: The flag of a link that each store sets.
FLAGS = {"final_data": "processed", "parse_error": "parse_error", "error": "error", "retry": "retry"}


def lay_out(df: DataFrame, name: str, path: str, buckets: int, key: str = KEY) -> DataFrame:
    """Writes df in buckets of its URL, one file each, and enters it in the catalog. Choose buckets so that one is some hundred MB."""
    rows = df.withColumn(key, trim_slash(F.col(key))).repartition(buckets, key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, schema, buckets: int, key: str = KEY) -> DataFrame:
    """Enters files that ``lay_out`` has written into the catalog of this session. ``schema``: its columns as DDL."""
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def priority(stores: dict[str, DataFrame], order: str = "id") -> DataFrame:
    """All stores in one, column ``status``: each URL once, in the store of highest priority (G11, I3). Every store is anti-joined with those before it."""
    parts, before = [], []
    for name in (n for n in PRIORITY if n in stores):
        store = stores[name].where(F.col(KEY).isNotNull())
        rows = first_per_key(store, [KEY], [order])
        for other in before:
            rows = rows.join(other.select(KEY), KEY, "left_anti")
        before.append(store)
        parts.append(rows.withColumn("status", F.lit(name)))
    nameless = priority_dedup({n: s.where(F.col(KEY).isNull()) for n, s in stores.items()}, order)
    return union_fill(*parts, nameless)


def flags(links: DataFrame, stores: dict[str, DataFrame]) -> DataFrame:
    """links with processed, parse_error, error and retry by membership of their URL in the stores (G12, D8); links that are laid out themselves are not shuffled either."""
    out = links.drop(*FLAGS.values())
    for name, flag in FLAGS.items():
        if name in stores:
            found = stores[name].where(F.col(KEY).isNotNull()).select(KEY).distinct().withColumn(flag, F.lit(True))
            out = out.join(found, KEY, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
        else:
            out = out.withColumn(flag, F.lit(False))
    return out


def unseen(run: DataFrame, stores: list[DataFrame]) -> DataFrame:
    """Rows of a run whose URL no store has (D6, D7, D14); rows without a URL stay."""
    rows = run.withColumn(KEY, trim_slash(F.col(KEY)))
    for store in stores:
        rows = rows.join(store.select(KEY), KEY, "left_anti")
    return rows
