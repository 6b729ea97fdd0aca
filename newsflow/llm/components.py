"""Connected components of a link table, without collecting links anywhere."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import storage

MOST_ROUNDS = 60


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of a link, the smallest node that links reach.

    Alternates two rewritings of the links (large star, small star) until every node points at its
    root. Each is a grouped minimum and a join; a hub's links are pre-aggregated before the shuffle
    and never listed in one row. Every round is a written table, so lineage stays short.
    """
    spark = links.sparkSession
    links = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, path, before = None, None, None
    for _ in range(MOST_ROUNDS):
        source = links if current is None else current
        both = source.unionByName(source.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.col("m").alias("v")))).alias("l")).select("l.u", "l.v").where("u > v").distinct()
        old, path = path, storage.new_dir(spark, "links")
        current = storage.written(small, path)
        now = current.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first()
        if old:
            storage.remove(spark, old)
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 of a small graph, the smallest node that links reach."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = new[new]
        if (new == label).all():
            break
        label = new
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    while True:
        new = label[label]
        if (new == label).all():
            return label
        label = new
