"""Session settings shared by tests, the bench and scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that hold at any size; partition counts and memory belong to the cluster.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A local[cores] session with the shared settings; on a cluster use its own builder."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("newsflow")
    conf = CONF | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory} | more
    spark = builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
