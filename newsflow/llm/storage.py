"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir. Where it is unset: one of our own on a local master, an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsflow-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def new_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/newsflow-{what}-{uuid.uuid4().hex}"


#: Spark then drops the shuffle files of an action when it ends, not when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, free: bool = False) -> DataFrame:
    """df as a Parquet table: cuts the lineage, survives lost executors. zstd also shrinks packed numbers. free: the write's shuffle files go with it."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES)
    conf.set(FREE_SHUFFLES, str(free or before == "true").lower())
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, what: str, free: bool = False) -> DataFrame:
    return written(df, new_dir(df.sparkSession, what), free)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a written table, in whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
