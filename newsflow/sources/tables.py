"""Readers and writers of the engine's tables."""

from __future__ import annotations

import json
import tempfile
import uuid
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from newsflow.operators.relational import aligned, first_per_key


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV with header and a declared schema; nothing is inferred."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep)


def read_many(spark: SparkSession, glob: str) -> DataFrame:
    """Parquet files of a glob with ``source_file``, the name each row comes from."""
    return spark.read.parquet(glob).withColumn("source_file", F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def gunzip(payload: Column) -> Column:
    """Text of a gzip payload; what is no gzip is read as it is."""

    @pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        def one(raw):
            if raw is None:
                return None
            try:
                return zlib.decompress(bytes(raw), 31).decode("utf-8", "replace")
            except zlib.error:
                return bytes(raw).decode("utf-8", "replace")

        return values.map(one)

    return run(payload)


def append_aligned(df: DataFrame, path: str) -> None:
    """Append to a Parquet table in its own columns and types: casts that fail and missing columns give null."""
    aligned(df, df.sparkSession.read.parquet(path)).write.mode("append").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table at path; an empty one is written if there is none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.parquet(path)


#: The folder column of tables by domain.
PART = "store_part"
#: Rows of a file of such a table.
FILE_ROWS = 1_000_000


def part_of(domain: Column) -> Column:
    """Name of a domain's folder: never null, empty or like a number, so that it reads back as it is."""
    return F.coalesce(F.concat(F.lit("d_"), domain.cast("string")), F.lit("null"))


def _file_system(spark: SparkSession, path: str):
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _folder_of(spark: SparkSession, name: str) -> str:
    """Name of the folder of a value of PART, as Spark escapes it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(PART, name)


def _write_parts(df: DataFrame, path: str, domain: str, key: str | None) -> None:
    """One folder per domain. Ranges of (domain, key), not domains, are dealt to tasks, so a large domain becomes several tasks and files; files are sorted by key and have a filter of its values, by which readers skip them."""
    plain = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    order = [PART, *([key] if key else [c for c in plain if c != domain])]
    rows = df.withColumn(PART, part_of(F.col(domain))).repartitionByRange(*order).sortWithinPartitions(*order)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS)
    (writer.option(f"parquet.bloom.filter.enabled#{key}", "true") if key else writer).partitionBy(PART).parquet(path)


def _keep_columns(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """The table's columns in a file that readers of its rows skip."""
    fs, make = _file_system(spark, path)
    out = fs.create(make(f"{path}/_columns"), True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def _columns(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns of a table by domain; None: there is no table."""
    fs, make = _file_system(spark, path)
    if not fs.exists(make(f"{path}/_columns")):
        return None
    file = fs.open(make(f"{path}/_columns"))
    try:
        return T.StructType.fromJson(json.loads(bytes(file.readAllBytes()).decode()))
    finally:
        file.close()


def write_by_domain(df: DataFrame, path: str, domain: str = "domain", key: str | None = None) -> None:
    """One folder per domain; only the folders of domains that df holds are replaced. The domain stays a column, with its type."""
    _write_parts(df, path, domain, key)
    _keep_columns(df.sparkSession, path, df.schema)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table by domain with the folder each lies in."""
    schema = _columns(spark, path)
    if schema is None:
        raise ValueError(f"no table by domain at {path}")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    fs, make = _file_system(spark, path)
    if not fs.globStatus(make(f"{path}/{PART}=*")):
        return spark.createDataFrame([], schema).withColumn(PART, F.lit(""))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(path)


def read_by_domain(spark: SparkSession, path: str, domains: list | None = None) -> DataFrame:
    """A table by domain, or the folders of some domains only (None among them: the null domain). A merge that was cut off is finished first."""
    finish_merge(spark, path)
    rows = _parts(spark, path)
    if domains is not None:
        rows = rows.where(F.col(PART).isin(["null" if x is None else f"d_{x}" for x in domains]))
    return rows.drop(PART)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; quotes are doubled, so that any text reads back."""
    df.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def write_pages(df: DataFrame, path: str, html: str = "html", name: str = "name") -> None:
    """Samples of pages as text files, a folder per name."""
    df.select(F.col(html).alias("value"), name).write.mode("overwrite").option("lineSep", "\n").partitionBy(name).text(path)


def domain_of_file(df: DataFrame, domain: str = "domain", source_file: str = "source_file") -> DataFrame:
    """domain from the name of the file (name_<domain>.ext) where the column is missing or null."""
    named = F.nullif(F.regexp_extract(F.col(source_file), r"_([^_/]+?)\.[A-Za-z]+$", 1), F.lit(""))
    return df.withColumn(domain, F.coalesce(F.col(domain), named) if domain in df.columns else named)


def transpose(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """A small table turned: one row per former column, one column per key (A4); ``names`` are the keys."""
    cells = df.unpivot(key, [c for c in df.columns if c != key], "name", "value")
    return cells.groupBy("name").pivot(key, names).agg(F.first("value"))


def _merge_folder(path: str) -> str:
    return f"{path.rstrip('/')}.merge"


def merge_by_domain(spark: SparkSession, new: DataFrame, path: str, done: DataFrame, key: str = "url", domain: str = "domain") -> None:
    """A table by domain with new rows merged in (B5, B6): inside a domain one row per key, the older one; keys of ``done`` go; a domain without rows has no folder.

    ``done`` has the key, and the domain if its keys are those of one domain only. Folders of domains
    that neither ``new`` nor ``done`` touches are not read (but for their keys, where ``done`` has no
    domain) and keep their files. What the touched folders shall hold is written beside the table first;
    a merge that is cut off after that is finished by the next reader or merge, one that is cut off before
    leaves the table as it was. One writer at a time. Null is a domain and a key of its own. The table
    keeps its columns and types and gains those that are new.
    """
    finish_merge(spark, path)
    held = _columns(spark, path)
    columns = [*(held.fields if held else []), *[f for f in new.schema.fields if held is None or f.name not in held.names]]
    fit = lambda df: df.select(PART, *[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in columns])
    keyed = fit(new.withColumn(PART, part_of(F.col(domain))))
    by = [PART, key] if domain in done.columns else [key]
    gone = (done.withColumn(PART, part_of(F.col(domain))) if domain in done.columns else done).select(*by).distinct().alias("g")
    every, touched = keyed.withColumn("__age", F.lit(1)), keyed.select(PART)
    if held:
        old = _parts(spark, path)
        hit = gone.select(PART) if domain in done.columns else old.select(PART, key).alias("k").join(gone, F.col(f"k.{key}").eqNullSafe(F.col(f"g.{key}")), "left_semi").select(PART)
        touched = materialize(touched.union(hit).distinct(), "touched")
        every = fit(old).join(touched, PART, "left_semi").withColumn("__age", F.lit(0)).unionByName(every)
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"g.{c}")) for c in by]
    first = first_per_key(every, [PART, key], ["__age", *[f.name for f in columns if f.name != key and not f.dataType.simpleString().startswith(("map", "variant"))]]).drop("__age")
    kept = materialize(first.alias("k").join(gone, same, "left_anti"), "kept")
    aside = _merge_folder(path)
    fs, make = _file_system(spark, path)
    fs.delete(make(aside), True)
    _write_parts(kept.select(*[f.name for f in columns]), f"{aside}/rows", domain, key)
    emptied = touched.distinct().join(kept.select(PART).distinct(), PART, "left_anti")
    emptied.coalesce(1).write.parquet(f"{aside}/emptied")
    _keep_columns(spark, f"{aside}/rows", T.StructType(columns))
    fs.create(make(f"{aside}/ready"), True).close()
    finish_merge(spark, path)


def finish_merge(spark: SparkSession, path: str) -> bool:
    """Takes over the folders that a merge has made ready, and removes those it has emptied; every step can be repeated. False: there was nothing to finish."""
    aside = _merge_folder(path)
    fs, make = _file_system(spark, path)
    if not fs.exists(make(f"{aside}/ready")):
        return False
    fs.mkdirs(make(path))
    # folders that a cut-off call has moved are not here any more; names only, as in any listing
    for status in fs.listStatus(make(f"{aside}/rows")):
        name = status.getPath().getName()
        if name.startswith(f"{PART}=") or name == "_columns":
            target = make(make(path), name)
            fs.delete(target, True)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"{name} could not be moved into {path}")
    for row in spark.read.schema(f"{PART} string").parquet(f"{aside}/emptied").toLocalIterator():
        fs.delete(make(make(path), _folder_of(spark, row[0])), True)
    fs.delete(make(f"{aside}/ready"), False)
    fs.delete(make(aside), True)
    return True


def next_chunk(names: Column) -> Column:
    """Aggregate: the next free name chunk_NNN."""
    number = F.regexp_extract(names, r"^chunk_(\d+)$", 1).try_cast("int")
    return F.concat(F.lit("chunk_"), F.lpad((F.coalesce(F.max(number), F.lit(0)) + 1).cast("string"), 3, "0"))


def new_path(spark: SparkSession, what: str) -> str:
    """A new name in the folder of spark.checkpoint.dir; where that is unset, in one of our own on a local master and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="newsflow-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder}/newsflow-{what}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, what: str) -> DataFrame:
    """df as a written table in the folder of spark.checkpoint.dir: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
