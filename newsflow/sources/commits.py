"""Stores that several tables are appended to together, all or none, and once however often it is tried.

Under a root, ``data/<store>/<batch>-<attempt>`` holds what one attempt wrote and ``commits/<batch>`` is
a line of JSON that names the folders of the attempt that counts, and the columns. It is written under
another name and renamed when all tables are there. Readers read the folders that commits name, so
they never see an attempt that failed; a batch that has a commit is not written again. A compaction is
a batch too: it writes a store's rows anew and names the batches it replaces.

Batches are one line each; a driver reads as many lines as there were flushes.

Defined results: the first committed batch fixes a store's columns and types; later rows are cast to
them, casts that fail and missing columns give null, further columns are dropped; a table without rows
is committed with no rows; a store that no batch has is an error unless a schema is given.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE = "batch string, at long, stores map<string, struct<folder: string, columns: string>>, replaces array<string>"


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _name(batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][\w.=-]*", batch):
        raise ValueError(f"a batch's name has letters, digits and ._=- only: {batch!r}")
    return batch


def commits(spark: SparkSession, root: str) -> list:
    """The commits under a root in the order in which they were made; one row per batch."""
    fs, make = _fs(spark, root)
    if not fs.exists(make(f"{root}/commits")):
        return []
    return sorted(spark.read.schema(LINE).json(f"{root}/commits").collect(), key=lambda c: (c["at"], c.batch))


def committed(spark: SparkSession, root: str, batch: str) -> bool:
    fs, make = _fs(spark, root)
    return fs.exists(make(f"{root}/commits/{_name(batch)}.json"))


def columns_of(spark: SparkSession, root: str, store: str) -> T.StructType | None:
    """The columns that the first commit gave a store; None: no commit has it."""
    return next((T.StructType.fromJson(json.loads(c.stores[store].columns)) for c in commits(spark, root) if store in c.stores), None)


def _cast(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def commit(spark: SparkSession, tables: dict[str, DataFrame], root: str, batch: str, replaces: tuple[str, ...] = ()) -> bool:
    """Appends the tables to their stores as one batch; False, and nothing is computed, where the batch is committed already."""
    if committed(spark, root, batch):
        return False
    known = {name: T.StructType.fromJson(json.loads(s.columns)) for c in reversed(commits(spark, root)) for name, s in c.stores.items()}
    attempt, stores = f"{batch}-{uuid.uuid4().hex}", {}
    for name, df in tables.items():
        schema = known.get(name, df.schema)
        folder = f"data/{name}/{attempt}"
        _cast(df, schema).write.parquet(f"{root}/{folder}")
        stores[name] = {"folder": folder, "columns": schema.json()}
    fs, make = _fs(spark, root)
    at = max((c["at"] for c in commits(spark, root)), default=0) + 1
    line = json.dumps({"batch": batch, "at": at, "stores": stores, "replaces": list(replaces)})
    aside = make(f"{root}/.{attempt}")  # a name that readers skip
    out = fs.create(aside, False)
    out.write(bytearray(line.encode()))
    out.close()
    fs.mkdirs(make(f"{root}/commits"))
    final = make(f"{root}/commits/{_name(batch)}.json")
    if fs.exists(final) or not fs.rename(aside, final):  # another writer of this batch was first
        fs.delete(aside, False)
        return False
    return True


def _folders(found: list, store: str) -> list[str]:
    gone = {b for c in found for b in c.replaces if store in c.stores}
    return [c.stores[store].folder for c in found if store in c.stores and c.batch not in gone]


def read(spark: SparkSession, root: str, store: str, schema=None) -> DataFrame:
    """The rows of all committed batches of a store."""
    found, columns = commits(spark, root), columns_of(spark, root, store)
    if columns is None:
        if schema is None:
            raise ValueError(f"no committed batch has a store {store!r} under {root}")
        return spark.createDataFrame([], schema)
    return spark.read.schema(columns).parquet(*[f"{root}/{x}" for x in _folders(found, store)])


def compact(spark: SparkSession, root: str, store: str) -> bool:
    """One batch in place of all that a store has; False where it has one at most. Folders of replaced batches stay for readers that have begun; ``sweep`` removes them."""
    batches = [c.batch for c in commits(spark, root) if store in c.stores]
    if len(_folders(commits(spark, root), store)) < 2:
        return False
    return commit(spark, {store: read(spark, root, store)}, root, f"compact-{store}-{uuid.uuid4().hex}", tuple(batches))


def sweep(spark: SparkSession, root: str, store: str) -> int:
    """Removes a store's folders that no reader will open: attempts that failed and batches that were replaced. Not while a batch is being written."""
    fs, make = _fs(spark, root)
    if not fs.exists(make(f"{root}/data/{store}")):
        return 0
    live = {x.rsplit("/", 1)[-1] for x in _folders(commits(spark, root), store)}
    dead = [s.getPath() for s in fs.listStatus(make(f"{root}/data/{store}")) if s.getPath().getName() not in live]
    return sum(bool(fs.delete(p, True)) for p in dead)
