"""A data source of pages as files, one file per page, named by the page.

``df.write.format("page_files")`` writes the columns name and html; reading gives them back, line breaks
and all. Files are ``<name>.html`` with signs of the name that paths don't take escaped. A task writes a
page under another name and renames it, so a file is whole or not there, and a task that runs again
writes the same files. Paths are those of PyArrow's file systems (local, or a URI such as hdfs:// or s3://).

Defined results: a null page is an empty file and reads as the empty text; a page without a name, or
two pages of one name in one write, are errors (``unique_names`` makes names that differ); overwriting
removes the pages that were there when all new ones are written; an empty folder has no rows.
"""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "name string, html string"
SUFFIX = ".html"
#: Files that one task reads, and pages of a batch.
FILES, BATCH = 500, 50


def _where(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _listed(path: str) -> list[str]:
    store, root = _where(path)
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.endswith(SUFFIX))


class _Written(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


class _Some(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class PageFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "page_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], overwrite)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[_Some]:
        files = _listed(self.path)  # a listing, as for any table of files
        return [_Some(files[i : i + FILES]) for i in range(0, len(files), FILES)] or [_Some([])]

    def read(self, partition: _Some):
        store, _ = _where(self.path)
        for i in range(0, len(partition.files), BATCH):
            some = partition.files[i : i + BATCH]
            texts = []
            for f in some:
                with store.open_input_stream(f) as file:
                    texts.append(file.read().decode("utf-8", "replace"))
            names = [unquote(posixpath.basename(f).removesuffix(SUFFIX)) for f in some]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["name", "html"])


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, rows) -> _Written:
        store, root = _where(self.path)
        store.create_dir(root)
        files = []
        for row in rows:
            if not row["name"]:
                raise ValueError("a page has no name")
            file = posixpath.join(root, quote(row["name"], safe="") + SUFFIX)
            aside = posixpath.join(root, f".{uuid.uuid4().hex}")
            with store.open_output_stream(aside) as out:
                out.write((row["html"] or "").encode())
            store.move(aside, file)
            files.append(posixpath.basename(file))
        return _Written(files)

    def commit(self, messages) -> None:
        written = [f for m in messages if m is not None for f in m.files]
        if len(written) != len(kept := set(written)):
            raise ValueError("two pages have the same name")
        if self.overwrite:
            store, _ = _where(self.path)
            for file in _listed(self.path):
                if posixpath.basename(file) not in kept:
                    store.delete_file(file)

    def abort(self, messages) -> None:
        """Files of a failed write stay: each is whole, and the next try writes them again."""


def unique_names(pages: DataFrame, name: str, order: list[str]) -> DataFrame:
    """pages with names that differ: the second page of a name gets -2, and so on, unless that is a page's name as well."""
    place = F.row_number().over(Window.partitionBy(name).orderBy(*order))
    taken = pages.select(F.col(name).alias("__taken")).distinct()
    numbered = pages.withColumn("__n", place).withColumn("__new", F.when(F.col("__n") > 1, F.concat(F.col(name), F.lit("-"), "__n")).otherwise(F.col(name)))
    both = numbered.join(taken, (F.col("__new") == F.col("__taken")) & (F.col("__n") > 1), "left")
    return both.withColumn(name, F.when(F.col("__taken").isNotNull(), F.concat("__new", F.lit("~"))).otherwise(F.col("__new"))).drop("__n", "__new", "__taken")


def export(pages: DataFrame, path: str, name: str = "name", html: str = "html", mode: str = "overwrite") -> None:
    """One file per page."""
    spark = pages.sparkSession
    spark.dataSource.register(PageFiles)
    pages.select(F.col(name).cast("string").alias("name"), F.col(html).alias("html")).write.format("page_files").mode(mode).save(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """name and html of the pages of a folder (A3)."""
    spark.dataSource.register(PageFiles)
    return spark.read.format("page_files").load(path)
