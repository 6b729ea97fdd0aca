"""Sitemaps read as streams: links come out while a document is parsed, never all of it at once.

A task holds one document's text, as the table has it, and BATCH links. Documents that break off, or are
broken somewhere, give what came before. Names are taken without their prefixes, declared or not.
"""

from __future__ import annotations

from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import iso_date

#: Bytes that a parser gets at a time, and links of a batch.
CHUNK, BATCH = 1 << 16, 10_000
#: What holds one entry of a sitemap, and the parts of an entry that are read.
ENTRIES, PARTS = ("url", "sitemap"), ("loc", "lastmod", "publication_date")
FOUND = T.StructType([T.StructField("kind", T.StringType()), T.StructField("place", T.LongType()), *(T.StructField(p, T.StringType()) for p in PARTS)])


class _Entries:
    """Collects the entries of one document as its elements end."""

    def __init__(self):
        self.ready: list[tuple] = []
        self.count = 0
        self.entry: dict[str, str] | None = None
        self.part: list[str] | None = None
        self.parser = expat.ParserCreate("utf-8")  # the text is decoded, whatever its declaration says
        self.parser.buffer_text = True
        self.parser.StartElementHandler, self.parser.EndElementHandler, self.parser.CharacterDataHandler = self.start, self.end, self.text

    def start(self, name: str, _) -> None:
        name = name.rpartition(":")[2].lower()
        if name in ENTRIES:
            self.entry = {}
        elif name in PARTS and self.entry is not None and name not in self.entry:
            self.part = []

    def text(self, data: str) -> None:
        if self.part is not None:
            self.part.append(data)

    def end(self, name: str) -> None:
        name = name.rpartition(":")[2].lower()
        if name in PARTS and self.part is not None:
            self.entry[name], self.part = "".join(self.part).strip(), None
        elif name in ENTRIES and self.entry is not None:
            self.count += 1
            self.ready.append((name, self.count, *(self.entry.get(p) or None for p in PARTS)))
            self.entry = None


def entries(raw: memoryview | bytes):
    """Lists of at most about BATCH entries (kind, place, loc, lastmod, publication_date) of a document in UTF-8."""
    found, view = _Entries(), memoryview(raw)
    at = 3 if bytes(view[:3]) == b"\xef\xbb\xbf" else 0
    while at < len(view) and view[at] in b" \t\r\n":
        at += 1
    try:
        for start in range(at, len(view), CHUNK):
            found.parser.Parse(bytes(view[start : start + CHUNK]), False)
            if len(found.ready) >= BATCH:
                yield found.ready
                found.ready = []
        found.parser.Parse(b"", True)
    except expat.ExpatError:
        pass  # what came before the fault counts
    if found.ready:
        yield found.ready


def _read(batches, body: str, names: list[str]):
    for batch in batches:
        at = batch.schema.get_field_index(body)
        rest = batch.remove_column(at)
        for i, text in enumerate(batch.column(at)):
            for found in entries(text.as_buffer()) if text.is_valid else ():
                kept = rest.take(pa.array([i] * len(found), pa.int64()))
                columns = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=names)


def read_entries(sitemaps: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of each sitemap (K3, K5, M3): its other columns, kind (url or sitemap), place (from 1), loc, lastmod and publication_date as they stand. Null and empty documents have none."""
    rest = [f for f in sitemaps.schema.fields if f.name != body]
    names = [f.name for f in rest] + FOUND.names
    return sitemaps.mapInArrow(lambda batches: _read(batches, body, names), T.StructType([*rest, *FOUND.fields]))


def read_links(sitemaps: DataFrame, body: str = "body") -> DataFrame:
    """The http(s) links of urlsets with their dates, as ``sitemaps.links`` gives them, a row each."""
    found = read_entries(sitemaps, body).where((F.col("kind") == "url") & F.col("loc").rlike("^https?://"))
    dated = found.withColumns({"lastmod_date": iso_date(F.col("lastmod")), "pub_date": iso_date(F.col("publication_date"))})
    return dated.withColumn("date", F.coalesce("pub_date", "lastmod_date")).withColumnRenamed("loc", "result_link").drop("kind", "lastmod", "publication_date")
