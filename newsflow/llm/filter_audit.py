"""Operator 13, filter interaction audit: partition-refinement duplicates, then counts by mask.

Five filters fail a text: A, too few words; B, too few distinct words; C, too many capitals; D, a sign
of ``SIGNS``; E, the text of a smaller id. One scan gives each row a mask of A to D, its length in code
points and a hash of each block of its text; blocks end at 256, 4,096, 65,536, ... code points.

E by partition refinement: rows of one length are a class, and classes are split by the hash of one
block after another. Classes of one row are dropped before the next split, so most rows are gone after
the first; rounds are the logarithm of the longest text. Full texts of what survives are compared with
the text of the class's least id; texts that only share all hashes are then grouped by themselves. A row
is marked if an equal text has a smaller id. Class sizes and least ids are pre-aggregated, and classes
are joined back as sort-merge joins, which adaptive execution splits for classes that are large.

Counting: rows become counts by (part, mask), pre-aggregated, a marked row as one more of the mask with
E and one less of the mask without. Every order of the filters and each of its steps is answered from
the at most 32 counts of a part.

Defined results: null texts count as empty; a null part is the empty string; rows of a null id neither
fail E nor make others fail it; rows that repeat an id are separate rows, told apart by a 64-bit hash
of the text, and a row is no copy of one with its own id; of labels that repeat an id, one that says 1
is enough, null labels say nothing; other columns are ignored, whatever their names; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm import storage
from newsflow.llm.textbytes import pieces, release

FILTERS = "ABCDE"
#: A, B and C: words; per cent of distinct words; per cent of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 2, b"#$%&*|"
CAPITALS = bytes(range(65, 91))
#: Code points of the first block; each later end is GROWTH times the one before.
FIRST_BLOCK, GROWTH = 256, 16
#: Bytes above which a text's words are walked one by one in place of a list of all.
LONG_BYTES = 4_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
COPY = 1 << FILTERS.index("E")


def _words(raw: bytes) -> tuple[int, int]:
    """Words and distinct words."""
    if len(raw) <= LONG_BYTES:
        words = raw.split()  # at the same six characters, for bytes
        return len(words), len(set(words))
    n, seen = 0, set()
    for found in _WORD.finditer(raw):
        n += 1
        seen.add(found[0])
    return n, len(seen)


def _mask(raw: bytes, points: int) -> int:
    words, distinct = _words(raw)
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    failed = (words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, len(raw) != len(raw.translate(None, SIGNS)))
    return sum(bad << i for i, bad in enumerate(failed))


def _blocks(text: str) -> list[int]:
    """A hash of each block."""
    out, start, end = [], 0, FIRST_BLOCK
    while start < len(text):
        out.append(xxhash.xxh3_64_intdigest(text[start:end].encode()) - (1 << 63))
        start, end = end, end * GROWTH
    return out


def _features(batches):
    try:
        for whole in batches:
            for batch in pieces(pa.Table.from_batches([whole]).combine_chunks().to_batches(), "__text"):
                raws = batch.column("__text").fill_null("").cast(pa.binary()).to_pylist()
                texts = [raw.decode("utf-8", "replace") for raw in raws]
                found = [pa.array([len(t) for t in texts], pa.int64()), pa.array([_mask(r, len(t)) for r, t in zip(raws, texts, strict=True)], pa.int32()), pa.array(list(map(_blocks, texts)), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__tie"), batch.column("__part"), *found], names=["id", "tie", "part", "points", "mask", "blocks"])
    finally:
        release()


def features(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, tie (hash of the text), part, points, mask of A to D, blocks, of every row."""
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__tie"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("__part"), F.col(text_col).alias("__text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(_features, f"id {kind}, tie long, part string, points long, mask int, blocks array<long>")


def refine(rows: DataFrame) -> DataFrame:
    """id, tie, mask, key of the distinct rows whose length and block hashes all recur; ``key`` names the class. ``rows`` is a written table as ``features`` makes it."""
    most = rows.agg(F.coalesce(F.max(F.size("blocks")), F.lit(0))).first()[0]
    alive = rows.where(F.col("id").isNotNull()).select("id", "tie", "mask", "blocks", F.xxhash64("points").alias("key")).distinct()
    for at in range(most + 1):
        if at:  # a text without this block stays in its class
            alive = alive.withColumn("key", F.when(F.size("blocks") >= at, F.xxhash64("key", F.get("blocks", F.lit(at - 1)))).otherwise(F.col("key")))
        several = alive.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        alive = storage.materialize(alive.join(several, "key", "left_semi"), "refined")
    return alive.drop("blocks")


def copies(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, mask of every row of ``docs`` whose text a smaller id has."""
    found = refine(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")).withColumn("tie", F.xxhash64("text"))
    # one plan at every size: the rows that survive are never broadcast
    members = storage.materialize(texts.join(found.hint("merge"), ["id", "tie"]).drop("tie"), "members")
    leaders = members.groupBy("key").agg(F.min_by(F.struct("id", "text"), "id").alias("least"))
    same = F.col("text") == F.col("least.text")
    compared = storage.materialize(members.join(leaders, "key").select("id", "part", "mask", "key", F.col("least.id").alias("least"), F.when(~same, F.col("text")).alias("other")), "compared")
    # texts that share length and hashes with their class's first but are not it
    others = compared.where(F.col("other").isNotNull()).drop("least")
    firsts = others.groupBy("key", "other").agg(F.min("id").alias("least"))
    marked = compared.where(F.col("other").isNull()).drop("other", "key").unionByName(others.join(firsts, ["key", "other"]).drop("other", "key"))
    return marked.where(F.col("id") > F.col("least")).drop("least")


def _orders() -> Column:
    """The 120 orders with their five steps, as one array of constants."""
    rows = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            rows.append(F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step"), F.lit(bit).alias("bit"), F.lit(before).alias("before")))
            before |= bit
    return F.array(*rows)


def _report(cells: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic -> a row per part, order and step."""
    held = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    steps = held.select("part", "cells", F.explode(_orders()).alias("o")).select("part", "cells", "o.*")

    def total(name: str, holds) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(holds(c["mask"]), c[name]).otherwise(F.lit(0)))

    bit, before = F.col("bit"), F.col("before")
    first = lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)
    # of the 120 orders, each filter that a row fails comes first among these equally often
    share = F.aggregate("cells", F.lit(0).cast("long"), lambda s, c: s + F.when(c["mask"].bitwiseAND(bit) != 0, c["n"] * (F.lit(120) / F.bit_count(c["mask"])).cast("long")).otherwise(F.lit(0)))
    return steps.select(
        "part", "filter_order", "step", total("n", lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"), total("n", first).alias("removed"),
        total("n", lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0)).alias("redundant"), total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", first).alias("good_lost"), total("toxic", first).alias("toxic_lost"), share.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. ``labels``: the id, quality, toxic."""
    rows = storage.materialize(features(docs, id_col, text_col, part_col), "features")
    says = lambda name: (F.coalesce(F.max(F.col(name)), F.lit(0)) == 1).cast("long")
    told = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    marked = copies(docs, rows, id_col, text_col, part_col)
    # a marked row moves from its mask to the one with E
    moves = rows.select("id", "part", "mask", F.lit(1).alias("n")).unionByName(marked.select("id", "part", F.explode(F.array(F.struct("mask", F.lit(-1).alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), F.lit(1).alias("n")))).alias("x")).select("id", "part", "x.mask", "x.n"))
    counted = moves.groupBy("id", "part", "mask").agg(F.sum("n").alias("n")).where("n > 0").join(told, "id", "left")
    sums = [F.sum(F.col("n") * F.coalesce(F.col(x), F.lit(0))).alias(x) for x in ("good", "toxic")]
    return _report(counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), *sums))


#: DuckDB: the filters' conditions, copies by the whole text, every order and step by its masks.
ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), m AS (
  SELECT w.part, CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN min(w.doc_id) OVER (PARTITION BY t) < w.doc_id THEN 16 ELSE 0 END AS mask, coalesce(l.quality, 0) = 1 AS good, coalesce(l.toxic, 0) = 1 AS toxic
  FROM w LEFT JOIN labels AS l ON l.doc_id = w.doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic, bit_count(mask::INTEGER) AS fails FROM m GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters AS a, letters AS b, letters AS c, letters AS d, letters AS e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, s.step AS step, bits[s.step] AS bit, coalesce(list_sum(bits[1 : s.step - 1]), 0)::INTEGER AS before FROM orders, (VALUES (1), (2), (3), (4), (5)) AS s(step)
)
SELECT part, filter_order, step::INTEGER AS step,
  sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
  sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost,
  sum(CASE WHEN mask & bit <> 0 THEN n * (120 // fails) ELSE 0 END)::BIGINT AS shapley
FROM cells, steps GROUP BY part, filter_order, step
"""
