"""Operator 8, line dedup [native]: overlapping three-line windows.

Consecutive lines are hashed in windows of three, windows that occur more than once in the corpus are
found by one aggregation, and every occurrence but the first has its lines removed. Covered positions
of one document are merged to intervals with a window function, so that the text is cut in one pass.
Only DataFrame functions are used.

Which occurrence is first: the least (id, hash of the text, row, position); rows equal in id and text
are told apart by their place in the table. ``docs`` is read twice and must be a table, whose rows keep
their places (a file scan, or a stage written before). Lines are split at "\\n" and compared without white space at their ends; windows of three blank lines don't count.

Defined results: a null text has no lines and stays null; an empty text has one line; texts of fewer
than three lines stay whole; an occurrence that overlaps the first one in the same text is a later
one; of rows that repeat in id and text the first keeps its lines, the others lose them as any later
occurrence does; null ids are an ordinary id; other columns pass through, also when they are named like ours; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WINDOW = 3
#: White space that doesn't count at the ends of a line.
BLANKS = " \t\n\x0b\f\r"


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns with the text cut, as a struct ``row``, and n_lines and n_removed."""
    base = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = base.withColumn("mark", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    lines = base.where(F.contains("text", F.lit("\n"))).select("id", "mark", "at", F.transform(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS))).alias("lines"))
    lines = lines.where(F.size("lines") >= window)
    pos = F.explode(F.sequence(F.lit(1), F.size("lines") - (window - 1)))
    part = F.slice("lines", F.col("pos"), F.lit(window))
    # two independent 64-bit hashes: no false repeats at any size of corpus
    windows = lines.select("id", "mark", "at", "lines", pos.alias("pos")).select("id", "mark", "at", "pos", part.alias("part")).where(F.exists("part", lambda x: x != "")).select("id", "mark", "at", "pos", F.xxhash64("part").alias("h1"), F.xxhash64(F.lit("second"), F.reverse("part")).alias("h2"))
    place = F.struct("id", "mark", "at", "pos")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first"))).select("id", "mark", "at", "pos").distinct()
    order = Window.partitionBy("id", "mark", "at").orderBy("pos")
    runs = later.withColumn("new", (F.col("pos") > F.lag("pos", 1, -window).over(order) + window).cast("int")).withColumn("run", F.sum("new").over(order))
    spans = runs.groupBy("id", "mark", "at", "run").agg(F.min("pos").alias("a"), (F.max("pos") + window).alias("b"))
    cuts = spans.groupBy(F.col("id").alias("cut_id"), F.col("mark").alias("cut_mark"), F.col("at").alias("cut_at")).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("cuts"))
    joined = base.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & F.col("mark").eqNullSafe(F.col("cut_mark")) & (F.col("at") == F.col("cut_at")), "left")
    split = F.split("text", "\n", -1)
    # what stays: before the first interval, between neighbours, after the last
    gaps = F.zip_with(F.concat(F.array(F.lit(1)), F.col("cuts.b")), F.concat(F.col("cuts.a"), F.array(F.col("n_lines").cast("int") + 1)), lambda a, b: F.struct(a.alias("a"), (b - a).alias("n")))
    kept = F.flatten(F.transform(gaps, lambda g: F.slice(F.col("split"), g["a"], g["n"])))
    cut = joined.withColumn("split", F.when(F.col("cuts").isNotNull(), split)).withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise((F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long")))
    removed = F.coalesce(F.aggregate("cuts", F.lit(0), lambda s, c: s + c["b"] - c["a"]), F.lit(0)).cast("long")
    return cut.select(F.col("row").withField(text_col, F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).alias("row"), "n_lines", removed.alias("n_removed"))


#: DuckDB: the same windows by text, the same order of occurrences (no row repeats an id there).
ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, line, regexp_replace(line, '^\s+|\s+$', '', 'g') AS t
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
), w AS (
  SELECT doc_id, i, t || chr(10) || lead(t, 1) OVER d || chr(10) || lead(t, 2) OVER d AS k FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS o FROM w WHERE k IS NOT NULL AND k <> chr(10) || chr(10)
), c AS (
  SELECT DISTINCT doc_id, i + d AS i FROM r, (VALUES (0), (1), (2)) AS s(d) WHERE o > 1
)
SELECT l.doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN c.i IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN c.i IS NULL THEN line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN c ON l.doc_id = c.doc_id AND l.i = c.i
GROUP BY l.doc_id
"""
