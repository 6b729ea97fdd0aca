"""Distinct, ordering, sampling and set operators with a defined result for every row order.

Randomness of the reference becomes an order by md5(key || seed), the same on every run and engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of rows that one task is to hold; how many of these a task gets does not depend on how well they are compressed.
TASK_BYTES = 64 << 20
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def tasks_for(df: DataFrame) -> int:
    """The number of tasks whose rows take TASK_BYTES each when they are sorted, by one aggregation; of small tables as many as run at once, of a MB at least."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields if not isinstance(f.dataType, _FIXED)]
    rows, more = df.agg(F.count(F.lit(1)), F.sum(sum(wide, F.lit(0).cast("long")))).first()
    size = rows * (40 + 8 * len(df.columns)) + (more or 0)
    parallel = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // TASK_BYTES), min(parallel, -(-size // (1 << 20))))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key (null is a key) in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def latest(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key, by one aggregation and no sort."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, "__r.*")


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of keys that occur more than once, with the group's size."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    same = [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    right = sizes.select("group_size", *[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)])
    return df.join(right, same).drop(*[f"__{i}" for i in range(len(keys))])


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Numbers 1.. over all rows in the given order: ranges of TASK_BYTES are sorted and numbered each on its own, and moved on by the rows of the ranges before. One number per range goes to the driver."""
    from newsflow.sources.tables import materialize

    parts = df.repartitionByRange(tasks_for(df), *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    kept = materialize(parts, "numbered").withColumn("__part", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND((1 << 33) - 1))
    total, starts = 0, []
    for part, n in sorted(tuple(r) for r in kept.groupBy("__part").agg(F.count(F.lit(1))).collect()):
        starts.append((part, total))
        total += n
    before = df.sparkSession.createDataFrame(starts, "__part long, __before long")
    return kept.join(F.broadcast(before), "__part").withColumn(name, F.col("__at") + F.col("__before") + 1).drop("__at", "__part", "__before")


def shuffle_key(key: Column, seed: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def sample(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """n rows at random, or all: a top-n of the hash order, which never sorts the whole table."""
    return df.orderBy(shuffle_key(F.col(key), seed), key).limit(n)


def stratified_sample(df: DataFrame, stratum: str, key: str, size: int, seed: str = "") -> DataFrame:
    """A sample of exactly min(size, rows), proportional by stratum.

    Quota: half-even rounding of the share, at most the stratum. What is missing goes one by one to the
    strata of the largest fractional part (ties by name), what is too much is taken back in reverse.
    Strata are counted by one aggregation; the quota table has a row per stratum.
    """
    counts = df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("all"))
    shares = counts.crossJoin(F.broadcast(totals)).withColumn("size", F.least(F.lit(size).cast("long"), "all"))  # one row
    exact = F.col("n") / F.col("all") * F.col("size")
    quota = shares.withColumn("frac", exact - F.floor(exact)).withColumn("q", F.least(F.bround(exact, 0).cast("long"), "n"))
    rest = quota.agg((F.max("size") - F.sum("q")).alias("rest"))
    room = F.col("n") - F.col("q")
    give = quota.crossJoin(F.broadcast(rest))
    order = Window.orderBy(F.col("frac").desc(), F.col(stratum))
    back = Window.orderBy(F.col("frac"), F.col(stratum).desc())
    give = give.withColumn("up", F.row_number().over(order.partitionBy((room > 0).cast("int")))).withColumn("down", F.row_number().over(back.partitionBy((F.col("q") > 0).cast("int"))))
    change = F.when((F.col("rest") > 0) & (room > 0) & (F.col("up") <= F.col("rest")), 1).when((F.col("rest") < 0) & (F.col("q") > 0) & (F.col("down") <= -F.col("rest")), -1).otherwise(0)
    wanted = give.select(stratum, (F.col("q") + change).alias("quota"))
    # only rows whose hash lies near the quota are ranked; a stratum in which too few do is ranked as a whole
    place = F.conv(F.substring(shuffle_key(F.col(key), seed), 1, 8), 16, 10).cast("double") / float(1 << 32)
    placed = df.withColumn("__p", place).join(wanted.join(counts, stratum), stratum)
    limit = (F.col("quota") + 6 * F.sqrt("quota") + 40) / F.col("n")
    enough = placed.where(F.col("__p") <= limit).groupBy(stratum).agg((F.count(F.lit(1)) >= F.any_value("quota")).alias("__enough"))
    near = placed.join(enough, stratum, "left").where((F.col("__p") <= limit) | ~F.coalesce("__enough", F.lit(False)))
    ranked = near.withColumn("__r", F.row_number().over(Window.partitionBy(stratum).orderBy(shuffle_key(F.col(key), seed), key)))
    return ranked.where("__r <= quota").select(*df.columns)


def round_robin(df: DataFrame, group: str, order: str, seed: str = "") -> DataFrame:
    """seq (place in the group) and turn (hashed order of groups): sorted by both, groups take turns."""
    seq = F.row_number().over(Window.partitionBy(group).orderBy(order))
    turns = numbered(df.select(group).distinct().withColumn("__k", shuffle_key(F.col(group), seed)), ["__k", group], "turn").drop("__k")
    return df.withColumn("seq", seq.cast("long")).join(turns, group)


def union_fill(*tables: DataFrame) -> DataFrame:
    """UNION ALL by name, missing columns as null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def aligned(df: DataFrame, like: DataFrame) -> DataFrame:
    """df in the columns and types of ``like``: casts that fail and columns that are missing give null."""
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in like.schema.fields])


def dense_ids(df: DataFrame, by: str, name: str) -> DataFrame:
    """Numbers 1.. of the distinct values in order; ranges of them are numbered in parallel."""
    return df.join(numbered(df.select(by).distinct(), [by], name), by)


def runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """run (number of the run of equal values) and run_pos (place in it) per key: run-length encoding as columns."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = F.coalesce((~F.col(value).eqNullSafe(F.lag(value).over(w))).cast("int"), F.lit(1))
    first = F.when(F.row_number().over(w) == 1, 1).otherwise(new)
    numbered = df.withColumn("__new", first).withColumn("run", F.sum("__new").over(w).cast("long")).drop("__new")
    return numbered.withColumn("run_pos", F.row_number().over(Window.partitionBy(*keys, "run").orderBy(*order)).cast("long"))


def monotone(df: DataFrame, keys: list[str], order: list[str], value: str, tolerance: int = 2) -> DataFrame:
    """Per key: valid_up, valid_down or invalid, by whether dates rise or fall but for ``tolerance`` days; nothing to compare: valid_up."""
    w = Window.partitionBy(*keys).orderBy(*order)
    step = df.withColumn("__d", F.datediff(value, F.lag(value).over(w)))
    up, down = F.coalesce(F.bool_and(F.col("__d") >= -tolerance), F.lit(True)), F.coalesce(F.bool_and(F.col("__d") <= tolerance), F.lit(True))
    return step.groupBy(*keys).agg(F.when(up, "valid_up").when(down, "valid_down").otherwise("invalid").alias("direction"))


def grid_counts(df: DataFrame, day: str, key: str, first: str, last: str) -> DataFrame:
    """Rows per day and key over the whole grid of days and keys, 0 where there are none; days x keys rows."""
    days = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    keys = df.select(F.col(key).alias("key")).distinct()
    counts = df.groupBy(F.col(day).alias("day"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.crossJoin(days).join(counts, ["day", "key"], "left").select("day", "key", F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.col("n").isNull().alias("zero_flag"))
