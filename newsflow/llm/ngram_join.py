"""Operator 10, n-gram Jaccard join: a size-aware heavy-light join.

Two texts link when their sets of word shingles have Jaccard similarity of at least num / den.

* Texts with equal sets are one node. A set that links shares at least ceil(n num / den) of its n
  shingles with one other set, so a set with fewer shingles that occur in a second set is out; one
  count of shingles over the corpus leaves about the sets that have near copies.
* Light: of a small set every subset that a partner must share is enumerated: all subsets of c shingles
  for c from ceil(n num / den) to n. Partners have an equal subset.
* Heavy: large sets are read from inverted lists, one per shingle. A set is on the lists of its
  n - ceil(n num / den) + 1 shingles that are rarest among the sets left; partners share one of these.
  Rarest first keeps lists short: a passage that a third of all rows share comes last.
* The boundary between the two is that which costs least over the corpus's small sets: subsets to be
  enumerated against the measured entries on the lists that these sets would scan.

Shingles and lists travel as packed blobs (``exchange.py``). A list yields links of its members to its
first, not all pairs; components of these are candidate groups. Inside a group similarities are exact:
prefix lists by the group's own frequencies, or matrix products where the group is dense. A group of
more than TILE sets (copies of one text) is worked on in tiles: links inside tiles, then of every set
to the group's leading sets, and then only between sets that are still apart; so it costs in proportion
to its size.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Shingles and sets are told apart by
64-bit hashes.

Defined results: texts without words (null too) have no shingles and link with nothing; texts of fewer
words than a shingle have one, all their words; rows that repeat an id are separate texts under
one id, each with its row; an empty table gives an empty table; other columns are not touched.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm import exchange as X
from newsflow.llm import storage
from newsflow.llm.components import connected_components, local_components
from newsflow.llm.textbytes import Words, gram_hashes, mix, pieces, release

_U = np.uint64
#: Sets of one candidate group that one task compares; leading sets that larger groups are compared with.
TILE, LEADERS = 1024, 8
#: A group of so many sets over at most so many shared shingles is compared by matrix product.
DENSE_SETS, DENSE_COLUMNS = 32, 8192
#: Sizes that may count as small.
MOST_SMALL = 24


class Rule:
    """The similarity rule and what follows from it for sets of one size."""

    def __init__(self, k: int, num: int, den: int):
        self.k, self.num, self.den = k, num, den

    def least(self, n):
        """The fewest shingles that a set of n shares with a partner."""
        return -(-n * self.num // self.den)

    def links(self, shared, n, m):
        return self.den * shared >= self.num * (n + m - shared)

    def subsets(self, n: int) -> int:
        return sum(math.comb(n, j) for j in range(n - self.least(n) + 1))

    def boundary(self, sizes: dict[int, tuple[int, int]]) -> int:
        """The largest small size: least total of enumerated subsets and entries of scanned lists. sizes: of each size how many sets there are, and the entries on all lists that they would scan."""
        def cost(x: int) -> float:
            return sum((k * self.subsets(n) if n <= x else 0) + (entries if n > x * self.num // self.den else 0) for n, (k, entries) in sizes.items())

        return min(range(MOST_SMALL + 1), key=lambda x: (cost(x), x))


def shingle_sets(column, k: int) -> tuple[list[np.ndarray], Words]:
    """For each text its distinct shingles as sorted hashes."""
    words = Words(column, lower=True)
    starts, text = words.gram_starts(k)
    hashes = words.gram_hashes(starts, k)
    cut = np.searchsorted(text, np.arange(len(words.counts) + 1))
    sets = [np.unique(hashes[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    for n in range(1, k):  # fewer words than a shingle: the whole sequence
        some = np.flatnonzero(words.counts == n)
        if len(some):
            for i, x in zip(some.tolist(), gram_hashes(words.hashes, n)[words.first[some]], strict=True):
                sets[i] = np.array([x], _U)
    return sets, words


def set_keys(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit key per set; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        sums = np.array([mix(s, 3).sum(dtype=_U) for s in sets], _U)
    return mix(sums + np.array([len(s) for s in sets], _U), 4).astype(np.int64)


def signatures(sets: list[np.ndarray], often: list[np.ndarray], rule: Rule, small: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) of all sets: subsets of small ones, list keys of large ones. often: in how many sets each shingle is."""
    out, owner = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for i, s in enumerate(sets):
        n = len(s)
        if 0 < n <= small:
            values = [int(v) for v in mix(s, 5)]
            total = sum(values)
            for j in range(n - rule.least(n) + 1):
                found = [(total - sum(c)) & 0xFFFFFFFFFFFFFFFF for c in combinations(values, j)]
                out.append(mix(np.array(found, _U) + _U(n - j), 6))
                owner.append(np.full(len(found), i))
        if n > small * rule.num // rule.den:
            # sets are sorted, so a stable sort breaks ties by hash, everywhere alike
            rarest = np.argsort(often[i], kind="stable")[: n - rule.least(n) + 1]
            keys = s[rarest[often[i][rarest] > 1]]
            out.append(mix(keys, 7))
            owner.append(np.full(len(keys), i))
    return np.concatenate(out), np.concatenate(owner)


def _freed(batches):
    try:
        yield from batches
    finally:
        release()


def _meta(batches, k: int):
    for batch in _freed(pieces(batches, "__text")):
        sets, _ = shingle_sets(batch.column("__text"), k)
        yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__mark"), pa.array([len(s) for s in sets], pa.int64()), pa.array(set_keys(sets), pa.int64())], names=["__id", "__mark", "n", "key"])


def _distinct(batches, k: int):
    """Texts with shingles, one per set and task: copies of a text leave a task once."""
    seen: set[int] = set()
    for batch in _freed(pieces(batches, "__text")):
        sets, _ = shingle_sets(batch.column("__text"), k)
        keys = set_keys(sets)
        new = []
        for i, key in enumerate(keys.tolist()):
            if len(sets[i]) and key not in seen:
                seen.add(key)
                new.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(keys[new], pa.int64()), batch.column("__text").take(pa.array(new, pa.int64()))], names=["key", "text"])


def _shard_sets(table: pa.Table, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys of a shard's distinct sets in order, and the sets."""
    keys, first = np.unique(table["key"].to_numpy(), return_index=True)
    sets, _ = shingle_sets(table["text"].take(pa.array(first)), k)
    return keys, sets


def _held(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's distinct shingles in order, in how many of its sets each is, and where each element of the sets is among them."""
    values, of, count = np.unique(np.concatenate([*sets, np.zeros(0, _U)]), return_inverse=True, return_counts=True)
    return values, count, of


def _tell(key, table: pa.Table, rule: Rule, buckets: int) -> pa.Table:
    """A shard's shingles, to be asked whether they recur: 31 bits of the hash beside those that choose the bucket."""
    values, count, _ = _held(_shard_sets(table, rule.k)[1])
    short = (values.astype(np.uint32) & ~np.uint32(1)) | (count > 1).astype(np.uint32)
    return X.packed(key[0].as_py(), 0, values, buckets, short=short)


def _survivors(table: pa.Table, replies: pa.Table, rule: Rule, buckets: int) -> pa.Table:
    """The sets of a shard enough of whose shingles recur to have a partner."""
    keys, sets = _shard_sets(table, rule.k)
    values, _, of = _held(sets)
    size = np.array([len(x) for x in sets], np.int64)
    sums = np.concatenate(([0], np.cumsum(X.answers(replies, 0, values, buckets)[of])))
    cut = np.concatenate(([0], np.cumsum(size)))
    alive = np.flatnonzero((sums[cut[1:]] - sums[cut[:-1]] >= rule.least(size)) & (size > 0))
    return pa.table({"key": pa.array(keys[alive], pa.int64()), "n": pa.array(size[alive], pa.int64()), "blob": pa.array([sets[i].tobytes() for i in alive.tolist()], pa.binary())})


def _ordered(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    keys, first = np.unique(table["key"].to_numpy(), return_index=True)
    return keys, _sets_of(table.take(pa.array(first)))


def _tell_counts(key, table: pa.Table, buckets: int) -> pa.Table:
    values, count, _ = _held(_ordered(table)[1])
    return X.packed(key[0].as_py(), 0, values, buckets, count.astype(np.uint32))


def _list_costs(table: pa.Table, replies: pa.Table, rule: Rule, buckets: int) -> pa.Table:
    """Per size of small sets, how many there are and the entries on the lists that they would scan."""
    _, sets = _ordered(table)
    values, _, of = _held(sets)
    total = X.told_totals(replies, values, buckets)[of].astype(np.int64)
    found: dict[int, list[int]] = {}
    at = 0
    for s in sets:
        n = len(s)
        if n <= MOST_SMALL:
            entry = found.setdefault(n, [0, 0])
            entry[0] += 1
            entry[1] += int(np.sort(total[at : at + n])[: n - rule.least(n) + 1].sum())
        at += n
    return pa.table({"n": pa.array(list(found), pa.int64()), "sets": pa.array([x[0] for x in found.values()], pa.int64()), "entries": pa.array([x[1] for x in found.values()], pa.int64())})


def _sign(key, table: pa.Table, replies: pa.Table, rule: Rule, small: int, buckets: int) -> pa.Table:
    _, sets = _ordered(table)
    values, _, of = _held(sets)
    total = X.told_totals(replies, values, buckets)[of]
    cut = np.cumsum([0, *map(len, sets)]).tolist()
    found, owner = signatures(sets, [total[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], rule, small)
    order = np.argsort(found, kind="stable")
    return X.packed(key[0].as_py(), 0, found[order], buckets, owner[order].astype(np.uint32))


def _list_links(table: pa.Table) -> pa.Table:
    """Links of the members of each list to its first, for one bucket of lists. A node is shard << 32 | index."""
    found, nodes = [], []
    for shard, blob in zip(table["shard"].to_pylist(), table["blob"].to_pylist(), strict=True):
        n = len(blob) // 12
        found.append(np.frombuffer(blob, _U, n))
        nodes.append((np.int64(shard) << 32) + np.frombuffer(blob, np.uint32, n, 8 * n).astype(np.int64))
    found, nodes = np.concatenate(found), np.concatenate(nodes)
    order = np.lexsort((nodes, found))
    found, nodes = found[order], nodes[order]
    new = np.concatenate(([True], found[1:] != found[:-1]))
    head = nodes[np.flatnonzero(new)[np.cumsum(new) - 1]]
    apart = nodes != head
    a, b = nodes[apart], head[apart]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
    return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})


def _shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets (a matrix)."""
    flat = np.concatenate([*a, *b])
    values, of, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = count > 1
    column = np.cumsum(common) - 1
    row = np.repeat(np.arange(len(a) + len(b)), [len(s) for s in (*a, *b)])
    keep = common[of]
    row, col = row[keep], column[of[keep]]
    out = np.zeros((len(a), len(b)), np.float32)
    width = 4096
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    cuts = np.searchsorted(col, np.arange(0, int(common.sum()) + width, width))
    for i, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        block = np.zeros((len(a) + len(b), width), np.float32)
        block[row[lo:hi], col[lo:hi] - i * width] = 1
        out += block[: len(a)] @ block[len(a) :].T
    return out


def _linked(a: list[np.ndarray], b: list[np.ndarray], rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    n, m = np.array([len(s) for s in a]), np.array([len(s) for s in b])
    return np.nonzero(rule.links(_shared(a, b).astype(np.int64), n[:, None], m[None, :]))


def _roots(sets: list[np.ndarray], rule: Rule) -> np.ndarray:
    """For the sets of one group, the least index that links reach."""
    size = np.array([len(x) for x in sets])
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return np.zeros(2, int) if rule.links(shared, *size) else np.arange(2)
    _, of, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    if len(sets) >= DENSE_SETS and (count > 1).sum() <= DENSE_COLUMNS:
        return local_components(len(sets), *_linked(sets, sets, rule))
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    cut = np.concatenate(([0], np.cumsum(size)))
    ids = [np.sort(rank[of[a:b]]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    heads = [x[: n - rule.least(n) + 1] for x, n in zip(ids, size.tolist(), strict=True)]
    token, owner = np.concatenate(heads), np.repeat(np.arange(len(sets)), [len(h) for h in heads])
    order = np.lexsort((owner, token))
    token, owner = token[order], owner[order]
    parent, tried = list(range(len(sets))), set()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1], [True])))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        members = owner[lo:hi].tolist()
        for j in range(1, hi - lo):
            x = members[j]
            for y in members[:j]:
                if root(x) != root(y) and (y, x) not in tried:
                    tried.add((y, x))
                    n, m = int(size[x]), int(size[y])
                    if rule.links(min(n, m), n, m) and rule.links(len(np.intersect1d(ids[x], ids[y], assume_unique=True)), n, m):
                        a, b = sorted((root(x), root(y)))
                        parent[b] = a
    return np.array([root(x) for x in range(len(sets))])


def _sets_of(table: pa.Table, name: str = "blob") -> list[np.ndarray]:
    return [np.frombuffer(b, _U) for b in table[name].to_pylist()]


def _within(table: pa.Table, rule: Rule) -> pa.Table:
    """(key, root) of the sets of several whole candidate groups or of one tile of a large one."""
    keys, groups, sets = table["key"].to_numpy(), table["comp"].to_numpy(), _sets_of(table)
    order = np.lexsort((keys, groups))
    roots = keys.copy()
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(groups[order]) != 0, [True])))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        some = order[lo:hi]
        if len(some) > 1:
            roots[some] = keys[some[_roots([sets[i] for i in some.tolist()], rule)]]
    return pa.table({"comp": pa.array(groups, pa.int64()), "key": pa.array(keys, pa.int64()), "root": pa.array(roots, pa.int64())})


def _between(left: pa.Table, right: pa.Table, rule: Rule) -> pa.Table:
    """Links between sets of two tables that have different roots, as links of their roots."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    i, j = _linked(_sets_of(left), _sets_of(right), rule)
    pairs = np.unique(np.stack([left["root"].to_numpy()[i], right["root"].to_numpy()[j]], 1), axis=0).reshape(-1, 2)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    return pa.table({"a": pa.array(pairs[:, 0], pa.int64()), "b": pa.array(pairs[:, 1], pa.int64())})


def _candidate_sets(table: pa.Table, groups: pa.Table) -> pa.Table:
    """The sets of a shard that are in a candidate group."""
    schema = pa.schema([("comp", pa.int64()), ("tiles", pa.int64()), ("key", pa.int64()), ("blob", pa.binary())])
    if not groups.num_rows or not table.num_rows:
        return schema.empty_table()
    keys, sets = _ordered(table)
    index = (groups["node"].to_numpy() & 0xFFFFFFFF).tolist()
    return pa.Table.from_arrays([groups["comp"].combine_chunks(), groups["tiles"].combine_chunks(), pa.array(keys[index], pa.int64()), pa.array([sets[i].tobytes() for i in index], pa.binary())], schema=schema)


SETS = "comp long, tiles long, key long, blob binary"
LINKS = "a long, b long"


def _large_groups(sets: DataFrame, rule: Rule) -> DataFrame:
    """(key, root) of candidate groups of several tiles."""
    tiled = sets.withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")))
    inside = storage.materialize(tiled.groupBy("comp", "tile").applyInArrow(lambda table: _within(table, rule), "comp long, key long, root long"), "tiles")
    rooted = tiled.join(inside.select("key", "root"), "key")
    # leading sets of a group: the roots of its largest parts
    parts = inside.groupBy("comp", "root").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("comp").orderBy(F.desc("n"), F.desc("root")))  # cut to so many in each task before the shuffle
    leaders = parts.withColumn("__n", place).where(F.col("__n") <= LEADERS).select("comp", F.col("root").alias("key"))
    led = tiled.join(leaders, ["comp", "key"]).select(F.col("comp").alias("comp"), F.col("key").alias("root"), F.col("blob").alias("blob"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"))
    with_leaders = rooted.groupBy("comp", "tile").cogroup(led.groupBy("comp", "tile")).applyInArrow(lambda left, right: _between(left, right, rule), LINKS)
    merged = _merge(inside, with_leaders)
    # what is still apart from the largest part is compared with everything, part by part
    sizes = merged.groupBy("comp", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("comp").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("all"), F.max("n").alias("most"))
    open_groups = main.where("most < all").withColumn("rest_tiles", F.ceil((F.col("all") - F.col("most")) / TILE).cast("long"))
    now = tiled.join(merged.select("key", "root"), "key").join(open_groups, "comp").withColumn("rest", F.pmod(F.xxhash64("key", F.lit(1)), F.col("rest_tiles")))
    fresh = [F.col(c).alias(c) for c in ("comp", "root", "blob")]  # both sides stem from one table
    rest = now.where("root <> main").select(*fresh, F.col("rest").alias("rest"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("tile"))
    every = now.select(*fresh, F.col("tile").alias("tile"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest_tiles") - 1)).alias("rest"))
    last = rest.groupBy("comp", "tile", "rest").cogroup(every.groupBy("comp", "tile", "rest")).applyInArrow(lambda left, right: _between(left, right, rule), LINKS)
    return _merge(merged, last).select("key", "root")


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (comp, key, root) after links between roots."""
    found = connected_components(links)
    return storage.materialize(labels.join(found.withColumnRenamed("root", "new").withColumnRenamed("node", "root"), "root", "left").select("comp", "key", F.coalesce("new", "root").alias("root")), "labels")


def _rooted(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(__id, __mark, n, key) of every row of docs, where __mark is the hash of its text; (key, rep, root) of every set, where rep is its first row: null ids last, then by id and mark."""
    rule = Rule(k, num, den)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    size = X.text_bytes(rows, "__text")
    shards = X.shards_for(size)
    id_field = T.StructField("__id", docs.schema[id_col].dataType)
    marked = rows.withColumn("__mark", F.xxhash64("__text"))
    meta = storage.materialize(marked.mapInArrow(lambda batches: _meta(batches, k), T.StructType([id_field, *T._parse_datatype_string("__mark long, n long, key long").fields])), "sets")
    nodes = meta.where("n > 0").groupBy("key").agg(F.min(F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__mark")).alias("rep"), F.max("n").alias("n"))
    dealt = rows.select("__text").mapInArrow(lambda batches: _distinct(batches, k), "key long, text string").withColumn("shard", F.pmod("key", F.lit(shards)))
    fewest = X.least_buckets(docs.sparkSession)
    buckets = X.buckets_for(size / 6, fewest)  # about a shingle every six bytes
    by_shard = dealt.groupBy("shard")
    recur = by_shard.applyInArrow(lambda key, table: _tell(key, table, rule, buckets), X.MESSAGE).groupBy("bucket").applyInArrow(lambda table: X.recurring(table, np.uint32), X.MESSAGE)
    alive = by_shard.cogroup(recur.groupBy("shard")).applyInArrow(lambda table, replies: _survivors(table, replies, rule, buckets), "key long, n long, blob binary")
    alive = storage.materialize(alive.withColumn("shard", F.pmod("key", F.lit(shards))), "alive")
    left = alive.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    few = X.buckets_for(left, fewest)
    by_shard = alive.select("shard", "key", "blob").groupBy("shard")
    often = storage.materialize(by_shard.applyInArrow(lambda key, table: _tell_counts(key, table, few), X.MESSAGE).groupBy("bucket").applyInArrow(lambda table: X.totals(table), X.MESSAGE), "often")
    costs = by_shard.cogroup(often.groupBy("shard")).applyInArrow(lambda table, replies: _list_costs(table, replies, rule, few), "n long, sets long, entries long")
    small = rule.boundary({r[0]: (r[1], r[2]) for r in costs.groupBy("n").agg(F.sum("sets"), F.sum("entries")).collect()})  # at most MOST_SMALL rows
    signed = by_shard.cogroup(often.groupBy("shard")).applyInArrow(lambda key, table, replies: _sign(key, table, replies, rule, small, few), X.MESSAGE)
    candidate = connected_components(signed.groupBy("bucket").applyInArrow(lambda table: _list_links(table), LINKS)).withColumnRenamed("root", "comp")
    counts = candidate.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("tiles"))
    tiled = candidate.join(counts, "comp").withColumn("shard", F.shiftright("node", 32))
    sets = storage.materialize(by_shard.cogroup(tiled.groupBy("shard")).applyInArrow(lambda table, groups: _candidate_sets(table, groups), SETS), "candidates")
    batch = F.pmod(F.xxhash64("comp"), F.lit(max(1, shards)))

    grouped = sets.where("tiles = 1").withColumn("batch", batch).groupBy("batch")
    labels = grouped.applyInArrow(lambda table: _within(table, rule), "comp long, key long, root long").select("key", "root")
    if sets.where("tiles > 1").limit(1).count():
        labels = labels.unionByName(_large_groups(sets.where("tiles > 1"), rule))
    labels = storage.materialize(labels.where("key <> root"), "roots")
    return meta, nodes.join(labels, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("root"))


def join_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: the id, n_shingles and component_id, the smallest id that links reach."""
    meta, rooted = _rooted(docs, k, num, den, id_col, text_col)
    named = rooted.groupBy("root").agg(F.min("rep")["__id"].alias("component_id"))
    found = rooted.join(named, "root").select("key", "component_id")
    out = meta.join(found, "key", "left").select("__id", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("__id")).alias("component_id"))
    return out.select(F.col("__id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that link with nothing, and of linked rows the one of the smallest id (a null id comes last), of these the one whose text has the least hash."""
    _, rooted = _rooted(docs, k, num, den, id_col, text_col)
    heads = rooted.groupBy("root").agg(F.min("rep").alias("h")).select(F.col("h.__id").alias("__head"), F.col("h.__mark").alias("__head_mark"))
    worded = F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # equal ids and texts are copies, whatever the other columns
    tie = F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind])
    rows = docs.where(worded).select(F.struct(*docs.columns).alias("__row"), F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__mark"), tie.alias("__tie"))
    kept = rows.join(heads, F.col("__id").eqNullSafe(F.col("__head")) & (F.col("__mark") == F.col("__head_mark")), "left_semi")
    order = Window.partitionBy("__id", "__mark").orderBy("__tie")
    first = kept.withColumn("__n", F.row_number().over(order)).where("__n = 1").select("__row.*")
    return first.unionByName(docs.where(~worded))
