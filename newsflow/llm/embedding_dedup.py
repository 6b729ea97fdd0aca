"""Operator 9, embedding near-dedup: PCA-ordered tiled comparison.

Vectors are scaled to length 1 in double precision and turned to principal axes, so that the leading
dimensions hold most of every product. Equal vectors are compared once. Vectors are dealt to blocks of
BLOCK_BYTES, ranges of the first axis. Vectors whose cosine reaches the threshold t differ by at most
sqrt(2 - 2t) along any axis, so pairs of blocks further apart than that are left out before a vector is
copied; every other pair of blocks is one task, which compares tile with tile:

1. The products over the LEADING axes and the suffix norms of what is left bound the cosine from above
   (by Cauchy-Schwarz). With the suffix norm as one more coordinate the bound of all pairs of a tile is
   one matrix product. Pairs below the threshold stop here.
2. The others add further axes, a stretch at a time, with the bound renewed after each.
3. What is left has its whole product in double precision, of the components as they were given and not
   as they were turned. Where that lies within CLOSE of the threshold, rounding must not decide: there the
   cosine is sum(ab) / sqrt(sum(aa) sum(bb)) with exactly rounded sums (``math.fsum``), whatever the axes.

A task returns, per vector, the number of its links, and links that connect what it has found to be
connected (at most one per vector), never all pairs. Components come from ``components.py``.

The axes are fitted on the SAMPLE vectors with the least hash; they decide how early pairs stop, never
which pairs link. The work is quadratic in the number of distinct vectors, as an exact comparison in
many dimensions is: a vector is copied once for each block in reach, so the shuffle is
rows * bytes of a vector * blocks in reach. Large blocks keep these few; how few the ranges leave depends
on the spread along the first axis (clustered vectors: few; evenly spread ones: nearly all).

Defined results: a vector that is null, empty or zero or holds null or non-finite components has no
links and is its own component; vectors of different length don't link; rows that repeat an id are
vectors of their own in n_links, under one id in components; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm import sampling, storage
from newsflow.llm.components import connected_components, local_components

SAMPLE, LEADING, STRETCH = 4096, 16, 16
#: Bytes of the distinct vectors of a block (one task compares two blocks), and vectors of a tile.
BLOCK_BYTES, TILE = 6_000_000, 1024
#: The bound is computed in single precision; pairs this far below the threshold are still looked at.
SLACK = 1e-4
#: Pairs this near the threshold are told by exactly rounded sums.
CLOSE = 1e-12


def _axes(vectors: DataFrame) -> np.ndarray:
    """Principal axes, largest spread first, one per column."""
    found = sampling.least(vectors, SAMPLE, vectors.count(), "key").select("v").toArrow()["v"].combine_chunks()
    size, flat, sizes = _flat(found)
    x = _power_scaled(flat[np.repeat(sizes == size, sizes)].reshape(int((sizes == size).sum()), size))
    x = _unit(x) if len(x) else x
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1]


def _flat(lists: pa.Array) -> tuple[int, np.ndarray, np.ndarray]:
    """Largest size, all numbers one after another, and the size of each list."""
    import pyarrow.compute as pc

    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return int(sizes.max(initial=0)), lists.flatten().to_numpy(zero_copy_only=False).astype(float), sizes


def _stack(blobs: list[bytes], size: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), size)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _power_scaled(x: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two to numbers below 1: no sum over- or underflows."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True, initial=0))[1])


def _on_axes(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Unit vectors turned to the axes where they have their length."""
    return np.ascontiguousarray(unit @ axes if unit.shape[1] == len(axes) else unit)


def _scaled(batches, axes: np.ndarray):
    """Vectors as bytes, scaled by a power of two (which changes no cosine, not even by rounding), and their first coordinate on the axes."""
    for batch in batches:
        _, flat, sizes = _flat(batch.column("v"))
        begin, out, lead = np.cumsum(sizes) - sizes, [b""] * len(sizes), np.zeros(len(sizes))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            x = flat[begin[rows][:, None] + np.arange(size)]
            x = np.ascontiguousarray(_power_scaled(x), "<f8")
            lead[rows] = _on_axes(_unit(x), axes)[:, 0]
            for i, row in zip(rows.tolist(), x, strict=True):
                out[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(out, pa.binary()), pa.array(lead)], names=["key", "n", "blob", "lead"])


def blocks_of(lead: np.ndarray, keys: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The block of each vector: the range between two cuts. Where many vectors share a coordinate cuts are equal; their keys deal them to the blocks between."""
    low, high = np.searchsorted(cuts, lead, "left"), np.searchsorted(cuts, lead, "right")
    return low + keys.astype(np.uint64) % (high - low + 1).astype(np.uint64)


def in_reach(cuts: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For each block, the first and the last block (itself at least) that holds vectors within ``reach`` of its range."""
    low, high = np.append(-np.inf, cuts), np.append(cuts, np.inf)
    first, last = np.searchsorted(high, low - reach, "left"), np.searchsorted(low, high + reach, "right") - 1
    own = np.arange(len(low))
    return np.minimum(first, own), np.maximum(last, own)


def _dealt(batches, cuts: np.ndarray, reach: float):
    """A copy of each vector for each pair of blocks it takes part in, a <= b; side: 0 as one of a, 1 as one of b."""
    first, last = in_reach(cuts, reach)
    for batch in batches:
        keys = batch.column("key").to_numpy()
        block = blocks_of(batch.column("lead").to_numpy(), keys, cuts).astype(np.int64)
        for lo in range(0, batch.num_rows, 512):
            own = block[lo : lo + 512]
            n = last[own] - first[own] + 1
            row = np.repeat(np.arange(len(own)), n)
            other = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[own][row]
            a, b = np.minimum(own[row], other), np.maximum(own[row], other)
            part = batch.slice(lo, 512).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("n"), part.column("blob"), pa.array(a), pa.array(b), pa.array((own[row] > other).astype(np.int32))], names=["key", "n", "blob", "a", "b", "side"])


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine with exactly rounded sums: the same in any order of the components."""
    return math.fsum((a * b).tolist()) / math.sqrt(math.fsum((a * a).tolist()) * math.fsum((b * b).tolist()))


class _Block:
    """Vectors of one length as they are, as units, and turned to the axes."""

    def __init__(self, x: np.ndarray, axes: np.ndarray):
        self.x, self.unit = x, _unit(x)
        self.turned = _on_axes(self.unit, axes)

    def tile(self, at: int) -> _Block:
        part = _Block.__new__(_Block)
        part.x, part.unit, part.turned = self.x[at : at + TILE], self.unit[at : at + TILE], self.turned[at : at + TILE]
        return part


def _tile_links(one: _Block, other: _Block, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows i of one and j of the other with cosine >= threshold."""
    a, b = one.turned, other.turned
    size = a.shape[1]
    stops = [*range(LEADING, size, STRETCH), size]
    if stops[0] >= size:
        i, j = np.nonzero(a @ b.T >= threshold - SLACK)
    else:
        rest_a, rest_b = (np.sqrt(np.maximum(0, (x[:, LEADING:] ** 2).sum(1))) for x in (a, b))
        lead_a, lead_b = (np.column_stack([x[:, :LEADING], r]).astype(np.float32) for x, r in ((a, rest_a), (b, rest_b)))
        i, j = np.nonzero(lead_a @ lead_b.T >= np.float32(threshold - SLACK))
        total = np.einsum("ij,ij->i", a[i, :LEADING], b[j, :LEADING])
        for lo, hi in zip(stops[:-1], stops[1:], strict=True):
            total += np.einsum("ij,ij->i", a[i, lo:hi], b[j, lo:hi])
            if hi < size:
                rest = np.sqrt((a[:, hi:] ** 2).sum(1))[i] * np.sqrt((b[:, hi:] ** 2).sum(1))[j]
                keep = total + rest >= threshold - SLACK
                i, j, total = i[keep], j[keep], total[keep]
    above = np.einsum("ij,ij->i", one.unit[i], other.unit[j]) - threshold
    keep = above > 0
    for k in np.flatnonzero(np.abs(above) <= CLOSE).tolist():
        keep[k] = cosine(one.x[i[k]], other.x[j[k]]) >= threshold
    return i[keep], j[keep]


def _compare(left: pa.Table, right: pa.Table, same: bool, threshold: float, axes: np.ndarray) -> pa.Table:
    """Of two blocks: (key, n links, null) and connecting links (key, null, other)."""
    names = ("key", "links", "other")
    types = (pa.int64(), pa.int64(), pa.int64())
    out: list[list] = [[], [], []]
    sides = []
    for side in (left,) if same else (left, right):
        keys, order = np.unique(side["key"].to_numpy(), return_index=True)
        blobs, n = side["blob"].take(pa.array(order)).to_pylist(), side["n"].to_numpy()[order]
        sides.append((keys, blobs, n))
    if same:
        sides.append(sides[0])
    (keys_a, blobs_a, n_a), (keys_b, blobs_b, n_b) = sides
    keys = keys_a if same else np.concatenate([keys_a, keys_b])
    shift = 0 if same else len(keys_a)
    links, pairs = np.zeros(len(keys), np.int64), []
    for size in sorted({len(x) for x in blobs_a} & {len(x) for x in blobs_b}):
        at_a, at_b = (np.array([i for i, x in enumerate(blobs) if len(x) == size]) for blobs in (blobs_a, blobs_b))
        a = _Block(_stack([blobs_a[i] for i in at_a], size // 8), axes)
        b = a if same else _Block(_stack([blobs_b[i] for i in at_b], size // 8), axes)
        for p in range(0, len(at_a), TILE):
            for q in range(p if same else 0, len(at_b), TILE):
                i, j = _tile_links(a.tile(p), b.tile(q), threshold)
                i, j = at_a[i + p], at_b[j + q]
                if same:
                    once = i < j
                    i, j = i[once], j[once]
                np.add.at(links, i, n_b[j])
                np.add.at(links, j + shift, n_a[i])
                pairs.append((i, j + shift))
    i, j = (np.concatenate([p[s] for p in pairs] or [np.zeros(0, int)]).astype(np.int64) for s in (0, 1))
    root = local_components(len(keys), i, j)
    some = np.flatnonzero(links)
    out[0] += keys[some].tolist()
    out[1] += links[some].tolist()
    out[2] += [None] * len(some)
    moved = np.flatnonzero(root != np.arange(len(keys)))
    out[0] += keys[moved].tolist()
    out[1] += [None] * len(moved)
    out[2] += keys[root[moved]].tolist()
    return pa.table({n: pa.array(x, t) for n, x, t in zip(names, out, types, strict=True)})


def _pair(key, table: pa.Table, threshold: float, axes: np.ndarray) -> pa.Table:
    right = table["side"].to_numpy() == 1
    sides = [table.filter(pa.array(x)) for x in (~right, right)]
    return _compare(*sides, key[0].as_py() == key[1].as_py(), threshold, axes)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per row: the id, n_links, component_id (smallest linked id) and kept (it is that id)."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.when(good, v).alias("v"))
    # adding 0.0 makes -0.0 and 0.0 one
    marked = storage.materialize(rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).withColumn("key", F.when(F.col("v").isNotNull(), F.xxhash64("v"))), "vectors")
    valid = marked.where("key is not null")
    same = valid.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"), F.min("v").alias("v"), F.max("v").alias("w"))
    distinct = same.where(F.when(F.col("v") == F.col("w"), True).otherwise(F.raise_error(F.lit("two vectors share a 64-bit hash")))).drop("w")
    axes = _axes(valid.select("key", "v"))
    turned = storage.materialize(distinct.select("key", "n", "v").mapInArrow(lambda batches: _scaled(batches, axes), "key long, n long, blob binary, lead double"), "turned")
    size = turned.agg(F.coalesce(F.sum(F.octet_length("blob")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    places = [i / blocks for i in range(1, blocks)]
    cuts = np.array(turned.approxQuantile("lead", places, 0.1 / blocks) if places else [], float)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    dealt = turned.mapInArrow(lambda batches: _dealt(batches, cuts, reach), "key long, n long, blob binary, a long, b long, side int")
    found = dealt.groupBy("a", "b").applyInArrow(lambda key, table: _pair(key, table, threshold, axes), "key long, links long, other long")
    found = storage.materialize(found, "found")
    counts = found.where("links is not null").groupBy("key").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "key")
    named = distinct.select("key", "n", "rep").join(roots, "key", "left").join(counts, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = named.join(smallest, "root").select("key", "n_links", "component_id")
    out = marked.select("id", "key").join(labels, "key", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))
