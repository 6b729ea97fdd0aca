"""Shards of whole texts, and packed exchange of hashes between them.

Rows are dealt to shards of a few MB of text by a hash of the row (rows equal in all columns share one). A shard sends the hashes that it
wants counted as a few binary blobs, one per bucket of the hash space, each hash once, so a value that
a third of all rows hold costs a bucket at most one entry per shard. 8 bytes a hash cross the
network instead of a row each, and the answer is one bit a hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_U = np.uint64
#: Bytes of text that a shard holds on average; a longer text makes its shard larger.
SHARD_BYTES = 4_000_000
#: Hashes that a bucket receives on average.
BUCKET_HASHES = 1_000_000
MESSAGE = "shard long, kind int, bucket long, blob binary"
ARROW_MESSAGE = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("blob", pa.binary())])


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts: one scan of one column, which sizes shards and buckets."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]


def shards_for(size: int, each: int = SHARD_BYTES) -> int:
    return max(1, math.ceil(size / each))


def buckets_for(hashes: float, least: int = 8) -> int:
    return max(least, math.ceil(hashes / BUCKET_HASHES))


def least_buckets(spark) -> int:
    """As many buckets as a shuffle has tasks, within reason, so that small inputs use the cluster too."""
    return min(256, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def shard_of(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n))


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket by the upper bits, so that sorted hashes lie in bucket order."""
    return (hashes >> _U(32)) * _U(n) >> _U(32)


def _cuts(hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted hashes fall into, and where each begins (with the end as last): work in proportion to the hashes, whatever n."""
    full, first = np.unique(bucket_of(hashes, n), return_index=True)
    return full.astype(np.int64), np.append(first, len(hashes))


def messages(shards, kinds, buckets, blobs: list[bytes]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(shards, pa.int64()), pa.array(kinds, pa.int32()), pa.array(buckets, pa.int64()), pa.array(blobs, pa.binary())], schema=ARROW_MESSAGE)


def packed(shard: int, kind: int, hashes: np.ndarray, n: int, payload: np.ndarray | None = None, short: np.ndarray | None = None) -> pa.Table:
    """Messages for sorted hashes; payload: 32-bit values sent along; short: 32-bit values sent in place of the hashes."""
    told = hashes if short is None else short
    full, cuts = _cuts(hashes, n)
    blobs = [told[a:b].tobytes() + (b"" if payload is None else payload[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return messages([shard] * len(full), [kind] * len(full), full, blobs)


def _replies(table: pa.Table, kind: int, hashes: np.ndarray, n: int):
    """(from, to, blob) of each reply to what a shard sent as ``kind``: the range of its sorted hashes, and the answer."""
    full, cuts = _cuts(hashes, n)
    for k, b, blob in zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), table["blob"].to_pylist(), strict=True):
        if k == kind:
            at = int(np.searchsorted(full, b))
            yield int(cuts[at]), int(cuts[at + 1]), blob


def partners(table: pa.Table) -> pa.Table:
    """For one bucket of hashes as ``marked`` makes them: answers each message with a bit per hash (it recurs) and, for those that do, the shard that holds it next.

    The holders of a hash form a ring, so each has one partner to tell of it, however many they are; a
    hash that only one shard holds, repeatedly, has that shard itself.
    """
    rows = sorted(zip(table["shard"].to_pylist(), table["kind"].to_pylist(), table["bucket"].to_pylist(), table["blob"].to_pylist(), strict=True), key=lambda r: r[:3])
    parts = [np.frombuffer(r[3], _U) for r in rows]
    every = np.concatenate(parts)
    owner = np.repeat(np.array([r[0] for r in rows], np.int64), [len(p) for p in parts])
    order = np.lexsort((owner, every & ~_U(1)))
    values, held = (every & ~_U(1))[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))[: len(values)]
    size = np.diff(np.append(first, len(values)))
    after = np.arange(1, len(values) + 1)
    after[first + size - 1] = first
    nearest, alone = np.empty(len(values), np.int64), np.empty(len(values), bool)
    nearest[order], alone[order] = held[after], np.repeat(size == 1, size)
    recurs = ~alone | ((every & _U(1)) > 0)
    blobs, at = [], 0
    for p in parts:
        some = recurs[at : at + len(p)]
        blobs.append(np.packbits(some).tobytes() + nearest[at : at + len(p)][some].astype(np.uint32).tobytes())
        at += len(p)
    return messages([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], blobs)


def told_partners(table: pa.Table, kind: int, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of the sorted hashes that a shard sent recurs, and its partner shard (-1: it does not)."""
    recurs, partner = np.zeros(len(hashes), bool), np.full(len(hashes), -1, np.int64)
    for lo, hi, blob in _replies(table, kind, hashes, n):
        width = -(-(hi - lo) // 8)
        some = np.unpackbits(np.frombuffer(blob, np.uint8, width), count=hi - lo).astype(bool)
        recurs[lo:hi] = some
        partner[lo:hi][some] = np.frombuffer(blob[width:], np.uint32)
    return recurs, partner


def marked(values: np.ndarray) -> np.ndarray:
    """Distinct values, sorted; the lowest bit is not part of the value and says that it occurs more than once."""
    found, counts = np.unique(values & ~_U(1), return_counts=True)
    return found | (counts > 1).astype(_U)


def recurring(table: pa.Table, dtype=_U) -> pa.Table:
    """For one bucket: answers each message with a bit per hash, set where the value occurs at least twice in all."""
    rows = sorted(zip(table["shard"].to_pylist(), table["kind"].to_pylist(), table["bucket"].to_pylist(), table["blob"].to_pylist(), strict=True), key=lambda r: r[:3])
    parts = [np.frombuffer(r[3], dtype) for r in rows]
    every = np.concatenate(parts) if parts else np.zeros(0, dtype)
    values = every & ~dtype(1)
    found, where, counts = np.unique(values, return_inverse=True, return_counts=True)
    twice = counts > 1
    twice[where[(every & dtype(1)) > 0]] = True
    bits, at = [], 0
    flags = twice[where]
    for p in parts:
        bits.append(np.packbits(flags[at : at + len(p)]).tobytes())
        at += len(p)
    return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()), pa.array(bits, pa.binary())], schema=ARROW_MESSAGE)


def answers(table: pa.Table, kind: int, hashes: np.ndarray, n: int) -> np.ndarray:
    """The bit of each of the sorted hashes that a shard sent as ``kind``."""
    out = np.zeros(len(hashes), bool)
    for lo, hi, blob in _replies(table, kind, hashes, n):
        out[lo:hi] = np.unpackbits(np.frombuffer(blob, np.uint8), count=hi - lo).astype(bool)
    return out


#: Counts are told up to this.
MOST_COUNT = 255


def totals(table: pa.Table) -> pa.Table:
    """For one bucket of hashes with counts as payload: answers each message with a byte per hash, the total up to MOST_COUNT."""
    rows = sorted(zip(table["shard"].to_pylist(), table["kind"].to_pylist(), table["bucket"].to_pylist(), table["blob"].to_pylist(), strict=True), key=lambda r: r[:3])
    sizes = [len(r[3]) // 12 for r in rows]
    every = np.concatenate([np.frombuffer(r[3], _U, n) for r, n in zip(rows, sizes, strict=True)])
    counts = np.concatenate([np.frombuffer(r[3], np.uint32, n, 8 * n) for r, n in zip(rows, sizes, strict=True)]).astype(np.int64)
    _, where = np.unique(every, return_inverse=True)
    total = np.minimum(np.bincount(where, counts), MOST_COUNT).astype(np.uint8)[where]
    blobs, at = [], 0
    for n in sizes:
        blobs.append(total[at : at + n].tobytes())
        at += n
    return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()), pa.array(blobs, pa.binary())], schema=ARROW_MESSAGE)


def told_totals(table: pa.Table, hashes: np.ndarray, n: int) -> np.ndarray:
    """The total of each of the sorted hashes that a shard sent."""
    out = np.zeros(len(hashes), np.uint8)
    for lo, hi, blob in _replies(table, 0, hashes, n):
        out[lo:hi] = np.frombuffer(blob, np.uint8)
    return out
