"""Vectorised work on the UTF-8 bytes of whole batches of texts.

Words are ``[^\\x20\\x09-\\x0D]+``. UTF-8 never uses those byte values inside a longer sequence, so
splitting bytes and splitting characters give the same words.

Hashes are 64-bit and built by a nonlinear mixer: words eight bytes at a time (long ones by BLAKE2b),
runs of words by doubling. No regular pattern of bytes or words makes two of them collide, as it does
with polynomials modulo 2**64; these (``rolling_hashes``) only place cuts, where a collision is harmless.
Where results must not rest on hashes at all, ``distinct_spans`` tells byte strings apart by their bytes.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib

import numpy as np
import pyarrow as pa

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 5  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between words of letters: all ASCII that is no letter.
NO_LETTER = np.ones(256, bool)
NO_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mixer of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(_U) + _U(0x9E3779B97F4A7C15 * (salt + 1) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_POWERS = {"up": np.ones(1, _U), "down": np.ones(1, _U)}
#: Powers are kept up to so many positions; longer inputs make their own and drop them.
MOST_POWERS = 1 << 20


def _powers(which: str, n: int) -> np.ndarray:
    """BASE**i (up) or BASE**-i (down) for i < n, modulo 2**64."""
    found = _POWERS[which]
    if len(found) < n:
        step = np.full(1 << max(16, (n - 1).bit_length()), BASE if which == "up" else INVERSE, _U)
        step[0] = 1
        found = np.cumprod(step)
        if len(found) <= MOST_POWERS:
            _POWERS[which] = found
    return found[:n]


def rolling_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of values[p:p + width] for every p at which it fits, from prefix sums."""
    n = max(0, len(values) - width + 1)
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * _powers("up", len(values)), out=sums[1:])
    return mix((sums[width : width + n] - sums[:n]) * _powers("down", n))


#: Longer byte strings are hashed by BLAKE2b.
LONG_BYTES = 256
_TAIL = np.array([(1 << 8 * k) - 1 for k in range(8)] + [0xFFFFFFFFFFFFFFFF], _U)


def _eights(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number."""
    padded = np.concatenate([flat, np.zeros(8, np.uint8)])
    return np.ndarray(len(flat) + 1, "<u8", padded, strides=(1,))


def byte_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of flat[s:e] for each span."""
    size = ends - starts
    out = mix(size)
    eights, some, at = _eights(flat), np.flatnonzero((size > 0) & (size <= LONG_BYTES)), 0
    while len(some):
        part = eights[starts[some] + at] & _TAIL[np.minimum(size[some] - at, 8)]
        out[some] = mix(out[some] ^ part, 1)
        at += 8
        some = some[size[some] > at]
    for i in np.flatnonzero(size > LONG_BYTES).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(flat[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def distinct_spans(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first span of each distinct byte string, and which of these each span is; by the bytes, whatever their hashes."""
    _, at, of = np.unique(byte_hashes(flat, starts, ends), return_index=True, return_inverse=True)
    size, same = ends - starts, at[of]
    wrong = size != size[same]
    eights, some, k = _eights(flat), np.flatnonzero(~wrong & (size <= LONG_BYTES) & (size > 0)), 0
    while len(some):
        tail = _TAIL[np.minimum(size[some] - k, 8)]
        wrong[some] |= (eights[starts[some] + k] ^ eights[starts[same[some]] + k]) & tail > 0
        k += 8
        some = some[size[some] > k]
    for i in np.flatnonzero(~wrong & (size > LONG_BYTES)).tolist():
        wrong[i] = (flat[starts[i] : ends[i]] != flat[starts[same[i]] : ends[same[i]]]).any()
    if wrong.any():  # strings that share a hash: once in about 2**64 pairs
        seen: dict[bytes, int] = {}
        of = np.array([seen.setdefault(flat[a:b].tobytes(), len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
        _, at = np.unique(of, return_index=True)
    return at, of


def gram_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of values[p:p + k] for every p at which it fits, from runs of 1, 2, 4, ... values."""
    out, size, power, run = None, 0, mix(values, 8), 1
    while True:
        if k & run:
            n = max(0, len(values) - size - run + 1)
            part = power[size : size + n]
            out = part if out is None else mix(out[:n] * _U(BASE) + part, 9)
            size += run
        run *= 2
        if run > k:
            return out
        power = mix(power[: -run // 2] * _U(BASE) + power[run // 2 :], 10) if len(power) > run // 2 else power[:0]


def release() -> None:
    """Gives memory that a finished task no longer needs back to the machine: workers live on and serve other tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each text starts (with the end as last). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


class Words:
    """The words of a batch of texts: byte spans, the text each belongs to, 64-bit hashes."""

    def __init__(self, column, lower: bool = False, between: np.ndarray = SPACE, breaks=None):
        """breaks: from the bytes, where else a word starts."""
        self.flat, self.offsets = texts_of(column)
        if lower:
            self.flat = LOWER[self.flat]
        n = len(self.flat)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~between[self.flat]
        edge = np.zeros(n + 1, bool)  # a text starts here
        if breaks is not None:
            edge[:-1] = breaks(self.flat)
        edge[self.offsets] = True
        first = inside[1:] & (~inside[:-1] | edge)
        last = inside[:-1] & (~inside[1:] | edge)
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last)
        #: text i has the words first[i]:first[i + 1]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self._hashes = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = byte_hashes(self.flat, self.starts, self.ends)
        return self._hashes

    def gram_starts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Word positions at which k words of one text follow, and the text of each."""
        per = np.maximum(self.counts - k + 1, 0)
        text = np.repeat(np.arange(len(per)), per)
        before = np.concatenate(([0], np.cumsum(per)[:-1])) if len(per) else np.zeros(0, np.int64)
        return np.arange(per.sum()) - np.repeat(before, per) + np.repeat(self.first[:-1], per), text

    def all_grams(self, k: int) -> np.ndarray:
        """Hashes of the k words from each position on, also across texts."""
        return gram_hashes(self.hashes, k)

    def gram_hashes(self, starts: np.ndarray, k: int) -> np.ndarray:
        return self.all_grams(k)[starts]

    def join(self, keep: np.ndarray) -> pa.Array:
        """Per text, its words with keep[word] joined by one space."""
        n = len(self.flat)
        kept = np.zeros(n + 1, np.int64)
        np.add.at(kept, self.starts[keep], 1)
        np.add.at(kept, np.minimum(self.ends[keep], n), -1)
        inside = np.cumsum(kept)[:n] > 0
        # every kept word brings one space after it; the last of a text is cut off below
        lengths = self.ends - self.starts
        size = np.where(keep, lengths + 1, 0)
        at = np.concatenate(([0], np.cumsum(size)))
        out = np.full(at[-1], 0x20, np.uint8)
        letters = np.ones(at[-1], bool)
        letters[at[1:][keep] - 1] = False
        out[letters] = self.flat[inside]
        begin, end = at[self.first[:-1]], at[self.first[1:]]
        cut = end > begin
        mask = np.ones(at[-1], bool)
        mask[end[cut] - 1] = False
        sizes = end - begin - cut
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(out[mask].tobytes())])


def sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over x[i:i + width] for every i at which it fits; op must be idempotent."""
    if len(x) < width:
        return x[:0]
    span, out = 1, x
    while span * 2 <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return op(out[: len(out) - rest], out[rest:]) if rest else out


#: Bytes of text that are worked on at a time; a longer text is a piece of its own.
PIECE_BYTES = 2_000_000


def pieces(batches, at: int | str, limit: int = PIECE_BYTES):
    """The record batches in slices of about ``limit`` bytes of the text column ``at``: bounded memory whatever the batch size."""
    for batch in batches:
        _, offsets = texts_of(batch.column(at))
        part = offsets[:-1] // limit
        edges = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows])) if batch.num_rows else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield batch.slice(a, b - a)


def gather(flat: np.ndarray, size: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of parts that lie one after another in flat: parts of[0], of[1], ... and where each begins (with the end as last)."""
    begin = np.cumsum(size) - size
    lengths = size[of]
    sums = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(sums[-1]) + np.repeat(begin[of] - sums[:-1], lengths)
    return flat[at], sums


def join_bytes(parts: list[bytes], dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all parts and how many each has."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(parts), dtype), size
