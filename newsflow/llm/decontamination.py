"""Operator 3, benchmark decontamination: pigeonhole edit matching.

An item of m characters may differ from a text by e = floor(ERROR_RATE * m) edits. It is split into
e + 1 pieces; e edits can spoil at most e of them, so every text that holds the item within the budget
holds one piece unchanged. All pieces go into one Aho-Corasick automaton, every whole text runs through
it, and the place that each hit implies is verified with Myers' bit-parallel edit distance (one Python
integer as the bit vector, so items may have any length). The same argument holds inside an item: of q
neighbouring pieces with at most q - 1 edits, one half has fewer edits than pieces. So a hit is
verified from its neighbour up a binary tree of pieces, and chance hits fail on a few characters.

Texts and items are compared in lower case with runs of white space as one space.

The items are a stated query set. They are taken from the driver in blocks of at most BLOCK_CHARS
characters, each block in one pass over the texts; the texts are neither shuffled nor collected.

Defined results: null, empty and blank items and texts match nothing; one row per text row and item
(the nearest occurrence, the first among equals), so repeated text rows and items give repeated rows;
an empty table gives an empty table; item ids have any type and may be null.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from newsflow.llm.textbytes import pieces, release

ERROR_RATE = 0.1
BLOCK_CHARS = 1_000_000
_STATE: dict = {}


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def split(item: str, parts: int) -> list[tuple[int, str]]:
    """The item in ``parts`` pieces of almost equal length, with their offsets."""
    edges = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def myers(item: str, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of item in text within ``most`` edits; the first end among equals."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    top, full = 1 << (m - 1), (1 << m) - 1
    up, down, score, best = full, 0, m, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | (full & ~(xh | up))
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        up = mh | (full & ~(xv | ph))
        down = ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
            if not score:
                break
    return best


def climb(parts: int) -> list[list[tuple[int, int]]]:
    """For each piece, the ranges of pieces that hold it, from two pieces up to all: a balanced binary tree."""
    paths: list[list[tuple[int, int]]] = [[] for _ in range(parts)]

    def down(a: int, b: int) -> None:
        if b - a > 1:
            down(a, (a + b) // 2)
            down((a + b) // 2, b)
            for p in paths[a:b]:
                p.append((a, b))

    down(0, parts)
    return paths


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.paths = [], []
        where: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        for k, (i, t) in enumerate(items):
            e = int(rate * len(t) + 1e-9)
            parts = split(t, min(e + 1, len(t)))
            edges = [*[a for a, _ in parts], len(t)]
            self.items.append((i, t, e))
            self.paths.append([[(edges[a], edges[b], b - a - 1) for a, b in path] for path in climb(len(parts))])
            for j, (offset, piece) in enumerate(parts):
                where[piece].append((k, j, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    @staticmethod
    def of(items: tuple, rate: float) -> Matcher:
        """One per worker and block."""
        if _STATE.get("key") != (items, rate):
            _STATE.clear()
            _STATE.update(key=(items, rate), matcher=Matcher(list(items), rate))
        return _STATE["matcher"]

    def find(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(index of the item, distance, start, end) in the normalised text."""
        text = normal(text)
        if not text or not self.items:
            return
        implied: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for end, (length, places) in self.automaton.iter(text):
            for k, j, offset in places:
                implied[k].add((end + 1 - length - offset, j))
        for k, hits in sorted(implied.items()):
            _, item, e = self.items[k]
            at = text.find(item)
            if at >= 0:
                yield k, 0, at, at + len(item)
            elif (best := self._nearest(text, k, sorted(hits))) is not None:
                distance, end = best
                begin = max(0, end - len(item) - e)
                back = myers(item[::-1], text[begin:end][::-1], distance)
                yield k, distance, end - back[1], end

    def _nearest(self, text: str, k: int, hits: list[tuple[int, int]]) -> tuple[int, int] | None:
        """(distance, end) of the nearest occurrence that one of the hits (implied start, piece) implies."""
        _, item, e = self.items[k]
        best, checked = None, -1
        for start, j in hits:
            if start <= checked:  # within e of a start whose surroundings have been searched
                continue
            for a, b, most in self.paths[k][j]:
                lo = max(0, start + a - most)
                found = myers(item[a:b], text[lo : max(0, start + b + most)], most)
                if found is None:
                    break
            else:
                # hits up to start + e look for occurrences that begin up to 2e from here
                lo = max(0, start - e)
                found = myers(item, text[lo : max(0, start + len(item) + 3 * e)], e)
                checked = start + e
                if found and (best is None or found[0] < best[0]):
                    best = (found[0], lo + found[1])
        return best


def freed(run):
    """run, after which a worker gives back what its task took."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[tuple[int, str], ...]]:
    block, size = [], 0
    for r in items.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        text = normal(r[1])
        if text:
            if block and size + len(text) > BLOCK_CHARS:
                yield tuple(block)
                block, size = [], 0
            block.append((r[0], text))
            size += len(text)
    if block:
        yield tuple(block)


def _matches(docs: DataFrame, block: tuple, rate: float, id_type: T.DataType) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters

    def run(batches):
        matcher = Matcher.of(held.value, rate)
        for batch in pieces(batches, "__text"):
            rows, out = [], []
            for row, text in enumerate(batch.column("__text").to_pylist()):
                for k, distance, start, end in matcher.find(text):
                    rows.append(row)
                    item_id, item, _ = matcher.items[k]
                    out.append((item_id, distance, 1 - distance / len(item), start, end))
            columns = [list(x) for x in zip(*out, strict=True)] or [[]] * 5
            types = (to_arrow_type(id_type), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            ids = batch.column("__id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["__id", "item_id", "distance", "similarity", "start", "end"])

    schema = T.StructType([docs.schema["__id"], T.StructField("item_id", id_type), *T._parse_datatype_string("distance long, similarity double, start long, end long").fields])
    return docs.mapInArrow(freed(run), schema)


def contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for each text and item that it holds: the id, item_id, distance, similarity and the place (start, end) in the normalised text."""
    kept = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    found = None
    for block in _blocks(items, item_id, item_text):
        more = _matches(kept, block, rate, items.schema[item_id].dataType)
        found = more if found is None else found.unionByName(more)
    if found is None:
        found = _matches(kept.limit(0), (), rate, items.schema[item_id].dataType)
    return found.withColumnRenamed("__id", id_col)


def clean(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text holds no item; one pass, no join."""
    kept = docs
    for block in _blocks(items, item_id, item_text):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, held=held, at=kept.columns.index(text_col)):
            matcher = Matcher.of(held.value, rate)
            for batch in pieces(batches, at):
                fine = [next(matcher.find(text), None) is None for text in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(fine, pa.bool_()))

        kept = kept.mapInArrow(freed(run), kept.schema)
    return kept
