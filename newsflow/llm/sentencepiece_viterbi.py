"""Operator 7, SentencePiece encoding and decoding: shared-prefix Viterbi.

A text is one marked word after another: a run of spaces with the characters up to the next space,
after one space is put before the text. No piece of the model has a space behind another character
(``Model`` checks it), so a text's ids are those of its marked words. Nor is anything merged across two
characters that no piece has side by side (a letter and a full stop, say): marked words are cut there too,
and most of what made them differ is gone. Each slice of texts encodes its distinct words once. They are sorted, which lays them out as a depth-first walk of their trie:
the forward states of the characters that a word shares with the one before are kept, and only the
rest is computed.

The public model is of type BPE: adjacent parts are merged, best score first, leftmost first among
equals. A list of pieces is such an encoding just if each of its neighbouring pairs is, so the forward
state of a prefix is the last piece of the prefix's encoding: of all pieces that end there, the one that
is compatible with the state where it begins. Whether a pair is compatible is told from the merges that
make its two pieces: a merge across the border must not come before those. Runs of spaces, whose pieces
share one score, and whatever the walk leaves open are merged plainly (``Model.plain``). The ids are
those of the sentencepiece library. A character that no piece covers becomes its UTF-8 bytes' pieces.

Decoding joins the pieces' bytes and drops the first space; it gives back every text, also with
repeated spaces, control characters and U+2581. That last one is spelt in bytes, where the library
reads it as a space and loses it: the one case in which ids differ.

Memory: a worker keeps the ids of CACHE_BYTES of words and PAIRS pairs at most; words go when its task ends.

Defined results: null texts have null ids and decode to null; empty texts have no ids; repeated rows
are encoded alike; an empty table gives an empty table; columns named ids or decoded are replaced.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from newsflow.llm.textbytes import distinct_spans, gather, join_bytes, pieces, release, texts_of

MARK = "▁"
#: Bytes of marked words and their ids that a worker keeps, with ENTRY_BYTES for each; pairs of pieces.
CACHE_BYTES, ENTRY_BYTES, PAIRS = 120_000_000, 250, 150_000
_STATE: dict = {}


class Model:
    """Pieces and scores of a model file of type BPE."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bytes_of = [b""] * n
        self.of_byte = [sp.unk_id()] * 256
        self.pieces: dict[str, tuple[int, float]] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
                self.of_byte[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                text = piece.replace(MARK, " ")
                self.bytes_of[i] = text.encode()
                self.pieces[text] = (i, sp.get_score(i))
        if any(" " in p.lstrip(" ") for p in self.pieces):
            raise ValueError("a piece spans words; this model can't be encoded word by word")
        if " " not in self.pieces or any(c not in self.pieces for p in self.pieces for c in p):
            raise ValueError("a piece has a character that is no piece; this model is not of type BPE")
        #: whether some piece has two bytes side by side
        self.joined = np.zeros((256, 256), bool)
        for p in self.pieces:
            raw = np.frombuffer(p.encode(), np.uint8)
            self.joined[raw[:-1], raw[1:]] = True
        self.joined[:, 0x80:0xC0] = True  # within a character
        self.names = {i: p for p, (i, _) in self.pieces.items()}
        ending: dict[str, set[int]] = {}
        for p in self.pieces:
            ending.setdefault(p[-3:], set()).add(len(p))
        self.lengths = {k: tuple(sorted(v, reverse=True)) for k, v in ending.items()}
        #: the same for any last three characters that texts had
        self.tails: dict[str, tuple[int, ...]] = {}
        runs = {p for p in self.pieces if len(p) > 1 and p.startswith("  ")}
        #: extra spaces are merged after everything else and with each other only
        self.spaces_last = all(not p.strip(" ") for p in runs) and max((self.pieces[p][1] for p in runs), default=-math.inf) < min(s for p, (_, s) in self.pieces.items() if len(p) > 1 and p not in runs)
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple | None] = {}

    @staticmethod
    def of(path: str) -> Model:
        if path not in _STATE:
            _STATE[path] = Model(path)
        return _STATE[path]

    def forget(self) -> None:
        self.known.clear()
        self.held = 0

    def plain(self, word: str, trace: list | None = None) -> list[str]:
        """The word's parts after all merges. trace: gets the two parts of each merge."""
        part, n = list(word), len(word)
        before, after, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (found := self.pieces.get(part[i] + part[after[i]])) is not None:
                heapq.heappush(heap, (-found[1], i, after[i], part[i] + part[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if not part[i] or not part[j] or after[i] != j or part[i] + part[j] != both:
                continue
            if trace is not None:
                trace.append((part[i], part[j]))
            part[i], part[j] = both, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p]

    def ids_of(self, parts: list[str]) -> list[int]:
        out: list[int] = []
        for p in parts:
            if (found := self.pieces.get(p)) is not None:
                out.append(found[0])
            else:
                out.extend(self.of_byte[b] for b in p.encode())
        return out

    def _time(self, piece: str) -> float:
        """When a part comes into being; single characters are there from the start."""
        return -self.pieces[piece][1] if len(piece) > 1 else -math.inf

    def _edges(self, i: int) -> tuple | None:
        """Of piece i the parts at its left and right border, from the whole piece to one character, as (part, made at, merged at); None: merging never makes it; (): merges don't come in order."""
        if i not in self.edges:
            name, found = self.names[i], None
            trace: list = []
            if len(self.plain(name, trace)) == 1:
                made = {a + b: (a, b) for a, b in trace}
                sides, ordered = [], True
                for side in (0, 1):
                    parts, x, until = [], name, math.inf
                    while True:
                        ordered &= self._time(x) < until
                        parts.append((x, self._time(x), until))
                        if len(x) == 1:
                            break
                        until, x = self._time(x), made[x][side]
                    sides.append(parts)
                found = tuple(sides) if ordered else ()
            self.edges[i] = found
        return self.edges[i]

    def _tail(self, tail: str) -> tuple[int, ...]:
        """By the last three characters of a prefix (or all of a shorter one), the lengths of pieces that may end there, longest first; none: its last character is no piece."""
        found = tuple(n for k in (3, 2, 1) if k <= len(tail) for n in self.lengths.get(tail[-k:], ()) if len(tail) == 3 or n <= len(tail))
        if len(self.tails) >= PAIRS:
            self.tails.clear()
        self.tails[tail] = found if tail[-1] in self.pieces else ()
        return self.tails[tail]

    def compatible(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a; a < 0: nothing that could be merged is before."""
        after = self._edges(b)
        if after is None or a < 0:
            return after is not None
        before = self._edges(a)
        if not before or not after:
            return self.plain(self.names[a] + self.names[b]) == [self.names[a], self.names[b]]
        for x, made_x, until_x in before[1]:
            for y, made_y, until_y in after[0]:
                if max(made_x, made_y) < min(until_x, until_y) and (both := self.pieces.get(x + y)) is not None and -both[1] < until_x and -both[1] <= until_y:
                    return False
        return True

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words of one leading space at most, by a depth-first walk of their trie."""
        out: dict[str, list[int]] = {}
        begin, state = [0], [-2]  # for each prefix of the walk's path: where its last piece begins, and the piece (-1: a character without one)
        last = ""
        find, pairs, tails = self.pieces.get, self.pairs, self.tails
        for word in sorted(words):
            shared, most = 0, min(len(last), len(word), len(state) - 1)
            while shared < most and last[shared] == word[shared]:
                shared += 1
            del begin[shared + 1 :], state[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                tail = word[max(0, end - 3) : end]
                if (sizes := tails.get(tail)) is None:
                    sizes = self._tail(tail)
                if not sizes:
                    begin.append(end - 1)
                    state.append(-1)
                    continue
                for n in sizes:
                    if n <= end and (piece := find(word[end - n : end])) is not None:
                        key = (state[end - n] << 32) + piece[0]
                        if (fits := pairs.get(key)) is None:
                            if len(pairs) >= PAIRS:
                                pairs.clear()
                            fits = pairs[key] = self.compatible(state[end - n], piece[0])
                        if fits:
                            begin.append(end - n)
                            state.append(piece[0])
                            break
                else:
                    break
            last = word
            if len(state) <= len(word):  # the walk leaves it open
                out[word] = self.ids_of(self.plain(word))
                continue
            ids, end = [], len(word)
            while end:
                piece = state[end]
                ids.extend([piece] if piece >= 0 else [self.of_byte[b] for b in reversed(word[begin[end] : end].encode())])
                end = begin[end]
            out[word] = ids[::-1]
        return out

    def _spelt(self, words: list[str]) -> list[bytes]:
        """Ids (32-bit) of distinct words with any run of spaces before them."""
        bodies = [" " + w.lstrip(" ") if w.startswith("  ") else w for w in words]
        found, space = self.encode_words(list(set(bodies))), self.pieces[" "][0]
        flat: list[int] = []
        at = [0]
        for w, body in zip(words, bodies, strict=True):
            ids, more = found[body], len(w) - len(body)
            if more and not self.spaces_last:
                ids = self.ids_of(self.plain(w))
            elif more:
                lone = ids[0] == space
                ids = [*self.ids_of(self.plain(" " * (more + lone))), *ids[lone:]]
            flat += ids
            at.append(len(flat))
        raw = np.array(flat, "<i4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin."""
        raw, offsets = texts_of(column)
        full = np.flatnonzero(np.diff(offsets))
        flat = np.insert(raw, offsets[:-1][full], 0x20)
        moved = offsets + np.concatenate(([0], np.cumsum(np.diff(offsets) > 0)))
        first = np.zeros(len(flat) + 1, bool)
        first[1:-1] = ~self.joined[flat[:-1], flat[1:]]
        first[moved] = True
        starts = np.flatnonzero(first[: len(flat)])
        ends = np.append(starts[1:], len(flat))[: len(starts)]
        at, of = distinct_spans(flat, starts, ends)
        text = flat.tobytes()
        names = [text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        ids = [self.known.get(w) for w in names]
        new = [j for j, x in enumerate(ids) if x is None]
        if new:
            for j, x in zip(new, self._spelt([names[j].decode("utf-8", "replace") for j in new]), strict=True):
                ids[j] = x
            if self.held > CACHE_BYTES:
                self.forget()
            for j in new:
                if self.held <= CACHE_BYTES:
                    self.known[names[j]] = ids[j]
                    self.held += len(names[j]) + len(ids[j]) + ENTRY_BYTES
        out, sums = gather(*join_bytes(ids, "<i4"), of)
        return out, sums[np.searchsorted(starts, moved)]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> pa.Array:
        """Texts of id lists; the one space that encoding puts before a text goes."""
        if not hasattr(self, "table"):
            self.table = join_bytes(self.bytes_of, "u1")
        flat, sums = gather(*self.table, ids)
        ends = sums[cuts]
        keep = np.ones(len(flat), bool)
        full = np.flatnonzero(np.diff(ends))
        keep[ends[:-1][full]] = flat[ends[:-1][full]] != 0x20
        offsets = np.concatenate(([0], np.cumsum(keep)))[ends].astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat[keep].tobytes())])


IDS, DECODED = T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())
#: Ids that are decoded at a time; a longer list is a piece of its own.
PIECE_IDS = 1_000_000


def _with(batch: pa.RecordBatch, **values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *values.values()], names=[*batch.schema.names, *values])


def _only_valid(value: pa.Array, like: pa.Array) -> pa.Array:
    """value with nulls where ``like`` has them."""
    import pyarrow.compute as pc

    return value if not like.null_count else pc.if_else(like.is_valid(), value, pa.scalar(None, value.type))


def _lists(cuts: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))


def _encoded(docs: DataFrame, model_path: str, text_col: str, back: bool) -> DataFrame:
    kept = docs.drop("ids", "decoded") if back else docs.drop("ids")
    at = kept.columns.index(text_col)

    def run(batches):
        model = Model.of(model_path)
        try:
            for batch in pieces(batches, at):
                ids, cuts = model.encode(batch.column(at))
                new = {"ids": _lists(cuts, ids)} | ({"decoded": model.decode(ids, cuts).cast(pa.string())} if back else {})
                yield _with(batch, **{name: _only_valid(x, batch.column(at)) for name, x in new.items()})
        finally:
            model.forget()
            release()

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, IDS, *([DECODED] if back else [])]))


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """docs with ids: array<int>. ``model_path`` is readable on every executor."""
    return _encoded(docs, model_path, text_col, False)


def round_trip(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """docs with ids and decoded, the text that the ids give back; one pass, in one worker a core."""
    return _encoded(docs, model_path, text_col, True)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids") -> DataFrame:
    """df with decoded: the text of its ids."""
    kept = df.drop("decoded")
    at = kept.columns.index(ids_col)

    def run(batches):
        import pyarrow.compute as pc

        model = Model.of(model_path)
        try:
            for whole in batches:
                lists = whole.column(at).fill_null([]) if whole.column(at).null_count else whole.column(at)
                sums = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
                part = sums[:-1] // PIECE_IDS
                edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows] if whole.num_rows else []
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    batch = whole.slice(a, b - a)
                    ids = lists.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                    yield _with(batch, decoded=_only_valid(model.decode(ids, sums[a : b + 1] - sums[a]).cast(pa.string()), batch.column(at)))
        finally:
            release()

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, DECODED]))
