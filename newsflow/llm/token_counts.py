"""Operator 12, token counts: prefix dynamic programming over byte-pair merges.

The count of every prefix of a text is stored, so that how long a text is, where it must be cut for a
budget, and how many ids any part of its beginning has are read off and nothing is encoded again.

A file of merges with word ends cuts a text into runs (of letters, of signs, single digits) and merges
inside each. The encoding of a run's prefix is unique, and neighbouring ids in it are such that the two
alone encode to themselves; a list of ids with that property is the encoding. So the state of a
prefix is its last id and its count: of all ids that end there, the one that may follow the state where
it begins. Each prefix has two states, within a run and as its end (ids with the word end). Whether two
ids may be neighbours is told from the merges that make them: no merge across the border may come
before those that use up its sides.

Distinct words of a batch are sorted, and a run keeps the states of what it shares with the one before.
A word's counts become steps, one signed byte for each code point: the change from the prefix that is
one shorter (no id is longer than 32 bytes, so a step is small; the count can also go down). Steps of all
words of a batch, gathered in the order of the texts, are the texts' steps; white space has none.

Composition (NFC) can join a character with marks that follow it. Words that are not composed are counted
prefix by prefix with the library between places that nothing joins across, which costs the square of the
length of such a stretch; so are the few prefixes that end inside a special token.

Defined results: null and empty texts have no ids and no steps; special strings inside texts are one id,
as the library has it; repeated rows are counted alike; other columns are dropped; an empty table gives an
empty table. Memory: a worker keeps the steps of CACHE_BYTES of words and PAIRS pairs.
"""

from __future__ import annotations

import heapq
import json
import math
import os
import re
import unicodedata
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.textbytes import Words, distinct_spans, gather, join_bytes, pieces, release, texts_of
from newsflow.llm.token_store import _at_signs, _lowered

#: Bytes of runs and words with their steps that a worker keeps, with ENTRY_BYTES for each; pairs of ids; bytes of text at a time.
CACHE_BYTES, ENTRY_BYTES, PAIRS, BATCH_BYTES = 150_000_000, 250, 400_000, 4_000_000
#: The file's pattern, for text of ASCII only; its contractions.
RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
_STATE: dict = {}


class Merges:
    """The merges of a tokenizers file of type BPE with word ends, and the counts of all prefixes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        model, self.end = spec["model"], spec["model"].get("end_of_word_suffix")
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        if model.get("type") != "BPE" or not self.end or not str((parts[0].get("pattern") or {}).get("Regex")).endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
            raise ValueError("token counts by prefix need a BPE file with word ends that splits letters, digits and signs")
        self.rank = {tuple(m): i for i, m in enumerate(model["merges"])}
        #: ids within a run, and those that end one (without the word end)
        self.inner = {x: i for x, i in model["vocab"].items() if not x.endswith(self.end)}
        self.last = {x[: -len(self.end)]: i for x, i in model["vocab"].items() if x.endswith(self.end)}
        self.names = {i: x for x, i in model["vocab"].items()}
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.ending = self._ending(self.inner), self._ending(self.last)
        #: for the last three characters that prefixes had, the lengths of ids within a run and at its end
        self.tails: dict[str, tuple] = {}
        self.trees: dict[int, tuple | None] = {}
        self.pairs: dict[int, bool] = {}
        self.runs: dict[str, bytes] = {}
        self.known: dict[bytes, bytes] = {}
        self.letters: dict[str, str] = {}
        self.held = 0
        self.byte_of = _byte_names()

    @staticmethod
    def of(path: str) -> Merges:
        if path not in _STATE:
            _STATE[path] = Merges(path)
        return _STATE[path]

    @staticmethod
    def _ending(names) -> dict[str, set[int]]:
        """By the last three characters of an id (or all of a shorter one), the lengths of such ids."""
        found: dict[str, set[int]] = {}
        for x in names:
            found.setdefault(x[-3:], set()).add(len(x))
        return found

    @staticmethod
    def _tail(found: dict[str, set[int]], tail: str) -> tuple[int, ...]:
        """By the last three characters of a prefix, the lengths of ids that may end there, longest first."""
        return tuple(sorted(set().union(*(found.get(tail[-k:], ()) for k in range(1, len(tail) + 1))), reverse=True))

    def forget(self) -> None:
        self.runs.clear()
        self.known.clear()
        self.letters.clear()
        self.held = 0

    def merged(self, parts: list[str]) -> list[tuple]:
        """What is left after all merges, as trees (text, rank of its merge, left, right); least rank first, leftmost first among equals."""
        part, n = [(p, -1, None, None) for p in parts], len(parts)
        before, after, heap = list(range(-1, n - 1)), list(range(1, n + 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (r := self.rank.get((part[i][0], part[after[i]][0]))) is not None:
                heapq.heappush(heap, (r, i, after[i], part[i], part[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, j, x, y = heapq.heappop(heap)
            if part[i] is not x or after[i] != j or part[j] is not y:
                continue
            part[i], part[j] = (x[0] + y[0], r, x, y), None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p]

    def _symbols(self, name: str) -> list[str]:
        return [*name[: -len(self.end) - 1], name[-len(self.end) - 1 :]] if name.endswith(self.end) else list(name)

    def _sides(self, i: int) -> tuple | None:
        """Of an id the parts at its left and right border as (text, made at, used up at); None: merging never makes it; (): its merges don't come in order."""
        if i not in self.trees:
            tree, found = self.merged(self._symbols(self.names[i])), None
            if len(tree) == 1:
                ordered = lambda t: t[2] is None or (t[1] > max(t[2][1], t[3][1]) and ordered(t[2]) and ordered(t[3]))
                sides = []
                for side in (2, 3):
                    parts, node, until = [], tree[0], math.inf
                    while node is not None:
                        parts.append((node[0], node[1], until))
                        until, node = node[1], node[side]
                    sides.append(parts)
                found = tuple(sides) if ordered(tree[0]) else ()
            self.trees[i] = found
        return self.trees[i]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether id b may come after id a (a < 0: at the start of a run)."""
        after = self._sides(b)
        if after is None or a < 0:
            return after is not None
        before = self._sides(a)
        if not before or not after:
            return [t[0] for t in self.merged(self._symbols(self.names[a]) + self._symbols(self.names[b]))] == [self.names[a], self.names[b]]
        for x, made_x, until_x in before[1]:
            for y, made_y, until_y in after[0]:
                # among equal ranks the left goes first
                if made_y < until_x and made_x <= until_y and (r := self.rank.get((x, y))) is not None and r < until_x and r <= until_y:
                    return False
        return True

    def _fits(self, a: int, b: int) -> bool:
        key = (a << 32) + b
        if (found := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = self.may_follow(a, b)
        return found

    def count_runs(self, runs: list[str]) -> None:
        """Keeps the steps of each of the runs."""
        state, count, ended, path = [-1], [0], [0], ""
        pairs, tails, find_in, find_last = self.pairs, self.tails, self.inner.get, self.last.get
        for run in sorted(runs):
            # bytes as the file names them; a prefix counts where a character ends
            spelt, ends = (run, None) if run.isascii() and run.isprintable() else self._spelt(run)
            shared, most = 0, min(len(path), len(spelt))
            while shared < most and path[shared] == spelt[shared]:
                shared += 1
            del state[shared + 1 :], count[shared + 1 :], ended[shared + 1 :]
            path = spelt
            for at in range(shared + 1, len(spelt) + 1):
                tail = spelt[at - 3 if at > 3 else 0 : at]
                if (sizes := tails.get(tail)) is None:
                    if len(tails) >= PAIRS:
                        tails.clear()
                    sizes = tails[tail] = (self._tail(self.ending[0], tail), self._tail(self.ending[1], tail))
                if ends is None or at in ends:
                    for n in sizes[1]:
                        if n <= at and (i := find_last(spelt[at - n : at])) is not None:
                            if (fits := pairs.get((state[at - n] << 32) + i)) is None:
                                fits = self._fits(state[at - n], i)
                            if fits:
                                ended.append(count[at - n] + 1)
                                break
                    else:
                        raise ValueError(f"no id ends {spelt[:at]!r}")
                else:
                    ended.append(ended[-1])
                for n in sizes[0]:
                    if n <= at and (i := find_in(spelt[at - n : at])) is not None:
                        if (fits := pairs.get((state[at - n] << 32) + i)) is None:
                            fits = self._fits(state[at - n], i)
                        if fits:
                            state.append(i)
                            count.append(count[at - n] + 1)
                            break
                else:
                    raise ValueError(f"no id within a run ends {spelt[:at]!r}")
            counts = ended if ends is None else [0, *(ended[e] for e in sorted(ends))]
            self.runs[run] = _steps(counts)
            self.held += 2 * len(run) + ENTRY_BYTES

    def _spelt(self, run: str) -> tuple[str, set[int]]:
        spelt, ends = [], set()
        for c in run:
            spelt += [self.byte_of[b] for b in c.encode()]
            ends.add(len(spelt))
        return "".join(spelt), ends

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _normal(self, c: str) -> str:
        if (found := self.letters.get(c)) is None:
            found = self.letters[c] = self.tokenizer.normalizer.normalize_str(c)
        return found

    def _cut(self, word: str) -> tuple[list[str], list[int], list[int]] | None:
        """The runs of a word without special strings, the code point of the word at which each begins, and for each code point the characters it has after lower-casing; None: composing changes it."""
        if word.isascii():
            low = word.lower()
            if low.isalpha():
                return [low], [0], []
            found = [(m[0], m.start()) for m in RUNS.finditer(low)]
            return [x for x, _ in found], [a for _, a in found], []
        if not unicodedata.is_normalized("NFC", word):
            return None
        parts = [self._normal(c) for c in word]
        low, whole = "".join(parts), self.tokenizer.normalizer.normalize_str(word)
        if low != whole and "".join(low.split()) != "".join(whole.split()):
            return None
        spans = [span for _, span in self.tokenizer.pre_tokenizer.pre_tokenize_str(low)]
        sizes = [len(p) for p in parts]
        return [low[a:b] for a, b in spans], [a for a, _ in spans], sizes if len(low) != len(word) or min(sizes) < 1 else []

    def _joined(self, cut, size: int) -> bytes:
        """The steps of a word of ``size`` code points from those of its runs; characters between runs have none."""
        runs, begins, sizes = cut
        if len(runs) == 1 and len(runs[0]) == size and not sizes:
            return self._run(runs[0])
        out, at = [], 0
        for run, a in zip(runs, begins, strict=True):
            out += [bytes(a - at), self._run(run)]
            at = a + len(run)
        if not sizes:
            return b"".join([*out, bytes(size - at)])
        # a character may be lower-cased to several, or to none of a run
        sums = np.concatenate(([0], np.cumsum(np.frombuffer(b"".join(out), np.int8), dtype=np.int64)))
        return _steps([0, *sums[np.minimum(np.cumsum(sizes), len(sums) - 1)].tolist()])

    def _run(self, run: str) -> bytes:
        if run in CONTRACTIONS:  # its prefixes are other runs
            return _steps([self.count(run[:n]) for n in range(len(run) + 1)])
        return self.runs[run]

    def _slowly(self, word: str) -> bytes:
        """Every prefix by the library, from the last place before it that neither composing nor a run spans."""
        out, base, start = [0], 0, 0
        for p in range(1, len(word) + 1):
            out.append(base + self.count(word[start:p]))
            if p < len(word) and word[p - 1 : p + 1].isascii() and "'" not in word[p - 1 : p + 1] and (word[p - 1].isalpha(), word[p - 1].isdigit()) != (word[p].isalpha(), word[p].isdigit()):
                base, start = out[-1], p
        return _steps(out)

    def _with_specials(self, word: str) -> bytes:
        """A word that holds special strings: what lies between them is a text of its own; a prefix that ends inside one is plain text up to there."""
        out, at = [], 0
        for found in self.special.finditer(word):
            plain = word[at : found.start()]
            out.append(self._plain(plain))
            before = self.count(plain)
            out.append(_steps([before, *(self.count(plain + found[0][:n]) for n in range(1, len(found[0]))), before + 1]))
            at = found.end()
        return b"".join([*out, self._plain(word[at:])])

    def _plain(self, word: str) -> bytes:
        cut = self._cut(word)
        self.count_runs(self._new(cut[0] if cut else ()))
        return self._joined(cut, len(word)) if cut else self._slowly(word)

    def _new(self, runs) -> list[str]:
        return [r for r in runs if r not in self.runs and r not in CONTRACTIONS]

    def steps_of(self, names: list[bytes]) -> list[bytes]:
        """The steps of each distinct word, one signed byte for each code point."""
        found = list(map(self.known.get, names))
        new = [j for j, x in enumerate(found) if x is None]
        if not new:
            return found
        if self.held > CACHE_BYTES:
            self.forget()
        words = [names[j].decode("utf-8", "replace") for j in new]
        special = [self.special is not None and self.special.search(w) is not None for w in words]
        cuts = [None if s else self._cut(w) for w, s in zip(words, special, strict=True)]
        self.count_runs(self._new({r for cut in cuts if cut for r in cut[0]}))
        for j, word, s, cut in zip(new, words, special, cuts, strict=True):
            found[j] = self._with_specials(word) if s else self._joined(cut, len(word)) if cut else self._slowly(word)
            if self.held <= CACHE_BYTES:
                self.known[names[j]] = found[j]
                self.held += len(names[j]) + len(found[j]) + ENTRY_BYTES
        self.runs.clear()  # words keep their steps
        return found


def _steps(counts: list[int]) -> bytes:
    """Changes from each count to the next, as signed bytes."""
    out = [b - a for a, b in pairwise(counts)]
    if out and not -128 <= min(out) <= max(out) < 128:
        raise ValueError("a step does not fit a byte")
    return bytes([x & 255 for x in out])


def _byte_names() -> list[str]:
    """The character by which byte-level files name each byte: printable Latin-1 by itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def steps(column, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Steps of all texts one after another, and where each text's begin (with the end as last)."""
    special = any(x.encode()[:2] in texts_of(column)[0].tobytes() for x in merges.specials)
    # a run never spans a Latin letter and a sign, and the case of A-Z doesn't matter, but where a special string may be spelt
    words = Words(column) if special else Words(column, breaks=_at_signs)
    if not special:
        words.flat = _lowered(words.flat)
    at, of = distinct_spans(words.flat, words.starts, words.ends)
    raw = words.flat.tobytes()
    names = list(map(raw.__getitem__, map(slice, words.starts[at].tolist(), words.ends[at].tolist())))
    found, _ = gather(*join_bytes(merges.steps_of(names), "i1"), of)
    points = (words.flat & 0xC0) != 0x80  # a code point begins here
    inside = np.zeros(len(words.flat) + 1, np.int8)
    inside[words.starts] += 1
    inside[words.ends] -= 1
    out = np.zeros(int(points.sum()), np.int8)
    out[(np.cumsum(inside[:-1]) > 0)[points]] = found
    before = np.concatenate(([0], np.cumsum(points)))
    return out, before[words.offsets]


def cuts(counts: np.ndarray, edges: np.ndarray, limit: int) -> np.ndarray:
    """Of texts whose steps are summed up in counts (all texts one after another): code points of the longest prefix of at most ``limit`` ids."""
    base = np.concatenate(([0], counts))[edges[:-1]]
    within = np.flatnonzero(counts - np.repeat(base, np.diff(edges)) <= limit)
    last = np.searchsorted(within, edges[1:]) - 1
    place = np.where(last >= 0, within[last] if len(within) else -1, -1)
    return np.where(place >= edges[:-1], place + 1 - edges[:-1], 0)


def _count(batches, path: str, limits: tuple[int, ...], stored: bool):
    merges = Merges.of(path)
    try:
        for batch in pieces(batches, "__text", BATCH_BYTES):
            column = batch.column("__text")
            found, edges = steps(column, merges)
            counts = np.cumsum(found, dtype=np.int64)
            sums = np.concatenate(([0], counts))
            out = [batch.column("__id"), pa.array(np.diff(texts_of(column)[1]), pa.int64()), pa.array(np.diff(edges), pa.int64()), pa.array(sums[edges[1:]] - sums[edges[:-1]], pa.int64())]
            out += [pa.array(cuts(counts, edges, x), pa.int64()) for x in limits]
            if stored:
                raw = found.tobytes()
                out.append(pa.array([raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(out, names=["id", "n_bytes", "n_chars", "n_tokens", *(f"cut_{x}" for x in limits), *["steps"] * stored])
    finally:
        release()


def prefix_counts(docs: DataFrame, path: str, limits: tuple[int, ...] = (), stored: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, n_bytes, n_chars (code points), n_tokens, for each limit cut_<limit> (code points of the longest prefix within it) and, if stored, the steps of every prefix. ``path`` is readable on every executor."""
    kind = docs.schema[id_col].dataType
    fields = [("n_bytes", T.LongType()), ("n_chars", T.LongType()), ("n_tokens", T.LongType()), *((f"cut_{x}", T.LongType()) for x in limits), *[("steps", T.BinaryType())] * stored]
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, t) for n, t in fields)])
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return rows.mapInArrow(lambda batches: _count(batches, path, limits, stored), schema).withColumnRenamed("id", id_col)


def _asked(batches, limit: str, position: str):
    for batch in batches:
        kept, told = [], []
        for raw, most, at in zip(batch.column("steps").to_pylist(), batch.column(limit).to_pylist(), batch.column(position).to_pylist(), strict=True):
            counts = np.cumsum(np.frombuffer(raw or b"", np.int8), dtype=np.int64)
            fit = np.flatnonzero(counts <= most) if most is not None else ()
            kept.append(None if most is None or most < 0 else int(fit[-1]) + 1 if len(fit) else 0)
            told.append(None if at is None else int(counts[min(at, len(counts)) - 1]) if min(at, len(counts)) > 0 else 0)
        yield batch.append_column("fits", pa.array(kept, pa.int64())).append_column("tokens_at", pa.array(told, pa.int64()))


def ask(counted: DataFrame, limit: str, position: str) -> DataFrame:
    """Rows of ``prefix_counts`` with a column of budgets and one of positions: adds fits (code points of the longest prefix within the budget) and tokens_at (ids of the first ``position`` code points), from the steps alone. Null asks get null."""
    return counted.mapInArrow(lambda batches: _asked(batches, limit, position), T.StructType([*counted.schema.fields, T.StructField("fits", T.LongType()), T.StructField("tokens_at", T.LongType())]))
