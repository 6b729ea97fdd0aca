"""Operator 1, substring dedup: repeated-phrase automata.

1. Confirm recurring passages. Every text is cut into words; of every window of words the smallest
   hash of its 16-word runs is its anchor (winnowing), so equal windows have equal anchors. Anchors
   that occur once rule their windows out; the hashes of the rest are counted over the whole corpus.
   Both counts use the packed exchange of ``exchange.py``, which also tells the shards that hold a
   recurring window, as a ring: each learns which one comes next.
2. Supply passages. A shard of about 2 MB of text sends the words of its recurring passages to the next
   shard of the ring, one copy of each, so that every shard gets from elsewhere the passages that its
   documents can meet. A passage that a third of all texts hold is sent once by each shard.
3. Compile sharded automata. Each shard compiles one Aho-Corasick automaton (pyahocorasick) from the
   passages that it was sent, in tiles of one window; passages that only its own texts repeat it takes
   from these. Memory follows the shard, not the corpus.
4. Stream all documents of the shard through its automaton and mark the words of every occurrence. An
   occurrence of a passage from elsewhere proves the repeat word by word; one of an own passage needs a
   second. So hashes only choose what is looked for: texts that share a hash but not the words stay.

Defined results: null and empty texts have no words; a text shorter than a window keeps all of its
words; repeated rows are separate documents (each word of a repeated window goes in all of them);
extra columns are passed through, those named like ours are replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm import exchange as X
from newsflow.llm.textbytes import Words, distinct_spans, release, sliding

_U = np.uint64
WINDOW = 35
#: Words of the runs from which a window's anchor is chosen.
RUN = 16
ANCHORS, WINDOWS, PASSAGES = 0, 1, 2
#: Bytes of text per shard: a worker's memory is about 150 times that.
SHARD_BYTES = 2_000_000


class Windows:
    """The windows of a shard's texts with their anchors. texts: how many of the column's; the rest are passages from elsewhere."""

    def __init__(self, column, window: int, texts: int | None = None):
        self.words = Words(column)
        self.window, run = window, min(RUN, window)
        starts, _ = self.words.gram_starts(window)
        if texts is not None:
            starts = starts[: np.searchsorted(starts, self.words.first[texts])]
        runs = np.zeros(len(self.words.starts) + 1, _U)
        at = np.arange(max(0, len(self.words.starts) - run + 1))
        runs[at] = self.words.gram_hashes(at, run) & ~_U(1)
        self.starts = starts
        width = window - run + 1
        low = sliding(runs[: len(at)], width, np.minimum)  # low[p]: of the window at word p, also across texts
        self.anchors = low[starts] if len(starts) else np.zeros(0, _U)
        # a run is an anchor where it is the least of a window of its own text
        chosen = np.zeros(len(runs), bool)
        if len(starts):
            for j in range(width):
                chosen[starts + j] |= runs[starts + j] == self.anchors
        self.anchor_values = runs[chosen]

    def candidates(self, table: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Word positions and hashes of the windows whose anchor recurs."""
        sent = X.marked(self.anchor_values)
        good = sent[X.answers(table, ANCHORS, sent, buckets)] & ~_U(1)
        at = self.starts[np.isin(self.anchors, good)]
        self.hashes = self.words.all_grams(self.window) & ~_U(1)
        return at, self.hashes[at]


def _anchors(key, table: pa.Table, window: int, buckets: int) -> pa.Table:
    return X.packed(key[0].as_py(), ANCHORS, X.marked(Windows(table["__text"], window).anchor_values), buckets)


def _windows(key, table: pa.Table, replies: pa.Table, window: int, buckets: int) -> pa.Table:
    _, hashes = Windows(table["__text"], window).candidates(replies, buckets)
    return X.packed(key[0].as_py(), WINDOWS, X.marked(hashes), buckets)


def _letters(ids: np.ndarray, digits: int) -> str:
    """Word numbers as a text of ``digits`` letters each, every digit from an alphabet of its own."""
    out = np.empty((len(ids), digits), "<u4")
    for d in range(digits):
        out[:, d] = 0x100 + 64 * d + ((ids >> 6 * (digits - 1 - d)) & 63)
    return out.tobytes().decode("utf-32-le")


def _runs(at: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of neighbouring positions (sorted) with equal values. Windows of two texts are never neighbours."""
    new = np.concatenate(([True], np.diff(at) > 1))[: len(at)]
    for x in same:
        new[1:] |= x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at))[: len(first)] - 1] if len(first) else at[:0]


def _wrapped(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def _unwrapped(blob: bytes) -> list[str]:
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    ends = 4 * (n + 1) + np.cumsum(np.frombuffer(blob, "<u4", n, 4).astype(np.int64))
    return [blob[a:b].decode() for a, b in zip([4 * (n + 1), *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _supply(key, table: pa.Table, replies: pa.Table, window: int, buckets: int) -> pa.Table:
    """The words of a shard's recurring passages, for the shards that hold them next."""
    shard, own = Windows(table["__text"], window), key[0].as_py()
    at, hashes = shard.candidates(replies, buckets)
    sent = X.marked(hashes)
    recurs, partner = X.told_partners(replies, WINDOWS, sent, buckets)
    _, first = np.unique(hashes, return_index=True)
    some = recurs & (partner != own)
    place, to = at[first[some]], partner[some]
    order = np.argsort(place)
    place, to = place[order], to[order]
    begin, end = _runs(place, to)
    raw, parts = shard.words.flat.tobytes(), {}
    for a, b, shard_to in zip(begin.tolist(), end.tolist(), to[np.searchsorted(place, begin)].tolist(), strict=True):
        parts.setdefault(shard_to, []).append(raw[shard.words.starts[a] : shard.words.ends[b + window - 1]])
    release()
    return X.messages(list(parts), [PASSAGES] * len(parts), [own] * len(parts), [_wrapped(p) for p in parts.values()])


def patterns(tiles: np.ndarray, hashes: np.ndarray, given: np.ndarray, given_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tile (a word position) where the words of its pattern are taken from: the given passage with its hash if there is one, else the tile itself; and whether they were given."""
    order = np.argsort(given_hashes, kind="stable")
    at = np.minimum(np.searchsorted(given_hashes[order], hashes), max(0, len(given) - 1))
    found = given_hashes[order][at] == hashes if len(given) else np.zeros(len(tiles), bool)
    return np.where(found, given[order][at] if len(given) else tiles, tiles), found


def covered_words(words: Words, texts: int, recurring: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Which words of the first ``texts`` texts lie in an occurrence of a confirmed passage.

    The texts after those are the passages that other shards supplied. recurring: sorted word positions
    of the recurring windows of the first texts; hashes: of the windows at all positions.
    """
    n = int(words.first[texts])
    covered = np.zeros(n, bool)
    if not len(recurring):
        return covered
    begin, end = _runs(recurring)
    tiles = np.concatenate([np.append(np.arange(b, e, window), e) for b, e in zip(begin.tolist(), end.tolist(), strict=True)])
    starts, _ = words.gram_starts(window)
    given = starts[starts >= n]
    source, supplied = patterns(tiles, hashes[tiles], given, hashes[given])
    _, ids = distinct_spans(words.flat, words.starts, words.ends)
    digits = max(1, -(-int(ids.max()).bit_length() // 6))
    line = _letters(ids, digits)
    needed: dict[str, int] = {}
    for t, other in zip(source.tolist(), supplied.tolist(), strict=True):
        word = line[t * digits : (t + window) * digits]
        needed[word] = min(needed.get(word, 2), 1 if other else 2)
    automaton = ahocorasick.Automaton()
    for i, word in enumerate(needed):
        automaton.add_word(word, i)
    automaton.make_automaton()
    least, ends, which = np.array(list(needed.values())), [], []
    for a, b in zip(words.first[:texts].tolist(), words.first[1 : texts + 1].tolist(), strict=True):
        if b - a >= window:
            for e, i in automaton.iter(line[a * digits : b * digits]):
                ends.append(a + (e + 1) // digits)
                which.append(i)
    ends, which = np.array(ends, np.int64), np.array(which, np.int64)
    ends = ends[np.bincount(which, minlength=len(least))[which] >= least[which]] if len(ends) else ends
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, ends - window, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth)[:-1] > 0


def _remove(key, table: pa.Table, replies: pa.Table, window: int, buckets: int) -> pa.Table:
    texts = table["__text"].cast(pa.string())
    mail = sorted((b, x) for k, b, x in zip(replies["kind"].to_pylist(), replies["bucket"].to_pylist(), replies["blob"].to_pylist(), strict=True) if k == PASSAGES)
    passages = pa.array([p for _, blob in mail for p in _unwrapped(blob)], pa.string())
    shard = Windows(pa.chunked_array([*texts.chunks, passages]), window, len(texts))
    at, hashes = shard.candidates(replies, buckets)
    sent = X.marked(hashes)
    good = sent[X.told_partners(replies, WINDOWS, sent, buckets)[0]] & ~_U(1)
    recurring = at[np.isin(hashes, good)]
    words, n = shard.words, len(texts)
    covered = covered_words(words, n, recurring, shard.hashes, window)
    sums = np.concatenate(([0], np.cumsum(covered)))
    removed = sums[words.first[1 : n + 1]] - sums[words.first[:n]]
    keep = np.concatenate([~covered, np.zeros(len(words.starts) - len(covered), bool)])
    out = table.drop_columns(["__shard", "__text"])
    for name, value in (("n_words", pa.array(words.counts[:n], pa.int64())), ("n_removed", pa.array(removed, pa.int64())), ("kept_text", words.join(keep)[:n].cast(pa.string()))):
        out = out.append_column(f"__{name}", value)
    release()
    return out


def remove_repeats(docs: DataFrame, text_col: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all but the text, if not given) with n_words, n_removed and kept_text.

    Removed is every word covered by a window of ``window`` words whose word sequence also starts
    anywhere else in the corpus, the same text included. Words that stay are joined by one space.
    """
    keep = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed", "kept_text")] if keep is None else keep
    size = X.text_bytes(docs, text_col)
    # about a tenth of the words are anchors and a quarter of the windows are candidates
    n, buckets = X.shards_for(size, SHARD_BYTES), X.buckets_for(size / 24, X.least_buckets(docs.sparkSession))
    held = [F.col(c).alias(f"__c{i}") for i, c in enumerate(keep)]
    chosen_by = [F.col(c) for c, kind in docs.select(*keep, text_col).dtypes if "map<" not in kind and "variant" not in kind]
    dealt = docs.select(*held, F.col(text_col).alias("__text"), X.shard_of(n, *chosen_by).alias("__shard"))
    by_shard = dealt.groupBy("__shard")
    anchors = by_shard.applyInArrow(lambda key, table: _anchors(key, table, window, buckets), X.MESSAGE).groupBy("bucket").applyInArrow(lambda table: X.recurring(table), X.MESSAGE)
    windows = by_shard.cogroup(anchors.groupBy("shard")).applyInArrow(lambda key, table, replies: _windows(key, table, replies, window, buckets), X.MESSAGE).groupBy("bucket").applyInArrow(lambda table: X.partners(table), X.MESSAGE)
    told = anchors.unionByName(windows)
    passages = by_shard.cogroup(told.groupBy("shard")).applyInArrow(lambda key, table, replies: _supply(key, table, replies, window, buckets), X.MESSAGE)
    schema = T.StructType([T.StructField(f"__c{i}", docs.schema[c].dataType) for i, c in enumerate(keep)] + [T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()), T.StructField("__kept_text", T.StringType())])
    out = by_shard.cogroup(told.unionByName(passages).groupBy("shard")).applyInArrow(lambda key, table, replies: _remove(key, table, replies, window, buckets), schema)
    return out.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(keep)], F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__kept_text").alias("kept_text"))
