"""Operator 4, toxicity: non-negative positive-unlabelled learning.

``fit`` learns a linear classifier of word presence in numpy from confirmed toxic texts and texts
without any label. Risk (logistic loss l, class prior p): p E_pos[l(g)] + max(0, E_unl[l(-g)] -
p E_pos[l(-g)]); where the bracket goes negative its gradient is reversed, which stops the model from
fitting the unlabelled sample. The prior is the toxic share of the labelled rows that may be learned.

Features are lower-cased runs of letters and their beginnings of PREFIXES bytes (which carry the stem
where endings vary), by 64-bit hash: those that confirmed texts hold significantly more often than
unlabelled ones. Where more than MOST_FEATURES pass that test, the most significant are taken; that
bounds the training matrix (9,000 by 4,096 numbers of 4 bytes).

Training takes bounded samples: MOST_POSITIVE confirmed texts and MOST_UNLABELLED others, those with
the least hash of their id, one row an id, whole texts. Features are counted on the executors; the
driver gets the chosen ones and, of each text of the sample, which of these it holds.
Scoring reads every whole text of all rows, in one pass without a shuffle.

Defined results: null and empty texts get the score of a text without any known feature; without any
confirmed text every score is the prior; repeated rows get equal scores; labels of one id that
contradict each other count as toxic if any does; an empty table gives an empty table.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm import sampling, storage
from newsflow.llm.textbytes import NO_LETTER, Words, byte_hashes, pieces, release

MOST_POSITIVE, MOST_UNLABELLED, MOST_FEATURES = 3000, 6000, 4096
PREFIXES = (4, 5, 6)
#: A feature occurs in so many confirmed texts, so many standard deviations above its share elsewhere.
LEAST_TEXTS, LEAST_DEVIATIONS = 3, 5.0
#: At least so much of the texts that hold a feature is estimated to be toxic.
LEAST_SHARE = 0.6
STEPS, RATE, DECAY = 400, 0.05, 1e-4
TOXIC_FROM = 0.7


@dataclasses.dataclass
class Model:
    words: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, column) -> np.ndarray:
        text, word = _presence(column, self.words)
        n = len(column)
        g = self.bias + np.bincount(text, self.weights[word], minlength=n)[:n] if len(text) else np.full(n, self.bias)
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _features(column) -> tuple[Words, np.ndarray, np.ndarray]:
    """The words of a column, their feature hashes and the word of each."""
    words = Words(column, lower=True, between=NO_LETTER)
    length = words.ends - words.starts
    longer = [np.flatnonzero(length > k) for k in PREFIXES]
    starts = np.concatenate([words.starts, *[words.starts[x] for x in longer]])
    ends = np.concatenate([words.ends, *[words.starts[x] + k for x, k in zip(longer, PREFIXES, strict=True)]])
    return words, byte_hashes(words.flat, starts, ends), np.concatenate([np.arange(len(length)), *longer])


def _presence(column, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, index of a known word) pairs."""
    words, hashes, word = _features(column)
    if not len(known) or not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # a table over the upper 16 bits leaves few hashes for the exact search
    maybe = np.zeros(1 << 16, bool)
    maybe[known >> np.uint64(48)] = True
    some = np.flatnonzero(maybe[hashes >> np.uint64(48)])
    at = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
    hit = known[at] == hashes[some]
    text, at = np.searchsorted(words.first, word[some[hit]], "right") - 1, at[hit]
    pairs = np.unique(text * len(known) + at)
    return pairs // len(known), pairs % len(known)


def _counts(batches):
    """(feature, confirmed texts, other texts that hold it) of each slice."""
    for batch in pieces(batches, "text"):
        words, hashes, word = _features(batch.column("text"))
        text = np.searchsorted(words.first, word, "right") - 1
        order = np.lexsort((text, hashes))
        hashes, text = hashes[order], text[order]
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])))[: len(hashes)]
        found, of = np.unique(hashes[new], return_inverse=True)
        positive = batch.column("positive").to_numpy(zero_copy_only=False).astype(bool)[text[new]]
        both = [np.bincount(of, x, len(found)).astype(np.int64) for x in (positive, ~positive)]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *map(pa.array, both)], names=["feature", "often", "seldom"])


def _held(batches, known: np.ndarray):
    """Of each text, the known features that it holds."""
    for batch in pieces(batches, "text"):
        text, at = _presence(batch.column("text"), known)
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array([at[a:b].tolist() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.list_(pa.int32()))], names=["positive", "at"])


def nnpu(pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam over the full samples."""
    pos, unl = (np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32) for x in (pos, unl))
    w = np.zeros(pos.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        p, u = 1 / (1 + np.exp(-(pos @ w.astype(np.float32)))), 1 / (1 + np.exp(-(unl @ w.astype(np.float32))))
        # l(-g) = log(1 + e^g): mean over the unlabelled less the prior times the mean over the confirmed
        rest = np.mean(-np.log1p(-np.minimum(u, 1 - 1e-7))) - prior * np.mean(-np.log1p(-np.minimum(p, 1 - 1e-7)))
        up = prior * (pos.T @ (p - 1)) / len(pos)
        down = (unl.T @ u) / len(unl) - prior * (pos.T @ p) / len(pos)
        grad = (up + down if rest >= 0 else -down).astype(float)
        grad[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labels of rows for which ``may_learn`` (over the labels' id column) holds."""
    known = labels.where(may_learn).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic")).where(F.col("toxic").isNotNull())
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    prior = min(max((toxic + 0.5) / (n + 1), 1e-4), 1 - 1e-4)
    confirmed = sampling.least(known.where("toxic = 1").select("id"), MOST_POSITIVE, toxic, "id").withColumn("positive", F.lit(True))
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null")
    others = sampling.least(ids, MOST_UNLABELLED, ids.count(), "id").withColumn("positive", F.lit(False))
    # both sides are bounded samples
    chosen = F.broadcast(confirmed.unionByName(others).distinct())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id").groupBy("id", "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    path = storage.new_dir(docs.sparkSession, "toxic")
    sample = storage.written(rows.select("positive", "text"), path)
    try:
        return learn(sample, prior)
    finally:
        storage.remove(docs.sparkSession, path)


def learn(sample: DataFrame, prior: float) -> Model:
    """A model from a bounded sample of confirmed and unlabelled texts (positive, text)."""
    n_pos, n_unl = sample.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    if not n_pos or not n_unl:
        return nothing
    counts = sample.mapInArrow(_counts, "feature long, often long, seldom long").groupBy("feature").agg(F.sum("often").alias("often"), F.sum("seldom").alias("seldom"))
    p, q = F.col("often") / n_pos, (F.col("seldom") + 1) / (n_unl + 1)
    deviations = (p - q) / F.sqrt(q * (1 - q) / n_pos + q / n_unl)
    # prior * p / q estimates the toxic share of the texts that hold a feature
    good = counts.where(F.col("often") >= LEAST_TEXTS).withColumn("d", deviations).where((F.col("d") >= LEAST_DEVIATIONS) & (prior * p >= LEAST_SHARE * q))
    best = [r.feature for r in good.orderBy(F.desc("d"), "feature").limit(MOST_FEATURES).select("feature").collect()]
    chosen = np.sort(np.array(best, np.int64).view(np.uint64))
    rows = sample.mapInArrow(lambda batches: _held(batches, chosen), "positive boolean, at array<int>").collect()  # MOST_POSITIVE + MOST_UNLABELLED short lists

    def matrix(positive: bool) -> np.ndarray:
        lists = sorted(r.at for r in rows if r.positive == positive)
        out = np.zeros((len(lists), len(chosen)), np.float32)
        for row, at in zip(out, lists, strict=True):
            row[at] = 1
        return out

    weights, bias = nnpu(matrix(True), matrix(False), prior)
    return Model(chosen, weights, bias, prior)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a score of 0 to 1 for every whole text; the score column replaces one of its name."""
    names = [c for c in docs.columns if c != score_col]
    at = docs.select(*names).columns.index(text_col)

    def run(batches):
        try:
            yield from scored(batches)
        finally:
            release()

    def scored(batches):
        for batch in pieces(batches, at):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(batch.column(at)), pa.float64())], names=[*batch.schema.names, score_col])

    return docs.select(*names).mapInArrow(run, T.StructType([*docs.select(*names).schema.fields, T.StructField(score_col, T.DoubleType())]))
