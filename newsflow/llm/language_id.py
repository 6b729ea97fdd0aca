"""Operator 5, language identification: a bidirectional gated recurrent network over bytes.

The network is trained here, in numpy, by backpropagation through time: one GRU reads the bytes
forwards, one backwards, and a linear layer on both states labels every position. A document's
probabilities are the mean over all its positions, so every byte of every text counts. Texts are read
in segments of SEGMENT bytes, many at a time, each with fresh states.

Training takes a bounded sample: MOST_TEXTS labelled texts, of each language about equally many (those
with the least hash of id and span; all of a rare language) and one at least, of each a span of SPAN
characters at a place that the id's hash chooses. So every language that has a labelled text is learned.

Defined results: a text that is null or has no letter is ``und`` with score 0; without a labelled text
everything is ``und``; repeated rows get equal predictions; ties go to the first language in
alphabetical order; an empty table gives an empty table.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm import sampling
from newsflow.llm.textbytes import pieces, release, texts_of

MOST_TEXTS, SPAN = 4000, 256
SEGMENT, TOGETHER = 64, 2048
HIDDEN, STEPS, BATCH, RATE = 8, 160, 192, 0.015
UNKNOWN = "und"


def _init(rng: np.random.Generator, hidden: int, n: int) -> dict[str, np.ndarray]:
    out = {}
    for side in "fb":
        out[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * hidden))
        out[f"u{side}"] = rng.normal(0, 0.3, (hidden, 2 * hidden))
        out[f"c{side}"] = rng.normal(0, 0.3, (hidden, hidden))
    out["v"], out["b"] = rng.normal(0, 0.3, (2 * hidden, n)), np.zeros(n)
    return {k: x.astype(np.float32) for k, x in out.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(p: dict, side: str, bytes_: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each byte, [position, text, unit]; backwards for side b. keep: gets what backpropagation needs."""
    hidden = p[f"c{side}"].shape[0]
    x, u, c = p[f"x{side}"], p[f"u{side}"], p[f"c{side}"]
    steps, n = bytes_.shape
    out = np.zeros((steps, n, hidden), np.float32)
    h = np.zeros((n, hidden), np.float32)
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        a = x[bytes_[t]]
        gates = _sigmoid(a[:, : 2 * hidden] + h @ u)
        z, r = gates[:, :hidden], gates[:, hidden:]
        rh = r * h
        new = np.tanh(a[:, 2 * hidden :] + rh @ c)
        if keep is not None:
            keep.append((t, h, gates, rh, new))
        h = h + z * (new - h)
        out[t] = h
    return out


def _back(p: dict, side: str, bytes_: np.ndarray, keep: list, d_out: np.ndarray, grad: dict) -> None:
    """Backpropagation through time of one direction."""
    hidden = p[f"c{side}"].shape[0]
    u, c = p[f"u{side}"], p[f"c{side}"]
    dh = np.zeros_like(d_out[0])
    for t, h, gates, rh, new in reversed(keep):
        dh = dh + d_out[t]
        z, r = gates[:, :hidden], gates[:, hidden:]
        d_new = dh * z * (1 - new * new)
        d_rh = d_new @ c.T
        d_gates = np.concatenate([dh * (new - h), d_rh * h], 1) * gates * (1 - gates)
        grad[f"c{side}"] += rh.T @ d_new
        grad[f"u{side}"] += h.T @ d_gates
        np.add.at(grad[f"x{side}"], bytes_[t], np.concatenate([d_gates, d_new], 1))
        dh = dh * (1 - z) + d_rh * r + d_gates @ u.T


@dataclasses.dataclass
class Model:
    langs: list[str]
    params: dict[str, np.ndarray]

    def positions(self, bytes_: np.ndarray) -> np.ndarray:
        """Probabilities of each language at each position: [position, text, language]."""
        states = np.concatenate([_run(self.params, "f", bytes_), _run(self.params, "b", bytes_)], 2)
        logits = states @ self.params["v"] + self.params["b"]
        logits -= logits.max(2, keepdims=True)
        np.exp(logits, out=logits)
        return logits / logits.sum(2, keepdims=True)

    def pooled(self, column) -> np.ndarray:
        """Mean probabilities of each whole text, [text, language]; zeros for empty texts."""
        flat, offsets = texts_of(column)
        size = np.diff(offsets)
        per = -(-size // SEGMENT)
        text = np.repeat(np.arange(len(size)), per)
        number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
        start = offsets[:-1][text] + number * SEGMENT
        length = np.minimum(SEGMENT, offsets[1:][text] - start)
        padded = np.concatenate([flat, np.zeros(SEGMENT, np.uint8)])
        # segments of like length together: short texts are not run to full length
        order = np.argsort(length, kind="stable")
        sums = np.zeros((len(text), len(self.langs)))
        for i in range(0, len(order), TOGETHER):
            some = order[i : i + TOGETHER]
            steps = int(length[some].max())
            at = np.arange(steps)[:, None]
            valid = at < length[some]
            probs = self.positions(np.where(valid, padded[start[some] + at], 0))
            sums[some] = np.einsum("tnk,tn->nk", probs, valid.astype(np.float32))
        out = np.zeros((len(size), len(self.langs)))
        np.add.at(out, text, sums)
        return out / np.maximum(size, 1)[:, None]

    def predict(self, column) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        probs = self.pooled(column)
        best = probs.argmax(1)
        return [self.langs[j] for j in best], np.clip(probs[np.arange(len(best)), best], 0, 1)


def train(texts: list[bytes], langs: list[str], seed: int = 7, steps: int = STEPS, hidden: int = HIDDEN) -> Model:
    """A network from labelled byte strings; languages weigh equally."""
    names = sorted(set(langs))
    if len(names) < 2:
        return Model(names, _init(np.random.default_rng(seed), hidden, max(1, len(names))))
    rng = np.random.default_rng(seed)
    by = [[t for t, k in zip(texts, langs, strict=True) if k == name and t] for name in names]
    params = _init(rng, hidden, len(names))
    m, v = ({k: np.zeros_like(x) for k, x in params.items()} for _ in range(2))
    for step in range(1, steps + 1):
        y = rng.integers(0, len(names), BATCH)
        bytes_, valid = np.zeros((SEGMENT, BATCH), np.int64), np.zeros((SEGMENT, BATCH), np.float32)
        for j, k in enumerate(y.tolist()):
            text = by[k][rng.integers(len(by[k]))] if by[k] else b""
            a = int(rng.integers(max(1, len(text) - SEGMENT + 1)))
            part = np.frombuffer(text[a : a + int(rng.integers(8, SEGMENT + 1))], np.uint8)
            bytes_[: len(part), j], valid[: len(part), j] = part, 1
        keeps: tuple[list, list] = ([], [])
        states = np.concatenate([_run(params, s, bytes_, k) for s, k in zip("fb", keeps, strict=True)], 2)
        logits = states @ params["v"] + params["b"]
        probs = np.exp(logits - logits.max(2, keepdims=True))
        probs /= probs.sum(2, keepdims=True)
        d = probs
        d[:, np.arange(BATCH), y] -= 1
        d *= valid[:, :, None] / max(1.0, valid.sum())
        grad = {k: np.zeros_like(x) for k, x in params.items()}
        grad["v"], grad["b"] = np.einsum("tnh,tnk->hk", states, d), d.sum((0, 1))
        d_states = d @ params["v"].T
        for s, k, part in zip("fb", keeps, (d_states[:, :, :hidden], d_states[:, :, hidden:]), strict=True):
            _back(params, s, bytes_, k, part, grad)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            params[k] = (params[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Model(names, params)


def fit(docs: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows for which ``may_learn`` holds and that have a language."""
    order = F.xxhash64("id")
    rows = docs.where(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    span = F.substring("text", (F.pmod(F.xxhash64("id", F.lit(1)), F.greatest(F.length("text") - SPAN, F.lit(1)).cast("long")) + 1).cast("int"), F.lit(SPAN))
    spans = rows.select(order.alias("o"), "id", span.alias("text"), "lang").withColumn("h", F.shiftrightunsigned(F.xxhash64("id", "text"), 11))
    # one row per language goes to the driver: its size and its first text
    per = spans.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "id", "text", "o")).alias("first")).collect()
    if not per:
        return train([], [])
    sizes = spans.sparkSession.createDataFrame([(r.lang, r.n) for r in per], "lang string, n long")
    place = F.col("h") / float(1 << 53) * F.col("n")  # about the row's place by hash within its language
    # of all partitions together little more than MOST_TEXTS rows pass and go to the driver
    limit = sampling.level([r.n for r in per], MOST_TEXTS)
    best = spans.join(F.broadcast(sizes), "lang").where(place <= limit + 6 * limit**0.5 + 40).orderBy(place, "id", "text", "lang").limit(MOST_TEXTS).select("o", "id", "text", "lang", "h").collect()
    first = {r.lang: (r.first.h, r.first.id, r.first.text) for r in per}
    sure = [(r.first.o, r.first.text, r.lang) for r in per]
    more = []
    for r in best:
        if first.get(r.lang) == (r.h, r.id, r.text):
            del first[r.lang]  # it is in already
        else:
            more.append((r.o, r.text, r.lang))
    found = sorted(sure + more[: max(0, MOST_TEXTS - len(sure))])
    return train([text.encode() for _, text, _ in found], [lang for _, _, lang in found])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and lang_score, from every whole text; they replace columns of those names."""
    kept = docs.drop("lang_pred", "lang_score")
    at = kept.columns.index(text_col)

    def run(batches):
        try:
            for batch in pieces(batches, at):
                langs, scores = model.predict(batch.column(at))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "lang_score"])
        finally:
            release()

    found = kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]))
    known = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)) & (F.col("lang_pred") != UNKNOWN)
    return found.withColumns({"lang_pred": F.when(known, F.col("lang_pred")).otherwise(UNKNOWN), "lang_score": F.when(known, F.col("lang_score")).otherwise(0.0)})
