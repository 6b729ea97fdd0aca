"""Operator 6, token-id output: a content-addressed store of id streams.

``build`` encodes every whole text with a ``tokenizers`` file, appends an end id, and cuts each
document's ids into chunks where a rolling hash over the last eight ids says so, so that equal runs
of ids in different documents are cut alike. It writes three Parquet tables under one folder:

* ``chunks``: sha (SHA-256 of the payload), n (ids), payload (ids as little-endian unsigned 16- or
  32-bit integers, by the size of the vocabulary). Each distinct chunk once.
* ``recipes``: documents in ascending id order, file after file: the id, part (number of the file
  range; a part has about PART_IDS ids), node (run of documents of the part), local_start, n_tokens, chunks (sha and the number of ids after it in the document), root
  (Merkle root of the document's chunk hashes).
* ``manifest``: per part n_docs, n_tokens and root (Merkle root over its nodes, and these over their documents).

``read`` goes back from the files: it checks every payload against its SHA-256, every document and
part against its Merkle root, that every document's chunks are there with all its ids, and returns start, n_tokens and the CRC-32 of the ids per document;
``read_ids`` rebuilds the ids themselves, and raises too where some are missing.

Encoding: the tokenizers file drops white space and never joins ids across it, nor across a Latin
letter and an ASCII sign, so a text's ids are those of such words one after another, in any case of
A-Z. A batch encodes its distinct words once. ``splits_on_space`` checks that property of a file;
others, and slices in which a special token may be spelt, are encoded more plainly.

Defined results: null and empty texts have the end id only; documents that repeat an id follow one
another in the order of a hash of their text; a null id comes first; an empty table gives empty
tables.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm import storage
from newsflow.llm.textbytes import LOWER, Words, distinct_spans, gather, join_bytes, mix, pieces, release, rolling_hashes, texts_of

_U = np.uint64
#: Ids of the rolling hash; a cut follows where its hash modulo AVERAGE is 0; bounds of a chunk.
ROLL, AVERAGE, LEAST, MOST = 8, 256, 64, 2048
#: Bytes of distinct words and their ids that a worker keeps, from task to task, with ENTRY_BYTES for each;
#: it starts anew beyond that.
CACHE_BYTES, ENTRY_BYTES = 150_000_000, 250
#: Words that are encoded in one text.
TOGETHER = 100
#: Bytes of text whose words are told apart at a time.
BATCH_BYTES = 8_000_000
#: Ids that a part of the store holds on average, and documents of one node of its hash tree.
PART_IDS, NODE_DOCS = 20_000_000, 10_000
_STATE: dict = {}


def splits_on_space(path: str) -> bool:
    """Whether no id of this file can span white space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    added = [t for t in spec.get("added_tokens", []) if any(c.isspace() for c in t["content"])]
    first = steps[0]
    return not added and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert")) and str((first.get("pattern") or {}).get("Regex")).endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


#: Words that a tokenizers file as below takes as they are: small Latin letters, composed, of U+0000 to U+00FF.
PLAIN = re.compile("[a-zß-öø-ÿ]+")


def for_plain(spec: dict) -> dict | None:
    """Of a file that splits on space, one that gives PLAIN words with single spaces between them the same ids
    without normalising them or matching the pattern, which finds each of them whole. None: not told of this file."""
    normal, steps = spec.get("normalizer") or {}, spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]]
    keeps = all(n.get("type") in ("NFC", "Lowercase") or (n.get("type"), n.get("pattern"), n.get("content")) == ("Replace", {"Regex": r"\s+"}, " ") for n in normal.get("normalizers") or [normal] if n)
    before = steps[0]["pattern"]["Regex"].removesuffix(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").split("|")
    if not keeps or any(x and not re.fullmatch("'[a-z]+", x) for x in before) or any(t.get("type") != "ByteLevel" or t.get("use_regex", True) or t.get("add_prefix_space", True) for t in steps[1:]):
        return None
    return spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *steps[1:]]}}


_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def _at_signs(flat: np.ndarray) -> np.ndarray:
    """Where a Latin letter meets an ASCII sign other than the apostrophe: the file's pattern always splits there."""
    out = np.zeros(len(flat), bool)
    letter, sign = _LETTER[flat], _SIGN[flat]
    latin = np.zeros(len(flat), bool)  # second byte of a letter U+00C0 to U+00FF
    latin[1:] = (flat[:-1] == 0xC3) & (flat[1:] >= 0x80) & (flat[1:] < 0xC0) & (flat[1:] != 0x97) & (flat[1:] != 0xB7)
    out[1:] = ((letter | latin)[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
    return out


def _lowered(flat: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but before a character from U+0100 on: the file composes first, and a capital and its mark may be composed where the small letter isn't, or the other way round."""
    out = LOWER[flat]
    keep = np.flatnonzero(flat[1:] >= 0xC4)
    out[keep] = flat[keep]
    return out


class Encoder:
    """Encodes batches of texts to ids; one per worker and file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_on_space(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.lower = self.by_word and any(n.get("type") == "Lowercase" for n in (json.loads(self.tokenizer.to_str()).get("normalizer") or {}).get("normalizers", []))
        self.known: dict[bytes, bytes] = {}
        self.held = 0
        # marks the ids that end a word, where the file has such; a run of letters is one word of it
        spec = json.loads(self.tokenizer.to_str()) if self.by_word else {}
        suffix = spec["model"].get("end_of_word_suffix") if self.by_word else None
        bare = for_plain(spec) if suffix else None
        self.bare = Tokenizer.from_str(json.dumps(bare)) if bare else None
        self.last = np.zeros(self.size, bool)
        if suffix:
            self.last[[i for x, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if x.endswith(suffix)]] = True
        # a special token parts other words of one text; without a fit one every word is a text of its own
        special = [(i, x.content) for i, x in self.tokenizer.get_added_tokens_decoder().items() if x.special]
        tried = [(i, s) for i, s in special if self._call([f"ab{s}c1{s}d"])[0].ids == sum((self._call([x])[0].ids for x in ("ab", s, "c1", s, "d")), [])]
        self.fence = tried[0] if tried else None

    def _call(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def _parted(self, names: list[str], sign: str, ends, call) -> list[bytes]:
        """Ids of each word, TOGETHER words in one text: of its ids, ends gives where the words begin and end.
        Words of a text that does not come out as so many are encoded one by one."""
        out = []
        groups = [names[i : i + TOGETHER] for i in range(0, len(names), TOGETHER)]
        for group, e in zip(groups, call([sign.join(g) for g in groups]), strict=True):
            ids = np.array(e.ids, "<u4")
            first, end = ends(ids)
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip(first, end, strict=True)] if len(first) == len(group) else self._alone(group)
        return out

    def _call_bare(self, texts: list[str]):
        return self.bare.encode_batch_fast(texts, add_special_tokens=False)

    def _alone(self, names: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self._call(names)]

    def _at_ends(self, ids: np.ndarray) -> tuple[list[int], list[int]]:
        at = (np.flatnonzero(self.last[ids]) + 1).tolist()
        return [0, *at[:-1]], at

    def _at_fences(self, ids: np.ndarray) -> tuple[list[int], list[int]]:
        at = np.flatnonzero(ids == self.fence[0])
        return [0, *(at + 1).tolist()], [*at.tolist(), len(ids)]

    def words(self, names: list[str], apart: bool) -> list[bytes]:
        """Ids of each word. apart: words in which a special token may be spelt, each a text of its own.

        Each word has an id at least, and a word of letters ends in one id that ends a word, unless lower
        case breaks it up. So if a text has as many ends as words, each word has just one of them.
        """
        if apart:
            return self._alone(names)
        letters = np.fromiter(map(str.isalpha, names), bool, len(names)) & self.last.any()
        plain = letters & np.fromiter((m is not None for m in map(PLAIN.fullmatch, names)), bool, len(names)) & (self.bare is not None)
        out = [b""] * len(names)
        for some, sign, ends, call in ((plain, " ", self._at_ends, self._call_bare), (letters & ~plain, " ", self._at_ends, self._call), (~letters, self.fence and self.fence[1], self._at_fences, self._call)):
            at = np.flatnonzero(some).tolist()
            part = [names[i] for i in at]
            if not part:
                continue
            for i, x in zip(at, self._alone(part) if sign is None else self._parted(part, sign, ends, call), strict=True):
                out[i] = x
        return out

    def forget(self) -> None:
        self.known.clear()
        self.held = 0

    @staticmethod
    def of(path: str) -> Encoder:
        if path not in _STATE:
            _STATE[path] = Encoder(path)
        return _STATE[path]

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of each text."""
        if not self.by_word:
            found = self.tokenizer.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)
            return np.array([i for e in found for i in e.ids], np.uint32), np.array([len(e.ids) for e in found], np.int64)
        plain = b"<|" in texts_of(column)[0].tobytes()  # a special token may be spelt here
        words = Words(column) if plain else Words(column, breaks=_at_signs)
        if self.lower and not plain:
            words.flat = _lowered(words.flat)
        at, of = distinct_spans(words.flat, words.starts, words.ends)
        raw = words.flat.tobytes()
        names = list(map(raw.__getitem__, map(slice, words.starts[at].tolist(), words.ends[at].tolist())))
        ids = list(map(self.known.get, names))
        new = [j for j, x in enumerate(ids) if x is None]
        if new:
            for j, x in zip(new, self.words([names[j].decode("utf-8", "replace") for j in new], plain), strict=True):
                ids[j] = x
            if self.held > CACHE_BYTES:
                self.forget()
            for j in new:
                if self.held <= CACHE_BYTES:
                    self.known[names[j]] = ids[j]
                    self.held += len(names[j]) + len(ids[j]) + ENTRY_BYTES
        flat, sums = gather(*join_bytes(ids, "<u4"), of)
        return flat, sums[words.first[1:]] - sums[words.first[:-1]]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with end_id after those of each text."""
    sums = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.empty(sums[-1], np.uint32)
    last = np.zeros(sums[-1], bool)
    last[sums[1:] - 1] = True
    out[last] = end_id
    out[~last] = ids
    return out, sums


def cuts(ids: np.ndarray, sums: np.ndarray) -> list[list[int]]:
    """For each document, the ends of its chunks as positions in ids."""
    at = np.arange(max(0, len(ids) - ROLL + 1))
    rolled = rolling_hashes(mix(ids), ROLL)
    marks = at[rolled % _U(AVERAGE) == 0] + ROLL
    out, near = [], np.searchsorted(marks, sums)
    for a, b, lo, hi in zip(sums[:-1].tolist(), sums[1:].tolist(), near[:-1].tolist(), near[1:].tolist(), strict=True):
        ends, start = [], a
        for m in [*marks[lo:hi].tolist(), b]:
            if m - ROLL < a:  # the rolling hash would look into the document before
                continue
            while m - start > MOST:
                start += MOST
                ends.append(start)
            if m - start >= LEAST and m < b:
                start = m
                ends.append(m)
        out.append([*ends, b] if not ends or ends[-1] < b else ends)
    return out


def merkle(leaves: list[bytes]) -> bytes:
    """Root of the binary hash tree over the leaves; an odd last node goes up as it is."""
    level = [hashlib.sha256(b"\0" + x).digest() for x in leaves] or [hashlib.sha256(b"").digest()]
    while len(level) > 1:
        pairs = [hashlib.sha256(b"\1" + level[i] + level[i + 1]).digest() for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


CHUNK = pa.struct([("sha", pa.binary()), ("n", pa.int64()), ("after", pa.int64()), ("payload", pa.binary())])


def _encode(batches, path: str, end_id: int, id_type):
    """__id, __tie, text -> __id, __tie, n_tokens, chunks with payloads, root."""
    encoder = Encoder.of(path)
    width = np.dtype("<u2" if max(encoder.size, end_id + 1) <= 1 << 16 else "<u4")
    try:
        yield from _chunked(batches, encoder, width, end_id)
    finally:
        release()


def _chunked(batches, encoder: Encoder, width: np.dtype, end_id: int):
    for batch in pieces(batches, "__text", BATCH_BYTES):
        ids, sums = with_end(*encoder.encode(batch.column("__text")), end_id)
        raw, per_doc = ids.astype(width), cuts(ids, sums)
        sizes = np.concatenate(([0], np.cumsum([len(x) for x in per_doc]))).astype(np.int64)
        ends = np.fromiter(chain.from_iterable(per_doc), np.int64, sizes[-1])
        edges, data = np.concatenate(([0], ends)) * width.itemsize, memoryview(raw).cast("B")
        shas = [hashlib.sha256(data[a:b]).digest() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        roots = [merkle(shas[a:b]) for a, b in zip(sizes[:-1].tolist(), sizes[1:].tolist(), strict=True)]
        # the payloads lie one after another in the ids
        payloads = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(raw)])
        flat = [pa.array(shas, pa.binary()), pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(np.repeat(sums[1:], np.diff(sizes)) - ends, pa.int64()), payloads]
        chunks = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(flat, fields=list(CHUNK)))
        yield pa.RecordBatch.from_arrays([batch.column("__id"), batch.column("__tie"), pa.array(np.diff(sums), pa.int64()), chunks, pa.array(roots, pa.binary())], names=["__id", "__tie", "n_tokens", "chunks", "root"])


def _starts(batches):
    """Numbers a sorted part's documents: local_start is the ids of the part's documents before, node a run of NODE_DOCS documents."""
    total, count = 0, 0
    for batch in batches:
        n = batch.column("n_tokens").to_numpy()
        batch = batch.append_column("local_start", pa.array(total + np.cumsum(n) - n, pa.int64()))
        yield batch.append_column("node", pa.array((count + np.arange(len(n))) // NODE_DOCS, pa.int64()))
        total += int(n.sum())
        count += len(n)


def _node_root(key, table: pa.Table) -> pa.Table:
    """Root of the hash tree over at most NODE_DOCS documents of a part."""
    order = np.argsort(table["local_start"].to_numpy(), kind="stable")
    roots = table["root"].to_pylist()
    return pa.table({"part": [key[0].as_py()], "node": [key[1].as_py()], "n_docs": [len(roots)], "n_tokens": [int(table["n_tokens"].to_numpy().sum())], "root": [merkle([roots[i] for i in order])]})


NODES = "part long, node long, n_docs long, n_tokens long, root binary"


def _part_root(key, table: pa.Table) -> pa.Table:
    """Root over a part's nodes, in order."""
    order = np.argsort(table["node"].to_numpy(), kind="stable")
    roots = table["root"].to_pylist()
    return pa.table({"part": [key[0].as_py()], "n_docs": [int(table["n_docs"].to_numpy().sum())], "n_tokens": [int(table["n_tokens"].to_numpy().sum())], "root": [merkle([roots[i] for i in order])]})


def _manifest(recipes: DataFrame) -> DataFrame:
    """Per part its size and root; a task holds the hashes of NODE_DOCS documents, or of one part's nodes."""
    nodes = recipes.select("part", "node", "local_start", "n_tokens", "root").groupBy("part", "node").applyInArrow(lambda key, table: _node_root(key, table), NODES)
    return nodes.groupBy("part").applyInArrow(lambda key, table: _part_root(key, table), MANIFEST)


MANIFEST = "part long, n_docs long, n_tokens long, root binary"


def build(docs: DataFrame, tokenizer_path: str, end_id: int, out_dir: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Writes the store of ``docs`` under ``out_dir`` and returns it. ``tokenizer_path`` is readable on every executor."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    chunk = "array<struct<sha: binary, n: long, after: long, payload: binary>>"
    schema = T.StructType([T.StructField("__id", id_type), T.StructField("__tie", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("chunks", T._parse_datatype_string(chunk)), T.StructField("root", T.BinaryType())])
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text_col).alias("__tie"), F.col(text_col).alias("__text"))
    staged = storage.written(rows.mapInArrow(lambda batches: _encode(batches, tokenizer_path, end_id, id_type), schema), f"{out_dir}/staged")
    # the same chunk leaves a task once, however many documents hold it
    staged.select(F.explode("chunks").alias("c")).select("c.sha", "c.n", "c.payload").dropDuplicates(["sha"]).write.option("compression", "zstd").parquet(f"{out_dir}/chunks")
    light = staged.select("__id", "__tie", "n_tokens", F.transform("chunks", lambda c: F.struct(c["sha"].alias("sha"), c["after"].alias("after"))).alias("chunks"), "root")
    n_parts = max(1, -(-staged.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0] // PART_IDS))
    parts = light.repartitionByRange(n_parts, "__id", "__tie").sortWithinPartitions("__id", "__tie", "root").withColumn("part", F.spark_partition_id().cast("long"))
    kept = T.StructType([*parts.schema.fields, T.StructField("local_start", T.LongType()), T.StructField("node", T.LongType())])
    recipes = storage.written(parts.mapInArrow(_starts, kept), f"{out_dir}/recipes")
    storage.written(_manifest(recipes), f"{out_dir}/manifest")
    storage.remove(spark, f"{out_dir}/staged")
    return out_dir


def starts_of(spark: SparkSession, out_dir: str) -> list[tuple[int, int, int]]:
    """(part, first id, ids) of each part: one row per file range of the store."""
    total, out = 0, []
    for part, n in sorted((r.part, r.n_tokens) for r in spark.read.parquet(f"{out_dir}/manifest").select("part", "n_tokens").collect()):
        out.append((part, total, n))
        total += n
    return out


def _checked(batches):
    """Chunks as read: their ids are what their hash says, and the CRC-32 of those ids as 32-bit integers."""
    for batch in batches:
        shas, payloads, ns = batch.column("sha").to_pylist(), batch.column("payload").to_pylist(), batch.column("n").to_pylist()
        crcs = []
        for sha, payload, n in zip(shas, payloads, ns, strict=True):
            if hashlib.sha256(payload).digest() != sha:
                raise ValueError(f"chunk {sha.hex()} does not hold what it is named for")
            crcs.append(zlib.crc32(np.frombuffer(payload, f"<u{len(payload) // n}").astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays([batch.column("sha"), batch.column("n"), pa.array(crcs, pa.int64())], names=["sha", "n", "crc"])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over GF(2) modulo the CRC-32 polynomial, in its reflected form."""
    out, b = np.zeros(len(a), np.uint32), b.astype(np.uint32).copy()
    for bit in range(31, -1, -1):
        out ^= np.where((a >> np.uint32(bit)) & np.uint32(1), b, np.uint32(0))
        b = np.where(b & np.uint32(1), (b >> np.uint32(1)) ^ np.uint32(0xEDB88320), b >> np.uint32(1))
    return out


#: At i, for each of a CRC's four bytes what it contributes after 2**i more bytes; as far as lengths needed it.
_AFTER: list[np.ndarray] = []


def _after(i: int) -> np.ndarray:
    while len(_AFTER) <= i:
        step = np.full(1, 1 << 23, np.uint32)  # x**8: one byte
        for _ in range(len(_AFTER)):
            step = _times(step, step)
        each = np.arange(256, dtype=np.uint32) << 8 * np.arange(4, dtype=np.uint32)[:, None]
        _AFTER.append(_times(np.repeat(step, each.size), each.ravel()).reshape(4, 256))
    return _AFTER[i]


def crc_shifted(crcs: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What each CRC contributes to that of a text in which ``length`` more bytes follow; the whole is their XOR."""
    out, length = crcs.astype(np.uint32), length.astype(np.int64).copy()
    bit = 0
    while length.any():
        odd = np.flatnonzero(length & 1)
        part, table = out[odd], _after(bit)
        out[odd] = table[0][part & np.uint32(255)] ^ table[1][(part >> np.uint32(8)) & np.uint32(255)] ^ table[2][(part >> np.uint32(16)) & np.uint32(255)] ^ table[3][part >> np.uint32(24)]
        length >>= 1
        bit += 1
    return out


def _shift(batches):
    for batch in batches:
        shifted = crc_shifted(batch.column("crc").to_numpy(), batch.column("after").to_numpy() * 4)
        at = batch.schema.get_field_index("crc")
        yield batch.set_column(at, "crc", pa.array(shifted.astype(np.int64), pa.int64()))


def _verify_docs(batches):
    """Documents whose chunk hashes give the root that their recipe names."""
    for batch in batches:
        for part, shas, root in zip(batch.column("part").to_pylist(), batch.column("shas").to_pylist(), batch.column("root").to_pylist(), strict=True):
            if merkle(shas) != root:
                raise ValueError(f"a document of part {part} does not match its root")
        yield batch.drop_columns(["shas", "root"])


def _whole(docs: DataFrame, whole: Column) -> DataFrame:
    """docs, all of which must be whole. A filter, so that counting rows checks them too."""
    return docs.where(F.when(whole, True).otherwise(F.raise_error(F.concat(F.lit("chunks are missing: a document of part "), F.col("part").cast("string"), F.lit(" does not have the ids its recipe counts")))))


def read(spark: SparkSession, out_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and n_chunks of every document, from the files of a store."""
    chunks = spark.read.parquet(f"{out_dir}/chunks").mapInArrow(_checked, "sha binary, n long, crc long")
    recipes, manifest = spark.read.parquet(f"{out_dir}/recipes"), spark.read.parquet(f"{out_dir}/manifest")
    found_parts = _manifest(recipes).select("part", *[F.struct("n_docs", "n_tokens", "root").alias("found_part")])
    told_parts = manifest.select("part", F.struct("n_docs", "n_tokens", "root").alias("told_part"))
    wrong = told_parts.join(found_parts, "part", "full").where(~F.col("told_part").eqNullSafe(F.col("found_part"))).select("part").limit(1).collect()
    if wrong:
        raise ValueError(f"part {wrong[0].part} does not match the manifest")
    parts = spark.createDataFrame(starts_of(spark, out_dir), "part long, first_start long, part_tokens long")
    told = recipes.select("part", "__id", "local_start", "n_tokens", F.size("chunks").cast("long").alias("told_chunks"), "root", F.transform("chunks", lambda c: c["sha"]).alias("shas"))
    docs = told.mapInArrow(_verify_docs, T.StructType([f for f in told.schema.fields if f.name not in ("shas", "root")]))
    used = recipes.select("part", "local_start", F.explode("chunks").alias("c")).select("part", "local_start", "c.sha", "c.after")
    held = used.join(chunks, "sha")
    moved = held.select("part", "local_start", "n", "after", "crc").mapInArrow(_shift, "part long, local_start long, n long, after long, crc long")
    sums = moved.groupBy("part", "local_start").agg(F.sum("n").alias("found"), F.bit_xor("crc").alias("crc"), F.count(F.lit(1)).alias("n_chunks"))
    # the manifest has one row per file of recipes, so its size is that of a listing
    found = _whole(docs.join(sums, ["part", "local_start"], "left"), (F.col("found") == F.col("n_tokens")) & (F.col("n_chunks") == F.col("told_chunks")))
    return found.join(F.broadcast(parts), "part").select(F.col("__id").alias("doc_id"), (F.col("first_start") + F.col("local_start")).alias("start"), F.col("found").alias("n_tokens"), F.col("crc").alias("ids_crc32"), "n_chunks")


def _joined(key, table: pa.Table) -> pa.Table:
    rows = sorted(zip(table["after"].to_pylist(), table["n"].to_pylist(), table["payload"].to_pylist(), strict=True), reverse=True)
    ids = np.concatenate([np.frombuffer(p, f"<u{len(p) // n}") for _, n, p in rows]).astype(np.int32)
    return pa.table({"part": [key[0].as_py()], "local_start": [key[1].as_py()], "ids": pa.array([ids], pa.list_(pa.int32()))})


def read_ids(spark: SparkSession, out_dir: str) -> DataFrame:
    """doc_id and the ids (with the end id) of every document, rebuilt from the store."""
    recipes = spark.read.parquet(f"{out_dir}/recipes")
    used = recipes.select("part", "local_start", F.explode("chunks").alias("c")).select("part", "local_start", "c.sha", "c.after")
    rebuilt = used.join(spark.read.parquet(f"{out_dir}/chunks"), "sha").drop("sha").groupBy("part", "local_start").applyInArrow(lambda key, table: _joined(key, table), "part long, local_start long, ids array<int>")
    docs = recipes.select("part", "local_start", F.col("__id").alias("doc_id"), "n_tokens").join(rebuilt, ["part", "local_start"], "left")
    return _whole(docs, F.size("ids") == F.col("n_tokens")).select("doc_id", "ids")


