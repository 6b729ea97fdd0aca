"""Operator 11, phrase collocation mining: weighted n-grams of distinct pieces, counted per hash bucket.

1. Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and equal pieces of a
   language become one row with a multiplicity, pre-aggregated before the shuffle.
2. A phrase of two to four words that occurs ``least`` times has only pairs of neighbouring words that
   do so too. Each shard of distinct pieces sends hashes of its pairs with their weights to buckets of
   the hash space, which answer with a bit each. A hash that two pairs share can only let more through.
3. Each shard then emits its words, and its phrases all of whose pairs passed, as text, each once with
   its weight. They are shuffled to buckets by a hash of the phrase, those of a shard, bucket and language in
   one row; a bucket streams what it gets into a DuckDB table of its task, which sums it within a memory
   limit, spilling to that task's own temporary folder. What spills goes when the task ends; a lost
   executor's bucket is counted again from the shuffle.
4. Parts are co-located by lookup requests: each candidate asks, for each cut, the rows of its two parts
   by a shuffle on (lang, phrase), and tells every phrase inside it its own count. Nothing is broadcast.

Counts and scores are exact: sums are 64-bit, products are decimals of 38 digits.

Defined results: null and empty texts have no pieces; a null language is ``und``; repeated rows count
as often as they are there; ids and all other columns are ignored; ties of a score go by count and then
by the bytes of the phrase; an empty table gives an empty table. A very long piece stays one row and
makes its shard larger.
"""

from __future__ import annotations

import os
import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm import exchange, storage
from newsflow.llm.textbytes import Words, distinct_spans, gram_hashes, mix, release
from newsflow.llm.textbytes import pieces as text_slices

_U = np.uint64
#: Words of the longest phrase; occurrences of a candidate; per cent of its count at which a longer one covers it; rows per language.
WORDS, LEAST, COVERED, TOP = 4, 30, 80, 2000
#: Bytes of distinct pieces in a shard; rows of phrases that a bucket gets on average; memory of a bucket's DuckDB.
SHARD_BYTES, BUCKET_ROWS, DUCK_MB = 4_000_000, 500_000, 300
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pieces_of(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, piece (its words joined by one space), times: each distinct piece of a language once."""
    text = F.regexp_replace(F.translate(text_col, UPPER, LOWERED), r"[ \t]{2,}|\t", " ")
    cut = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(text, r"[.,;:!?\n-\r]", -1)).alias("piece"))
    return cut.select("lang", F.trim("piece").alias("piece")).where(F.col("piece") != "").groupBy("lang", "piece").agg(F.count(F.lit(1)).alias("times"))


class _Shard:
    """The words of a shard's pieces, with the language and weight of each and the hashes of its pairs."""

    def __init__(self, table: pa.Table):
        self.words = Words(table["piece"])
        langs = table["lang"].combine_chunks().dictionary_encode()
        langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
        self.langs = langs.dictionary.to_pylist()
        self.lang = np.repeat(langs.indices.to_numpy().astype(np.int64), self.words.counts)
        self.weight = np.repeat(table["times"].to_numpy(), self.words.counts)
        salt = np.array([int.from_bytes(x.encode()[:8].ljust(8, b"\0"), "little") ^ len(x) for x in self.langs], _U)
        #: of the word and its language
        self.hashes = mix(self.words.hashes ^ mix(salt)[self.lang])
        self.pair_at = self.words.gram_starts(2)[0]
        self.pair_hashes = gram_hashes(self.hashes, 2)[self.pair_at]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of pairs, sorted, the weight of each, and which of them each pair has."""
        hashes, of = np.unique(self.pair_hashes, return_inverse=True)
        return hashes, np.minimum(np.bincount(of, self.weight[self.pair_at], len(hashes)), 2**31).astype(np.uint32), of


def _sent(key, table: pa.Table, buckets: int) -> pa.Table:
    """A shard's pairs as messages: the lower half of each hash, the upper half chooses the bucket."""
    shard = _Shard(table)
    hashes, weights, _ = shard.pairs()
    return exchange.packed(key[0].as_py(), 0, hashes, buckets, weights, hashes.astype(np.uint32))


def _frequent(table: pa.Table, least: int) -> pa.Table:
    """For one bucket: answers each message with a bit per hash, set where the weights of all shards reach ``least``."""
    blobs = table["blob"].to_pylist()
    parts = [len(b) // 8 for b in blobs]
    values = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, parts, strict=True)])
    weights = np.concatenate([np.frombuffer(b, np.uint32, n, 4 * n) for b, n in zip(blobs, parts, strict=True)])
    _, of = np.unique(values, return_inverse=True)
    enough = (np.bincount(of, weights) >= least)[of]
    ends = np.cumsum(parts)
    bits = [np.packbits(enough[e - n : e]).tobytes() for e, n in zip(ends.tolist(), parts, strict=True)]
    return exchange.messages(table["shard"], table["kind"], table["bucket"], bits)


PHRASE = "lang string, size int, phrase string, times long"
ARROW_PHRASE = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("times", pa.int64())])
#: A shard's phrases of one language for one bucket, a line each (no piece holds a line end).
PACKED = "bucket long, lang string, phrases string, times array<long>"
ARROW_PACKED = pa.schema([("bucket", pa.int64()), ("lang", pa.string()), ("phrases", pa.string()), ("times", pa.list_(pa.int64()))])


def _phrases(table: pa.Table, told: pa.Table, buckets: int, most: int, parts: int) -> pa.Table:
    """Every word of a shard, and its phrases whose pairs all passed, each once per language with its weight, for ``parts`` buckets of phrases."""
    shard = _Shard(table)
    words, hashes, _, of = shard.words, *shard.pairs()
    passed = np.zeros(len(words.starts), bool)  # the pair that starts at this word passed
    passed[shard.pair_at] = exchange.answers(told, 0, hashes, buckets)[of]
    out, here = [], np.ones(len(words.starts), bool)
    for size in range(1, most + 1):
        if size > 1:  # the phrase of one word less starts here, and the pair of its last word and the next passed
            n = max(0, len(here) - 1)
            here = here[:n] & passed[size - 2 : size - 2 + n]
        at = np.flatnonzero(here)
        if not len(at):
            break
        starts, ends = words.starts[at], words.ends[at + size - 1]
        _, which = distinct_spans(words.flat, starts, ends)
        key, place, back = np.unique(which * len(shard.langs) + shard.lang[at], return_index=True, return_inverse=True)
        times = np.bincount(back, shard.weight[at], len(key)).astype(np.int64)  # exact: a shard has less than 2**53 words
        home = exchange.bucket_of(gram_hashes(shard.hashes, size)[at[place]], parts).astype(np.int64)
        out.append((home, shard.lang[at][place], starts[place], ends[place], times))
    if not out:
        return ARROW_PACKED.empty_table()
    home, lang, starts, ends, times = map(np.concatenate, zip(*out, strict=True))
    order = np.lexsort((lang, home))
    home, lang, raw = home[order], lang[order], words.flat.tobytes()
    found = [raw[a:b] for a, b in zip(starts[order].tolist(), ends[order].tolist(), strict=True)]
    first = np.flatnonzero(np.concatenate(([True], (home[1:] != home[:-1]) | (lang[1:] != lang[:-1]))))
    cuts = np.append(first, len(home))
    lines = [b"\n".join(found[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    langs = pa.array(shard.langs, pa.string()).take(pa.array(lang[first]))
    return pa.Table.from_arrays([pa.array(home[first]), langs, pa.array(lines, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(times[order]))], schema=ARROW_PACKED)


def _unpacked(batch: pa.RecordBatch) -> pa.Table:
    """lang, phrase, times: a row for each line."""
    lines = pc.split_pattern(batch["phrases"], "\n")
    return pa.table({"lang": batch["lang"].take(pc.list_parent_indices(lines)), "phrase": lines.flatten(), "times": batch["times"].flatten()})


def _counted(batches, least: int):
    """One bucket: sums the weights of each phrase in DuckDB and yields those that reach ``least``."""
    with tempfile.TemporaryDirectory(prefix="phrases-") as folder:
        con = duckdb.connect(config={"memory_limit": f"{DUCK_MB}MB", "threads": 1, "temp_directory": os.path.join(folder, "spill"), "preserve_insertion_order": False})
        try:
            con.execute("CREATE TABLE held (lang VARCHAR, phrase VARCHAR, times BIGINT)")
            for batch in text_slices(batches, "phrases"):
                con.register("arrived", _unpacked(batch))
                con.execute("INSERT INTO held SELECT lang, phrase, times FROM arrived")
            size = "len(phrase) - len(replace(phrase, ' ', '')) + 1"
            found = con.execute(f"SELECT lang, ({size})::INTEGER AS size, phrase, sum(times)::BIGINT AS times FROM held GROUP BY lang, phrase HAVING sum(times) >= {int(least)}")
            while rows := found.fetchmany(50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), ARROW_PHRASE, strict=True)], schema=ARROW_PHRASE)
        finally:
            con.close()
    release()


def count_phrases(pieces: DataFrame, most: int = WORDS, least: int = LEAST) -> DataFrame:
    """lang, size (words), phrase, times of every phrase of 1 to ``most`` words that occurs at least ``least`` times; ``pieces`` is a written table as pieces_of makes it, read three times."""
    spark, held = pieces.sparkSession, pieces
    size = held.agg(F.coalesce(F.sum(F.octet_length("piece")), F.lit(0))).first()[0]
    shards = exchange.shards_for(size, SHARD_BYTES)
    # a shard's distinct pairs are at most its words, of two bytes or more each
    buckets = exchange.buckets_for(size / 8, exchange.least_buckets(spark))
    dealt = held.withColumn("shard", exchange.shard_of(shards, "lang", "piece")).groupBy("shard")
    sent = dealt.applyInArrow(lambda key, table: _sent(key, table, buckets), exchange.MESSAGE)
    told = sent.groupBy("bucket").applyInArrow(lambda table: _frequent(table, least), exchange.MESSAGE)
    parts = max(exchange.least_buckets(spark), -(-size // (20 * BUCKET_ROWS)))
    found = dealt.cogroup(told.groupBy("shard")).applyInArrow(lambda table, answer: _phrases(table, answer, buckets, most, parts) if table.num_rows else ARROW_PACKED.empty_table(), PACKED)
    counted = found.repartitionById(parts, F.col("bucket").cast("int")).mapInArrow(lambda batches: _counted(batches, least), PHRASE)
    return storage.materialize(counted, "phrases", free=True)


def _big(x: str) -> Column:
    return F.col(x).cast("decimal(27,0)")


def scored(counts: DataFrame, totals: DataFrame, covered: int = COVERED) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates among ``counts`` that no longer one covers; ``totals``: lang, n."""
    most = F.array_size("words")
    whole = counts.where("size > 1").select("lang", "phrase", F.col("times").alias("a"), F.split("phrase", " ", -1).alias("words"))
    part = lambda start, n: F.array_join(F.slice("words", start, n), " ")
    # a request per cut and side, answered where the part's count lies
    cuts = whole.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), most - 1)).alias("k"))
    asked = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(F.struct(F.lit(0).alias("side"), part(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(1).alias("side"), part(F.col("k") + 1, most - F.col("k")).alias("part")))).alias("x")).select("lang", "phrase", "a", "k", "x.side", "x.part")
    known = counts.select("lang", F.col("phrase").alias("part"), "times")
    sides = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("side") == 0, F.col("times"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("times"))).alias("r"))
    sides = sides.withColumn("p", _big("a") * F.lit(2_000_000).cast("decimal(7,0)")).withColumn("q", (_big("l") + _big("r")).cast("decimal(27,0)")).withColumn("score", F.expr("p div q").cast("long"))
    best = sides.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # a longer candidate tells each candidate inside it its count
    spans = F.flatten(F.transform(F.sequence(F.lit(2), most - 1), lambda n: F.transform(F.sequence(F.lit(1), most - n + 1), lambda i: F.array_join(F.slice("words", i, n), " "))))
    inner = whole.where(most > 2).select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (_big("longer") * 100 < _big("a") * covered))
    return left.join(totals, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = WORDS, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases by score, count and bytes."""
    pieces = storage.materialize(pieces_of(docs, text_col, lang_col), "pieces", free=True)
    counts = count_phrases(pieces, most, least)
    words = F.length("piece") - F.length(F.replace("piece", F.lit(" "), F.lit(""))) + 1
    totals = pieces.groupBy("lang").agg(F.sum(F.col("times") * words).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(counts, totals, covered).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB: every contiguous phrase of every piece, counted plainly; the pieces' words are cut at spaces and tabs.
ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece FROM documents)
), u AS MATERIALIZED (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM p WHERE len(w) > 0),
f AS MATERIALIZED (
  SELECT lang, s.k AS k, array_to_string(w[i : i + s.k - 1], ' ') AS phrase, count(*) AS f
  FROM u, (VALUES (1), (2), (3), (4)) AS s(k) WHERE i + s.k - 1 <= len(w) GROUP BY ALL
), n AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
asked AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.a, s.k AS cut, array_to_string(c.w[1 : s.k], ' ') AS left_part, array_to_string(c.w[s.k + 1 :], ' ') AS right_part
  FROM c JOIN (VALUES (1), (2), (3)) AS s(k) ON s.k < c.k
), half AS MATERIALIZED (
  SELECT q.*, l.f AS l FROM asked AS q JOIN f AS l ON l.lang = q.lang AND l.phrase = q.left_part
), cut AS (
  SELECT h.lang, h.phrase, h.a, h.cut, h.l, r.f AS r, (2000000::HUGEINT * h.a) // (h.l + r.f) AS score
  FROM half AS h JOIN f AS r ON r.lang = h.lang AND r.phrase = h.right_part
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT c.lang, array_to_string(c.w[s.i : s.i + s.n - 1], ' ') AS phrase, max(c.a) AS longer
  FROM c JOIN (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) AS s(i, n) ON s.n < c.k AND s.i + s.n - 1 <= c.k GROUP BY ALL
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score
  FROM best AS b JOIN n ON n.lang = b.lang LEFT JOIN inner_phrases AS x ON x.lang = b.lang AND x.phrase = b.phrase
  WHERE x.longer IS NULL OR 100 * x.longer < 80 * b.a
) WHERE rank <= 2000
"""
