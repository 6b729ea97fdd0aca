"""The thin queries over the operators of this subpackage, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import collocations, decontamination, embedding_dedup, filter_audit, language_id, line_dedup, ngram_join, pii, sentencepiece_viterbi, storage, substring_dedup, token_counts, token_store, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of recurring 35-word windows removed: doc_id, n_words, n_removed, kept_sha256."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.remove_repeats(docs, window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def _crc_mod(col: str, n: int) -> Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: doc_id, counts of base spans per kind, base_sha256, spans."""
    found = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), pii.fit(spark))
    kinds = F.transform("base_found", lambda x: x["k"])
    counts = [(F.size("base_found") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.named(F.col("base_found")).cast("binary"), 256).alias("base_sha256"), pii.named(F.col("found")).alias("spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item within a tenth of its length in edits: doc_id, item_id, distance, similarity, start, end."""
    return decontamination.contaminated(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score, predicted."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), _crc_mod("doc_id", 3) != 1)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", F.coalesce(_crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score."""
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs, _crc_mod("doc_id", 4) != 2)
    found = language_id.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer lies on this machine and, in the same place, on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written to a content-addressed store and read back: doc_id, start, n_tokens, ids_crc32."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_store.build(docs, tokenizer_file("word_bpe_49k.json"), 1, storage.new_dir(spark, "tokens"))
    return token_store.read(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text they decode to: doc_id, n_ids, ids_hash, decoded_sha256, round_trip."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = tokenizer_file("piece_bpe_32k.model")
    found = sentencepiece_viterbi.round_trip(docs, path)
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), F.sha2(F.coalesce("decoded", F.lit("")).cast("binary"), 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows removed: doc_id, n_lines, n_removed, kept_sha256."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs)
    return found.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("row.text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine >= 0.9 and their components: vec_id, n_links, component_id, kept."""
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of Jaccard >= 0.85 on 4-word shingles: doc_id, n_shingles, component_id."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.join_components(docs, k=4, num=85, den=100)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words: lang, rank, phrase, a, l, r, n, score."""
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text: doc_id, n_bytes, n_tokens, over_limit, n_chars and cut_chars (code points of the longest prefix of at most 2048 ids)."""
    found = token_counts.prefix_counts(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("word_bpe_49k.json"), limits=(2048,), stored=False)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "n_chars", F.col("cut_2048").alias("cut_chars"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders, per source: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return filter_audit.audit(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    found = (op1_substring_dedup, op2_pii, op3_decontamination, op4_toxicity, op5_language_id, op6_token_store, op7_sentencepiece, op8_line_dedup, op9_embedding_dedup, op10_ngram_join, op11_collocations, op12_token_counts, op13_filter_audit)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op8_line_dedup": line_dedup.ORACLE, "op11_collocations": collocations.ORACLE, "op13_filter_audit": filter_audit.ORACLE}
