"""The corpus pipeline: five of the training-data operators, one after another over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet
and read again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import decontamination, language_id, line_dedup, ngram_join, sentencepiece_viterbi, storage
from newsflow.llm.catalog import tokenizer_file

#: A document stays if its language is known and has at least this pooled probability.
LEAST_LANGUAGE_SCORE = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without letters, or of which no language is likely, go."""
    model = language_id.fit(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    found = language_id.identify(docs.select(F.struct(*docs.columns).alias("row"), F.col("text").alias("text")), model)
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)).select("row.*")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: later occurrences of three-line windows are cut from the texts; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs).select("row.*")
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long"))) if "n_chars" in docs.columns else cut


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of documents that Jaccard >= 0.8 on five-word shingles links, the one of the smallest id stays."""
    return ngram_join.keep_one(docs, k=5, num=80, den=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a benchmark item, give or take a tenth of it in edits, go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: doc_id, lang, source, the SentencePiece ids, their number, and whether they decode to the text."""
    path = tokenizer_file("piece_bpe_32k.model")
    found = sentencepiece_viterbi.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    return found.select("doc_id", "lang", "source", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_ngrams),
    ("decontamination", decontaminate),
    ("sentencepiece", encode_pieces),
]

#: The network of the first stage and the segmentation of the last have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
