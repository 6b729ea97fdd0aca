import pytest

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, ties, columns named like the operators' own."""
    rows = [
        (1, "One short text.", "en", 5), (2, None, "en", 5), (3, "", None, 5), (4, LONG, "en", None), (4, LONG, "en", None), (5, " \n\t ", "de", 1), (6, "ünïcödé 😀 text", "fr", 2),
        (7, "One short text.", "en", 5), (8, "a\n\n\nb\nc\nd\n\n\nb\nc\nd", None, 0), (None, "no id here", None, None),
    ]
    return spark.createDataFrame([(*r, 1, "x", 0.5, "k", "t") for r in rows], "doc_id long, text string, lang string, n_chars long, shard int, key string, score double, kept_text string, ids string")


@pytest.fixture(scope="session")
def small_docs(spark):
    """All documents of the smallest data directory."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
