"""Hashes and byte strings that regular patterns must not confuse."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.llm import catalog, ngram_join, sentencepiece_viterbi, storage, substring_dedup, token_store
from newsflow.llm import textbytes as B


def thue_morse(n, a="a", b="b", by=""):
    """n letters (or words) of the sequence and of its mirror: equal under any polynomial modulo 2**64 for n = 1024."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return by.join((a, b)[x] for x in bits), by.join((b, a)[x] for x in bits)


def test_regular_words_differ():
    one, two = thue_morse(1024)
    short = thue_morse(64)
    words = B.Words(pa.array([f"{one} {two} {one} {short[0]} {short[1]}", "x" * 300 + " " + "x" * 299 + "y"]))
    assert len(set(words.hashes.tolist())) == 6
    at, of = B.distinct_spans(words.flat, words.starts, words.ends)
    assert len(at) == 6 and of[0] == of[2] and len(set(of.tolist())) == 6
    x, y = (np.array([3, 7], np.uint64)[[bin(i + s).count("1") % 2 for i in range(1024)]] for s in (0, 1024))
    assert B.gram_hashes(x, 1024)[0] != B.gram_hashes(y, 1024)[0]


@pytest.mark.parametrize("k", (1, 2, 3, 5, 16, 35, 200))
def test_grams_are_the_same_anywhere(k):
    x = np.random.default_rng(k).integers(0, 2**63, 190).astype(np.uint64)
    found = B.gram_hashes(x, k)
    assert len(found) == max(0, 190 - k + 1)
    assert (B.gram_hashes(np.concatenate([x[:7], x, x[:3]]), k)[7 : 7 + len(found)] == found).all()
    assert len(np.unique(found)) == len(found)


def test_colliding_hashes_fall_back_to_bytes(monkeypatch):
    monkeypatch.setattr(B, "byte_hashes", lambda flat, starts, ends: ends - starts)
    words = B.Words(pa.array(["ab cd ab xyz " + "q" * 300 + " " + "q" * 299 + "r", "cd"]))
    at, of = B.distinct_spans(words.flat, words.starts, words.ends)
    assert len(at) == 5 and of[0] == of[2] and of[1] == of[6]
    assert all(words.flat[words.starts[at[j]] : words.ends[at[j]]].tobytes() == words.flat[a:b].tobytes() for j, a, b in zip(of, words.starts, words.ends, strict=True))


def test_operators_tell_regular_words_apart(spark):
    import sentencepiece
    from tokenizers import Tokenizer

    one, two = thue_morse(1024)
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{two} {one}")], "doc_id long, text string")
    path = catalog.tokenizer_file("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    out = token_store.build(docs, path, 1, storage.new_dir(spark, "test"))
    for r in token_store.read_ids(spark, out).join(docs, "doc_id").collect():
        assert r.ids == [*plain.encode(r.text, add_special_tokens=False).ids, 1]
    path = catalog.tokenizer_file("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in sentencepiece_viterbi.round_trip(docs, path).collect():
        assert r.ids == sp.encode(r.text) and r.decoded == r.text


def test_operators_tell_regular_sequences_apart(spark):
    one, two = thue_morse(1024, "left", "right", " ")
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join.join_components(docs, 1024, 1, 1).collect()}
    assert all(got[i].component_id == i for i in (1, 2))
    assert all(r.n_removed == 0 for r in substring_dedup.remove_repeats(docs, window=1024).collect())
    assert docs.where(F.length("text") > 0).count() == 2


def test_encoder_gives_the_ids_of_the_library():
    """Also of letters that only one case composes with a mark, and of words of letters that lower case breaks up."""
    path = catalog.tokenizer_file("word_bpe_49k.json")
    pool = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x320), *range(0x370, 0x400), 0x1E9E, 0xE33, 0x1100, 0x1161, 0x3042, 0x10400, 0x1F600, 0xFB01]]
    rng = random.Random(6)
    texts = ["İstanbul İİ İabc", "Y̊ T̈ H̱ W̊", "a ́ b", "x|y | z", "½ ² Ⅷ ١٢", "don't we'll 'S", "", "\x85 a​"]
    texts += ["".join(rng.choices(pool + [" "] * 60, k=rng.randint(1, 60))).replace("<|", "") for _ in range(5000)]
    encoder = token_store.Encoder(path)
    flat, counts = encoder.encode(pa.array(texts))
    ends = np.cumsum(counts).tolist()
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [flat[b - n : b].tolist() for b, n in zip(ends, counts.tolist(), strict=True)] == want


def test_encoder_takes_plain_words_as_they_are(monkeypatch):
    """Small Latin letters, composed, are neither normalised nor matched again; the ids are those of the library."""
    path = catalog.tokenizer_file("word_bpe_49k.json")
    rng = random.Random(7)
    letters = [chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)] if c != 0xF7]
    plain = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(4000)]
    other = ["aµb", "÷", "a÷b", "straße\u0301", "e\u0301a", "ªº", "ŷx", "x1", "don't", "'s", "ﬁn"]
    encoder = token_store.Encoder(path)
    whole, sent = encoder._call, []
    monkeypatch.setattr(encoder, "_call", lambda texts: sent.extend(texts) or whole(texts))
    texts = [" ".join(rng.choices(plain, k=20)) for _ in range(300)] + plain + other + [" ".join(other)]
    flat, counts = encoder.encode(pa.array(texts))
    ends = np.cumsum(counts).tolist()
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [flat[b - n : b].tolist() for b, n in zip(ends, counts.tolist(), strict=True)] == want
    assert not {w for t in sent for w in t.split(" ")} & set(plain)
    encoder = token_store.Encoder(path)
    encoder.bare = None  # a file of which nothing is told
    assert encoder.encode(pa.array(texts))[0].tolist() == flat.tolist()
    spec = {"normalizer": {"type": "NFKD"}, "pre_tokenizer": {"type": "Split", "pattern": {"Regex": r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}}}
    assert token_store.for_plain(spec) is None and token_store.for_plain(spec | {"normalizer": None}) is not None


def test_shifted_crcs_make_up_that_of_the_whole():
    rng = np.random.default_rng(9)
    parts = [rng.bytes(int(n)) for n in (0, 1, 3, 255, 256, 70_001, 1 << 20)]
    after = np.cumsum([0, *[len(p) for p in parts[:0:-1]]])[::-1]
    shifted = token_store.crc_shifted(np.array([zlib.crc32(p) for p in parts], np.uint32), after)
    assert np.bitwise_xor.reduce(shifted) == zlib.crc32(b"".join(parts))
