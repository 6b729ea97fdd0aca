"""Operators 2 to 7 against brute force, held-out labels and round trips."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.llm import catalog, decontamination, language_id, pii, sentencepiece_viterbi, storage, token_store, toxicity
from newsflow.llm.textbytes import Words

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and max(map(int, m[0].split("."))) > 255) or (kind == "card" and not (14 <= len(n) <= 19 and luhn(n))) or (kind == "phone" and not 10 <= len(n) <= 15):
                continue
            out.append((m.start(), k, m.end()))
    return ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in sorted(out))


@pytest.fixture(scope="module")
def pii_model(spark):
    return pii.fit(spark)


def test_pii(spark, small_docs, edge_docs, pii_model):
    tricky = ["a@b.c.@d.e x", "1.2.3.4.5.6.7.8", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "é😀 x@y.zz +1 (743) 555-3824 ", "x@y", "+1 234", "0255.1.1.1", "12345678901234567890", "1." * 500, "a@" * 500, "+1-" * 300]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(tricky)], "doc_id long, text string").unionByName(small_docs.select("doc_id", "text"))
    for r in pii.find(docs, pii_model).select("text", pii.named(F.col("base_found")).alias("base")).collect():
        assert r.base == base_spans(r.text), r.text[:80]
    got = pii.find(edge_docs, pii_model)
    assert got.count() == 10 and got.where("size(found) > 0").count() == 0
    assert pii.find(edge_docs.limit(0), pii_model).count() == 0


def test_pii_adds_and_leaves(spark, pii_model):
    rows = [("mail bob77(at)web.example.org now", 1), ("call (555) 123-4567", 1), ("login ip 10[.]0[.]0[.]7", 1), ("order 123 456 7890", 0), ("see section 3.4 (at) page 5", 0), ("isbn 123-456-7890", 0)]
    docs = spark.createDataFrame([(t, n) for t, n in rows], "text string, n int")
    for r in pii.find(docs, pii_model).collect():
        assert len(r.found) == r.n, r.text
    one = pii.find(docs.limit(1), pii_model).select(pii.redact(F.col("text"), F.col("found")).alias("t")).first().t
    assert one == "mail [REDACTED] now"


def test_pii_long_texts(spark, pii_model):
    """Long texts need no stack, and time in proportion to their length."""
    texts = ["9" * 200_000, "1-" * 100_000, "a" * 200_000, "a@" * 100_000, "1." * 50_000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert pii.find(docs, pii_model).count() == 5
    assert [r.n for r in pii.find(docs, pii_model).select(F.size("base_found").alias("n")).collect()] == [0, 0, 0, 0, 12_500]
    for unit in ("1 22 333 4444 ", "10.0.0.7 a@b.cd ", "call (555) 123-4567 "):
        one = spark.createDataFrame([(unit * (1_000_000 // len(unit)),)], "text string")
        start = time.perf_counter()
        r = pii.find(one, pii_model).select(F.size("found").alias("n")).first()
        assert time.perf_counter() - start < 30, unit
        assert r.n == {"1 22 333 4444 ": 0, "10.0.0.7 a@b.cd ": 2 * (1_000_000 // len(unit))}.get(unit, r.n)


def test_pii_overlaps_by_rank(spark):
    """a before b before c: where a and b overlap and b and c, c stays; base spans stay whatever overlaps them."""
    span = "array<struct<s: int, k: int, e: int>>"
    rows = [
        ([], [(3.0, 0, 0, 10), (2.0, 8, 1, 20), (1.0, 18, 3, 30)], [(0, 0, 10), (18, 3, 30)]),
        ([(5, 0, 9)], [(9.0, 0, 3, 6), (1.0, 9, 1, 12)], [(5, 0, 9), (9, 1, 12)]),
        ([(0, 0, 40), (3, 1, 9)], [(9.0, 30, 3, 50), (8.0, 45, 2, 60)], [(0, 0, 40), (3, 1, 9), (45, 2, 60)]),
        ([(1, 1, 2)], [], [(1, 1, 2)]),
    ]
    docs = spark.createDataFrame([(i, b, c) for i, (b, c, _) in enumerate(rows)], f"i int, b {span}, c array<struct<p: double, s: int, k: int, e: int>>")
    got = {r.i: [tuple(x) for x in r.o] for r in docs.select("i", pii.unrivalled("b", "c").alias("o")).collect()}
    assert [got[i] for i in range(len(rows))] == [want for _, _, want in rows]


def test_pii_calibration_holds_out_templates(spark):
    x, y, template = pii.examples(spark)
    sums, model = pii.unseen_scores(x, y, template), pii.boost(x, y, template)
    for k, kind in enumerate(pii.KINDS):
        own = x[:, 0] == k
        chosen = own & (sums >= model.thresholds[k])
        assert y[chosen].mean() >= pii.PRECISION - 0.005 and y[chosen].sum() >= 0.3 * y[own].sum(), kind


def edit_distance(item, text):
    """Least edits between item and any stretch of text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    return min(row)


def test_decontamination(spark, edge_docs):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("al", "er", "in", "on")]
    items = [(i, " ".join(rng.choice(words, 14))) for i in range(6)] + [(90, None), (91, " "), (92, "Xy")]
    rows = []
    for i in range(120):
        item = list(items[int(rng.integers(6))][1])
        for _ in range(int(rng.integers(0, 9))):
            at = int(rng.integers(len(item)))
            item[at : at + int(rng.integers(0, 2))] = [str(rng.choice(list("qxz")))] * int(rng.integers(0, 2))
        rows.append((i, " ".join(rng.choice(words, 6)) + "  " + "".join(item).upper() + "\n" + " ".join(rng.choice(words, 5))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in rows:
        for k, b in items[:6]:
            b, d = decontamination.normal(b), edit_distance(decontamination.normal(b), decontamination.normal(t))
            if d <= int(0.1 * len(b) + 1e-9):
                want[i, k] = d
    found = decontamination.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == want and want
    texts = dict(rows)
    for r in found:
        part = decontamination.normal(texts[r.doc_id])[r.start : r.end]
        assert edit_distance(decontamination.normal(dict(items)[r.item_id]), part) == r.distance
    assert {r.doc_id for r in decontamination.clean(docs, bench).collect()} == {i for i, _ in rows} - {i for i, _ in want}
    assert decontamination.contaminated(edge_docs, bench).count() == 0
    assert decontamination.clean(edge_docs, bench.limit(0)).count() == 10
    assert decontamination.contaminated(edge_docs.limit(0), bench).count() == 0


def test_toxicity(spark, edge_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in catalog.op4_toxicity(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for i, r in got.items())
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p for t, p in held if not t) <= 0.01 * len(held)
    assert sum(t == p for t, p in held) / len(held) > 0.9
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.score(edge_docs, model)
    assert out.count() == 10 and out.where("score between 0 and 1").count() == 10 and len(set(out.columns)) == len(out.columns)
    none = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert toxicity.score(edge_docs.limit(0), none).count() == 0


def test_nnpu_finds_the_separating_feature():
    rng = np.random.default_rng(0)
    unl = (rng.random((2000, 3)) < 0.3).astype(np.float32)
    unl[:, 0] = 0
    unl[:200, 0] = 1
    pos = (rng.random((200, 3)) < 0.3).astype(np.float32)
    pos[:, 0] = 1
    w, b = toxicity.nnpu(pos, unl, 0.1)
    assert w[0] > 3 * max(abs(w[1]), abs(w[2])) and b < 0 < w[0] + b


def test_language_id(spark, edge_docs):
    got = {r.doc_id: r for r in catalog.op5_language_id(spark, "/root/testdata/sf0.01").collect()}
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert sum(got[i].lang_pred == lang[i] for i in held) / len(held) > 0.97
    model = language_id.train([b"the cat and the dog " * 4, b"der hund und die katze " * 4] * 8, ["en", "de"] * 8, steps=60)
    out = {r.doc_id: r for r in language_id.identify(edge_docs, model).collect()}
    assert all(out[i].lang_pred == "und" and out[i].lang_score == 0 for i in (2, 3, 5)) and out[1].lang_pred in ("en", "de")
    assert language_id.identify(edge_docs.limit(0), model).count() == 0
    assert language_id.fit(edge_docs.limit(0), F.lit(True)).langs == []


def test_language_id_learns_rare_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_TEXTS", 40)
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(3000)] + [(i, f"der hund und die katze {i}", "de") for i in range(3000, 6000)]
    rows += [(i, f"zqx wvk {i}", "rare") for i in range(6000, 6003)] + [(None, "øæå", "copies")] * 500
    seen = []
    monkeypatch.setattr(language_id, "train", lambda texts, langs: seen.extend(langs))
    language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert len(seen) == 40 and seen.count("rare") == 3 and "copies" in seen and min(seen.count("en"), seen.count("de")) >= 5


def test_gru_gradients():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in language_id._init(rng, 3, 2).items()}
    data, weight = rng.integers(0, 256, (5, 2)), rng.normal(size=(5, 2, 3))

    def loss():
        return float((language_id._run(p, "b", data).astype(np.float64) * weight).sum())

    keep: list = []
    language_id._run(p, "b", data, keep)
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    language_id._back(p, "b", data, keep, weight.copy(), grad)
    for name in ("xb", "ub", "cb"):
        at = np.unravel_index(np.argmax(np.abs(grad[name])), grad[name].shape)
        old, step = p[name][at], 1e-2
        p[name][at] = old + step
        up = loss()
        p[name][at] = old - step
        down = loss()
        p[name][at] = old
        assert abs((up - down) / (2 * step) - grad[name][at]) < 2e-2 * max(1, abs(grad[name][at]))


def test_token_store(spark, small_docs, edge_docs):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_file("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    extra = spark.createDataFrame([(1000, "it's <|endoftext|>x ISN'T «né», éa…b 3.14 don't!!"), (1001, "<|ENDOFTEXT|> a_b"), (1002, "né,ñ;Ö:x×y÷z")], "doc_id long, text string")
    for docs in (small_docs.select("doc_id", "text").unionByName(extra), edge_docs):
        out = token_store.build(docs, path, 1, storage.new_dir(spark, "test"))
        got = sorted(((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in token_store.read(spark, out).collect()), key=lambda r: r[0])
        rows = sorted(docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
        start = 0
        for (s, n, crc, i), r in zip(got, rows, strict=True):
            ids = np.array([*plain.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
            assert (s, n, crc, i) == (start, len(ids), zlib.crc32(ids.tobytes()), r.doc_id)
            start += n
        ids = {r.doc_id: r.ids for r in token_store.read_ids(spark, out).collect()}
        assert all(ids[r.doc_id] == [*plain.encode(r.text or "", add_special_tokens=False).ids, 1] for r in rows)
        shas = [bytes(r.sha) for r in spark.read.parquet(f"{out}/chunks").collect()]
        assert len(shas) == len(set(shas))
    empty = token_store.build(edge_docs.limit(0), path, 1, storage.new_dir(spark, "test"))
    assert token_store.read(spark, empty).count() == 0


def test_token_store_notices_damage(spark, small_docs, tmp_path):
    out = token_store.build(small_docs, catalog.tokenizer_file("word_bpe_49k.json"), 1, str(tmp_path / "a"))
    spark.read.parquet(f"{out}/chunks").withColumn("payload", F.concat("payload", F.unhex(F.lit("0000")))).write.parquet(f"{tmp_path}/b/chunks")
    for t in ("recipes", "manifest"):
        spark.read.parquet(f"{out}/{t}").write.parquet(f"{tmp_path}/b/{t}")
    with pytest.raises(Exception, match="does not hold what it is named for"):
        token_store.read(spark, str(tmp_path / "b")).count()


def test_token_store_notices_missing_chunks(spark, small_docs, tmp_path):
    out = token_store.build(small_docs, catalog.tokenizer_file("word_bpe_49k.json"), 1, str(tmp_path / "a"))
    most = F.max_by("chunks", F.size("chunks"))
    for name, chunk in (("one", spark.read.parquet(f"{out}/recipes").select(most).first()[0][0]), ("only", spark.read.parquet(f"{out}/recipes").where("size(chunks) = 1").first().chunks[0])):
        spark.read.parquet(f"{out}/chunks").where(F.col("sha") != F.lit(bytes(chunk.sha))).write.parquet(f"{tmp_path}/{name}/chunks")
        for t in ("recipes", "manifest"):
            spark.read.parquet(f"{out}/{t}").write.parquet(f"{tmp_path}/{name}/{t}")
        for read in (token_store.read, token_store.read_ids):
            with pytest.raises(Exception, match="chunks are missing"):
                read(spark, f"{tmp_path}/{name}").count()


def test_sentencepiece(spark, small_docs, edge_docs):
    """The ids are those of the library, text by text, none left out; and they decode to the text."""
    import sentencepiece

    path = catalog.tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = ["Hello  world", " a", "a ", "é😀", "\x00\t\n", "   ", "naïve—test", "ﷺx", "  lead", "x" * 50_000, " " * 999, "a" + " " * 37 + "b" + " " * 5, "   世界  世", "<s> hi </s>", "the president of the united states", "\r\nx", None, ""]
    rng = np.random.default_rng(6)
    odd += ["".join(rng.choice(list("ab xinger  é世\n."), int(rng.integers(1, 60)))) for _ in range(3000)]
    names = list(sentencepiece_viterbi.Model(path).pieces)
    odd += ["".join(names[i] for i in rng.integers(0, len(names), 4)) for _ in range(3000)]
    for docs in (small_docs, edge_docs, spark.createDataFrame([(t,) for t in odd], "text string")):
        encoded = sentencepiece_viterbi.encode(docs, path)
        rows = sentencepiece_viterbi.decode(encoded, path).select("text", "ids", "decoded").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.decoded == r.text and r.ids == (None if r.text is None else library.encode(r.text)), r.text
        both = sentencepiece_viterbi.round_trip(docs, path)
        assert both.where(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0 and both.count() == docs.count()
    marks = spark.createDataFrame([("▁x▁ ▁▁",), ("a▁b",)], "text string")  # the library reads U+2581 as a space
    assert sentencepiece_viterbi.round_trip(marks, path).where(~F.col("decoded").eqNullSafe(F.col("text"))).count() == 0
    assert sentencepiece_viterbi.encode(edge_docs.limit(0), path).count() == 0


def test_sentencepiece_cache_is_bounded(monkeypatch):
    import sentencepiece

    path = catalog.tokenizer_file("piece_bpe_32k.model")
    monkeypatch.setattr(sentencepiece_viterbi, "CACHE_BYTES", 2000)
    monkeypatch.setattr(sentencepiece_viterbi, "PAIRS", 50)
    model, library = sentencepiece_viterbi.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    for part in range(20):
        texts = [f"word{part * 7 + i} of a{i}b" for i in range(9)]
        ids, cuts = model.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == library.encode(texts)
        assert model.held <= 2000 + 400 and len(model.pairs) <= 50
    model.forget()
    assert not model.known


def test_sentencepiece_walks_each_word_once(monkeypatch):
    """Whatever signs and digits stand beside it, and however many words came between."""
    import sentencepiece

    path = catalog.tokenizer_file("piece_bpe_32k.model")
    model, library = sentencepiece_viterbi.Model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    walked, plain = [], model.encode_words
    monkeypatch.setattr(model, "encode_words", lambda words: walked.extend(words) or plain(words))
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefghij"), 8)) for _ in range(30_000)]
    signs = ["", ",", ".\n", "!!", "###", "7", " 12", "   3", "é.", "世,", ")", "\t"]
    for begin in [*range(0, 30_000, 5000), 0]:
        texts = [f"w {words[i]}{signs[(i + k) % len(signs)]} x  {words[i]}{signs[i % len(signs)]}" for i in range(begin, begin + 5000) for k in (0, 1)]
        ids, cuts = model.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)] == library.encode(texts)
    counts = Counter(walked)
    assert max(counts[f" {w}"] for w in words) == 1
    assert sum(map(len, walked)) < 14 * len(words)


def test_words():
    texts = ["a b", None, "", " \t", "x y é\vz\x1cq", "b" * 5000]
    words = Words(pa.array(texts))
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert words.counts.tolist() == [len(w) for w in want]
    assert words.join(np.ones(len(words.starts), bool)).to_pylist() == [" ".join(w) for w in want]
    sliced = Words(pa.array(["zz", *texts]).slice(1))
    assert (sliced.hashes == words.hashes).all()
