"""Operators 11 to 13: phrases, prefix counts and the filter audit against brute force and SQL."""

import itertools
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsflow.llm import catalog, collocations, filter_audit, storage, token_counts

DIR = "/root/testdata/sf0.001"


def duck(name, **tables):
    con = duckdb.connect()
    for t, rows in tables.items():
        con.register(t, rows)
    for t in {"documents", "labels"} - set(tables):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    rel = con.sql(catalog.oracle_sql()[name])
    return rel.columns, sorted(rel.fetchall(), key=repr)


def same(df, found):
    columns, want = found
    assert sorted(df.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == want


# phrases


def brute_phrases(rows, least, covered, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        some = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in some.items():
            if any(len(q) > len(p) and 100 * b >= covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in some.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((" ".join(p), a, l, r, n[lang], score))
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i, *x) for i, x in enumerate(found[:top], 1)]
    return sorted(out)


def mined(spark, rows, **how):
    docs = spark.createDataFrame(rows, "text string, lang string, doc_id long, phrase string, times long")
    return sorted(map(tuple, collocations.mine(docs, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_phrases_by_sql(spark):
    same(catalog.op11_collocations(spark, DIR), duck("op11_collocations"))


def test_phrases_by_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "B", "c", "dé", "É", "é", "😀", "x y", "zz"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " \t", ". ", "\n", ",", "\r", "!"]) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None])) for _ in range(120)]
    rows += [(None, "en"), ("", "en"), (" \t ", None), ("One two three four", "en"), ("a b c a b c " * 400, "fr")] + [("The very same piece, again.", "en")] * 50
    full = [(t, x, 1, "p", 7) for t, x in rows]
    for least, covered, top in ((2, 80, 2000), (5, 50, 3), (30, 80, 2000)):
        assert mined(spark, full, least=least, covered=covered, top=top) == brute_phrases(rows, least, covered, top)


def test_phrases_across_shards_and_batches(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(" ".join(rng.choices("abcdefg", k=rng.randint(1, 30))), rng.choice(["en", "xx"])) for _ in range(300)]
    monkeypatch.setattr(collocations, "SHARD_BYTES", 300)
    assert mined(spark, [(t, x, None, "", 0) for t, x in rows], least=4) == brute_phrases(rows, 4, 80, 2000)


def test_scores_pass_64_bits(spark):
    big = 2**45
    rows = [("en", 1, "a", big + 2), ("en", 1, "b", big + 1), ("en", 2, "a b", big), ("en", 3, "a b c", big // 2), ("en", 1, "c", big), ("en", 2, "b c", big - 1)]
    counts, totals = spark.createDataFrame(rows, "lang string, size int, phrase string, times long"), spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    found = {r.phrase: (r.a, r.l, r.r, r.score) for r in collocations.scored(counts, totals).collect()}
    assert found["a b"] == (big, big + 2, big + 1, 2_000_000 * big // (2 * big + 3))
    assert found["a b c"] == (big // 2, big + 2, big - 1, 2_000_000 * (big // 2) // (2 * big + 1)) or found["a b c"][3] == 2_000_000 * (big // 2) // (2 * big)


def test_phrases_are_sent_in_few_rows():
    """A shard sends one row a bucket and language, which holds every phrase once; a bucket sums what several shards send it."""
    rng = random.Random(5)
    rows = Counter((rng.choice(["en", "dé"]), " ".join(rng.choices(["a", "b", "ç", "dd", "😀"], k=rng.randint(1, 12)))) for _ in range(400))
    table = pa.table({"lang": [x for x, _ in rows], "piece": [p for _, p in rows], "times": list(rows.values())})
    want = Counter()
    for (lang, piece), times in rows.items():
        words = piece.split()
        for k in range(1, 5):
            for i in range(len(words) - k + 1):
                want[lang, k, " ".join(words[i : i + k])] += times
    sent = collocations._phrases(table, collocations._frequent(collocations._sent((pa.scalar(0),), table, 1), 1), 1, 4, 3)
    assert sent.num_rows <= 3 * 2 and sum(map(len, sent["times"].to_pylist())) == len(want)
    found = Counter()
    for bucket in range(3):
        batches = sent.filter(pa.compute.equal(sent["bucket"], bucket)).to_batches()
        for batch in collocations._counted(iter(batches * 2), 20):
            found += Counter({(r["lang"], r["size"], r["phrase"]): r["times"] for r in batch.to_pylist()})
    assert found == {x: 2 * n for x, n in want.items() if 2 * n >= 20}


def test_writes_leave_no_shuffle_files(spark):
    """Pieces and phrases are written with their shuffle files gone at once; the session's setting stays as it was."""
    held = lambda: sum("shuffle_" in f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n"))
    docs, setting = spark.read.parquet(f"{DIR}/documents.parquet"), spark.conf.get(storage.FREE_SHUFFLES)
    storage.materialize(docs.groupBy("doc_id").count(), "kept")
    before = held()
    assert before > 0
    pieces = storage.materialize(collocations.pieces_of(docs), "pieces", free=True)
    assert pieces.count() > 0 and spark.conf.get(storage.FREE_SHUFFLES) == setting
    before = held()
    storage.materialize(collocations.pieces_of(docs), "pieces", free=True)
    assert held() <= before


def test_phrases_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None, None, None, None)], least=1) == []


# counts of prefixes


@pytest.fixture(scope="module")
def merges():
    return token_counts.Merges.of(catalog.tokenizer_file("word_bpe_49k.json"))


POOL = [*"abcdefghijklmnopqrstuvwxyz" * 4, *"     \n\t  ABCXYZ0123456789''''.,;:!?->#$%&()[]", "\x1c", "\x85", " ", " ", "\x00", "\x7f", *"éèüßñÀȨ́́̈  中文字คำที่한국어한😂😂İΣςſﬁ̀", "'re", "'ll", "the", "ing", "é", "́"]


@pytest.mark.parametrize("more", ([], ["<|endoftext|>", "<|startoftext|>", "<|END", "<|", "|>"]))
def test_every_prefix_is_the_librarys(merges, more):
    rng = random.Random(len(more))
    texts = ["".join(rng.choices(POOL + more * 4, k=rng.randint(0, 24))) for _ in range(600)] + ["a" * 300, "=" * 200, "😂" * 40, "haha" * 20, "aaaa bbbb", "ABCDEF" * 20, None, ""]
    steps, edges = token_counts.steps(pa.array(texts), merges)
    for i, text in enumerate(texts):
        assert np.cumsum(steps[edges[i] : edges[i + 1]]).tolist() == [merges.count((text or "")[:p]) for p in range(1, len(text or "") + 1)]


def test_small_cache_changes_nothing(merges, monkeypatch):
    texts = pa.array(["some words, and others", "others and some! words", "x" * 5000] * 3)
    want = token_counts.steps(texts, merges)[0].tolist()
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 10)
    monkeypatch.setattr(token_counts, "PAIRS", 3)
    merges.forget()
    assert token_counts.steps(texts, merges)[0].tolist() == want


def test_op12_is_the_librarys(spark, merges):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIR}/documents.parquet").collect()}
    rows = catalog.op12_token_counts(spark, DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text, n = texts[r.doc_id] or "", merges.count(texts[r.doc_id] or "")
        assert (r.n_bytes, r.n_tokens, r.over_limit, r.n_chars) == (len(text.encode()), n, n > 2048, len(text))
        assert merges.count(text[: r.cut_chars]) <= 2048 and (r.cut_chars == len(text) if n <= 2048 else r.cut_chars < len(text))


def test_edges_and_questions(spark, edge_docs, merges):
    path = catalog.tokenizer_file("word_bpe_49k.json")
    counted = token_counts.prefix_counts(edge_docs, path, limits=(0, 3))
    rows = sorted(counted.collect(), key=repr)
    texts = sorted((r.text or "" for r in edge_docs.collect()), key=lambda t: (len(t), t))
    assert sorted(r.n_chars for r in rows) == [len(t) for t in texts]
    assert sorted(r.n_tokens for r in rows) == sorted(merges.count(t) for t in texts)
    short = [(i, t) for i, t in enumerate(["The quick brown fox", "thethethe", "", "   lead", "1234567"])]
    docs = spark.createDataFrame([(i, t, m, p) for i, t in short for m in (0, 1, 2, 3, 99) for p in (0, 1, 4, 400)], "doc_id long, text string, most long, at long")
    told = token_counts.prefix_counts(docs.select("doc_id", "text").distinct(), path).join(docs.drop("text"), "doc_id")
    for r in token_counts.ask(told, "most", "at").collect():
        text = dict(short)[r.doc_id]
        assert r.tokens_at == merges.count(text[: r.at])
        assert r.fits == max((p for p in range(len(text) + 1) if merges.count(text[:p]) <= r.most), default=0)
    none = told.withColumns({"most": F.lit(None).cast("long"), "at": F.lit(None).cast("long")})
    assert {(r.fits, r.tokens_at) for r in token_counts.ask(none, "most", "at").collect()} == {(None, None)}
    assert token_counts.prefix_counts(edge_docs.limit(0), path).count() == 0


# the filter audit


def brute_audit(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({r[0] for r in labels if r[0] is not None and r[k] == 1} for k in (1, 2))
    rows = []
    for i, text, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        rows.append((part or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        here, each = [r for r in rows if r[0] == part], {}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = here
            for step, x in enumerate(order, 1):
                gone = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                each[order, step] = (x, len(left), len(gone), sum(x in r[1] for r in here) - len(gone), sum(r[1] == {x} for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone))
        total = Counter()
        for x, _, gone, *_ in each.values():
            total[x] += gone
        out += [(part, order, step, *v[1:], total[v[0]]) for (order, step), v in each.items()]
    return sorted(out)


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, "k") for r in docs], "doc_id long, text string, source string, mask int, key string")
    found = filter_audit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    return sorted(tuple(r) for r in found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())


def test_audit_by_sql(spark):
    same(catalog.op13_filter_audit(spark, DIR), duck("op13_filter_audit"))


def test_audit_by_brute_force(spark):
    rng = random.Random(9)
    long = " ".join(f"w{i}" for i in range(5000))
    texts = [None, "", " ", "A", "a b", "é" * 300, "é" * 299 + "e", "é" * 300 + "x", "Same words " * 300, "x#", long, long + "#", long[:-1] + "y", "ok " + long, " ".join(f"v{i}" for i in range(220))]
    docs = [(i, rng.choice(texts), rng.choice(["s1", "s2", "", None])) for i in range(90)]
    docs += [(None, "a b", "s1"), (None, "a b", "s1"), (5, "a b", "s2"), (5, "a b", "s2"), (5, "a b", "s1"), (-1, long, "only")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 90, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (7777, 1, 1)]
    assert audited(spark, docs, labels) == brute_audit(docs, labels)


def test_audit_tells_colliding_hashes_apart(spark, monkeypatch):
    texts = ["aaa", "bbb", "aaa", "ccc", "bbb", "ccc", "aaa"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = storage.materialize(filter_audit.features(docs, "doc_id", "text", "source").withColumn("blocks", F.array(F.lit(1).cast("long"))), "features")
    assert sorted(r.id for r in filter_audit.copies(docs, rows, "doc_id", "text", "source").collect()) == [2, 4, 5, 6]


def test_long_texts_are_walked(monkeypatch):
    raw = b"\x0bA b\tb  c\x0c" * 3
    want = filter_audit._words(raw)
    monkeypatch.setattr(filter_audit, "LONG_BYTES", 3)
    assert filter_audit._words(raw) == want == (12, 3)


def test_audit_of_nothing(spark):
    assert audited(spark, [], []) == []


# embeddings at the threshold


def test_links_at_the_threshold_do_not_hang_on_the_axes(spark):
    from newsflow.llm import embedding_dedup as E

    rng = np.random.default_rng(11)
    rows = []
    for i in range(40):  # pairs of signs that differ in one of 20: a cosine of exactly 0.9
        x = rng.choice([-1.0, 1.0], 20)
        y = x.copy()
        y[rng.integers(20)] *= -1
        rows += [(2 * i, x.tolist()), (2 * i + 1, (y * 3).tolist())]
    more = [(1000 + i, rng.normal(size=20).tolist()) for i in range(30)]
    found = E.near_duplicates(spark.createDataFrame(rows + more, "vec_id long, embedding array<double>"), 0.9).collect()
    x = {i: np.array(v) for i, v in rows + more}
    want = {i: sum(j != i and E.cosine(x[i], x[j]) >= 0.9 for j in x) for i in x}
    assert {r.vec_id: r.n_links for r in found} == want and all(want[i] >= 1 for i, _ in rows)
    for _ in range(20):  # any axes give the same links
        axes = np.linalg.qr(rng.normal(size=(20, 20)))[0]
        a, b = (E._Block(np.array([v for _, v in rows[s::2]]), axes) for s in (0, 1))
        i, j = E._tile_links(a, b, 0.9)
        assert {(p, p) for p in range(40)} <= set(zip(i.tolist(), j.tolist(), strict=True))
    huge = [(0, [1e308, 0.0]), (1, [1e308, 1e300]), (2, [1e-300, 1e-305])]
    assert [r.n_links for r in E.near_duplicates(spark.createDataFrame(huge, "vec_id long, embedding array<double>"), 0.9).orderBy("vec_id").collect()] == [2, 2, 2]
