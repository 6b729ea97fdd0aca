"""Operators 1, 8, 9 and 10 against brute force."""

import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa

from newsflow.llm import embedding_dedup, line_dedup, ngram_join, substring_dedup
from newsflow.llm.components import connected_components, local_components
from newsflow.llm.textbytes import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeats(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[p : p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_substring_dedup(spark, small_docs, edge_docs):
    for docs in (small_docs, edge_docs.select("doc_id", "text")):
        rows = docs.collect()
        want = sorted(zip([str(r.doc_id) for r in rows], brute_repeats([r.text for r in rows], 35), strict=True))
        got = substring_dedup.remove_repeats(docs).collect()
        assert sorted((str(r.doc_id), (r.n_words, r.n_removed, r.kept_text)) for r in got) == want


def test_substring_dedup_overlaps_and_columns(spark, edge_docs):
    periodic = " ".join(["a b c"] * 30)
    docs = spark.createDataFrame([(1, periodic), (2, "x " + periodic[:40]), (3, "z")], "doc_id long, text string")
    want = brute_repeats([r.text for r in docs.collect()], 6)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs, window=6).collect()}
    assert [got[i] for i in (1, 2, 3)] == want
    assert "shard" in substring_dedup.remove_repeats(edge_docs).columns
    assert substring_dedup.remove_repeats(edge_docs.limit(0)).count() == 0


def test_substring_dedup_automata_hold_foreign_passages(spark, small_docs, monkeypatch):
    """With many shards every passage comes from another one, and the words decide: results are those of brute force."""
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 20_000)
    rows = small_docs.collect()
    want = sorted(zip([r.doc_id for r in rows], brute_repeats([r.text for r in rows], 35), strict=True))
    got = substring_dedup.remove_repeats(small_docs.select("doc_id", "text")).collect()
    assert sorted((r.doc_id, (r.n_words, r.n_removed, r.kept_text)) for r in got) == want


def test_substring_dedup_takes_patterns_from_given_passages():
    one, two = "a b c d e f", "b c d"
    words = Words(pa.array([one, "x y z x y z", two, "p q r"]))  # two texts of a shard and passages from elsewhere
    hashes = words.all_grams(3)
    tiles = np.array([1, 6])  # b c d; x y z
    given = words.gram_starts(3)[0]
    given = given[given >= 12]
    source, supplied = substring_dedup.patterns(tiles, hashes[tiles], given, hashes[given])
    assert supplied.tolist() == [True, False] and source.tolist() == [12, 6]
    covered = substring_dedup.covered_words(words, 2, np.array([1, 6, 9]), hashes, 3)
    assert covered.tolist() == [False, True, True, True, False, False] + [True] * 6
    # a hash that lies: the words given are others, so nothing is found
    lying = hashes.copy()
    lying[15] = lying[2]
    assert substring_dedup.covered_words(words, 2, np.array([2]), lying, 3).sum() == 0
    # a passage of the shard's own needs a second occurrence
    assert substring_dedup.covered_words(words, 2, np.array([0]), hashes, 3).sum() == 0


def brute_lines(rows, window=3):
    first, gone = {}, {}
    for i, text in sorted(rows):
        lines = [re.sub(r"^\s+|\s+$", "", x) for x in text.split("\n")]
        for p in range(len(lines) - window + 1):
            key = tuple(lines[p : p + window])
            if any(key) and first.setdefault(key, (i, p)) != (i, p):
                gone.setdefault(i, set()).update(range(p, p + window))
    return {i: "\n".join(x for p, x in enumerate(t.split("\n")) if p not in gone.get(i, ())) for i, t in rows}


def test_line_dedup(spark, small_docs, edge_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    got = {r.row.doc_id: r.row.text for r in line_dedup.dedup_lines(small_docs).collect()}
    assert got == brute_lines(rows)
    out = line_dedup.dedup_lines(edge_docs)
    assert out.count() == edge_docs.count() and out.select("row.*").columns == edge_docs.columns
    found = {r.row.doc_id: r for r in out.collect()}
    assert found[2].row.text is None and found[2].n_lines == 0 and found[3].n_lines == 1
    assert found[8].row.text == brute_lines([(8, "a\n\n\nb\nc\nd\n\n\nb\nc\nd")])[8]
    assert line_dedup.dedup_lines(edge_docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "A\nA\nA\nA\nA"), (2, "A\nA\nA")], "doc_id long, text string")
    assert {r.row.doc_id: r.row.text for r in line_dedup.dedup_lines(same).collect()} == {1: "A", 2: ""}


def test_line_dedup_cuts_repeated_rows_once(spark, tmp_path):
    """Of rows equal in id and text one keeps its lines; also in the order in which the table holds them."""
    rows = [(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "x\ny\nz\nw"), (None, "x\ny\nz\nw"), (None, "x\ny\nz\nw"), (2, "k\na\nb\nc")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    got = sorted((str(r.row.doc_id), r.row.text, r.n_removed) for r in line_dedup.dedup_lines(spark.read.parquet(f"{tmp_path}/docs")).collect())
    assert got == sorted([("1", "a\nb\nc", 0), ("1", "", 3), ("None", "x\ny\nz\nw", 0), ("None", "", 4), ("None", "", 4), ("2", "k", 3)])


def test_line_dedup_long_blanks(spark):
    """White space inside a line costs in proportion to its length."""
    text = "a" + " " * 1_000_000 + "b\nc\nd"
    start = time.perf_counter()
    got = line_dedup.dedup_lines(spark.createDataFrame([(1, text), (2, f"  {text}\t")], "doc_id long, text string")).collect()
    assert {r.row.doc_id: r.n_removed for r in got} == {1: 0, 2: 3} and time.perf_counter() - start < 10


def test_line_dedup_runs_no_python(spark, small_docs):
    plan = line_dedup.dedup_lines(small_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[p : p + k]) for p in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(sets, num, den):
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def near_copies(n=60):
    """Texts of 3 to 40 words with edits, so that sizes lie on both sides of the small boundary."""
    rng = np.random.default_rng(5)
    rows, i = [], 0
    for size in (3, 4, 6, 9, 12, 16, 22, 40):
        base = [f"v{rng.integers(400)}" for _ in range(size)]
        for _ in range(n // 6):
            w = list(base)
            for _ in range(int(rng.integers(0, 3))):
                w[int(rng.integers(len(w)))] = f"v{rng.integers(400)}"
            rows.append((i, " ".join(w)))
            i += 1
    return rows


def test_ngram_join(spark, small_docs, monkeypatch):
    for rows, k, num, den in (([(r.doc_id, r.text) for r in small_docs.collect()], 4, 85, 100), (near_copies(), 1, 80, 100), (near_copies(), 2, 60, 100)):
        sets = {i: shingles(t, k) for i, t in rows}
        want = brute_components(sets, num, den)
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        for tile in (1024, 4):  # 4: groups over many tiles
            monkeypatch.setattr(ngram_join, "TILE", tile)
            got = ngram_join.join_components(docs, k, num, den).collect()
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_ngram_join_edges(spark, edge_docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(edge_docs).collect()), key=str)
    by = {i: (n, c) for i, n, c in got if i is not None}
    assert len(got) == 10 and by[2] == (0, 2) and by[3] == (0, 3) and by[5] == (0, 5) and by[7] == (1, 1) and by[4][1] == 4
    kept = ngram_join.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, (1, 2, 3, 4, 5, 6, 8, None)))
    assert ngram_join.join_components(edge_docs.limit(0)).count() == 0


def test_ngram_join_keeps_by_row(spark):
    """Null and repeated ids of different texts: only linked rows compete."""
    text = lambda name: " ".join(f"{name}{i}" for i in range(12))
    rows = [
        (1, text("a")), (5, text("a")), (5, text("b")), (5, text("c")), (6, text("c")), (None, text("a")), (None, text("d")), (None, text("d")), (None, text("e")), (None, text("f")),
        (None, None), (None, None), (None, " "), (7, ""), (7, None), (8, text("f") + " more"),
    ]
    want = [(1, text("a")), (5, text("b")), (5, text("c")), (None, text("d")), (None, text("e")), (8, text("f") + " more"), (None, None), (None, None), (None, " "), (7, ""), (7, None)]
    docs = spark.createDataFrame([(*r, {"k": 1}) for r in rows], "doc_id long, text string, m map<string, int>")
    assert sorted(map(repr, ((r.doc_id, r.text) for r in ngram_join.keep_one(docs).collect()))) == sorted(map(repr, want))


def test_ngram_join_light_side(spark, monkeypatch):
    """Short sets of words that many texts share: measured lists are long, so their links come from subsets."""
    rng = np.random.default_rng(9)
    rows, i = [], 0
    for _ in range(40):
        base = rng.choice(60, int(rng.integers(8, 13)), replace=False).tolist()
        for _ in range(3):
            w = [*base, int(rng.integers(60, 90))] if rng.random() < 0.6 else base
            rows.append((i, " ".join(f"w{x}" for x in w)))
            i += 1
    seen, plain = [], ngram_join.Rule.boundary
    monkeypatch.setattr(ngram_join.Rule, "boundary", lambda self, sizes: seen.append(plain(self, sizes)) or seen[-1])
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85, 100).collect()}
    sets = {i: shingles(t, 1) for i, t in rows}
    assert got == brute_components(sets, 85, 100) and seen[0] >= 8
    # sets of up to small * num // den shingles are on no list: what links them is a subset
    rule = ngram_join.Rule(1, 85, 100)
    only = [s for s in sets.values() if len(s) <= seen[0] * 85 // 100]
    pairs = sum(a < b and len(x & y) * 100 >= 85 * len(x | y) and x != y for a, x in enumerate(only) for b, y in enumerate(only))
    assert pairs > 0 and rule.subsets(8) == 9


def test_signatures_meet():
    """Partners always share a signature, whatever their sizes."""
    rule, rng = ngram_join.Rule(4, 85, 100), np.random.default_rng(1)
    for n in (*range(1, 30), 60, 150, 400):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            m = int(rng.integers(0, max(1, n * 15 // 100) + 1))
            b = np.unique(np.concatenate([a[m:], rng.integers(0, 2**63, int(rng.integers(0, m + 2))).astype(np.uint64)]))
            if len(b) and rule.links(len(np.intersect1d(a, b)), len(a), len(b)):
                often = [1 + np.isin(x, y).astype(np.uint8) for x, y in ((a, b), (b, a))]
                assert all((o > 1).sum() >= rule.least(len(o)) for o in often)
                for small in (0, 8, 16):
                    found, owner = ngram_join.signatures([a, b], often, rule, small)
                    assert np.intersect1d(found[owner == 0], found[owner == 1]).size


def test_embedding_dedup(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 24))
    x = np.concatenate([base, base[:15] + rng.normal(size=(15, 24)) * 0.2, base[:5], base[3:4] * 7])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None), (n + 1, []), (n + 2, [0.0] * 24), (n + 3, [float("nan")] * 24), (n + 4, [None] * 24), (n + 5, [1.0, 2.0]), (n + 6, [2.0, 4.0]), (0, x[0].tolist())]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 16 * 24 * 8)
    monkeypatch.setattr(embedding_dedup, "TILE", 5)
    links = {i: [j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in unit}
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == len(rows)
    root = {i: i for i, _ in rows}
    for _ in rows:
        for i, js in links.items():
            root[i] = min([root[i], *(root[j] for j in js)])
    for r in got:
        assert r.component_id == root[r.vec_id] and r.kept == (r.vec_id == root[r.vec_id])
        copies = 1 if r.vec_id == 0 else 0  # the repeated row of vector 0
        assert r.n_links == len(links.get(r.vec_id, [])) + (copies if r.vec_id == 0 else int(0 in links.get(r.vec_id, [])))
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_blocks_hold_together():
    """Every pair within reach along the first axis meets in a pair of blocks; vectors that share a coordinate are spread."""
    rng = np.random.default_rng(8)
    lead = np.concatenate([rng.normal(0, 0.4, 400), np.full(300, 0.25)])
    cuts = np.quantile(lead, np.arange(1, 14) / 14)
    keys = rng.integers(-(2**63), 2**63, len(lead))
    block, (first, last) = embedding_dedup.blocks_of(lead, keys, cuts).astype(int), embedding_dedup.in_reach(cuts, 0.447)
    near = np.abs(lead[:, None] - lead[None, :]) <= 0.447
    met = (first[block][:, None] <= block[None, :]) & (block[None, :] <= last[block][:, None])
    assert (met | ~near).all() and (met == met.T).all() and not met.all()
    assert np.bincount(block, minlength=14).max() < 150


def test_components(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 80, 60), rng.integers(0, 80, 60)
    want = local_components(80, a, b)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b, strict=True)], "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(80))
    chain = {r.node: r.root for r in connected_components(spark.range(50).selectExpr("id as a", "id + 1 as b")).collect()}
    assert set(chain.values()) == {0}


