"""Operators 6 and 10 against brute force; edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import ann, components, ngram_join

SPLIT = " \t\n\x0b\x0c\r"


def word_set(text):
    for c in SPLIT:
        text = (text or "").replace(c, " ")
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(i, word_set(t)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def family(rng, i, n_words, members, edits):
    words = [f"w{rng.randrange(400)}" for _ in range(n_words)]
    for k in range(members):
        own = list(words)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        cut = rng.randrange(max(1, n_words // 8))
        yield i + k, " ".join(own[cut:] if rng.random() < 0.3 else own)


def test_join_equals_brute_force(spark):
    rng = random.Random(11)
    rows, i = [], 0
    for n_words, members, edits in [(6, 6, 1), (9, 8, 1), (14, 8, 1), (30, 10, 1), (83, 8, 2), (84, 8, 3), (130, 10, 4), (260, 25, 6), (270, 25, 8), (700, 10, 12), (1500, 6, 25)]:
        rows += family(rng, i, n_words, members, edits)
        i += members
    rows += [(i, None), (i + 1, ""), (i + 2, "Only Four words here"), (i + 3, "only  four\nWORDS here"), (i + 4, "ÄB c d e f g"), (i + 5, "äB c d e f g")]
    rng.shuffle(rows)
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_join_edge_cases(edge_docs, edge_rows, no_docs):
    got = ngram_join.ngram_jaccard_join(edge_docs).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert len(by[None]) == 1 and by[None][0][0] > 0 and by[None][0][1] is None and len(got) == len(edge_rows)
    assert by[1] == by[2] == [(by[1][0][0], 1)] and by[3][0][1] == 1 and by[11] == by[1] * 2
    assert by[4] == [(0, 4)] and by[5] == [(0, 5)] and by[6] == [(0, 6)]
    assert by[7] == [(1, 7)] and by[8] == [(1, 7)]
    assert ngram_join.ngram_jaccard_join(no_docs).count() == 0


def test_blocks_split_large_groups(spark, monkeypatch):
    """With tiny blocks, pairs across blocks are found as well."""
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rng = random.Random(2)
    rows = list(family(rng, 0, 150, 40, 7))
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == brute_components(rows)


def test_shared_keys_over_any_batches():
    rng = random.Random(4)
    rows = sorted((rng.randrange(12), rng.randrange(25)) for k in range(30))
    want = sorted({(k, i) for k, i in rows if len({y for x, y in rows if x == k}) > 1})
    for size in range(1, 9):
        batches = [pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows[s : s + size]], pa.int64()) for c in (0, 1)], ["key", "id"]) for s in range(0, len(rows), size)]
        got = [tuple(x) for b in ngram_join._shared(iter(batches)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert got == want


@pytest.mark.parametrize(("size", "more"), [(300, 12), (40, 2), (2000, 300), (40_000, 1_500)])
def test_tree_bound_never_excludes_similar_sets(size, more):
    rng, many = np.random.default_rng(0), 40 if size < 1000 else 6
    base = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
    sets = [np.unique(np.concatenate([base[rng.random(len(base)) < 0.93], rng.integers(0, 2**63, more * (k % 3)).astype(np.uint64)])) for k in range(many)]
    sets += [np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)) for _ in range(10)]
    points, sizes = ngram_join.points_of([ngram_join.group_counts(s) for s in sets]), np.array([len(s) for s in sets])
    tree, found = ngram_join.CountTree(points, sizes), 0
    for k, s in enumerate(sets):
        near, bound = tree.near(points[k], int(sizes[k]))
        assert {j for j, t in enumerate(sets) if ngram_join.similar(s, t)} <= set(near.tolist())
        assert all(len(np.intersect1d(s, sets[j])) <= b * (len(s) + len(sets[j])) + 1e-9 for j, b in zip(near, bound, strict=True))
        found += len(near) if k >= many else 0
    assert found == (10 if size < 30_000 else found)  # unlike sets meet nobody but themselves


def test_crowded_groups_keep_the_bound():
    """Counts over 15, as of hashes that share their leading bits, leave the bound an upper one."""
    a = np.arange(1, 2001, dtype=np.uint64)
    b = np.concatenate([a[:1900], np.arange(5000, 5080, dtype=np.uint64)])
    points = ngram_join.points_of([ngram_join.group_counts(a), ngram_join.group_counts(b)])
    near, bound = ngram_join.CountTree(points, np.array([len(a), len(b)])).near(points[0], len(a))
    assert sorted(near.tolist()) == [0, 1] and ngram_join.similar(a, b) and min(bound) * 3980 >= 1900


def test_large_groups_are_contracted_not_expanded(spark):
    """250 near copies of one text and 60 texts that share a passage: pairs verified stay near the number of texts."""
    rng = random.Random(8)
    rows = list(family(rng, 0, 300, 250, 2))
    passage = [f"p{k}" for k in range(60)]
    rows += [(1000 + k, " ".join([*(f"v{rng.randrange(10**6)}" for _ in range(120)), *passage])) for k in range(60)]
    docs = spark.createDataFrame(rows, "id long, text string")
    sig = docs.mapInArrow(ngram_join._signatures, "id long, n long, d1 long, d2 long, vec binary, keys array<long>")
    log = []
    ngram_join._link(sig, docs, log)
    assert sum(x["candidates"] for x in log) <= 4 * 250 and log[-1]["open"] == 0 and len(log) <= 4
    assert sorted(map(tuple, ngram_join.ngram_jaccard_join(docs, "id").collect())) == brute_components(rows)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (3, 10), (20, 21), (21, 22), (22, 23), (23, 24), (24, 20), (None, 1)]
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 1), (3, 1), (8, 8), (9, 8), (10, 1), (20, 20), (21, 20), (22, 20), (23, 20), (24, 20)]
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


VEC = "vec_id long, embedding array<float>, shard int, id string"


def test_ann_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD", 300)
    rng = np.random.default_rng(1)
    v = rng.standard_normal((1500, 24)).astype(np.float32) * rng.uniform(0.2, 3, (1500, 1)).astype(np.float32)
    v[100:140] = v[60]  # ties
    rows = spark.createDataFrame([(i, x.tolist(), 1, "a") for i, x in enumerate(v)], VEC)
    got = {}
    for r in ann.nearest(rows, rows.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    w, hits = v.astype(np.float64), 0
    for q in range(0, 1500, 20):
        score = w @ w[q]
        score[q] = -np.inf
        best = np.lexsort((np.arange(1500), -score))[:20]
        hits += len({x for x, _ in got[q]} & set(best.tolist()))
        assert len(got[q]) == 20 and q not in {x for x, _ in got[q]}
        assert all(abs(s - score[x]) < 1e-9 for x, s in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
    assert hits / (75 * 20) >= 0.9


def test_ann_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, "a"), (1, [0.5, 0.5], 1, "a"), (2, None, 1, "a"), (3, [0.0, 0.0], 1, "a"), (4, [nan, 1.0], 1, "a"), (5, [inf, 1.0], 1, "a"), (6, [None, 1.0], 1, "a"), (20, [0.5, 0.5], 1, "a"), (40, None, 1, "a"), (7, [], 1, "a"), (None, [1.0, 1.0], 1, "a")]
    df = spark.createDataFrame(rows, VEC)
    got = [tuple(r) for r in ann.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, 0.5), (20, 1, 0, 0.5), (20, 2, 1, 0.5)]
    assert ann.nearest(df.limit(0), df).count() == 0 and ann.nearest(df, df.limit(0)).count() == 0


def test_ann_keeps_extreme_vectors_lengths_and_ties(spark, monkeypatch):
    """Vectors whose squares leave the range of doubles, two lengths in one table, and many copies of one vector."""
    monkeypatch.setattr(ann, "SHARD", 100)
    rows = [(0, [1e-200, 0.0]), (1, [1e200, 1.0]), (2, [5e-324, 5e-324]), (20, [1.0, 0.0, 2.0]), (3, [1.0, 1.0, 1.0])]
    rng = np.random.default_rng(3)
    one = rng.standard_normal(7).tolist()
    rows += [(k, one) for k in range(100, 1300)] + [(40, [-x for x in one]), (60, one)]
    df = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in ann.nearest(df, df.where("vec_id in (0, 1, 20, 40, 60)")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got[0])[0] == (1, 1, 1.0) and len(got[0]) == 2 and {x[1] for x in got[1]} == {0, 2}
    assert sorted(got[20]) == [(1, 3, 3.0)]
    assert [x[1] for x in sorted(got[60])] == list(range(100, 120)) and [x[1] for x in sorted(got[40])] == [60, *range(100, 119)]


def test_chi_square():
    assert abs(ann.chi_square_quantile(0.95, 8) - 15.507) < 1e-3 and abs(ann.chi_square_quantile(0.5, 2) - 1.386) < 1e-3
