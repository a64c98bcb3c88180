"""Hard negatives, repeated byte strings and vector codes against plain versions, also on odd input."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskspark.llm import hard_negatives, suffix_dedup, vector_codes, vectors

VECTORS = "vec_id long, embedding array<float>, label int, hot_ int, key_ string, cell int"


def clusters(n, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(4, dims))
    kind = rng.integers(0, 4, n)
    return (middles[kind] + rng.normal(scale=0.6, size=(n, dims))).round(3).astype(np.float32), kind


def odd_vectors(n=240):
    """Clusters with copies of vectors and of whole rows, and rows that can take no part."""
    x, kind = clusters(n)
    x[40:70] = x[40]
    rows = [(i, x[i].tolist(), int(k), 1, "k", 7) for i, k in enumerate(kind)]
    rows += [rows[50], rows[50], rows[3]]
    bad = [None, [], [None] * 8, [float("nan")] + [0.0] * 7, [float("inf")] + [0.0] * 7, [1.0] * 5]
    return rows, [(1000 + i, v, 1, 1, "k", 7) for i, v in enumerate(bad)]


def plain_negatives(rows, scale=256):
    ids, labels = (np.array([r[k] for r in rows]) for k in (0, 2))
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * scale).astype(int)
    out = []
    for a in np.flatnonzero(ids % 10 == 0):
        score = x @ x[a]
        order = [j for j in np.lexsort((ids, -score)) if j != a]
        for p in [j for j in order if labels[j] == labels[a]][:5]:
            fits = [j for j in order if labels[j] != labels[a] and 50 * score[p] <= 100 * score[j] <= 95 * score[p]][:3]
            out += [(ids[a], ids[p], k + 1, ids[j], score[p], score[j]) for k, j in enumerate(fits)]
    return sorted(tuple(map(int, r)) for r in out)


@pytest.mark.parametrize("least_rows, leaf, fanout", [(4096, 128, 16), (30, 4, 3)])
def test_negatives_are_those_of_all_pairs(spark, monkeypatch, least_rows, leaf, fanout):
    for name, value in (("LEAST_ROWS", least_rows), ("LEAF", leaf), ("FANOUT", fanout)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows, bad = odd_vectors()
    nulls = [(None, [1.0] * 8, 1, 1, "k", 7), (2000, [1.0] * 8, None, 1, "k", 7)]
    df = spark.createDataFrame(rows + bad + nulls, VECTORS)
    got = hard_negatives.mine(df, F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_a_cover_tree_skips_and_finds():
    x, kind = clusters(3000, seed=5)
    points = np.floor(x.astype(float) * 256)
    tree = hard_negatives.CoverTree(points, kind, np.arange(3000), np.arange(3000))
    for depth, level in enumerate(tree.levels):
        for centre, radius, (a, b) in zip(level.centres, level.radii, level.rows):
            own = tree.points[a:b]
            score = own @ points[7]
            assert np.all(np.abs(score - centre @ points[7]) <= np.linalg.norm(points[7]) * radius)
    visited = []
    visit = tree._visit
    tree._visit = lambda found, search, leaves, *rest: visited.extend(leaves.tolist()) or visit(found, search, leaves, *rest)
    search, score, ids, _ = tree.best(points[:1], kind[:1], np.array([0]), np.array([0]), np.array([-np.inf]), np.array([np.inf]), True, 5)
    all_scores = points @ points[0]
    want = [j for j in np.lexsort((np.arange(3000), -all_scores)) if j and kind[j] == kind[0]][:5]
    assert ids.tolist() == want and score.tolist() == all_scores[want].astype(int).tolist()
    assert len(visited) < sum(level.leaf.sum() for level in tree.levels) / 2


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    x = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * scale).astype(int).reshape(len(rows), parts, -1)
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], rows[i][1]))[:entries]
    books = x[first].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        far = ((x[:, :, None] - books[None]) ** 2).sum(-1)
        code = far.argmin(-1)
        for p in range(parts if k < rounds else 0):
            for e in set(code[:, p].tolist()):
                books[p, e] = x[code[:, p] == e, p].sum(0) // (code[:, p] == e).sum()
    error = far.min(-1).sum(-1)
    by_label = Counter()
    for r, e in zip(rows, error.tolist()):
        by_label[r[2]] += e
    return sorted((repr(r[0]), bytes(c.astype(np.uint8)).hex(), int(e), by_label[r[2]]) for r, c, e in zip(rows, code, error)), books


@pytest.mark.parametrize("n, hot_share", [(240, 1000), (240, 2), (5, 1000)])
def test_codes_are_those_of_whole_rescans(spark, monkeypatch, n, hot_share):
    monkeypatch.setattr(vectors, "HOT_SHARE", hot_share)
    rows, bad = odd_vectors()
    rows = rows[:n] + rows[240:241] + [(None, rows[0][1], 2, 1, "k", 7), (5000, rows[1][1], None, 1, "k", 7), (5001, rows[2][1], None, 1, "k", 7)]
    codes, books = vector_codes.compress(spark.createDataFrame(rows + bad, VECTORS).repartition(3))
    want, expected_books = plain_codes(rows)
    assert sorted((repr(r.vec_id), r.code, r.error, r.label_error) for r in codes.collect()) == want
    assert np.array_equal(books, expected_books)
    assert vector_codes.digest(books) == hashlib.sha256(",".join(str(v) for v in expected_books.reshape(-1)).encode()).hexdigest()


def test_only_moved_entries_can_take_a_part_that_stayed():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x, old = rng.integers(-4, 5, (50, 2)), rng.integers(-4, 5, (6, 2))
        code, apart = vector_codes.nearest(x, old)
        new = np.where(rng.random((6, 1)) < 0.4, rng.integers(-4, 5, (6, 2)), old)
        got = vector_codes.reassign(x, new, (new != old).any(axis=1), code, apart)
        assert all(np.array_equal(a, b) for a, b in zip(got, vector_codes.nearest(x, new)))


def test_tables_without_usable_vectors(spark):
    _, bad = odd_vectors()
    for rows in ([], bad[:5], [(1, [1.0] * 5, 1, 1, "k", 7)]):
        df = spark.createDataFrame(rows, VECTORS)
        codes, books = vector_codes.compress(df)
        assert codes.count() == 0 and books.size == 0 and codes.columns == ["vec_id", "label", "code", "error", "label_error"]
        assert hard_negatives.mine(df, F.col("vec_id") % 10 == 0).count() == 0


def plain_repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[s:s + length] for t in raw for s in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone[s:s + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("hot, entry, chunk, sorted_at_once", [(4096, 512, 1 << 18, 1 << 18), (2, 40, 700, 500)])
def test_repeats_are_those_of_all_windows(spark, monkeypatch, hot, entry, chunk, sorted_at_once):
    for name, value in (("HOT", hot), ("ENTRY", entry), ("CHUNK", chunk), ("SORTED", sorted_at_once)):
        monkeypatch.setattr(suffix_dedup, name, value)
    r = random.Random(hot)
    base = ["".join(r.choice("abcd é\n") for _ in range(r.randint(50, 400))) for _ in range(5)] + ["a" * 900, "ab" * 300]
    texts = ["".join(b[(x := r.randint(0, 100)):x + r.randint(0, 500)] + r.choice(["", "q", " "]) for b in r.choices(base, k=r.randint(1, 4))) for _ in range(40)]
    passage = "".join(r.choice("xyz ") for _ in range(150))
    texts += [f"{r.random()} {passage} {r.random()}" for _ in range(12)]  # one passage in many texts: all edges differ
    texts += base + [None, "", None, "n" * 99, "p" * 100, "s" * 101, texts[0], texts[0]]
    df = spark.createDataFrame([(i, t, "x", 1, 2, b"") for i, t in enumerate(texts)], "doc_id long, text string, row string, at int, low int, kept binary")
    got = {row.doc_id: tuple(row[1:5]) + (bytes(row.kept),) for row in suffix_dedup.without_repeats(df.repartition(3), 100).collect()}
    assert [got[i] for i in range(len(texts))] == plain_repeats(texts, 100)


def test_repeats_with_equal_and_null_ids_and_without_rows(spark):
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(500))
    rows = [(1, text), (1, text), (None, text[:450]), (None, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((repr(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.without_repeats(df).collect())
    assert got == [("1", 500, 500, 1), ("1", 500, 500, 1), ("None", 5, 0, 0), ("None", 450, 450, 1)]
    none = suffix_dedup.without_repeats(df.limit(0))
    assert none.count() == 0 and none.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
