"""Embedding links: recall against brute force at the threshold, large buckets, odd vectors and rows."""

from __future__ import annotations

import numpy as np
import pytest

from strandline.llm import embedding_dedup

VECTORS = "vec_id long, embedding array<float>, label int, id long, n long, v string, unit string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if v is None else float(v) for v in x], 0, 1, 2, "v", "u") for i, x in rows], VECTORS)


def unit_of(x):
    x = np.asarray(x, np.float32).astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute(x, threshold=0.95):
    y = unit_of(x)
    link = (y @ y.T >= threshold) & ~np.eye(len(y), dtype=bool)
    label = np.arange(len(y))
    while True:
        new = np.array([min(label[k], label[link[k]].min(initial=len(y))) for k in range(len(y))])
        if (new == label).all():
            return link, label
        label = new


def pairs_at(rng, n, d, cosine, common=0.0):
    """n vectors with a common direction of squared share ``common``, and one more at the given cosine from each."""
    x = rng.normal(size=(n, d)) / np.sqrt(d)
    top = np.zeros(d)
    top[0] = 1
    x = np.sqrt(common) * top + np.sqrt(1 - common) * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) * x
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * noise])


@pytest.mark.parametrize("common", [0.0, 0.5, 0.8])
def test_recall_at_the_threshold(spark, common):
    """Pairs just over the threshold, also with a strong common direction."""
    x = pairs_at(np.random.default_rng(1), 1500, 64, 0.9505, common)
    link, label = brute(x)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors(spark, enumerate(x))).collect()}
    n = np.array([got[k].n_links for k in range(len(x))])
    assert link.sum() >= 3000 and (n <= link.sum(1)).all()
    assert n.sum() >= 0.95 * link.sum()


@pytest.mark.parametrize("dense,block", [(48, 1024), (4, 16)])
def test_large_groups(spark, monkeypatch, dense, block):
    """Groups of hundreds of near copies: every way of comparing a bucket gives the same links."""
    monkeypatch.setattr(embedding_dedup, "DENSE", dense)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    x = np.concatenate([c + rng.normal(scale=0.06, size=(150, 32)) for c in rng.normal(size=(3, 32))] + [rng.normal(size=(200, 32))])
    link, label = brute(x)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors(spark, enumerate(x))).collect()}
    n = np.array([got[k].n_links for k in range(len(x))])
    assert (n <= link.sum(1)).all() and n.sum() >= 0.97 * link.sum() > 10_000
    assert all(got[k].component_id == label[k] and got[k].kept == (label[k] == k) for k in range(len(x)))


def test_a_pair_is_judged_by_one_sum():
    """Cosines within rounding of the threshold come out alike in small and large buckets."""
    rng = np.random.default_rng(9)
    x = pairs_at(rng, 300, 16, 0.95)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pa = embedding_dedup.pa
    n = len(x)
    table = pa.table({"id": np.arange(n), "n": np.ones(n, np.int64), "rep": np.arange(n), "tbl": np.zeros(n, np.int32), "key": np.zeros(n, np.int64), **{c: np.zeros(n, np.int32) for c in ("own", "i", "j")}, "codes": [bytes(4)] * n, "unit": [v.tobytes() for v in x]})
    found = []
    for dense in (1, n + 1):
        embedding_dedup.DENSE, before = dense, embedding_dedup.DENSE
        try:
            found.append({tuple(sorted(y)) for y in zip(*(z.tolist() for z in embedding_dedup.Rows(table, 16).near(0.95)), strict=True)})
        finally:
            embedding_dedup.DENSE = before
    assert found[0] == found[1] and len(found[0]) > 50


def test_odd_vectors_and_rows(spark):
    """Repeated ids, repeated vectors, unequal lengths, null and broken vectors."""
    rng = np.random.default_rng(4)
    a, b, c = rng.normal(size=(3, 24))
    rows = [(1, a), (1, b), (2, a), (3, 2 * b), (4, c), (None, c), (5, c[:12]), (6, 3 * c[:12]), (7, None), (8, []), (9, np.zeros(24)), (10, [None, *a[1:]]), (11, [float("inf"), *a[1:]]), (12, rng.normal(size=24)), (13, [5.0]), (14, [7.0]), (15, [-1.0])]
    rows += [(100 + k, rng.normal(size=24)) for k in range(40)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(vectors(spark, rows)).collect())
    null = -(2**63)
    expected = [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 1, null, False), (null, 1, null, True), (5, 1, 5, True), (6, 1, 5, False), *[(k, 0, k, True) for k in range(7, 13)], (13, 1, 13, True), (14, 1, 13, False), (15, 0, 15, True)]
    assert got == sorted(expected + [(100 + k, 0, 100 + k, True) for k in range(40)])
