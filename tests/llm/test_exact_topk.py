"""Exact top-k against brute force over all pairs in Python integers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from strandline.llm import exact_topk as T
from strandline.llm import queries as llm

MOST = 2**63 - 1


def brute(rows, asked, k=5):
    def codes(v):
        if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * 256) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    own = [(i, c) for i, v in rows if (c := codes(v)) is not None]
    out = []
    for i, v in asked:
        q = codes(v)
        if q is None:
            continue
        skipped, found = False, []
        for j, c in own:
            if not skipped and (i, q) == (j, c):
                skipped = True
            elif len(c) == len(q):
                found.append((-max(-MOST, min(MOST, sum(a * b for a, b in zip(q, c, strict=True)))), -(2**63) if j is None else j))
        out += [(i, r, None if j == -(2**63) else j, -s) for r, (s, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def vectors(n=700, seed=2):
    rng = np.random.default_rng(seed)
    low = rng.normal(size=(n, 6)) @ rng.normal(size=(6, 24)) * rng.lognormal(0, 1, (n, 1)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(low.astype(np.float32).astype(float))]
    same = rows[50][1]
    rows += [(1000 + i, same) for i in range(40)] + [(50, same), (50, rows[3][1]), (100, rows[100][1]), (None, same), (None, rows[0][1])]
    rows += [(1050, None), (1100, []), (1101, []), (1150, [0.0] * 24), (1200, [float("nan")] + [1.0] * 23), (1250, [1.0, None]), (1300, [1e308] * 24), (1301, [float("inf")] * 24)]
    rows += [(2000 + i, v) for i, v in enumerate(([1.0, 2.0, 3.0], [1.0, 2.0, -3.0], [300.0, -200.0, 0.5], [1e18, 1.0, 1e18], [-1e18, 1.0, 3e17], [5e17, -5e17, 1e-9], [-0.001, 0.0, 0.999]))]
    rows += [(3000 + 25 * i, [float(x) for x in np.sign(rng.normal(size=12))]) for i in range(60)]  # all of one length
    rows += [(5000, [1.5]), (5001, [-2.0]), (5050, [3.0]), (6000, [1.0] * 5000), (6001, [2.0] * 5000), (6050, [1e290, 1e290]), (6051, [1e290, -1e290]), (6052, [0.0, 0.0]), (6053, [1.0, 1.0])]
    return rows


@pytest.fixture(params=[(4096, 512), (16, 8)])
def block(request, monkeypatch):
    monkeypatch.setattr(T, "ROWS", request.param[0])
    monkeypatch.setattr(T, "STEP", request.param[1])


def test_the_query_is_brute_force(spark, tmp_path, block):
    rows = vectors()
    random.Random(1).shuffle(rows)
    spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<double>, label int, norm double").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = llm.queries()["op12_exact_topk"](spark, str(tmp_path))
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == brute(rows, [(i, v) for i, v in rows if i is not None and i % 50 == 0])


def test_no_rows_and_few_rows(spark):
    kind = "vec_id long, embedding array<float>"
    none = spark.createDataFrame([], kind)
    assert T.top_k(none, none).collect() == []
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.25]), (50, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, kind)
    assert sorted(map(tuple, T.top_k(df, df.where("vec_id % 50 = 0")).collect()), key=str) == brute(rows, [rows[0], rows[2]])
    alone = spark.createDataFrame([(0, [1.0])], kind)
    assert T.top_k(alone, alone).collect() == []


def packed(x):
    x = x[np.argsort(-np.linalg.norm(x, axis=1), kind="stable")]
    n, d = x.shape
    return {"d": d, "n": n, "wide": True, "norms": np.linalg.norm(x, axis=1).tobytes(), "codes": x.tobytes(), "many": np.ones(n, np.int32).tobytes(), "ids": np.arange(n, dtype=np.int64).tobytes()}


def test_bounds_save_most_products():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(4000, 5)) @ rng.normal(size=(5, 64)) * 300 + rng.normal(size=(4000, 64)) * 5) * np.ceil(rng.lognormal(0, 1, (4000, 1)))
    _, _, v = np.linalg.svd(x, full_matrices=False)
    c, q = T.Block(packed(x), v[:32].T.copy()), T.Block(packed(x[:100]), v[:32].T.copy())
    s = T.Search(q, np.full(100, -np.inf), 5)
    s.meet(c)
    every = q.x @ c.x.T
    assert (np.sort(every, 1)[:, ::-1][:, :6] == s.score).all()
    assert s.multiplied < 0.3 * every.size


def test_partial_sums_bound_scores():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(300, 16)) * rng.lognormal(0, 3, (300, 1)) * 100)
    _, _, v = np.linalg.svd(x[:40], full_matrices=False)
    b = T.Block(packed(x), v[:8].T.copy())
    for m, left in zip(b.parts, b.left, strict=True):
        assert (b.lead[:, :m] @ b.lead[:, :m].T + left[:, None] * left >= b.x @ b.x.T - 1e-6).all()


def test_blocks_stay_small_and_equal_vectors_fold(spark):
    df = spark.createDataFrame([(i, [float(i % 7)] * 8) for i in range(400)], "vec_id long, embedding array<double>")
    plan = T.scaled(df, "vec_id", "embedding")
    assert plan.count() == 400 and plan.select("codes").distinct().count() == 7
    got = T.top_k(df, df.where("vec_id = 150"))
    assert [(r["rank"], r["vec_id"]) for r in got.orderBy("rank").collect()] == [(k + 1, 6 + 7 * k) for k in range(5)]
