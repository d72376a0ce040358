"""Calls under spans: narrow bins, long spans, and joins whose sides aren't sent through the driver."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from strandline.operators import intervals

CALL, SPAN = "chrom string, pos long", "chrom string, start long, end long, name long"


def made(spark, n=400):
    rng = random.Random(3)
    sizes = [1, 10, 256, 300, 256 * 64, 256 * 64 + 1, 200_000, 256 * 64**2 + 1, 3_000_000]
    spans = [(rng.choice("12"), at := rng.randrange(2_000_000), at + rng.choice(sizes), k) for k in range(n)] + [("1", 500, 500, n), ("1", 700, 600, n + 1)]
    calls = [(rng.choice("12"), rng.randrange(1, 2_000_000)) for _ in range(n)] + [(c, p) for c, a, b, _ in spans[:n] for p in (a, a + 1, b, b + 1)]
    return calls, spans, spark.createDataFrame(calls, CALL), spark.createDataFrame(spans, SPAN)


def test_same_pairs_as_brute_force(spark):
    calls, spans, c, s = made(spark)
    want = sorted((p, k) for x, p in calls for y, a, b, k in spans if x == y and a <= p - 1 < b)
    for deep in (None, 5):
        assert sorted((r.pos, r.name) for r in intervals.near_positions(c, s, "start", "end", deep=deep).select("pos", "name").collect()) == want


def test_a_short_read_meets_few_calls(spark):
    """Calls every ten bases: a read of ten bases shares its bins with those of two bins at most, not with a thousand; a long one touches few bins."""
    size = intervals.NEAR
    calls = spark.range(5000).select(F.explode(intervals.bins_of_base(F.col("id") * 10, size)).alias("b"))
    reads = spark.range(5000).select("id", F.explode(intervals.bins_of_span(F.col("id") * 10, F.col("id") * 10 + 10, size)).alias("b"))
    assert reads.join(calls, "b").groupBy("id").count().agg(F.max("count")).first()[0] <= 2 * (size // 10 + 1)
    long = spark.createDataFrame([(0, 10**k) for k in range(1, 9)], "a long, b long")
    assert long.select(F.max(F.size(intervals.bins_of_span(F.col("a"), F.col("b"), size)))).first()[0] <= 2 * intervals.LONG + 1


def test_calls_are_not_broadcast(spark):
    """Small by Catalyst's estimate or not, calls and spans are sorted and merged."""
    *_, c, s = made(spark, 20)
    plan = intervals.near_positions(c, s, "start", "end")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
