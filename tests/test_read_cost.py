"""Reads meet calls once, and mates are sorted once."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline import queries
from strandline.operators import reads

DATA = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_reads_meet_calls_once(spark):
    """The reads over a lane are used twice, for their mismatches and for their sums: the second use reads the first one's exchange."""
    for name in ("q_read_loci", "q_read_evidence"):
        text = final_plan(queries.queries()[name](spark, DATA))
        made = [line for line in text.splitlines() if "Exchange hashpartitioning(call_chrom" in line and "read_name" in line and "ReusedExchange" not in line]
        assert len(made) == 1, (name, len(made))


def test_mates_are_sorted_once(spark):
    rows = spark.range(50).select((F.col("id") % 5).alias("k"), (F.col("id") % 7).cast("string").alias("read_name"), (F.col("id") % 2 == 0).alias("overlapping"), F.lit("A").alias("base"), (F.col("id") % 11).cast("int").alias("bq"))
    text = reads.resolve_mates(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 1


def test_plain_reads_need_no_walk(spark):
    """A read of one stretch gives the same as the walk along the same bases cut in two."""
    cut = lambda *c: F.array(*[F.struct(F.lit(op).alias("op"), F.lit(n).alias("len")) for op, n in c])
    at = F.col("id").cast("int")
    for op in (0, 7, 8):
        pairs = spark.range(-2, 14).select(reads.position_in_read(cut((op, 10)), at).alias("a"), reads.position_in_read(cut((op, 4), (op, 6)), at).alias("b"))
        inside = pairs.where("a.op IS NOT NULL").collect()
        assert [r.a.qpos for r in inside if r.a.qpos >= 0] == list(range(10)) and all(r.a == r.b for r in inside)
