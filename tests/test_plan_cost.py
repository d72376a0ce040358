"""What the filter plan evaluates for each call: nothing twice, and nothing that isn't read."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline import queries
from strandline.functions.rounding import at_least_text, hundredths
from strandline.operators import calling
from strandline.plans.filtering import FilterPlan

OBS = "chrom string, pos long, ref string, sample string, base string, bq int, mq int, plus boolean"


def records(spark):
    rows = [("1", 10, "A", s, b, 40, 40, k % 2 == 0) for s, b, n in (("DNA_NORMAL", "A", 30), ("DNA_TUMOR", "A", 20), ("DNA_TUMOR", "C", 15), ("RNA_TUMOR", "C", 12)) for k in range(n)]
    return calling.records(spark.createDataFrame(rows, OBS)).withColumns({"id": F.array().cast("array<string>"), "info": F.expr("map('SS', array('2'))")})


def optimized(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended").split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]


def test_allele_statistics_are_looked_up_once(spark):
    """Each sample's alleles meet the place's map in one expression, not once for each field."""
    text = optimized(records(spark))
    assert text.count("concat(DNA_TUMOR_") == 1, text.count("concat(DNA_TUMOR_")


def test_genotypes_are_for_those_who_read_them(spark):
    out = FilterPlan(dna=queries.DNA_LOW, rna=queries.RNA_LOW).run(records(spark))
    assert {"dn_gt", "rn_gt", "dt_gt", "rt_gt"} <= set(out.columns) and "_rna" not in out.columns
    assert "_gt" not in optimized(out.select("chrom", "pos", "filter"))
    assert [(r.dn_gt, r.dt_gt, r.rn_gt) for r in out.collect()] == [([0, 0], [0, 1], None)]


def test_shares_are_compared_without_a_quotient(spark):
    """Against the rounded quotient, ties in both directions, counts above the total and a total of 0."""
    pairs = spark.range(0, 260).select(F.col("id").alias("t")).crossJoin(spark.range(0, 280).select(F.col("id").alias("c")))
    limits = [-1, 0, 1, 3, 10, 14, 29, 50, 58, 99, 100, 101, 107]
    wrong = [F.count_if(~F.expr(at_least_text("c", "t", h)).eqNullSafe(hundredths(F.col("c"), F.col("t")) >= h)).alias(f"h{h}") for h in limits]
    assert not any(pairs.agg(*wrong).first())
