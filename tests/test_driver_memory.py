"""What grows with the input is not sent whole through the driver."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.sources import reference


def test_a_reference_is_not_broadcast(spark):
    """A packed row holds 4,096 bases, and Catalyst takes it for twenty bytes: 2,000 rows of one base each would look small enough to broadcast 8 MB."""
    places = spark.range(2000).select(F.lit("1").alias("chrom"), (F.col("id") * reference.CHUNK + 4000).alias("begin"), F.lit("A").alias("value"))
    wanted = spark.range(50).select(F.col("id").alias("k"), F.lit("1").alias("c"), (F.col("id") * reference.CHUNK + 3999).alias("a"), F.lit(2).alias("n"))
    out = reference.stretches(wanted, reference.packed(places), "c", "a", "n", ["k"])
    assert {r.ref for r in out.collect()} == {"NA"}
    assert "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()
