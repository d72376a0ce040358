"""Observations stored by place: bucketed and sorted by chromosome and position, so that merges need no exchange and a region reads few row groups.

All samples lie in one table. What groups or joins by place (``calling.merged_counts``, ``site_evidence``, ``allele_stats``) then works inside the buckets,
and as each file is sorted by place, the statistics of its row groups leave out what lies outside a region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLACE = ["chrom", "pos"]


def store_observations(obs: DataFrame, table: str, buckets: int, mode: str = "errorifexists", row_group_bytes: int = 32 << 20) -> None:
    """Write observations as a table of Spark's catalog, one file for each bucket and write; further samples can be appended.

    The rows are dealt to the buckets before they are written, so that there are as many files as buckets and not one for each task and bucket.
    """
    placed = obs.repartition(buckets, *PLACE).sortWithinPartitions(*PLACE)
    placed.write.mode(mode).format("parquet").option("parquet.block.size", row_group_bytes).bucketBy(buckets, *PLACE).sortBy(*PLACE).saveAsTable(table)


def stored_observations(spark: SparkSession, table: str, chrom: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Observations of a stored table, of a region if one is given; the region's limits are part of the scan."""
    out = spark.table(table)
    if chrom is not None:
        out = out.where(out["chrom"] == chrom)
    if start is not None:
        out = out.where(out["pos"] >= start)
    return out.where(out["pos"] <= stop) if stop is not None else out
