"""Allele counts over a stream of observations or pileup text that arrives in files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.operators.calling import CallParams, allele_stats, merged_counts
from strandline.sources import pileup

SCHEMA = "chrom string, pos long, ref string, sample string, base string, bq int, mq int, plus boolean"


def observation_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Observations that arrive as Parquet files."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def pileup_stream(spark: SparkSession, path: str, sample: str, files_per_trigger: int = 100) -> DataFrame:
    """Observations of a sample whose pileup text arrives in files (plain or gzip), decoded batch by batch as in ``pileup.observations``."""
    rows = spark.readStream.schema(pileup.SCHEMA).option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files_per_trigger).csv(path)
    return pileup.observations(pileup.cleaned(rows), sample)


def running_allele_stats(stream: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """The batch statistics, kept up to date; write it in update or complete mode. State is one row per position, sample and base."""
    return allele_stats(stream, p)


def running_counts(stream: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """The merged counts that calls are made from, one row of state per position, kept up to date; ``calling.find_variants`` works on what update mode emits."""
    return merged_counts(stream, p)
