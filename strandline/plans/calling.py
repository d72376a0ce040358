"""The calling plan: pileups of up to four samples to calls."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.operators.calling import SAMPLES, CallParams, at_coordinates, calls, consistent_reference, emitted, records, reference_codes, site_info
from strandline.sources.pileup import observations, site_counts


def observed(pileups: dict[str, DataFrame], coordinates: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Observations of all samples that are given, at the coordinates if there are any; and the samples."""
    given = [s for s in SAMPLES if s in pileups]
    obs = reduce(DataFrame.unionByName, [observations(pileups[s], s) for s in given])
    return at_coordinates(obs, coordinates) if coordinates is not None else obs, given


def call_pileups(pileups: dict[str, DataFrame], p: CallParams = CallParams(), coordinates: DataFrame | None = None, output_all: bool = False, unsure: bool = False) -> DataFrame:
    """Calls over pileup rows by sample name; which samples are given decides the types of the calls.

    Places without a reference base, or whose samples don't agree on one, give no calls; unsure: they are called by the least base that was given, and carry noref
    or diffref in their filter.
    """
    obs, given = observed(pileups, coordinates)
    p = replace(p, supplied=tuple(given))
    if not unsure:
        return calls(consistent_reference(obs), p, output_all)
    coded = reference_codes(obs)
    one = coded.withColumn("ref", F.min("ref").over(Window.partitionBy("chrom", "pos"))).drop("ref_codes")
    return emitted(calls(one, p, output_all), coded, output_all=True)


def call_records(pileups: dict[str, DataFrame], p: CallParams = CallParams(), coordinates: DataFrame | None = None) -> DataFrame:
    """Records over pileup rows by sample name: calls with each sample's evidence, indels and read edges, the site across samples, and all of it as INFO entries."""
    obs, given = observed(pileups, coordinates)
    sites = reduce(DataFrame.unionByName, [site_counts(pileups[s], s) for s in given])
    return site_info(records(consistent_reference(obs), replace(p, supplied=tuple(given)), sites=sites, site=True))
