"""Merging of call sets by (chrom, pos)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["chrom", "pos"]
PASS = lambda s: F.coalesce(F.array_contains(F.col(f"{s}.filter"), "PASS"), F.lit(False))


def union_sorted(parts: list[DataFrame]) -> DataFrame:
    """All parts, numbered chromosomes first in number order, then the others, each by position."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.orderBy(F.expr("try_cast(chrom AS int)").asc_nulls_last(), "chrom", "pos")


def overlay(originals: DataFrame, passing: DataFrame) -> DataFrame:
    """Every original place, with the passing set's row where it has one."""
    cols = [c for c in originals.columns if c not in KEYS]
    side = passing.select(*KEYS, F.struct(*cols).alias("_new"))
    return originals.select(*KEYS, F.struct(*cols).alias("_old")).join(side, KEYS, "left").select(*KEYS, F.coalesce("_new", "_old").alias("_x")).select(*KEYS, "_x.*")


def merged_filters(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>")))))


def support_label(kind: Column, origin: Column) -> Column:
    """The label of a call by its type and by which evidence found it."""
    dna, rna = F.array_contains(origin, "DNA"), F.array_contains(origin, "RNA")
    som = F.when(dna & rna, "RADIASomRNAConf").when(dna, "RADIASomDNA").otherwise("RADIASomRNARescue")
    return F.when(kind == "GERM", "RADIAGerm").when(kind == "SOM", som).when(kind == "TUM_EDIT", "RADIATumEdit").when(kind == "RNA_TUM_VAR", "RADIATumRNAVar").when(kind == "NOR_EDIT", "RADIANorEdit").when(kind == "RNA_NOR_VAR", "RADIANorRNAVar")


FIELDS = ["filter", "types", "origin", "mod_filters"]


def merge_rna_and_dna(dna: DataFrame, rna: DataFrame, overlaps: DataFrame, non_overlaps: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Priority merge of four sets of calls (filter, types, origin, mod_filters arrays, and the columns that ``carry`` names); see ``resolved``."""
    fields = [*FIELDS, *(carry or [])]
    # one shuffle: the four sets as one, each row marked with the set it comes from; a set has a place once
    kind = dna.select(F.struct(*fields).alias("x")).schema["x"].dataType
    blank = F.lit(None).cast(kind)
    parts = [df.select(*KEYS, F.lit(name).alias("s"), (F.struct(*fields).cast(kind) if name != "o" else blank).alias("x")) for df, name in ((dna, "d"), (overlaps, "o"), (non_overlaps, "n"), (rna, "r"))]
    pick = lambda name: F.first(F.when(F.col("s") == name, F.col("x")), ignorenulls=True).alias(name)
    j = reduce(DataFrame.unionByName, parts).groupBy(*KEYS).agg(pick("d"), pick("n"), pick("r"), F.bool_or(F.col("s") == "o").alias("both"))
    return resolved(j, carry).select(*KEYS, *fields, "sst")


def resolved(j: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rows with d, n, r (structs of FIELDS and ``carry``, or null) and both, with these fields of the call that stands and its label sst; rows where none stands go.

    DNA rows come first; overlapping ones gain the RNA origin. A passing row that only RNA has (n) replaces a failing DNA row, and a passing one unless that mentions
    GERM or SOM, by the passing RNA row r as its own filter left it; where there is no DNA row, n stands. Failing rows add their filters to a failing
    DNA row, or stand for themselves. All other fields, judged modifications among them, are those of the row that stands.
    """
    tagged = F.when(F.coalesce("both", F.lit(False)), F.array_union("d.origin", F.array(F.lit("RNA")))).otherwise(F.col("d.origin"))
    strong = F.coalesce(F.arrays_overlap("d.types", F.array(F.lit("GERM"), F.lit("SOM"))), F.lit(False))
    has_d, has_n, has_r = (F.col(f"{s}.filter").isNotNull() for s in "dnr")
    n_wins = has_n & PASS("n") & (~PASS("d") | ~strong)
    # failing rows that add to a failing DNA row: those that only RNA has, then failing RNA rows
    adds_n, adds_r = has_n & ~PASS("n") & ~PASS("d"), has_r & ~PASS("r") & ~PASS("d") & ~n_wins

    def base(f: str) -> Column:
        return F.when(n_wins & has_d & PASS("r"), F.col(f"r.{f}")).when(n_wins, F.col(f"n.{f}")).when(has_d, tagged if f == "origin" else F.col(f"d.{f}")).when(has_n & adds_n, F.col(f"n.{f}")).when(adds_r, F.col(f"r.{f}"))

    def with_added(f: str) -> Column:
        out = base(f)
        out = F.when(adds_n & has_d, merged_filters(out, F.col(f"n.{f}"))).otherwise(out)
        return F.when(adds_r & (has_d | adds_n), merged_filters(out, F.col(f"r.{f}"))).otherwise(out)

    kept = [c for c in j.columns if c not in ("d", "n", "r", "both", *FIELDS, *(carry or []))]
    out = j.select(*kept, *[(base(f) if f == "types" else with_added(f)).alias(f) for f in FIELDS], *[base(f).alias(f) for f in carry or []])
    out = out.where("filter IS NOT NULL")
    return out.withColumn("sst", support_label(F.get("types", 0), F.col("origin")))


def traced(filters: Column, info: Column, types: Column) -> Column:
    """A trace of DNA: a dnm* code, DB, EGPS or RTPS, or a GERM type."""
    found = F.exists(filters, lambda f: f.startswith("dnm")) | F.arrays_overlap(F.map_keys(info), F.array(F.lit("DB"), F.lit("EGPS"), F.lit("RTPS"))) | F.array_contains(types, "GERM")
    return F.coalesce(found, F.lit(False))


def rna_only(calls: DataFrame) -> DataFrame:
    """Calls without a DNA trace: no dnm* code, no DB, EGPS or RTPS flag, no GERM type; what is left passes."""
    return calls.where(~traced(F.col("filter"), F.col("info"), F.col("types"))).withColumn("filter", F.array(F.lit("PASS")))


def passing(calls: DataFrame) -> DataFrame:
    return calls.where(F.array_contains("filter", "PASS"))
