"""Realignment evidence: hits of each variant read, and whether its best hit is at the call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.rounding import hundredths
from strandline.functions.strings import flag
from strandline.operators.intervals import plain_chrom
from strandline.operators.reads import PAIRED, PROPER, SECONDARY


def overlaps_call(subject: Column, start: Column, end: Column, chrom: Column, pos: Column) -> Column:
    """The hit covers the call's base, in either orientation, with or without a chr prefix."""
    return (plain_chrom(subject) == plain_chrom(chrom)) & (F.least(start, end) <= pos - 1) & (F.greatest(start, end) >= pos - 1)


def considered(flags: Column, dna: Column, secondary: bool = False) -> Column:
    primary = ~flag(flags, SECONDARY)
    return F.when(dna, flag(flags, PAIRED) & flag(flags, PROPER) & primary).otherwise(primary | F.lit(secondary))


def valid_reads_blast(hits: DataFrame, keys: list[str], magnitude: int = 0) -> DataFrame:
    """Per call and read: whether some alignment of over half the read at the call beats all others, by e-value (scaled by 10 ** magnitude) or by identity.

    Needs overlapping, usable (booleans), length, read_length, evalue, identity. Without a qualifying overlapping hit a read is not valid.
    """
    long = F.col("usable") & (F.col("length") > F.col("read_length") / 2)
    here, there = long & F.col("overlapping"), long & ~F.col("overlapping")
    best = hits.groupBy(*keys).agg(
        F.min(F.when(here, F.col("evalue"))).alias("e_here"), F.min(F.when(there, F.col("evalue"))).alias("e_there"),
        F.max(F.when(here, F.col("identity"))).alias("i_here"), F.max(F.when(there, F.col("identity"))).alias("i_there"),
    )
    wins = F.col("e_there").isNull() | (F.col("e_here") * (10.0**magnitude) < F.col("e_there")) | (F.col("i_here") > F.coalesce("i_there", F.lit(0.0)))
    return best.withColumn("valid", F.col("e_here").isNotNull() & wins)


def valid_reads_psl(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Per call and read: whether no other place scores higher than the best one at the call. Needs overlapping, usable, score."""
    here, there = F.col("usable") & F.col("overlapping"), F.col("usable") & ~F.col("overlapping")
    best = hits.groupBy(*keys).agg(F.max(F.when(here, F.col("score"))).alias("s_here"), F.max(F.when(there, F.col("score"))).alias("s_there"))
    return best.withColumn("valid", F.col("s_here").isNotNull() & ~F.coalesce(F.col("s_there") > F.col("s_here"), F.lit(False)))


def judge_calls(reads: DataFrame, keys: list[str], min_reads: int = 4, min_share: float = 0.10) -> DataFrame:
    """Per call: reads, valid reads, and whether they are enough; the share is compared after rounding to two decimals."""
    out = reads.groupBy(*keys).agg(F.count("*").alias("n_reads"), F.count_if("valid").alias("n_valid"))
    return out.withColumn("passes", (F.col("n_valid") >= min_reads) & (hundredths(F.col("n_valid"), F.col("n_reads")) >= round(min_share * 100)))


def filter_calls(calls: DataFrame, judged: DataFrame, keys: list[str], code: str = "blat") -> DataFrame:
    """Sets the filter to the code for calls whose reads are not enough; calls without reads fail."""
    return calls.join(judged.select(*keys, "passes"), keys, "left").withColumn("filter", F.when(F.coalesce("passes", F.lit(False)), F.col("filter")).otherwise(F.array(F.lit(code)))).drop("passes")


def filter_modifications(calls: DataFrame, judged: DataFrame, keep_filters: bool = False, code: str = "blat") -> DataFrame:
    """Calls (chrom, pos, filter, mods) after each modification was judged on its own (chrom, pos, type, src, tgt, passes).

    If one passes, those that don't go and the call passes; else all stay, and the code replaces the filters (keep_filters: comes to
    them). A modification without a judgement fails.
    """
    mod = F.struct(F.col("type").alias("type"), F.col("src").alias("src"), F.col("tgt").alias("tgt"))
    good = judged.where("passes").groupBy("chrom", "pos").agg(F.collect_set(mod).alias("_good"))
    out = calls.join(good, ["chrom", "pos"], "left")
    some = F.size(F.coalesce("_good", F.array().cast(calls.schema["mods"].dataType))) > 0
    failed = F.array_sort(F.array_union(F.array_remove("filter", "PASS"), F.array(F.lit(code)))) if keep_filters else F.array(F.lit(code))
    return out.withColumns({"mods": F.when(some, F.filter("mods", lambda m: F.array_contains("_good", m))).otherwise(F.col("mods")), "filter": F.when(some, F.array(F.lit("PASS"))).otherwise(failed)}).drop("_good")


#: Which reads stand for a type of modification, in the order in which they are looked for.
READS_OF = {"GERM": ["dnaNormal"], "NOR_EDIT": ["rnaNormal"], "SOM": ["dnaTumor", "rnaTumor"], "TUM_EDIT": ["rnaTumor"]}


def filter_by_hits(
    calls: DataFrame, hits: DataFrame, realigned: list[str], form: str = "psl", min_reads: int = 4, min_share: float = 0.10, magnitude: int = 0, secondary: bool = False, keep_filters: bool = False, passing_only: bool = True
) -> DataFrame:
    """Calls (chrom, pos, filter, mods; optionally tx_names, tx_coords, mod_filters) judged by the hits of their realigned reads (``tables.read_hits``).

    ``realigned`` names the samples whose reads were realigned (dnaNormal, rnaNormal, dnaTumor, rnaTumor). Each type of modification has the hits of
    its sample at the call's place; a read is valid if its best usable hit is at the call, or at one of its transcript loci where it has any. Types with too few
    valid reads, and types without hits, fail; if another type passes their modifications go, else the call fails. passing_only: other calls are left out.
    """
    kinds = {t: next((s for s in samples if s in realigned), None) for t, samples in READS_OF.items()}
    sample = F.create_map(*[F.lit(x) for t, s in kinds.items() if s for x in (t, s)])
    asked = calls.where(F.array_contains("filter", "PASS")) if passing_only else calls
    own = F.array(F.struct(F.col("chrom").alias("n"), F.col("pos").cast("long").alias("c")))
    loci = own
    if "tx_names" in calls.columns:
        on_tx = F.zip_with("tx_names", "tx_coords", lambda n, c: F.struct(n.alias("n"), c.cast("long").alias("c")))
        loci = F.when(F.size("tx_names") > 0, on_tx).otherwise(own)
    types = F.explode(F.array_distinct(F.transform("mods", lambda m: m["type"])))
    each = asked.select("chrom", "pos", loci.alias("loci"), types.alias("type")).withColumn("sample", sample[F.col("type")])
    values = ["score"] if form == "psl" else ["evalue", "identity", "length", "read_length"]
    rows = hits.select("sample", "chrom", "pos", "read_name", "flag", "subject", "s_start", "s_end", *values)
    j = each.join(rows, ["sample", "chrom", "pos"])
    here = F.exists("loci", lambda x: overlaps_call(F.col("subject"), F.col("s_start"), F.col("s_end"), x["n"], x["c"]))
    keys = ["chrom", "pos", "type"]
    j = j.select(*keys, "read_name", here.alias("overlapping"), considered(F.col("flag"), ~F.col("sample").startswith("rna"), secondary).alias("usable"), *values)
    valid = valid_reads_psl(j, [*keys, "read_name"]) if form == "psl" else valid_reads_blast(j, [*keys, "read_name"], magnitude)
    judged = judge_calls(valid, keys, min_reads, min_share).select(*keys, "passes")
    mods = asked.select("chrom", "pos", F.inline("mods")).join(judged, keys, "left").withColumn("passes", F.coalesce("passes", F.lit(False)))
    out = filter_modifications(asked, mods, keep_filters)
    if "mod_filters" in calls.columns:
        out = out.withColumn("mod_filters", F.when(F.array_contains("filter", "PASS"), F.col("mod_filters")).otherwise(F.array_union("mod_filters", F.array(F.lit("blat")))))
    return out
