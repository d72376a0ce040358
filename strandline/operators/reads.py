"""Read-level evidence: reads over calls, overlapping mates, perfect reads, position and strand bias, support codes.

A read: sample, read_name, flag, chrom, start (0-based), mapq, cigar array<struct<op:int, len:int>>, mate_start, seq, qual.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.rounding import ratio2
from strandline.functions.strings import flag, reverse_complement
from strandline.operators.intervals import near_positions

#: SAM flag bits.
PAIRED, PROPER, UNMAPPED, MATE_MINUS, MINUS, SECONDARY, QC_FAIL, DUPLICATE = 0x1, 0x2, 0x4, 0x20, 0x10, 0x100, 0x200, 0x400
#: CIGAR operations that use the reference, and the read.
ON_REFERENCE, ON_READ = [0, 2, 3, 7, 8], [0, 1, 4, 7, 8]


def reference_span(cigar: Column) -> Column:
    return F.aggregate(cigar, F.lit(0), lambda acc, c: acc + F.when(c["op"].isin(ON_REFERENCE), c["len"]).otherwise(0))


def position_in_read(cigar: Column, offset: Column) -> Column:
    """(qpos, op, indel after it) of the base at an offset from the read's start on the reference: a walk along the CIGAR."""
    start = F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("op"), F.lit(0).alias("indel"))

    def step(acc, c):
        uses_r, uses_q = c["op"].isin(ON_REFERENCE), c["op"].isin(ON_READ)
        here = acc["op"].isNull() & uses_r & (offset < acc["r"] + c["len"])
        # the element after the one that ends with the base
        after = acc["op"].isNotNull() & (acc["indel"] == 0) & c["op"].isin(1, 2) & (acc["r"] == offset + 1)
        return F.struct(
            (acc["r"] + F.when(uses_r, c["len"]).otherwise(0)).alias("r"), (acc["q"] + F.when(uses_q, c["len"]).otherwise(0)).alias("q"),
            F.when(here & uses_q, acc["q"] + offset - acc["r"]).otherwise(acc["at"]).alias("at"), F.when(here, c["op"]).otherwise(acc["op"]).alias("op"),
            F.when(after, F.when(c["op"] == 1, c["len"]).otherwise(-c["len"])).otherwise(acc["indel"]).alias("indel"),
        )

    walk = F.aggregate(cigar, start, step, lambda acc: F.struct(acc["at"].alias("qpos"), acc["op"].alias("op"), acc["indel"].alias("indel")))
    # most reads are one stretch of bases: no walk for these
    one = F.get(cigar, 0)
    plain = (F.size(cigar) == 1) & one["op"].isin(0, 7, 8) & (offset >= 0) & (offset < one["len"])
    return F.when(plain, F.struct(offset.cast("int").alias("qpos"), one["op"].cast("int").alias("op"), F.lit(0).alias("indel"))).otherwise(walk)


def reads_at_calls(calls: DataFrame, reads: DataFrame, rna: bool = False) -> DataFrame:
    """Usable reads over each call with qpos, base and bq; deletions, skips, indels next to the base and flagged reads go."""
    spans = reads.withColumn("_end", F.col("start") + reference_span(F.col("cigar")))
    over = near_positions(calls, spans.withColumnRenamed("start", "read_start"), "read_start", "_end")
    over = over.withColumn("_at", position_in_read(F.col("cigar"), (F.col("pos") - 1 - F.col("read_start")).cast("int")))
    ok = ~flag(F.col("flag"), QC_FAIL) & ~flag(F.col("flag"), UNMAPPED) & ~flag(F.col("flag"), DUPLICATE) & (F.col("_at.op").isin(0, 7, 8)) & (F.col("_at.indel") == 0)
    if rna:
        ok = ok & ~flag(F.col("flag"), SECONDARY)
    out = over.where(ok).withColumn("qpos", F.col("_at.qpos"))
    return out.withColumns({"base": F.upper(F.substring("seq", F.col("qpos") + 1, F.lit(1))), "bq": F.ascii(F.substring("qual", F.col("qpos") + 1, F.lit(1))) - 33}).drop("_at", "_end")


def expand_loci(calls: DataFrame, names: str = "tx_names", coords: str = "tx_coords", strands: str = "tx_strands") -> DataFrame:
    """One row per transcript locus of a call, from three parallel lists."""
    z = F.explode_outer(F.arrays_zip(names, coords, strands))
    return calls.withColumn("_z", z).withColumns({"tx_name": F.col(f"_z.{names}"), "tx_coord": F.col(f"_z.{coords}"), "tx_strand": F.col(f"_z.{strands}")}).drop("_z")


def stranded_base(base: Column, minus: Column) -> Column:
    return F.when(minus, reverse_complement(base)).otherwise(base)


def resolve_mates(reads: DataFrame, keys: list[str], name: str = "read_name", min_bq: int = 10, order: list[str] | None = None) -> DataFrame:
    """One read of each pair of overlapping mates.

    overlapping (boolean) marks reads whose mate covers the same place. Reads that stand alone and non-overlapping ones stay. Overlapping reads of one name
    collapse to the one of highest bq (ties: ``order``, all columns by default) where their bases agree, or where the highest bq reaches
    min_bq and the next lower one does not; else all of them go.
    """
    group = Window.partitionBy(*keys, name, "overlapping")
    rank = [F.desc("bq"), *[F.col(c) for c in (order or sorted(c for c in reads.columns if c not in keys))]]
    # the order is that of the ranks: all windows read rows that are exchanged and sorted once
    w = Window.partitionBy(*keys, name).orderBy("overlapping", *rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = reads.withColumn("_n", F.count("*").over(w)).withColumn("_rank", F.row_number().over(group.orderBy(*rank)))
    r = r.withColumns({"_m": F.count("*").over(group), "_low": F.min("base").over(group), "_high": F.max("base").over(group), "_max": F.max("bq").over(group), "_next": F.max(F.when(F.col("_rank") > 1, F.col("bq"))).over(group)})
    alone = (F.col("_n") == 1) | ~F.col("overlapping") | (F.col("_m") == 1)
    agree = F.col("_low") == F.col("_high")
    clear = (F.col("_max") >= min_bq) & (F.col("_next") < min_bq)
    return r.where(alone | ((F.col("_rank") == 1) & (agree | clear))).drop("_n", "_m", "_low", "_high", "_max", "_rank", "_next")


def mate_overlaps(start: Column, qpos: Column, mate_start: Column, seq: Column) -> Column:
    return F.abs(start + qpos - mate_start) < F.length(seq)


def low_neighbours(qual: Column, qpos: Column, around: int = 5, least: int = 10) -> Column:
    """Some base within ``around`` places has a quality below ``least``."""
    low, high = F.greatest(qpos - around, F.lit(0)), F.least(qpos + around, F.length(qual) - 1)
    return F.exists(F.sequence(low, high), lambda k: F.ascii(F.substring(qual, k + 1, F.lit(1))) - 33 < least)


def mismatches(seq: Column, reference: Column, germline: Column, edit: Column) -> Column:
    """Bases of a read that differ from the reference, are no germline variant at their place (a map place -> bases) and no A>G edit where those are expected."""
    places = F.sequence(F.lit(0), F.length(seq) - 1)

    def mutated(k):
        b, r = F.upper(F.substring(seq, k + 1, F.lit(1))), F.upper(F.substring(reference, k + 1, F.lit(1)))
        known = F.coalesce(F.array_contains(germline[k], b), F.lit(False))
        return (b != r) & ~known & ~(edit & (r == "A") & (b == "G"))

    return F.size(F.filter(places, mutated))


def perfect_reason(dna: Column, flags: Column, cigar: Column, low_neighbour: Column, mutations: Column, max_mutations: int = 4, max_clip: float = 0.10, length: Column | None = None) -> Column:
    """Why a read is not perfect, the first reason; null for a perfect read."""
    clipped = F.aggregate(cigar, F.lit(0), lambda acc, c: acc + F.when(c["op"] == 4, c["len"]).otherwise(0))
    total = length if length is not None else F.aggregate(cigar, F.lit(0), lambda acc, c: acc + F.when(c["op"].isin(ON_READ), c["len"]).otherwise(0))
    has = lambda op: F.exists(cigar, lambda c: c["op"] == op)
    return (
        F.when(dna & ~flag(flags, PROPER), "improperpair").when(has(1), "insertion").when(has(2), "deletion").when(low_neighbour, "neighborbq").when(mutations >= max_mutations, "maxmuts").when(clipped >= max_clip * total, "maxsoftclip")
    )


def third(qpos: Column, length: Column) -> Column:
    share = qpos / length
    return F.when(share <= 0.33, "start").when(share <= 0.66, "middle").otherwise("end")


def support(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Per call: reads with the variant, perfect ones, their places and strands. Needs mutated, perfect, secondary, plus (booleans), place."""
    m, p = F.col("mutated"), F.col("mutated") & F.col("perfect")
    at = lambda c, x: F.count_if(c & (F.col("place") == x))
    return reads.groupBy(*keys).agg(
        F.count_if(m).alias("n_mut"), F.count_if(~m).alias("n_ref"), F.count_if(p).alias("n_perfect"), at(m, "start").alias("n_start"), at(m, "middle").alias("n_middle"), at(m, "end").alias("n_end"),
        at(p, "start").alias("p_start"), at(p, "end").alias("p_end"), F.count_if(p & F.col("plus")).alias("p_plus"), F.count_if(m & F.col("secondary")).alias("n_multi"),
    )


def support_codes(s: DataFrame, least: int = 4, max_multi: float = 0.90, max_strand: float = 0.90, max_place: float = 0.95, min_perfect: int = 4, min_share: float = 0.10) -> DataFrame:
    """Adds mmp (share of secondary reads, two decimals) and codes (sorted); a call without codes passes."""
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    mmp = F.coalesce(ratio2(F.col("n_multi"), F.col("n_mut")), F.lit(0.0))
    forward = share("p_plus", "n_perfect")
    all_reads = F.col("n_mut") + F.col("n_ref")
    tests = [
        ("mxmmp", (F.col("n_mut") >= least) & (mmp >= max_multi)),
        ("perfsbias", (F.col("n_perfect") >= least) & ((forward > max_strand) | (forward < 1 - max_strand))),
        ("pbias", (F.col("n_mut") >= least) & ((share("n_start", "n_mut") >= max_place) | (share("n_end", "n_mut") >= max_place))),
        ("perfpbias", (F.col("n_perfect") >= least) & ((share("p_start", "n_perfect") >= max_place) | (share("p_end", "n_perfect") >= max_place))),
        ("perfmnad", F.col("n_perfect") < min_perfect),
        ("perfmnaf", F.when(all_reads > 0, F.col("n_perfect") / all_reads < min_share).otherwise(True)),
    ]
    return s.withColumns({"mmp": mmp, "codes": F.array_sort(F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in tests])))})


def germline_places(reads: DataFrame, calls: DataFrame, keys: list[str]) -> DataFrame:
    """Reads (by keys, with chrom, start, seq) with ``germline``: a map from a place in the read to the germline bases called there (calls: chrom, pos, base)."""
    spans = reads.select(*keys, "chrom", F.col("start").alias("read_start"), (F.col("start") + F.length("seq")).alias("_end"))
    at = near_positions(calls.select("chrom", "pos", "base"), spans, "read_start", "_end").select(*keys, (F.col("pos") - 1 - F.col("read_start")).cast("int").alias("k"), "base")
    maps = at.groupBy(*keys, "k").agg(F.array_sort(F.collect_set("base")).alias("bases")).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("k", "bases"))).alias("germline"))
    return reads.join(maps, keys, "left").withColumn("germline", F.coalesce("germline", F.expr("map_from_arrays(cast(array() AS array<int>), cast(array() AS array<array<string>>))")))


def filter_by_read_support(calls: DataFrame, reads: DataFrame, dna: bool = True, min_bq: int = 10, **limits) -> DataFrame:
    """Calls (chrom, pos, alt, filter) judged by the reads over them: adds mmp, n_mut, n_ref, n_perfect, and the codes to the filter.

    Reads over a call lose flagged ones, collapse overlapping mates, count as perfect or not, and are summed by place and strand. A read
    may carry ``mutations``, its number of unexplained mismatches (0 where the column is missing). Calls without reads
    have no perfect ones.
    """
    rows = reads if "mutations" in reads.columns else reads.withColumn("mutations", F.lit(0))
    over = reads_at_calls(calls.select("chrom", "pos", "alt"), rows, rna=not dna).where(F.col("bq") >= min_bq)
    over = over.withColumn("overlapping", mate_overlaps(F.col("read_start"), F.col("qpos"), F.col("mate_start"), F.col("seq")))
    kept = resolve_mates(over, ["chrom", "pos"], min_bq=min_bq, order=["base", "qpos", "flag", "mapq", "read_start", "mutations", "qual", "cigar"])
    reason = perfect_reason(F.lit(dna), F.col("flag"), F.col("cigar"), low_neighbours(F.col("qual"), F.col("qpos")), F.col("mutations"))
    facts = kept.withColumns({
        "mutated": F.col("base") == F.col("alt"), "perfect": reason.isNull(), "secondary": flag(F.col("flag"), SECONDARY), "plus": ~flag(F.col("flag"), MINUS), "place": third(F.col("qpos"), F.length("seq")),
    })
    judged = support_codes(support(facts, ["chrom", "pos"]), **limits).select("chrom", "pos", "mmp", "n_mut", "n_ref", "n_perfect", "codes")
    out = calls.join(judged, ["chrom", "pos"], "left")
    codes = F.coalesce("codes", F.array(F.lit("perfmnad"), F.lit("perfmnaf")))
    return out.withColumn("filter", F.when(F.size(codes) > 0, F.array_sort(F.array_union(F.array_remove("filter", "PASS"), codes))).otherwise(F.col("filter"))).drop("codes")


def neighbour_bases(reference: DataFrame) -> DataFrame:
    """Previous and next base of each position of a reference table (chrom, pos, base)."""
    prev = reference.select("chrom", (F.col("pos") + 1).alias("pos"), F.col("base").alias("pn"))
    nxt = reference.select("chrom", (F.col("pos") - 1).alias("pos"), F.col("base").alias("nn"))
    return reference.join(prev, ["chrom", "pos"], "left").join(nxt, ["chrom", "pos"], "left")


def query_sequences(reads: DataFrame, prefix: str) -> DataFrame:
    """FASTA lines of reads over calls: a header that names call, read, base, qualities, flag and length, then the sequence."""
    name = F.regexp_replace("read_name", "_", "")
    head = F.concat(F.lit("> "), F.concat_ws("_", F.lit(prefix), "chrom", F.col("pos").cast("string"), name, "base", F.col("bq").cast("string"), F.col("mapq").cast("string"), F.col("flag").cast("string"), F.length("seq").cast("string")))
    return reads.select(F.concat_ws("\n", head, "seq").alias("value"))
