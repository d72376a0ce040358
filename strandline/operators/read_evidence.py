"""Calls judged by the reads over them: mismatches against a packed reference, germline places, transcript loci, both origins.

Each modification of a call becomes a lane, a lane has one locus on the genome or several on transcripts of either strand, and reads at all loci of a lane are
folded into one verdict. A read's mismatches depend only on its alignment, so they are found once for each distinct alignment, with one
join by reference chunk, and lookups of known variants are a join of the few mismatched places.

Calls: chrom, pos, ref, alleles, filter, origin (arrays), mods (array of type, src, tgt), ss; optionally tx_names, tx_coords, tx_strands (arrays).
Reads: sample, chrom, start (0-based), read_name, flag, mapq, cigar (array of op, len), mate_start, seq, qual.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.rounding import hundredths
from strandline.functions.strings import flag, reverse_complement
from strandline.operators.calling import computed
from strandline.operators.intervals import near_positions
from strandline.operators.reads import DUPLICATE, MINUS, ON_READ, ON_REFERENCE, PROPER, QC_FAIL, SECONDARY, UNMAPPED, low_neighbours, mate_overlaps, position_in_read, reference_span, resolve_mates, stranded_base, third
from strandline.sources.reference import stretches

#: CIGAR operations whose bases are compared with the reference.
COMPARED = [0, 8]
LANE = ["call_chrom", "call_pos", "lane", "mod"]
ALIGNMENT = ["chrom", "start", "cigar", "seq"]


@dataclass(frozen=True)
class ReadLimits:
    """Limits of reads and of their shares (compared after rounding to two decimals), which calls are judged, and how deep places are dealt."""

    min_base_qual: int = 10
    min_map_qual: int = 10
    neighbours: int = 5
    min_neighbour_qual: int = 10
    max_mutations: int = 4
    max_clip: float = 0.10
    include_secondary: bool = False
    min_perfect: int = 4
    min_perfect_share: float = 0.10
    max_strand: float = 0.90
    min_strand_depth: int = 4
    max_place: float = 0.95
    min_place_depth: int = 4
    max_multi: float = 0.90
    min_multi_depth: int = 4
    passing_only: bool = True
    #: Reads of one bin beyond which it is dealt in parts; None: adaptive execution alone splits deep places.
    deep: int | None = None


def germline_bases(calls: DataFrame) -> DataFrame:
    """(chrom, pos, base) of passing germline and LOH calls, at their place and at their transcript loci."""
    known = calls.where(F.array_contains("filter", "PASS") & F.col("ss").isin(1, 3))
    places = F.array(F.struct(F.col("chrom").alias("chrom"), F.col("pos").cast("long").alias("pos")))
    if "tx_names" in calls.columns:
        tx = F.zip_with("tx_names", "tx_coords", lambda n, c: F.struct(n.alias("chrom"), c.cast("long").alias("pos")))
        places = F.concat(places, F.coalesce(tx, F.array().cast("array<struct<chrom:string,pos:bigint>>")))
    return known.select(F.explode(places).alias("p"), F.transform("mods", lambda m: m["tgt"]).alias("b")).select("p.chrom", "p.pos", F.explode("b").alias("base")).distinct()


def lanes(calls: DataFrame) -> DataFrame:
    """One row for each locus of each modification to judge: LANE, sample, dna, src, tgt, edit, chrom, pos, strand.

    A DNA call is judged by its first modification on the genome, an RNA call by all of them, on the transcripts where the call has any.
    Somatic calls look at the tumor's reads of their origin, edits at the RNA that they were found in.
    """
    mods = F.posexplode(F.when(F.col("lane") == "DNA", F.slice("mods", 1, 1)).otherwise(F.col("mods"))).alias("mod", "m")
    tx = [c for c in ("tx_names", "tx_coords", "tx_strands") if c in calls.columns]
    lane = calls.where(F.col("ss").isin(2, 4)).select("chrom", "pos", "mods", "ss", *tx, F.explode(F.array_intersect("origin", F.array(F.lit("DNA"), F.lit("RNA")))).alias("lane"))
    one = lane.select("chrom", "pos", "ss", *tx, "lane", mods)
    kind = F.col("m.type")
    sample = F.when(F.col("ss") == 2, F.concat("lane", F.lit("_TUMOR"))).when(kind == "NOR_EDIT", F.lit("RNA_NORMAL")).when(kind == "TUM_EDIT", F.lit("RNA_TUMOR"))
    own = F.array(F.struct(F.col("chrom").alias("n"), F.col("pos").cast("long").alias("c"), F.lit(None).cast("string").alias("s")))
    loci = own
    if len(tx) == 3:
        on_tx = F.transform(F.arrays_zip(*[F.col(c).alias(a) for c, a in zip(tx, "ncs", strict=True)]), lambda z: F.struct(z["n"].alias("n"), z["c"].cast("long").alias("c"), z["s"].alias("s")))
        loci = F.when((F.col("lane") == "RNA") & (F.size(F.coalesce(on_tx, F.array().cast("array<struct<n:string,c:bigint,s:string>>"))) > 0), on_tx).otherwise(own)
    out = one.select(F.col("chrom").alias("call_chrom"), F.col("pos").alias("call_pos"), "lane", "mod", sample.alias("sample"), F.col("m.src").alias("src"), F.col("m.tgt").alias("tgt"), (F.col("ss") == 4).alias("edit"), F.posexplode(loci).alias("locus", "l"))
    return out.select(*LANE, "sample", (F.col("lane") == "DNA").alias("dna"), "src", "tgt", "edit", "locus", F.col("l.n").alias("chrom"), F.col("l.c").alias("pos"), F.coalesce("l.s", F.lit("+")).alias("strand"))


def reads_over(loci: DataFrame, reads: DataFrame, p: ReadLimits) -> DataFrame:
    """Usable reads of each locus's sample with a base of the lane's alleles: base as read, own (on the genome's strand), bq, qpos."""
    spans = reads.select(F.col("sample").alias("_sample"), "chrom", "start", (F.col("start") + reference_span(F.col("cigar"))).alias("_end"), "read_name", "flag", "mapq", "cigar", "mate_start", "seq", "qual").where("_end > start")
    bad = flag(F.col("flag"), QC_FAIL) | flag(F.col("flag"), UNMAPPED) | flag(F.col("flag"), DUPLICATE)
    over = near_positions(loci, spans.where(~bad), "start", "_end", deep=p.deep).where(F.col("sample") == F.col("_sample"))
    if not p.include_secondary:
        over = over.where(F.col("dna") | ~flag(F.col("flag"), SECONDARY))
    # as a generator's output: the walk and the filters above it are not evaluated again for each column that reads them
    over = computed(over, {"_at": position_in_read(F.col("cigar"), (F.col("pos") - 1 - F.col("start")).cast("int"))}).where(F.col("_at.op").isin(0, 7, 8) & (F.col("_at.indel") == 0))
    qpos = F.col("_at.qpos")
    base = F.upper(F.substring("seq", qpos + 1, F.lit(1)))
    over = computed(over, {"qpos": qpos, "base": base, "bq": F.ascii(F.substring("qual", qpos + 1, F.lit(1))) - 33, "own": stranded_base(base, F.col("strand") == "-")})
    return over.where(F.col("own").isin(F.col("src"), F.col("tgt"))).drop("_at", "_end", "_sample")


def segments(cigar: Column, start: Column) -> Column:
    """Compared stretches of an alignment: q (place in the read), r (on the reference), n."""
    entry = "struct<q:int,r:bigint,n:int>"
    begin = F.struct(F.lit(0).alias("q"), start.cast("long").alias("r"), F.array().cast(f"array<{entry}>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        part = F.array(F.struct(acc["q"].alias("q"), acc["r"].alias("r"), c["len"].cast("int").alias("n")))
        on = lambda ops: F.when(c["op"].isin(ops), c["len"]).otherwise(0).cast("int")
        return F.struct((acc["q"] + on(ON_READ)).alias("q"), (acc["r"] + on(ON_REFERENCE)).alias("r"), F.when(c["op"].isin(COMPARED), F.concat(acc["out"], part)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(cigar, begin, step, lambda acc: acc["out"])


def mismatches(alignments: DataFrame, reference: DataFrame, germline: DataFrame | None) -> DataFrame:
    """(key, strand, mism): of each distinct alignment (key, strand, chrom, start, cigar, seq) the places r, reference bases and read bases that differ and are no known variant there.

    On the minus strand of a transcript the read's complement is held against the known variants. Alignments without such places have no row.
    """
    s = alignments.withColumn("s", F.explode(segments(F.col("cigar"), F.col("start")))).select("key", "strand", "chrom", F.col("s.q").alias("q"), F.col("s.r").alias("r"), F.col("s.n").alias("n"), F.upper(F.substring("seq", F.col("s.q") + 1, F.col("s.n"))).alias("bases"))
    keys = ["key", "strand", "chrom", "q", "r", "n", "bases"]
    both = stretches(s, reference, "chrom", "r", "n", keys).where(F.col("ref") != F.col("bases"))
    places = F.arrays_zip(F.split("bases", "").alias("b"), F.split("ref", "").alias("r"))
    apart = both.select("key", "strand", "chrom", F.col("r").alias("begin"), F.posexplode(places).alias("k", "z")).where((F.col("z.b") != F.col("z.r")) & (F.col("z.b") != ""))
    apart = apart.select("key", "strand", "chrom", (F.col("begin") + F.col("k")).alias("r"), F.col("z.r").alias("ref"), F.col("z.b").alias("base"))
    if germline is not None:
        own = F.when(F.col("strand") == "-", reverse_complement(F.col("base"))).otherwise(F.col("base"))
        known = germline.select(F.col("chrom").alias("_c"), (F.col("pos") - 1).alias("_r"), F.col("base").alias("_b"))
        apart = apart.join(known, (F.col("chrom") == F.col("_c")) & (F.col("r") == F.col("_r")) & (own == F.col("_b")), "left_anti")
    return apart.groupBy("key", "strand").agg(F.collect_list(F.struct("r", "ref", "base")).alias("mism"))


def imperfect(p: ReadLimits) -> Column:
    """Why a read is not perfect, the first reason along its CIGAR; null for a perfect one. Needs dna, flag, cigar, start, seq, qual, qpos, edit, mism."""
    cigar, length = F.col("cigar"), F.length("seq")
    has = lambda op: F.exists(cigar, lambda c: c["op"] == op)
    counted = F.filter("mism", lambda m: ~(F.col("edit") & (m["ref"] == "A") & (m["base"] == "G")))
    begin = F.struct(F.col("start").cast("long").alias("r"), F.lit(0).alias("muts"), F.lit(0).alias("clip"), F.lit(None).cast("string").alias("why"), counted.alias("m"))

    def step(acc: Column, c: Column) -> Column:
        end = acc["r"] + F.when(c["op"].isin(ON_REFERENCE), c["len"]).otherwise(0)
        muts = acc["muts"] + F.when(c["op"].isin(COMPARED), F.size(F.filter(acc["m"], lambda m: (m["r"] >= acc["r"]) & (m["r"] < end)))).otherwise(0)
        clip = acc["clip"] + F.when(c["op"] == 4, c["len"]).otherwise(0).cast("int")
        why = F.when(muts >= p.max_mutations, F.lit("maxmuts")).when((length > 0) & (hundredths(clip, length) >= round(p.max_clip * 100)), F.lit("maxsoftclip"))
        return F.struct(end.alias("r"), muts.alias("muts"), clip.alias("clip"), F.coalesce(acc["why"], why).alias("why"), acc["m"].alias("m"))

    walk = F.aggregate(cigar, begin, step, lambda acc: acc["why"])
    low = low_neighbours(F.col("qual"), F.col("qpos"), p.neighbours, p.min_neighbour_qual)
    return F.when(F.col("dna") & ~flag(F.col("flag"), PROPER), "improperpair").when(has(1), "insertion").when(has(2), "deletion").when(low, "neighborbq").otherwise(walk)


REASONS = ["improperpair", "insertion", "deletion", "neighborbq", "maxmuts", "maxsoftclip"]


def sums(facts: DataFrame) -> DataFrame:
    """Per lane: reads of the target and of the source, good and perfect ones by place and strand, secondary ones by base, and imperfect ones by reason."""
    m, good = F.col("mutated"), F.col("mutated") & F.col("good")
    p, second = good & F.col("why").isNull(), flag(F.col("flag"), SECONDARY)
    n = lambda c, name: F.count_if(c).alias(name)
    at = lambda c, place: c & (F.col("place") == place)
    return facts.groupBy(*LANE).agg(
        n(m, "n_mut"), n(~m, "n_ref"), n(good, "n_good"), n(m & ~F.col("good"), "n_low"), n(m & second, "n_mut2"), n(~m & second, "n_ref2"), n(p, "n_perfect"), n(p & ~flag(F.col("flag"), MINUS), "p_plus"),
        n(at(good, "start"), "n_start"), n(at(good, "end"), "n_end"), n(at(p, "start"), "p_start"), n(at(p, "end"), "p_end"), *[n(good & (F.col("why") == w), f"n_{w}") for w in REASONS],
    )


def codes(p: ReadLimits) -> Column:
    """Codes of a lane's sums, sorted; none for a lane that passes."""
    share = lambda a, b: F.coalesce(hundredths(F.col(a), F.col(b)), F.lit(0))
    h = lambda x: round(x * 100)
    least = lambda c, n: (F.col(c) > 0) & (F.col(c) >= n)
    place = lambda a, b, n: least(n, p.min_place_depth) & ((share(a, n) >= h(p.max_place)) | (share(b, n) >= h(p.max_place)))
    every = F.col("n_mut") + F.col("n_ref")
    tests = [
        ("mxmmp", least("n_mut", p.min_multi_depth) & (share("n_mut2", "n_mut") >= h(p.max_multi))),
        ("pbias", place("n_start", "n_end", "n_good")), ("perfpbias", place("p_start", "p_end", "n_perfect")),
        ("perfsbias", least("n_perfect", p.min_strand_depth) & ((share("p_plus", "n_perfect") > h(p.max_strand)) | (share("p_plus", "n_perfect") < 100 - h(p.max_strand)))),
        ("perfmnad", F.col("n_perfect") < p.min_perfect),
        ("perfmnaf", (every > 0) & (F.coalesce(hundredths(F.col("n_perfect"), every), F.lit(0)) < h(p.min_perfect_share))),
    ]
    return F.array_sort(F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in tests])))


def lane_evidence(calls: DataFrame, reads: DataFrame, reference: DataFrame, germline: DataFrame | None = None, p: ReadLimits = ReadLimits()) -> DataFrame:
    """One row for each lane: its sample, sums, multi-mapped shares of source and target (hundredths) and codes. Lanes without reads have sums of 0."""
    loci = lanes(calls)
    # said here, as the join of the sums below would say it for one of the two uses of ``kept`` only: they'd differ, and reads would meet calls twice
    placed = loci.where(" AND ".join(f"{c} IS NOT NULL" for c in LANE))
    over = reads_over(placed, reads, p).withColumn("overlapping", mate_overlaps(F.col("start"), F.col("qpos"), F.col("mate_start"), F.col("seq")))
    order = ["base", "qpos", "flag", "mapq", "locus", "start", "qual", "cigar", "seq"]
    kept = resolve_mates(over, LANE, min_bq=p.min_base_qual, order=order)
    # only reads of the target are looked at base by base
    kept = kept.withColumns({"mutated": F.col("own") == F.col("tgt"), "good": (F.col("mapq") >= p.min_map_qual) & (F.col("bq") >= p.min_base_qual)})
    # the key holds all that later steps read of a row, so both uses of ``kept`` read the same columns and Spark makes its exchange once
    text = F.concat_ws("|", F.col("dna").cast("string"), F.col("edit").cast("string"), F.col("chrom"), F.col("start").cast("string"), F.array_join(F.transform("cigar", lambda c: F.concat_ws(",", c["op"].cast("string"), c["len"].cast("string"))), ";"), F.col("seq"))
    keyed = kept.withColumn("key", F.when(F.col("mutated") & F.col("good"), F.sha2(text, 256)))
    found = mismatches(keyed.where("key IS NOT NULL").select("key", "strand", *ALIGNMENT).distinct(), reference, germline)
    facts = keyed.join(found, ["key", "strand"], "left").withColumn("mism", F.coalesce("mism", F.array().cast("array<struct<r:bigint,ref:string,base:string>>")))
    facts = computed(facts, {"why": F.when(F.col("mutated") & F.col("good"), imperfect(p)), "place": third(F.col("qpos"), F.length("seq"))})
    each = sums(facts)
    zero = [c for c in each.columns if c not in LANE]
    all_ = loci.select(*LANE, "sample", "src", "tgt", "dna").distinct().join(each, LANE, "left").na.fill(0, zero)
    share = lambda a, b: F.coalesce(hundredths(F.col(a), F.col(b)), F.lit(0))
    return all_.withColumns({"ref_multi": share("n_ref2", "n_ref"), "mut_multi": share("n_mut2", "n_mut"), "codes": codes(p)})


def filter_by_reads(calls: DataFrame, reads: DataFrame, reference: DataFrame, germline: DataFrame | None = None, p: ReadLimits = ReadLimits()) -> DataFrame:
    """``calls`` with the filter judged by their reads, ``mmp`` (sample -> share of secondary reads of each allele) and pn, nn (the reference bases around the place).

    Somatic calls and edits are judged, by default only passing ones. A call passes if its DNA lane has no code, or else one of its RNA lanes; if none
    passes, the lanes' codes replace a PASS, or come to the codes that the call had. RNA lanes count only where the DNA lane has failed. Of several modifications
    of one sample the last one gives mmp, pn and nn. ``germline`` is None: it comes from the calls themselves. A call stands once for each (chrom, pos).
    """
    known = germline_bases(calls) if germline is None else germline
    judged = calls.where(F.col("ss").isin(2, 4) & (F.array_contains("filter", "PASS") if p.passing_only else F.lit(True)))
    tx = [c for c in ("tx_names", "tx_coords", "tx_strands") if c in calls.columns]
    each = lane_evidence(judged.select("chrom", "pos", "filter", "origin", "mods", "ss", *tx), reads, reference, known, p)
    row = F.struct("dna", "mod", "sample", "src", "tgt", "ref_multi", "mut_multi", "codes")
    by_call = each.groupBy(F.col("call_chrom").alias("chrom"), F.col("call_pos").alias("pos")).agg(F.array_sort(F.collect_list(row)).alias("_l"))
    ok = lambda x: F.size(x["codes"]) == 0
    dna_ok = F.exists("_l", lambda x: x["dna"] & ok(x))
    by_call = by_call.withColumn("_l", F.filter("_l", lambda x: x["dna"] | ~dna_ok))
    out = calls.join(by_call, ["chrom", "pos"], "left")
    found = F.array_sort(F.array_distinct(F.flatten(F.transform("_l", lambda x: x["codes"]))))
    failed = F.when(F.array_contains("filter", "PASS"), found).otherwise(F.array_sort(F.array_union("filter", found)))
    # the last lane of a sample
    samples = F.array_distinct(F.transform("_l", lambda x: x["sample"]))
    last = lambda s: F.element_at(F.filter("_l", lambda x: x["sample"] == s), -1)
    per_allele = lambda x: F.transform("alleles", lambda a: F.when(a == x["src"], x["ref_multi"]).when(a == x["tgt"], x["mut_multi"]).otherwise(0) / 100.0)
    mmp = F.map_from_entries(F.transform(F.filter(samples, lambda s: s.isNotNull()), lambda s: F.struct(s, per_allele(last(s)))))
    out = out.withColumns({"filter": F.when(F.col("_l").isNull(), F.col("filter")).when(F.exists("_l", ok), F.array(F.lit("PASS"))).otherwise(failed), "mmp": mmp, "_rna": F.exists("_l", lambda x: ~x["dna"])})
    return around(out, reference, tx).drop("_l", "_rna")


def around(calls: DataFrame, reference: DataFrame, tx: list[str]) -> DataFrame:
    """Adds pn and nn, the reference bases before and after the place that was judged last: the first transcript locus of an RNA lane, else the call's own."""
    chrom, pos = F.col("chrom"), F.col("pos").cast("long")
    if len(tx) == 3:
        on_tx = F.coalesce(F.col("_rna") & (F.size("tx_names") > 0), F.lit(False))
        chrom, pos = F.when(on_tx, F.get("tx_names", 0)).otherwise(chrom), F.when(on_tx, F.get("tx_coords", 0).cast("long")).otherwise(pos)
    asked = calls.where("_l IS NOT NULL").select("chrom", "pos", chrom.alias("_at"), (pos - 2).alias("_from"), F.lit(3).alias("_three"))
    bases = stretches(asked, reference, "_at", "_from", "_three", ["chrom", "pos"])
    return calls.join(bases.select("chrom", "pos", F.substring("ref", 1, 1).alias("pn"), F.substring("ref", 3, 1).alias("nn")), ["chrom", "pos"], "left")
