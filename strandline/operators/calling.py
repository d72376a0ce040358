"""Variant calling from read observations (chrom, pos, ref, sample, base, bq, mq, plus)."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.rounding import hundredths_text, let, mean, ratio2
from strandline.operators.intervals import overlaps

#: The order in which alleles of one sample are visited, and samples.
BASES = ["A", "C", "T", "G"]
SAMPLES = ["DNA_NORMAL", "RNA_NORMAL", "DNA_TUMOR", "RNA_TUMOR"]
SHORT = {"DNA_NORMAL": "dn", "RNA_NORMAL": "rn", "DNA_TUMOR": "dt", "RNA_TUMOR": "rt"}
EDGES = ["ins", "del", "start", "stop"]
NO_MODS = "cast(array() AS array<struct<type:string,src:string,tgt:string>>)"
SS_CODES = {"GERM": 1, "SOM": 2, "NOR_EDIT": 4, "TUM_EDIT": 4}


@dataclass(frozen=True)
class CallParams:
    """Minimums per sample; supplied: the samples whose files were given, which decides the type of a call."""

    min_bq: int = 10
    min_mq: int = 10
    min_total: dict = field(default_factory=lambda: dict.fromkeys(SAMPLES, 4))
    min_alt: dict = field(default_factory=lambda: dict.fromkeys(SAMPLES, 2))
    supplied: tuple = tuple(SAMPLES)


def passing(p: CallParams = CallParams()) -> Column:
    return (F.col("bq") >= p.min_bq) & (F.col("mq") >= p.min_mq)


def region(obs: DataFrame, chrom: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    tests = [F.col("chrom") == chrom if chrom else None, F.col("pos") >= start if start is not None else None, F.col("pos") <= stop if stop is not None else None]
    return reduce(lambda df, t: df.where(t) if t is not None else df, tests, obs)


def batch_ranges(extents: DataFrame, size: int = 250_000_000) -> DataFrame:
    """Ranges of at most ``size`` positions over the extent of each chromosome (chrom, start, stop; stop is part of it)."""
    first = F.explode(F.expr(f"sequence(cast(start AS bigint), cast(stop AS bigint), {size}L)"))
    return extents.where("start <= stop").select("chrom", "stop", first.alias("start")).select("chrom", "start", F.least(F.col("start") + size - 1, F.col("stop").cast("long")).alias("stop"))


def at_coordinates(obs: DataFrame, coordinates: DataFrame, prune: bool = True) -> DataFrame:
    """Observations inside the listed (chrom, start, stop) ranges, by a join on bins; first by each chromosome's whole range, if asked."""
    if prune:
        whole = coordinates.groupBy("chrom").agg(F.min("start").alias("_low"), F.max("stop").alias("_high"))
        obs = obs.join(whole, "chrom").where(F.col("pos").between(F.col("_low"), F.col("_high"))).drop("_low", "_high")
    spans = coordinates.select("chrom", (F.col("start") - 1).alias("start"), F.col("stop").alias("end"))
    places = overlaps(obs.select("chrom", "pos").distinct(), spans).select("chrom", "pos").distinct()
    return obs.join(places, ["chrom", "pos"], "left_semi")


def consistent_reference(obs: DataFrame) -> DataFrame:
    """Positions whose observations agree on a reference base other than N."""
    return reference_codes(obs).where(F.size("ref_codes") == 0).drop("ref_codes")


def reference_codes(obs: DataFrame) -> DataFrame:
    """Adds ref_codes: noref where a position's observations have an N reference, diffref where they don't agree on one."""
    place = Window.partitionBy("chrom", "pos")
    codes = F.array(F.when(F.max(F.contains("ref", F.lit("N"))).over(place), "noref"), F.when(F.min("ref").over(place) != F.max("ref").over(place), "diffref"))
    return obs.withColumn("ref_codes", F.array_compact(codes))


def emitted(found: DataFrame, codes: DataFrame, output_all: bool = False) -> DataFrame:
    """Calls with a position's reference codes (chrom, pos, ref_codes) in front of their filter; without output_all only those that pass.

    PASS goes when a code comes; positions with no code and no other filter pass.
    """
    out = found.join(codes.select("chrom", "pos", "ref_codes").dropDuplicates(["chrom", "pos"]), ["chrom", "pos"], "left")
    every = F.concat(F.coalesce("ref_codes", F.array().cast("array<string>")), F.array_remove("filter", "PASS"))
    out = out.withColumn("filter", F.when(F.size(every) > 0, every).otherwise(F.array(F.lit("PASS")))).drop("ref_codes")
    return out if output_all else out.where(F.array_contains("filter", "PASS"))


def allele_stats(obs: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """Per position, sample and base: count, quality sums, best mapping quality and plus strands of passing reads; reads of mapping quality 0 count before the filter."""
    ok = passing(p)
    return obs.groupBy("chrom", "pos", "ref", "sample", "base").agg(
        F.count_if(ok).alias("ad"),
        F.sum(F.when(ok, F.col("bq")).otherwise(0)).alias("sum_bq"),
        F.sum(F.when(ok, F.col("mq")).otherwise(0)).alias("sum_mq"),
        F.count_if(ok & F.col("plus")).alias("plus"),
        F.max(F.when(ok, F.col("mq")).otherwise(0)).cast("long").alias("max_mq"),
        F.count_if(F.col("mq") == 0).alias("mq0"),
    )


def count_column(sample: str, base: str) -> str:
    return f"{SHORT[sample]}_{base}"


def merged_counts(obs: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """One row per position with the passing count of each base in each sample: the outer merge of the samples, in one shuffle."""
    ok = passing(p)
    return obs.groupBy("chrom", "pos", "ref").agg(*[F.count_if(ok & (F.col("sample") == s) & (F.col("base") == b)).alias(count_column(s, b)) for s in SAMPLES for b in BASES])


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that filters and projections above read: as a generator's output, large expressions aren't repeated for each use."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def find_variants(sites: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """Adds alts (array), mods (array of type, src, tgt), ss, somatic, below_total, below_alt, filter.

    Samples are visited in order; each compares its bases with what its parents have shown: the bases of all earlier samples
    and, once one has reads, the reference. That is a function of the counts, so each visit is a column expression of its own.
    """
    # one SQL text for each column: a tree of this size takes seconds to build node by node
    earlier: list[str] = []
    alts: list[str] = []
    #: For each sample its type, the bases that are called and the bases that they can come from.
    seen: list[tuple[str, str, str]] = []
    below_total, below_alt = [], []
    for s in SAMPLES:
        n = {b: count_column(s, b) for b in BASES}
        total = "(" + " + ".join(n.values()) + ")"
        shown = " + ".join(count_column(e, b) for e in earlier for b in BASES) or "0"
        if s == "DNA_TUMOR":
            pm, prev = p.min_alt["DNA_NORMAL"], {b: count_column("DNA_NORMAL", b) for b in BASES}
            kind = "SOM" if "DNA_NORMAL" in p.supplied else "DNA_TUM_VAR"
        elif s == "RNA_TUMOR":
            source = "DNA_TUMOR" if "DNA_TUMOR" in p.supplied else "RNA_NORMAL"
            pm, prev = p.min_alt["DNA_TUMOR"], {b: count_column(source, b) for b in BASES}
            kind = "TUM_EDIT" if {"DNA_NORMAL", "DNA_TUMOR"} & set(p.supplied) else "RNA_TUM_VAR"
        else:
            pm = p.min_alt["DNA_NORMAL"]
            prev = dict.fromkeys(BASES, str(pm))
            kind = "GERM" if s == "DNA_NORMAL" else "NOR_EDIT" if "DNA_NORMAL" in p.supplied else "RNA_NOR_VAR"
        prev = {b: f"(CASE WHEN {shown} = 0 OR ref = '{b}' THEN {pm} ELSE {prev[b]} END)" for b in BASES}
        inside = {b: "(" + (" + ".join(count_column(e, b) for e in earlier) or "0") + f" > 0 OR ref = '{b}')" for b in BASES}
        earlier.append(s)
        targets = []
        for b in BASES:
            alts.append(f"CASE WHEN {n[b]} > 0 AND NOT {inside[b]} THEN '{b}' END")
            differs = f"({n[b]} > 0 AND (NOT {inside[b]} OR {prev[b]} < {pm}))"
            enough = f"{total} >= {p.min_total[s]}"
            below_total.append(f"({differs} AND NOT {enough})")
            below_alt.append(f"({differs} AND {enough} AND {n[b]} < {p.min_alt[s]})")
            called = f"{differs} AND {enough} AND {n[b]} >= {p.min_alt[s]}"
            targets.append(f"CASE WHEN {called} THEN '{b}' END")
        sources = [f"CASE WHEN {inside[d]} AND {prev[d]} >= {pm} THEN '{d}' END" for d in BASES]
        seen.append((kind, f"array_compact(array({', '.join(targets)}))", f"array_compact(array({', '.join(sources)}))"))
    texts = {"alts": f"array_distinct(array_compact(array({', '.join(alts)})))", "below_total": " OR ".join(below_total), "below_alt": " OR ".join(below_alt)}
    out = computed(sites, {k: F.expr(v) for k, v in (texts | {f"_to{i}": to for i, (_, to, _) in enumerate(seen)}).items()})
    # sources are looked at only where a base is called
    each = ", ".join(f"if(size(_to{i}) = 0, {NO_MODS}, flatten(transform(_to{i}, b -> transform(array_remove({sources}, b), d -> named_struct('type', '{kind}', 'src', d, 'tgt', b)))))" for i, (kind, _, sources) in enumerate(seen))
    out = computed(out, {"mods": F.expr(f"concat({each})")}).drop(*[f"_to{i}" for i in range(len(seen))])
    first = F.get(F.col("mods"), 0)["type"]
    ss = reduce(lambda c, x: c.when(first == x[0], x[1]), list(SS_CODES.items())[1:], F.when(first == "GERM", 1))
    codes = F.array_compact(F.array(F.when(F.col("below_total"), F.lit("mbt")), F.when(F.col("below_alt"), F.lit("mba"))))
    return out.withColumns({
        "ss": F.when(first.isNotNull(), ss.otherwise(5)).cast("int"),
        "somatic": F.exists("mods", lambda m: m["type"] == "SOM"),
        "filter": F.when(F.size("mods") > 0, F.array(F.lit("PASS"))).otherwise(codes),
    })


def calls(obs: DataFrame, p: CallParams = CallParams(), output_all: bool = False) -> DataFrame:
    """Called positions; with output_all every position with passing reads."""
    found = find_variants(merged_counts(obs, p), p)
    depth = sum(F.col(count_column(s, b)) for s in SAMPLES for b in BASES)
    return found.where(depth > 0) if output_all else found.where(F.size("mods") > 0)


def modifications(called: DataFrame) -> DataFrame:
    """One row for each modification of each call."""
    return called.select("*", F.posexplode("mods").alias("mod_at", "mod")).select("*", "mod.*").drop("mod", "mods")


def site_summary(stats: DataFrame) -> DataFrame:
    """Per position across samples: NS, AN (alleles, the reference included), DP, MQ0, BQ, MQ, SB and FA."""
    seen = stats.where("ad > 0 OR mq0 > 0")
    alt = F.when(F.col("base") != F.col("ref"), F.col("ad")).otherwise(0)
    alleles = F.collect_set(F.when(F.col("ad") > 0, F.col("base")))
    totals = seen.groupBy("chrom", "pos", "ref").agg(
        F.count_distinct(F.when(F.col("ad") > 0, F.col("sample"))).alias("ns"), F.sum("ad").alias("dp"), F.sum("mq0").alias("mq0"), F.sum("sum_bq").alias("_bq"), F.sum("sum_mq").alias("_mq"),
        F.sum("plus").alias("_plus"), F.sum(alt).alias("_alt"), alleles.alias("_alleles"),
    ).where("dp > 0")
    return totals.select(
        "chrom", "pos", "ref", "ns", F.size(F.array_union("_alleles", F.array("ref"))).cast("long").alias("an"), "dp", "mq0", mean(F.col("_bq"), F.col("dp")).alias("bq"), mean(F.col("_mq"), F.col("dp")).alias("mq"),
        ratio2(F.col("_plus"), F.col("dp")).alias("sb"), ratio2(F.col("_alt"), F.col("dp")).alias("fa"),
    )


def site_evidence(obs: DataFrame, p: CallParams = CallParams()) -> DataFrame:
    """One row per position: the count of each base in each sample, and ``stats``, a map from sample and base to the allele's statistics."""
    # means and shares are taken here, where a row is an allele
    zero = F.lit(0).cast("long")
    means = [F.coalesce(mean(F.col("sum_mq"), F.col("ad")), zero).alias("mqa"), F.coalesce(mean(F.col("sum_bq"), F.col("ad")), zero).alias("bq"), F.coalesce(ratio2(F.col("plus"), F.col("ad")), F.lit(0.0)).alias("sb")]
    value = F.struct("ad", "sum_bq", "sum_mq", "plus", "max_mq", "mq0", *means)
    # at most four bases for each of four samples
    entries = F.map_from_entries(F.collect_list(F.struct(F.concat_ws("_", "sample", "base").alias("k"), value.alias("v"))))
    sites = allele_stats(obs, p).groupBy("chrom", "pos", "ref").agg(entries.alias("stats"))
    return sites.select("*", *[F.coalesce(F.col("stats")[f"{s}_{b}"]["ad"], zero).alias(count_column(s, b)) for s in SAMPLES for b in BASES])


def site_struct() -> Column:
    """The site across samples, from ``stats`` and the samples' structs: counts and shares of each alternate in the order of alts, depth, edges of reads, means."""
    short = [SHORT[s] for s in SAMPLES]
    total = lambda f, where="true": f"aggregate(filter(map_entries(stats), e -> {where}), 0L, (a, e) -> a + e.value.{f})"
    every = lambda f: " + ".join(f"coalesce({s}.{f}, 0L)" for s in short)
    base = "substring_index(e.key, '_', -1)"
    ac = f"transform(alts, (b, i) -> {' + '.join(f'coalesce(get({s}.ad, i + 1), 0L)' for s in short)})"
    shown = f"transform(filter(map_entries(stats), e -> e.value.ad > 0), e -> {base})"
    values = {
        "ns": f"cast(size(filter(array({', '.join(short)}), s -> s IS NOT NULL)) AS bigint)", "an": f"cast(size(array_union(array(ref), {shown})) AS bigint)", "dp": total("ad"), "ac": ac, "mq0": total("mq0"),
        **{c: every(c) for c in EDGES}, "_bq": total("sum_bq"), "_mq": total("sum_mq"), "_plus": total("plus"), "_alt": total("ad", f"{base} <> ref"),
    }
    share = lambda c: f"{hundredths_text(c, 'v.dp')} / 100.0D"
    mean = lambda c: f"CASE WHEN v.dp > 0 THEN (2L * {c} + v.dp) div (2L * v.dp) END"
    kept = [f"'{c}', v.{c}" for c in values if not c.startswith("_")]
    more = [f"'af', transform(v.ac, c -> {share('c')})", f"'bq', {mean('v._bq')}", f"'mq', {mean('v._mq')}", f"'sb', {share('v._plus')}", f"'fa', {share('v._alt')}"]
    text = ", ".join(f"'{k}', {v}" for k, v in values.items())
    return F.expr(let("v", f"named_struct({text})", f"named_struct({', '.join(kept + more)})"))


def site_info(records: DataFrame) -> DataFrame:
    """Records with their ``site`` and modifications as entries of ``info`` (key -> values), as text in the order of the alternates."""
    text = lambda f: F.array(F.col(f"site.{f}").cast("string"))
    each = lambda c: F.transform(c, lambda x: x.cast("string"))
    entries = {k: text(k.lower()) for k in ("NS", "AN", "DP", "INS", "DEL", "START", "STOP", "MQ0", "BQ", "MQ", "SB", "FA")}
    entries |= {"AC": each("site.ac"), "AF": each("site.af"), "MT": F.transform("mods", lambda m: m["type"]), "MC": F.transform("mods", lambda m: F.concat_ws(">", m["src"], m["tgt"])), "SS": F.array(F.col("ss").cast("string")), "VT": F.array(F.lit("SNP"))}
    made = F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)])
    made = F.when(F.col("somatic"), F.map_concat(made, F.create_map(F.lit("SOMATIC"), F.array(F.lit("True"))))).otherwise(made)
    have = "info" in records.columns
    return records.withColumn("info", F.map_concat(F.map_filter("info", lambda k, _: ~k.isin([*entries, "SOMATIC"])), made) if have else made)


def records(obs: DataFrame, p: CallParams = CallParams(), sites: DataFrame | None = None, site: bool = False) -> DataFrame:
    """Calls with per-sample, per-allele evidence: alleles (ref, then alts) and a struct for each sample, null without passing reads.

    site: with a struct of the place across samples (``site_struct``), from the same aggregate. sites: unfiltered counts of insertions, deletions, read starts and ends (chrom, pos, sample, ins, del, start, stop); zero where
    there is no row.
    """
    found = find_variants(site_evidence(obs, p), p)
    out = found.where(F.size("mods") > 0).withColumn("alleles", F.concat(F.array("ref"), "alts"))
    if sites is not None:
        edges = [F.sum(F.when(F.col("sample") == s, F.col(c)).otherwise(0)).cast("long").alias(f"{SHORT[s]}_{c}") for s in SAMPLES for c in EDGES]
        out = out.join(sites.groupBy("chrom", "pos").agg(*edges), ["chrom", "pos"], "left")
    zero = F.lit(0).cast("long")

    def sample(s: str) -> Column:
        own = f"_{SHORT[s]}"
        over = lambda fn: F.transform(own, fn)
        dp = sum(F.col(count_column(s, b)) for b in BASES)
        edge = {c: zero if sites is None else F.coalesce(f"{SHORT[s]}_{c}", zero) for c in EDGES}
        fields = [
            dp.alias("dp"), edge["ins"].alias("ins"), edge["del"].alias("del"), edge["start"].alias("start"), edge["stop"].alias("stop"),
            F.flatten(over(lambda x: F.array(x["plus"], x["ad"] - x["plus"]))).alias("dp4"), F.col(f"{own}.ad").alias("ad"), over(lambda x: ratio2(x["ad"], dp)).alias("af"),
            F.col(f"{own}.mq0").alias("mq0"), F.col(f"{own}.max_mq").alias("mmq"), F.col(f"{own}.mqa").alias("mqa"), F.col(f"{own}.bq").alias("bq"), F.col(f"{own}.sb").alias("sb"),
        ]
        return F.when(dp > 0, F.struct(*fields))

    counts = [count_column(s, b) for s in SAMPLES for b in BASES]
    helpers = [f"{SHORT[s]}_{c}" for s in SAMPLES for c in EDGES] if sites is not None else []
    # each allele's statistics once; the fields read them
    absent = "named_struct('ad', 0L, 'sum_bq', 0L, 'sum_mq', 0L, 'plus', 0L, 'max_mq', 0L, 'mq0', 0L, 'mqa', 0L, 'bq', 0L, 'sb', 0.0D)"
    total = lambda s: " + ".join(count_column(s, b) for b in BASES)
    out = computed(out, {f"_{SHORT[s]}": F.expr(f"CASE WHEN {total(s)} > 0 THEN transform(alleles, b -> coalesce(stats[concat('{s}_', b)], {absent})) END") for s in SAMPLES})
    out = computed(out, {SHORT[s]: sample(s) for s in SAMPLES}).drop(*[f"_{SHORT[s]}" for s in SAMPLES])
    out = computed(out, {"site": site_struct()}) if site else out
    return out.drop("stats", *counts, *helpers)


def run_totals(called: DataFrame) -> DataFrame:
    """Calls of each kind per chromosome."""
    has = lambda t: F.count_if(F.exists("mods", lambda m: m["type"] == t))
    return called.groupBy("chrom").agg(has("GERM").alias("germ"), has("SOM").alias("som"), has("NOR_EDIT").alias("norm_edit"), has("TUM_EDIT").alias("tum_edit"))


def coordinates_with_data(obs: DataFrame) -> DataFrame:
    """Positions with reads, per chromosome and sample."""
    return obs.select("chrom", "sample", "pos").distinct().groupBy("chrom").agg(*[F.count_if(F.col("sample") == s).alias(SHORT[s]) for s in SAMPLES])
