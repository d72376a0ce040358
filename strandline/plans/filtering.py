"""The filtering plan: steps from calls to filtered calls as one lazy DAG."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators import genes, intervals, merge, read_evidence, support

#: Interval steps (name, code, inside, where to, value).
INTERVAL_STEPS = [
    ("blacklist", "blck", False, "filter", "flag"), ("dbsnp", "DB", True, "id", "flag"), ("retro_genes", "RTPS", True, "info", "flag"), ("pseudo_genes", "EGPS", True, "info", "flag"),
    ("cosmic", "COSMIC", True, "info", "count"), ("radar", "RADAR", True, "info", "name"), ("darned", "DARNED", True, "info", "name"), ("targets", "ntr", False, "filter", "flag"),
]


#: Columns that judging a call sets.
JUDGED = ["filter", "mods", "origin", "types", "mod_filters", "final_type", "ss", "somatic"]


def typed(calls: DataFrame) -> DataFrame:
    """Types as the modifications have them now."""
    return calls.withColumn("types", F.array_distinct("mods.type"))


def judged(calls: DataFrame, p: support.Preset, with_genotypes: bool = True) -> DataFrame:
    """Calls judged by a preset, with their types and the codes of all their modifications."""
    out = typed(support.judge(calls, p, with_genotypes=with_genotypes)).drop("pre_codes")
    return out.withColumn("mod_filters", F.array_distinct(F.flatten("mod_filters.codes")))


@dataclass
class FilterPlan:
    """What to run: ``databases`` holds interval tables by step name, steps without one are left out.

    dna_only and rna_only choose one branch; effects, realigned and read_support are functions on calls that stand for results of
    external tools and reads, left out where they are None. With ``reads`` and a packed ``reference`` the last step is
    ``read_evidence.filter_by_reads``.
    """

    databases: dict[str, DataFrame] = field(default_factory=dict)
    dna_only: bool = False
    rna_only: bool = False
    targets_info: bool = False
    dna: support.Preset = support.DNA
    rna: support.Preset = support.RNA
    gene_lists: tuple[DataFrame, DataFrame] | None = None
    effects: Callable[[DataFrame], DataFrame] | None = None
    realigned: Callable[[DataFrame], DataFrame] | None = None
    read_support: Callable[[DataFrame], DataFrame] | None = None
    reads: DataFrame | None = None
    reference: DataFrame | None = None
    read_limits: read_evidence.ReadLimits = read_evidence.ReadLimits()

    def steps(self) -> list[str]:
        """The steps that a run would take, in order; nothing runs."""
        out = [f"interval:{name}" for name, *_ in INTERVAL_STEPS if name in self.databases]
        if self.dna_only:
            out.append("support:dna")
        elif self.rna_only:
            out += ["support:rna", "rna_only"]
        else:
            out += ["support:rna", "support:dna", "compare", "support:dna:non_overlap", "rna_only"]
        out += ["realign"] * (self.realigned is not None and not self.dna_only)
        out += ["merge"] * (not self.dna_only and not self.rna_only)
        out += ["passing", "effects"] * (self.effects is not None)
        out += ["genes"] * (self.effects is not None and self.gene_lists is not None and not self.dna_only)
        out += ["overlay"] * (self.effects is not None)
        return out + ["read_support"] * (self.read_support is not None or self.reads is not None)

    def intervals(self, calls: DataFrame) -> DataFrame:
        for name, code, inside, to, value in INTERVAL_STEPS:
            if name in self.databases:
                if name == "targets" and self.targets_info:
                    code, to = "NTR", "info"
                calls = intervals.tag(calls, self.databases[name], code, inside, to, value)
        return calls

    def merged(self, start: DataFrame) -> DataFrame:
        """Both branches and their merge, row by row: a call is judged as DNA, as RNA, and what only RNA passes as DNA again; no row leaves its task.

        Filter, modifications, types, genotypes and status are those of the branch that stands (``merge.resolved``).
        """
        own = [c for c in start.columns if c not in [*JUDGED, *support.genotypes(self.dna)]]
        given = start.select(*own, F.struct("filter", "mods", *[c for c in ["origin"] if c in start.columns]).alias("_given"))

        def branch(df: DataFrame, name: str, p: support.Preset, before: Column) -> DataFrame:
            """``df`` with a struct of what judging gives to the calls as they were ``before`` (filter, mods and origin)."""
            done = [c for c in df.columns if c not in own]
            have = [f.name for f in df.select(before.alias("b")).schema["b"].dataType.fields]
            out = judged(df.withColumns({c: before[c] for c in have}), p, with_genotypes=False)
            return out.select(*own, *done, F.struct(*[c for c in JUDGED if c in out.columns], F.lit(p.rna).alias("_rna")).alias(name))

        passes = lambda s: F.array_contains(f"{s}.filter", "PASS")
        som = lambda s: F.array_contains(f"{s}.types", "SOM")
        wide = branch(branch(given, "r", self.rna, F.col("_given")), "d", self.dna, F.col("_given"))
        asked = passes("r") & ~passes("d")
        mods = F.when(asked, F.col("r.mods")).otherwise(F.slice("r.mods", 1, 0))  # the others have nothing to judge
        again = branch(wide, "n", replace(self.dna, origin=None), F.struct(F.array(F.lit("PASS")).alias("filter"), mods.alias("mods"), F.col("r.origin").alias("origin")))
        rescued = asked & ~merge.traced(F.col("n.filter"), F.col("info"), F.col("n.types"))
        kind = again.schema["n"].dataType
        n = F.col("n").withField("filter", F.array(F.lit("PASS"))).withField("origin", F.array(F.lit("RNA")))
        wide = again.select(*own, "r", "d", (passes("r") & passes("d") & som("r") & som("d")).alias("both"), F.when(rescued, n).alias("n"))
        if self.realigned:  # by the place: what stands for hits decides on the calls that only RNA has
            only = typed(self.realigned(wide.where("n IS NOT NULL").select(*own, "n.*")))
            judged_n = only.select(*merge.KEYS, F.struct(*[f.name for f in kind.fields]).alias("n"))
            wide = wide.drop("n").join(judged_n, merge.KEYS, "left")
        out = merge.resolved(wide, [f.name for f in kind.fields if f.name not in merge.FIELDS])
        # genotypes depend on the preset alone, not on the modifications that it judged
        rna = support.genotypes(self.rna)
        return out.withColumns({c: F.when(F.col("_rna"), rna[c]).otherwise(g) for c, g in support.genotypes(self.dna).items()}).drop("_rna")

    def run(self, records: DataFrame) -> DataFrame:
        """Records (chrom, pos, id, filter, info, alleles, mods, dn, rn, dt, rt) to calls with filter, types, origin and final type."""
        start = self.intervals(records)
        if self.dna_only:
            out = judged(start, self.dna)
        elif self.rna_only:
            out = merge.rna_only(judged(start, self.rna))
            out = typed(self.realigned(out)) if self.realigned else out
        else:
            out = self.merged(start)
        if self.effects:
            passing = self.effects(merge.passing(out))
            if self.gene_lists and not self.dna_only:
                passing = genes.blacklist(passing, *self.gene_lists)
            out = merge.overlay(out, passing.select(*out.columns))
        if self.reads is not None:
            return read_evidence.filter_by_reads(out, self.reads, self.reference, p=self.read_limits)
        return self.read_support(out) if self.read_support else out
