"""Evidence filters on calls: a table of rules per modification type, a pre-filter that drops or re-types weak modifications, and the final type.

Works on records: alleles, samples dn, rn, dt, rt (structs of per-allele arrays), mods, filter (array), origin.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.genotype import recomputed_text
from strandline.functions.rounding import at_least_text, floor2, least_twice, let
from strandline.operators.calling import computed

RNA_TYPES = ["NOR_EDIT", "RNA_NOR_VAR", "TUM_EDIT", "RNA_TUM_VAR"]
#: Order in which types of surviving modifications decide the final type.
PRIORITY = ["GERM", "NOR_EDIT", "RNA_NOR_VAR", "SOM", "TUM_EDIT", "RNA_TUM_VAR", "LOH"]


@dataclass(frozen=True)
class Limits:
    """Limits of one sample."""

    min_depth: int = 8
    max_depth: int = 8000
    min_alt: int = 4
    min_alt_pct: float = 0.03
    min_bq: int = 20
    min_mqa: int = 15
    min_mmq: int = 20
    max_mq0_pct: float = 0.50
    max_indels: int = 3
    max_strand_bias: float = 0.99
    min_strand_bias_depth: int = 4
    max_error_pct: float = 0.01
    min_error_depth: int = 2
    purity: float = 1.0


@dataclass(frozen=True)
class Preset:
    dn: Limits = field(default_factory=Limits)
    rn: Limits = field(default_factory=lambda: Limits(min_alt_pct=0.10))
    dt: Limits = field(default_factory=lambda: Limits(min_alt_pct=0.10))
    rt: Limits = field(default_factory=lambda: Limits(min_alt_pct=0.10))
    mod_min_depth: int = 4
    mod_min_pct: float = 0.10
    genotype_min_depth: int = 4
    genotype_min_pct: float = 0.10
    rna: bool = False
    origin: str | None = None


DNA = Preset(dn=Limits(min_depth=10, min_alt_pct=0.10), dt=Limits(min_depth=10, min_alt_pct=0.10), origin="DNA")
_rna = Limits(min_depth=10, min_alt_pct=0.10, min_bq=15, min_mmq=15, min_mqa=20)
RNA = Preset(
    dn=Limits(min_depth=10, min_alt=0, min_alt_pct=0.0, max_error_pct=1.0, min_bq=15), dt=Limits(min_depth=1, min_alt=1, min_alt_pct=0.01, max_error_pct=1.0, min_bq=15), rn=_rna, rt=_rna,
    mod_min_depth=1, mod_min_pct=0.01, genotype_min_pct=0.0, rna=True, origin="RNA",
)


def at(s: str, f: str, allele: Column) -> Column:
    """A sample's value for an allele; null where the sample is absent."""
    return F.get(F.col(f"{s}.{f}"), (F.array_position("alleles", allele) - 1).cast("int"))


def mq0_fails(s: str, tgt: Column, x: Limits) -> Column:
    return (at(s, "ad", tgt) > 0) & (floor2(at(s, "mq0", tgt), at(s, "ad", tgt)) > x.max_mq0_pct)


def strand_fails(s: str, src: Column, tgt: Column, x: Limits) -> Column:
    t, q = at(s, "sb", tgt), at(s, "sb", src)
    deep_t, deep_s = at(s, "ad", tgt) >= x.min_strand_bias_depth, at(s, "ad", src) >= x.min_strand_bias_depth
    biased = (t > x.max_strand_bias) | (t < F.lit(1.0) - x.max_strand_bias)
    both_alike = deep_s & (((t == 0) & (q == 0)) | ((t == 1) & (q == 1)))
    return deep_t & biased & ~F.coalesce(both_alike, F.lit(False))


def error_fails(s: str, src: Column, tgt: Column, x: Limits, with_target: bool) -> Column:
    """Too many reads of alleles other than source and target (with_target: other than source)."""
    ads = F.arrays_zip(F.col("alleles").alias("b"), F.col(f"{s}.ad").alias("ad"))
    other = F.filter(ads, lambda z: (z["b"] != src) if with_target else (z["b"] != src) & (z["b"] != tgt))
    errors = F.aggregate(other, F.lit(0).cast("long"), lambda acc, z: acc + F.coalesce(z["ad"], F.lit(0).cast("long")))
    return (errors >= x.min_error_depth) & (floor2(errors, F.col(f"{s}.dp")) > x.max_error_pct)


# Rules as data: which sample is looked at for which type and how, the limits of each sample, and one fold that reads both.

SAMPLES = ("dn", "rn", "dt", "rt")
#: (type, sample, how): all tests, all tests where the sample is there, or depth and errors only (the target's reads are errors there).
RULES = [("GERM", "dn", "all"), ("SOM", "dt", "all"), ("SOM", "dn", "context"), ("NOR_EDIT", "dn", "context"), ("TUM_EDIT", "dn", "context"), ("TUM_EDIT", "dt", "context")]
RNA_RULES = [("GERM", "rn", "present"), ("NOR_EDIT", "rn", "all"), ("RNA_NOR_VAR", "rn", "all"), ("SOM", "rt", "present"), ("TUM_EDIT", "rt", "all"), ("RNA_TUM_VAR", "rt", "all")]
SHARE = "(CASE WHEN {t} > 0 THEN floor(cast({c} AS double) / cast({t} AS double) * 100) / 100.0D ELSE 0.0D END)"
#: A sample's value for the target and for the source; reads of other alleles in depth-and-errors rules (o), and without the target's in the others.
T, Q = (lambda f: f"get(v.s.{f}, a.t)"), (lambda f: f"get(v.s.{f}, a.q)")
OTHERS = "(aggregate(v.s.ad, 0L, (n, y) -> n + coalesce(y, 0L)) - coalesce(get(v.s.ad, a.q), 0L) - if(v.l.full, coalesce(get(v.s.ad, a.t), 0L), 0L))"
#: Code, whether depth-and-errors rules have it, and its test: v.l holds the sample's limits, v.s its values, a.t and a.q the places of target and source.
TESTS = [
    ("mndp", True, "coalesce(cast(v.s.dp AS bigint), 0L) < v.l.min_depth"),
    ("mxdp", True, "v.s.dp >= v.l.max_depth"),
    ("mnad", False, f"{T('ad')} < v.l.min_alt"),
    ("mnaf", False, f"400L * {T('ad')} < v.l.share_a * nullif(cast(v.s.dp AS bigint), 0L) + v.l.share_b"),
    ("mnbq", False, f"{T('bq')} < v.l.min_bq"),
    ("mnmqa", False, f"{T('mqa')} < v.l.min_mqa"),
    ("mnmq", False, f"{T('mmq')} < v.l.min_mmq"),
    ("mxmq0", False, f"{T('ad')} > 0 AND {SHARE.format(c=T('mq0'), t=T('ad'))} > v.l.max_mq0_pct"),
    ("mxindel", False, "v.s.ins + v.s.del >= v.l.max_indels"),
    ("sbias", False, f"{T('ad')} >= v.l.min_strand_bias_depth AND ({T('sb')} > v.l.max_strand_bias OR {T('sb')} < 1.0D - v.l.max_strand_bias) AND NOT coalesce({Q('ad')} >= v.l.min_strand_bias_depth AND (({T('sb')} = 0 AND {Q('sb')} = 0) OR ({T('sb')} = 1 AND {Q('sb')} = 1)), false)"),
    ("mxerr", True, f"{OTHERS} >= v.l.min_error_depth AND {SHARE.format(c=OTHERS, t='v.s.dp')} > v.l.max_error_pct"),
]
NO_CODES = "cast(array() AS array<string>)"


def limits_text(p: Preset, s: str, how: str) -> str:
    """The limits of a sample and how a rule looks at it, as a struct of literals."""
    x = getattr(p, s)
    share = x.min_alt_pct if x.purity == 1.0 else round(x.min_alt_pct / x.purity if s == "dn" else x.min_alt_pct * x.purity, 2)
    a, b = least_twice(round(share * 100))
    own = {"s": f"'{s}'", "full": str(how != "context").lower(), "present": str(how == "present").lower(), "share_a": f"{a}L", "share_b": f"{b}L"}
    own |= {f.name: f"{getattr(x, f.name)!r}D" if isinstance(f.default, float) else f"{getattr(x, f.name)}L" for f in fields(x)}
    return f"named_struct({', '.join(f'{k!r}, {v}' for k, v in own.items())})"


def place_text(allele: str) -> str:
    return f"cast(array_position(alleles, {allele}) - 1 AS int)"


def rules_text(p: Preset) -> str:
    """The rules of each type as a map of literals: the sample's number and its limits."""
    rules: dict[str, list[str]] = {}
    for t, s, how in RULES + RNA_RULES * p.rna:
        rules.setdefault(t, []).append(f"named_struct('i', {SAMPLES.index(s)}, 'l', {limits_text(p, s, how)})")
    return f"map({', '.join(f'{t!r}, array({chr(44).join(rows)})' for t, rows in rules.items())})"


def rule_text(m: str, p: Preset) -> str:
    """Sorted codes that fail a modification named ``m`` (a struct of type, src, tgt), as SQL text."""
    rows = lambda which: ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, context, test in TESTS if context or which)
    codes = f"array_compact(if(v.l.full, array({rows(True)}), array({rows(False)})))"
    one = f"if(v.l.present AND v.s IS NULL, {NO_CODES}, transform({codes}, c -> concat(v.l.s, c)))"
    each = f"transform(transform(try_element_at({rules_text(p)}, {m}.type), x -> named_struct('l', x.l, 's', get(array({', '.join(SAMPLES)}), x.i))), v -> {one})"
    ruled = let("a", f"named_struct('t', {place_text(f'{m}.tgt')}, 'q', {place_text(f'{m}.src')})", each)
    indels = " + ".join(f"coalesce({s}.ins + {s}.del, 0L)" for s in SAMPLES)
    more = [f"CASE WHEN {indels} >= {p.dt.max_indels} THEN 'indel' END"]
    if p.rna and p.rn.min_depth > 0:
        more.append(f"CASE WHEN {m}.type = 'GERM' AND rn IS NULL THEN 'dnacall' END")
    if p.rna and p.rt.min_depth > 0:
        more.append(f"CASE WHEN {m}.type = 'SOM' AND rt IS NULL THEN 'rtmndp' END")
    if not p.rna:
        more.append(f"CASE WHEN {m}.type IN ({', '.join(map(repr, RNA_TYPES))}) THEN 'rnacall' END")
    return f"sort_array(array_distinct(concat(coalesce(flatten({ruled}), {NO_CODES}), array_compact(array({', '.join(more)})))))"


def rule_codes(mod: str, p: Preset) -> Column:
    """Codes that fail one modification, the name of a struct of type, src, tgt."""
    return F.expr(rule_text(mod, p))


def pre_filter(records: DataFrame, p: Preset) -> DataFrame:
    """Drops or re-types modifications that the parents' evidence contradicts; adds pre_codes. If none is left, the list stays as it was."""
    share = round(p.mod_min_pct * 100)
    ad = lambda s, a: f"get({s}.ad, {place_text(f'm.{a}')})"
    shared = lambda s, a: at_least_text(ad(s, a), f"{s}.dp", share)

    def enough(s: str, a: str, either: bool = False) -> str:
        """An allele has the depth and share that a modification needs in a sample (either: one of them)."""
        return f"(coalesce({ad(s, a)} >= {p.mod_min_depth}, false) {'OR' if either else 'AND'} coalesce({shared(s, a)}, false))"

    def weak(a: str, low: str, af: str) -> str:
        return f"array(CASE WHEN coalesce({ad('dn', a)}, 0L) < {p.mod_min_depth} THEN '{low}' END, CASE WHEN NOT coalesce({shared('dn', a)}, {str(share <= 0).lower()}) THEN '{af}' END)"

    typed = lambda kind: f"named_struct('type', {kind}, 'src', m.src, 'tgt', m.tgt)"
    keep, none = typed("m.type"), "cast(array() AS array<struct<type:string,src:string,tgt:string>>)"
    also = lambda kind: f"array({keep}, {typed(repr(kind))})"
    survive = f"""CASE m.type
      WHEN 'GERM' THEN CASE WHEN {enough('dn', 'tgt')} THEN array({keep}) WHEN {enough('dt', 'tgt', either=True)} THEN array({typed("'SOM'")}) ELSE {none} END
      WHEN 'SOM' THEN CASE WHEN dn IS NULL OR NOT {enough('dn', 'src')} THEN {none} ELSE array({keep}) END
      WHEN 'LOH' THEN CASE WHEN {enough('dn', 'src')} THEN array({keep}) ELSE {none} END
      ELSE CASE
        WHEN m.type IN ('NOR_EDIT', 'RNA_NOR_VAR') AND {enough('dn', 'tgt')} THEN {also('GERM')}
        WHEN m.type = 'RNA_NOR_VAR' AND dn IS NOT NULL THEN {also('NOR_EDIT')}
        WHEN m.type IN ('NOR_EDIT', 'RNA_NOR_VAR') AND NOT {enough('rn', 'tgt')} AND {enough('rt', 'tgt')} THEN {also('TUM_EDIT')}
        WHEN m.type IN ('TUM_EDIT', 'RNA_TUM_VAR') AND {enough('dt', 'tgt')} THEN {also('SOM')}
        WHEN m.type = 'RNA_TUM_VAR' AND coalesce({ad('dt', 'tgt')}, 0L) = 0 THEN {also('TUM_EDIT')}
        ELSE array({keep}) END END"""
    codes = f"CASE WHEN m.type = 'GERM' THEN {weak('tgt', 'dnmnad', 'dnmnaf')} WHEN m.type = 'SOM' AND dn IS NULL THEN array('dnmndp') WHEN m.type = 'SOM' THEN {weak('src', 'dnmnrefad', 'dnmnrefaf')} ELSE {NO_CODES} END"
    # the codes are looked at only where nothing survives
    out = computed(records, {"_survive": F.expr(f"array_distinct(flatten(transform(mods, m -> {survive})))")})
    return out.withColumns({
        "pre_codes": F.expr(f"if(size(_survive) > 0, {NO_CODES}, sort_array(array_distinct(array_compact(flatten(transform(mods, m -> {codes}))))))"), "mods": F.expr("if(size(_survive) > 0, _survive, mods)"),
    }).drop("_survive")


def judge(records: DataFrame, p: Preset, with_pre_filter: bool = True, with_genotypes: bool = True) -> DataFrame:
    """Filter calls by the preset: adds final_type, mod_filters (type, src, tgt, codes of each modification) and each sample's recomputed genotype (dn_gt and so on), and sets filter, mods and origin.

    Modifications without a failing code survive; if none does, the call gets all codes.
    """
    r = pre_filter(records, p) if with_pre_filter else records.withColumn("pre_codes", F.array().cast("array<string>"))
    r = computed(r, {"mod_filters": F.expr(f"transform(mods, m -> named_struct('type', m.type, 'src', m.src, 'tgt', m.tgt, 'codes', {rule_text('m', p)}))")})
    alive = "if(size(pre_codes) > 0, slice(mods, 1, 0), transform(filter(mod_filters, m -> size(m.codes) = 0), m -> named_struct('type', m.type, 'src', m.src, 'tgt', m.tgt)))"
    r = computed(r, {"_alive": F.expr(alive), "_every": F.expr("sort_array(array_distinct(concat(pre_codes, flatten(mod_filters.codes))))")})
    have = r.columns
    earlier = "array_remove(`filter`, 'PASS')" if "filter" in have else NO_CODES
    kinds = " ".join(f"WHEN array_contains(if(size(_alive) > 0, _alive.type, mods.type), {t!r}) THEN {t!r}" for t in PRIORITY)
    r = computed(r, {
        "_filter": F.expr(f"CASE WHEN size(_alive) = 0 THEN sort_array(array_union({earlier}, _every)) WHEN size({earlier}) = 0 THEN array('PASS') ELSE {earlier} END"),
        "_final": F.expr(f"CASE {kinds} END"),
    })
    made = {"filter": F.col("_filter"), "mods": F.expr("if(size(_alive) > 0, _alive, mods)"), "final_type": F.col("_final"), "ss": ss_of(F.col("_final")), "somatic": F.expr("_final = 'SOM'")}
    if p.origin:
        made["origin"] = F.array_union(F.col("origin") if "origin" in have else F.array().cast("array<string>"), F.array(F.lit(p.origin)))
    return r.withColumns(made | (genotypes(p) if with_genotypes else {})).drop("_alive", "_every", "_filter", "_final")


def genotypes(p: Preset) -> dict[str, Column]:
    """Each sample's recomputed genotype, null without the sample; plain columns, so that who doesn't read them doesn't pay for them."""
    return {f"{s}_gt": F.expr(f"CASE WHEN {s} IS NOT NULL THEN {recomputed_text('chrom', f'{s}.ad', p.genotype_min_depth, p.genotype_min_pct)} END") for s in SAMPLES}


def final_type(types: Column) -> Column:
    """The type of highest priority in an array of types."""
    return F.get(F.filter(F.array(*[F.lit(t) for t in PRIORITY]), lambda t: F.array_contains(types, t)), 0)


def ss_of(kind: Column) -> Column:
    return F.when(kind == "GERM", 1).when(kind == "SOM", 2).when(kind == "LOH", 3).when(kind.isin("NOR_EDIT", "TUM_EDIT"), 4).otherwise(5)


def somatic_evidence(judged: DataFrame) -> DataFrame:
    """Passing somatic calls, those with RNA reads, and those with RNA reads of the variant."""
    som = (F.col("final_type") == "SOM") & F.array_contains("filter", "PASS")
    tgt = F.get(F.col("mods"), 0)["tgt"]
    return judged.agg(F.count_if(som).alias("n_somatic"), F.count_if(som & (F.coalesce(F.col("rt.dp"), F.lit(0)) > 1)).alias("n_rna"), F.count_if(som & (F.coalesce(at("rt", "ad", tgt), F.lit(0)) > 1)).alias("n_rna_alt"))


def with_limits(p: Preset, **limits) -> Preset:
    """A preset with some limits changed in every sample."""
    return replace(p, **{s: replace(getattr(p, s), **limits) for s in ("dn", "rn", "dt", "rt")})
