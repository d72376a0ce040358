"""Genotypes from allele depths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.rounding import hundredths, hundredths_text, let

MITO = ["M", "MT", "chrM", "chrMT"]
SEX_Y = ["Y", "chrY"]


def _passes(depth: Column, total: Column, min_depth: int, min_pct: float) -> Column:
    return (depth >= min_depth) & (F.coalesce(hundredths(depth, total), F.lit(0)) >= round(min_pct * 100))


def _ranked(depths: Column) -> Column:
    """Allele indexes by depth, the deepest first; ties go to the lower index."""
    return F.array_sort(F.transform(depths, lambda d, i: F.struct((-d).alias("d"), i.cast("int").alias("i"))))


def diploid(depths: Column, total: Column, min_depth: int = 2, min_pct: float = 0.10) -> Column:
    ranked = _ranked(depths)
    first, second = F.get(ranked, 0), F.get(ranked, 1)
    ok = second.isNotNull() & _passes(-second["d"], total, min_depth, min_pct)
    return F.array_sort(F.array(first["i"], F.when(ok, second["i"]).otherwise(first["i"])))


def single(depths: Column, total: Column, min_depth: int = 2, min_pct: float = 0.10) -> Column:
    """One index: the deepest allele if it passes both minimums, else 0."""
    best = F.get(_ranked(depths), 0)
    return F.array(F.when(_passes(-best["d"], total, min_depth, min_pct), best["i"]).otherwise(0))


def single_alt(depths: Column, total: Column, min_depth: int = 4, min_pct: float = 0.10) -> Column:
    """One index: the deepest allele but the first, if it passes both minimums, else 0."""
    best = F.get(F.filter(_ranked(depths), lambda x: x["i"] > 0), 0)
    return F.array(F.when(_passes(-best["d"], total, min_depth, min_pct), best["i"]).otherwise(0))


def mitochondrial(depths: Column, total: Column, min_depth: int = 2, min_pct: float = 0.10) -> Column:
    """All alleles that pass both minimums; [0] if none does."""
    kept = F.filter(F.transform(depths, lambda d, i: F.when(_passes(d, total, min_depth, min_pct), i.cast("int"))), lambda i: i.isNotNull())
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(0)))


def genotype(chrom: Column, depths: Column, total: Column, min_depth: int = 2, min_pct: float = 0.10) -> Column:
    args = (depths, total, min_depth, min_pct)
    return F.when(chrom.isin(SEX_Y), single(*args)).when(chrom.isin(MITO), mitochondrial(*args)).otherwise(diploid(*args))


def recomputed(chrom: Column, depths: Column, min_depth: int = 4, min_pct: float = 0.10) -> Column:
    """The filter's genotype, from the depths of the called alleles alone."""
    total = F.aggregate(depths, F.lit(0).cast("long"), lambda a, d: a + d)
    args = (depths, total, min_depth, min_pct)
    return F.when(chrom.isin(SEX_Y), single_alt(*args)).when(chrom.isin(MITO), mitochondrial(*args)).otherwise(diploid(*args))


def recomputed_text(chrom: str, depths: str, min_depth: int = 4, min_pct: float = 0.10) -> str:
    """``recomputed`` as SQL text."""
    quoted = lambda names: ", ".join(f"'{n}'" for n in names)
    good = f"transform({depths}, d -> d >= {min_depth} AND coalesce({hundredths_text('d', f'aggregate({depths}, 0L, (a, x) -> a + x)')}, 0L) >= {round(min_pct * 100)})"
    ranked = f"array_sort(transform({depths}, (d, i) -> named_struct('d', -d, 'i', i)))"
    alt = let("b", "get(filter(g.r, x -> x.i > 0), 0)", "array(if(get(g.ok, b.i), b.i, 0))")
    every = let("k", "filter(transform(g.ok, (o, i) -> if(o, i, null)), i -> i IS NOT NULL)", "if(size(k) > 0, k, array(0))")
    two = "array_sort(array(get(g.r, 0).i, if(get(g.ok, get(g.r, 1).i), get(g.r, 1).i, get(g.r, 0).i)))"
    return let("g", f"named_struct('r', {ranked}, 'ok', {good})", f"CASE WHEN {chrom} IN ({quoted(SEX_Y)}) THEN {alt} WHEN {chrom} IN ({quoted(MITO)}) THEN {every} ELSE {two} END")


def text(gt: Column) -> Column:
    return F.array_join(F.transform(gt, lambda g: g.cast("string")), "/")


def pad(values: Column, padder: Column, n: Column) -> Column:
    """Right-pad an array to n values."""
    return F.concat(values, F.array_repeat(padder, F.greatest(n - F.size(values), F.lit(0))))
