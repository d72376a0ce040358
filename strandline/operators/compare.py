"""Comparison of two call sets (chrom, pos, types array, filter array)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_spec(spec: str) -> list[tuple[str, list[str]]]:
    """"A=B,C" style specification: left types, each with the right types that agree with it."""
    pairs: list[tuple[str, list[str]]] = []
    for item in spec.split(","):
        if "=" in item:
            left, right = item.split("=", 1)
            pairs.append((left.strip(), [right.strip()]))
        elif pairs:
            pairs[-1][1].append(item.strip())
        else:
            raise ValueError(f"no left key in {spec!r}")
    return pairs


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join on (chrom, pos); l and r are the sides' (types, filter)."""
    side = lambda df, c: df.select("chrom", "pos", F.struct("types", "filter").alias(c))
    return side(left, "l").join(side(right, "r"), ["chrom", "pos"], "full")


def counts(left: DataFrame, right: DataFrame, spec: list[tuple[str, list[str]]]) -> DataFrame:
    """Per key: left, right and overlapping calls, all and passing."""
    j = paired(left, right)
    ok = lambda s: F.coalesce(F.array_contains(f"{s}.filter", "PASS"), F.lit(False))
    rows = []
    for a, bs in spec:
        in_l = F.coalesce(F.array_contains("l.types", a), F.lit(False))
        in_r = F.coalesce(F.arrays_overlap("r.types", F.array(*[F.lit(b) for b in bs])), F.lit(False))
        rows.append(F.struct(F.lit(a).alias("key"), *[c.alias(n) for c, n in ((in_l, "l"), (in_l & ok("l"), "lp"), (in_r, "r"), (in_r & ok("r"), "rp"), (in_l & in_r, "o"), (in_l & in_r & ok("l") & ok("r"), "op"))]))
    flat = j.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    return flat.groupBy("key").agg(*[F.count_if(c).alias(n) for c, n in (("l", "n_left"), ("lp", "n_left_pass"), ("r", "n_right"), ("rp", "n_right_pass"), ("o", "n_overlap"), ("op", "n_overlap_pass"))])


def filter_counts(calls: DataFrame) -> DataFrame:
    return calls.select(F.explode("filter").alias("filter")).groupBy("filter").agg(F.count("*").alias("n"))


def overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Passing left calls at places that pass on the right too."""
    return left.where(F.array_contains("filter", "PASS")).join(right.where(F.array_contains("filter", "PASS")).select("chrom", "pos"), ["chrom", "pos"], "left_semi")


def non_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Passing left calls at places that the right does not have."""
    return left.where(F.array_contains("filter", "PASS")).join(right.select("chrom", "pos"), ["chrom", "pos"], "left_anti")
