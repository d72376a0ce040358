"""Filter of calls by gene lists: names that contain an entry, or families that equal one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.strings import parse_effects
from strandline.operators.intervals import with_filter


def listed(values: DataFrame, name: str, entries: DataFrame) -> DataFrame:
    """Distinct values of a column that contain some entry of a list (column ``entry``); null and empty entries are none.

    Distinct names are few beside the rows that carry them: each is cut into its parts of the lengths that entries have (their set is a scalar subquery of the
    plan), and the parts meet the list in one join, whatever its length. Nothing runs while the plan is built.
    """
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    entries = entries.select("entry").where("entry IS NOT NULL AND entry <> ''").distinct()
    lengths = entries.agg(F.collect_set(F.length("entry")).alias("n")).scalar()
    parts = distinct.withColumn("_lengths", lengths).withColumn("_n", F.explode("_lengths")).where(F.col("_n") <= F.length(name))
    parts = parts.withColumn("_at", F.explode(F.sequence(F.lit(1), F.length(name) - F.col("_n") + 1))).withColumn("entry", F.substring(name, F.col("_at"), F.col("_n")))
    return parts.join(entries, "entry", "left_semi").select(name).distinct()


def blacklist(calls: DataFrame, genes: DataFrame, families: DataFrame, code: str = "rgene", whitelist: DataFrame | None = None) -> DataFrame:
    """Adds the code to calls with an effect (array column ``eff``) on a listed gene or family; upstream and downstream effects do not count. Needs chrom, pos."""
    keys = ["chrom", "pos"]
    effects = calls.select(*keys, F.explode(parse_effects(F.col("eff"))).alias("e")).select(*keys, "e.*").where("effect NOT IN ('UPSTREAM', 'DOWNSTREAM')")
    bad = effects.join(listed(effects, "gene", genes), "gene", "left_semi").select(*keys)
    bad = bad.union(effects.join(families.select(F.col("entry").alias("biotype")).distinct(), "biotype", "left_semi").select(*keys)).distinct()
    if whitelist is not None:
        good = effects.join(listed(effects, "gene", whitelist), "gene", "left_semi").select(*keys).distinct()
        bad = bad.join(good, keys, "left_anti")
    return calls.join(bad.withColumn("_bad", F.lit(True)), keys, "left").withColumn("filter", with_filter(code, F.coalesce("_bad", F.lit(False)))).drop("_bad")
