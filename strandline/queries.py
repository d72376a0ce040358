"""Queries over the driver tables, one for each operator, and the SQL that gives the same rows.

The tables hold no genomes: ``obs`` reads lineitem and part as observations (position: part, sample: return flag, qualities: quantity
and discount), and the other views build calls, intervals, reads and hits from them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import genotype, strings
from strandline.functions.rounding import hundredths_sql, ratio2
from strandline.operators import calling, compare, genes, intervals, merge, read_evidence, realign, reads, score, support
from strandline.operators.calling import BASES
from strandline.plans.filtering import FilterPlan
from strandline.sources import reference

#: Lower minimums than the presets': a position has about thirty reads over three samples.
LOW = {"min_depth": 4, "min_alt": 3, "min_bq": 20, "min_mqa": 25, "min_mmq": 30}
DNA_LOW, RNA_LOW = support.with_limits(support.DNA, **LOW, max_error_pct=0.10), support.with_limits(support.RNA, **LOW, max_error_pct=0.10)
GENES = ["almond", "azure", "green", "steel"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def letter(n) -> F.Column:
    return F.substring(F.lit("ACGT"), (1 + n % 4).cast("int"), F.lit(1))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = read(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    j = line.join(read(spark, sf_dir, "part").select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    number, kind = F.col("l_linenumber"), F.col("l_returnflag")
    shift = F.when((number >= 6) & (kind != "A"), 1).when(number == 7, 2).otherwise(0)
    return j.select(
        (F.col("p_size") % 25).cast("string").alias("chrom"), (F.col("l_partkey") + 1).alias("pos"), letter(F.col("p_partkey")).alias("ref"), F.when(kind == "A", "DNA_NORMAL").when(kind == "R", "DNA_TUMOR").otherwise("RNA_TUMOR").alias("sample"),
        letter(F.col("p_partkey") + shift).alias("base"), F.col("l_quantity").cast("int").alias("bq"), F.round(F.col("l_discount") * 600).cast("int").alias("mq"), (F.col("l_linestatus") == "F").alias("plus"),
        F.col("l_orderkey").alias("read_name"), F.col("l_linenumber").cast("int").alias("line"),
    )


OBS = """obs AS (
  SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, l_partkey + 1 AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref,
    CASE l_returnflag WHEN 'A' THEN 'DNA_NORMAL' WHEN 'R' THEN 'DNA_TUMOR' ELSE 'RNA_TUMOR' END AS sample,
    substr('ACGT', CAST(1 + (p_partkey + CASE WHEN l_linenumber >= 6 AND l_returnflag <> 'A' THEN 1 WHEN l_linenumber = 7 THEN 2 ELSE 0 END) % 4 AS INT), 1) AS base,
    CAST(l_quantity AS INT) AS bq, CAST(round(l_discount * 600) AS INT) AS mq, l_linestatus = 'F' AS plus, l_orderkey AS read_name, CAST(l_linenumber AS INT) AS line
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
STATS = """stats AS (
  SELECT chrom, pos, ref, sample, base, count(*) FILTER (bq >= 10 AND mq >= 10) AS ad, CAST(coalesce(sum(bq) FILTER (bq >= 10 AND mq >= 10), 0) AS BIGINT) AS sum_bq,
    CAST(coalesce(sum(mq) FILTER (bq >= 10 AND mq >= 10), 0) AS BIGINT) AS sum_mq, count(*) FILTER (bq >= 10 AND mq >= 10 AND plus) AS plus,
    CAST(coalesce(max(mq) FILTER (bq >= 10 AND mq >= 10), 0) AS BIGINT) AS max_mq, count(*) FILTER (mq = 0) AS mq0
  FROM obs GROUP BY ALL)"""
#: One row per position and base with the counts of the samples, the flags of the parents' bases and the counts they are held against.
STATE = """n AS (
  SELECT s.chrom, s.pos, s.ref, b.base, coalesce(sum(ad) FILTER (sample = 'DNA_NORMAL'), 0) AS dn, coalesce(sum(ad) FILTER (sample = 'DNA_TUMOR'), 0) AS dt, coalesce(sum(ad) FILTER (sample = 'RNA_TUMOR'), 0) AS rt
  FROM (SELECT DISTINCT chrom, pos, ref FROM stats) s CROSS JOIN (VALUES ('A'), ('C'), ('T'), ('G')) b(base)
  LEFT JOIN stats a ON a.chrom = s.chrom AND a.pos = s.pos AND a.base = b.base GROUP BY ALL
), t AS (
  SELECT *, base = ref AS isref, sum(dn) OVER w AS dnt, sum(dt) OVER w AS dtt, sum(rt) OVER w AS rtt FROM n WINDOW w AS (PARTITION BY chrom, pos)
), s1 AS (
  SELECT *, dnt > 0 AND (isref OR dn > 0) AS p1, CASE WHEN dnt = 0 OR isref THEN 2 ELSE dn END AS prev2, CASE WHEN (dnt = 0 AND dtt = 0) OR isref THEN 2 ELSE dt END AS prev3 FROM t
), state AS (
  SELECT *, p1 OR isref AS in2, (CASE WHEN dtt > 0 THEN p1 OR isref OR dt > 0 ELSE p1 END) OR isref AS in3 FROM s1
), mods AS (
  SELECT b.chrom, b.pos, b.ref, 'GERM' AS type, b.ref AS src, b.base AS tgt FROM state b WHERE b.dnt >= 4 AND b.dn >= 2 AND NOT b.isref
  UNION ALL
  SELECT b.chrom, b.pos, b.ref, 'SOM', d.base, b.base FROM state b JOIN state d ON b.chrom = d.chrom AND b.pos = d.pos AND b.base <> d.base
  WHERE b.dtt >= 4 AND b.dt >= 2 AND (NOT b.in2 OR b.prev2 < 2) AND d.in2 AND d.prev2 >= 2
  UNION ALL
  SELECT b.chrom, b.pos, b.ref, 'TUM_EDIT', d.base, b.base FROM state b JOIN state d ON b.chrom = d.chrom AND b.pos = d.pos AND b.base <> d.base
  WHERE b.rtt >= 4 AND b.rt >= 2 AND (NOT b.in3 OR b.prev3 < 2) AND d.in3 AND d.prev3 >= 2)"""
CALLS = f"WITH {OBS}, {STATS}, {STATE}"
#: Depths of source and target for each modification, by sample (dn, dt, rt).
DEPTHS = """g AS (
  SELECT m.*, a.dn AS dn_src, a.dt AS dt_src, a.rt AS rt_src, b.dn AS dn_tgt, b.dt AS dt_tgt, b.rt AS rt_tgt, b.dnt, b.dtt, b.rtt
  FROM mods m JOIN state a ON a.chrom = m.chrom AND a.pos = m.pos AND a.base = m.src JOIN state b ON b.chrom = m.chrom AND b.pos = m.pos AND b.base = m.tgt)"""

QUERIES: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = f, sql
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items() if sql}


# Observations and calls


@query(f"WITH {OBS} SELECT chrom, pos, sample, base, bq, mq, plus FROM obs WHERE bq >= 10 AND mq >= 10")
def q_obs_quality(spark, d):
    return obs(spark, d).where(calling.passing()).select("chrom", "pos", "sample", "base", "bq", "mq", "plus")


@query(f"WITH {OBS} SELECT chrom, pos, sample, base FROM obs WHERE chrom = '7' AND pos BETWEEN 100 AND 1500")
def q_region(spark, d):
    return calling.region(obs(spark, d), "7", 100, 1500).select("chrom", "pos", "sample", "base")


@query("""WITH e AS (SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, min(p_partkey * 10) AS a, max(p_partkey * 10 + 9) AS b FROM part GROUP BY ALL), s AS (SELECT chrom, b, unnest(range(a, b + 1, 1000)) AS start FROM e)
SELECT chrom, CAST(start AS BIGINT) AS start, CAST(least(start + 999, b) AS BIGINT) AS stop FROM s""")
def q_batch_ranges(spark, d):
    """Batches of a thousand positions over the extent of each chromosome's calls, ten positions for each part."""
    extents = read(spark, d, "part").groupBy((F.col("p_size") % 25).cast("string").alias("chrom")).agg(F.min(F.col("p_partkey") * 10).alias("start"), F.max(F.col("p_partkey") * 10 + 9).alias("stop"))
    return calling.batch_ranges(extents, 1000)


@query(f"WITH {OBS}, {STATS} SELECT * FROM stats")
def q_allele_stats(spark, d):
    return calling.allele_stats(obs(spark, d))


@query(f"{CALLS} SELECT chrom, pos, ref, " + ", ".join(f"CAST(coalesce(sum({s}) FILTER (base = '{b}'), 0) AS BIGINT) AS {s}_{b}" for s in ("dn", "dt", "rt") for b in BASES) + " FROM n GROUP BY chrom, pos, ref")
def q_pileup_outer_merge(spark, d):
    return calling.merged_counts(obs(spark, d)).select("chrom", "pos", "ref", *[f"{s}_{b}" for s in ("dn", "dt", "rt") for b in BASES])


@query(f"""WITH {OBS}, {STATS}, seen AS (SELECT * FROM stats WHERE ad > 0 OR mq0 > 0), x AS (
  SELECT chrom, pos, ref, count(DISTINCT sample) FILTER (ad > 0) AS ns, count(DISTINCT base) FILTER (ad > 0 AND base <> ref) + 1 AS an, CAST(sum(ad) AS BIGINT) AS dp, CAST(sum(mq0) AS BIGINT) AS mq0,
    CAST(sum(sum_bq) AS BIGINT) AS b, CAST(sum(sum_mq) AS BIGINT) AS m, CAST(sum(plus) AS BIGINT) AS p, CAST(coalesce(sum(ad) FILTER (base <> ref), 0) AS BIGINT) AS a FROM seen GROUP BY ALL)
SELECT chrom, pos, ref, ns, an, dp, mq0, (2 * b + dp) // (2 * dp) AS bq, (2 * m + dp) // (2 * dp) AS mq, {hundredths_sql('p', 'dp')} / 100.0 AS sb, {hundredths_sql('a', 'dp')} / 100.0 AS fa FROM x WHERE dp > 0""")
def q_site_summary(spark, d):
    return calling.site_summary(calling.allele_stats(obs(spark, d)))


def called(spark: SparkSession, d: str) -> DataFrame:
    return calling.calls(obs(spark, d))


def mods_of(spark: SparkSession, d: str, kind: str) -> DataFrame:
    return calling.modifications(called(spark, d)).where(F.col("type") == kind)


def depth_of(s: str, base) -> F.Column:
    return sum(F.when(base == b, F.col(f"{s}_{b}")).otherwise(0) for b in BASES)


def total_of(s: str) -> F.Column:
    return sum(F.col(f"{s}_{b}") for b in BASES)


def call_query(spark, d, kind: str, s: str) -> DataFrame:
    m = mods_of(spark, d, kind).withColumns({"ad": depth_of(s, F.col("tgt")), "dp": total_of(s)})
    return m.select("chrom", "pos", "ref", "src", "tgt", F.col("ad").cast("long"), F.col("dp").cast("long"), ratio2(F.col("ad"), F.col("dp")).alias("af"))


def call_sql(kind: str, s: str) -> str:
    return f"{CALLS}, {DEPTHS} SELECT chrom, pos, ref, src, tgt, CAST({s}_tgt AS BIGINT) AS ad, CAST({s}t AS BIGINT) AS dp, {hundredths_sql(f'CAST({s}_tgt AS BIGINT)', f'CAST({s}t AS BIGINT)')} / 100.0 AS af FROM g WHERE type = '{kind}'"


@query(call_sql("GERM", "dn"))
def q_call_germline(spark, d):
    return call_query(spark, d, "GERM", "dn")


@query(call_sql("SOM", "dt"))
def q_call_somatic(spark, d):
    return call_query(spark, d, "SOM", "dt")


@query(call_sql("TUM_EDIT", "rt"))
def q_call_edit(spark, d):
    return call_query(spark, d, "TUM_EDIT", "rt")


@query(f"""{CALLS} SELECT m.chrom, m.pos, string_agg(DISTINCT m.tgt, ',' ORDER BY m.tgt) AS called, min(CASE m.type WHEN 'GERM' THEN 1 WHEN 'SOM' THEN 2 ELSE 4 END) AS ss, bool_or(m.type = 'SOM') AS somatic FROM mods m GROUP BY ALL""")
def q_call_record(spark, d):
    # samples are visited normal first, so the first modification has the lowest code
    return called(spark, d).select("chrom", "pos", F.array_join(F.array_sort(F.array_distinct(F.transform("mods", lambda m: m["tgt"]))), ",").alias("called"), "ss", "somatic")


@query(f"""WITH {OBS}, bad AS (SELECT chrom, pos FROM (SELECT *, CASE WHEN bq = 50 AND line = 1 THEN 'N' ELSE ref END AS r FROM obs) GROUP BY ALL HAVING min(r) <> max(r) OR contains(min(r), 'N'))
SELECT chrom, count(*) AS n, count(DISTINCT pos) AS n_pos FROM obs WHERE (chrom, pos) NOT IN (SELECT chrom, pos FROM bad) GROUP BY chrom""")
def q_consistent_reference(spark, d):
    o = obs(spark, d).withColumn("ref", F.when((F.col("bq") == 50) & (F.col("line") == 1), "N").otherwise(F.col("ref")))
    return calling.consistent_reference(o).groupBy("chrom").agg(F.count("*").alias("n"), F.count_distinct("pos").alias("n_pos"))


def coordinates(spark, d) -> DataFrame:
    return read(spark, d, "part").select((F.col("p_size") % 25).cast("string").alias("chrom"), F.col("p_partkey").alias("start"), (F.col("p_partkey") + 2).alias("stop"))


@query(f"""WITH {OBS}, c AS (SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey AS a, p_partkey + 2 AS b FROM part)
SELECT chrom, pos, count(*) AS n FROM obs o WHERE EXISTS (SELECT 1 FROM c WHERE c.chrom = o.chrom AND o.pos BETWEEN c.a AND c.b) GROUP BY ALL""")
def q_coordinates(spark, d):
    return calling.at_coordinates(obs(spark, d), coordinates(spark, d)).groupBy("chrom", "pos").agg(F.count("*").alias("n"))


@query("SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, min(p_partkey) AS start, max(p_partkey + 2) AS stop FROM part GROUP BY ALL")
def q_coordinate_ranges(spark, d):
    return coordinates(spark, d).groupBy("chrom").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))


@query(f"""{CALLS}, k AS (SELECT chrom, pos, bool_or(type = 'GERM') AS g, bool_or(type = 'SOM') AS s, bool_or(type = 'TUM_EDIT') AS e FROM mods GROUP BY ALL)
SELECT chrom, count(*) FILTER (g) AS germ, count(*) FILTER (s) AS som, CAST(0 AS BIGINT) AS norm_edit, count(*) FILTER (e) AS tum_edit FROM k GROUP BY chrom""")
def q_stats_counts(spark, d):
    return calling.run_totals(called(spark, d))


@query(f"WITH {OBS} SELECT chrom, count(DISTINCT pos) FILTER (sample = 'DNA_NORMAL') AS dn, CAST(0 AS BIGINT) AS rn, count(DISTINCT pos) FILTER (sample = 'DNA_TUMOR') AS dt, count(DISTINCT pos) FILTER (sample = 'RNA_TUMOR') AS rt FROM obs GROUP BY chrom")
def q_coordinates_with_data(spark, d):
    return calling.coordinates_with_data(obs(spark, d))


# Genotypes

RANKED = f"""{CALLS}, r AS (SELECT chrom, pos, CAST(dt AS BIGINT) AS n, CAST(dtt AS BIGINT) AS total, CAST(instr('ACTG', base) - 1 AS INT) AS i, row_number() OVER (PARTITION BY chrom, pos ORDER BY dt DESC, instr('ACTG', base)) AS k FROM state WHERE dtt > 0),
q AS (SELECT *, n >= 2 AND {hundredths_sql('n', 'total')} >= 10 AS ok FROM r)"""


def tumor_depths(spark, d) -> DataFrame:
    sites = calling.merged_counts(obs(spark, d)).where(total_of("dt") > 0)
    return sites.select("chrom", "pos", F.array(*[f"dt_{b}" for b in BASES]).alias("depths"), total_of("dt").alias("total"))


@query(f"{RANKED} SELECT a.chrom, a.pos, least(a.i, CASE WHEN b.ok THEN b.i ELSE a.i END) || '/' || greatest(a.i, CASE WHEN b.ok THEN b.i ELSE a.i END) AS gt FROM q a JOIN q b ON a.chrom = b.chrom AND a.pos = b.pos AND a.k = 1 AND b.k = 2")
def q_genotype_diploid(spark, d):
    return tumor_depths(spark, d).select("chrom", "pos", genotype.text(genotype.genotype(F.lit("1"), F.col("depths"), F.col("total"))).alias("gt"))


@query(f"{RANKED} SELECT chrom, pos, CAST(CASE WHEN ok THEN i ELSE 0 END AS VARCHAR) AS gt FROM q WHERE k = 1")
def q_genotype_y(spark, d):
    return tumor_depths(spark, d).select("chrom", "pos", genotype.text(genotype.genotype(F.lit("Y"), F.col("depths"), F.col("total"))).alias("gt"))


@query(f"{RANKED} SELECT chrom, pos, coalesce(string_agg(CAST(i AS VARCHAR), '/' ORDER BY i) FILTER (ok), '0') AS gt FROM q GROUP BY ALL")
def q_genotype_m(spark, d):
    return tumor_depths(spark, d).select("chrom", "pos", genotype.text(genotype.genotype(F.lit("MT"), F.col("depths"), F.col("total"))).alias("gt"))


@query(f"{CALLS} SELECT chrom, pos, array_to_string(list_resize(coalesce(list(CAST(dt AS BIGINT) ORDER BY instr('ACTG', base)) FILTER (dt > 0), []), 4, 0), ',') AS ad FROM state GROUP BY ALL")
def q_pad_alleles(spark, d):
    c = calling.merged_counts(obs(spark, d))
    found = F.filter(F.array(*[f"dt_{b}" for b in BASES]), lambda n: n > 0)
    return c.select("chrom", "pos", F.array_join(genotype.pad(found, F.lit(0).cast("long"), F.lit(4)), ",").alias("ad"))


# Evidence filters

#: Allele statistics of source and target in one sample, for each modification of a type.
def evidence_sql(s: str, sample: str) -> str:
    return f"""e_{s} AS (
  SELECT g.chrom, g.pos, g.type, g.src, g.tgt, coalesce(b.ad, 0) AS ad, CAST(g.{s}t AS BIGINT) AS dp, coalesce(b.mq0, 0) AS mq0, coalesce(b.max_mq, 0) AS mmq, CASE WHEN b.ad > 0 THEN (2 * b.sum_mq + b.ad) // (2 * b.ad) ELSE 0 END AS mqa,
    CASE WHEN b.ad > 0 THEN (2 * b.sum_bq + b.ad) // (2 * b.ad) ELSE 0 END AS bq, CASE WHEN b.ad > 0 THEN {hundredths_sql('b.plus', 'b.ad')} / 100.0 ELSE 0.0 END AS sb,
    coalesce(a.ad, 0) AS src_ad, CASE WHEN a.ad > 0 THEN {hundredths_sql('a.plus', 'a.ad')} / 100.0 ELSE 0.0 END AS src_sb
  FROM g LEFT JOIN stats b ON b.chrom = g.chrom AND b.pos = g.pos AND b.base = g.tgt AND b.sample = '{sample}'
  LEFT JOIN stats a ON a.chrom = g.chrom AND a.pos = g.pos AND a.base = g.src AND a.sample = '{sample}')"""


EVIDENCE = f"{CALLS}, {DEPTHS}, {evidence_sql('dn', 'DNA_NORMAL')}, {evidence_sql('dt', 'DNA_TUMOR')}, {evidence_sql('rt', 'RNA_TUMOR')}"
MQ0 = "(ad > 0 AND floor(CAST(mq0 AS DOUBLE) / CAST(ad AS DOUBLE) * 100) / 100.0 > 0.5)"
BIAS = "(ad >= 4 AND (sb > 0.99 OR sb < 1.0 - 0.99) AND NOT (src_ad >= 4 AND ((sb = 0 AND src_sb = 0) OR (sb = 1 AND src_sb = 1))))"


def error_sql(errors: str, limit: float) -> str:
    return f"({errors} >= 2 AND floor(CAST({errors} AS DOUBLE) / CAST(dp AS DOUBLE) * 100) / 100.0 > {limit})"


def evidence(spark, d, kind: str) -> DataFrame:
    r = calling.records(obs(spark, d))
    return r.select("*", F.explode("mods").alias("m")).where(F.col("m.type") == kind)


def flag_query(spark, d, test) -> DataFrame:
    e = evidence(spark, d, "SOM")
    return e.select("chrom", "pos", "m.src", "m.tgt", F.coalesce(test(F.col("m.src"), F.col("m.tgt")), F.lit(False)).alias("fails"))


@query(f"{EVIDENCE} SELECT chrom, pos, src, tgt, {MQ0} AS fails FROM e_dt WHERE type = 'SOM'")
def q_mq0(spark, d):
    return flag_query(spark, d, lambda src, tgt: support.mq0_fails("dt", tgt, support.Limits()))


@query(f"{EVIDENCE} SELECT chrom, pos, src, tgt, {BIAS} AS fails FROM e_dt WHERE type = 'SOM'")
def q_strand_bias(spark, d):
    return flag_query(spark, d, lambda src, tgt: support.strand_fails("dt", src, tgt, support.Limits()))


#: Reads of called alleles other than the source (and the target) in a sample: records hold the reference and all bases that a sample shows anew.
ERRORS = """(SELECT coalesce(CAST(sum(z.{s}) AS BIGINT), 0) FROM state z WHERE z.chrom = x.chrom AND z.pos = x.pos AND z.base <> x.src{also})"""


@query(f"{EVIDENCE}, y AS (SELECT *, {ERRORS.format(s='dt', also=' AND z.base <> x.tgt')} AS errors FROM e_dt x WHERE type = 'SOM') SELECT chrom, pos, src, tgt, {error_sql('errors', 0.01)} AS fails FROM y")
def q_max_error(spark, d):
    return flag_query(spark, d, lambda src, tgt: support.error_fails("dt", src, tgt, support.Limits(), with_target=False))


def full_sql(s: str, table: str, low_pct: int, limit: float) -> str:
    """Rows of codes that fail in the full set of one sample."""
    tests = {
        "mndp": "dp < 4", "mnad": "ad < 3", "mnaf": f"{hundredths_sql('ad', 'dp')} < {low_pct}", "mnbq": "bq < 20", "mnmqa": "mqa < 25", "mnmq": "mmq < 30", "mxmq0": MQ0, "sbias": BIAS, "mxerr": error_sql("errors", limit),
    }
    cases = ", ".join(f"CASE WHEN {t} THEN '{s}{c}' END" for c, t in tests.items())
    return f"SELECT chrom, pos, type, src, tgt, unnest([{cases}]) AS code FROM (SELECT *, {ERRORS.format(s=s, also=' AND z.base <> x.tgt')} AS errors FROM {table} x)"


def context_sql(s: str, table: str, limit: float) -> str:
    return f"SELECT chrom, pos, type, src, tgt, unnest([CASE WHEN dp < 4 THEN '{s}mndp' END, CASE WHEN dp > 0 AND {error_sql('errors', limit)} THEN '{s}mxerr' END]) AS code FROM (SELECT *, {ERRORS.format(s=s, also='')} AS errors FROM {table} x)"


def support_query(spark, d, kinds: list[str], preset: support.Preset) -> DataFrame:
    r = calling.records(obs(spark, d)).select("*", F.explode("mods").alias("m")).where(F.col("m.type").isin(kinds))
    return r.select("chrom", "pos", "m.type", "m.src", "m.tgt", F.array_join(support.rule_codes("m", preset), "_").alias("codes"))


@query(f"""{EVIDENCE}, f AS ({full_sql('dt', "(SELECT * FROM e_dt WHERE type = 'SOM')", 10, 0.10)} UNION ALL {context_sql('dn', "(SELECT * FROM e_dn WHERE type = 'SOM')", 0.10)} UNION ALL {full_sql('dn', "(SELECT * FROM e_dn WHERE type = 'GERM')", 10, 0.10)})
SELECT g.chrom, g.pos, g.type, g.src, g.tgt, coalesce(string_agg(DISTINCT code, '_' ORDER BY code), '') AS codes FROM g LEFT JOIN f ON f.chrom = g.chrom AND f.pos = g.pos AND f.type = g.type AND f.src = g.src AND f.tgt = g.tgt WHERE g.type IN ('SOM', 'GERM') GROUP BY ALL""")
def q_support_dna(spark, d):
    return support_query(spark, d, ["SOM", "GERM"], DNA_LOW)


@query(f"""{EVIDENCE}, f AS ({full_sql('rt', "(SELECT * FROM e_rt WHERE type = 'TUM_EDIT')", 10, 0.10)} UNION ALL {context_sql('dn', "(SELECT * FROM e_dn WHERE type = 'TUM_EDIT')", 0.10)} UNION ALL {context_sql('dt', "(SELECT * FROM e_dt WHERE type = 'TUM_EDIT')", 0.10)})
SELECT g.chrom, g.pos, g.type, g.src, g.tgt, coalesce(string_agg(DISTINCT code, '_' ORDER BY code), '') AS codes FROM g LEFT JOIN f ON f.chrom = g.chrom AND f.pos = g.pos AND f.type = g.type AND f.src = g.src AND f.tgt = g.tgt WHERE g.type = 'TUM_EDIT' GROUP BY ALL""")
def q_support_rna(spark, d):
    return support_query(spark, d, ["TUM_EDIT"], RNA_LOW)


@query(f"""{CALLS} SELECT chrom, pos, CASE WHEN bool_or(type = 'GERM') THEN 'GERM' WHEN bool_or(type = 'SOM') THEN 'SOM' ELSE 'TUM_EDIT' END AS final_type, CAST(CASE WHEN bool_or(type = 'GERM') THEN 1 WHEN bool_or(type = 'SOM') THEN 2 ELSE 4 END AS INT) AS ss FROM mods GROUP BY ALL""")
def q_final_mod_type(spark, d):
    out = called(spark, d).select("chrom", "pos", support.final_type(F.transform("mods", lambda m: m["type"])).alias("final_type"))
    return out.withColumn("ss", support.ss_of(F.col("final_type")))


def enough_sql(n: str, total: str, how: str = "AND", depth: int = 4, pct: int = 10) -> str:
    return f"({n} >= {depth} {how} coalesce({hundredths_sql(f'CAST({n} AS BIGINT)', f'CAST({total} AS BIGINT)')}, 0) >= {pct})"


def weak_sql(n: str, code: str, depth: int = 4, pct: int = 10) -> str:
    return f"CASE WHEN {n} < {depth} THEN 'dn{code}ad' END, CASE WHEN coalesce({hundredths_sql(f'CAST({n} AS BIGINT)', 'CAST(dnt AS BIGINT)')}, 0) < {pct} THEN 'dn{code}af' END"


#: Modifications after the pre-filter, the codes of those that none survived, and the failing rules of each.
PRE_FILTERED = f"""{CALLS}, {DEPTHS.replace('g AS', 'g0 AS')},
one AS (SELECT chrom, pos, ref, src, tgt, unnest(CASE
    WHEN type = 'GERM' THEN CASE WHEN {enough_sql('dn_tgt', 'dnt')} THEN ['GERM'] WHEN {enough_sql('dt_tgt', 'dtt', 'OR')} THEN ['SOM'] ELSE [] END
    WHEN type = 'SOM' THEN CASE WHEN dnt > 0 AND {enough_sql('dn_src', 'dnt')} THEN ['SOM'] ELSE [] END
    ELSE CASE WHEN {enough_sql('dt_tgt', 'dtt')} THEN ['TUM_EDIT', 'SOM'] ELSE ['TUM_EDIT'] END END) AS type FROM g0),
live AS (SELECT DISTINCT chrom, pos FROM one),
pre AS (SELECT chrom, pos, unnest(CASE WHEN type = 'GERM' THEN [{weak_sql('dn_tgt', 'mn')}] WHEN type = 'SOM' AND dnt = 0 THEN ['dnmndp'] WHEN type = 'SOM' THEN [{weak_sql('dn_src', 'mnref')}] ELSE [] END) AS code FROM g0 ANTI JOIN live USING (chrom, pos)),
mods2 AS (SELECT DISTINCT chrom, pos, ref, type, src, tgt FROM one UNION ALL SELECT chrom, pos, ref, type, src, tgt FROM mods ANTI JOIN live USING (chrom, pos)),
{DEPTHS.replace('FROM mods m', 'FROM mods2 m')}, {evidence_sql('dn', 'DNA_NORMAL')}, {evidence_sql('dt', 'DNA_TUMOR')}"""


@query(f"""{PRE_FILTERED}, f AS ({full_sql('dt', "(SELECT * FROM e_dt WHERE type = 'SOM')", 10, 0.10)} UNION ALL {full_sql('dn', "(SELECT * FROM e_dn WHERE type = 'GERM')", 10, 0.10)}
  UNION ALL {context_sql('dn', "(SELECT * FROM e_dn WHERE type IN ('SOM', 'TUM_EDIT'))", 0.10)} UNION ALL {context_sql('dt', "(SELECT * FROM e_dt WHERE type = 'TUM_EDIT')", 0.10)}
  UNION ALL SELECT chrom, pos, type, src, tgt, 'rnacall' FROM g WHERE type = 'TUM_EDIT'),
c AS (SELECT chrom, pos, code FROM f WHERE code IS NOT NULL UNION SELECT chrom, pos, code FROM pre WHERE code IS NOT NULL),
every AS (SELECT chrom, pos, string_agg(code, ';' ORDER BY code) AS codes FROM c GROUP BY ALL),
m AS (SELECT g.*, pre.chrom IS NULL AND f.chrom IS NULL AS alive FROM g LEFT JOIN (SELECT DISTINCT chrom, pos FROM pre WHERE code IS NOT NULL) pre ON pre.chrom = g.chrom AND pre.pos = g.pos
  LEFT JOIN (SELECT DISTINCT chrom, pos, type, src, tgt FROM f WHERE code IS NOT NULL) f ON f.chrom = g.chrom AND f.pos = g.pos AND f.type = g.type AND f.src = g.src AND f.tgt = g.tgt),
k AS (SELECT *, bool_or(alive) OVER (PARTITION BY chrom, pos) AS ok FROM m),
o AS (SELECT chrom, pos, ok, CASE WHEN bool_or(type = 'GERM') THEN 'GERM' WHEN bool_or(type = 'SOM') THEN 'SOM' ELSE 'TUM_EDIT' END AS final_type, string_agg(type || ':' || src || '>' || tgt, ',' ORDER BY type || ':' || src || '>' || tgt) AS mods FROM k WHERE alive OR NOT ok GROUP BY ALL)
SELECT o.chrom, o.pos, final_type, CAST(CASE final_type WHEN 'GERM' THEN 1 WHEN 'SOM' THEN 2 ELSE 4 END AS INT) AS ss, final_type = 'SOM' AS somatic, CASE WHEN ok THEN 'PASS' ELSE codes END AS filter, 'DNA' AS origin, mods
FROM o LEFT JOIN every ON every.chrom = o.chrom AND every.pos = o.pos""")
def q_filter_by_support(spark, d):
    """Pre-filter, rules and final type together, with the DNA preset at lower minimums; modifications in order of their text."""
    r = support.judge(calling.records(obs(spark, d)), DNA_LOW)
    mods = F.array_sort(F.transform("mods", lambda m: F.concat(m["type"], F.lit(":"), m["src"], F.lit(">"), m["tgt"])))
    return r.select("chrom", "pos", "final_type", "ss", "somatic", F.array_join("filter", ";").alias("filter"), F.array_join("origin", ",").alias("origin"), F.array_join(mods, ",").alias("mods"))


def judged_sql(x: str, mods: str, rna: bool) -> str:
    """Tables out_x (modifications after judging those of ``mods``) and sum_x (ok, codes) with the DNA or the RNA preset at lower minimums; their helpers end in x, too."""
    depth, pct = (1, 1) if rna else (4, 10)
    low = {"dn": 0, "dt": 1, "rt": 10} if rna else {"dn": 10, "dt": 10, "rt": 10}
    of = lambda s, t: f"(SELECT * FROM e_{s}_{x} WHERE {t})"
    full = lambda s, t: full_sql(s, of(s, t), low[s], 0.10)
    context = lambda s, t: context_sql(s, of(s, t), 0.10)
    named = lambda code, t: f"SELECT chrom, pos, type, src, tgt, '{code}' FROM g_{x} WHERE {t}"
    germ, som, edit = "type = 'GERM'", "type = 'SOM'", "type = 'TUM_EDIT'"
    rules = [full("dn", germ), full("dt", som), context("dn", som), context("dn", edit), context("dt", edit)]
    rules += [named("dnacall", germ), full("rt", f"{som} AND dp > 0"), named("rtmndp", f"{som} AND rtt = 0"), full("rt", edit)] if rna else [named("rnacall", edit)]
    evidence = lambda s, sample: re.sub(r"\bg\b", f"g_{x}", evidence_sql(s, sample)).replace(f"e_{s} AS", f"e_{s}_{x} AS")
    depths = lambda name, m: DEPTHS.replace("g AS", f"{name} AS").replace("FROM mods m", f"FROM {m} m")
    enough = lambda n, total, how="AND": enough_sql(n, total, how, depth, pct)
    return f"""{depths(f'g0_{x}', mods)},
one_{x} AS (SELECT chrom, pos, ref, src, tgt, unnest(CASE
    WHEN type = 'GERM' THEN CASE WHEN {enough('dn_tgt', 'dnt')} THEN ['GERM'] WHEN {enough('dt_tgt', 'dtt', 'OR')} THEN ['SOM'] ELSE [] END
    WHEN type = 'SOM' THEN CASE WHEN dnt > 0 AND {enough('dn_src', 'dnt')} THEN ['SOM'] ELSE [] END
    ELSE CASE WHEN {enough('dt_tgt', 'dtt')} THEN ['TUM_EDIT', 'SOM'] ELSE ['TUM_EDIT'] END END) AS type FROM g0_{x}),
live_{x} AS (SELECT DISTINCT chrom, pos FROM one_{x}),
pre_{x} AS (SELECT chrom, pos, unnest(CASE WHEN type = 'GERM' THEN [{weak_sql('dn_tgt', 'mn', depth, pct)}] WHEN type = 'SOM' AND dnt = 0 THEN ['dnmndp'] WHEN type = 'SOM' THEN [{weak_sql('dn_src', 'mnref', depth, pct)}] ELSE [] END) AS code FROM g0_{x} ANTI JOIN live_{x} USING (chrom, pos)),
mods_{x} AS (SELECT DISTINCT chrom, pos, ref, type, src, tgt FROM one_{x} UNION ALL SELECT chrom, pos, ref, type, src, tgt FROM {mods} ANTI JOIN live_{x} USING (chrom, pos)),
{depths(f'g_{x}', f'mods_{x}')}, {evidence('dn', 'DNA_NORMAL')}, {evidence('dt', 'DNA_TUMOR')}, {evidence('rt', 'RNA_TUMOR')},
f_{x} AS ({' UNION ALL '.join(rules)}),
c_{x} AS (SELECT chrom, pos, code FROM f_{x} WHERE code IS NOT NULL UNION SELECT chrom, pos, code FROM pre_{x} WHERE code IS NOT NULL),
k_{x} AS (SELECT m.*, p.chrom IS NULL AND b.chrom IS NULL AS alive FROM mods_{x} m LEFT JOIN (SELECT DISTINCT chrom, pos FROM pre_{x} WHERE code IS NOT NULL) p ON p.chrom = m.chrom AND p.pos = m.pos
  LEFT JOIN (SELECT DISTINCT chrom, pos, type, src, tgt FROM f_{x} WHERE code IS NOT NULL) b ON b.chrom = m.chrom AND b.pos = m.pos AND b.type = m.type AND b.src = m.src AND b.tgt = m.tgt),
out_{x} AS (SELECT chrom, pos, ref, type, src, tgt, ok FROM (SELECT *, bool_or(alive) OVER (PARTITION BY chrom, pos) AS ok FROM k_{x}) WHERE alive OR NOT ok),
sum_{x} AS (SELECT chrom, pos, bool_or(ok) AS ok, bool_or(type = 'GERM') AS germ, bool_or(type = 'SOM') AS som FROM out_{x} GROUP BY ALL)"""


@query(f"""{CALLS}, {judged_sql('d', 'mods', False)}, {judged_sql('r', 'mods', True)},
open AS (SELECT r.chrom, r.pos, r.ref, r.type, r.src, r.tgt FROM out_r r JOIN sum_d d ON d.chrom = r.chrom AND d.pos = r.pos WHERE r.ok AND NOT d.ok), {judged_sql('n', 'open', False)},
w AS (SELECT d.chrom, d.pos, d.ok AS dok, r.ok AS rok, d.ok AND r.ok AND d.som AND r.som AS together,
  coalesce(NOT n.germ AND NOT (NOT n.ok AND EXISTS (SELECT 1 FROM c_n WHERE c_n.chrom = d.chrom AND c_n.pos = d.pos AND starts_with(c_n.code, 'dnm'))), false) AS rescued
  FROM sum_d d JOIN sum_r r ON r.chrom = d.chrom AND r.pos = d.pos LEFT JOIN sum_n n ON n.chrom = d.chrom AND n.pos = d.pos),
codes AS (SELECT w.chrom, w.pos, c.code FROM w JOIN c_d c ON c.chrom = w.chrom AND c.pos = w.pos WHERE NOT dok AND NOT rescued UNION SELECT w.chrom, w.pos, c.code FROM w JOIN c_r c ON c.chrom = w.chrom AND c.pos = w.pos WHERE NOT dok AND NOT rok),
stands AS (SELECT w.*, o.type, o.src, o.tgt FROM w JOIN out_d o ON o.chrom = w.chrom AND o.pos = w.pos WHERE NOT rescued UNION ALL SELECT w.*, o.type, o.src, o.tgt FROM w JOIN out_r o ON o.chrom = w.chrom AND o.pos = w.pos WHERE rescued)
SELECT chrom, pos, CASE WHEN bool_or(dok OR rescued) THEN 'PASS' ELSE (SELECT string_agg(code, ';' ORDER BY code) FROM codes WHERE codes.chrom = s.chrom AND codes.pos = s.pos) END AS filter,
  CASE WHEN bool_or(rescued) THEN 'RNA' WHEN bool_or(together OR (NOT dok AND NOT rok)) THEN 'DNA,RNA' ELSE 'DNA' END AS origin, string_agg(DISTINCT type, ',' ORDER BY type) AS types,
  CAST(CASE WHEN bool_or(type = 'GERM') THEN 1 WHEN bool_or(type = 'SOM') THEN 2 ELSE 4 END AS INT) AS ss, string_agg(type || ':' || src || '>' || tgt, ',' ORDER BY type || ':' || src || '>' || tgt) AS mods
FROM stands s GROUP BY chrom, pos""")
def q_filter_plan(spark, d):
    """The whole plan without databases: both branches, what only RNA passes judged again, and the call that stands with the modifications and the status of its branch."""
    r = calling.records(obs(spark, d)).withColumns({"id": F.array().cast("array<string>"), "info": F.expr("map('VT', array('SNP'))")})
    out = FilterPlan(dna=DNA_LOW, rna=RNA_LOW).run(r)
    text = lambda c, sep: F.array_join(F.sort_array(c), sep)
    mods = F.transform("mods", lambda m: F.concat(m["type"], F.lit(":"), m["src"], F.lit(">"), m["tgt"]))
    return out.select("chrom", "pos", text(F.col("filter"), ";").alias("filter"), text(F.col("origin"), ",").alias("origin"), text(F.col("types"), ",").alias("types"), "ss", text(mods, ",").alias("mods"))


@query(f"""{CALLS}, {DEPTHS}, h AS (SELECT chrom, pos, type, src, tgt, dt_tgt >= 4 AND {hundredths_sql('CAST(dt_tgt AS BIGINT)', 'CAST(dtt AS BIGINT)')} >= 10 AS ok FROM g WHERE type = 'TUM_EDIT')
SELECT chrom, pos, src, tgt, CASE WHEN ok THEN 'TUM_EDIT,SOM' ELSE 'TUM_EDIT' END AS types FROM h""")
def q_pre_filter(spark, d):
    r = calling.records(obs(spark, d)).select("*", F.explode("mods").alias("m")).where(F.col("m.type") == "TUM_EDIT").withColumn("mods", F.array("m"))
    return support.pre_filter(r, support.DNA).select("chrom", "pos", "m.src", "m.tgt", F.array_join(F.transform("mods", lambda m: m["type"]), ",").alias("types"))


# Intervals


def bed(spark, d) -> DataFrame:
    return read(spark, d, "part").select((F.col("p_size") % 25).cast("string").alias("chrom"), (F.col("p_partkey") - F.col("p_partkey") % 3).alias("start"), (F.col("p_partkey") - F.col("p_partkey") % 3 + 1 + F.col("p_size") * 40).alias("end"), F.col("p_brand").alias("name"))


BED = "bed AS (SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey - p_partkey % 3 AS a, p_partkey - p_partkey % 3 + 1 + p_size * 40 AS b, p_brand AS name FROM part)"
SOM_SITES = "som AS (SELECT DISTINCT chrom, pos FROM mods WHERE type = 'SOM')"


def som_sites(spark, d) -> DataFrame:
    c = called(spark, d).where("somatic")
    return c.select("chrom", "pos", F.array().cast("array<string>").alias("id"), F.array(F.lit("PASS")).alias("filter"), F.map_from_arrays(F.array(F.lit("SS")), F.array(F.array(F.lit("2")))).alias("info"))


HITS = f"{CALLS}, {BED}, {SOM_SITES}, hits AS (SELECT som.chrom, som.pos, bed.name, bed.a, bed.b FROM som LEFT JOIN bed ON bed.chrom = som.chrom AND som.pos - 1 >= bed.a AND som.pos - 1 < bed.b)"


@query(f"{HITS} SELECT chrom, pos, CASE WHEN count(name) > 0 THEN 'DB;SS=2' ELSE 'SS=2' END AS info, coalesce(arg_min(name, (a, b, name)), '.') AS id FROM hits GROUP BY ALL")
def q_interval_flag(spark, d):
    out = intervals.tag(som_sites(spark, d), bed(spark, d), "DB", to="id")
    return out.select("chrom", "pos", strings.format_info(F.col("info")).alias("info"), F.when(F.size("id") > 0, F.array_join("id", ";")).otherwise(".").alias("id"))


@query(f"{HITS} SELECT chrom, pos, CASE WHEN count(name) > 0 THEN 'PASS' ELSE 'blck' END AS filter FROM hits GROUP BY ALL")
def q_interval_antifilter(spark, d):
    return intervals.tag(som_sites(spark, d), bed(spark, d), "blck", inside=False).select("chrom", "pos", F.array_join("filter", ";").alias("filter"))


@query(f"{HITS} SELECT chrom, pos, count(name) AS n_hits FROM hits GROUP BY ALL")
def q_interval_count(spark, d):
    return intervals.annotate(som_sites(spark, d), bed(spark, d)).select("chrom", "pos", "n_hits")


@query(f"{HITS} SELECT chrom, pos, CASE WHEN count(name) > 0 THEN 'RADAR=' || arg_min(name, (a, b, name)) || ';SS=2' ELSE 'SS=2' END AS info FROM hits GROUP BY ALL")
def q_interval_name(spark, d):
    return intervals.tag(som_sites(spark, d), bed(spark, d), "RADAR", to="info", value="name").select("chrom", "pos", strings.format_info(F.col("info")).alias("info"))


@query(f"""WITH {BED}, o AS (SELECT CAST(o_orderkey % 25 AS VARCHAR) AS chrom, o_orderkey AS a, o_orderkey + 3 AS b FROM orders)
SELECT DISTINCT chrom, a AS start, b AS "end", name FROM bed WHERE EXISTS (SELECT 1 FROM o WHERE o.chrom = bed.chrom AND bed.a < o.b + 10 AND bed.b > o.a - 10)""")
def q_interval_intersect(spark, d):
    o = read(spark, d, "orders").select((F.col("o_orderkey") % 25).cast("string").alias("chrom"), F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 3).alias("end"))
    return intervals.intersect(bed(spark, d), o, buffer=10)


@query(f"WITH {BED} SELECT count(*) AS n_intervals FROM (SELECT DISTINCT * FROM bed)")
def q_interval_length(spark, d):
    return intervals.length(bed(spark, d))


# Reads


@query(f"""WITH {OBS}, o AS (SELECT *, mq > 24 AS overlapping FROM obs WHERE sample = 'DNA_TUMOR'), w AS (
  SELECT *, count(*) OVER (PARTITION BY chrom, read_name) AS n, count(*) OVER v AS m, min(base) OVER v AS lo, max(base) OVER v AS hi, row_number() OVER (v ORDER BY bq DESC, base, line, mq, overlapping, plus, pos, ref, sample) AS k, max(bq) OVER v AS best
  FROM o WINDOW v AS (PARTITION BY chrom, read_name, overlapping)
), x AS (SELECT *, max(CASE WHEN k > 1 THEN bq END) OVER (PARTITION BY chrom, read_name, overlapping) AS next FROM w)
SELECT chrom, read_name, base, bq, mq, overlapping FROM x WHERE n = 1 OR NOT overlapping OR m = 1 OR (k = 1 AND (lo = hi OR (best >= 20 AND next < 20)))""")
def q_mate_overlap(spark, d):
    o = obs(spark, d).where("sample = 'DNA_TUMOR'").withColumn("overlapping", F.col("mq") > 24)
    return reads.resolve_mates(o, ["chrom"], min_bq=20, order=["base", "line", "mq", "overlapping", "plus", "pos", "ref", "sample"]).select("chrom", "read_name", "base", "bq", "mq", "overlapping")


def tumor_reads(spark, d) -> DataFrame:
    o = obs(spark, d).where("sample = 'DNA_TUMOR'")
    return o.withColumns({"mutated": F.col("base") != F.col("ref"), "perfect": F.col("bq") >= 20, "secondary": F.col("mq") == 0, "place": reads.third(F.col("bq"), F.lit(50))})


READS = f"WITH {OBS}, r AS (SELECT *, base <> ref AS mutated, bq >= 20 AS perfect, mq = 0 AS secondary, CASE WHEN bq / 50.0 <= 0.33 THEN 'start' WHEN bq / 50.0 <= 0.66 THEN 'middle' ELSE 'end' END AS place FROM obs WHERE sample = 'DNA_TUMOR')"
COUNTS = """s AS (SELECT chrom, pos, count(*) FILTER (mutated) AS n_mut, count(*) FILTER (NOT mutated) AS n_ref, count(*) FILTER (mutated AND perfect) AS n_perfect, count(*) FILTER (mutated AND place = 'start') AS n_start, count(*) FILTER (mutated AND place = 'middle') AS n_middle,
  count(*) FILTER (mutated AND place = 'end') AS n_end, count(*) FILTER (mutated AND perfect AND place = 'start') AS p_start, count(*) FILTER (mutated AND perfect AND place = 'end') AS p_end, count(*) FILTER (mutated AND perfect AND plus) AS p_plus, count(*) FILTER (mutated AND secondary) AS n_multi FROM r GROUP BY ALL)"""


@query(f"{READS}, {COUNTS} SELECT chrom, pos, n_mut, n_start, n_middle, n_end FROM s")
def q_position_bias(spark, d):
    return reads.support(tumor_reads(spark, d), ["chrom", "pos"]).select("chrom", "pos", "n_mut", "n_start", "n_middle", "n_end")


@query(f"{READS}, {COUNTS} SELECT chrom, pos, n_ref, n_perfect, p_start, p_end, p_plus, n_multi FROM s")
def q_perfect_counts(spark, d):
    return reads.support(tumor_reads(spark, d), ["chrom", "pos"]).select("chrom", "pos", "n_ref", "n_perfect", "p_start", "p_end", "p_plus", "n_multi")


JUDGED = f"""c AS (SELECT *, CASE WHEN n_mut > 0 THEN {hundredths_sql('n_multi', 'n_mut')} / 100.0 ELSE 0.0 END AS mmp FROM s)
SELECT chrom, pos, mmp, array_to_string(list_sort(list_filter([
  CASE WHEN n_mut >= 4 AND mmp >= 0.9 THEN 'mxmmp' END, CASE WHEN n_perfect >= 4 AND (p_plus / n_perfect > 0.9 OR p_plus / n_perfect < 1 - CAST(0.9 AS DOUBLE)) THEN 'perfsbias' END,
  CASE WHEN n_mut >= 4 AND (n_start / n_mut >= 0.95 OR n_end / n_mut >= 0.95) THEN 'pbias' END, CASE WHEN n_perfect >= 4 AND (p_start / n_perfect >= 0.95 OR p_end / n_perfect >= 0.95) THEN 'perfpbias' END,
  CASE WHEN n_perfect < 4 THEN 'perfmnad' END, CASE WHEN n_perfect / (n_mut + n_ref) < 0.1 THEN 'perfmnaf' END], lambda x: x IS NOT NULL)), '_') AS codes FROM c"""


@query(f"{READS}, {COUNTS}, {JUDGED}")
def q_read_support_codes(spark, d):
    out = reads.support_codes(reads.support(tumor_reads(spark, d), ["chrom", "pos"]))
    return out.select("chrom", "pos", "mmp", F.array_join("codes", "_").alias("codes"))


@query("""WITH c AS (SELECT doc_id, coalesce(text, '') AS s, doc_id % 40 AS q FROM documents)
SELECT doc_id, len(list_filter(range(greatest(q - 5, 0), least(q + 5, length(s) - 1) + 1), lambda k: ascii(substr(s, CAST(k + 1 AS INT), 1)) - 33 < 10)) > 0 AS low FROM c WHERE length(s) > q""")
def q_neighbour_quality(spark, d):
    c = read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("s"), (F.col("doc_id") % 40).cast("int").alias("q")).where("length(s) > q")
    return c.select("doc_id", reads.low_neighbours(F.col("s"), F.col("q")).alias("low"))


@query("""SELECT l_orderkey AS k, l_linenumber AS n, CASE WHEN l_linenumber % 2 = 0 AND l_orderkey % 4 < 2 THEN 'improperpair' WHEN l_linenumber = 3 THEN 'insertion' WHEN l_linenumber = 5 THEN 'deletion' WHEN l_discount < 0.02 THEN 'neighborbq' WHEN l_quantity >= 46 THEN 'maxmuts' WHEN l_orderkey % 20 >= 10 THEN 'maxsoftclip' END AS reason FROM lineitem""")
def q_perfect_reads(spark, d):
    n = F.col("l_linenumber")
    op = F.when(n == 3, 1).when(n == 5, 2).otherwise(0)
    piece = lambda o, k: F.struct(o.cast("int").alias("op"), k.cast("int").alias("len"))
    clip = F.col("l_orderkey") % 20
    cigar = F.array(piece(F.lit(4), clip), piece(F.lit(0), 99 - clip), piece(op, F.lit(1)))
    flags = F.when(F.col("l_orderkey") % 4 < 2, 1).otherwise(3)
    reason = reads.perfect_reason(n % 2 == 0, flags, cigar, F.col("l_discount") < 0.02, (F.col("l_quantity") - 42).cast("int"), length=F.lit(100))
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), n.alias("n"), reason.alias("reason"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 90 < 40 THEN o_orderkey % 90 WHEN o_orderkey % 90 < 45 THEN NULL ELSE o_orderkey % 90 - 5 END AS qpos FROM orders")
def q_cigar_walk(spark, d):
    piece = lambda o, k: F.struct(F.lit(o).alias("op"), F.lit(k).alias("len"))
    at = reads.position_in_read(F.array(piece(0, 40), piece(2, 5), piece(0, 60)), (F.col("o_orderkey") % 90).cast("int"))
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), at["qpos"].cast("long").alias("qpos"))


@query("""SELECT p_size % 25 AS chrom, p_partkey AS pos, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS base, lag_b.base AS pn, lead_b.base AS nn FROM part p
LEFT JOIN (SELECT p_size % 25 AS c, p_partkey + 1 AS k, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS base FROM part) lag_b ON lag_b.c = p.p_size % 25 AND lag_b.k = p.p_partkey
LEFT JOIN (SELECT p_size % 25 AS c, p_partkey - 1 AS k, substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS base FROM part) lead_b ON lead_b.c = p.p_size % 25 AND lead_b.k = p.p_partkey""")
def q_neighbour_bases(spark, d):
    return reads.neighbour_bases(read(spark, d, "part").select((F.col("p_size") % 25).alias("chrom"), F.col("p_partkey").alias("pos"), letter(F.col("p_partkey")).alias("base")))


# Scores

@query(f"""{CALLS}, {DEPTHS}, f AS (SELECT chrom, pos, src, tgt, CAST(dn_src AS BIGINT) AS a, CAST(dn_tgt AS BIGINT) AS b, CAST(dt_src + rt_src AS BIGINT) AS c, CAST(dt_tgt + rt_tgt AS BIGINT) AS d FROM g WHERE type = 'SOM'),
lf AS (SELECT k, sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (ORDER BY k) AS v FROM range(0, 2000) r(k)),
tl AS (SELECT f.*, unnest(range(0, least(b, c) + 1)) AS s, true AS up FROM f UNION ALL SELECT f.*, unnest(range(0, least(a, d) + 1)) AS s, false AS up FROM f),
cell AS (SELECT chrom, pos, src, tgt, up, CASE WHEN up THEN a + s ELSE a - s END AS a, CASE WHEN up THEN b - s ELSE b + s END AS b, CASE WHEN up THEN c - s ELSE c + s END AS c, CASE WHEN up THEN d + s ELSE d - s END AS d FROM tl),
term AS (SELECT chrom, pos, src, tgt, up, exp(l1.v + l2.v + l3.v + l4.v - l5.v - l6.v - l7.v - l8.v - l9.v) AS p FROM cell
  JOIN lf l1 ON l1.k = a + b JOIN lf l2 ON l2.k = c + d JOIN lf l3 ON l3.k = a + c JOIN lf l4 ON l4.k = b + d JOIN lf l5 ON l5.k = a + b + c + d JOIN lf l6 ON l6.k = a JOIN lf l7 ON l7.k = b JOIN lf l8 ON l8.k = c JOIN lf l9 ON l9.k = d),
s AS (SELECT chrom, pos, src, tgt, sum(p) FILTER (up) AS r, sum(p) FILTER (NOT up) AS l FROM term GROUP BY ALL), v AS (SELECT *, CASE WHEN r >= 0.999 THEN l ELSE r END AS p FROM s)
SELECT chrom, pos, src, tgt, CAST(least(255, greatest(0, floor(-10 * log10(least(p, 1.0)) + 0.5))) AS BIGINT) AS qual FROM v""")
def q_fisher_score(spark, d):
    m = mods_of(spark, d, "SOM")
    depth = {f"{s}_{n}": (depth_of(s, F.col(c)) if s != "rn" else F.lit(0)).cast("long") for s in ("dn", "rn", "dt", "rt") for n, c in (("ref", "src"), ("alt", "tgt"))}
    return score.score(m.withColumns(depth | {"final_type": F.col("type"), "passes": F.lit(True)})).select("chrom", "pos", "src", "tgt", "qual")


# Realignment, genes


@query("""WITH h AS (SELECT l_orderkey AS read, l_linestatus = 'F' AS here, l_tax > 0.01 AS usable, CAST(l_quantity AS INT) AS len, l_discount AS e, l_extendedprice AS i FROM lineitem), b AS (
  SELECT read, min(e) FILTER (usable AND len > 10 AND here) AS eh, min(e) FILTER (usable AND len > 10 AND NOT here) AS et, max(i) FILTER (usable AND len > 10 AND here) AS ih, max(i) FILTER (usable AND len > 10 AND NOT here) AS it FROM h GROUP BY read)
SELECT read, eh IS NOT NULL AND (et IS NULL OR eh < et OR ih > coalesce(it, 0.0)) AS valid FROM b""")
def q_blat_valid(spark, d):
    return realign.valid_reads_blast(hits(spark, d), ["read"]).select("read", F.coalesce("valid", F.lit(False)).alias("valid"))


def hits(spark, d) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), (F.col("l_linestatus") == "F").alias("overlapping"), (F.col("l_tax") > 0.01).alias("usable"), F.col("l_quantity").cast("int").alias("length"), F.lit(20).alias("read_length"), F.col("l_discount").alias("evalue"), F.col("l_extendedprice").alias("identity"))


PSL_SQL = """WITH h AS (SELECT l_orderkey AS read, l_suppkey AS call, l_linestatus = 'F' AS here, l_tax > 0.01 AS usable, CAST(l_quantity AS BIGINT) + l_linenumber - 2 AS score FROM lineitem),
b AS (SELECT call, read, max(score) FILTER (usable AND here) AS sh, max(score) FILTER (usable AND NOT here) AS st FROM h GROUP BY ALL), v AS (SELECT call, read, sh IS NOT NULL AND NOT coalesce(st > sh, false) AS valid FROM b)"""


def psl_reads(spark, d) -> DataFrame:
    h = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("call"), (F.col("l_linestatus") == "F").alias("overlapping"), (F.col("l_tax") > 0.01).alias("usable"),
        strings.psl_score(F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long"), F.lit(1), F.lit(1), F.lit(0)).alias("score"))
    return realign.valid_reads_psl(h, ["call", "read"])


@query(f"{PSL_SQL} SELECT call, read, valid FROM v")
def q_psl_valid(spark, d):
    return psl_reads(spark, d).select("call", "read", "valid")


@query(f"{PSL_SQL} SELECT call, count(*) AS n_reads, count(*) FILTER (valid) AS n_valid, count(*) FILTER (valid) >= 4 AND {hundredths_sql('count(*) FILTER (valid)', 'count(*)')} >= 10 AS passes FROM v GROUP BY call")
def q_blat_calls(spark, d):
    return realign.judge_calls(psl_reads(spark, d), ["call"])


@query("""SELECT o_orderkey AS k, (o_orderkey % 25 = o_custkey % 25) AND least(o_custkey, o_orderkey) <= o_custkey + 1 - 1 AND greatest(o_custkey, o_orderkey) >= o_custkey + 1 - 1 AS here FROM orders""")
def q_blat_overlap(spark, d):
    chrom = lambda c: (F.col(c) % 25).cast("string")
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), realign.overlaps_call(F.concat(F.lit("chr"), chrom("o_orderkey")), F.col("o_orderkey"), F.col("o_custkey"), chrom("o_custkey"), F.col("o_custkey") + 1).alias("here"))


HIT_CALLS = "SELECT p_partkey AS p, CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey % 2 = 0 AS edited, p_partkey % 3 = 0 AS tx FROM part"


def hit_calls(spark, d) -> DataFrame:
    """Somatic calls, every second one an edit too; every third one has a transcript locus."""
    p = F.col("p_partkey")
    mod = lambda t: F.struct(F.lit(t).alias("type"), letter(p).alias("src"), letter(p + 1).alias("tgt"))
    mods = F.when(p % 2 == 0, F.array(mod("SOM"), mod("TUM_EDIT"))).otherwise(F.array(mod("SOM")))
    on_tx = lambda c: F.when(p % 3 == 0, F.array(c))
    return read(spark, d, "part").select((F.col("p_size") % 25).cast("string").alias("chrom"), p.alias("pos"), F.array(F.when(p % 11 == 0, "blck").otherwise("PASS")).alias("filter"), mods.alias("mods"), on_tx(F.concat(F.lit("T"), p.cast("string"))).alias("tx_names"), on_tx(F.lit(10).cast("long")).alias("tx_coords"))


def read_hits(spark, d) -> DataFrame:
    """Hits of one read for each order and part: some at the call in either direction, some on its transcript, some elsewhere."""
    line = read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_quantity", "l_discount", "l_tax")
    j = line.join(read(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).cast("string").alias("chrom")), F.col("l_partkey") == F.col("p_partkey"))
    p, n = F.col("l_partkey"), F.col("l_linenumber")
    on_tx = (p % 3 == 0) & (F.col("l_tax") > 0.02)
    at = F.when(on_tx, 10).otherwise(p) - 1
    ends = (F.when(n % 2 == 0, at - n).otherwise(at + n), F.when(n % 2 == 0, at + n).otherwise(at - n))
    subject = F.when(F.col("l_linestatus") == "F", F.when(on_tx, F.concat(F.lit("T"), p.cast("string"))).when(n % 3 == 0, F.concat(F.lit("chr"), "chrom")).otherwise(F.col("chrom"))).otherwise("other")
    flags = F.lit(1) + F.when(F.col("l_discount") > 0.02, 2).otherwise(0) + F.when(F.col("l_suppkey") % 5 == 0, 256).otherwise(0)
    return j.select(
        F.when(F.col("l_suppkey") % 2 == 0, "dnaTumor").otherwise("rnaTumor").alias("sample"), "chrom", p.alias("pos"), (F.col("l_orderkey") % 5 + F.col("l_suppkey") % 4).cast("string").alias("read_name"), flags.alias("flag"), subject.alias("subject"),
        ends[0].alias("s_start"), ends[1].alias("s_end"), F.col("l_quantity").cast("long").alias("score"),
    )


@query(f"""WITH c AS ({HIT_CALLS}), k AS (SELECT *, unnest(CASE WHEN edited THEN ['SOM', 'TUM_EDIT'] ELSE ['SOM'] END) AS type FROM c WHERE p % 11 <> 0),
h AS (SELECT k.p, k.type, l_orderkey % 5 + l_suppkey % 4 AS name, CAST(l_quantity AS BIGINT) AS score, l_linestatus = 'F' AND (NOT tx OR l_tax > 0.02) AS here, CASE WHEN type = 'SOM' THEN l_discount > 0.02 ELSE true END AND l_suppkey % 5 <> 0 AS usable
  FROM k JOIN lineitem ON l_partkey = k.p AND (l_suppkey % 2 = 0) = (type = 'SOM')),
v AS (SELECT p, type, name, max(score) FILTER (usable AND here) AS a, max(score) FILTER (usable AND NOT here) AS b FROM h GROUP BY ALL),
j AS (SELECT p, type, count(*) AS n, count(*) FILTER (a IS NOT NULL AND NOT coalesce(b > a, false)) AS good FROM v GROUP BY ALL),
t AS (SELECT k.p, k.chrom, k.type, coalesce(good >= 3 AND {hundredths_sql('good', 'n')} >= 40, false) AS ok FROM k LEFT JOIN j ON j.p = k.p AND j.type = k.type),
o AS (SELECT *, bool_or(ok) OVER (PARTITION BY p) AS passed FROM t)
SELECT chrom, p AS pos, CASE WHEN passed THEN 'PASS' ELSE 'blat' END AS filter, string_agg(type, ',' ORDER BY type) AS types FROM o WHERE ok OR NOT passed GROUP BY ALL""")
def q_hits_to_calls(spark, d):
    """Hits by sample, place and read to filters and modifications of calls, some on transcripts."""
    out = realign.filter_by_hits(hit_calls(spark, d), read_hits(spark, d), ["dnaTumor", "rnaTumor"], min_reads=3, min_share=0.40)
    return out.select("chrom", "pos", F.array_join("filter", ";").alias("filter"), F.array_join(F.array_sort(F.transform("mods", lambda m: m["type"])), ",").alias("types"))


LISTED = " OR ".join(f"contains(p_name, '{g}')" for g in GENES)


@query(f"""SELECT CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey AS pos, CASE WHEN p_partkey % 3 <> 0 AND ({LISTED} OR p_brand = 'Brand#13') THEN 'rgene' ELSE 'PASS' END AS filter FROM part""")
def q_gene_blacklist(spark, d):
    p = read(spark, d, "part")
    effect = F.concat(F.when(F.col("p_partkey") % 3 == 0, "UPSTREAM").otherwise("EXON"), F.lit("(a|b|c|d|1|"), "p_name", F.lit("|"), "p_brand", F.lit("|x|y)"))
    calls = p.select((F.col("p_size") % 25).cast("string").alias("chrom"), F.col("p_partkey").alias("pos"), F.array(F.lit("PASS")).alias("filter"), F.array(effect).alias("eff"))
    entries = lambda v: spark.createDataFrame([(x,) for x in v], "entry string")
    return genes.blacklist(calls, entries(GENES), entries(["Brand#13"])).select("chrom", "pos", F.array_join("filter", ";").alias("filter"))


# Comparison and merging


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Calls with a somatic or germline type, and calls with an edit; every third position fails."""
    base = calling.calls(obs(spark, d)).select("chrom", "pos", F.array_sort(F.array_distinct(F.transform("mods", lambda m: m["type"]))).alias("types"), F.array(F.when(F.col("pos") % 3 == 0, "dtmnad").otherwise("PASS")).alias("filter"))
    return base.where(F.arrays_overlap("types", F.array(F.lit("SOM"), F.lit("GERM")))), base.where(F.array_contains("types", "TUM_EDIT")).withColumn("filter", F.array(F.when(F.col("pos") % 5 == 0, "rtmnad").otherwise("PASS")))


SIDES = f"""{CALLS}, k AS (SELECT chrom, pos, bool_or(type = 'GERM') AS germ, bool_or(type = 'SOM') AS som, bool_or(type = 'TUM_EDIT') AS edit FROM mods GROUP BY ALL),
l AS (SELECT *, pos % 3 <> 0 AS ok FROM k WHERE som OR germ), r AS (SELECT *, pos % 5 <> 0 AS ok FROM k WHERE edit)"""


@query(f"""{SIDES}, j AS (SELECT coalesce(l.som, false) AS ls, coalesce(l.ok, false) AS lo, coalesce(r.edit, false) AS re, coalesce(r.som, false) AS rs, coalesce(r.ok, false) AS ro FROM l FULL JOIN r ON l.chrom = r.chrom AND l.pos = r.pos)
SELECT 'SOM' AS key, count(*) FILTER (ls) AS n_left, count(*) FILTER (ls AND lo) AS n_left_pass, count(*) FILTER (re OR rs) AS n_right, count(*) FILTER ((re OR rs) AND ro) AS n_right_pass, count(*) FILTER (ls AND (re OR rs)) AS n_overlap, count(*) FILTER (ls AND (re OR rs) AND lo AND ro) AS n_overlap_pass FROM j""")
def q_compare_sets(spark, d):
    return compare.counts(*sides(spark, d), compare.parse_spec("SOM=TUM_EDIT,SOM"))


@query(f"{SIDES} SELECT l.chrom, l.pos FROM l WHERE ok AND EXISTS (SELECT 1 FROM r WHERE r.chrom = l.chrom AND r.pos = l.pos AND r.ok)")
def q_overlap(spark, d):
    return compare.overlap(*sides(spark, d)).select("chrom", "pos")


@query(f"{SIDES} SELECT l.chrom, l.pos FROM l WHERE ok AND NOT EXISTS (SELECT 1 FROM r WHERE r.chrom = l.chrom AND r.pos = l.pos)")
def q_nonoverlap(spark, d):
    return compare.non_overlap(*sides(spark, d)).select("chrom", "pos")


@query(f"{SIDES} SELECT CASE WHEN ok THEN 'PASS' ELSE 'dtmnad' END AS filter, count(*) AS n FROM l GROUP BY ALL")
def q_filter_counts(spark, d):
    return compare.filter_counts(sides(spark, d)[0])


@query(f"""{SIDES}, fresh AS (SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.ok AND l.chrom = r.chrom AND l.pos = r.pos)), o AS (SELECT r.chrom, r.pos FROM r JOIN l ON r.chrom = l.chrom AND r.pos = l.pos WHERE r.ok AND l.ok),
j AS (SELECT coalesce(l.chrom, n.chrom) AS chrom, coalesce(l.pos, n.pos) AS pos, l.chrom IS NOT NULL AS hl, n.chrom IS NOT NULL AS hn, coalesce(l.ok, false) AS lok, coalesce(n.ok, false) AS nok, l.germ AS lg, l.som AS ls, l.edit AS le, n.germ AS ng, n.som AS ns, n.edit AS ne
  FROM l FULL JOIN fresh n ON l.chrom = n.chrom AND l.pos = n.pos),
w AS (SELECT *, hn AND nok AND NOT lok AS win FROM j), x AS (SELECT *, win OR NOT hl AS from_n FROM w)
SELECT x.chrom, x.pos, CASE WHEN win THEN 'PASS' WHEN hl AND lok THEN 'PASS' WHEN hl THEN CASE WHEN hn AND NOT nok THEN 'dtmnad;rtmnad' ELSE 'dtmnad' END ELSE 'rtmnad' END AS filter,
  CASE WHEN from_n THEN 'RNA' WHEN (o.chrom IS NOT NULL) THEN 'DNA,RNA' WHEN hn AND NOT nok THEN 'DNA,RNA' ELSE 'DNA' END AS origin
FROM x LEFT JOIN o ON o.chrom = x.chrom AND o.pos = x.pos""")
def q_merge_priority(spark, d):
    left, right = sides(spark, d)
    full = lambda df, o: df.withColumns({"origin": F.array(F.lit(o)), "mod_filters": F.array().cast("array<string>")})
    only = compare.non_overlap(right.withColumn("filter", F.array(F.lit("PASS"))), merge.passing(left)).select("chrom", "pos")
    none = full(right, "RNA").where(F.lit(False))
    out = merge.merge_rna_and_dna(full(left, "DNA"), none, compare.overlap(right, left), full(right.join(only, ["chrom", "pos"], "left_semi"), "RNA"))
    return out.select("chrom", "pos", F.array_join(F.array_sort("filter"), ";").alias("filter"), F.array_join(F.array_sort("origin"), ",").alias("origin"))


@query(f"{SIDES} SELECT l.chrom, l.pos, CASE WHEN r.ok THEN 'edit' ELSE 'call' END AS source FROM l LEFT JOIN r ON r.chrom = l.chrom AND r.pos = l.pos AND r.ok")
def q_overlay(spark, d):
    left, right = sides(spark, d)
    mark = lambda df, s: df.select("chrom", "pos", F.lit(s).alias("source"))
    return merge.overlay(mark(left, "call"), mark(merge.passing(right), "edit"))


@query(f"{SIDES} SELECT chrom, pos, 'call' AS source FROM l UNION ALL SELECT chrom, pos, 'edit' FROM r")
def q_chrom_sort_union(spark, d):
    left, right = sides(spark, d)
    return merge.union_sorted([left.select("chrom", "pos", F.lit("call").alias("source")), right.select("chrom", "pos", F.lit("edit").alias("source"))])


@query(f"{SIDES} SELECT chrom, pos FROM l WHERE ok")
def q_extract_passing(spark, d):
    return merge.passing(sides(spark, d)[0]).select("chrom", "pos")


@query(f"{SIDES} SELECT chrom, pos, 'PASS' AS filter FROM l WHERE NOT germ AND pos % 7 <> 0 AND pos % 3 <> 0")
def q_rna_only(spark, d):
    left, _ = sides(spark, d)
    flagged = left.withColumns({"info": F.map_from_arrays(F.array(F.when(F.col("pos") % 7 == 0, "DB").otherwise("SS")), F.array(F.array(F.lit("True")))), "filter": F.array(F.when(F.col("pos") % 3 == 0, "dnmndp").otherwise("dtmnad"))})
    return merge.rna_only(flagged).select("chrom", "pos", F.array_join("filter", ";").alias("filter"))


@query(f"""{SIDES} SELECT chrom, pos, CASE WHEN germ THEN 'RADIAGerm' WHEN pos % 3 = 0 THEN 'RADIASomDNA' WHEN pos % 3 = 1 THEN 'RADIASomRNAConf' ELSE 'RADIASomRNARescue' END AS sst FROM l""")
def q_support_label(spark, d):
    left, _ = sides(spark, d)
    origin = F.when(F.col("pos") % 3 == 0, F.array(F.lit("DNA"))).when(F.col("pos") % 3 == 1, F.array(F.lit("DNA"), F.lit("RNA"))).otherwise(F.array(F.lit("RNA")))
    return left.select("chrom", "pos", merge.support_label(F.get("types", 0), origin).alias("sst"))


# Text fields


@query("SELECT p_partkey AS k, translate(substr('ACGTN', CAST(1 + p_partkey % 5 AS INT), 1), 'ACGTN', 'TGCAN') AS base FROM part")
def q_revcomp(spark, d):
    base = F.substring(F.lit("ACGTN"), (1 + F.col("p_partkey") % 5).cast("int"), F.lit(1))
    return read(spark, d, "part").select(F.col("p_partkey").alias("k"), strings.reverse_complement(base).alias("base"))


@query("SELECT o_orderkey AS k, 'p.T' || o_custkey || '=' AS prot, CAST(o_orderkey % 2 = 0 AS BOOLEAN) AS db, 'AC=' || o_custkey || ',' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ';DB' ELSE '' END || ';ProtCh=p.T' || o_custkey || '=' AS again FROM orders")
def q_info_parse(spark, d):
    c, k = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    info = F.concat(F.lit("ProtCh=p.T"), c, F.lit("=;AC="), c, F.lit(","), k, F.when(F.col("o_orderkey") % 2 == 0, ";DB").otherwise(""))
    x = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), strings.parse_info(info).alias("i"))
    return x.select("k", F.get(F.col("i")["ProtCh"], 0).alias("prot"), F.array_contains(F.map_keys("i"), "DB").alias("db"), strings.format_info(F.col("i")).alias("again"))


@query("SELECT c_custkey AS k, 'hg' || c_nationkey AS fasta, '/data/' || c_name || '.bam' AS bam FROM customer")
def q_vcfgenerator_parse(spark, d):
    line = F.concat(F.lit("##vcfGenerator=<source=<x>,fasta=<hg"), F.col("c_nationkey").cast("string"), F.lit(">,bam=</data/"), "c_name", F.lit(".bam>>"))
    x = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), strings.parse_generator(line).alias("p"))
    return x.select("k", F.col("p")["fasta"].alias("fasta"), F.col("p")["bam"].alias("bam"))


@query("SELECT p_partkey AS k, 'NON_SYNONYMOUS' AS effect, p_name AS gene, p_type AS biotype FROM part")
def q_effect_parse(spark, d):
    e = F.array(F.concat(F.lit("NON_SYNONYMOUS(MODERATE|MISSENSE|aCc/aTc|T1I|99|"), "p_name", F.lit("|"), "p_type", F.lit("|CODING|id|1|1)")))
    return read(spark, d, "part").select(F.col("p_partkey").alias("k"), F.explode(strings.parse_effects(e)).alias("e")).select("k", "e.effect", "e.gene", "e.biotype")


@query("SELECT l_orderkey AS k, l_linenumber AS n, (l_orderkey & 1) <> 0 AS paired, (l_orderkey & 2) <> 0 AS proper, (l_orderkey & 256) <> 0 AS secondary FROM lineitem")
def q_sam_flags(spark, d):
    k = F.col("l_orderkey")
    return read(spark, d, "lineitem").select(k.alias("k"), F.col("l_linenumber").alias("n"), *[strings.flag(k, b).alias(n) for b, n in ((0x1, "paired"), (0x2, "proper"), (0x100, "secondary"))])


@query("SELECT c_custkey AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END || ',B' AS codes, CASE WHEN c_acctbal > 0 THEN 'AY' ELSE 'AN' END || ',' || CASE WHEN c_nationkey > 12 THEN 'NY' ELSE 'NN' END AS flags FROM customer")
def q_tissue_and_flag_codes(spark, d):
    codes = F.create_map(F.lit("BUILDING"), F.lit("B"), F.lit("MACHINERY"), F.lit("M"))
    return read(spark, d, "customer").select(F.col("c_custkey").alias("k"), strings.tissue_codes(F.concat("c_mktsegment", F.lit(", BUILDING")), codes).alias("codes"), strings.pack_flags([("A", F.col("c_acctbal") > 0), ("N", F.col("c_nationkey") > 12)]).alias("flags"))


# Reference codes, genotypes of the filter, indels and depths, normal RNA


def unsure(spark, d) -> DataFrame:
    """Observations of which some have no reference base or another one."""
    at, n = F.col("pos"), F.col("line")
    return obs(spark, d).withColumn("ref", F.when((at % 11 == 0) & (n == 2), "N").when((at % 7 == 0) & (n == 4), "G").otherwise(F.col("ref")))


UNSURE = f"""{CALLS}, u AS (SELECT chrom, pos, CASE WHEN pos % 11 = 0 AND line = 2 THEN 'N' WHEN pos % 7 = 0 AND line = 4 THEN 'G' ELSE ref END AS ref FROM obs),
c AS (SELECT chrom, pos, concat_ws(';', CASE WHEN bool_or(ref = 'N') THEN 'noref' END, CASE WHEN min(ref) <> max(ref) THEN 'diffref' END) AS codes FROM u GROUP BY ALL)"""


@query(f"{UNSURE} SELECT chrom, pos, codes FROM c")
def q_reference_codes(spark, d):
    return calling.reference_codes(unsure(spark, d)).select("chrom", "pos", F.array_join("ref_codes", ";").alias("codes")).distinct()


@query(f"{UNSURE} SELECT k.chrom, k.pos, CASE WHEN codes = '' THEN 'PASS' ELSE codes END AS filter FROM (SELECT DISTINCT chrom, pos FROM mods) k JOIN c ON c.chrom = k.chrom AND c.pos = k.pos")
def q_emit_gate(spark, d):
    out = calling.emitted(called(spark, d), calling.reference_codes(unsure(spark, d)), output_all=True)
    return out.select("chrom", "pos", F.array_join("filter", ";").alias("filter"))


@query(f"""{RANKED}, f AS (SELECT *, n >= 4 AND {hundredths_sql('n', 'total')} >= 10 AS good, row_number() OVER (PARTITION BY chrom, pos, i > 0 ORDER BY k) AS ka FROM r),
h AS (SELECT chrom, pos, max(i) FILTER (k = 1) AS a, coalesce(max(i) FILTER (k = 2 AND good), max(i) FILTER (k = 1)) AS b, coalesce(max(i) FILTER (i > 0 AND ka = 1 AND good), 0) AS y, coalesce(string_agg(CAST(i AS VARCHAR), '/' ORDER BY i) FILTER (good), '0') AS m FROM f GROUP BY ALL)
SELECT chrom, pos, least(a, b) || '/' || greatest(a, b) AS gt, CAST(y AS VARCHAR) AS gt_y, m AS gt_m FROM h""")
def q_genotype_recomputed(spark, d):
    gt = lambda chrom: genotype.text(genotype.recomputed(F.lit(chrom), F.col("depths")))
    return tumor_depths(spark, d).select("chrom", "pos", gt("1").alias("gt"), gt("Y").alias("gt_y"), gt("MT").alias("gt_m"))


INDELS = support.with_limits(DNA_LOW, max_indels=6, max_depth=14)


@query(f"""{CALLS}, {DEPTHS}, e AS (SELECT chrom, pos, count(*) FILTER (sample = 'DNA_NORMAL') AS dn, count(*) FILTER (sample = 'DNA_TUMOR') AS dt, count(*) FILTER (sample = 'RNA_TUMOR') AS rt FROM obs WHERE line <= 2 GROUP BY ALL)
SELECT g.chrom, g.pos, g.src, g.tgt, concat_ws('_', CASE WHEN dnt >= 14 THEN 'dnmxdp' END, CASE WHEN dtt >= 14 THEN 'dtmxdp' END, CASE WHEN dtt > 0 AND coalesce(dt, 0) >= 6 THEN 'dtmxindel' END,
  CASE WHEN CASE WHEN dnt > 0 THEN coalesce(dn, 0) ELSE 0 END + CASE WHEN dtt > 0 THEN coalesce(dt, 0) ELSE 0 END + CASE WHEN rtt > 0 THEN coalesce(rt, 0) ELSE 0 END >= 6 THEN 'indel' END) AS codes
FROM (SELECT chrom, pos, type, src, tgt, dnt, dtt, rtt FROM g) g LEFT JOIN e ON e.chrom = g.chrom AND e.pos = g.pos WHERE type = 'SOM'""")
def q_indels_and_depths(spark, d):
    o = obs(spark, d)
    sites = o.groupBy("chrom", "pos", "sample").agg(*[F.count_if(F.col("line") == k).alias(c) for k, c in enumerate(calling.EDGES, 1)])
    r = calling.records(o, sites=sites).select("*", F.explode("mods").alias("m")).where(F.col("m.type") == "SOM")
    codes = F.filter(support.rule_codes("m", INDELS), lambda c: c.isin("dnmxdp", "dtmxdp", "dtmxindel", "indel"))
    return r.select("chrom", "pos", "m.src", "m.tgt", F.array_join(codes, "_").alias("codes"))


@query(f"""{CALLS}, e AS (SELECT chrom, pos, sample, count(*) FILTER (line = 1) AS ins, count(*) FILTER (line = 2) AS del, count(*) FILTER (line = 3) AS st, count(*) FILTER (line = 4) AS en FROM obs GROUP BY ALL),
k AS (SELECT DISTINCT chrom, pos, ref FROM mods), has AS (SELECT chrom, pos, sample, sum(ad) AS dp FROM stats GROUP BY ALL HAVING sum(ad) > 0),
edges AS (SELECT chrom, pos, CAST(sum(ins) AS BIGINT) AS ins, CAST(sum(del) AS BIGINT) AS del, CAST(sum(st) AS BIGINT) AS start, CAST(sum(en) AS BIGINT) AS stop FROM e JOIN has USING (chrom, pos, sample) GROUP BY ALL),
sums AS (SELECT chrom, pos, CAST(sum(ad) AS BIGINT) AS dp, CAST(sum(mq0) AS BIGINT) AS mq0, CAST(sum(sum_bq) AS BIGINT) AS b, CAST(sum(sum_mq) AS BIGINT) AS m, CAST(sum(plus) AS BIGINT) AS pl, CAST(coalesce(sum(ad) FILTER (base <> ref), 0) AS BIGINT) AS alt,
  1 + count(DISTINCT base) FILTER (ad > 0 AND base <> ref) AS an FROM stats GROUP BY ALL),
c AS (SELECT m.chrom, m.pos, m.tgt, CAST(dn + dt + rt AS BIGINT) AS n FROM (SELECT DISTINCT chrom, pos, tgt FROM mods WHERE tgt <> ref) m JOIN state s ON s.chrom = m.chrom AND s.pos = m.pos AND s.base = m.tgt),
l AS (SELECT c.chrom, c.pos, string_agg(tgt || n || '=' || CAST({hundredths_sql('n', 'dp')} AS VARCHAR), ',' ORDER BY tgt) AS alts FROM c JOIN sums ON sums.chrom = c.chrom AND sums.pos = c.pos GROUP BY ALL)
SELECT k.chrom, k.pos, an, dp, mq0, ins, del, start, stop, (2 * b + dp) // (2 * dp) AS bq, (2 * m + dp) // (2 * dp) AS mq, {hundredths_sql('pl', 'dp')} AS sb, {hundredths_sql('alt', 'dp')} AS fa, coalesce(alts, '') AS alts
FROM k JOIN sums ON sums.chrom = k.chrom AND sums.pos = k.pos JOIN edges ON edges.chrom = k.chrom AND edges.pos = k.pos LEFT JOIN l ON l.chrom = k.chrom AND l.pos = k.pos""")
def q_site_alleles(spark, d):
    """The site across samples in the records' own aggregate: edges of reads, and count and share of each alternate (hundredths; here by letter, in records in the order of alts)."""
    o = obs(spark, d)
    sites = o.groupBy("chrom", "pos", "sample").agg(*[F.count_if(F.col("line") == k).alias(c) for k, c in enumerate(calling.EDGES, 1)])
    r = calling.records(o, sites=sites, site=True)
    called = F.filter(F.arrays_zip(F.col("alts").alias("b"), F.col("site.ac").alias("n"), F.col("site.af").alias("f")), lambda z: F.exists("mods", lambda m: m["tgt"] == z["b"]))
    alts = F.array_join(F.array_sort(F.transform(called, lambda z: F.concat(z["b"], z["n"].cast("string"), F.lit("="), F.round(z["f"] * 100).cast("int").cast("string")))), ",")
    share = lambda c: F.round(F.col(f"site.{c}") * 100).cast("long").alias(c)
    return r.select("chrom", "pos", *[F.col(f"site.{c}").alias(c) for c in ("an", "dp", "mq0", *calling.EDGES, "bq", "mq")], share("sb"), share("fa"), alts.alias("alts"))


@query(f"""WITH {OBS.replace("ELSE 'RNA_TUMOR' END", "ELSE 'RNA_NORMAL' END")}, {STATS}, {STATE.replace("'RNA_TUMOR'", "'RNA_NORMAL'")}, g AS (
  SELECT b.chrom, b.pos, b.ref, 'NOR_EDIT' AS type, d.base AS src, b.base AS tgt, b.dnt, b.rtt FROM state b JOIN state d ON b.chrom = d.chrom AND b.pos = d.pos AND b.base <> d.base
  WHERE b.rtt >= 4 AND b.rt >= 2 AND b.dn = 0 AND NOT b.isref AND (d.dn > 0 OR d.isref)
), {evidence_sql('dn', 'DNA_NORMAL')}, {evidence_sql('rt', 'RNA_NORMAL')}, f AS ({full_sql('rt', 'e_rt', 10, 0.10)} UNION ALL {context_sql('dn', 'e_dn', 0.10)})
SELECT g.chrom, g.pos, g.src, g.tgt, coalesce(string_agg(DISTINCT regexp_replace(code, '^rt', 'rn'), '_' ORDER BY regexp_replace(code, '^rt', 'rn')), '') AS codes
FROM g LEFT JOIN f ON f.chrom = g.chrom AND f.pos = g.pos AND f.src = g.src AND f.tgt = g.tgt GROUP BY g.chrom, g.pos, g.src, g.tgt""")
def q_support_normal_rna(spark, d):
    """Rules of edits in normal RNA: the RNA observations count as the normal's."""
    o = obs(spark, d).where("sample <> 'DNA_TUMOR'").withColumn("sample", F.when(F.col("sample") == "RNA_TUMOR", "RNA_NORMAL").otherwise(F.col("sample")))
    r = calling.records(o).select("*", F.explode("mods").alias("m")).where(F.col("m.type") == "NOR_EDIT")
    return r.select("chrom", "pos", "m.src", "m.tgt", F.array_join(support.rule_codes("m", RNA_LOW), "_").alias("codes"))


# Read support from reads to filters


def short_reads(spark, d) -> tuple[DataFrame, DataFrame]:
    """A call every ten places, one for each part, and reads of ten bases over them, one for each line item."""
    part = read(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).cast("string").alias("chrom"))
    calls = part.select("chrom", (F.col("p_partkey") * 10).alias("pos"), letter(F.col("p_partkey") + 1).alias("alt"), F.array(F.lit("PASS")).alias("filter"))
    line = read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_quantity", "l_discount")
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    piece = lambda op, size: F.struct(F.lit(op).alias("op"), F.lit(size).alias("len"))
    cigar = F.when(k % 10 == 0, F.array(piece(4, 2), piece(0, 8))).when(k % 10 == 1, F.array(piece(0, 5), piece(1, 1), piece(0, 4))).when(k % 10 == 2, F.array(piece(0, 5), piece(2, 1), piece(0, 5))).otherwise(F.array(piece(0, 10)))
    start = F.col("l_partkey") * 10 - 1 - n
    quality = lambda q: F.repeat(F.chr(q + 33), F.lit(5))
    flags = F.lit(1) + F.when(F.col("l_discount") > 0.02, 2).otherwise(0) + F.when(F.col("l_linestatus") == "F", 16).otherwise(0) + F.when(F.col("l_suppkey") % 5 == 0, 256).otherwise(0) + F.when(k % 17 == 0, 1024).otherwise(0)
    rows = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "chrom", start.alias("start"), F.col("l_suppkey").cast("string").alias("read_name"), flags.alias("flag"), k.alias("mapq"), cigar.alias("cigar"), (start + F.when(n % 2 == 0, 0).otherwise(30)).alias("mate_start"),
        F.repeat(letter(F.col("l_partkey") + F.when(n % 3 == 0, 1).otherwise(0)), F.lit(10)).alias("seq"), F.concat(quality(F.least(F.col("l_quantity").cast("int"), F.lit(40))), quality(n + 8)).alias("qual"), (k % 6).alias("mutations"),
    )
    return calls, rows


@query(f"""WITH c AS (SELECT p_partkey, CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey * 10 AS pos, substr('ACGT', CAST(1 + (p_partkey + 1) % 4 AS INT), 1) AS alt FROM part),
l AS (SELECT chrom, pos, alt, l_suppkey AS name, l_orderkey AS k, l_linenumber AS n, l_orderkey % 10 AS kind, least(CAST(l_quantity AS INT), 40) AS q, l_discount > 0.02 AS proper, l_linestatus <> 'F' AS plus, l_suppkey % 5 = 0 AS secondary,
  substr('ACGT', CAST(1 + (l_partkey + CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END) % 4 AS INT), 1) AS base, l_linenumber % 2 = 0 AS overlapping FROM lineitem JOIN c ON l_partkey = p_partkey WHERE l_orderkey % 17 <> 0),
a AS (SELECT *, CASE WHEN kind = 0 THEN n + 2 WHEN kind = 1 AND n >= 5 THEN n + 1 WHEN kind = 2 AND n >= 5 THEN n - 1 ELSE n END AS qpos FROM l WHERE NOT (kind IN (1, 2) AND n = 4) AND NOT (kind = 2 AND n = 5)),
o AS (SELECT *, CASE WHEN qpos < 5 THEN q ELSE n + 8 END AS bq FROM a WHERE CASE WHEN qpos < 5 THEN q ELSE n + 8 END >= 10),
w AS (SELECT *, count(*) OVER (PARTITION BY chrom, pos, name) AS rows_of_name, count(*) OVER v AS m, min(base) OVER v AS lo, max(base) OVER v AS hi, row_number() OVER (v ORDER BY bq DESC, base, qpos, 2 * proper::INT + 16 * (NOT plus)::INT + 256 * secondary::INT, k) AS place_of FROM o WINDOW v AS (PARTITION BY chrom, pos, name, overlapping)),
r AS (SELECT *, base = alt AS mutated, proper AND kind > 2 AND q >= 10 AND n > 1 AND k % 6 < 4 AS perfect, CASE WHEN qpos <= 3 THEN 'start' WHEN qpos <= 6 THEN 'middle' ELSE 'end' END AS place FROM w WHERE rows_of_name = 1 OR NOT overlapping OR m = 1 OR (place_of = 1 AND lo = hi)),
{COUNTS}, j AS (WITH {JUDGED.replace("SELECT chrom, pos, mmp,", "SELECT chrom, pos, mmp, n_mut, n_ref, n_perfect,")})
SELECT c.chrom, c.pos, mmp, n_mut, n_ref, n_perfect, CASE WHEN j.pos IS NULL THEN 'perfmnad_perfmnaf' WHEN codes = '' THEN 'PASS' ELSE codes END AS filter FROM c LEFT JOIN j ON j.chrom = c.chrom AND j.pos = c.pos""")
def q_read_support(spark, d):
    """Reads over calls, flags, mates, perfect reads, counts, codes and filter in one plan."""
    out = reads.filter_by_read_support(*short_reads(spark, d))
    return out.select("chrom", "pos", "mmp", "n_mut", "n_ref", "n_perfect", F.array_join("filter", "_").alias("filter"))


# Read evidence: mismatches against a packed reference, known variants, origins and transcript loci


def evidence_calls(spark, d) -> DataFrame:
    """A call for each part, fifty bases into a hundred of its own: somatic in DNA, RNA or both, an edit of tumor RNA, or (one in four, six bases before) a known variant."""
    p, b = F.col("p_partkey"), lambda k: letter(F.col("p_partkey") + k)
    mod = lambda kind, tgt: F.array(F.struct(kind.alias("type"), b(0).alias("src"), tgt.alias("tgt")))
    edit = p % 8 < 2
    origin = F.when(edit | (p % 3 == 2), F.array(F.lit("RNA"))).when(p % 3 == 1, F.array(F.lit("DNA"))).otherwise(F.array(F.lit("DNA"), F.lit("RNA")))
    base = read(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).cast("string").alias("chrom"), b(0).alias("ref"), F.array(b(0), b(1)).alias("alleles"), F.array(F.lit("PASS")).alias("filter"))
    judged = base.select("*", origin.alias("origin"), mod(F.when(edit, "TUM_EDIT").otherwise("SOM"), b(1)).alias("mods"), F.when(edit, 4).otherwise(2).alias("ss"), (p * 100 + 50).alias("pos"))
    known = base.where(p % 4 == 1).select("*", F.array(F.lit("DNA")).alias("origin"), mod(F.lit("GERM"), b(2)).alias("mods"), F.lit(1).alias("ss"), (p * 100 + 42).alias("pos"))
    return judged.unionByName(known)


def evidence_reads(spark, d) -> DataFrame:
    """A read of twenty bases for each line item: up to five mismatches at its start, the call's base six to twelve bases in, some clipped."""
    line = read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_quantity", "l_discount")
    j = line.join(read(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).cast("string").alias("chrom")), F.col("l_partkey") == F.col("p_partkey"))
    n, k, at, m = F.col("l_linenumber").cast("int"), F.col("l_orderkey"), (F.col("l_linenumber") + 5).cast("int"), (F.col("l_orderkey") % 6).cast("int")
    own = lambda s: letter(F.col("l_partkey") + s)
    base = F.when(k % 7 == 0, own(2)).when(n % 3 == 0, own(1)).otherwise(own(0))
    seq = F.concat(F.repeat(own(2), m), F.repeat(own(0), at - m), base, F.repeat(own(0), F.lit(19) - at))
    clip = F.when(k % 10 == 0, 1).when(k % 10 == 1, 3).otherwise(0).cast("int")
    piece = lambda op, size: F.struct(F.lit(op).alias("op"), size.cast("int").alias("len"))
    start = F.col("l_partkey") * 100 + 49 - at
    quality = lambda q: F.repeat(F.chr(q + 33), F.lit(10))
    flags = F.lit(1) + F.when(F.col("l_discount") > 0.02, 2).otherwise(0) + F.when(F.col("l_linestatus") == "F", 16).otherwise(0) + F.when(F.col("l_suppkey") % 5 == 0, 256).otherwise(0) + F.when(k % 17 == 0, 1024).otherwise(0)
    return j.select(
        F.when(F.col("l_suppkey") % 2 == 0, "DNA_TUMOR").otherwise("RNA_TUMOR").alias("sample"), "chrom", (start + clip).alias("start"), F.col("l_suppkey").cast("string").alias("read_name"), flags.alias("flag"), F.when(k % 13 == 0, -k).otherwise(k + 10).cast("int").alias("mapq"),
        F.filter(F.array(piece(4, clip), piece(0, F.lit(20) - clip)), lambda c: c["len"] > 0).alias("cigar"), (start + F.when(n % 2 == 0, 0).otherwise(300)).alias("mate_start"), seq.alias("seq"),
        F.concat(quality(F.least(F.col("l_quantity").cast("int"), F.lit(40))), quality(n + 8)).alias("qual"), F.col("l_partkey").alias("part"),
    )


def evidence_reference(spark, d) -> DataFrame:
    part = read(spark, d, "part").select((F.col("p_size") % 25).cast("string").alias("chrom"), (F.col("p_partkey") * 100).alias("begin"), F.repeat(letter(F.col("p_partkey")), F.lit(100)).alias("value"))
    return reference.packed(part)


def lane_sql(lanes: str, forward: str = "true") -> str:
    """The judged lanes of evidence_calls over evidence_reads; ``lanes`` says which lanes a part p has, ``forward`` which reads lie on the genome's strand."""
    return f"""WITH c AS (SELECT p_partkey AS p, CAST(p_size % 25 AS VARCHAR) AS chrom, p_partkey % 8 < 2 AS edit FROM part),
lanes AS ({lanes}),
l AS (SELECT l_partkey AS p, CASE WHEN l_suppkey % 2 = 0 THEN 'DNA' ELSE 'RNA' END AS lane, l_suppkey AS name, l_orderkey AS k, CAST(l_linenumber AS INT) AS n, CAST(l_linenumber AS INT) + 5 AS qp, l_orderkey % 6 AS m,
  CASE WHEN l_orderkey % 10 = 0 THEN 1 WHEN l_orderkey % 10 = 1 THEN 3 ELSE 0 END AS clip, least(CAST(l_quantity AS INT), 40) AS q, l_discount > 0.02 AS proper, l_linestatus <> 'F' AS plus, l_suppkey % 5 = 0 AS secondary, l_linenumber % 3 = 0 AS mutated, l_linenumber % 2 = 0 AS overlapping
  FROM lineitem WHERE l_orderkey % 17 <> 0 AND l_orderkey % 7 <> 0),
o AS (SELECT lanes.*, l.* EXCLUDE (p, lane), CASE WHEN qp < 10 THEN q ELSE n + 8 END AS bq, CASE WHEN k % 13 = 0 THEN -k ELSE k + 10 END AS mapq FROM lanes JOIN l ON l.p = lanes.p AND l.lane = lanes.lane WHERE l.lane = 'DNA' OR NOT secondary),
w AS (SELECT *, count(*) OVER (PARTITION BY p, lane, name) AS of_name, count(*) OVER v AS size, min(mutated::INT) OVER v AS lo, max(mutated::INT) OVER v AS hi, max(bq) OVER v AS top, row_number() OVER (v ORDER BY bq DESC, mutated, qp, 2 * proper::INT + 16 * (NOT plus)::INT + 256 * secondary::INT, mapq) AS rank FROM o WINDOW v AS (PARTITION BY p, lane, name, overlapping)),
x AS (SELECT *, max(bq) FILTER (rank > 1) OVER (PARTITION BY p, lane, name, overlapping) AS next FROM w),
f AS (SELECT *, mapq >= 10 AND bq >= 10 AS good, CASE WHEN qp <= 6 THEN 'start' WHEN qp <= 13 THEN 'middle' ELSE 'end' END AS place,
  (lane = 'RNA' OR proper) AND q >= 10 AND n > 1 AND clip < 2 AND (SELECT count(*) FROM (SELECT unnest(range(6)) AS i) WHERE i < m AND i >= clip AND NOT (p % 4 = 1 AND i = qp - 8) AND NOT (edit AND p % 4 = 0 AND {forward})) + 1 < 4 AS clean
  FROM x WHERE of_name = 1 OR NOT overlapping OR size = 1 OR (rank = 1 AND (lo = hi OR (top >= 10 AND next < 10)))),
s AS (SELECT p, lane, count(*) FILTER (mutated) AS n_mut, count(*) FILTER (NOT mutated) AS n_ref, count(*) FILTER (mutated AND good) AS n_good, count(*) FILTER (mutated AND secondary) AS n_mut2, count(*) FILTER (NOT mutated AND secondary) AS n_ref2,
  count(*) FILTER (mutated AND good AND clean) AS n_perfect, count(*) FILTER (mutated AND good AND clean AND plus) AS p_plus, count(*) FILTER (mutated AND good AND place = 'start') AS n_start, count(*) FILTER (mutated AND good AND place = 'end') AS n_end,
  count(*) FILTER (mutated AND good AND clean AND place = 'start') AS p_start, count(*) FILTER (mutated AND good AND clean AND place = 'end') AS p_end FROM f GROUP BY ALL),
j AS (SELECT lanes.p, lanes.chrom, lanes.lane, coalesce(n_mut, 0) AS n_mut, coalesce(n_ref, 0) AS n_ref, coalesce(n_perfect, 0) AS n_perfect, coalesce(n_mut2, 0) AS n_mut2, coalesce(n_ref2, 0) AS n_ref2, concat_ws(',',
  CASE WHEN n_mut >= 4 AND {hundredths_sql('n_mut2', 'n_mut')} >= 90 THEN 'mxmmp' END,
  CASE WHEN n_good >= 4 AND greatest({hundredths_sql('n_start', 'n_good')}, {hundredths_sql('n_end', 'n_good')}) >= 95 THEN 'pbias' END,
  CASE WHEN coalesce(n_perfect, 0) < 4 THEN 'perfmnad' END, CASE WHEN coalesce(n_mut + n_ref, 0) > 0 AND {hundredths_sql('n_perfect', 'n_mut + n_ref')} < 10 THEN 'perfmnaf' END,
  CASE WHEN n_perfect >= 4 AND greatest({hundredths_sql('p_start', 'n_perfect')}, {hundredths_sql('p_end', 'n_perfect')}) >= 95 THEN 'perfpbias' END,
  CASE WHEN n_perfect >= 4 AND ({hundredths_sql('p_plus', 'n_perfect')} > 90 OR {hundredths_sql('p_plus', 'n_perfect')} < 10) THEN 'perfsbias' END) AS codes FROM lanes LEFT JOIN s ON s.p = lanes.p AND s.lane = lanes.lane)"""


LANES = "SELECT p, chrom, edit, 'DNA' AS lane FROM c WHERE NOT edit AND p % 3 < 2 UNION ALL SELECT p, chrom, edit, 'RNA' FROM c WHERE edit OR p % 3 <> 1"


@query(f"""{lane_sql(LANES)}, e AS (SELECT p, chrom, bool_or(lane = 'DNA' AND codes = '') AS dna, bool_or(codes = '') AS ok FROM j GROUP BY ALL),
r AS (SELECT j.p, code FROM j, unnest(string_split(codes, ',')) AS t(code) WHERE code <> '')
SELECT e.chrom, e.p * 100 + 50 AS pos, CASE WHEN ok THEN 'PASS' ELSE (SELECT string_agg(DISTINCT code, '_' ORDER BY code) FROM r WHERE r.p = e.p) END AS filter,
  (SELECT coalesce({hundredths_sql('n_mut2', 'n_mut')}, 0) FROM j WHERE j.p = e.p AND j.lane = 'DNA') AS dt_mmp, substr('ACGT', CAST(1 + e.p % 4 AS INT), 1) AS pn FROM e
UNION ALL SELECT chrom, p * 100 + 42, 'PASS', NULL, NULL FROM c WHERE p % 4 = 1""")
def q_read_evidence(spark, d):
    """Reads to filters with mismatches against the reference, known variants and expected edits left out of them, DNA before RNA."""
    out = read_evidence.filter_by_reads(evidence_calls(spark, d), evidence_reads(spark, d).drop("part"), evidence_reference(spark, d))
    share = F.get(F.col("mmp")["DNA_TUMOR"], 1)
    return out.select("chrom", "pos", F.array_join("filter", "_").alias("filter"), F.round(share * 100).cast("long").alias("dt_mmp"), "pn")


@query(f"""{lane_sql("SELECT p, chrom, edit, 'RNA' AS lane FROM c WHERE edit OR p % 3 <> 1", "name % 3 <> 0")}
SELECT chrom, p * 100 + 50 AS pos, n_mut, n_ref, n_perfect, codes FROM j""")
def q_read_loci(spark, d):
    """RNA lanes over two transcripts: reads and reference of the one lie on the other strand, those of the other thirty bases on; both are folded into one verdict."""
    calls = evidence_calls(spark, d).where(F.array_contains("origin", "RNA") | (F.col("ss") == 1))
    own = (F.floor(F.when(F.col("ss") == 1, F.col("pos") - 42).otherwise(F.col("pos") - 50) / 100)).cast("string")
    off = F.when(F.col("ss") == 1, 42).otherwise(50).cast("long")
    calls = calls.withColumns({"origin": F.array(F.lit("RNA")), "tx_names": F.array(F.concat(F.lit("M"), own), F.concat(F.lit("P"), own)), "tx_coords": F.array(off, off + 30), "tx_strands": F.array(F.lit("-"), F.lit("+"))})
    minus = F.col("l_minus")
    part = F.col("part").cast("string")
    at = lambda c: F.col(c) - F.col("part") * 100 + F.when(minus, 0).otherwise(30)
    rows = evidence_reads(spark, d).where("sample = 'RNA_TUMOR'").withColumn("l_minus", F.col("read_name").cast("long") % 3 == 0)
    rows = rows.withColumns({"chrom": F.concat(F.when(minus, "M").otherwise("P"), part), "start": at("start"), "mate_start": at("mate_start"), "seq": F.when(minus, strings.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))})
    letters = read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("k"), letter(F.col("p_partkey")).alias("b"))
    ref = letters.select(F.concat(F.lit("M"), "k").alias("chrom"), F.lit(0).alias("begin"), F.repeat(strings.reverse_complement(F.col("b")), F.lit(100)).alias("value"))
    ref = ref.union(letters.select(F.concat(F.lit("P"), "k"), F.lit(30), F.repeat("b", F.lit(100))))
    each = read_evidence.lane_evidence(calls, rows.drop("part", "l_minus"), reference.packed(ref), read_evidence.germline_bases(calls))
    return each.select(F.col("call_chrom").alias("chrom"), F.col("call_pos").alias("pos"), "n_mut", "n_ref", "n_perfect", F.array_join("codes", ",").alias("codes"))


# Merge with RNA rows


@query(f"""{SIDES}, fresh AS (SELECT r.* FROM r WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.ok AND l.chrom = r.chrom AND l.pos = r.pos)), o AS (SELECT r.chrom, r.pos FROM r JOIN l ON r.chrom = l.chrom AND r.pos = l.pos WHERE r.ok AND l.ok),
j AS (SELECT coalesce(l.chrom, r.chrom) AS chrom, coalesce(l.pos, r.pos) AS pos, l.chrom IS NOT NULL AS hd, coalesce(l.ok, false) AS lok, r.chrom IS NOT NULL AS hr, coalesce(r.ok, false) AS rok, n.chrom IS NOT NULL AS hn, o.chrom IS NOT NULL AS in_both,
    coalesce(l.germ, r.germ) AS germ, coalesce(l.som, r.som) AS som, coalesce(l.edit, r.edit) AS edit
  FROM l FULL JOIN r ON r.chrom = l.chrom AND r.pos = l.pos LEFT JOIN fresh n ON n.chrom = r.chrom AND n.pos = r.pos LEFT JOIN o ON o.chrom = r.chrom AND o.pos = r.pos),
x AS (SELECT *, hn AND rok AND NOT lok AS win, hn AND NOT rok AND NOT lok AS an, hr AND NOT rok AND NOT lok AS ar FROM j),
y AS (SELECT *, CASE WHEN win OR (hd AND lok) THEN 'PASS' ELSE nullif(concat_ws(';', CASE WHEN hd THEN 'dtmnad' END, CASE WHEN ar THEN 'rtmnad' END, CASE WHEN an THEN 'rtmnbq' END), '') END AS filter FROM x)
SELECT chrom, pos, filter, concat_ws(',', CASE WHEN germ THEN 'GERM' END, CASE WHEN som THEN 'SOM' END, CASE WHEN edit THEN 'TUM_EDIT' END) AS types, CASE WHEN win OR NOT hd THEN 'RNA' WHEN in_both OR ar THEN 'DNA,RNA' ELSE 'DNA' END AS origin FROM y WHERE filter IS NOT NULL""")
def q_merge_with_rna(spark, d):
    left, right = sides(spark, d)
    full = lambda df, o: df.withColumns({"origin": F.array(F.lit(o)), "mod_filters": F.array().cast("array<string>")})
    apart = compare.non_overlap(right.withColumn("filter", F.array(F.lit("PASS"))), merge.passing(left)).select("chrom", "pos")
    only = right.join(apart, ["chrom", "pos"], "left_semi").withColumn("filter", F.array(F.when(F.col("pos") % 5 == 0, "rtmnbq").otherwise("PASS")))
    out = merge.merge_rna_and_dna(full(left, "DNA"), full(right, "RNA"), compare.overlap(right, left), full(only, "RNA"))
    return out.select("chrom", "pos", *[F.array_join(F.array_sort(c), s).alias(c) for c, s in (("filter", ";"), ("types", ","), ("origin", ","))])
