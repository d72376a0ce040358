"""Evidence with indels, read support from reads to filters, realigned modifications, genotypes, and the filtering plan."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import functions as F

from strandline import queries
from strandline.functions import genotype
from strandline.operators import calling, intervals, merge, reads, realign, support
from strandline.plans.filtering import FilterPlan, judged

OBS = "chrom string, pos long, ref string, sample string, base string, bq int, mq int, plus boolean"


def observations(spark, depth=30):
    """Position 10: somatic A>C; 20: germline; 30: an RNA edit A>G; 40: RNA shows a somatic change too."""
    rows = []
    def add(pos, sample, counts):
        for base, n in counts.items():
            rows.extend(("1", pos, "A", sample, base, 40, 40, k % 2 == 0) for k in range(n))
    add(10, "DNA_NORMAL", {"A": depth}); add(10, "DNA_TUMOR", {"A": 20, "C": 15})  # noqa: E702
    add(20, "DNA_NORMAL", {"A": 15, "T": 15}); add(20, "DNA_TUMOR", {"A": 15, "T": 15})  # noqa: E702
    add(30, "DNA_NORMAL", {"A": depth}); add(30, "DNA_TUMOR", {"A": depth}); add(30, "RNA_TUMOR", {"A": 15, "G": 15})  # noqa: E702
    add(40, "DNA_NORMAL", {"A": depth}); add(40, "DNA_TUMOR", {"A": 15, "C": 15}); add(40, "RNA_TUMOR", {"A": 15, "C": 15})  # noqa: E702
    add(50, "RNA_NORMAL", {"A": 6, "G": 6})
    return spark.createDataFrame(rows, OBS)


def records(spark, sites=None):
    r = calling.records(observations(spark), sites=sites)
    return r.withColumns({"id": F.array().cast("array<string>"), "info": F.expr("map('SS', array('2'))")})


def test_indels_and_depths_fail_their_rules(spark):
    """Indels at a place, a place too deep, and the RNA normal sample's own rules."""
    sites = spark.createDataFrame([("1", 10, "DNA_TUMOR", 2, 1, 0, 0), ("1", 40, "DNA_TUMOR", 1, 1, 5, 6), ("1", 50, "RNA_NORMAL", 0, 9, 0, 0)], "chrom string, pos long, sample string, ins int, del int, start int, stop int")
    r = records(spark, sites)
    codes = lambda p: {x.pos: x.filter for x in support.judge(r, p, with_pre_filter=False).select("pos", "filter").collect()}
    dna = codes(support.DNA)
    assert dna[10] == ["dtmxindel", "indel"] and dna[40] == ["PASS"] and dna[20] == ["PASS"]
    deep = codes(support.with_limits(support.DNA, max_depth=30))
    assert "dtmxdp" in deep[10] and "dnmxdp" in deep[20]
    rna = codes(support.RNA)
    assert {"rnmxindel", "indel"} <= set(rna[50]) and "dnmndp" not in rna[30]
    low = codes(support.with_limits(support.RNA, min_mmq=60, min_bq=60))
    assert {"rnmnbq", "rnmnmq"} <= set(low[50])


def test_genotypes_of_the_filter(spark):
    """Recomputed genotypes against a plain count; on Y only alternatives count."""
    rng = random.Random(3)
    rows = [(c, [rng.choice([0, 1, 3, 4, 9, 40]) for _ in range(rng.randrange(1, 5))]) for c in ("1", "Y", "MT") for _ in range(80)]
    got = spark.createDataFrame(rows, "chrom string, ad array<long>").select("chrom", "ad", genotype.recomputed(F.col("chrom"), F.col("ad")).alias("gt")).collect()
    for r in got:
        total = sum(r.ad)
        ok = lambda n: n >= 4 and total and round(n / total, 2) >= 0.10  # noqa: B023, E731
        if r.chrom == "Y":
            best = max(r.ad[1:], default=0)
            expected = [1 + r.ad[1:].index(best)] if ok(best) else [0]
        elif r.chrom == "MT":
            expected = [i for i, n in enumerate(r.ad) if ok(n)] or [0]
        else:
            order = sorted(range(len(r.ad)), key=lambda i: (-r.ad[i], i))
            expected = sorted([order[0], order[1] if len(order) > 1 and ok(r.ad[order[1]]) else order[0]])
        assert r.gt == expected, r
    judged = {r.pos: r for r in support.judge(records(spark), support.DNA).collect()}
    assert (judged[20].dn_gt, judged[10].dn_gt, judged[10].dt_gt, judged[10].rt_gt) == ([0, 1], [0, 0], [0, 1], None)


def test_wide_and_narrow_intervals(spark):
    """Bins of both widths against all pairs."""
    rng = random.Random(5)
    calls = [("1" if k % 2 else "chr2", rng.randrange(1, 3_000_000)) for k in range(300)]
    beds = [(rng.choice(["chr1", "2"]), a, a + n, f"n{k}") for k in range(60) for a, n in [(rng.randrange(3_000_000), rng.choice([0, 1, 50, 30_000, 700_000, 2_000_000]))]]
    got = intervals.annotate(spark.createDataFrame(calls, "chrom string, pos long"), spark.createDataFrame(beds, "chrom string, start long, end long, name string")).collect()
    strip = lambda c: c.removeprefix("chr")
    for r in got:
        hits = sorted((a, b, n) for c, a, b, n in beds if strip(c) == strip(r.chrom) and a <= r.pos - 1 < b)
        assert (r.n_hits, r.hit_name) == (len(hits), hits[0][2] if hits else None)
    left = spark.createDataFrame(beds[:30], "chrom string, start long, end long, name string")
    both = intervals.intersect(left, spark.createDataFrame(beds[30:], "chrom string, start long, end long, name string"), buffer=100)
    expected = {x for x in beds[:30] if x[1] < x[2] and any(strip(x[0]) == strip(c) and x[1] < b + 100 and x[2] > a - 100 and a - 100 < b + 100 for c, a, b, _ in beds[30:])}
    assert {tuple(r) for r in both.collect()} == expected


def test_coordinates_of_any_length(spark):
    obs = spark.createDataFrame([("1", k * 1000) for k in range(1, 400)], "chrom string, pos long")
    ranges = spark.createDataFrame([("1", 5000, 5000), ("1", 7001, 7999), ("1", 100_000, 300_000_000), ("2", 1, 9)], "chrom string, start long, stop long")
    for prune in (True, False):
        got = {r.pos for r in calling.at_coordinates(obs, ranges, prune).collect()}
        assert got == {5000, *range(100_000, 400_000, 1000)}


def read(name, start, seq, flag=3, mate=10_000, qual=None, cigar=None):
    return ("T", name, flag, "1", start, 60, [(0, len(seq))] if cigar is None else cigar, mate, seq, qual or "I" * len(seq))


READ = "sample string, read_name string, flag int, chrom string, start long, mapq int, cigar array<struct<op:int,len:int>>, mate_start long, seq string, qual string"


def test_read_support_from_reads_to_filters(spark):
    """Flags, mates, perfect reads, places and strands, put together."""
    base = "A" * 20
    at = lambda k, b: base[:k] + b + base[k + 1 :]
    good = [read(f"g{k}", 100 - k, at(k, "C"), flag=3 if k % 2 else 19) for k in range(3, 17)]
    plain = [read(f"p{k}", 100 - k, base) for k in range(2, 12)]
    bad = [read("dup", 95, at(5, "C"), flag=3 | 0x400), read("del", 95, base, cigar=[(0, 3), (2, 4), (0, 17)]), read("lowq", 95, at(5, "C"), qual="I" * 5 + "#" + "I" * 14)]
    pair = [read("m", 95, at(5, "C"), mate=99), read("m", 95, base, mate=99)]
    same = [read("s", 95, at(5, "C"), mate=99), read("s", 95, at(5, "C"), mate=99)]
    ragged = [read("low", 95, at(5, "C"), qual="I" * 4 + "#" + "I" * 15), read("imp", 95, at(5, "C"), flag=1)]
    calls = spark.createDataFrame([("1", 101, "C", ["PASS"]), ("1", 5000, "C", ["PASS"])], "chrom string, pos long, alt string, filter array<string>")
    got = {r.pos: r for r in reads.filter_by_read_support(calls, spark.createDataFrame(good + plain + bad + pair + same + ragged, READ)).collect()}
    assert (got[101].n_mut, got[101].n_ref, got[101].n_perfect, got[101].filter) == (len(good) + 1 + 2, len(plain), len(good) + 1, ["PASS"])
    assert got[5000].filter == ["perfmnad", "perfmnaf"] and got[5000].n_mut is None
    one = [read(f"e{k}", 99, at(1, "C"), flag=3) for k in range(9)]
    end = reads.filter_by_read_support(calls.where("pos = 101"), spark.createDataFrame(one, READ)).first()
    assert end.filter == ["pbias", "perfpbias", "perfsbias"]


def test_germline_bases_are_no_mismatches(spark):
    rows = spark.createDataFrame([read("a", 10, "ACGT"), read("b", 50, "ACGT")], READ).withColumn("reference", F.lit("AAAA"))
    calls = spark.createDataFrame([("1", 12, "C"), ("1", 12, "G"), ("1", 14, "C")], "chrom string, pos long, base string")
    known = reads.germline_places(rows, calls, ["read_name"])
    n = {r.read_name: (r.germline, r.n) for r in known.withColumn("n", reads.mismatches(F.col("seq"), F.col("reference"), F.col("germline"), F.lit(True))).collect()}
    assert n == {"a": ({1: ["C", "G"], 3: ["C"]}, 1), "b": ({}, 2)}


def test_realigned_modifications(spark):
    """Modifications that fail go only if another one passes."""
    som, edit = ("SOM", "A", "C"), ("TUM_EDIT", "A", "G")
    calls = spark.createDataFrame([("1", k, ["PASS"] if k < 4 else ["blck"], [som, edit]) for k in (1, 2, 3, 4)], "chrom string, pos long, filter array<string>, mods array<struct<type:string,src:string,tgt:string>>")
    judged = spark.createDataFrame([("1", 1, *som, True), ("1", 1, *edit, False), ("1", 2, *som, False), ("1", 3, *som, True), ("1", 3, *edit, True)], "chrom string, pos long, type string, src string, tgt string, passes boolean")
    got = {r.pos: (r.filter, [tuple(m) for m in r.mods]) for r in realign.filter_modifications(calls, judged).collect()}
    assert got == {1: (["PASS"], [som]), 2: (["blat"], [som, edit]), 3: (["PASS"], [som, edit]), 4: (["blat"], [som, edit])}
    kept = {r.pos: r.filter for r in realign.filter_modifications(calls, judged, keep_filters=True).collect()}
    assert kept[2] == ["blat"] and kept[4] == ["blat", "blck"]


def plain_merge(dna, rna, both, only):
    """The priority merge, place by place."""
    out = {}
    ok = lambda x: x is not None and "PASS" in x[0]
    for key in set(dna) | set(rna) | set(only):
        d, r, n = dna.get(key), rna.get(key), only.get(key)
        if d is not None and key in both:
            d = (d[0], d[1], [*d[2], *(["RNA"] if "RNA" not in d[2] else [])])
        current = d
        if n is not None:
            if ok(n):
                if not ok(d) or not {"GERM", "SOM"} & set(d[1]):
                    current = n
            elif d is None:
                current = n
            elif not ok(d):
                current = (sorted(set(d[0]) | set(n[0])), d[1], sorted(set(d[2]) | set(n[2])))
        if r is not None and not ok(r) and not ok(current):
            current = r if current is None else (sorted(set(current[0]) | set(r[0])), current[1], sorted(set(current[2]) | set(r[2])))
        if current is not None:
            out[key] = (sorted(current[0]), sorted(current[2]))
    return out


def test_priority_merge_with_rna_rows(spark):
    rng = random.Random(7)
    def side(origin, share):
        return {("1", k): (rng.choice([["PASS"], ["dtmnad"], ["rtmnbq", "x"]]), rng.choice([["SOM"], ["GERM"], ["TUM_EDIT"], ["TUM_EDIT", "SOM"]]), [origin]) for k in range(200) if rng.random() < share}
    dna, rna, only = side("DNA", 0.6), side("RNA", 0.6), side("RNA", 0.3)
    both = {k for k in dna if k in rna and rng.random() < 0.5}
    frame = lambda x: spark.createDataFrame([(*k, *v, []) for k, v in x.items()], "chrom string, pos long, filter array<string>, types array<string>, origin array<string>, mod_filters array<string>")
    got = merge.merge_rna_and_dna(frame(dna), frame(rna), frame({k: dna[k] for k in both}), frame(only)).collect()
    assert {(r.chrom, r.pos): (sorted(r.filter), sorted(r.origin)) for r in got} == plain_merge(dna, rna, both, only)


def test_filter_plan(spark):
    """The whole plan over small tables: both branches, interval steps, genes, overlay."""
    r = records(spark)
    bed = lambda rows: spark.createDataFrame(rows, "chrom string, start long, end long, name string")
    databases = {"blacklist": bed([("1", 0, 45, "ok")]), "dbsnp": bed([("1", 19, 20, "rs9")]), "cosmic": bed([("1", 9, 10, "c1"), ("1", 9, 11, "c2")])}
    plan = FilterPlan(databases)
    assert plan.steps() == ["interval:blacklist", "interval:dbsnp", "interval:cosmic", "support:rna", "support:dna", "compare", "support:dna:non_overlap", "rna_only", "merge"]
    out = {x.pos: x for x in plan.run(r).collect()}
    assert set(out) == {10, 20, 30, 40, 50}
    assert out[20].id == ["rs9"] and out[10].info["COSMIC"] == ["2"] and out[10].filter == ["PASS"] and out[40].filter == ["PASS"]
    assert sorted(out[40].origin) == ["DNA", "RNA"] and out[10].origin == ["DNA"] and "blck" in out[50].filter
    assert (out[10].sst, out[40].sst, out[20].sst) == tuple(merge_label for merge_label in (label(spark, "SOM", ["DNA"]), label(spark, "SOM", ["DNA", "RNA"]), label(spark, "GERM", ["DNA"])))
    dna = {x.pos: x.filter for x in FilterPlan(databases, dna_only=True).run(r).collect()}
    assert dna[10] == ["PASS"] and "rnacall" in dna[30]
    rna = {x.pos for x in FilterPlan(databases, rna_only=True).run(r).collect()}
    assert 30 in rna and 20 not in rna


def test_plan_carries_what_the_standing_branch_judged(spark):
    """Modifications, types, status and genotypes are those of the branch whose row stands, also where judging dropped or re-typed some."""
    r = calling.records(queries.obs(spark, "/root/testdata/sf0.001")).withColumns({"id": F.array().cast("array<string>"), "info": F.expr("map('SS', array('2'))")}).cache()
    plan = FilterPlan(dna=queries.DNA_LOW, rna=queries.RNA_LOW)
    key = lambda x: (x.chrom, x.pos)
    given = {key(x): [tuple(m) for m in x.mods] for x in r.collect()}
    d, q = ({key(x): x for x in judged(r, p).collect()} for p in (queries.DNA_LOW, queries.RNA_LOW))
    out = {key(x): x for x in plan.run(r).collect()}
    assert set(out) == set(given)
    changed, rescued = 0, 0
    for k, x in out.items():
        stands = d[k]
        if "PASS" in q[k].filter and "PASS" not in d[k].filter and x.filter == ["PASS"]:
            stands, rescued = q[k], rescued + 1
        assert [tuple(m) for m in x.mods] == [tuple(m) for m in stands.mods]
        assert (x.types, x.ss, x.somatic, x.final_type, x.dt_gt, x.rt_gt) == (stands.types, stands.ss, stands.somatic, stands.final_type, stands.dt_gt, stands.rt_gt)
        assert set(x.types) == {m[0] for m in x.mods}
        changed += [tuple(m) for m in x.mods] != given[k]
        both = "PASS" in d[k].filter and "PASS" in q[k].filter and "SOM" in d[k].types and "SOM" in q[k].types
        assert x.origin == (["RNA"] if stands is q[k] else ["DNA", "RNA"] if both else x.origin)
    assert changed > 20 and rescued > 3


def test_hits_decide_on_calls_that_only_rna_has(spark):
    """Realigned reads inside the plan: a call without valid reads fails, one with them keeps the passing modification and its types."""
    r = records(spark)
    only = FilterPlan().run(r).where("origin = array('RNA')").select("pos", "types").collect()
    assert [(x.pos, x.types) for x in only] == [(30, ["TUM_EDIT"])]
    row = lambda k, subject, score: ("rnaTumor", "1", 30, f"r{k}", 1, subject, 20, 40, score)
    schema = "sample string, chrom string, pos long, read_name string, flag int, subject string, s_start long, s_end long, score int"
    for subject, want in (("chr1", ["PASS"]), ("9", ["blat"])):
        found = spark.createDataFrame([row(k, subject, 30) for k in range(5)] + [row(9, "9", 40)], schema)
        plan = FilterPlan(realigned=lambda c, found=found: realign.filter_by_hits(c, found, ["rnaTumor"]))
        got = {x.pos: x for x in plan.run(r).collect()}
        assert ("PASS" in got[30].filter) == (want == ["PASS"]) and ("blat" in got[30].filter) == (want != ["PASS"])
        assert got[30].types == ["TUM_EDIT"]


def label(spark, kind, origin):
    return spark.range(1).select(merge.support_label(F.lit(kind), F.array(*map(F.lit, origin)))).first()[0]


def test_chromosomes_in_order(spark):
    rows = [("10", 3), ("2", 9), ("X", 1), ("2", 4), ("MT", 7), ("1", 8)]
    df = spark.createDataFrame(rows, "chrom string, pos long")
    assert [tuple(r) for r in merge.union_sorted([df, df.where("pos > 8")]).collect()] == [("1", 8), ("2", 4), ("2", 9), ("2", 9), ("10", 3), ("MT", 7), ("X", 1)]


def test_somatic_evidence_and_sums(spark):
    judged = support.judge(records(spark), support.DNA)
    assert tuple(support.somatic_evidence(judged).first()) == (2, 1, 1)
    counts = defaultdict(int)
    for r in judged.collect():
        counts[r.final_type] += 1
    assert counts["SOM"] == 2 and counts["GERM"] == 1
