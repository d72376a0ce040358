"""Calls judged by reads, against a plain Python walk over every read and base."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from strandline.operators import read_evidence as E
from strandline.sources import reference

CALL = "chrom string, pos long, ref string, alleles array<string>, filter array<string>, origin array<string>, mods array<struct<type:string,src:string,tgt:string>>, ss int, tx_names array<string>, tx_coords array<long>, tx_strands array<string>, id long"
READ = "sample string, chrom string, start long, read_name string, flag int, mapq int, cigar array<struct<op:int,len:int>>, mate_start long, seq string, qual string, pos string"
PAIR = dict(zip("ACGTN", "TGCAN", strict=True))


def round2(a, b):
    return float(Decimal(a / b).quantize(Decimal("0.01"), ROUND_HALF_UP))


def genome(seed=1):
    rng = random.Random(seed)
    out = {c: "".join(rng.choice("ACGT") for _ in range(400)) for c in ("1", "2")}
    out["T1"] = out["1"][100:260]
    out["T2"] = "".join(PAIR[b] for b in reversed(out["1"][120:300]))
    return out


def locus(g, c, name):
    """Where a place of chromosome 1 (1-based) lies on a transcript."""
    return c - 100 if name == "T1" else 300 - c + 1


def make(seed=2, n_reads=1500):
    rng, g = random.Random(seed), genome()
    calls, reads = [], []
    for k, pos in enumerate(range(20, 390, 10)):
        for chrom in ("1", "2"):
            ref = g[chrom][pos - 1]
            alts = [b for b in "ACGT" if b != ref]
            rng.shuffle(alts)
            ss = rng.choice([1, 2, 2, 4, 4, 3])
            kinds = {1: ["GERM"], 2: ["SOM"], 3: ["LOH"], 4: rng.choice([["TUM_EDIT"], ["NOR_EDIT"], ["NOR_EDIT", "TUM_EDIT"]])}[ss]
            if ss == 4 and ref == "A":
                alts = ["G", *[b for b in alts if b != "G"]]
            mods = [(t, ref, alts[i % 2]) for i, t in enumerate(kinds)]
            origin = ["RNA"] if ss == 4 else rng.choice([["DNA"], ["RNA"], ["DNA", "RNA"]])
            tx = (None, None, None)
            if chrom == "1" and 130 < pos < 250 and k % 2:
                names = rng.choice([["T1"], ["T2"], ["T1", "T2"]])
                tx = (names, [locus(g, pos, t) for t in names], ["+" if t == "T1" else "-" for t in names])
            calls.append((chrom, pos, ref, [ref, *alts[:2]], rng.choice([["PASS"], ["PASS"], ["PASS"], ["blck"]]), origin, mods, ss, *tx, k))
    known = {(c[0], c[1]): c[6][0][2] for c in calls if c[7] in (1, 3)}
    for i in range(n_reads):
        chrom = rng.choice(["1", "1", "2", "T1", "T2"])
        sample = rng.choice(["RNA_TUMOR", "RNA_NORMAL"]) if chrom[0] == "T" else rng.choice(["DNA_TUMOR", "RNA_TUMOR", "RNA_NORMAL"])
        cigar = rng.choice([[(0, 30)]] * 6 + [[(4, 2), (0, 28)], [(4, 5), (0, 25)], [(0, 10), (3, 20), (0, 20)], [(0, 15), (1, 2), (0, 13)], [(0, 12), (2, 3), (0, 18)], [(7, 20), (8, 10)], [(5, 4), (0, 27), (4, 3)], [(0, 9), (6, 1), (0, 21)]])
        start = rng.randrange(0, len(g[chrom]) - 70)
        seq, r = "", start
        for op, n in cigar:
            if op in (0, 7, 8):
                seq += g[chrom][r : r + n]
            elif op in (1, 4):
                seq += "".join(rng.choice("ACGT") for _ in range(n))
            r += n if op in (0, 2, 3, 7, 8) else 0
        bases, noise = list(seq), rng.choice([0.01, 0.03, 0.15])
        for j in range(len(bases)):  # variants at calls, and noise
            u = rng.random()
            if u < noise:
                bases[j] = rng.choice("ACGTN")
        r, q = start, 0
        for op, n in cigar:
            for d in range(n if op in (0, 7, 8) else 0):
                at = next((c for c in calls if ((c[0] == chrom and c[1] == r + d + 1) or (c[8] and any(t == chrom and x == r + d + 1 for t, x in zip(c[8], c[9], strict=True))))), None)
                if at and rng.random() < 0.5:
                    alt = rng.choice(at[6])[2]
                    bases[q + d] = PAIR[alt] if chrom == "T2" else alt
            r += n if op in (0, 2, 3, 7, 8) else 0
            q += n if op in (0, 1, 4, 7, 8) else 0
        quals = [rng.choice([12, 30, 35, 40]) for _ in bases]
        if rng.random() < 0.25:
            quals[rng.randrange(len(quals))] = 4
        flags = rng.choice([3, 3, 3, 3, 1]) | rng.choice([0, 16]) | rng.choice([0, 0, 0, 0x100]) | rng.choice([0] * 12 + [0x200, 0x400, 0x4])
        reads.append((sample, chrom, start, f"r{i // 2 if i % 3 else i}", flags, rng.choice([5, 20, 40, 60]), cigar, start + rng.choice([0, 3, 500]), "".join(bases), "".join(chr(x + 33) for x in quals), "x"))
    return g, calls, known, reads


def brute_lane(g, known, call, mod, dna, reads, p):
    """Sums and codes of one modification, one origin."""
    chrom, pos, *_ = call
    kind, src, tgt = mod
    sample = ("DNA_TUMOR" if dna else "RNA_TUMOR") if call[7] == 2 else {"NOR_EDIT": "RNA_NORMAL", "TUM_EDIT": "RNA_TUMOR"}[kind]
    places = list(zip(*call[8:11], strict=True)) if call[8] and not dna else [(chrom, pos, None)]
    by_name: dict = {}
    for name, at, strand in places:
        for x in reads:
            s, c, start, read, flags, mapq, cigar, mate, seq, qual, _ = x
            if s != sample or c != name or flags & 0x604 or (not dna and flags & 0x100):
                continue
            r, q, hit = start, 0, None
            for i, (op, n) in enumerate(cigar):
                if op in (0, 2, 3, 7, 8) and r <= at - 1 < r + n:
                    if op in (0, 7, 8):
                        after = cigar[i + 1][0] if i + 1 < len(cigar) else None
                        hit = None if at - 1 == r + n - 1 and after in (1, 2) else q + at - 1 - r
                    break
                r += n if op in (0, 2, 3, 7, 8) else 0
                q += n if op in (0, 1, 4, 7, 8) else 0
            if hit is None:
                continue
            own = PAIR[seq[hit]] if strand == "-" else seq[hit]
            if own in (src, tgt):
                by_name.setdefault(read, []).append((x, hit, own, strand))
    kept = []
    for group in by_name.values():
        if len(group) == 1:
            kept += group
            continue
        over = []
        for e in group:
            x, hit, *_ = e
            (over if abs(x[2] + hit - x[7]) < len(x[8]) else kept).append(e)
        quals = sorted((ord(x[9][hit]) - 33 for x, hit, *_ in over), reverse=True)
        if over and (len({x[8][hit] for x, hit, *_ in over}) == 1 or (quals[0] >= 10 and (len(quals) < 2 or quals[1] < 10))):
            best = [e for e in over if ord(e[0][9][e[1]]) - 33 == quals[0]]
            loci = {(n, s): k for k, (n, _, s) in enumerate(places)}
            kept.append(min(best, key=lambda e: (e[0][8][e[1]], e[1], e[0][4], e[0][5], loci[(e[0][1], e[3])], e[0][2], e[0][9], e[0][6], e[0][8])))
    n = dict.fromkeys(["n_mut", "n_ref", "n_good", "n_low", "n_mut2", "n_ref2", "n_perfect", "p_plus", "n_start", "n_end", "p_start", "p_end", *[f"n_{w}" for w in E.REASONS]], 0)
    for x, hit, own, strand in kept:
        _, c, start, _, flags, mapq, cigar, _, seq, qual, _ = x
        second = bool(flags & 0x100)
        if own != tgt:
            n["n_ref"] += 1
            n["n_ref2"] += second
            continue
        n["n_mut"] += 1
        n["n_mut2"] += second
        if mapq < 10 or ord(qual[hit]) - 33 < 10:
            n["n_low"] += 1
            continue
        n["n_good"] += 1
        part = hit / len(seq)
        place = "start" if part <= 0.33 else "middle" if part <= 0.66 else "end"
        if place != "middle":
            n[f"n_{place}"] += 1
        ops = {op for op, _ in cigar}
        why = "improperpair" if dna and not flags & 2 else "insertion" if 1 in ops else "deletion" if 2 in ops else "neighborbq" if any(ord(z) - 33 < 10 for z in qual[max(0, hit - 5) : hit + 6]) else None
        if why is None:
            r = start
            q = muts = clip = 0
            for op, k in cigar:
                if op in (0, 8):
                    for d in range(k):
                        b, ref = seq[q + d], g[c][r + d]
                        own_b = PAIR[b] if strand == "-" else b
                        if b != ref and own_b not in known.get((c, r + d + 1), ()) and not (call[7] == 4 and ref == "A" and b == "G"):
                            muts += 1
                clip += k if op == 4 else 0
                r += k if op in (0, 2, 3, 7, 8) else 0
                q += k if op in (0, 1, 4, 7, 8) else 0
                if muts >= 4:
                    why = "maxmuts"
                elif round2(clip, len(seq)) >= 0.10:
                    why = "maxsoftclip"
                if why:
                    break
        if why:
            n[f"n_{why}"] += 1
            continue
        n["n_perfect"] += 1
        n["p_plus"] += not flags & 16
        if place != "middle":
            n[f"p_{place}"] += 1
    codes = set()
    if n["n_mut"] >= 4 and round2(n["n_mut2"], n["n_mut"]) >= 0.90:
        codes.add("mxmmp")
    if n["n_perfect"] >= 4:
        forward = round2(n["p_plus"], n["n_perfect"])
        if forward > 0.9 or forward < 1.0 - 0.9:
            codes.add("perfsbias")
    for a, b, code in (("n", "n_good", "pbias"), ("p", "n_perfect", "perfpbias")):
        if n[b] >= 4 and max(round2(n[f"{a}_start"], n[b]), round2(n[f"{a}_end"], n[b])) >= 0.95:
            codes.add(code)
    if n["n_perfect"] < 4:
        codes.add("perfmnad")
    if n["n_mut"] + n["n_ref"] and round2(n["n_perfect"], n["n_mut"] + n["n_ref"]) < 0.10:
        codes.add("perfmnaf")
    return sample, n, codes


def brute(g, calls, reads, passing_only=True):
    known: dict = {}
    for c in calls:
        if c[7] in (1, 3) and "PASS" in c[4]:
            for place in [(c[0], c[1]), *(zip(c[8], c[9], strict=True) if c[8] else [])]:
                known.setdefault(place, set()).update(m[2] for m in c[6])
    out, sums = {}, {}
    for c in calls:
        key, filters = (c[0], c[1]), set(c[4])
        if c[7] not in (2, 4) or (passing_only and "PASS" not in filters):
            out[key] = (sorted(filters), None)
            continue
        dna, rna, mmp = set(), set(), {}
        for origin in c[5]:
            if origin == "RNA" and dna == {"PASS"}:
                continue
            for k, m in enumerate(c[6][:1] if origin == "DNA" else c[6]):
                sample, n, codes = brute_lane(g, known, c, m, origin == "DNA", reads, None)
                sums[(*key, origin, k)] = (n, codes)
                (dna if origin == "DNA" else rna).update(codes or {"PASS"})
                share = {m[1]: round2(n["n_ref2"], n["n_ref"]) if n["n_ref"] else 0.0, m[2]: round2(n["n_mut2"], n["n_mut"]) if n["n_mut"] else 0.0}
                mmp[sample] = [share.get(b, 0.0) for b in c[3]]
        if "PASS" in dna | rna:
            filters = {"PASS"}
        else:
            filters = dna | rna if "PASS" in filters else filters | dna | rna
        out[key] = (sorted(filters), mmp)
    return out, sums


@pytest.fixture(scope="module")
def made(spark):
    g, calls, _, reads = make()
    ref = reference.packed(spark.createDataFrame([(c, 0, s) for c, s in g.items()], "chrom string, begin long, value string"))
    return g, calls, reads, spark.createDataFrame(calls, CALL), spark.createDataFrame(reads, READ).repartition(3), ref


@pytest.mark.parametrize("passing_only", [True, False])
def test_filters_are_brute_force(made, passing_only):
    g, calls, reads, c, r, ref = made
    want, sums = brute(g, calls, reads, passing_only)
    out = E.filter_by_reads(c, r, ref, p=E.ReadLimits(passing_only=passing_only))
    assert set(out.columns) == {*c.columns, "mmp", "pn", "nn"}
    got = {(x.chrom, x.pos): (sorted(x["filter"]), x.mmp) for x in out.collect()}
    assert got == want
    codes = {f for f, _ in want.values() for f in f}
    assert {"PASS", "perfmnad", "blck"} <= codes
    if passing_only:
        assert sum(n["n_maxmuts"] for n, _ in sums.values()) > 20 and sum(n["n_maxsoftclip"] for n, _ in sums.values()) > 5


def test_lanes_are_brute_force(made):
    g, calls, reads, c, r, ref = made
    _, sums = brute(g, calls, reads)
    judged = c.where("array_contains(filter, 'PASS')")
    got = E.lane_evidence(judged, r, ref, E.germline_bases(c))
    by = {(x.call_chrom, x.call_pos, x.lane, x.mod): x for x in got.collect()}
    assert set(sums) <= set(by)
    for key, (n, codes) in sums.items():
        assert {f: by[key][f] for f in n} == n, key
        assert set(by[key].codes) == codes


def test_neighbours_come_from_the_place_judged_last(made):
    g, calls, _, c, r, ref = made
    for x in E.filter_by_reads(c, r, ref).where("mmp IS NOT NULL").collect():
        own = (g[x.chrom][x.pos - 2], g[x.chrom][x.pos])
        tx = (g[x.tx_names[0]][x.tx_coords[0] - 2], g[x.tx_names[0]][x.tx_coords[0]]) if x.tx_names and x.mmp.keys() - {"DNA_TUMOR"} else own
        assert (x.pn, x.nn) == tx


def test_calls_without_reads_and_no_rows(spark, made):
    *_, c, r, ref = made
    none = E.filter_by_reads(c.where("ss = 2 AND array_contains(filter, 'PASS')").limit(3), r.limit(0), ref)
    assert all(x["filter"] == ["perfmnad"] and all(v == 0 for s in x.mmp.values() for v in s) for x in none.collect())
    assert E.filter_by_reads(c.limit(0), r, ref).count() == 0


def test_common_alignments_are_compared_once(spark, made):
    """Equal alignments under many names give one row to the comparison, and all count."""
    g, *_, c, _, ref = made
    call = [("1", 50, g["1"][49], [g["1"][49]], ["PASS"], ["DNA"], [("SOM", g["1"][49], PAIR[g["1"][49]])], 2, None, None, None, 1)]
    seq = g["1"][40:49] + PAIR[g["1"][49]] + g["1"][50:70]
    rows = [("DNA_TUMOR", "1", 40, f"r{i}", 3 | 16 * (i % 2), 60, [(0, 30)], 600, seq, "I" * 30, "x") for i in range(500)]
    calls, reads = spark.createDataFrame(call, CALL), spark.createDataFrame(rows, READ)
    (lane,) = E.lane_evidence(calls, reads, ref).collect()
    assert (lane.n_mut, lane.n_perfect, lane.p_plus) == (500, 500, 250)


def test_deep_places_are_dealt_in_parts(spark, made):
    """The same verdicts with bins dealt in parts, and no part with more than a few times its share of the reads."""
    from pyspark.sql import functions as F

    from strandline.operators import intervals

    *_, c, r, ref = made
    rows = lambda p: sorted((x.chrom, x.pos, tuple(x["filter"]), str(x.mmp)) for x in E.filter_by_reads(c, r, ref, p=p).collect())
    assert rows(E.ReadLimits(deep=40)) == rows(E.ReadLimits())
    pile = spark.range(5000).select(F.lit("1").alias("chrom"), F.lit(10).cast("long").alias("start"), F.lit(40).cast("long").alias("end"), F.col("id").alias("read"))
    one = spark.createDataFrame([("1", 20), ("1", 39), ("1", 50), ("2", 20)], "chrom string, pos long")
    parts = intervals.deep_bins(pile.select(F.col("chrom").alias("_chrom"), F.lit(0).alias("_bin")), 100).collect()
    assert [tuple(x) for x in parts] == [("1", 0, 50)]
    got = intervals.near_positions(one, pile, "start", "end", deep=100)
    assert got.columns == [*one.columns, "start", "end", "read"]
    assert sorted((x.pos, x["count"]) for x in got.groupBy("pos").count().collect()) == [(20, 5000), (39, 5000)]
