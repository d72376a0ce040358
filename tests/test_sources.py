"""Readers and writers: golden pileup lines, round trips, header order, tables."""

from __future__ import annotations

import gzip
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from strandline.functions import fisher, strings
from strandline.operators import calling, reads
from strandline.plans.calling import call_pileups, call_records
from strandline.sources import pileup, tables, vcf


def test_golden_pileup_line():
    """Every kind of token; qualities run along bases, gaps and skips only. Fixed value: the line and its qualities."""
    row = pileup.decode('T$TT+3AGG^".GT+2AG+2AG,-2AGGG..-1A<<>>', "A", "01234567890", "IIIIIIIIIII")
    assert (row["ins"], row["del"], row["start"], row["stop"]) == (3, 2, 1, 1)
    assert [o["base"] for o in row["obs"]] == ["T", "T", "T", "A", "G", "T", "A", "G", "G", "A", "A"]
    assert [o["bq"] for o in row["obs"]] == [15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 15]
    assert [o["plus"] for o in row["obs"]] == [True] * 6 + [False] + [True] * 4
    # qualities that run out are -1, lower case is the minus strand, gaps use up a quality
    short = pileup.decode("a*cG", "N", "5", "5")
    assert [(o["base"], o["bq"], o["mq"], o["plus"]) for o in short["obs"]] == [("A", 20, 20, False), ("C", -1, -1, False), ("G", -1, -1, True)]
    assert pileup.decode("", "A", "", "")["obs"] == []


def test_decoder_is_a_plain_scan():
    """Random strings against a scan by character."""
    rng = random.Random(2)
    for _ in range(200):
        parts, bases = [], 0
        expected = {"ins": 0, "del": 0, "start": 0, "stop": 0}
        for _ in range(rng.randrange(12)):
            kind = rng.randrange(6)
            if kind == 0:
                n = rng.randrange(1, 13)
                sign = rng.choice("+-")
                parts.append(f"{sign}{n}" + "".join(rng.choice("ACGTacgt") for _ in range(n)))
                expected["ins" if sign == "+" else "del"] += 1
            elif kind == 1:
                parts.append("^" + rng.choice("!+5^$~"))
                expected["start"] += 1
            elif kind == 2:
                parts.append("$")
                expected["stop"] += 1
            else:
                parts.append(rng.choice("ACGTacgt.,"))
                bases += 1
        got = pileup.decode("".join(parts), "C", "I" * 99, "I" * 99)
        assert {k: got[k] for k in expected} == expected and len(got["obs"]) == bases


TOKEN = re.compile(r"\^.|\$|[+-](\d+)|.", re.S)


def plain_decode(reads, ref, base_quals, map_quals):
    """Token by token."""
    n, obs, at, k = dict.fromkeys("+-^$", 0), [], 0, 0
    while at < len(reads):
        m = TOKEN.match(reads, at)
        token, at = m[0], m.end()
        if token[0] in n and (token[0] in "^$" or m[1]):
            n[token[0]] += 1
            at += int(m[1]) if m[1] else 0
            continue
        have = k < len(base_quals) and k < len(map_quals)
        q = (ord(base_quals[k]) - 33, ord(map_quals[k]) - 33) if have else (-1, -1)
        k += 1
        base = ref if token in ".," else token.upper()
        if base in ("A", "C", "G", "T"):
            obs.append((base, *q, token == "." or token.isupper()))
    return (n["+"], n["-"], n["^"], n["$"]), obs


def test_batches_are_decoded_token_by_token(spark):
    """Rows of any bytes, indels and read starts inside and at the end of others, and qualities that run out."""
    rng = random.Random(5)
    rows = [("1", k, rng.choice("ACGTN"), 1, "".join(rng.choice("ACgt.,^^$+-*<N0123") for _ in range(rng.randrange(40))), "I5#" * rng.randrange(8), "?J" * rng.randrange(12)) for k in range(400)]
    rows += [("1", 400, None, 1, None, None, None), ("1", 401, "A", 1, "", "", ""), ("1", 402, "C", 1, "^", "I", "I"), ("1", 403, "C", 1, "..+99999999999999999999A", "III", "III"), ("1", 404, "C", 1, "^^^+2AC.-1", "III", "III")]
    out = pileup.with_decoded(spark.createDataFrame(rows, pileup.SCHEMA)).collect()
    for r in out:
        counts, obs = plain_decode(r.reads or "", r.ref or "", r.base_quals or "", r.map_quals or "")
        p = r.pileup
        assert ((p.ins, p["del"], p.start, p.stop), [tuple(o) for o in p.obs]) == (counts, obs), r
    assert sum(len(r.pileup.obs) for r in out) > 2000


def test_pileup_file_to_calls(spark, tmp_path):
    """Two samples from text to calls with insertions, deletions, starts and stops; tool lines and blank lines are no rows."""
    q = "I" * 20
    normal = ["[mpileup] 1 samples", "", f"1\t10\ta\t12\t{'.' * 12}\t{q[:12]}\t{q[:12]}", f"1\t11\tC\t8\t........\t{q[:8]}\t{q[:8]}", f"1\t12\tN\t8\tAAAAAAAA\t{q[:8]}\t{q[:8]}"]
    tumor = ["<mpileup> x", f"1\t10\tA\t12\t.......^I.t+2AAt-1Gt$t\t{q[:12]}\t{q[:12]}", f"1\t11\tG\t8\tTTTTTTTT\t{q[:8]}\t{q[:8]}"]
    for name, lines in (("n", normal), ("t", tumor)):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = {s: pileup.read_pileup(spark, str(tmp_path / k)) for s, k in (("DNA_NORMAL", "n"), ("DNA_TUMOR", "t"))}
    assert [r.pos for r in pileup.read_pileup(spark, str(tmp_path / "n"), "1", 11, 11).collect()] == [11]
    called = call_pileups(rows).collect()
    assert [(r.chrom, r.pos, r.ref, [tuple(m) for m in r.mods]) for r in called] == [("1", 10, "A", [("SOM", "A", "T")])]
    obs = pileup.observations(rows["DNA_NORMAL"], "DNA_NORMAL").unionByName(pileup.observations(rows["DNA_TUMOR"], "DNA_TUMOR"))
    codes = calling.reference_codes(obs)
    assert {(r.pos, tuple(r.ref_codes)) for r in codes.select("pos", "ref_codes").distinct().collect()} == {(10, ()), (11, ("diffref",)), (12, ("noref",))}
    every = calling.emitted(calling.calls(obs, output_all=True), codes, output_all=True).select("pos", "ref", "filter").collect()
    assert {(r.pos, tuple(r.filter)) for r in every} >= {(10, ("PASS",)), (11, ("diffref",))} and any(r.filter[0] == "noref" for r in every)
    assert [r.pos for r in calling.emitted(calling.calls(obs), codes).collect()] == [10]
    sites = pileup.site_counts(rows["DNA_TUMOR"], "DNA_TUMOR")
    rec = calling.records(calling.consistent_reference(obs), sites=sites).first()
    assert (rec.dt.ins, getattr(rec.dt, "del"), rec.dt.start, rec.dt.stop, rec.dn.ins) == (1, 1, 1, 1, 0)
    assert rec.alleles == ["A", "T"] and rec.dt.ad == [8, 4] and rec.dt.dp4 == [8, 0, 0, 4]


HEADER = ["##fileformat=VCFv4.1", "##zeta=1", "##alpha=2", '##INFO=<ID=B,Number=1,Type=String,Description="b, c">', '##INFO=<ID=A,Number=1,Type=String,Description="a">', "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tDNA_NORMAL\tDNA_TUMOR"]
LINES = [
    "2\t7\t.\tA\tC,T\t0\tPASS\tDB;SS=2\tGT:DP:AD\t0/1:9:4,5,0\t./.",
    "10\t3\trs1;rs2\tG\t.\t.\tblck;dnmndp\tMT=SOM,GERM\tGT:DP:AD\t0/0:.:.\t0/0:3:3",
    "Y\t5\t.\tG\tA\t2.5\tPASS\t.\tGT:DP:AD\t.\t1:3:0,3",
]


def test_vcf_round_trip(spark, tmp_path):
    """Header and records come back in order, from parts that make one file."""
    (tmp_path / "in.vcf").write_text("\n".join([*HEADER, LINES[2], LINES[1], LINES[0]]) + "\n")
    (tmp_path / "in.vcf.gz").write_bytes(gzip.compress((tmp_path / "in.vcf").read_bytes()))
    samples = vcf.sample_columns(vcf.read_header(spark, str(tmp_path / "in.vcf")))
    assert vcf.read_header(spark, str(tmp_path / "in.vcf.gz")) == HEADER and samples == ["DNA_NORMAL", "DNA_TUMOR"]
    records = vcf.read_vcf(spark, str(tmp_path / "in.vcf.gz"), samples)
    out = str(tmp_path / "out")
    vcf.write_vcf(records, samples, HEADER, out)
    text = "".join(f.read_text() for f in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines() == [*HEADER, LINES[0], LINES[1].replace("0/0:.:.", "0/0:.:."), LINES[2]]
    again = vcf.read_vcf(spark, out, samples)
    assert sorted(map(str, again.collect())) == sorted(map(str, records.collect()))
    vcf.write_vcf(records.where("chrom = '2'"), samples, HEADER, out, mode="append")
    assert vcf.read_vcf(spark, out, samples).count() == 4 and vcf.read_vcf(spark, out, samples, passing_only=True).count() == 3
    one = {r.chrom: r for r in records.collect()}
    assert one["10"].alt == [] and one["10"].qual is None and one["10"].id == ["rs1", "rs2"] and one["2"].dna_tumor is None
    # a lone dot stands for every allele under AD, for itself under DP
    assert one["10"].dna_normal["DP"] == ["."] and one["10"].dna_normal["AD"] == ["."]
    assert one["2"].info == {"DB": ["True"], "SS": ["2"]}


def test_lone_dots(spark):
    row = spark.createDataFrame([("./.:.:.:.:.", "GT:DP:AD:INS:BQ")], "s string, k string")
    got = row.select(strings.parse_sample(F.col("s"), F.split("k", ":"), F.lit(3)).alias("m")).first().m
    assert got == {"GT": [".", "."], "DP": ["."], "AD": [".", ".", "."], "INS": ["."], "BQ": [".", ".", "."]}


def test_headers(spark):
    merged = vcf.merge_headers([HEADER, [*HEADER[:2], "##SAMPLE=<ID=DNA_NORMAL>", '##FILTER=<ID=q,Description="low">', HEADER[-1]]])
    assert merged[0] == HEADER[0] and merged[-1] == HEADER[-1] and len(merged) == 8
    assert [h for h in merged if h.startswith("##INFO")] == [HEADER[4], HEADER[3]] and merged.index("##SAMPLE=<ID=DNA_NORMAL>") < merged.index('##FILTER=<ID=q,Description="low">')
    made = vcf.header_lines(["DNA_NORMAL", "DNA_TUMOR"], {"fasta": "hg19.fa", "rnaTumor": "a,b"}, {"blck": "mask"}, {"SS": ("1", "Integer", "type")})
    assert vcf.generator_params(made) == {"fasta": "hg19.fa", "rnaTumor": "a,b"} and vcf.sample_columns(made) == ["DNA_NORMAL", "DNA_TUMOR"]
    assert "##PEDIGREE=<Derived=DNA_TUMOR,Original=DNA_NORMAL>" in made
    with pytest.raises(vcf.HeaderError):
        vcf.sample_columns(HEADER[:-1])
    with pytest.raises(vcf.HeaderError):
        vcf.sample_columns(["#POS\tCHROM"])


def test_paths_are_checked(tmp_path):
    (tmp_path / "a").write_text("x")
    vcf.check_paths([str(tmp_path / "a")], str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        vcf.check_paths([str(tmp_path / "b")])
    with pytest.raises(FileNotFoundError):
        vcf.check_paths([], str(tmp_path / "no" / "out"))


def test_tables(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    bed = tables.read_bed(spark, put("a.bed", "#c\nchr1\t0\t5\tx\n2\t3\t9\n"))
    assert {tuple(r) for r in bed.collect()} == {("chr1", 0, 5, "x"), ("2", 3, 9, "")}
    tables.write_bed(bed, str(tmp_path / "bed"))
    assert {tuple(r) for r in tables.read_bed(spark, str(tmp_path / "bed")).collect()} == {tuple(r) for r in bed.collect()}
    assert {r.entry for r in tables.read_list(spark, put("l", "#x\nA\n\n B \nA\n")).collect()} == {"A", "B"}
    assert [tuple(r) for r in tables.read_coordinates(spark, put("c", "#x\n1\t5\t9\n")).collect()] == [("1", 5, 9)]
    fai = tables.read_fai(spark, put("f.fai", "chr1\t100\t6\t60\t61\nM\t16\t9\t60\t61\n"))
    assert (tables.chrom_size(fai, "1"), tables.chrom_size(fai, "M"), tables.chrom_size(fai, "9")) == (100, 16, -1)
    ref = tables.read_reference(spark, put("r.fa", ">1 first\nACg\nT\n\n>2\nNN\nA\n"))
    assert sorted((r.chrom, r.pos, r.base) for r in ref.collect()) == [*zip("1111", (1, 2, 3, 4), "ACGT"), *zip("222", (1, 2, 3), "NNA")]
    hit = "N_1_20_r1_A_30_40_99_50"
    blast = tables.read_hits(spark, put("h", f"{hit}\tchr1\t98.5\t50\t1\t0\t1\t50\t10\t60\t1e-20\t90\n")).first()
    assert (blast.sample, blast.chrom, blast.pos, blast.base, blast.flag, blast.read_length, blast.evalue) == ("N", "1", 20, "A", 99, 50, 1e-20)
    psl = "\t".join(map(str, [48, 1, 2, 0, 1, 3, 1, 4, "+", hit, 50, 0, 50, "1", 1000, 9, 60, 2, "20,30,", "0,20,", "9,30,"]))
    assert tables.read_hits(spark, put("p", psl + "\n"), form="psl").first().score == 47
    maf = "#v\nHugo_Symbol\ta\tb\tc\tChromosome\ts\te\nG\t1\tx\ty\t7\t5\t6\nG\t1\tx\ty\t7\t5\tno\n"
    assert [tuple(r) for r in tables.read_maf(spark, put("m", maf)).collect()] == [("7", 6)]
    assert tables.read_validation(spark, put("v", "1\t4\t5\tA\tC\tx\tok\n")).first().pos == 5
    assert tables.read_simulation(spark, put("s", "snv\t1\t4\t5\t0.2\t5\tA>C\t9\t9\t0.2\t0.3\n")).first().pos == 5
    vcf.write_table(spark.createDataFrame([("1", 5)], "chrom string, germ long"), str(tmp_path / "t"))
    vcf.write_table(spark.createDataFrame([("2", 6)], "chrom string, germ long"), str(tmp_path / "t"), mode="append")
    assert spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "t")).count() == 2


def test_query_sequences_and_text(spark):
    rows = spark.createDataFrame([("1", 5, "r_1", "A", 30, 40, 99, "ACGT")], "chrom string, pos long, read_name string, base string, bq int, mapq int, flag int, seq string")
    assert reads.query_sequences(rows, "rnaTumor").first().value == "> rnaTumor_1_5_r1_A_30_40_99_4\nACGT"
    one = spark.createDataFrame([('##SAMPLE=<ID=N,x=1>', "/d/TCGA-AB-1234-01A-x.bam", 0.000123)], "l string, b string, p double")
    got = one.select(strings.meta_id(F.col("l")), strings.meta_key(F.col("l")), strings.barcode(F.col("b")), fisher.p_text(F.col("p")), strings.phred(F.lit("I"))).first()
    assert tuple(got) == ("N", "SAMPLE", "TCGA-AB-1234-01A-x", "1.23e-04", 40)


def test_log_factorials_at_any_depth(spark):
    n = [-3, 0, 1, 2, 15, 16, 17, 40, 1000, 8000, 123456]
    got = spark.createDataFrame([(k,) for k in n], "n long").select("n", fisher.log_factorial(F.col("n")).alias("v")).collect()
    assert all(abs(r.v - math.lgamma(max(r.n, 0) + 1)) <= 2e-14 * max(1, math.lgamma(max(r.n, 0) + 1)) for r in got)


def test_pileups_to_records_with_the_site(spark):
    """From pileup rows to INFO: counts and shares in the order of the alternates, edges of reads over the samples, unsure places on demand."""
    q = lambda n: "I" * n
    normal = [("1", 10, "A", 12, "." * 10 + "^I.$.", q(12), q(12)), ("1", 11, "N", 8, "." * 8, q(8), q(8)), ("1", 12, "C", 8, "." * 8, q(8), q(8))]
    tumor = [("1", 10, "A", 20, "." * 8 + "C" * 7 + "g" * 4 + "+2AC^I.", q(20), q(20)), ("1", 11, "N", 8, "T" * 8, q(8), q(8)), ("1", 12, "G", 8, "." * 8, q(8), q(8))]
    frames = {"DNA_NORMAL": spark.createDataFrame(normal, pileup.SCHEMA), "DNA_TUMOR": spark.createDataFrame(tumor, pileup.SCHEMA)}
    (r,) = call_records(frames).collect()
    alts = r.alts
    assert sorted(alts) == ["C", "G"] and r.site.dp == 32
    count = {"C": 7, "G": 4}
    assert r.info["AC"] == [str(count[b]) for b in alts] and r.info["AF"] == [{"C": "0.22", "G": "0.13"}[b] for b in alts]  # 4 / 32 rounds half up
    assert {k: r.info[k] for k in ("NS", "AN", "DP", "INS", "DEL", "START", "STOP", "MQ0", "BQ", "SB", "FA", "VT", "SS")} == {
        "NS": ["2"], "AN": ["3"], "DP": ["32"], "INS": ["1"], "DEL": ["0"], "START": ["2"], "STOP": ["1"], "MQ0": ["0"], "BQ": ["40"], "SB": [str(round(28 / 32, 2))], "FA": [str(round(11 / 32, 2))], "VT": ["SNP"], "SS": ["2"],
    }
    assert r.info["SOMATIC"] == ["True"] and r.info["MT"] == ["SOM"] * len(r.mods) and r.info["MC"] == [f"A>{m.tgt}" for m in r.mods]
    every = {x.pos: x["filter"] for x in call_pileups(frames, output_all=True, unsure=True).collect()}
    assert every[10] == ["PASS"] and "noref" in every[11] and "diffref" in every[12] and "PASS" not in every[11] + every[12]
    assert {x.pos for x in call_pileups(frames, output_all=True).collect()} == {10}


def test_info_keeps_its_order_on_rewrite(spark, tmp_path):
    line = LINES[0].split("\t")
    line[7] = "SS=2;DB;AC=5,1;MT=SOM;AB=x"
    (tmp_path / "a.vcf").write_text("\n".join([*HEADER, "\t".join(line)]) + "\n")
    r = vcf.read_vcf(spark, str(tmp_path / "a.vcf"), vcf.sample_columns(HEADER))
    assert vcf.format_lines(r, vcf.sample_columns(HEADER), info_sorted=False).first().value.split("\t")[7] == line[7]
    assert vcf.format_lines(r, vcf.sample_columns(HEADER)).first().value.split("\t")[7] == "AB=x;AC=5,1;DB;MT=SOM;SS=2"
    vcf.write_vcf(r, vcf.sample_columns(HEADER), HEADER, str(tmp_path / "out"), info_sorted=False)
    text = "".join(f.read_text() for f in sorted((tmp_path / "out").glob("part-*")))
    assert text.splitlines()[-1].split("\t")[7] == line[7]


def test_sample_lines_and_chromosome_files(spark, tmp_path):
    own = {"DNA_NORMAL": vcf.sample_line("DNA_NORMAL", "P1", "/d/TCGA-AB-1234-01A-11D.bam", "normal", "DNA"), "DNA_TUMOR": vcf.sample_line("DNA_TUMOR", "P1", "/d/t.bam", "tumor", "DNA", platform="x", source="y")}
    made = vcf.header_lines(own, {"fasta": "hg19.fa"})
    assert own["DNA_TUMOR"] == '##SAMPLE=<ID=DNA_TUMOR,SampleName=P1,Individual=P1,Description="tumor",File="/d/t.bam",Analyte="DNA",Platform="x",Source="y">'
    assert vcf.parse_meta(own["DNA_NORMAL"])[1]["SampleName"].startswith("TCGA-AB-1234") and set(own.values()) <= set(made)
    assert vcf.sample_columns(made) == ["DNA_NORMAL", "DNA_TUMOR"] and "##PEDIGREE=<Derived=DNA_TUMOR,Original=DNA_NORMAL>" in made
    (tmp_path / "chr1.bed").write_text("1\t0\t5\n")
    assert tables.chromosome_file(spark, str(tmp_path), "1").endswith("chr1.bed")
    with gzip.open(tmp_path / "chr1.bed.gz", "wt") as f:
        f.write("1\t0\t9\n")
    assert tables.read_bed(spark, tables.chromosome_file(spark, str(tmp_path), "1")).first().end == 9
    with pytest.raises(FileNotFoundError):
        tables.chromosome_file(spark, str(tmp_path), "2")
