"""Packed references: files of several splits, with and without an index, and stretches of bases."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandline.sources import reference, tables


def fasta(seed, eol, width=11):
    """Text, index lines and sequences by name."""
    rng = random.Random(seed)
    sizes = [0, 1, width, width * 40, width * 40 + 3, 5, 700, width * 2, 0, 9]
    text, index, own = "", [], {}
    for k, n in enumerate(sizes):
        seq = "".join(rng.choice("ACGTacgtN") for _ in range(n))
        text += f">s{k} about{eol}"
        index.append(f"s{k}\t{n}\t{len(text)}\t{width}\t{width + len(eol)}")
        text += "".join(seq[i : i + width] + eol for i in range(0, n, width))
        own[f"s{k}"] = seq.upper()
    return text, index, own


def whole(ref):
    by = {}
    for r in ref.orderBy("chrom", "chunk").collect():
        by[r.chrom] = by.get(r.chrom, "") + r.seq
    return by


@pytest.mark.parametrize("eol", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [37, 150])
def test_splits_are_placed_alike(spark, tmp_path, monkeypatch, eol, size):
    monkeypatch.setattr(reference, "CHUNK", 100)
    text, index, own = fasta(size, eol)
    (tmp_path / "r.fa").write_text(text, newline="")
    (tmp_path / "r.fa.fai").write_text("\n".join(index) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        fai = tables.read_fai(spark, str(tmp_path / "r.fa.fai"))
        n = reference.lines_of(spark, str(tmp_path / "r.fa")).select("split").distinct().count()
        assert n > 8
        want = {k: s for k, s in own.items() if s}
        indexed = reference.read_packed_reference(spark, str(tmp_path / "r.fa"), fai)
        assert whole(indexed) == want
        assert whole(reference.read_packed_reference(spark, str(tmp_path / "r.fa"))) == want
        plan = indexed._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_first_lines_of_all_splits():
    """For every byte, the first line that starts after it."""
    text, index, _ = fasta(3, "\n")
    starts = [0] + [i + 1 for i, c in enumerate(text[:-1]) if c == "\n"]

    class Fai:
        def orderBy(self, _):
            return self

        def collect(self):
            from collections import namedtuple

            row = namedtuple("row", "name length offset linebases linewidth")
            return [row(x[0], *map(int, x[1:])) for x in (line.split("\t") for line in index)]

    made = reference.entries(Fai())
    for byte in range(1, len(text) - 1):
        assert reference.first_line(made, byte) == sum(s <= byte for s in starts), byte


def test_packing_fills_gaps(spark, monkeypatch):
    monkeypatch.setattr(reference, "CHUNK", 8)
    bases = spark.createDataFrame([("1", p, "ACGT"[p % 4]) for p in (3, 4, 9, 20)] + [("1", 4, "A")] + [("2", 1, "t")], "chrom string, pos long, base string")
    got = {(r.chrom, r.chunk): r.seq for r in reference.packed_bases(bases).collect()}
    assert got == {("1", 0): "NNTA", ("1", 1): "C", ("1", 2): "NNNA", ("2", 0): "T"}


def test_stretches(spark, monkeypatch):
    monkeypatch.setattr(reference, "CHUNK", 8)
    seq = "ACGTTGCAACGGTCATTACGA"
    ref = reference.packed(spark.createDataFrame([("1", 0, seq)], "chrom string, begin long, value string"))
    wanted = [(a, n) for a in range(0, 25, 3) for n in (0, 1, 5, 17)]
    df = spark.createDataFrame([("1", a, n) for a, n in wanted] + [("9", 2, 4)], "c string, a long, n int")
    got = {(r.c, r.a, r.n): r.ref for r in reference.stretches(df, ref, "c", "a", "n", ["c", "a", "n"]).collect()}
    want = {("1", a, n): seq[a : a + n].ljust(n, "N") for a, n in wanted if n} | {("9", 2, 4): "NNNN"}
    assert got == want


def test_bases(spark):
    ref = reference.packed(spark.createDataFrame([("1", 0, "acg"), ("1", 3, "T")], "chrom string, begin long, value string"))
    assert [tuple(r) for r in reference.bases_of(ref).orderBy(F.col("pos")).collect()] == [("1", 1, "A"), ("1", 2, "C"), ("1", 3, "G"), ("1", 4, "T")]
