"""Reference sequences of FASTA text as packed rows (chrom, chunk, seq): CHUNK bases a row, so that a join by chunk fetches bases.

A split of a file is placed on its own. With the file's index (.fai) the first line of a split follows from the split's byte offset and the
line widths, and a line's place from its number, without any order over lines. Without an index, lines are summed inside their split and only a row for each split goes on.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bases of a packed row; lines of a bin in the join of lines with sequences.
CHUNK, LINE_BIN = 4096, 64
SPLIT = ["file", "split"]


class Entry(NamedTuple):
    """A sequence of an index: bytes of its header, first base and end, and the number of its header line in the file."""

    name: str
    length: int
    head: int
    offset: int
    end: int
    bases: int
    width: int
    line: int


def entries(fai: DataFrame) -> list[Entry]:
    """The index in file order, with byte and line numbers summed up: a short row for each sequence."""
    rows = fai.orderBy("offset").collect()
    lines = [-(-r.length // r.linebases) if r.linebases else 0 for r in rows]
    ends = [r.offset + r.length // r.linebases * r.linewidth + (r.length % r.linebases + r.linewidth - r.linebases) * (r.length % r.linebases > 0) if r.linebases else r.offset for r in rows]
    heads, first = [0, *ends[:-1]], [0, *accumulate(n + 1 for n in lines)]
    return [Entry(r.name, r.length, head, r.offset, end, r.linebases, r.linewidth, line) for r, head, end, line in zip(rows, heads, ends, first[:-1], strict=True)]


def first_line(index: list[Entry], start: int) -> int:
    """Number of the first line that a split from byte ``start`` on reads: the first that starts after it, or the file's first."""
    if start == 0 or not index:
        return 0
    e = index[bisect_right([e.head for e in index], start) - 1]
    if start < e.offset or not e.width:
        return e.line + 1
    return e.line + 1 + (min(start, e.end - 1) - e.offset) // e.width + 1 + (start >= e.end)


def lines_of(spark: SparkSession, path) -> DataFrame:
    """Lines with their file, the byte where their split starts, and a number that grows by one from line to line inside the split."""
    return spark.read.text(path).select(F.trim("value").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))


def is_bases() -> Column:
    return (F.col("value") != "") & ~F.col("value").startswith(">")


def by_index(lines: DataFrame, fai: DataFrame) -> DataFrame:
    """(chrom, begin, value) by arithmetic on the index, for one file."""
    spark = lines.sparkSession
    index = entries(fai)
    splits = lines.groupBy(*SPLIT).agg(F.min("at").alias("first")).collect()
    start = spark.createDataFrame([(r.file, r.split, first_line(index, r.split) - r.first) for r in splits], "file string, split long, shift long")
    numbered = lines.join(F.broadcast(start), SPLIT).select("value", (F.col("at") + F.col("shift")).alias("line")).where(is_bases())  # a row for each split of the file
    named = spark.createDataFrame([(e.name, e.line + 1, e.line + 1 + -(-e.length // e.bases), e.bases) for e in index if e.bases], "chrom string, first long, last long, bases int")
    bins = named.withColumn("bin", F.explode(F.sequence(F.floor(F.col("first") / LINE_BIN), F.floor((F.col("last") - 1) / LINE_BIN))))
    on = (F.floor(F.col("line") / LINE_BIN) == F.col("bin")) & (F.col("line") >= F.col("first")) & (F.col("line") < F.col("last"))
    return numbered.join(bins, on).select("chrom", ((F.col("line") - F.col("first")) * F.col("bases")).alias("begin"), "value")


def by_split(lines: DataFrame) -> DataFrame:
    """(chrom, begin, value) with the lengths of lines summed in each split, and the splits' sums over the file."""
    inside = Window.partitionBy(*SPLIT).orderBy("at")
    header = F.when(F.col("value").startswith(">"), F.regexp_extract("value", r"^>\s*(\S+)", 1))
    n = F.when(is_bases(), F.length("value")).otherwise(0)
    sums = lines.select(*SPLIT, "at", "value", header.alias("header"), F.coalesce(F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), n.alias("n"))
    last = F.last(F.when(F.col("header").isNotNull(), F.struct("header", "before")), ignorenulls=True).over(inside)
    own = sums.withColumn("own", last)
    # what is open at the end of each split: its last name, and the bases since
    ends = own.groupBy(*SPLIT).agg(F.max_by(F.struct("own", (F.col("before") + F.col("n")).alias("total")), "at").alias("e"))
    order = Window.partitionBy("file").orderBy("split")
    tails = ends.select(*SPLIT, F.col("e.own.header").alias("name"), (F.col("e.total") - F.coalesce("e.own.before", F.lit(0))).alias("tail"))
    group = tails.withColumn("g", F.count("name").over(order))
    carry = group.select(*SPLIT, F.lag(F.last("name", ignorenulls=True).over(order)).over(order).alias("name0"), F.sum("tail").over(Window.partitionBy("file", "g").orderBy("split")).alias("sum"))
    carry = carry.select(*SPLIT, "name0", F.lag("sum").over(order).alias("begin0"))
    placed = own.where(is_bases()).join(carry, SPLIT)
    begin = F.when(F.col("own").isNotNull(), F.col("before") - F.col("own.before")).otherwise(F.col("before") + F.coalesce("begin0", F.lit(0)))
    return placed.select(F.coalesce("own.header", "name0").alias("chrom"), begin.alias("begin"), "value")


def packed(pieces: DataFrame) -> DataFrame:
    """(chrom, chunk, seq) of pieces (chrom, begin, value), upper case; places that no piece covers hold N. Of pieces at one place the last in order stays."""
    chunks = F.explode(F.sequence(F.floor(F.col("begin") / CHUNK), F.floor((F.col("begin") + F.length("value") - 1) / CHUNK)))
    cut = pieces.where(F.length("value") > 0).withColumn("chunk", chunks).withColumn("low", F.greatest(F.col("begin"), F.col("chunk") * CHUNK))
    high = F.least(F.col("begin") + F.length("value"), (F.col("chunk") + 1) * CHUNK)
    cut = cut.select("chrom", "chunk", (F.col("low") - F.col("chunk") * CHUNK).cast("int").alias("at"), F.upper(F.substring("value", (F.col("low") - F.col("begin") + 1).cast("int"), (high - F.col("low")).cast("int"))).alias("s"))
    rows = cut.groupBy("chrom", "chunk").agg(F.array_sort(F.collect_set(F.struct("at", "s"))).alias("p"))
    # up to where the next piece starts; a gap before a piece is filled
    until = lambda x, i: F.coalesce(F.get(F.col("p"), i + 1)["at"], x["at"] + F.length(x["s"]))
    part = F.transform("p", lambda x, i: F.concat(F.when(i == 0, F.repeat(F.lit("N"), x["at"])).otherwise(F.lit("")), F.rpad(x["s"], until(x, i) - x["at"], F.lit("N"))))
    return rows.select("chrom", "chunk", F.array_join(part, "").alias("seq"))


def packed_bases(bases: DataFrame) -> DataFrame:
    """(chrom, chunk, seq) of single bases (chrom, pos; 1-based, base)."""
    return packed(bases.select("chrom", (F.col("pos") - 1).alias("begin"), F.col("base").alias("value")))


def read_packed_reference(spark: SparkSession, path, fai: DataFrame | None = None) -> DataFrame:
    """Packed sequences of FASTA text; ``fai`` is the index of the one file at ``path``, if there is one. A gzipped file is one split."""
    lines = lines_of(spark, path)
    return packed(by_index(lines, fai) if fai is not None else by_split(lines))


def bases_of(reference: DataFrame) -> DataFrame:
    """(chrom, pos, base) of packed rows, one for each base."""
    one = reference.select("chrom", "chunk", F.posexplode(F.split("seq", "")).alias("k", "base")).where("base <> ''")
    return one.select("chrom", (F.col("chunk") * CHUNK + F.col("k") + 1).alias("pos"), "base")


def stretches(wanted: DataFrame, reference: DataFrame, chrom: str, start: str, length: str, keys: list[str]) -> DataFrame:
    """``keys`` of ``wanted`` with ``ref``, the bases of [start, start + length) of its chromosome; N where the reference has none. ``keys`` name a row.

    Rows are copied to the chunks that they touch, most to one, and meet the packed row by (chromosome, chunk). Both sides are merged: Catalyst takes a packed row for
    twenty bytes and would send a whole reference through the driver.
    """
    end = F.col(start) + F.col(length)
    w = wanted.where(F.col(length) > 0).withColumn("_chunk", F.explode(F.sequence(F.floor(F.col(start) / CHUNK), F.floor((end - 1) / CHUNK))))
    w = w.withColumn("_low", F.greatest(F.col(start), F.col("_chunk") * CHUNK)).withColumn("_n", (F.least(end, (F.col("_chunk") + 1) * CHUNK) - F.col("_low")).cast("int"))
    r = reference.select(F.col("chrom").alias("_chrom"), F.col("chunk").alias("_of"), F.col("seq").alias("_seq"))
    j = w.hint("merge").join(r.hint("merge"), (F.col(chrom) == F.col("_chrom")) & (F.col("_chunk") == F.col("_of")), "left")
    part = F.rpad(F.substring(F.coalesce("_seq", F.lit("")), (F.col("_low") - F.col("_chunk") * CHUNK + 1).cast("int"), F.col("_n")), F.col("_n"), F.lit("N"))
    return j.select(*keys, "_low", part.alias("_part")).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_low", "_part"))), lambda x: x["_part"]), "").alias("ref"))
