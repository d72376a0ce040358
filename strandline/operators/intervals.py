"""Range joins of calls (chrom, pos; 1-based) with intervals (chrom, start, end; 0-based half-open, name) over position bins.

Each interval is copied to the bins it touches, a call has one bin of each width, and the join is an equi-join on (chrom, width, bin) with the
range as a residual test, so it is a hash or sort-merge join that adaptive execution can split or broadcast by size. Intervals
of over LONG bins take bins that are LONG times as wide, so a whole chromosome's mask is some hundred rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

BIN, LONG = 10_000, 64
#: Narrowest bins of reads.
NEAR = 256


def plain_chrom(chrom: Column) -> Column:
    """Without a "chr" prefix."""
    return F.regexp_replace(chrom, "^chr", "")


def binned(intervals: DataFrame, size: int = BIN) -> DataFrame:
    """Intervals as (_chrom, _wide, _bin, _start, _end, _name), one row for each bin touched; empty intervals go."""
    i = intervals.where("start < end")
    name = F.col("name") if "name" in intervals.columns else F.lit("")
    wide = F.col("end") - F.col("start") > size * LONG
    width = F.when(wide, size * LONG).otherwise(size)
    bins = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)))
    return i.select(plain_chrom(F.col("chrom")).alias("_chrom"), wide.alias("_wide"), bins.alias("_bin"), F.col("start").alias("_start"), F.col("end").alias("_end"), name.alias("_name"))


def overlaps(calls: DataFrame, intervals: DataFrame, size: int = BIN) -> DataFrame:
    """Calls with each interval that holds their base."""
    base = F.col("pos") - 1
    places = F.array(*[F.struct(F.lit(wide).alias("wide"), F.floor(base / width).alias("bin")) for wide, width in ((False, size), (True, size * LONG))])
    keyed = calls.withColumn("_place", F.explode(places))
    on = (plain_chrom(F.col("chrom")) == F.col("_chrom")) & (F.col("_place.wide") == F.col("_wide")) & (F.col("_place.bin") == F.col("_bin")) & (base >= F.col("_start")) & (base < F.col("_end"))
    return keyed.join(binned(intervals, size), on).drop("_place", "_wide")


def annotate(calls: DataFrame, intervals: DataFrame, size: int = BIN) -> DataFrame:
    """Adds n_hits and hit_name: how many intervals hold the call, and the name of the one with the smallest start, end and name."""
    keys = ["chrom", "pos"]
    hits = overlaps(calls.select(*keys).distinct(), intervals, size).groupBy(*keys).agg(F.count("*").alias("n_hits"), F.min(F.struct("_start", "_end", "_name")).alias("_first"))
    return calls.join(hits.select(*keys, "n_hits", F.col("_first._name").alias("hit_name")), keys, "left").withColumn("n_hits", F.coalesce("n_hits", F.lit(0).cast("long")))


def with_filter(code: str, when: Column) -> Column:
    """The filter column with one more code; PASS goes when a code comes."""
    return F.when(when, F.array_sort(F.array_union(F.array_remove("filter", "PASS"), F.array(F.lit(code))))).otherwise(F.col("filter"))


def tag(calls: DataFrame, intervals: DataFrame, code: str, inside: bool = True, to: str = "filter", value: str = "flag", size: int = BIN) -> DataFrame:
    """Tag the calls inside (or outside) the intervals; no row goes.

    to: "filter" adds the code to the FILTER set; "info" sets INFO[code] to the hit's name, the number of hits or a flag (value: name,
    count, flag); "id" sets the INFO flag and adds the hit's name to the ids.
    """
    named = annotate(calls, intervals, size)
    hit = F.col("n_hits") > 0 if inside else F.col("n_hits") == 0
    if to == "filter":
        out = named.withColumn("filter", with_filter(code, hit))
    else:
        v = {"name": F.col("hit_name"), "count": F.col("n_hits").cast("string"), "flag": F.lit("True")}["flag" if to == "id" else value]
        entry = F.create_map(F.lit(code), F.array(v))
        rest = F.map_filter("info", lambda k, _: k != code)
        out = named.withColumn("info", F.when(hit, F.map_concat(rest, entry)).otherwise(F.col("info")))
        if to == "id":
            out = out.withColumn("id", F.when(hit & (F.col("hit_name") != ""), F.array_union("id", F.array("hit_name"))).otherwise(F.col("id")))
    return out.drop("n_hits", "hit_name")


def intersect(left: DataFrame, right: DataFrame, buffer: int = 0, size: int = BIN) -> DataFrame:
    """Intervals of ``left`` that overlap some interval of ``right`` widened by ``buffer``, each once."""
    wide = right.select("chrom", (F.col("start") - buffer).alias("start"), (F.col("end") + buffer).alias("end"))
    keyed = left.withColumn("_row", F.struct(*left.columns))
    bins = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size)))
    narrow = keyed.where("start < end").withColumn("_bin1", bins)
    l = narrow.withColumn("_place", F.explode(F.array(F.struct(F.lit(False).alias("wide"), F.col("_bin1").alias("bin")), F.struct(F.lit(True).alias("wide"), F.floor(F.col("_bin1") / LONG).alias("bin")))))
    on = (plain_chrom(F.col("chrom")) == F.col("_chrom")) & (F.col("_place.wide") == F.col("_wide")) & (F.col("_place.bin") == F.col("_bin")) & (F.col("start") < F.col("_end")) & (F.col("end") > F.col("_start"))
    return l.join(binned(wide, size), on, "left_semi").select(*left.columns).distinct()


def length(intervals: DataFrame) -> DataFrame:
    """Number of distinct intervals."""
    return intervals.distinct().agg(F.count("*").alias("n_intervals"))


def deep_bins(spans: DataFrame, limit: int) -> DataFrame:
    """(_chrom, _bin, _parts) of bins that more than ``limit`` spans touch, by a count of all; there are at most as many rows as spans and bins over ``limit``."""
    counts = spans.groupBy("_chrom", "_bin").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > limit).select("_chrom", "_bin", F.ceil(F.col("n") / limit).cast("int").alias("_parts"))


def bins_of_base(base: Column, size: int) -> Column:
    """The base's bin of each of three widths; a bin's number holds its width."""
    return F.array(*[F.floor(base / (size * LONG**k)) * 3 + k for k in range(3)])


def bins_of_span(start: Column, end: Column, size: int) -> Column:
    """The bins that a span touches: of the narrowest width of which it spans at most LONG, else of the widest."""
    low, high, n = bins_of_base(start, size), bins_of_base(end - 1, size), end - start
    k = F.when(n <= size * LONG, 0).when(n <= size * LONG**2, 1).otherwise(2)
    return F.sequence(F.get(low, k), F.get(high, k), F.lit(3).cast("long"))


def near_positions(calls: DataFrame, spans: DataFrame, start: str, end: str, size: int = NEAR, deep: int | None = None) -> DataFrame:
    """Calls with each span (chrom, start, end) whose bases they fall in; ``spans`` keeps its own columns.

    Bins are about as narrow as reads, so a span meets few calls that it doesn't hold; long spans take wider ones. Both sides are sorted and merged: calls grow with the input, so they are never sent whole through the driver.

    deep: bins that more spans touch are dealt in parts of about that many, by a hash of the span, and their calls are copied to each part: a pile of reads at
    one place is spread over tasks, whatever the place's width.
    """
    s = spans.where(F.col(start) < F.col(end)).withColumn("_bin", F.explode(bins_of_span(F.col(start), F.col(end), size))).withColumnRenamed("chrom", "_chrom")
    base = F.col("pos") - 1
    placed = calls.withColumn("_of", F.explode(bins_of_base(base, size)))
    on = (F.col("chrom") == F.col("_chrom")) & (F.col("_of") == F.col("_bin")) & (base >= F.col(start)) & (base < F.col(end))
    if deep is None:
        return placed.hint("merge").join(s, on).drop("_bin", "_chrom", "_of")
    parts = deep_bins(s.select("_chrom", "_bin"), deep)
    whole = lambda c: F.coalesce(c, F.lit(1))
    own = F.xxhash64(*[c for c in spans.columns if not isinstance(spans.schema[c].dataType, MapType) and c != "chrom"])
    dealt = s.join(parts, ["_chrom", "_bin"], "left").withColumn("_part", F.pmod(own, whole(F.col("_parts"))).cast("int")).drop("_parts")
    wanted = parts.select(F.col("_chrom").alias("_c"), F.col("_bin").alias("_b"), "_parts")
    copied = placed.join(wanted, (F.col("chrom") == F.col("_c")) & (F.col("_of") == F.col("_b")), "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), whole(F.col("_parts")) - 1))).drop("_c", "_b", "_parts")
    return copied.hint("merge").join(dealt, on & (F.col("_copy") == F.col("_part"))).drop("_bin", "_chrom", "_of", "_copy", "_part")
