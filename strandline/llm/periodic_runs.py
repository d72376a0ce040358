"""Periodic runs of words: a harmonic grid of (period, grid point) pairs, longest common extensions by binary search over prefix hashes.

A run of period q and length L matches itself q words on over L - q consecutive places. Runs count from max(LEAST, TIMES * q) words,
so a grid of that many less q words has a point inside each of them, and all periods of a text of n words make n log n pairs at most. The pairs of all texts of a pass whose
two words are equal are extended to both sides at once, by binary search over one table of prefix hashes. What is long enough is held
against the words themselves, and runs that several grid points or multiples of their period found are kept once, with their smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import textkernel as K
from strandline.llm.common import text_batches, text_bytes

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 24, 3
#: (period, grid point) pairs that numpy holds at a time.
PAIRS = 1 << 20
RUN = "struct<start:long,length:long,period:long>"


def stride(q: np.ndarray) -> np.ndarray:
    """Places at which the shortest run of period q matches itself q words on."""
    return np.maximum(LEAST, TIMES * q) - q


def grid(first: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, place) of all grid points of texts that start at ``first`` and have n words, in portions of about PAIRS."""
    most = np.where(n >= LEAST, n // TIMES, 0)
    text = np.repeat(np.arange(len(n)), most)
    q = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    points = (n[text] - q - 1) // stride(q) + 1
    ends = np.cumsum(points)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + PAIRS, "right")))
        many = points[i:j]
        t, period = np.repeat(text[i:j], many), np.repeat(q[i:j], many)
        k = np.arange(len(t)) - np.repeat(np.cumsum(many) - many, many)
        yield t, period, first[t] + k * stride(period)
        i = j


def extensions(spans: K.Spans, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words from a and b on (back: before them) agree, ``most`` at most, by their hashes."""
    low, high = np.zeros(len(a), np.int64), most + 1
    while True:
        open_ = np.flatnonzero(low + 1 < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        x, y = a[open_], b[open_]
        same = spans.of(x - mid, x) == spans.of(y - mid, y) if back else spans.of(x, x + mid) == spans.of(y, y + mid)
        low[open_[same]] = mid[same]
        high[open_[~same]] = mid[~same]


def verified(ids: np.ndarray, low: int, high: int, start: int, end: int, q: int) -> list[tuple[int, int]]:
    """The run [start, end) of period q in the text [low, high) with its words compared; where hashes had made it too long, all stretches of that period in the text."""
    if np.array_equal(ids[start : end - q], ids[start + q : end]):
        return [(start, end)]
    apart = np.flatnonzero(ids[low : high - q] != ids[low + q : high]) + low
    starts, ends = np.concatenate([[low], apart + 1]), np.concatenate([apart, [high - q]]) + q
    long = ends - starts >= max(LEAST, TIMES * q)
    return list(zip(starts[long].tolist(), ends[long].tolist(), strict=True))


def runs(ids: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of all runs, by text, start and period; starts count from the text's first word.

    ``ids`` numbers the words of texts that lie one after another: equal numbers for equal words.
    """
    spans = K.Spans(K.mix(ids.astype(np.uint64) + np.uint64(1)))
    found = []
    for t, q, j in grid(first, n):
        hit = np.flatnonzero(ids[j] == ids[j + q])
        t, q, j = t[hit], q[hit], j[hit]
        ahead = extensions(spans, j, j + q, first[t] + n[t] - j - q, back=False)
        behind = extensions(spans, j, j + q, j - first[t], back=True)
        long = ahead + behind + q >= np.maximum(LEAST, TIMES * q)
        found.append(np.stack([t, j - behind, j + q + ahead, q])[:, long])
    all_ = np.unique(np.concatenate([np.zeros((4, 0), np.int64), *found], 1), axis=1)  # in order of text, start, end and period
    out, smallest = [], (-1, -1, 1)
    for t, start, end, q in all_.T.tolist():
        # a multiple of the smallest period of the same stretch is that run again
        if (start, end) == smallest[:2] and q % smallest[2] == 0:
            continue
        own = verified(ids, int(first[t]), int(first[t] + n[t]), start, end, q)
        if own == [(start, end)] and (start, end) != smallest[:2]:
            smallest = (start, end, q)
        out += [(t, *x, q) for x in own]
    # the smallest period of each stretch, once
    kept: dict[tuple[int, int], tuple[int, int]] = {}
    for t, start, end, q in sorted(out, key=lambda x: x[3]):
        kept.setdefault((start, end), (t, q))
    rows = np.array(sorted((t, start, q, end) for (start, end), (t, q) in kept.items()), np.int64).reshape(-1, 4)
    t, start, q, end = rows.T
    return t, start - first[t], end - start, q


class Words:
    """Words of a few texts: byte spans, exact numbers and the words' places by text."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        inside = K.word_class("space")[data]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        self.data, self.start, self.end = data, edge[0::2], edge[1::2]  # the last byte is a space
        offsets = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=offsets[1:])
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        self.ids = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        place = np.searchsorted(self.start, starts)
        self.first, self.n = place[:-1], np.diff(place)

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Kept words of each text, joined by one space: offsets and bytes."""
        data = self.data.copy()
        data[self.end[keep]] = 0x20
        edges = np.zeros(len(data) + 1, np.int8)
        edges[self.start[keep]] += 1
        edges[self.end[keep] + 1] -= 1  # a word's edges are not another's: a space stands between two words
        text = np.repeat(np.arange(len(self.n)), self.n)
        size = np.bincount(text[keep], (self.end - self.start + 1)[keep], len(self.n)).astype(np.int64)
        inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
        inside[self.end[keep]] = True
        out = data[inside]
        # the space after a text's last word goes
        ends = np.cumsum(size)
        last = np.ones(len(out), bool)
        last[ends[size > 0] - 1] = False
        offsets = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size - (size > 0), out=offsets[1:])
        return offsets, out[last]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, ``runs`` (array of start, length, period; by start, then period) and ``collapsed``.

    Words are runs of bytes other than white space (0x20, 0x09-0x0D), numbered from 0. A run is a stretch of consecutive words with smallest
    period q and at least max(24, 3 * q) words that no neighbouring word extends keeping that period. ``collapsed`` joins by one space the words
    that no run holds after its first period. Null and empty texts have no words, no runs and an empty collapsed text; a very long text is a pass of its own and is searched
    whole; rows that repeat an id or a text are judged each for itself; a null id stays null; other columns are not read. No rows give no rows.
    """
    text_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = Words(*K.joined(column, i, j))
                t, start, length, period = runs(w.ids, w.first, w.n)
                edges = np.zeros(len(w.ids) + 1, np.int64)
                np.add.at(edges, w.first[t] + start + period, 1)
                np.add.at(edges, w.first[t] + start + length, -1)
                offsets, kept = w.joined(np.cumsum(edges[:-1]) == 0)
                lists = np.searchsorted(t, np.arange(j - i + 1)).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run))
                text = pa.LargeStringArray.from_buffers(j - i, pa.py_buffer(offsets), pa.py_buffer(kept)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(w.n, pa.int64()), pa.ListArray.from_arrays(pa.array(lists), structs), text], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"))
    return rows.mapInArrow(search, f"id long, n_words long, runs array<{RUN}>, collapsed string").withColumnRenamed("id", id_col)


def strongest(found: Column) -> Column:
    """The run of the greatest exact length / period (ties: smallest start, then period) in an array of runs; null where there is none."""
    better = lambda a, b: (b["length"] * a["period"] > a["length"] * b["period"])
    # runs come by start, then period: the first of equal ones stays
    return F.aggregate(found, F.lit(None).cast(RUN), lambda acc, r: F.when(acc.isNull() | better(acc, r), r).otherwise(acc))


def digests(found: DataFrame) -> DataFrame:
    """n_runs, the strongest run and hashes of all runs and of the collapsed text, for rows of ``periodic_runs``."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = found.withColumn("_best", strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in which every tenth one, by h = crc32 of its decimal id, goes on repeating p of its words from word a on.

    With g = floor(h / 10) and n words: a = g % n, p = 1 + floor((n - a) / (3 + g % 8)). A null id is left as it is.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", h.alias("h"), F.expr("h div 10").alias("g"), F.when(F.col("h") % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.coalesce(F.size("w"), F.lit(0)).cast("long")).withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[cast(a + (i - a) % p AS int)] END), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))
