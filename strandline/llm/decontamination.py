"""Benchmark decontamination by greedy string tiling.

Shared runs of ``least`` words are joined as seeds. A document that tiles cover far enough holds a certain number of an item's seeds, so it holds one
that is not among the item's commonest: only those bring (document, item) pairs together, and a seed that stands everywhere makes no pairs. A pair
goes on if the item's words that its seeds cover, each wherever it stands in the item, could reach the threshold. Tiling
then repeatedly marks the longest non-overlapping matches, found by running Karp-Rabin, so passages count in
any order; an item that is covered far enough contaminates the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import textkernel as K
from strandline.llm.common import cut, id_or_least, text_bytes, text_batches

#: Words of the shortest match, and the share of an item's words that tiles must cover.
LEAST, COVERAGE = 5, 0.5
#: Bits of each of the two hashed maps of seeds that tasks get; fuller maps let more seeds through to the join, which decides.
MAP_BITS = 22


def tokens(text: bytes) -> np.ndarray:
    data, starts = K.joined(pa.array([text], pa.binary()), 0, 1)
    return K.Words(data, starts, K.word_class("alnum"), True).hash


def free_windows(marked: np.ndarray, s: int) -> np.ndarray:
    """Starts of the runs of s unmarked words."""
    if len(marked) < s:
        return np.zeros(0, np.int64)
    sums = np.append(0, np.cumsum(marked))
    return np.flatnonzero(sums[s:] == sums[:-s])


def tiles(pattern: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (pattern start, text start, length) of non-overlapping matches, the longest first."""
    used_p, used_t = np.zeros(len(pattern), bool), np.zeros(len(text), bool)
    out: list[tuple[int, int, int]] = []
    s = max(least, min(20, len(pattern)))
    while True:
        found: list[tuple[int, int, int]] = []
        longest = 0
        starts_p, starts_t = free_windows(used_p, s), free_windows(used_t, s)
        if len(starts_p) and len(starts_t):
            hash_p, hash_t = K.gram_hashes(pattern, s)[starts_p], K.gram_hashes(text, s)[starts_t]
            at: dict[int, list[int]] = {}
            for h, p in zip(hash_p.tolist(), starts_p.tolist(), strict=True):
                at.setdefault(h, []).append(p)
            hit = np.isin(hash_t, hash_p)
            reached: dict[tuple[int, int], int] = {}
            for h, t in zip(hash_t[hit].tolist(), starts_t[hit].tolist(), strict=True):
                for p in at[h]:
                    # a match that an earlier start on the same diagonal has covered is not maximal
                    if reached.get(p - t, -1) > t:
                        continue
                    n = 0
                    most = min(len(pattern) - p, len(text) - t)
                    while n < most and pattern[p + n] == text[t + n] and not used_p[p + n] and not used_t[t + n]:
                        n += 1
                    reached[p - t] = t + n
                    if n >= s:
                        found.append((n, p, t))
                        longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        for n, p, t in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if not used_p[p : p + n].any() and not used_t[t : t + n].any():
                used_p[p : p + n] = used_t[t : t + n] = True
                out.append((p, t, n))
        if s > 2 * least:
            s //= 2
        elif s > least:
            s = least
        elif not found:  # marking can cut a match in two; what is left of it is looked for again
            return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, n_item_words, n_covered, coverage, n_tiles) of every document and benchmark item whose tiles reach the coverage.

    Words are lower-cased alphanumeric runs; texts of any length are tiled whole. Items with fewer than ``least`` words, null and empty texts
    match nothing; a null id is the smallest; other columns are not read. Rows that repeat a document's id are judged each by its own text and give one row for an item: the one with the highest
    coverage; likewise rows that repeat an item's id.
    """
    spark = docs.sparkSession
    text_batches(spark)

    def item_seeds(batches):
        for batch in batches:
            column = batch.column(2)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                h, at = K.shingles(w.hash, w.text, least)
                pairs, times = np.unique(np.stack([w.text[at], h.view(np.int64)]), axis=1, return_counts=True) if len(h) else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
                ids, g = (batch.column(c).slice(i, j - i).take(pa.array(pairs[0])) for c in range(2))
                yield pa.RecordBatch.from_arrays([ids, g, pa.array(pairs[1]), pa.array(times, pa.int64()), pa.array(w.n[pairs[0]], pa.int64())], ["item", "g", "seed", "times", "n_words"])

    items = benchmark.select(id_or_least(item_col).alias("item"), text_bytes(item_text).alias("t")).distinct().select("item", F.xxhash64("t").alias("g"), "t")
    seeds = cut(items.mapInArrow(item_seeds, "item long, g long, seed long, times long, n_words long"))
    maps = np.zeros((2, 1 << MAP_BITS), bool)
    for k, place in enumerate((F.shiftrightunsigned("seed", 64 - MAP_BITS), F.col("seed").bitwiseAND((1 << MAP_BITS) - 1))):
        maps[k, seeds.select(place.alias("k")).distinct().toArrow()["k"].to_numpy()] = True
    wanted = spark.sparkContext.broadcast(np.packbits(maps, axis=1))

    def doc_seeds(batches):
        high, low = np.unpackbits(wanted.value, axis=1).astype(bool)
        for batch in batches:
            column = batch.column(1)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                h, at = K.shingles(w.hash, w.text, least)
                k = np.flatnonzero(high[h >> np.uint64(64 - MAP_BITS)])
                k = k[low[h[k] & np.uint64((1 << MAP_BITS) - 1)]]
                pairs = np.unique(np.stack([w.text[at[k]], h[k].view(np.int64)]), axis=1) if len(k) else np.zeros((2, 0), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).take(pa.array(pairs[0])), batch.column(2).slice(i, j - i).take(pa.array(pairs[0])), pa.array(pairs[1])], ["id", "h", "seed"])

    source = docs.select(id_or_least(id_col).alias("id"), text_bytes(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    held = source.select("id", "t", "h").mapInArrow(doc_seeds, "id long, h long, seed long").distinct()
    found = cut(held.join(seeds.select("seed").distinct(), "seed", "left_semi"))
    # tiles that reach the coverage hold so many seeds; of the commonest seeds fewer than that can be left out, as a document needs one of the others
    common = Window.partitionBy("item", "g").orderBy(F.desc("df"), "seed").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = found.groupBy("seed").agg(F.count("*").alias("df")).join(seeds, "seed")
    rare = spread.withColumn("upto", F.sum("times").over(common)).where(F.col("upto") >= F.ceil(F.col("n_words") * coverage / least - 1e-9)).select("seed", "item", "g")
    near = found.join(rare, "seed").select("id", "h", "item", "g").distinct()
    # rows that repeat an item's id are judged one by one; a seed counts as often as it stands in the item, once for all copies of a document's row
    shared = near.join(found, ["id", "h"]).join(seeds, ["item", "g", "seed"])
    pairs = shared.groupBy("id", "h", "item", "g").agg(F.sum("times").alias("n"), F.max("n_words").alias("n_words"))
    pairs = cut(pairs.where(F.col("n") * least >= F.col("n_words") * coverage).select("id", "h", "item", "g"))
    texts = source.join(pairs.select("id", "h").distinct(), ["id", "h"], "left_semi").dropDuplicates(["id", "h"])
    work = pairs.join(texts, ["id", "h"]).join(items.select("item", "g", F.col("t").alias("p")), ["item", "g"]).select("id", "item", "t", "p")

    def tile(batches):
        for batch in (whole.slice(k, 256) for whole in batches for k in range(0, whole.num_rows, 256)):
            out = []
            last: tuple[bytes, np.ndarray] = (b"", tokens(b""))
            for i, item, t, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if t != last[0]:
                    last = t, tokens(t)
                pattern = tokens(p)
                got = tiles(pattern, last[1], least)
                covered = sum(n for _, _, n in got)
                if len(pattern) and covered >= coverage * len(pattern):
                    out.append((i, item, len(pattern), covered, covered / len(pattern), len(got)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            types = [pa.int64()] * 4 + [pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types, strict=True)], ["id", "item", "n_item_words", "n_covered", "coverage", "n_tiles"])

    tiled = work.mapInArrow(tile, "id long, item long, n_item_words long, n_covered long, coverage double, n_tiles long")
    best = tiled.groupBy("id", "item").agg(F.max(F.struct("coverage", "n_item_words", "n_covered", "n_tiles")).alias("m"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.n_item_words", "m.n_covered", "m.coverage", "m.n_tiles")
