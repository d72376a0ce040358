"""Text pileups: rows of (chrom, pos, ref, n_reads, reads, base_quals, map_quals), decoded to read observations."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "chrom string, pos long, ref string, n_reads int, reads string, base_quals string, map_quals string"
OBSERVATION = T.StructType().add("base", "string").add("bq", "integer").add("mq", "integer").add("plus", "boolean")
DECODED = T.StructType([*(T.StructField(c, T.IntegerType()) for c in ("ins", "del", "start", "stop")), T.StructField("obs", T.ArrayType(OBSERVATION))])


def cleaned(rows: DataFrame) -> DataFrame:
    """Rows of text without the tool's own lines, with the reference in upper case."""
    return rows.where(F.col("pos").isNotNull() & ~F.col("chrom").startswith("[mpileup]") & ~F.col("chrom").startswith("<mpileup>")).withColumn("ref", F.upper("ref"))


def read_pileup(spark: SparkSession, path: str, chrom: str | None = None, start: int | None = None, stop: int | None = None) -> DataFrame:
    """Pileup rows; blank lines and the tool's own ``[mpileup]`` or ``<mpileup>`` lines are no rows."""
    rows = cleaned(spark.read.schema(SCHEMA).option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE").csv(path))
    for test in (F.col("chrom") == chrom if chrom else None, F.col("pos") >= start if start is not None else None, F.col("pos") <= stop if stop is not None else None):
        rows = rows.where(test) if test is not None else rows
    return rows


class Rows(NamedTuple):
    """Decoded rows: counts of each row, and observations by row (number of the row, base, qualities, strand)."""

    ins: np.ndarray
    dels: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    row: np.ndarray
    base: np.ndarray
    bq: np.ndarray
    mq: np.ndarray
    plus: np.ndarray


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is empty."""
    flat = column.fill_null("").cast(pa.large_binary())
    flat = pa.concat_arrays([flat])
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int64, len(flat) + 1, flat.offset * 8) if len(flat) else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def _jumps(text: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a token of several bytes may begin (a read start with its quality, an indel with its length and bases), and where it ends; ``end`` is each byte's row end."""
    caret = np.flatnonzero(text == ord("^"))
    sign = np.flatnonzero((text == ord("+")) | (text == ord("-")))
    after, size = sign + 1, np.zeros(len(sign), np.int64)
    open_ = np.arange(len(sign))
    while len(open_):  # a round for each digit of the longest length
        open_ = open_[after[open_] < end[sign[open_]]]
        digit = text[after[open_]].astype(np.int64) - 48
        open_, digit = open_[(digit >= 0) & (digit < 10)], digit[(digit >= 0) & (digit < 10)]
        size[open_] = np.minimum(size[open_] * 10 + digit, len(text))
        after[open_] += 1
    some = after > sign + 1
    at = np.concatenate([caret, sign[some]])
    to = np.concatenate([caret + 2, (after + size)[some]])
    order = np.argsort(at)
    return at[order], np.minimum(to, end[at])[order]


def _reached(at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Which of the places are tokens: each follows from the first by jumps from a token's end to the next place, and one inside a token is none."""
    n = len(at)
    hop = np.append(np.searchsorted(at, to), n)
    powers = [hop]
    while (powers[-1][0] < n) and len(powers) < 40:
        powers.append(powers[-1][powers[-1]])
    real = np.zeros(n + 1, bool)
    real[:1] = True
    for p in reversed(powers):
        real[p[real]] = True
    return real[:n]


def decode_rows(reads: pa.Array, ref: pa.Array, base_quals: pa.Array, map_quals: pa.Array) -> Rows:
    """All rows of a batch in one pass over their bytes.

    Every token but indels, starts and ends uses up one quality character; where those run out both qualities are -1. Tokens
    other than bases (gaps, skips, N) give no observation.
    """
    at, text = _bytes(reads)
    text = text[: at[-1]]
    n = len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    place, to = _jumps(text, at[1:][row])
    real = _reached(place, to)
    place, to = place[real], to[real]
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, place + 1, 1)
    np.add.at(inside, to, -1)
    token = np.cumsum(inside[:-1]) == 0
    jump = np.zeros(len(text), bool)
    jump[place] = True
    count = lambda x: np.bincount(row[x], minlength=n)
    stop = token & (text == ord("$"))
    used = token & ~jump & ~stop
    k = np.cumsum(used) - used
    k = k - np.append(k, 0)[at[:-1]][row]  # from the row's first token on
    (ref_at, ref_text), (bq_at, bq_text), (mq_at, mq_text) = (_bytes(x) for x in (ref, base_quals, map_quals))
    own = np.zeros(n, np.uint8)
    one = np.diff(ref_at) == 1
    own[one] = ref_text[ref_at[:-1][one]]
    i = np.flatnonzero(used)
    c, r, k = text[i], row[i], k[i]
    base = np.where((c == ord(".")) | (c == ord(",")), own[r], np.where((c >= 97) & (c <= 122), c - 32, c))
    seen = np.isin(base, np.frombuffer(b"ACGT", np.uint8))
    base, c, r, k = base[seen], c[seen], r[seen], k[seen]
    have = (k < np.diff(bq_at)[r]) & (k < np.diff(mq_at)[r])
    quality = lambda at, text: np.where(have, np.append(text, 0)[np.where(have, at[:-1][r] + k, 0)].astype(np.int32) - 33, -1)
    return Rows(count(jump & (text == ord("+"))), count(jump & (text == ord("-"))), count(jump & (text == ord("^"))), count(stop), r, base, quality(bq_at, bq_text), quality(mq_at, mq_text), (c == ord(".")) | ((c >= 65) & (c <= 90)))


def decode(reads: str, ref: str, base_quals: str, map_quals: str) -> dict:
    """One row: insertions, deletions, read starts and ends, and the observed bases."""
    d = decode_rows(*(pa.array([x], pa.string()) for x in (reads, ref, base_quals, map_quals)))
    obs = [{"base": chr(b), "bq": q, "mq": m, "plus": p} for b, q, m, p in zip(d.base.tolist(), d.bq.tolist(), d.mq.tolist(), d.plus.tolist(), strict=True)]
    return {"ins": int(d.ins[0]), "del": int(d.dels[0]), "start": int(d.start[0]), "stop": int(d.stop[0]), "obs": obs}


def with_decoded(rows: DataFrame) -> DataFrame:
    """Adds ``pileup``, the decoded row; batches of rows are decoded at once."""
    schema = T.StructType([*rows.schema.fields, T.StructField("pileup", DECODED)])

    def run(batches):
        for batch in batches:
            d = decode_rows(*(batch.column(c) for c in ("reads", "ref", "base_quals", "map_quals")))
            letters = pa.array([], pa.string()) if not len(d.base) else pa.StringArray.from_buffers(len(d.base), pa.py_buffer(np.arange(len(d.base) + 1, dtype=np.int32)), pa.py_buffer(d.base.astype(np.uint8)))
            obs = pa.StructArray.from_arrays([letters, pa.array(d.bq, pa.int32()), pa.array(d.mq, pa.int32()), pa.array(d.plus)], ["base", "bq", "mq", "plus"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(d.row, np.arange(len(batch) + 1)), pa.int32()), obs)
            counts = [pa.array(x, pa.int32()) for x in (d.ins, d.dels, d.start, d.stop)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays([*counts, lists], ["ins", "del", "start", "stop", "obs"])], [*batch.schema.names, "pileup"])

    return rows.mapInArrow(run, schema)


def observations(rows: DataFrame, sample: str) -> DataFrame:
    """One row per observed base: chrom, pos, ref, sample, base, bq, mq, plus."""
    return with_decoded(rows).select("chrom", "pos", "ref", F.lit(sample).alias("sample"), F.explode("pileup.obs").alias("o")).select("chrom", "pos", "ref", "sample", "o.*")


def site_counts(rows: DataFrame, sample: str) -> DataFrame:
    """Depth, insertions, deletions, starts and ends per position; not quality filtered."""
    return with_decoded(rows).select("chrom", "pos", F.lit(sample).alias("sample"), F.col("n_reads").alias("n"), "pileup.ins", "pileup.del", "pileup.start", "pileup.stop")
