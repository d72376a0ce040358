"""Repeated windows across a corpus: an exact sieve that leaves only windows whose anchor occurs again.

A window of ``width`` units (bytes or words) holds an anchor: the leftmost smallest hash of its runs of ``gram``
units. Equal windows have equal anchors at equal offsets, so neighbouring windows with one anchor travel as one
run, keyed by the anchor's hash, and a window whose key occurs once in the corpus cannot be repeated. What
is exchanged is packed into numpy blobs, one for each task's flush and destination, so no row is made for each position.

Flow: runs (equal runs of one flush are folded) -> exchange by key -> runs that are alone go; of runs with equal 64-bit content
hashes all but the first are settled as copies, without a look at the index; the rest ("open" runs: one anchor, different content) fetch their
text -> exchange by key -> the operator's own index (suffix trees, or a Burrows-Wheeler transform) settles their
windows -> exchange by document, next to the texts.

An anchor that very many runs share (a line that stands in a third of all documents) would put them all into one task. Such
anchors are found first, in hashed counters of fixed size, and their runs are keyed by the hash of a whole window instead: the prefix
is lengthened as far as it goes, so the runs spread over all tasks, and what still meets are copies, folded before the exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textkernel as K
from strandline.llm.common import cut, with_row, text_batches

#: Text bytes of a document group, and runs that a task holds before it sends them on.
GROUP_BYTES, FLUSH_RUNS = 6 << 20, 200_000
#: Runs from which on an anchor is hot; one run in COUNTED is counted, in 2 ** COUNTER_BITS counters.
HOT_RUNS, COUNTED, COUNTER_BITS = 4096, 16, 24

RUN = np.dtype([("key", "<u8"), ("same", "<u8"), ("row", "<i8"), ("at", "<u4"), ("n", "u1"), ("more", "u1")])
MARK = np.dtype([("row", "<i8"), ("at", "<u4"), ("n", "<u4")])
BLOBS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("blob", pa.binary())])
BLOB_DDL = "kind int, part int, blob binary"
#: Kinds of blob: runs by key, settled windows by document group, open runs by document group.
RUNS, MARKS, OPEN = 0, 1, 2


@dataclass(frozen=True)
class Shape:
    """width: units of a window; gram: units of an anchor; words: words or bytes; keep_first: whether the first of equal windows stays."""

    width: int
    gram: int
    words: bool
    keep_first: bool


def row_group(rows: np.ndarray, groups: int) -> np.ndarray:
    return (K.mix(rows.astype(np.uint64)) % np.uint64(groups)).astype(np.int32)


def units_of(data: np.ndarray, starts: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray, K.Words | None]:
    """Units of some joined texts, each text's first unit (one more at the end), and the words."""
    if words:
        w = K.Words(data, starts, K.word_class("space"), False)
        return w.hash, w.first, w
    return K.byte_values(False)[data], starts, None


def counter(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def runs_of(units: np.ndarray, first: np.ndarray, last: np.ndarray, rows: np.ndarray, shape: Shape, hot: np.ndarray | None = None) -> np.ndarray:
    """Runs of the windows of each text; a text's units are first to last - 1. hot: counters whose runs come window by window, keyed by content (None: keys only)."""
    n = len(units) - shape.width + 1
    if n <= 0:
        return np.zeros(0, RUN)
    grams = K.gram_hashes(units, shape.gram)
    bits = np.uint64(max(20, math.ceil(math.log2(len(grams) + 1))))
    low = (np.uint64(1) << bits) - np.uint64(1)
    anchor = (K.sliding_min(grams & ~low | np.arange(len(grams), dtype=np.uint64), shape.width - shape.gram + 1) & low).astype(np.int64)
    change = np.zeros(n + 1, np.int8)  # +1 where a text's windows begin, -1 behind them
    full = last - first >= shape.width
    np.add.at(change, first[full], 1)
    np.add.at(change, last[full] - shape.width + 1, -1)
    inside = np.cumsum(change[:n]) > 0
    begins = inside.copy()
    begins[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    begins[first[full]] = True
    start = np.flatnonzero(begins)
    stop = np.flatnonzero(inside & np.append((anchor[1:] != anchor[:-1]) | ~inside[1:] | begins[1:], True)) + 1

    def made(key, start, stop, spans):
        out = np.zeros(len(start), RUN)
        text = np.searchsorted(first, start, "right") - 1
        out["key"], out["row"], out["at"], out["n"] = key, rows[text], start - first[text], stop - start
        if spans is not None:
            out["same"] = spans.of(start, stop + shape.width - 1)
        return out

    key = grams[anchor[start]]
    if hot is None:
        return made(key, start, stop, None)
    spans = K.Spans(units)
    if not len(hot):
        return made(key, start, stop, spans)
    common = np.isin(counter(key), hot)
    size = (stop - start)[common]
    windows = np.repeat(start[common] - np.cumsum(size) + size, size) + np.arange(size.sum())
    single = made(spans.of(windows, windows + shape.width), windows, windows + 1, None)
    single["same"] = single["key"]
    return np.concatenate([made(key[~common], start[~common], stop[~common], spans), single])


def groups_of_equal(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by key, content, place; and where each group of equal runs begins in that order."""
    order = np.lexsort((runs["at"], runs["row"], runs["same"], runs["key"]))
    s = runs[order]
    new = np.ones(len(s), bool)
    new[1:] = (s["key"][1:] != s["key"][:-1]) | (s["same"][1:] != s["same"][:-1])
    return order, np.flatnonzero(new)


def marks_of(runs: np.ndarray) -> np.ndarray:
    out = np.zeros(len(runs), MARK)
    out["row"], out["at"], out["n"] = runs["row"], runs["at"], runs["n"]
    return out


def joined_marks(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Single windows as marks, neighbours together."""
    order = np.lexsort((at, row))
    row, at = row[order], at[order].astype(np.int64)
    begin = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))) if len(row) else np.zeros(0, np.int64)
    out = np.zeros(len(begin), MARK)
    out["row"], out["at"], out["n"] = row[begin], at[begin], np.diff(np.append(begin, len(row)))
    return out


def bundles(runs: np.ndarray, pieces: list[np.ndarray], most: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Runs of whole keys, of about ``most`` units together; a key with more makes a bundle of its own."""
    order = np.argsort(runs["key"], kind="stable")
    edge = np.flatnonzero(np.append(True, np.diff(runs["key"][order]) != 0)).tolist() + [len(order)]
    held: list[int] = []
    size = 0
    for i, j in zip(edge[:-1], edge[1:], strict=True):
        own = order[i:j].tolist()
        n = sum(len(pieces[k]) + 1 for k in own)
        if held and size + n > most:
            yield runs[held], [pieces[k] for k in held]
            held, size = [], 0
        held += own
        size += n
    if held:
        yield runs[held], [pieces[k] for k in held]


def blobs(kind: int, part: np.ndarray, items: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    if len(items):
        order = np.argsort(part, kind="stable")
        part, items = part[order], items[order]
        edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() + [len(part)]
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            yield kind, int(part[i]), items[i:j].tobytes()


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, part, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())], schema=BLOBS)


def unpack(column: pa.ChunkedArray, kinds: pa.ChunkedArray, kind: int, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(b for b, k in zip(column.to_pylist(), kinds.to_pylist(), strict=True) if k == kind), dtype)


def fold(runs: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Of equal runs the first goes on; the others are settled, as they are repeated whatever else there is."""
    order, begin = groups_of_equal(runs)
    s = runs[order]
    rest = np.ones(len(s), bool)
    rest[begin] = False
    size = np.diff(np.append(begin, len(s)))
    firsts = s[begin]
    firsts["more"] |= size > 1
    return firsts, marks_of(s[rest])


def text_runs(column: pa.Array, rows: np.ndarray, shape: Shape, hot: np.ndarray | None) -> Iterator[np.ndarray]:
    for i, j in K.passes(np.diff(K.raw(column)[0])):
        data, starts = K.joined(column, i, j)
        units, first, _ = units_of(data, starts, shape.words)
        yield runs_of(units, first[:-1], first[1:] if shape.words else first[1:] - 1, rows[i:j], shape, hot)


def survey(source: DataFrame, shape: Shape, hot_runs: int) -> tuple[int, np.ndarray]:
    """Bytes of all texts, and the counters of hot anchors: those beyond ``hot_runs`` runs and four times the mean of all counters."""

    def count(batches):
        held, size = [np.zeros(0, np.int64)], 0
        for batch in batches:
            column, rows = batch.column(1), batch.column(0).to_numpy()
            size += int(np.diff(K.raw(column)[0]).sum())
            for runs in text_runs(column, rows, shape, None):
                taken = K.mix(runs["key"] + K.mix(runs["row"].astype(np.uint64) + K.mix(runs["at"].astype(np.uint64)))) % np.uint64(COUNTED) == 0
                held.append(counter(runs["key"][taken]))
        at, n = np.unique(np.concatenate(held), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(n, size), pa.int64())], ["k", "n"])

    counts = cut(source.select("row", "t").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")))
    total, size = counts.agg(F.sum(F.when(F.col("k") >= 0, F.col("n"))), F.sum(F.when(F.col("k") < 0, F.col("n")))).first()
    least = max(hot_runs, 4 * COUNTED * (total or 0) >> COUNTER_BITS) / COUNTED
    # at most a quarter of the counters lie over four times their mean
    return size or 0, np.sort(counts.where((F.col("k") >= 0) & (F.col("n") >= least)).select("k").toArrow()["k"].to_numpy())


def find(docs: DataFrame, shape: Shape, settle: Callable[[np.ndarray, list[np.ndarray]], np.ndarray], finish: Callable[..., pa.RecordBatch], schema: str, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, hot_runs: int = HOT_RUNS) -> DataFrame:
    """One result row for each document; with carry, a struct ``rest`` of the document's other columns too.

    settle(runs, units) -> (row, at, n) of the windows to remove among open runs of the same keys, with each run's units.
    finish(ids, data, starts, marks of each text as (at, n) arrays) -> the result's rows.
    """
    carry = carry and len(set(docs.columns) - {id_col, text_col}) > 0
    text_batches(docs.sparkSession)
    source, _ = with_row(docs, id_col, text_col, carry)
    total, hot = survey(source, shape, hot_runs)
    hot = source.sparkSession.sparkContext.broadcast(hot)
    groups = max(1, math.ceil(total / GROUP_BYTES), int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def send(batches):
        held: list[np.ndarray] = []
        def flush():
            firsts, marks = fold(np.concatenate(held), shape)
            held.clear()
            return batch_of([*blobs(RUNS, (firsts["key"] % np.uint64(groups)).astype(np.int32), firsts), *blobs(MARKS, row_group(marks["row"], groups), marks)])
        for batch in batches:
            for runs in text_runs(batch.column(1), batch.column(0).to_numpy(), shape, hot.value):
                held.append(runs)
                if sum(map(len, held)) >= FLUSH_RUNS:
                    yield flush()
        if held:
            yield flush()

    def sieve(table: pa.Table) -> pa.Table:
        runs = unpack(table["blob"], table["kind"], RUNS, RUN)
        out = [(MARKS, p, b) for k, p, b in zip(table["kind"].to_pylist(), table["part"].to_pylist(), table["blob"].to_pylist(), strict=True) if k == MARKS]
        if len(runs):
            keys = np.sort(runs["key"])
            again = np.unique(keys[1:][keys[1:] == keys[:-1]])
            at = np.minimum(np.searchsorted(again, runs["key"]), max(len(again) - 1, 0))
            hit = again[at] == runs["key"] if len(again) else np.zeros(len(runs), bool)
            # runs that a flush had folded are repeated even if no other flush has them
            alone = runs[~hit & (runs["more"] > 0)]
            firsts, marks = fold(runs[hit], shape)
            if not shape.keep_first:
                marks = np.concatenate([marks, marks_of(firsts[firsts["more"] > 0]), marks_of(alone)])
            same_key = firsts["key"][1:] == firsts["key"][:-1]
            several = np.append(same_key, False) | np.append(False, same_key)
            opened = firsts[several] if len(firsts) else firsts
            out += [*blobs(MARKS, row_group(marks["row"], groups), marks), *blobs(OPEN, row_group(opened["row"], groups), opened)]
        return pa.Table.from_batches([batch_of(out)])

    def fetch(_, left: pa.Table, right: pa.Table) -> pa.Table:
        """The units of each open run, from its text."""
        runs = unpack(right["blob"], right["kind"], OPEN, RUN)
        out = []
        if len(runs) and left.num_rows:
            row = left["row"].to_numpy()
            order = np.argsort(runs["row"], kind="stable")
            runs = runs[order]
            column = left["t"].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            low, high = np.searchsorted(runs["row"], row), np.searchsorted(runs["row"], row, "right")
            need = np.flatnonzero(high > low)
            for k in need.tolist():
                data, starts = K.joined(column, k, k + 1)
                units, _, _ = units_of(data, starts, True) if shape.words else (data, None, None)
                for run in runs[low[k] : high[k]]:
                    piece = units[int(run["at"]) : int(run["at"]) + int(run["n"]) + shape.width - 1]
                    out.append((int(run["key"] % np.uint64(groups)), run.tobytes() + piece.tobytes()))
        by: dict[int, list[bytes]] = {}
        for p, b in out:
            by.setdefault(p, []).append(b)
        return pa.Table.from_batches([batch_of([(OPEN, p, b"".join(x)) for p, x in by.items()])])

    def decide(table: pa.Table) -> pa.Table:
        runs, pieces, unit = [], [], np.dtype("<u8") if shape.words else np.dtype("u1")
        for blob in table["blob"].to_pylist():
            at = 0
            while at < len(blob):
                run = np.frombuffer(blob, RUN, 1, at)
                at += RUN.itemsize
                n = int(run["n"][0]) + shape.width - 1
                runs.append(run)
                pieces.append(np.frombuffer(blob, unit, n, at))
                at += n * unit.itemsize
        marks = settle(np.concatenate(runs), pieces) if runs else np.zeros(0, MARK)
        return pa.Table.from_batches([batch_of([*blobs(MARKS, row_group(marks["row"], groups), marks)])])

    def apply(_, left: pa.Table, right: pa.Table) -> pa.Table:
        marks = unpack(right["blob"], right["kind"], MARKS, MARK)
        marks = marks[np.lexsort((marks["at"], marks["row"]))]
        out = []
        for batch in left.to_batches():
            ids, row, column = batch.column("id"), batch.column("row").to_numpy(), batch.column("t")
            low, high = np.searchsorted(marks["row"], row), np.searchsorted(marks["row"], row, "right")
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                data, starts = K.joined(column, i, j)
                done = finish(ids.slice(i, j - i), data, starts, [marks[a:b] for a, b in zip(low[i:j], high[i:j], strict=True)])
                out.append(done.append_column("rest", batch.column("rest").slice(i, j - i)) if carry else done)
        return pa.Table.from_batches(out) if out else None

    packed = source.select("row", "t").mapInArrow(send, BLOB_DDL)
    sieved = cut(packed.groupBy("part").applyInArrow(sieve, BLOB_DDL))

    def group_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(row_group(batch.column(0).to_numpy(), groups)), *batch.columns], names=["part", *batch.schema.names])

    by_group = source.select("row", "id", "t", *["rest"] * carry)
    rest = f", rest {by_group.schema['rest'].dataType.simpleString()}" if carry else ""
    by_group = by_group.mapInArrow(group_of, f"part int, row long, id long, t binary{rest}")
    opened = by_group.groupBy("part").cogroup(sieved.where(F.col("kind") == OPEN).groupBy("part")).applyInArrow(fetch, BLOB_DDL)
    settled = opened.groupBy("part").applyInArrow(decide, BLOB_DDL)
    marks = sieved.where(F.col("kind") == MARKS).unionByName(settled)
    return by_group.groupBy("part").cogroup(marks.groupBy("part")).applyInArrow(apply, schema + rest)
