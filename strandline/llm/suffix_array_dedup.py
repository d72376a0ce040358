"""Removal of repeated byte strings by threshold-bounded interval expansion on a Burrows-Wheeler transform.

The suffixes of a bundle of texts are sorted as far as the threshold; breadth-first backward extension over a wavelet matrix of
the transform then finds common prefix lengths by increasing value: an interval that ends at a boundary not met
before sets it to the current length and is extended further. Boundaries still unset at the threshold separate
suffixes that share at least that many bytes. Strings that are equal by their hash, and those around anchors that too many texts
share, are settled before that (see ``repeats``).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm import repeats

#: Bytes of one transform.
BUNDLE = 500_000


def sorted_suffixes(symbols: np.ndarray, least: int) -> np.ndarray:
    """Cyclic suffixes in the order of at least their first ``least`` symbols, by prefix doubling."""
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    known = max(1, 62 // bits)
    packed = np.zeros(n, np.int64)
    for k in range(known):
        packed = packed << bits | np.roll(symbols, -k)
    while True:
        order = np.argsort(packed, kind="stable")
        s = packed[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(0, s[1:] != s[:-1]))
        if known >= least or rank[order[-1]] == n - 1:
            return order
        packed = rank * n + np.roll(rank, -known)
        known *= 2


class Wavelet:
    """Wavelet matrix of a sequence of small integers: all symbols of an interval, with their ranks, many intervals at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        x = symbols
        for b in reversed(range(bits)):
            bit = (x >> b & 1).astype(bool)
            ones = np.zeros(len(x) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append(ones)
            self.zeros.append(len(x) - int(ones[-1]))
            x = np.concatenate([x[~bit], x[bit]])
        counts = np.bincount(symbols, minlength=1 << bits)
        self.less = np.concatenate([[0], np.cumsum(counts)])
        self.base = np.zeros(1 << bits, np.int64)  # where each symbol stands in the last level
        order = sorted(range(1 << bits), key=lambda c: int(f"{c:0{bits}b}"[::-1], 2))
        self.base[order] = np.cumsum([0, *counts[order]])[:-1]

    def extend(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of c + w for every symbol c before some w, from the intervals of each w."""
        symbol = np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.levels, self.zeros, strict=True):
            l1, h1 = ones[low], ones[high]
            l0, h0 = low - l1, high - h1
            left, right = h0 > l0, h1 > l1
            low = np.concatenate([l0[left], l1[right] + zeros])
            high = np.concatenate([h0[left], h1[right] + zeros])
            symbol = np.concatenate([symbol[left] << 1, symbol[right] << 1 | 1])
        shift = self.less[symbol] - self.base[symbol]
        return low + shift, high + shift


def bounded_boundaries(wavelet: Wavelet, n: int, threshold: int) -> np.ndarray:
    """Whether sorted suffix k has less than ``threshold`` symbols in common with suffix k - 1 (of n; one more at the end)."""
    met = np.zeros(n + 1, bool)
    met[0] = met[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(threshold):
        low, high = wavelet.extend(low, high)
        new = ~met[high]
        low, high = low[new], high[new]
        met[high] = True
        # the first interval of a level that ends at n is kept by its left neighbour's end
        if not len(low):
            break
    return met


def equal_windows(pieces: list[np.ndarray], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts (in the pieces with one separator after each) in suffix order, and a group number each; equal windows share it."""
    total = sum(map(len, pieces)) + len(pieces)
    symbols = np.zeros(total, np.int64)
    at, starts = 0, []
    for piece, n in zip(pieces, counts.tolist(), strict=True):
        symbols[at : at + len(piece)] = piece.astype(np.int64) + 1
        starts.append(np.arange(at, at + n))
        at += len(piece) + 1
    alphabet, symbols = np.unique(symbols, return_inverse=True)
    bits = max(1, int(len(alphabet) - 1).bit_length())
    order = sorted_suffixes(symbols, width + 1)
    boundary = bounded_boundaries(Wavelet(symbols[order - 1], bits), total, width)
    group = np.cumsum(boundary[:-1])
    window = np.zeros(total, bool)
    window[np.concatenate(starts)] = True
    keep = window[order]
    return order[keep], group[keep]


def settle(shape: repeats.Shape, bundle: int = BUNDLE):
    def run(runs: np.ndarray, pieces: list[np.ndarray]) -> np.ndarray:
        rows, ats = [], []
        for own, parts in repeats.bundles(runs, pieces, bundle):
            start, group = equal_windows(parts, own["n"], shape.width)
            base = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
            k = np.searchsorted(base, start, "right") - 1
            row, at = own["row"][k], own["at"][k] + (start - base[k])
            order = np.lexsort((at, row, group))
            later = np.append(False, group[order][1:] == group[order][:-1])
            rows.append(row[order][later])
            ats.append(at[order][later])
        if not rows:
            return np.zeros(0, repeats.MARK)
        return repeats.joined_marks(np.concatenate(rows), np.concatenate(ats))

    return run


def remove_repeated_bytes(docs: DataFrame, width: int = 100, gram: int = 40, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, hot_runs: int = repeats.HOT_RUNS) -> DataFrame:
    """Each document without the bytes that a ``width``-byte string covers which also starts earlier: id, n_bytes, n_removed, n_spans, kept_sha256, kept.

    Earlier is a smaller id, or the same document and an earlier start; a null id is the smallest. Strings never
    cross documents and are judged on the input. Null texts are empty. Of rows that share an id the one with the smaller text
    hash counts as earlier, and of wholly equal rows one. ``kept`` is the remaining text (n_* and kept_sha256 count
    bytes; of a character that a removed string cuts in two, nothing stays in ``kept``). carry: adds ``rest``, the other columns. Texts of any length are read whole. hot_runs: from how many windows' runs on an anchor counts as too common.
    """
    shape = repeats.Shape(width, gram, words=False, keep_first=True)

    def finish(ids, data, starts, marks):
        n, removed, spans, sha, kept = [], [], [], [], []
        for k, own in enumerate(marks):
            text = data[starts[k] : starts[k + 1] - 1]
            n.append(len(text))
            runs = 0
            if len(own):
                keep = np.ones(len(text), bool)
                for at, m in zip(own["at"].tolist(), own["n"].tolist(), strict=True):
                    keep[at : at + m + width - 1] = False
                runs = int(np.count_nonzero(np.diff(np.append(True, keep).astype(np.int8)) == -1))
                text = text[keep]
            removed.append(n[-1] - len(text))
            spans.append(runs)
            sha.append(hashlib.sha256(text.tobytes()).hexdigest())
            kept.append(text.tobytes().decode("utf-8", "ignore"))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        )

    out = repeats.find(docs, shape, settle(shape), finish, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string", id_col, text_col, carry, hot_runs)
    return out.withColumnRenamed("id", id_col)
