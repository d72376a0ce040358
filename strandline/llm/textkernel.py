"""Vectorised numpy kernels over Arrow batches of UTF-8 text: word hashes, rolling hashes, minimisers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes that one numpy pass handles; a longer text makes a pass of its own.
PASS_BYTES = 1 << 17
MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
MULT2 = np.uint64(0xC2B2AE3D27D4EB4F | 1)


def word_class(pattern: str) -> np.ndarray:
    """space: all bytes but white space 0x20, 0x09-0x0D. alnum: digits, ASCII letters and bytes over 0x7F."""
    b = np.arange(256)
    if pattern == "space":
        return (b != 0x20) & ~((b >= 0x09) & (b <= 0x0D))
    return ((b >= 0x30) & (b <= 0x39)) | ((b >= 0x41) & (b <= 0x5A)) | ((b >= 0x61) & (b <= 0x7A)) | (b >= 0x80)


@cache
def byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * MULT2)
    if lower:
        values[0x41:0x5B] = values[0x61:0x7B]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, PASS_BYTES + 64), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 8 * PASS_BYTES:
            _powers[int(base)] = have
    return have[:n]


@cache
def inverse(base: int) -> np.uint64:
    return np.uint64(pow(base, -1, 1 << 64))


class Spans:
    """Hash of any span of a sequence of 64-bit units from prefix sums."""

    def __init__(self, units: np.ndarray, base: np.uint64 = MULT):
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * powers(base, len(units)), out=self.sums[1:])
        self.shift = powers(inverse(int(base)), len(units) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.shift[start] + (end - start).astype(np.uint64))


def passes(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about PASS_BYTES each."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > PASS_BYTES:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(lengths):
        yield start, len(lengths)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary column, without a copy."""
    if pa.types.is_large_binary(column.type):
        width = np.int64
    else:
        width = np.int32
    if len(column) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width, len(column) + 1, column.offset * np.dtype(width).itemsize).astype(np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def joined(column: pa.Array, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts i to j - 1 with one space byte after each, and where each starts (one more at the end)."""
    at, data = raw(column)
    lengths = np.diff(at[i : j + 1])
    out = np.full(int(lengths.sum()) + j - i, 0x20, np.uint8)
    starts = np.zeros(j - i + 1, np.int64)
    np.cumsum(lengths + 1, out=starts[1:])
    for k in range(j - i):
        out[starts[k] : starts[k] + lengths[k]] = data[at[i + k] : at[i + k + 1]]
    return out, starts


class Words:
    """Words of a few texts: byte spans, 64-bit hashes and the text of each word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, is_word: np.ndarray, lower: bool):
        inside = is_word[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(data) and inside[0]:
            edge = np.concatenate([[0], edge])
        self.data, self.start, self.end = data, edge[0::2], edge[1::2]  # the last byte is a space
        self.spans = Spans(byte_values(lower)[data])
        self.hash = self.spans.of(self.start, self.end) if len(self.start) else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.start, starts)  # of each text; one more at the end
        self.n = np.diff(self.first)
        self.text = np.repeat(np.arange(len(self.n)), self.n)


def shingles(words: np.ndarray, text: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, and the index of their first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * MULT2 + words[i : i + n]
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    return mix(h[at]), at


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def gram_hashes(units: np.ndarray, m: int) -> np.ndarray:
    """Hash of every run of m units, built by doubling."""
    parts, have, h = [], 1, units
    total, out = 0, None
    base = int(MULT)
    while True:
        power = np.uint64(base)
        if m & have:
            if out is None:
                out, total = h, have
            else:
                n = len(units) - total - have + 1
                out = out[: max(n, 0)] * power + h[total : total + max(n, 0)]
                total += have
        if have * 2 > m:
            break
        h = h[: len(h) - have] * power + h[have:]
        base = base * base % (1 << 64)
        have *= 2
    return mix(out)
