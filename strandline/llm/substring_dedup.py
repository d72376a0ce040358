"""Removal of repeated word sequences with prefix-partitioned suffix trees.

Suffixes that may begin a repeated window are split by prefixes of variable length, in two stages: between tasks by an anchor inside the window,
or by the whole window where an anchor is too common (see ``repeats``); inside a task by a first word, lengthened word by word until the
suffixes that share the prefix fit the memory bound. Each group's subtree is its sorted suffixes with the common prefix lengths of
neighbours; an internal node is an interval of these, and the topmost nodes at or below the window's depth are the repeats, each
of all its leaves. Whole copies are settled by their hash before that.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandline.llm import repeats

#: Suffixes of one subtree, and words of one bundle of keys.
SUBTREE, BUNDLE = 20_000, 300_000


def prefix_groups(words: np.ndarray, suffixes: np.ndarray, width: int, most: int = SUBTREE):
    """(prefix length, suffixes that share it) of at most ``most`` suffixes each, or of suffixes that share all ``width`` words."""
    stack = [(0, suffixes)]
    while stack:
        depth, own = stack.pop()
        if len(own) < 2:
            continue
        if len(own) <= most or depth == width:
            yield depth, own
            continue
        word = words[own + depth]
        order = np.argsort(word, kind="stable")
        edge = np.flatnonzero(np.append(True, np.diff(word[order]) != 0)).tolist() + [len(own)]
        small = []
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            if j - i > most:
                stack.append((depth + 1, own[order[i:j]]))
            elif j - i > 1:
                small.append((i, j))
        # prefixes that are not lengthened share subtrees up to the bound
        held, size = [], 0
        for i, j in small:
            if size + j - i > most:
                yield depth, np.concatenate(held)
                held, size = [], 0
            held.append(own[order[i:j]])
            size += j - i
        if held:
            yield depth, np.concatenate(held)


def internal_nodes(words: np.ndarray, suffixes: np.ndarray, depth: int, width: int, ends: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(depth in words, leaves) of each topmost node at depth >= width of the subtree of suffixes that share ``depth`` words; a suffix stops before its own end."""
    reach = np.arange(depth, max(int((ends - suffixes).max()), width))
    at = suffixes[:, None] + reach
    columns = np.where(at < ends[:, None], words[np.minimum(at, len(words) - 1)], -1)
    order = np.lexsort(columns.T[::-1]) if len(reach) else np.arange(len(suffixes))
    columns = columns[order]
    equal = (columns[1:] == columns[:-1]) & (columns[1:] >= 0)
    common = depth + np.cumprod(equal, axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)  # of neighbouring leaves
    edge = np.flatnonzero(np.append(True, common < width)).tolist() + [len(order)]
    return [(int(common[i : j - 1].min()), suffixes[order[i:j]]) for i, j in zip(edge[:-1], edge[1:], strict=True) if j - i > 1]


def deep_nodes(words: np.ndarray, suffixes: np.ndarray, depth: int, width: int, ends: np.ndarray | None = None) -> list[np.ndarray]:
    """Leaves of each topmost node at depth >= width."""
    return [leaves for _, leaves in internal_nodes(words, suffixes, depth, width, np.full(len(suffixes), len(words)) if ends is None else ends)]


def settle(shape: repeats.Shape, bundle: int = BUNDLE, subtree: int = SUBTREE):
    def run(runs: np.ndarray, pieces: list[np.ndarray]) -> np.ndarray:
        found = []
        for own, parts in repeats.bundles(runs, pieces, bundle):
            _, words = np.unique(np.concatenate(parts), return_inverse=True)
            words = words.astype(np.int32)
            base = np.cumsum([0, *map(len, parts)])[:-1]
            n = own["n"].astype(np.int64)
            suffixes = np.repeat(base - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
            run_of = np.repeat(np.arange(len(own)), n)
            where = np.zeros(len(words), np.int64)
            where[suffixes] = run_of
            stop = base + np.fromiter(map(len, parts), np.int64, len(parts))
            for depth, group in prefix_groups(words, suffixes, shape.width, subtree):
                for leaves in deep_nodes(words, group, depth, shape.width, stop[where[group]]):
                    k = where[leaves]
                    found.append((own["row"][k], own["at"][k] + (leaves - base[k])))
        if not found:
            return np.zeros(0, repeats.MARK)
        return repeats.joined_marks(np.concatenate([r for r, _ in found]), np.concatenate([a for _, a in found]))

    return run


def remove_repeated_words(docs: DataFrame, width: int = 35, gram: int = 12, id_col: str = "doc_id", text_col: str = "text", hot_runs: int = repeats.HOT_RUNS) -> DataFrame:
    """Each document without the words that a repeated window of ``width`` words covers: id, n_words, n_removed, kept_sha256, kept.

    Words are runs of anything but ASCII white space. Every occurrence of a repeated window goes, the first too, in the same
    document or another; windows are judged on the input. Null and empty texts have no words; texts of any length are read whole. Rows that repeat an
    id count as documents of their own; other columns are not read. hot_runs: from how many windows' runs on an anchor counts as too common.
    """
    shape = repeats.Shape(width, gram, words=True, keep_first=False)

    def finish(ids, data, starts, marks):
        n, removed, sha, kept = [], [], [], []
        raw = data.tobytes()
        for k, own in enumerate(marks):
            words = raw[starts[k] : starts[k + 1]].split()
            n.append(len(words))
            if len(own):
                keep = np.ones(len(words), bool)
                for at, m in zip(own["at"].tolist(), own["n"].tolist(), strict=True):
                    keep[at : at + m + width - 1] = False
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            removed.append(n[-1] - len(words))
            kept.append(b" ".join(words))
            sha.append(hashlib.sha256(kept[-1]).hexdigest())
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["id", "n_words", "n_removed", "kept_sha256", "kept"])

    out = repeats.find(docs, shape, settle(shape), finish, "id long, n_words long, n_removed long, kept_sha256 string, kept binary", id_col, text_col, hot_runs=hot_runs)
    return out.withColumn("kept", out["kept"].cast("string")).withColumnRenamed("id", id_col)
