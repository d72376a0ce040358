"""Repeated windows with anchors that very many texts share, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from strandline.llm import repeats, substring_dedup, suffix_array_dedup
from test_operators import brute_bytes, odd_texts, prose, sha

DOCS = "doc_id long, text string, row long, rest string, part int, `kept` string, t string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", 2, "k", "t") for i, t in rows], DOCS)


def common_line_texts(n=120):
    """A 20-word line in different surroundings, in half of the texts a whole repeated passage, and odd texts."""
    line, passage = prose(20, 50), prose(45, 51)
    rng = random.Random(2)
    texts = [" ".join(prose(40, 100 + k) + line + prose(30, 300 + k) + (passage if rng.random() < 0.5 else [])) for k in range(n)]
    return [*texts, *odd_texts(), *texts[:9]]


def brute_words(rows, width=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - width + 1):
            seen[tuple(w[i : i + width])] = seen.get(tuple(w[i : i + width]), 0) + 1
    out = []
    for (k, _), w in zip(rows, words, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        left = [x for x, y in zip(w, keep, strict=True) if y]
        out.append((k, len(w), len(w) - len(left), sha(" ".join(left).encode())))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [2, repeats.HOT_RUNS])
def test_words_with_common_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "COUNTED", 1)
    rows = list(enumerate(common_line_texts()))
    got = substring_dedup.remove_repeated_words(docs_of(spark, rows), hot_runs=hot).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_words(rows)


@pytest.mark.parametrize("hot", [2, repeats.HOT_RUNS])
def test_bytes_with_common_anchors(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "COUNTED", 1)
    texts = common_line_texts()
    got = suffix_array_dedup.remove_repeated_bytes(docs_of(spark, list(enumerate(texts))), hot_runs=hot).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert {tuple(r) for r in got} == brute_bytes(texts) and len(got) == len(texts)


def test_rows_that_share_an_id(spark):
    """Each row is a document of its own, null ids too."""
    texts = common_line_texts(30)
    rows = [((None, 3, 4)[k % 3], t) for k, t in enumerate(texts)]
    got = substring_dedup.remove_repeated_words(docs_of(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_words(rows)
    out = suffix_array_dedup.remove_repeated_bytes(docs_of(spark, rows)).collect()
    # of every repeated string one stays, whichever row comes first
    assert len(out) == len(rows) and sum(r.n_bytes for r in out) == sum(len((t or "").encode()) for t in texts)
    twice = docs_of(spark, [(5, " ".join(prose(50, 9)))] * 3)
    assert sorted(r.n_removed > 0 for r in suffix_array_dedup.remove_repeated_bytes(twice).collect()) == [False, True, True]


def test_a_common_line_spreads_over_tasks(spark, monkeypatch):
    """One line in every text: no key of the exchange has more runs than the bound and a few."""
    monkeypatch.setattr(repeats, "COUNTED", 1)
    line = prose(20, 70)
    column = repeats.pa.array([" ".join(prose(40, 1000 + k) + line + prose(40, 9000 + k)).encode() for k in range(400)], repeats.pa.binary())
    shape = repeats.Shape(35, 12, True, False)
    rows = np.arange(400)
    before = np.concatenate(list(repeats.text_runs(column, rows, shape, np.zeros(0, np.int64))))
    assert np.unique(before["key"], return_counts=True)[1].max() > 60
    source = spark.createDataFrame([(k, bytearray(t)) for k, t in enumerate(column.to_pylist())], "row long, t binary")
    size, hot = repeats.survey(source, shape, 40)
    assert size == sum(map(len, column.to_pylist())) and len(hot)
    after = np.concatenate(list(repeats.text_runs(column, rows, shape, hot)))
    assert np.unique(after["key"], return_counts=True)[1].max() < 40


def test_nodes_are_the_longest_common_prefixes():
    """Depth and leaves of the topmost deep nodes, by brute force."""
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2, 120).astype(np.int32)
    suffixes, ends = np.arange(100), np.full(100, 110)
    nodes = substring_dedup.internal_nodes(words, suffixes, 0, 6, ends)
    groups: dict[tuple, list[int]] = {}
    for k in suffixes.tolist():
        groups.setdefault(tuple(words[k : k + 6]), []).append(k)
    expected = []
    for own in groups.values():
        if len(own) > 1:
            n = 6
            while all(k + n < 110 for k in own) and len({words[k + n] for k in own}) == 1:
                n += 1
            expected.append((n, sorted(own)))
    assert sorted((d, sorted(x.tolist())) for d, x in nodes) == sorted(expected)
