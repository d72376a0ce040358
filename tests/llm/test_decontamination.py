"""Contaminated documents against tiling of all pairs."""

from __future__ import annotations

import random

import pytest

from strandline.llm import decontamination

DOCS = "doc_id long, text string, item long, id long, h long, seed long, t string, `a.b` string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "t", "x") for i, t in rows], DOCS)


def brute(docs, items, least=5, coverage=0.5):
    best = {}
    low = lambda x: -(2**63) if x is None else x
    for i, t in docs:
        text = decontamination.tokens((t or "").encode())
        for k, p in items:
            pattern = decontamination.tokens((p or "").encode())
            got = decontamination.tiles(pattern, text, least)
            covered = sum(n for _, _, n in got)
            if len(pattern) >= least and covered >= coverage * len(pattern):
                new = (covered / len(pattern), len(pattern), covered, len(got))
                best[low(i), low(k)] = max(best.get((low(i), low(k)), new), new)
    return best


def tables(seed):
    """Items of few distinct words (repeated seeds), a seed that stands everywhere, repeated and null ids, reordered and partial passages, long texts."""
    rng = random.Random(seed)
    word = lambda n: [f"q{rng.randrange(n)}" for _ in range(1)][0]
    common = ["what", "is", "the", "value", "of", "this"]
    items, docs = [], []
    for k in range(25):
        size = rng.randrange(4, 60)
        vocabulary = rng.choice([2, 4, 40, 4000])
        item = [word(vocabulary) for _ in range(size)]
        if k % 2:
            item = common + item
        items.append((rng.choice([None, k, k, k, 3]), " ".join(item)))
    for k in range(120):
        text = [word(3000) for _ in range(rng.randrange(0, 80))]
        if k % 3 == 0:
            text = text + common
        for _ in range(rng.randrange(3)):
            p = rng.choice(items)[1].split()
            cut = rng.randrange(len(p) + 1)
            p = p[cut:] + p[:cut] if rng.random() < 0.5 else p[: rng.randrange(1, len(p) + 1)]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + p + text[at:]
        docs.append((rng.choice([None, k, k, k, 7]), " ".join(text)))
    long = [word(3000) for _ in range(9000)]
    docs += [(500, " ".join(long[:5000] + items[4][1].split() + long[5000:])), (501, None), (502, ""), docs[3], docs[3]]
    return docs, [*items, (60, None), (61, "a b c"), items[2]]


@pytest.mark.parametrize("seed", [1, 2])
def test_contaminated_is_tiling_of_all_pairs(spark, seed):
    docs, items = tables(seed)
    got = decontamination.contaminated(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = brute(docs, items)
    assert len(expected) > 20 and len(got) == len(expected)
    assert {(r.doc_id, r.item_id): (r.coverage, r.n_item_words, r.n_covered, r.n_tiles) for r in got} == expected


def test_full_maps_only_send_more(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAP_BITS", 3)
    docs, items = tables(3)
    got = decontamination.contaminated(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): (r.coverage, r.n_item_words, r.n_covered, r.n_tiles) for r in got} == brute(docs, items)
