"""Near duplicates against brute force: every pair of rows compared."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from strandline.llm import near_dup

DOCS = "doc_id long, text string, id long, component long, node long, bucket long, `a.b` string, h long, row long, t string"
NULL = -(2**63)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "x", 5, 6, "y") for i, t in rows], DOCS)


def words(rng, n):
    return [f"w{rng.randrange(3000)}x" for _ in range(n)]


def brute(spark, rows, threshold=0.8):
    """Class of each row, and the similarities of all pairs."""
    idf = near_dup.document_frequencies(docs_of(spark, rows), "text")
    v = near_dup.Vectors(pa.array([(t or "").encode() for _, t in rows], pa.binary()), idf)
    every = np.arange(len(rows))
    s = v.similarities(every, every)
    ids = [NULL if i is None else i for i, _ in rows]
    texts = [t or "" for _, t in rows]
    label = list(range(len(rows)))
    link = [[k for k in range(len(rows)) if k != j and (s[j, k] >= threshold or texts[j] == texts[k] or ids[j] == ids[k])] for j in range(len(rows))]
    changed = True
    while changed:
        changed = False
        for j in range(len(rows)):
            low = min([label[j], *(label[k] for k in link[j])])
            changed |= low < label[j]
            label[j] = low
    least = {}
    for j, c in enumerate(label):
        least[c] = min(least.get(c, ids[j]), ids[j])
    return sorted((ids[j], least[label[j]]) for j in range(len(rows))), s


def family(rng, n, copies, rate):
    base = words(rng, n)
    return [" ".join(w if rng.random() > rate else "z" + w for w in base) for _ in range(copies)]


def cases():
    rng = random.Random(3)
    texts = [None, "", " !? ", "one", "One!", "a b c d", "a, b c d", *[" ".join(words(rng, 60)) for _ in range(10)]]
    for rate in (0.005, 0.01, 0.015, 0.02, 0.03):
        texts += family(rng, 120, 12, rate)
    hot = words(rng, 100)
    texts += [" ".join(hot + words(rng, 60)) for _ in range(20)]
    long = words(rng, 12000)
    texts += [" ".join(long), " ".join(long[:6000] + ["other"] + long[6000:]), " ".join(words(rng, 9000))]
    texts += texts[20:26]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [128, 3])
def test_classes_are_brute_force(spark, monkeypatch, block):
    """Near copies on both sides of the threshold, a common passage, long texts, repeated texts, clashing column names."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = list(enumerate(cases()))
    expected, s = brute(spark, rows)
    near = np.triu((s > 0.75) & (s < 0.85), 1).sum()
    assert near > 30
    got = near_dup.classes(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id, r.class_id) for r in got) == expected
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_rows_that_share_an_id(spark):
    """Each row is compared by its own text; ids that several rows have, and null ids, join their rows."""
    rng = random.Random(8)
    texts = cases()
    ids = [rng.choice([None, *range(6)]) if k % 9 == 0 else 10 + k for k in range(len(texts))]
    rows = list(zip(ids, texts, strict=True))
    assert sorted((r.doc_id, r.class_id) for r in near_dup.classes(docs_of(spark, rows)).collect()) == brute(spark, rows)[0]
    base = words(rng, 80)
    three = [(1, " ".join(words(rng, 80))), (1, " ".join(base)), (2, " ".join([*base[:-1], "end"]))]
    assert {(r.doc_id, r.class_id) for r in near_dup.classes(docs_of(spark, three)).collect()} == {(1, 1), (2, 1)}


def test_pairs_at_the_threshold_share_a_bucket(spark):
    """Recall of the bands alone, over pairs of similarity 0.8 to 0.9."""
    rng = random.Random(5)
    texts = [t for k in range(150) for t in family(rng, 100, 2, 0.011)]
    idf = near_dup.document_frequencies(docs_of(spark, list(enumerate(texts))), "text")
    column = pa.array([t.encode() for t in texts], pa.binary())
    v = near_dup.Vectors(column, idf)
    data, starts = near_dup.K.joined(column, 0, len(texts))
    shingles = near_dup.weighted_shingles(near_dup.K.Words(data, starts, near_dup.K.word_class("alnum"), True), idf)
    which, rows = near_dup.bands(*shingles, len(texts), near_dup.parameters())
    assert len(which) == len(texts)
    hit = [bool((rows[k] == rows[k + 1]).any()) for k in range(0, len(texts), 2) if 0.8 <= v.similarities(np.array([k]), np.array([k + 1]))[0, 0] < 0.9]
    assert len(hit) > 30 and np.mean(hit) >= 0.99


def test_no_rows_grow_with_the_square_of_a_group(spark):
    """A group just under the threshold: rows sent to be compared stay linear."""
    rng = random.Random(4)
    texts = family(rng, 90, 400, 0.013)
    docs = docs_of(spark, list(enumerate(texts)))
    sent = []
    whole = near_dup.links

    def counted(work, *rest):
        sent.append(work.count())
        return whole(work, *rest)

    near_dup.links, before = counted, whole
    try:
        near_dup.classes(docs).count()
    finally:
        near_dup.links = before
    # 14 buckets a text, each text once for each block of its bucket
    assert all(n <= 14 * 400 * (1 + 400 // near_dup.BLOCK) for n in sent)
