"""Classifiers: odd rows, few labels, and corpus counts of terms."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from strandline.llm import classifiers, pu_learning

DOCS = "doc_id long, text string, score string, t string, positive int, drawn int, h string, p string"
LABELS = "doc_id long, quality int, toxic int, lang string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "s", "t", 1, 2, "h", "p") for i, t in rows], DOCS)


def corpus(n, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + ["grumbleword", "snarlterm"] * toxic
        junk = k % 7 == 0
        rng.shuffle(words)
        rows.append((k, " ".join(w.upper() + "!!!" if junk else w for w in words)))
        if k % 2 == 0:
            labels.append((k, int(not junk), int(toxic), "en"))
    return rows, labels


def test_odd_rows_are_scored(spark):
    """Null and empty texts, repeated rows, null ids, clashing names, a very long text: one score for each row."""
    rows, labels = corpus(400)
    odd = [(1000, None), (1001, ""), (None, "a text"), (None, None), rows[3], rows[3], (1002, "long word " * 50000)]
    docs, known = docs_of(spark, rows + odd), spark.createDataFrame(labels, LABELS)
    for f in (classifiers.quality, classifiers.toxicity):
        got = f(docs, known).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows + odd)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
        score = {r.doc_id: r.score for r in got}
        assert score[1000] == score[1001]
    kept = classifiers.quality(docs, known, accept=True)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows + odd)
    toxic = {r.doc_id: r.predicted for r in classifiers.toxicity(docs, known).collect()}
    assert np.mean([toxic[k] == (k % 5 == 0) for k in range(400)]) > 0.97


def test_few_and_no_labels(spark):
    """Nobody is toxic without toxic examples, everything is good without labels, and a handful of positives makes a model."""
    rows, labels = corpus(200)
    docs = docs_of(spark, rows)
    none = spark.createDataFrame([], LABELS)
    assert classifiers.toxicity(docs, none).where("predicted = 1").isEmpty()
    assert classifiers.quality(docs, none).where("predicted = 0").isEmpty()
    for n in (1, 3, 6, 12):
        few = [x for x in labels if x[2]][:n]
        got = classifiers.toxicity(docs, spark.createDataFrame(few, LABELS)).collect()
        wrong = [r.doc_id for r in got if r.predicted and r.doc_id % 5]
        assert len(wrong) <= 10, n


def test_term_counts_are_brute_force(spark):
    rows = [(k, t) for k, t in enumerate(["Word word other", "word", None, "", "longerword LONGERWORD longerword longerword"])]
    t = docs_of(spark, rows).select(F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("t"))
    every = {r.h: r.n for r in classifiers.term_counts(t).collect()}
    some = np.sort(np.array(list(every)[::2], np.int64).view(np.uint64))
    assert {r.h: r.n for r in classifiers.term_counts(t, some).collect()} == {h: every[h] for h in some.view(np.int64).tolist()}
    # word, other, longerword, five stems of it, "othe": each once, and those that a text holds twice or three times
    assert sorted(every.values()) == [1] * (len(every) - 1) + [2]


def test_prior_and_risk():
    """The prior of a known mixture, and a risk that does not fall below zero."""
    rng = np.random.default_rng(3)
    positive = rng.normal(2, 1, (2000, 3))
    unlabelled = np.concatenate([rng.normal(2, 1, (900, 3)), rng.normal(-2, 1, (2100, 3))])
    model, prior = pu_learning.fit(positive, unlabelled)
    assert abs(prior - 0.3) < 0.05
    assert (model.score(unlabelled[:900]) >= 0.5).mean() > 0.95 and (model.score(unlabelled[900:]) >= 0.5).mean() < 0.05
    assert pu_learning.estimate_prior(np.zeros(30), np.zeros(90)) is None
    assert np.allclose(pu_learning.constant(3, 0.2).score(positive[:4]), 0.2)
