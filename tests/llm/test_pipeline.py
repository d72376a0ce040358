"""The pipeline's stages against brute force over small tables with odd rows."""

from __future__ import annotations

import random

import pytest
import sentencepiece
from test_decontamination import brute as brute_leaks
from test_near_dup import brute as brute_classes
from test_near_dup import family
from test_operators import SF, prose, sha

import corpus_pipeline
from strandline.llm import classifiers
from strandline.llm import queries as llm

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, rest string, _gone long, c0 string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", -1, 7, "r", i, "c") for i, t in rows], DOCS)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def texts(n=90):
    rng = random.Random(12)
    shared, item = " ".join(prose(60, 90)), " ".join(prose(40, 91))
    out = [None, "", "one", " \n", None, *family(rng, 130, 6, 0.004), " ".join(prose(3000, 92))]
    for k in range(n):
        t = " ".join(prose(rng.randrange(5, 120), 200 + k))
        out.append(t + rng.choice(["", "", " " + shared, " " + item, " ÄÖ日本"]))
    return out + out[6:9] + out[30:33]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("sf"))
    rows = list(enumerate(texts()))
    rows[40] = (39, rows[40][1])  # an id on two rows
    rows[50] = (None, rows[50][1])
    table(spark, rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, int(k % 9 > 0), 0) for k in range(0, 90, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    items = [(1, " ".join(prose(40, 91))), (2, None), (3, "a b")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at, rows, items


def test_quality_stage_keeps_what_the_classifier_accepts(spark, folder):
    at, rows, _ = folder
    docs = table(spark, rows)
    out = corpus_pipeline.quality_classifier(spark, docs, at)
    scores = classifiers.quality(docs, spark.read.parquet(f"{at}/labels.parquet")).where("predicted = 1")
    assert out.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in out.collect()) == sorted(r.doc_id or -1 for r in scores.collect())


def test_near_dup_stage(spark, folder):
    at, rows, _ = folder
    docs = table(spark, rows)
    classes, _ = brute_classes(spark, rows)
    gone = {i for i, c in classes if i != c}
    out = corpus_pipeline.minhash_near_dedup(spark, docs, at)
    assert out.columns == docs.columns and len(gone) > 8
    assert rows_of(out) == sorted(((i, t) for i, t in rows if (-(2**63) if i is None else i) not in gone), key=str)


def test_suffix_array_stage(spark, folder):
    at, rows, _ = folder
    own = [(i, t) for i, t in rows if i is not None]
    own = list({i: (i, t) for i, t in own}.values())
    docs = table(spark, own)
    seen, expected = set(), []
    for i, t in sorted(own):
        b = (t or "").encode()
        keep = [True] * len(b)
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                keep[k : k + 100] = [False] * 100
            seen.add(b[k : k + 100])
        expected.append((i, bytes(x for x, y in zip(b, keep, strict=True) if y).decode("utf-8", "ignore")))
    out = corpus_pipeline.suffix_array(spark, docs, at)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert rows_of(out) == sorted(expected, key=str)
    assert all(r.n_chars == len(r.text) and (r.id, r.rest, r.c0, r._gone) == (7, "r", "c", r.doc_id) for r in out.collect())


def test_decontamination_stage(spark, folder):
    at, rows, items = folder
    docs = table(spark, rows)
    gone = {i for i, _ in brute_leaks(rows, items)}
    out = corpus_pipeline.benchmark_decontamination(spark, docs, at)
    assert out.columns == docs.columns and len(gone) > 5
    assert rows_of(out) == sorted(((i, t) for i, t in rows if (-(2**63) if i is None else i) not in gone), key=str)


def test_encoding_stage(spark, folder):
    at, rows, _ = folder
    library = sentencepiece.SentencePieceProcessor(model_file=llm.tokenizer_path())
    got = sorted((tuple(r) for r in corpus_pipeline.sentencepiece_encoding(spark, table(spark, rows), at).collect()), key=str)
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        expected.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode())))
    assert got == sorted(expected, key=str)


def test_empty_tables_pass_through(spark, tmp_path):
    at = str(tmp_path)
    table(spark, []).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    assert corpus_pipeline.run(spark, at).count() == 0


def test_run_chains_the_stages(spark, folder):
    """run() gives what the stages give one after another."""
    for at in (folder[0], SF):
        docs = spark.read.parquet(f"{at}/documents.parquet")
        n = docs.count()
        out = corpus_pipeline.run(spark, at)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, at)
        got = sorted((tuple(r) for r in out.collect()), key=str)
        assert got == sorted((tuple(r) for r in docs.collect()), key=str) and 0 < len(got) < n
