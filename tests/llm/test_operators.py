"""The training-data operators against brute force, exact round trips or held-out labels."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import classifiers, decontamination, embedding_dedup, license_scan, near_dup, sentencepiece_spans, substring_dedup, suffix_array_dedup, url_filter
from strandline.llm import queries as llm

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, id long, kept string, t string"


def table(spark, texts, ids=None):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", 7, "x", "y") for i, t in enumerate(texts)], DOCS)


def prose(n: int, seed: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]


def odd_texts() -> list[str | None]:
    shared = prose(60, 1)
    return [
        None, "", " \n\t ", "one", " ".join(prose(200, 2) + shared + prose(30, 3)), " ".join(shared + prose(20, 4) + shared), "\n".join(prose(15, 5) + shared[:36]), " ".join(prose(80, 6)), " ".join(prose(80, 6)),
        "ab" * 400, "é" * 130, "a" * 99, " ".join(prose(34, 7)), " ".join(prose(34, 7)), " ".join(prose(9000, 8) + shared), "x\u00a0y " * 50,
    ]


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def test_substring_dedup_is_brute_force(spark):
    texts = odd_texts()
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    expected = set()
    for k, w in enumerate(words):
        keep = [True] * len(w)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                keep[i : i + 35] = [False] * 35
        left = [x for x, y in zip(w, keep, strict=True) if y]
        expected.add((k, len(w), len(w) - len(left), sha(" ".join(left).encode())))
    got = substring_dedup.remove_repeated_words(table(spark, texts)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert len(got) == len(texts) and {tuple(r) for r in got} == expected


def test_substring_dedup_with_small_groups(spark):
    """The prefix partition gives the same leaves whatever its memory bound."""
    rng = np.random.default_rng(3)
    words = rng.integers(0, 3, 400)
    suffixes = np.arange(380)
    def nodes(most):
        return sorted(sorted(x.tolist()) for d, g in substring_dedup.prefix_groups(words, suffixes, 8, most) for x in substring_dedup.deep_nodes(words, g, d, 8) if len(x) > 1)
    assert nodes(10) == nodes(1000) != []


def brute_bytes(texts, width=100):
    seen, out = set(), set()
    for k, t in enumerate(texts):
        b = (t or "").encode()
        keep = [True] * len(b)
        for i in range(len(b) - width + 1):
            s = b[i : i + width]
            if s in seen:
                keep[i : i + width] = [False] * width
            seen.add(s)
        left = bytes(x for x, y in zip(b, keep, strict=True) if y)
        spans = sum(1 for i, y in enumerate(keep) if not y and (i == 0 or keep[i - 1]))
        out.add((k, len(b), len(b) - len(left), spans, sha(left)))
    return out


def test_suffix_array_dedup_is_brute_force(spark):
    texts = odd_texts()
    got = suffix_array_dedup.remove_repeated_bytes(table(spark, texts)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert len(got) == len(texts) and {tuple(r) for r in got} == brute_bytes(texts)


def test_bounded_boundaries_are_common_prefixes():
    rng = np.random.default_rng(1)
    symbols = np.concatenate([rng.integers(1, 3, 300), [0]])
    order = suffix_array_dedup.sorted_suffixes(symbols, len(symbols))
    met = suffix_array_dedup.bounded_boundaries(suffix_array_dedup.Wavelet(symbols[order - 1], 2), len(symbols), 6)
    text = symbols.tolist() * 2
    for k in range(1, len(symbols)):
        a, b = (text[int(order[x]) : int(order[x]) + 6] for x in (k - 1, k))
        assert met[k] == (a != b)


def test_sentencepiece_is_the_library(spark):
    import sentencepiece

    path = llm.tokenizer_path()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*odd_texts(), "ﬁne  print\u3000①②", "\u0000nul", "tab\tnew\nline  ", "日本語のテキスト", "🙂👩‍👩‍👧", "e\u0301\u0302", " lead"]
    got = {r.doc_id: r for r in sentencepiece_spans.token_digests(table(spark, texts), path).collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", out_type=int, add_eos=True)
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode()))


def test_sentencepiece_spans_are_the_librarys(spark, tmp_path, monkeypatch):
    """Spans and digests of both queries come from encode() and decode(), also under a compiled character map."""
    import sentencepiece

    from sentencepiece import sentencepiece_model_pb2

    # the tokenizer's pieces under a public character map that the library brings with it; nothing is trained
    rules = sentencepiece_model_pb2.ModelProto()
    rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    proto = sentencepiece_model_pb2.ModelProto()
    with open(llm.tokenizer_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.CopyFrom(rules.normalizer_spec)
    (tmp_path / "mapped.model").write_bytes(proto.SerializeToString())
    lines = ["ﬁne ① print ü é", "Ａｂｃ ㍍ ½ ﷺ", "x\u00ad\u200by  z "]
    texts = [*odd_texts()[:5], "  a  b ", "ﬁne  print\u3000①②", "\u0000nul", "tab\tnew\nline  ", "日本語のテキスト abc 日本", "🙂👩‍👩‍👧", "e\u0301\u0302 u\u0308", " lead", "▁x▁▁ y", "\u200b", *lines]
    calls = []
    for name in ("encode", "decode"):
        f = getattr(sentencepiece_spans, name)
        monkeypatch.setattr(sentencepiece_spans, name, lambda *a, f=f, name=name, **b: calls.append(name) or f(*a, **b))
    for path, mapped in ((llm.tokenizer_path(), False), (str(tmp_path / "mapped.model"), True)):
        assert bool(sentencepiece_spans.Encoder(path).map.units) == mapped
        library, byte = (x := sentencepiece.SentencePieceProcessor(model_file=path)), x.is_byte
        got = {r.doc_id: r.pieces for r in sentencepiece_spans.encode(table(spark, texts), path).collect()}
        calls.clear()
        digests = {r.doc_id: r for r in sentencepiece_spans.token_digests(table(spark, texts), path).collect()}
        assert calls == ["encode", "decode"]
        for k, t in enumerate(texts):
            source, want = (t or "").encode(), library.encode(t or "", return_type="proto").pieces
            assert [x.id for x in want] == [x.id for x in got[k]]
            # the bytes of a character share its span here
            assert all((x.begin, x.end) == (y.begin, y.end) for x, y in zip(want, got[k], strict=True) if not byte(x.id))
            assert all(source[y.begin : y.end].decode() and (y.begin, y.end) for y in got[k] if byte(y.id))
            if not mapped:
                assert all(source[y.begin : y.end].decode() == y.piece.replace("▁", " ")[y is got[k][0] :] for y in got[k] if not byte(y.id) and "▁" not in (t or ""))
                assert not got[k] or (got[k][0].begin, got[k][-1].end) == (0, len(source))
            ids = [x.id for x in want]
            assert digests[k][1:] == (len(ids) + 1, sha(" ".join(map(str, [*ids, library.eos_id()])).encode()), sha(library.decode(ids).encode()))


def test_license_base_counts(spark):
    texts = [None, "", "Under the MIT license, under the mit License", "Apache License Version 2.0", "cc-by-nc cc by nc", "nothing here"]
    got = {r.doc_id: r for r in license_scan.scan(table(spark, texts)).collect()}
    assert [got[k].n_base for k in range(6)] == [0, 0, 2, 1, 2, 0]  # "2.0" is the words 2 and 0
    assert (got[2].first_word, got[2].last_word, got[2].base_labels) == (0, 4, "mit")
    assert got[0].first_word is None and got[4].base_labels == "cc-by-nc"
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got.values())


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://NET", "http://net/", "https://a.example.net/en/x?q", "https://a.example.net/de", "ftp://xexample.com/de/", "http://example.com/de/", "http://w.org/fr/#a", "http://org/en", "a://b.net/x://y", "http://x.net#/", "http:///p"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, url_filter.RULES).collect()}
    assert len(got) == len(urls) and got[0] == got[2] == ("", "", None, "allow")
    assert got[3][:2] == ("net", "") and got[3][2] is None
    assert got[4][2:] == ("net/", "block") and got[5][2:] == ("example.net/en/", "allow") and got[6][2:] == ("net/", "block")
    assert got[7][2] is None and got[8][2:] == ("example.com/de/", "block") and got[9][2:] == ("org/fr/", "allow")


def test_near_duplicates(spark):
    base, hot = prose(300, 11), prose(150, 12)
    near = base[:150] + ["changed"] + base[151:]
    texts = [None, "", " ".join(base), " ".join(near), " ".join(base), "a b c", "A, b c!", " ".join(prose(300, 13))]
    texts += [" ".join(hot + prose(120, 100 + k)) for k in range(60)]  # share a passage, and are not similar
    got = near_dup.classes(table(spark, texts)).collect()
    cls = {r.doc_id: r.class_id for r in got}
    assert len(got) == len(texts)
    assert cls[0] == cls[1] == 0 and cls[2] == cls[3] == cls[4] == 2 and cls[5] == cls[6] == 5 and cls[7] == 7
    assert all(cls[k] == k for k in range(8, len(texts)))
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_decontamination_finds_reordered_passages(spark):
    item = prose(80, 31)
    docs = table(spark, [None, "", " ".join(prose(50, 32) + item + prose(20, 33)), " ".join(item[40:] + prose(40, 34) + item[:40]), " ".join(prose(100, 35)), " ".join(prose(60, 36) + item[:20])])
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(prose(30, 37)))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontamination.contaminated(docs, benchmark).collect()}
    assert set(got) == {(2, 1), (3, 1)}
    assert got[2, 1].coverage == 1.0 and got[3, 1].n_tiles == 2


def test_decontamination_counts_repeated_seeds(spark):
    """An item with few distinct seeds, and a short item whose id a long one has too."""
    refrain, short = prose(10, 41) * 11, prose(30, 42)
    docs = table(spark, [" ".join(prose(50, 43) + refrain), " ".join(short + prose(40, 44)), " ".join(prose(90, 45))])
    items = [(1, " ".join(refrain)), (2, " ".join(short)), (2, " ".join(prose(400, 46))), (None, " ".join(short)), (None, " ".join(prose(400, 47)))]
    got = {(r.doc_id, r.item_id): r.coverage for r in decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {(0, 1): 1.0, (1, 2): 1.0, (1, -(2**63)): 1.0}


def test_tiles_do_not_overlap():
    rng = np.random.default_rng(4)
    for _ in range(30):
        p, t = rng.integers(0, 3, 60).astype(np.uint64), rng.integers(0, 3, 90).astype(np.uint64)
        used_p, used_t = np.zeros(60, int), np.zeros(90, int)
        for i, j, n in decontamination.tiles(p, t):
            assert n >= 5 and (p[i : i + n] == t[j : j + n]).all()
            used_p[i : i + n] += 1
            used_t[j : j + n] += 1
        assert used_p.max() <= 1 and used_t.max() <= 1


def test_embedding_links_are_brute_force(spark):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(30, 48))
    x = np.concatenate([centre, centre[:15] + rng.normal(scale=0.1, size=(15, 48)), centre[:10] + rng.normal(scale=0.3, size=(10, 48)), centre[:5]]).astype(np.float32)
    rows = [(k, [float(v) for v in r]) for k, r in enumerate(x)] + [(900, None), (901, [0.0] * 48), (902, [None] + [1.0] * 47), (903, [float("nan")] + [1.0] * 47)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    y = x.astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    link = (y @ y.T >= 0.95) & ~np.eye(len(y), dtype=bool)
    label = np.arange(len(y))
    for _ in range(len(y)):
        label = np.array([min(label[k], *label[link[k]]) if link[k].any() else label[k] for k in range(len(y))])
    assert len(got) == len(rows)
    found = sum(got[k].n_links for k in range(len(y)))
    assert found <= link.sum() and found >= 0.9 * link.sum()
    assert sum(got[k].component_id == label[k] for k in range(len(y))) >= 0.9 * len(y)
    assert all(got[k].n_links == 0 and got[k].component_id == k for k in (900, 901, 902, 903))


@pytest.mark.parametrize("name,label,least", [("op1_quality_classifier", "quality", 0.99), ("op9_toxicity", "toxic", 0.94)])
def test_scores_hold_on_labels_held_out(spark, name, label, least):
    large = SF.replace("sf0.01", "sf0.1")
    rows = llm.queries()[name](spark, large).join(spark.read.parquet(f"{large}/labels.parquet"), "doc_id").where("held_out").select("score", label, "predicted").toPandas().dropna()
    s, y = rows["score"].to_numpy(), rows[label].to_numpy()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    assert auc >= least and np.mean((s >= 0.5) == y) >= 0.98
    assert ((s >= 0) & (s <= 1)).all() and (rows["predicted"] == (s >= 0.5)).all()


def test_few_labels(spark):
    """A table whose positives are too few for the bound on the prior still gives every document a score."""
    small = SF.replace("sf0.01", "sf0.001")
    for name in ("op1_quality_classifier", "op9_toxicity"):
        out = llm.queries()[name](spark, small)
        assert out.count() == spark.read.parquet(f"{small}/documents.parquet").count()
        assert out.where("score IS NULL OR score < 0 OR score > 1").isEmpty()
        # most documents are good, and few are toxic
        share = out.agg(F.avg("predicted")).first()[0]
        assert share > 0.5 if name.startswith("op1") else share < 0.3


def test_empty_tables(spark):
    docs, labels = table(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for out in (
        substring_dedup.remove_repeated_words(docs), suffix_array_dedup.remove_repeated_bytes(docs), near_dup.classes(docs), decontamination.contaminated(docs, benchmark), license_scan.scan(docs), sentencepiece_spans.token_digests(docs, llm.tokenizer_path()),
        classifiers.quality(docs, labels), classifiers.toxicity(docs, labels), embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
        url_filter.judge(spark.createDataFrame([], "page_id long, url string"), url_filter.RULES),
    ):
        assert out.count() == 0
