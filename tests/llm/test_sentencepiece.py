"""Encoding and decoding: caches, models that are not cut into chunks, repeated rows and other columns."""

from __future__ import annotations

import random
import time

import pytest

from strandline.llm import queries as llm
from strandline.llm import sentencepiece_spans as sp


@pytest.fixture(scope="module")
def library():
    return sp.decoder(llm.tokenizer_path())


def test_a_small_cache_gives_the_same_pieces(monkeypatch, library):
    monkeypatch.setattr(sp, "CACHE_BYTES", 2000)
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "日本", "x" * rng.randrange(1, 40), "🙂", "  "]) for _ in range(rng.randrange(60))) for _ in range(400)]
    for t, (ids, begin, end) in zip(texts, sp.Encoder(llm.tokenizer_path()).encode(texts), strict=True):
        assert ids.tolist() == library.encode(t)
        assert not len(ids) or (begin[0], end[-1]) == (0, len(t.encode()))


def test_texts_encoded_whole(library):
    """Without cutting into chunks: the way of models whose pieces run on over spaces."""
    encoder = sp.Encoder(llm.tokenizer_path())
    texts = ["one two  three", "", "日本 x" * 50, " a"]
    cut = [x.tolist() for _, *rest in [(0, *y) for y in encoder.encode(texts)] for x in rest]
    encoder.chunked = False
    assert [x.tolist() for y in encoder.encode(texts) for x in y] == cut
    assert [i for i, _, _, _ in encoder.spans(texts[0])] == library.encode(texts[0])
    assert "".join(p for _, p, _, _ in encoder.spans("ab cd")) == "▁ab▁cd"


def test_repeated_rows_and_clashing_columns(spark, library):
    docs = spark.createDataFrame([(1, "two rows", "p", "d"), (1, "two rows", "p", "d"), (None, None, None, None), (2, "", "p", "d"), (3, "long " * 30000, "p", "d")], "doc_id long, text string, ids string, decoded string")
    out = sp.token_digests(docs, llm.tokenizer_path()).collect()
    n = {r.doc_id: r.n_tokens for r in out}
    assert len(out) == 5 and n == {1: len(library.encode("two rows")) + 1, None: 1, 2: 1, 3: len(library.encode("long " * 30000)) + 1}
    back = sp.decode(sp.encode(docs, llm.tokenizer_path()).selectExpr("doc_id", "text", "pieces.id AS ids"), llm.tokenizer_path())
    assert all(r.decoded == (r.text or "").strip() or r.text.startswith("long") and r.decoded == r.text for r in back.collect())


def test_new_words_cost_little_more_than_the_librarys_own_pass(library):
    """Spans of words that no text had before, some with bytes: CPU time beside that of the library's ids alone."""
    rng = random.Random(5)
    part = ["an", "ció", "er", "𒀀", "𓀀", "\x07"]
    encoder = sp.Encoder(llm.tokenizer_path())

    def seconds(f) -> float:
        start = time.process_time()
        f()
        return time.process_time() - start

    shares = []
    for _ in range(5):
        texts = [" ".join("".join(rng.choices(part, k=8)) for _ in range(200)) for _ in range(320)]
        least = min(seconds(lambda: library.encode(texts, num_threads=1)) for _ in range(2))  # noqa: B023
        shares.append(seconds(lambda: list(encoder.encode(texts))) / least)  # noqa: B023
    assert min(shares) < 2


def test_unknown_characters_and_small_groups(tmp_path, monkeypatch):
    """A model without bytes: a run of unknown characters is one piece with their span; groups and runs may end anywhere."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(llm.tokenizer_path(), "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.byte_fallback = False
    for p in proto.pieces:
        p.type = 5 if p.type == 6 else p.type
    (tmp_path / "plain.model").write_bytes(proto.SerializeToString())
    monkeypatch.setattr(sp, "CACHE_BYTES", 500)
    monkeypatch.setattr(sp, "CHARS", 40)
    texts = ["one 𒀀𓀀x  𒀀 two", "", "   ", "a▁▁ b 𒀀" * 9, "x" * 90, "𒀀"] * 20
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "plain.model"))
    got = list(sp.Encoder(str(tmp_path / "plain.model")).encode(texts))
    for t, (ids, begin, end) in zip(texts, got, strict=True):
        assert ids.tolist() == library.encode(t)
        assert list(end[:-1]) == list(begin[1:]) and (not t or (begin[0], end[-1]) == (0, len(t.encode())))
    assert any(e - b == 8 for (ids, *at) in got for i, b, e in zip(ids, *at, strict=True) if i == library.unk_id())
