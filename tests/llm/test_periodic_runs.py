"""Periodic runs against brute force over every period and place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from strandline.llm import periodic_runs as P
from strandline.llm import queries as llm
from strandline.llm import textkernel as K


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def smallest_period(w):
    return next(q for q in range(1, len(w) + 1) if w[q:] == w[: len(w) - q])


def brute(w):
    """(start, length, period) of all runs, from the definition."""
    found = set()
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and smallest_period(w[i : j + q]) == q:
                found.add((i, j + q - i, q))
            i = j + 1
    return sorted(found, key=lambda x: (x[0], x[2]))


def collapsed(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def damaged(doc_id, w):
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def texts(count=160):
    rng = random.Random(4)
    out = [None, "", " \n\t", "a", "a " * 23, "a " * 24, "a " * 500, "x y " * 12, "x y " * 11 + "x", "ab\x0bab\x0cab " * 9, "é ö " * 15, "a b " * 30]
    fib = ["a", "a b"]
    while len(fib[-1]) < 700:
        fib.append(fib[-1] + " " + fib[-2])
    out += [fib[-1], " ".join("ab"[bin(k).count("1") % 2] for k in range(600))]  # Fibonacci and Thue-Morse words
    for _ in range(count):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            word = lambda: rng.choice(["a", "b", "cc", "dé", "e.", "f"][: rng.randrange(1, 7)])
            block = [word() for _ in range(rng.randrange(1, 30))]
            parts += block * rng.randrange(1, 9)
            parts += [word() for _ in range(rng.randrange(12))]
        out.append(rng.choice([" ", "\n", " \t "]).join(parts))
    return out + [out[20], out[20]]


def rows():
    out = [(k, t) for k, t in enumerate(texts())]
    return [*out, (None, out[25][1]), (7, "a " * 60), (-3, "p q r " * 40)]


def check(row, t):
    w = words_of(t)
    want = brute(w)
    assert row.n_words == len(w)
    assert [(r.start, r.length, r.period) for r in row.runs] == want, t
    assert row.collapsed == collapsed(w, want)


def test_runs_are_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "s", 1, None) for i, t in rows()], "doc_id long, text string, runs string, id int, collapsed string")
    out = P.periodic_runs(docs)
    assert out.columns == ["doc_id", "n_words", "runs", "collapsed"]
    by = sorted(out.collect(), key=lambda r: (str(r.doc_id), r.collapsed))
    want = sorted(rows(), key=lambda x: (str(x[0]), collapsed(words_of(x[1]), brute(words_of(x[1])))))
    assert len(by) == len(want)
    for r, (i, t) in zip(by, want, strict=True):
        assert r.doc_id == i
        check(r, t)


def test_the_query_is_brute_force(spark, tmp_path):
    own = rows() + [(k, " ".join(f"w{random.Random(k).randrange(9)}" for _ in range(k % 90))) for k in range(1000, 1200)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in own if i is not None) > 15
    spark.createDataFrame(own, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in own:
        w = damaged(i, words_of(t))
        found = brute(w)
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(w, found))))
    out = llm.queries()["op13_periodic_runs"](spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


def test_no_rows(spark):
    assert P.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_very_long_texts(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(3000)}" for _ in range(60000)]
    block = long[:7000]
    long = long + block * 4 + ["z"] * 9000
    (row,) = P.periodic_runs(spark.createDataFrame([(1, " ".join(long))], "doc_id long, text string")).collect()
    assert (60000 + 9000 + 28000, 1) == (row.n_words, row.runs[-1].period)
    assert [(r.start, r.length, r.period) for r in row.runs] == [(60000, 28000, 7000), (88000, 9000, 1)]
    assert row.collapsed == " ".join([*long[:67000], "z"])


def test_words_decide_where_hashes_agree(monkeypatch):
    """With a hash that says that all spans of a length are equal, what is found is still exact."""
    monkeypatch.setattr(K.Spans, "of", lambda self, a, b: (b - a).astype(np.uint64))
    for t in texts(40):
        w = words_of(t)
        number = {x: k for k, x in enumerate(dict.fromkeys(w))}
        _, s, n, q = P.runs(np.array([number[x] for x in w], np.int64), np.zeros(1, np.int64), np.array([len(w)]))
        assert sorted(zip(s.tolist(), n.tolist(), q.tolist(), strict=True), key=lambda x: (x[0], x[2])) == brute(w)


def test_pairs_come_in_portions(monkeypatch):
    n = np.array([0, 23, 24, 500, 3])
    first = np.cumsum(n) - n
    whole = np.concatenate([np.stack(x) for x in P.grid(first, n)], 1)
    monkeypatch.setattr(P, "PAIRS", 17)
    parts = [np.stack(x) for x in P.grid(first, n)]
    assert len(parts) > 20 and (np.concatenate(parts, 1) == whole).all()
    assert whole.shape[1] < 500 * np.log(500)
