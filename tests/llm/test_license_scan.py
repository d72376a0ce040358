"""Licence scan against brute force: places, labels, score and hits."""

from __future__ import annotations

import random
import re

from strandline.llm import license_scan
from strandline.llm.license_scan import BASE, COVERAGE, TEMPLATES


def words_of(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def places(words, phrase):
    return [k for k in range(len(words) - len(phrase) + 1) if words[k : k + len(phrase)] == phrase]


def brute(text):
    w = words_of(text)
    own = sorted((k, label) for phrase, label in BASE for k in places(w, words_of(phrase)))
    hits = []
    for e, (label, t, key) in enumerate(TEMPLATES):
        t, key = words_of(t), words_of(key)
        at = places(t, key)[0]
        for k in places(w, key):
            first = k - at
            hits.append((label, e, first, sum(0 <= first + i < len(w) and w[first + i] == x for i, x in enumerate(t)) / len(t)))
    labels = {label for _, label in own}
    more = labels | {label for label, _, _, share in hits if share >= COVERAGE}
    score = max([1.0 * bool(own), *(x[3] for x in hits)])
    return len(w), len(own), own[0][0] if own else None, own[-1][0] if own else None, ",".join(sorted(labels)), ",".join(sorted(more)), round(score, 9), sorted(hits)


def cases():
    rng = random.Random(6)
    filler = ["the", "license", "software", "public", "x", "é", "2", "general", "under", "mit", "gnu", "version"]
    out = [None, "", "...", "Under the MIT license", "cc by nc cc by nc", "under the mit license under the mit license"]
    for _ in range(250):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.randrange(4)
            if kind == 0:
                parts.append(" ".join(rng.choice(filler) for _ in range(rng.randrange(30))))
            elif kind == 1:
                parts.append(rng.choice(BASE)[0])
            else:
                t = rng.choice(TEMPLATES)[1].split()
                if rng.random() < 0.5:
                    i = rng.randrange(len(t))
                    t = t[:i] if rng.random() < 0.5 else t[i:]
                parts.append(" ".join(w if rng.random() > 0.05 else rng.choice(filler) for w in t))
        out.append(rng.choice([" ", "\n", " / "]).join(parts))
    out.append("word " * 40000 + TEMPLATES[1][1])
    return out + out[3:6]


def test_scan_is_brute_force(spark):
    texts = cases()
    docs = spark.createDataFrame([(k // 2, t, "h", 1, [2]) for k, t in enumerate(texts)], "doc_id long, text string, hits string, score int, labels array<int>")
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9), [(h.label, h.template, h.first, round(h.share, 9)) for h in r.hits]) for r in license_scan.scan(docs).collect()), key=str)
    expected = sorted(((k // 2, *brute(t)[:-1], [(*h[:3], round(h[3], 9)) for h in brute(t)[-1]]) for k, t in enumerate(texts)), key=str)
    assert got == expected
    assert sum(bool(x[-1]) for x in expected) > 100


def test_own_templates(spark):
    docs = spark.createDataFrame([(1, "a b a b c"), (None, "c")], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(docs, templates=[("own", "a b c", "b c")], base=[]).collect()}
    assert (got[1].labels, got[1].score, got[1].n_base, got[None].labels) == ("own", 1.0, 0, "")
