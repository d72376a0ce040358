"""Licence scan by a positional index of rare words.

The words of the templates' mandatory key phrases make an inverted index of postings (template, place in the template). Each file's
licence words are looked up from its highest inverse document frequency (over the corpus) down: a template is opened by the rarest of its key
words, at the places that the posting points to, and each further word intersects these places by relative position. What is
left is verified word for word against the key phrase, and the template's other words are counted where they stand in place.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textkernel as K
from strandline.llm.common import text_bytes, text_batches

#: Base phrases and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: The method's templates (label, a passage of the licence or its notice, mandatory key phrase).
TEMPLATES = [
    ("mit", "released under the MIT License", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "Permission is hereby granted, free of charge"),
    ("apache-2", "licensed under the Apache License, Version 2.0", "Apache License, Version 2"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", "CC BY NC"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution NonCommercial"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution ShareAlike"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide", "copyright and related and neighboring rights"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "GNU General Public License as published by the Free Software Foundation either version 2"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GNU General Public License as published by the Free Software Foundation either version 3"),
    ("gpl-3", "this work is licensed under the GNU General Public License version 3", "GNU General Public License version 3"),
    ("lgpl-2", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", "GNU Lesser General Public License as published by the Free Software Foundation either version 2"),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at", "Mozilla Public License"),
    ("epl-2", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Redistribution and use in source and binary forms"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "for any purpose with or without fee is hereby granted"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "In no event will the authors be held liable"),
    ("boost", "Distributed under the Boost Software License, Version 1.0.", "Boost Software License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "free and unencumbered software released into the public domain"),
]

#: Share of a template's words that must stand at their places.
COVERAGE = 0.8


def word_hash(text: str) -> np.ndarray:
    data, starts = K.joined(pa.array([text.encode()], pa.binary()), 0, 1)
    return K.Words(data, starts, K.word_class("alnum"), True).hash


class Index:
    def __init__(self, df: dict[int, int], n_docs: int, templates=None, base=None):
        """df: documents that hold each template word, by word hash."""
        entries = [(label, t, key, False) for label, t, key in (TEMPLATES if templates is None else templates)] + [(label, p, p, True) for p, label in (BASE if base is None else base)]
        #: (label, whether it is a base phrase) of each entry; its words, and where its key phrase begins and ends in them.
        self.entries = [(label, is_base) for label, _, _, is_base in entries]
        self.words, self.key = [], []
        postings: dict[int, list[tuple[int, int]]] = {}
        for e, (_, text, key, _) in enumerate(entries):
            words, phrase = word_hash(text), word_hash(key)
            at = next(k for k in range(len(words)) if len(phrase) and np.array_equal(words[k : k + len(phrase)], phrase))
            self.words.append(words)
            self.key.append((at, at + len(phrase)))
            for k, h in enumerate(phrase.tolist()):
                postings.setdefault(h, []).append((e, at + k))
        #: Key words from the highest inverse document frequency down, with their postings.
        idf = {h: math.log((1 + n_docs) / (1 + df.get(h, 0))) for h in postings}
        self.postings = [(h, postings[h]) for h in sorted(postings, key=lambda h: (-idf[h], h))]
        self.known = np.sort(np.array(list(postings), np.uint64))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.known >> np.uint64(48)] = True

    def scan(self, words: K.Words) -> list[tuple[int, int, int, float]]:
        """(text, entry, first word in the text, share of the template's words at their places) of every hit; a template that began before the text has a negative first word."""
        at = np.flatnonzero(self.maybe[words.hash >> np.uint64(48)])
        k = np.searchsorted(self.known, words.hash[at])
        at = at[self.known[np.minimum(k, len(self.known) - 1)] == words.hash[at]] if len(self.known) else at[:0]
        own = words.hash[at]
        order = np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        first: dict[int, np.ndarray] = {}
        for h, postings in self.postings:
            i, j = np.searchsorted(own, np.uint64(h)), np.searchsorted(own, np.uint64(h), "right")
            for e, place in postings:
                here = at[i:j] - place
                first[e] = np.intersect1d(first[e], here, assume_unique=True) if e in first else here
        out = []
        for e, starts in first.items():
            begin, end = self.key[e]
            starts = starts[words.text[starts + begin] == words.text[starts + end - 1]] if len(starts) else starts
            if not len(starts):
                continue
            text = words.text[starts + begin]
            low, high = words.first[text], words.first[text + 1]
            share, key = np.zeros(len(starts)), np.ones(len(starts), bool)
            for k, want in enumerate(self.words[e]):
                p = starts + k
                here = (p >= low) & (p < high)
                here[here] = words.hash[p[here]] == want
                share += here
                if begin <= k < end:
                    key &= here
            share /= len(self.words[e])
            out += [(int(text[k]), e, int(starts[k] - low[k]), float(share[k])) for k in np.flatnonzero(key)]
        return out


def template_words(templates=None, base=None) -> np.ndarray:
    return np.unique(np.concatenate([word_hash(""), *(word_hash(key) for _, _, key in (TEMPLATES if templates is None else templates)), *(word_hash(p) for p, _ in (BASE if base is None else base))]))


def document_frequencies(docs: DataFrame, text_col: str = "text", vocabulary: np.ndarray | None = None) -> tuple[dict[int, int], int]:
    """How many of all documents hold each template word; the result has one row per template word at most."""
    vocabulary = template_words() if vocabulary is None else vocabulary
    maybe = np.zeros(1 << 16, bool)
    maybe[vocabulary >> np.uint64(48)] = True

    def count(batches):
        n, df = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            column = batch.column(0)
            n += len(column)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                at = np.flatnonzero(maybe[w.hash >> np.uint64(48)])
                k = np.minimum(np.searchsorted(vocabulary, w.hash[at]), len(vocabulary) - 1)
                hit = vocabulary[k] == w.hash[at]
                pairs = np.unique(w.text[at][hit] * len(vocabulary) + k[hit])
                df += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(vocabulary))], pa.int32()), pa.array([n, *df.tolist()], pa.int64())], ["k", "n"])

    rows = docs.select(text_bytes(text_col).alias("t")).mapInArrow(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    got = {r.k: r.n for r in rows}
    return {int(h): got.get(k, 0) for k, h in enumerate(vocabulary)}, got.get(-1, 0)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, base=None) -> DataFrame:
    """One row per input row: n_words, n_base, first_word, last_word, base_labels, labels, score, and ``hits``,
    an array of (label, template, first word, share).

    Words are runs of digits, ASCII letters (lower-cased) and non-ASCII characters. Null and empty texts have no
    words, no places, empty label strings and score 0; texts of any length are scanned whole; other columns are not read. The score is the best share of a template's words found
    in place around its key phrase, 1 for a whole template. Overlapping and repeated places all count.
    """
    text_batches(docs.sparkSession)
    index = Index(*document_frequencies(docs, text_col, template_words(templates, base)), templates, base)
    hit = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first", pa.int64()), ("share", pa.float64())])

    def run(batches):
        for batch in batches:
            column, ids = batch.column(1), batch.column(0)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                found: list[list] = [[] for _ in range(j - i)]
                for text, e, first, share in index.scan(w):
                    found[text].append((e, first, share))
                rows = []
                for hits in found:
                    own = [(first, index.entries[e][0]) for e, first, _ in hits if index.entries[e][1]]
                    places = [first for first, _ in own]
                    labels = {label for _, label in own}
                    near = [(index.entries[e][0], e, first, share) for e, first, share in hits if not index.entries[e][1]]
                    more = labels | {label for label, _, _, share in near if share >= COVERAGE}
                    rows.append((
                        len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(more)),
                        max([1.0 * bool(own), *(share for *_, share in near)]), [dict(zip(("label", "template", "first", "share"), x, strict=True)) for x in sorted(near)],
                    ))
                n, first, last, base_labels, labels, score, hits = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(w.n, pa.int64()), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()), pa.array(hits, pa.list_(hit))],
                    ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "hits"],
                )

    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, hits array<struct<label:string,template:int,first:long,share:double>>"
    return docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, schema).withColumnRenamed("id", id_col)
