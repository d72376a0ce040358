"""Quality and toxicity scores by positive-unlabelled learning on bounded training samples."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm import pu_learning
from strandline.llm import textkernel as K
from strandline.llm.common import cut, text_bytes, text_batches

#: Training sample: trusted positives and unlabelled rows at most.
POSITIVES, UNLABELLED = 8_000, 16_000
#: Toxicity: a term enters the vocabulary from so many positives on (a fifth of them, if they are few); terms considered, and features of the model.
SUPPORT, CANDIDATES, VOCABULARY = 4, 50_000, 1024
#: Z scores from which on a term's documents are counted over the whole corpus, and from which on it is kept.
CONSIDERED, KEPT = 1, 3
#: Class priors where there are too few labels to estimate them: most texts are good, few are toxic.
QUALITY_PRIOR, TOXIC_PRIOR = 0.8, 0.05
#: Estimated share of positives among the texts that hold a term, from which on the term counts.
PURITY = 0.7
#: Lengths of stems in bytes.
STEMS = (4, 5, 6, 7, 8)

PUNCTUATION = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
#: Byte classes: upper, lower, digit, white space, newline, non-ASCII, other control, then each punctuation mark.
CLASS_OF = np.full(256, 6, np.int64)
CLASS_OF[0x41:0x5B], CLASS_OF[0x61:0x7B], CLASS_OF[0x30:0x3A], CLASS_OF[0x20], CLASS_OF[0x0A], CLASS_OF[0x80:] = 0, 1, 2, 3, 4, 5
CLASS_OF[PUNCTUATION] = np.arange(7, 7 + len(PUNCTUATION))
CLASSES = 7 + len(PUNCTUATION)
SHAPES = CLASSES + 8


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus == remainder


def distinct_share(text: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each of n texts over all its values; 1 where it has none."""
    order = np.lexsort((value, text))
    t, v = text[order], value[order]
    new = np.append(True, (t[1:] != t[:-1]) | (v[1:] != v[:-1])) if len(t) else np.zeros(0, bool)
    total = np.bincount(text, minlength=n)
    return np.where(total > 0, np.bincount(t[new], minlength=n) / np.maximum(total, 1), 1.0)


def shapes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A text's shape: root shares of byte classes, sizes, repeated and unusual words, repeated lines."""
    n = len(starts) - 1
    size = np.diff(starts) - 1
    text = np.repeat(np.arange(n), np.diff(starts))
    kind = CLASS_OF[data]
    counts = np.bincount(text * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    counts[:, 3] -= 1  # the space that joins texts
    out = np.zeros((n, SHAPES))
    out[:, :CLASSES] = np.sqrt(np.maximum(counts, 0) / np.maximum(size, 1)[:, None])
    w = K.Words(data, starts, K.word_class("space"), False)
    words = np.maximum(w.n, 1)
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind <= 1, out=letters[1:])
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind == 0, out=upper[1:])
    has, big = letters[w.end] - letters[w.start], upper[w.end] - upper[w.start]
    out[:, CLASSES] = np.log1p(size)
    out[:, CLASSES + 1] = np.log1p(w.n)
    out[:, CLASSES + 2] = size / words / 10
    out[:, CLASSES + 3] = np.bincount(w.text, (has > 1) & (has == big), n) / words
    out[:, CLASSES + 4] = np.bincount(w.text, has == 0, n) / words
    out[:, CLASSES + 5] = distinct_share(w.text, w.hash, n)
    cuts = np.flatnonzero(data == 0x0A)
    edge = np.unique(np.concatenate([starts[:-1], cuts + 1, starts[1:]]))
    begin, end = edge[:-1], edge[1:]
    keep = end - begin > 2
    begin, end = begin[keep], end[keep]
    line = np.searchsorted(starts, begin, "right") - 1
    out[:, CLASSES + 6] = distinct_share(line, K.Spans(K.byte_values(False)[data]).of(begin, end - 1), n)
    out[:, CLASSES + 7] = np.log1p(np.bincount(line, minlength=n))
    return out


def terms(w: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash (a multiple of 4) of every word and of the stems of longer words."""
    text, term = [w.text], [w.hash]
    for n in STEMS if len(w.hash) else ():
        long = np.flatnonzero(w.end - w.start > n)
        text.append(w.text[long])
        term.append(K.mix(w.spans.of(w.start[long], w.start[long] + n)))
    return np.concatenate(text), np.concatenate(term) & ~np.uint64(3)


def word_sets(data: np.ndarray, starts: np.ndarray, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) pairs, each once; words are lower-cased alphanumeric runs. A term is a word's or stem's hash plus 1, plus 2 if the text holds it twice, plus 3 if three times. base: hashes to look for."""
    t, h = terms(K.Words(data, starts, K.word_class("alnum"), True))
    if base is not None:
        maybe = np.zeros(1 << 16, bool)
        maybe[base >> np.uint64(48)] = True
        at = np.flatnonzero(maybe[h >> np.uint64(48)])
        at = at[np.isin(h[at], base)]
        t, h = t[at], h[at]
    order = np.lexsort((h, t))
    t, h = t[order], h[order]
    new = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (h[1:] != h[:-1]))) if len(t) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(t)))
    t, h = t[new], h[new]
    return np.concatenate([t[times >= k] for k in (1, 2, 3)]), np.concatenate([h[times >= k] + np.uint64(k) for k in (1, 2, 3)])


def sample(docs: DataFrame, labels: DataFrame, label: str, out: Column, id_col: str, text_col: str, positives: int, unlabelled: int) -> DataFrame:
    """Training rows (positive, t) that are not held out, equal texts once: positives by hash order of their id, unlabelled rows by a hash threshold."""
    ids = labels.where(~out & (F.col(label) == 1)).select(F.col(id_col)).distinct().orderBy(F.xxhash64(id_col, F.lit(label)), id_col).limit(positives)
    share = min(1.0, unlabelled / max(1, docs.count()))
    drawn = F.pmod(F.xxhash64(id_col, F.lit("unlabelled")), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = docs.where(~out).select(id_col, text_bytes(text_col).alias("t"), drawn.alias("drawn"))
    found = rows.join(F.broadcast(ids.withColumn("p", F.lit(True))), id_col, "left").where("p OR drawn")
    # a row that is drawn and positive stands in both samples
    both = found.select("t", F.explode(F.array_compact(F.array(F.when(F.col("p"), F.lit(1)), F.when(F.col("drawn"), F.lit(0))))).alias("positive"))
    return both.groupBy("positive", F.xxhash64("t").alias("h"), F.crc32("t").alias("c")).agg(F.first("t").alias("t")).select("positive", "t")


def rows_of(batches, make, columns: int):
    """For every pass over texts in column ``columns``: the batch's slice and what make(data, starts) returns."""
    for batch in batches:
        column = batch.column(columns)
        for i, j in K.passes(np.diff(K.raw(column)[0])):
            yield batch.slice(i, j - i), make(*K.joined(column, i, j))


def scored(docs: DataFrame, features, model: pu_learning.Model, out: Column, id_col: str, text_col: str, accept: bool = False) -> DataFrame:
    """Scores of all rows; with accept, instead the rows themselves that are predicted 1."""

    n = len(docs.columns)

    def choose(batches):
        for part, x in rows_of(batches, features, n):
            yield part.filter(pa.array(model.score(x) >= 0.5)).select(list(range(n)))

    if accept:
        whole = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # whatever the columns are called
        t = text_bytes(f"c{docs.columns.index(text_col)}").alias("t")
        return whole.select("*", t).mapInArrow(choose, whole.schema).toDF(*docs.columns)
    def run(batches):
        for part, x in rows_of(batches, features, 2):
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["id", "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), out.alias("held_out"), text_bytes(text_col).alias("t"))
    return source.mapInArrow(run, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, remainder: int = 1, id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED, accept: bool = False) -> DataFrame:
    """id, held_out, score, predicted for every document; the score sees the text's shape only. accept: the documents that are predicted 1, as they came.

    Null texts count as empty; an empty text has a score too; texts of any length are read whole. Rows, repeated ones too, are kept one for one,
    and with accept all their columns. With fewer than four positives or unlabelled rows the class prior is QUALITY_PRIOR; without any
    every score is that. A document whose id is null is judged, and trains as unlabelled text.
    """
    text_batches(docs.sparkSession)
    out = held_out(id_col, modulus, remainder)

    def extract(batches):
        for part, x in rows_of(batches, shapes, 1):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(x), pa.list_(pa.float64()))], ["positive", "x"])

    rows = sample(docs, labels, label, out, id_col, text_col, positives, unlabelled).mapInArrow(extract, "positive int, x array<double>").toArrow()
    x = np.array(rows["x"].to_pylist()).reshape(-1, SHAPES)
    p = rows["positive"].to_numpy() == 1
    order = np.lexsort(x.T)
    x, p = x[order], p[order]
    model, _ = pu_learning.fit(x[p], x[~p], hidden=24, fallback=QUALITY_PRIOR, steps=500, rate=0.01)
    return scored(docs, shapes, model, out, id_col, text_col, accept)


def presence(vocabulary: np.ndarray):
    """A text's features: which terms of the vocabulary it holds."""
    base, column = np.unique(vocabulary & ~np.uint64(3), return_inverse=True)
    times = (vocabulary & np.uint64(3)).astype(np.int64)
    maybe = np.zeros(1 << 16, bool)
    maybe[base >> np.uint64(48)] = True

    def make(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n = len(starts) - 1
        text, term = terms(K.Words(data, starts, K.word_class("alnum"), True))
        at = np.flatnonzero(maybe[term >> np.uint64(48)])
        if not len(base) or not len(at):
            return np.zeros((n, len(vocabulary)))
        k = np.minimum(np.searchsorted(base, term[at]), len(base) - 1)
        hit = base[k] == term[at]
        counts = np.bincount(text[at][hit] * len(base) + k[hit], minlength=n * len(base)).reshape(n, len(base))
        return (counts[:, column] >= times).astype(float)

    return make


def term_counts(docs: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """(h, n): how many texts (column t) hold each term, of those wanted."""
    base = None if wanted is None else np.unique(wanted & ~np.uint64(3))

    def run(batches):
        held, n = [], 0

        def flush():
            value, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(times, pa.int64())], ["h", "n"])

        for _, (_, h) in rows_of(batches, lambda data, starts: word_sets(data, starts, base), 0):
            h = h if wanted is None else h[np.isin(h, wanted)]
            held.append(h)
            n += len(h)
            if n > 500_000:
                yield flush()
                n = 0
        if held:
            yield flush()

    return docs.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary_of(rows: DataFrame, corpus: DataFrame, support: int, candidates: int, size: int) -> np.ndarray:
    """Terms that positives hold much more often than the corpus (all texts that are not held out), by their z score; sorted hashes.

    The sample of unlabelled rows only rules out terms that are plainly no more frequent in positives; the document frequencies
    that decide are counted over the whole corpus.
    """
    sizes = {r.positive: r.n for r in rows.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_p = sizes.get(1, 0)
    least = min(support, max(2, n_p // 5))
    in_p = {r.h: r.n for r in term_counts(rows.where("positive = 1")).where(F.col("n") >= least).orderBy(F.desc("n"), "h").limit(candidates).collect()}

    def z_over(texts: DataFrame, n_u: int, terms: dict[int, int]) -> dict[int, float]:
        if not terms or not n_u:
            return {}
        wanted = np.sort(np.array(list(terms), np.int64).view(np.uint64))
        in_u = {r.h: r.n for r in term_counts(texts, wanted).collect()}
        return {h: (n / n_p - in_u.get(h, 0) / n_u) / ((in_u.get(h, 0) + 1) / n_u / n_p + n / n_p / n_p) ** 0.5 for h, n in terms.items()}

    rough = z_over(rows.where("positive = 0"), sizes.get(0, 0), in_p)
    z = z_over(corpus, corpus.count(), {h: in_p[h] for h, x in rough.items() if x > CONSIDERED})
    best = sorted(z, key=lambda h: (-z[h], h))[:size]
    return np.sort(np.array([h for h in best if z[h] > KEPT], np.int64).view(np.uint64))


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, remainder: int = 0, id_col: str = "doc_id", text_col: str = "text", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """id, held_out, score, predicted for every document; the score sees which words the text holds.

    Null texts count as empty; an empty text has the score of a text without any listed word; texts of any length are read whole. Rows,
    repeated ones too, are kept one for one; other columns are not read. The model has at most VOCABULARY features, whatever the size of
    the corpus, chosen from CANDIDATES terms of the positives. With fewer than four positives or unlabelled rows the class prior is
    TOXIC_PRIOR; without any every score is that. A document whose id is null is judged, and trains as unlabelled text.
    """
    text_batches(docs.sparkSession)
    out = held_out(id_col, modulus, remainder)
    rows = cut(sample(docs, labels, label, out, id_col, text_col, positives, unlabelled))
    corpus = docs.where(~out).select(text_bytes(text_col).alias("t"))
    features = presence(vocabulary_of(rows, corpus, SUPPORT, CANDIDATES, VOCABULARY))

    def extract(batches):
        for part, x in rows_of(batches, features, 1):
            text, k = np.nonzero(x)
            edge = np.searchsorted(text, np.arange(len(x) + 1))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(k, pa.int32()))], ["positive", "k"])

    got = rows.mapInArrow(extract, "positive int, k array<int>").toArrow()
    x = np.zeros((got.num_rows, features(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape[1]), np.float32)
    lists = got["k"].to_pylist()
    for i, k in enumerate(lists):
        x[i, k] = 1
    order = sorted(range(len(lists)), key=lambda i: lists[i])
    x, p = x[order], (got["positive"].to_numpy() == 1)[order]
    options = {"fallback": TOXIC_PRIOR, "steps": 300, "rate": 0.05, "decay": 1e-5, "standardise": False}
    model, prior = pu_learning.fit(x[p], x[~p], **options)
    # under that prior a term's own share of positives; terms that clean texts hold too often go
    if p.any() and not p.all():
        weak = prior * x[p].mean(0) < PURITY * (x[~p].sum(0) + 1) / (len(x) - p.sum() + 1)
        x[:, weak] = 0
        model, _ = pu_learning.fit(x[p], x[~p], **options)
        model.weights[0][weak] = 0
    return scored(docs, features, model, out, id_col, text_col)
