"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

A shingle of five words weighs its count times the mean inverse document frequency of its words; document frequencies are
counted over all documents in a fixed number of hashed word buckets, so the table that tasks receive has one size
whatever the corpus. Equal texts are folded before banding. In each bucket a few pivots are compared with the others; what they link
makes components. Texts that share a bucket and are still in different components are then compared in
pairs of blocks, and a task passes on only links that join components, so rows never grow with the square of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import textkernel as K
from strandline.llm.common import connected_components, cut, id_or_least, text_bytes, with_row, text_batches

SHINGLE, SIMILARITY = 5, 0.8
#: 14 bands of 3 samples: a pair at the threshold shares a band with probability 0.99996.
BANDS, ROWS = 14, 3
#: Hashed word buckets of the document frequency table; entries of each sample's parameter table.
BUCKET_BITS, TABLE_BITS = 18, 14
#: Pivots of a bucket; texts of one block, or of one pivot's group; text bytes that a task holds at a time.
PIVOTS, BLOCK, BUNDLE_BYTES = 3, 512, 4 << 20
#: Room for the rounding of sums.
SLACK = 1e-9


def parameters() -> tuple[np.ndarray, ...]:
    """Per sample and table entry: r ~ Gamma(2, 1), 1 / r, beta ~ Uniform(0, 1), ln c - r with c ~ Gamma(2, 1)."""
    rng = np.random.default_rng(20)
    shape = (BANDS * ROWS, 1 << TABLE_BITS)
    r, c = rng.gamma(2, 1, shape), rng.gamma(2, 1, shape)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, rng.random(shape), np.log(c) - r))


def counted_shingles(w: K.Words, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash, weight of one and count of each distinct shingle, by text. A text of one to four words is one shingle."""
    h, at = K.shingles(w.hash, w.text, SHINGLE)
    value = idf[w.hash >> np.uint64(64 - BUCKET_BITS)]
    sums = np.append(0, np.cumsum(value))
    weight, text = (sums[at + SHINGLE] - sums[at]) / SHINGLE, w.text[at]
    short = np.flatnonzero((w.n > 0) & (w.n < SHINGLE))
    if len(short):
        first, last = w.first[short], w.first[short + 1]
        h = np.concatenate([h, K.Spans(w.hash).of(first, last)])
        weight, text = np.concatenate([weight, (sums[last] - sums[first]) / (last - first)]), np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text, weight = h[order], text[order], weight[order]
    new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (text[1:] != text[:-1]))) if len(h) else np.zeros(0, np.int64)
    return text[new], h[new], weight[new], np.diff(np.append(new, len(h)))


def weighted_shingles(w: K.Words, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and weight of each distinct shingle, by text."""
    text, h, weight, times = counted_shingles(w, idf)
    return text, h, weight * times


def bands(text: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, tables) -> tuple[np.ndarray, np.ndarray]:
    """Which of n texts have shingles, and their band hashes: one row for each."""
    begin = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else np.zeros(0, np.int64)
    out = np.zeros((len(begin), BANDS), np.uint64)
    if not len(begin):
        return np.zeros(0, np.int64), out
    ln_w = np.log(weight).astype(np.float32)
    index = np.arange(len(h), dtype=np.uint64)
    for band in range(BANDS):
        acc = np.full(len(begin), band + 1, np.uint64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            entry = (h * K.powers(K.MULT2, k + 2)[k + 1] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
            r, inverse, beta, ln_c = (t[k][entry] for t in tables)
            t = np.floor(ln_w * inverse + beta)
            ln_a = ln_c - r * (t - beta)
            bits = ln_a.view(np.uint32)
            order = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)).astype(np.uint64) << np.uint64(32)
            best = (np.minimum.reduceat(order | index, begin) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            acc = K.mix(acc * K.MULT + (h[best] ^ K.mix(t[best].astype(np.int64).astype(np.uint64))))
        out[:, band] = acc
    return text[begin], out


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """Inverse document frequency of each word bucket, over all documents."""
    size = 1 << BUCKET_BITS

    def count(batches):
        n, df = 0, np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column(0)
            n += len(column)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                pairs = np.unique(w.text.astype(np.int64) << BUCKET_BITS | (w.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
                df += np.bincount(pairs & size - 1, minlength=size)
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1), pa.int32()), pa.array(np.append(df[k], n), pa.int64())], ["k", "n"])

    got = docs.select(text_bytes(text_col).alias("t")).mapInArrow(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    k, n = got["k"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(size)
    df[k[k >= 0]] = n[k >= 0]
    total = int(n[k < 0].sum())
    return np.log(1 + (total + 1) / (1 + df))


class Vectors:
    """Shingle vectors of a column of texts: a shingle that a text holds k times is k features of the shingle's weight, so common weight is a sum over common features."""

    def __init__(self, column: pa.Array, idf: np.ndarray):
        text, feature, weight = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0)]
        for i, j in K.passes(np.diff(K.raw(column)[0])):
            own, h, one, n = counted_shingles(K.Words(*K.joined(column, i, j), K.word_class("alnum"), True), idf)
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            text.append(np.repeat(own, n) + i)
            feature.append(np.repeat(h, n) + K.mix(nth.astype(np.uint64)))
            weight.append(np.repeat(one, n))
        text, self.feature, self.weight = np.concatenate(text), np.concatenate(feature), np.concatenate(weight)
        self.first = np.searchsorted(text, np.arange(len(column) + 1))
        self.total = np.bincount(text, self.weight, len(column))

    def features(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Feature indices of some texts, and each one's place among the texts."""
        n = self.first[texts + 1] - self.first[texts]
        return np.arange(n.sum()) + np.repeat(self.first[texts] - np.cumsum(n) + n, n), np.repeat(np.arange(len(texts)), n)

    def similarities(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarity of every left with every right text."""
        (a, row), (b, column) = self.features(left), self.features(right)
        shared = np.intersect1d(self.feature[a], self.feature[b])
        common = np.zeros((len(left), len(right)))
        if len(shared):
            ka, kb = (np.minimum(np.searchsorted(shared, self.feature[x]), len(shared) - 1) for x in (a, b))
            hit = shared[ka] == self.feature[a]
            a, row, ka = a[hit], row[hit], ka[hit]
            hit = shared[kb] == self.feature[b]
            column, kb = column[hit], kb[hit]
            for c in range(0, len(shared), 2048):
                x, y = np.zeros((len(left), 2048)), np.zeros((len(right), 2048))
                here = (ka >= c) & (ka < c + 2048)
                x[row[here], ka[here] - c] = self.weight[a[here]]
                here = (kb >= c) & (kb < c + 2048)
                y[column[here], kb[here] - c] = 1
                common += x @ y.T
        total = self.total[left][:, None] + self.total[right][None, :] - common
        return np.divide(common, total, out=np.zeros_like(common), where=total > 0)


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links between some labels, those that still join two trees."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for x, y in np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0).tolist():
        if (p := root(x)) != (q := root(y)):
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def links(work: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (a, b) between components, from groups of nodes to compare: rows (grp, side, node, component).

    Side 0 is compared with side 1, or with itself where a group has no side 1. A group's links are thinned to a forest.
    """
    work = cut(work)
    n, (held, size) = work.count(), texts.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    count = max(int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(n * (size / max(1, held) + 64)) // BUNDLE_BYTES)
    bundled = work.join(texts, "node").withColumn("bundle", F.pmod(F.xxhash64("grp"), F.lit(count)).cast("int"))

    def compare(table: pa.Table) -> pa.Table:
        node, grp, side, component = (table[c].to_numpy() for c in ("node", "grp", "side", "component"))
        _, first, back = np.unique(node, return_index=True, return_inverse=True)
        column = table["t"].take(pa.array(first)).combine_chunks()
        vectors = Vectors(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column, idf.value)
        order = np.lexsort((node, side, grp))
        edge = np.flatnonzero(np.append(True, grp[order][1:] != grp[order][:-1])).tolist() + [len(order)]
        found: list[tuple[int, int]] = []
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            own = order[i:j]
            cut_at = int(np.searchsorted(side[own], 1))
            left, right = own[:cut_at], own[cut_at:] if cut_at < len(own) else own
            near = (vectors.similarities(back[left], back[right]) >= threshold - SLACK) & (component[left][:, None] != component[right][None, :])
            p, q = np.nonzero(near)
            if len(p):
                found += forest(component[left[p]], component[right[q]])
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return cut(bundled.select("bundle", "grp", "side", "node", "component", "t").groupBy("bundle").applyInArrow(compare, "a long, b long"))


def pivot_groups(members: DataFrame) -> DataFrame:
    """Each bucket's pivots against its other members; a pivot with many is met in groups of about BLOCK."""
    order = [F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(PIVOTS)]
    pivots = members.groupBy("bucket").agg(F.array(*order).alias("p"))
    pairs = members.join(pivots, "bucket").select("node", F.explode("p").alias("p")).where("node <> p").distinct()
    big = pairs.groupBy("p").count().where(F.col("count") > BLOCK)
    grouped = pairs.join(big, "p", "left").select("node", "p", F.xxhash64("p", F.pmod(F.xxhash64("node"), F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)))).alias("grp"))
    own = grouped.select("grp", F.lit(0).alias("side"), F.col("p").alias("node")).distinct()
    return own.union(grouped.select("grp", F.lit(1), "node")).withColumn("component", F.col("node"))


def block_groups(members: DataFrame, component: DataFrame) -> DataFrame:
    """Pairs of blocks of the buckets that hold several components. A component with many members has blocks of its own, which never meet each other."""
    labelled = members.join(component, "node")
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m")).where("low < high").select("bucket", "m")
    rows = cut(labelled.join(mixed, "bucket"))
    big = rows.groupBy("bucket", "component").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    part = lambda size: F.pmod(F.xxhash64("node"), F.ceil(F.col(size) / BLOCK))
    rows = rows.join(big, ["bucket", "component"], "left")
    rows = rows.select("bucket", "node", "component", F.when(F.col("n").isNull(), part("m")).otherwise(F.xxhash64("component", part("n"))).alias("blk"), F.when(F.col("n").isNotNull(), F.col("component")).alias("home"))
    other = rows.select("bucket", F.col("blk").alias("blk2"), F.col("home").alias("home2")).distinct()
    meet = rows.join(other, "bucket").where("home IS NULL OR home2 IS NULL OR home <> home2")
    return meet.select(F.xxhash64("bucket", F.least("blk", "blk2"), F.greatest("blk", "blk2")).alias("grp"), (F.col("blk") > F.col("blk2")).cast("int").alias("side"), "node", "component")


def classes(docs: DataFrame, threshold: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its id, class_id (the smallest id of its class) and kept (id = class_id).

    Documents with equal texts, or with a weighted Jaccard similarity of at least ``threshold``, are linked; a class is what links
    connect. A pair at 0.8 shares no bucket, and is missed, with probability 0.00004. Null and empty texts equal each other; texts of
    one to four words have one shingle, texts without words link with equal texts only; texts of any length are compared
    whole. A null id is the smallest; each row is compared by its own text, and rows that share an id share a class. Other columns are not read.
    """
    spark = docs.sparkSession
    text_batches(spark)
    source, own_id = with_row(docs, id_col, text_col)
    idf = spark.sparkContext.broadcast(document_frequencies(docs, text_col))

    def sign(batches):
        tables = parameters()
        for batch in batches:
            column = batch.column(4)
            for i, j in K.passes(np.diff(K.raw(column)[0])):
                w = K.Words(*K.joined(column, i, j), K.word_class("alnum"), True)
                which, rows = bands(*weighted_shingles(w, idf.value), j - i, tables)
                size = np.zeros(j - i, np.int64)
                size[which] = BANDS
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(rows.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, j - i) for c in range(4)), lists], ["row", "id", "h", "g", "bands"])

    keyed = source.select("row", id_or_least("id").alias("id"), F.xxhash64("t").alias("h"), F.xxhash64(F.lit(1), "t").alias("g"), "t")
    signed = cut(keyed.mapInArrow(sign, "row long, id long, h long, g long, bands array<long>"))
    folded = cut(signed.groupBy("h", "g").agg(F.min("row").alias("node"), F.first("bands").alias("bands")))
    entries = folded.select("node", F.explode("bands").alias("bucket"))
    full = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = cut(entries.join(full, "bucket"))
    involved = members.select("node").distinct()
    texts = cut(source.join(involved, F.col("row") == F.col("node"), "left_semi").select(F.col("row").alias("node"), "t"))

    first = connected_components(links(pivot_groups(members), texts, idf, threshold)).withColumnRenamed("id", "node")
    component = cut(involved.join(first, "node", "left").select("node", F.coalesce("component", "node").alias("component")))
    edges = links(block_groups(members, component), texts, idf, threshold)
    nodes = folded.select("h", "g", "node").join(component, "node", "left").select("h", "g", F.coalesce("component", "node").alias("component"))
    rows = signed.select("row", "id", "h", "g").join(nodes, ["h", "g"]).select("row", "id", "component")
    if not own_id:  # rows that share an id
        rows = cut(rows)
        shared = rows.groupBy("id").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("id", "low")
        edges = edges.union(rows.join(shared, "id").where("component <> low").select("component", "low"))
    second = connected_components(edges).select(F.col("id").alias("component"), F.col("component").alias("now"))
    out = rows.join(second, "component", "left").select("id", F.coalesce("now", "component").alias("class_id"))
    if not own_id:
        least = rows.select(F.col("row").alias("class_id"), F.col("id").alias("least"))
        out = out.join(least, "class_id").select("id", F.col("least").alias("class_id"))
    idf.unpersist()
    return out.select(F.col("id").alias(id_col), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))
