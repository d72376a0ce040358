"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, and a rerank with the original vectors.

Rotations of the principal components are learned, on a bounded sample, so that signs of the rotated components lose least;
the signs of several such rotations make a balanced binary code. The code's chunks index one table each. Vectors that agree on a chunk first
compare their whole codes; only rows that have a mate within the Hamming radius there fetch their vectors and are reranked by
cosine in double precision. Tables and radius are set on the sample, on pairs made at the threshold. Equal vectors are folded
first. A bucket beyond BLOCK rows is worked in pairs of blocks, so no task holds all of it; a pair counts only in the first table where its
chunks agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import connected_components, cut, id_or_least

COSINE = 0.95
#: Vectors that the rotations are learned from, at most; least bits of a chunk at first; rows of a block; rows of a bucket compared by matrix.
SAMPLE, CHUNK_BITS, BLOCK, DENSE = 20_000, 12, 1024, 48
#: Share of the pairs just at the threshold that no table may bring together, and that the Hamming radius may leave out; tables beyond which chunks become shorter, and their least bits.
MISSED, OUTSIDE, TABLES, LEAST_BITS = 0.02, 0.001, 64, 6
#: Room for the rounding of a matrix product; pairs so near the threshold are judged one by one.
ROUNDING = 1e-9


def at_threshold(unit: np.ndarray, threshold: float) -> np.ndarray:
    """For each unit vector another one whose cosine with it is the threshold, in a random direction."""
    noise = np.random.default_rng(11).normal(size=unit.shape)
    noise -= (noise * unit).sum(1, keepdims=True) * unit
    length = np.linalg.norm(noise, axis=1, keepdims=True)
    return threshold * unit + np.sqrt(max(0.0, 1 - threshold**2)) * np.divide(noise, length, out=np.zeros_like(noise), where=length > 0)


def tables_for(unit: np.ndarray, mean: np.ndarray, bits: int, threshold: float) -> tuple[int, int] | None:
    """Bits of a chunk and number of tables that leave MISSED of the pairs at the threshold apart.

    A bit of a centred code agrees with probability 1 - angle / pi, where the angle is that of the centred pair: the nearer
    to the mean, the larger. None: too many vectors stand near the mean for that, and codes must not be centred.
    """
    x, y = unit - mean, at_threshold(unit, threshold) - mean
    length = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
    angle = np.arccos(np.clip(np.divide((x * y).sum(1), length, out=np.zeros(len(x)), where=length > 0), -1, 1))
    while True:
        apart = 1 - (1 - angle / np.pi) ** bits
        for tables in range(2, TABLES + 1):
            if (apart**tables).mean() <= MISSED:
                return bits, tables
        bits -= 1
        if bits < LEAST_BITS:
            return None


def learn(sample: np.ndarray, mean: np.ndarray, rotations: int, rounds: int = 30) -> np.ndarray:
    """The projections (dimensions x bits) of the centred vectors, one ITQ rotation after another."""
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x / max(1, len(x)))
    v = x @ axes
    d = x.shape[1]
    rng = np.random.default_rng(5)
    out = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(rounds):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(b.T @ v)
            r = (left @ right).T
        out.append(axes @ r)
    return np.concatenate(out, 1)


def chunks(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray, bits: int) -> np.ndarray:
    """Chunk values of each vector's code: vectors x tables."""
    code = (unit - mean) @ projection >= 0
    tables = code.shape[1] // bits
    code = code[:, : tables * bits].reshape(len(unit), tables, bits)
    return code @ (1 << np.arange(bits, dtype=np.int64))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distance of codes, chunk by chunk along the last axis."""
    out = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1], np.int16)
    for t in range(a.shape[-1]):
        out += np.bitwise_count(a[..., t] ^ b[..., t])
    return out


def first_agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """First table in which the chunks of two codes agree (the number of tables, if none)."""
    same = a == b
    return np.where(same.any(-1), same.argmax(-1), a.shape[-1])


class Rows:
    """Rows of a bundle of buckets, sorted by bucket and block; unit vectors are there at the rerank only."""

    def __init__(self, table: pa.Table, d: int = 0):
        take = lambda c: table[c].to_numpy()
        self.order = np.lexsort([take(c) for c in ("own", "j", "i", "key", "tbl")])
        self.tbl, self.own, self.i, self.j, key = (take(c)[self.order] for c in ("tbl", "own", "i", "j", "key"))
        self.codes = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint32).reshape(len(self.order), -1)[self.order]
        if d:
            self.id, self.n, self.rep = (take(c)[self.order] for c in ("id", "n", "rep"))
            self.x = np.frombuffer(b"".join(table["unit"].to_pylist()), np.float64).reshape(-1, d)[self.order]
        change = (self.tbl[1:] != self.tbl[:-1]) | (key[1:] != key[:-1]) | (self.i[1:] != self.i[:-1]) | (self.j[1:] != self.j[:-1])
        self.begin = np.flatnonzero(np.append(True, change)) if len(key) else np.zeros(0, np.int64)
        self.size = np.diff(np.append(self.begin, len(self.order)))

    def pairs(self, few, many) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows of one bucket (and of the right blocks) that few(p, q) accepts, or many(p's, q's) in buckets beyond DENSE."""
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        size_of = np.repeat(self.size, self.size)
        last = np.repeat(self.begin + self.size, self.size)
        for k in range(1, min(DENSE, int(self.size.max(initial=1)))):
            a = np.flatnonzero((size_of <= DENSE) & (np.arange(len(last)) + k < last))
            a = a[(self.i[a] == self.j[a]) | (self.own[a] != self.own[a + k])]
            for c in range(0, len(a), 1 << 14):
                part = a[c : c + (1 << 14)]
                hit = part[few(part, part + k)]
                left.append(hit)
                right.append(hit + k)
        for b, n in zip(self.begin[self.size > DENSE].tolist(), self.size[self.size > DENSE].tolist(), strict=True):
            whole = self.i[b] == self.j[b]
            cut_at = b + n if whole else b + int(np.searchsorted(self.own[b : b + n], self.own[b], "right"))
            p, q = (x.astype(np.int64) for x in np.nonzero(many(slice(b, cut_at), slice(b, b + n) if whole else slice(cut_at, b + n))))
            p, q = p + b, q + (b if whole else cut_at)
            if whole:
                p, q = p[p < q], q[p < q]
            left.append(p)
            right.append(q)
        return np.concatenate(left), np.concatenate(right)

    def mates(self, radius: int) -> np.ndarray:
        """Rows with a mate within the radius whose first table is this one."""

        def few(p, q):
            return (distance(self.codes[p], self.codes[q]) <= radius) & (first_agreement(self.codes[p], self.codes[q]) == self.tbl[p])

        def many(p, q):
            a, b = self.codes[p][:, None], self.codes[q][None]
            out = distance(a, b) <= radius
            for t in range(int(self.tbl[p][0])):
                out &= a[..., t] != b[..., t]
            return out

        return np.unique(self.order[np.concatenate(self.pairs(few, many))])

    def near(self, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that are near enough. The last bits of a cosine come from one sum whatever the bucket's size."""

        def few(p, q):
            return np.einsum("nd,nd->n", self.x[p], self.x[q]) >= threshold

        def many(p, q):
            cosine = self.x[p] @ self.x[q].T
            out = cosine >= threshold
            a, b = np.nonzero(np.abs(cosine - threshold) < ROUNDING)
            for c in range(0, len(a), 1 << 14):
                x, y = a[c : c + (1 << 14)], b[c : c + (1 << 14)]
                out[x, y] = few(x + p.start, y + q.start)
            return out

        return self.pairs(few, many)


def settle(rows: Rows, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vector, its least id, least id of a vector of its part here, links): a link counts in the first table where the codes' chunks agree, and joins parts in any."""
    p, q = rows.near(threshold)
    first = np.concatenate([first_agreement(rows.codes[p[c : c + (1 << 16)]], rows.codes[q[c : c + (1 << 16)]]) for c in range(0, max(1, len(p)), 1 << 16)]) == rows.tbl[p]
    links = np.bincount(p[first], rows.n[q[first]], len(rows.id)) + np.bincount(q[first], rows.n[p[first]], len(rows.id))
    ids, at, back = np.unique(rows.id, return_index=True, return_inverse=True)
    rep = rows.rep[at]
    total = np.bincount(back, links, len(ids)).astype(np.int64)
    a, b, label = back[p], back[q], np.arange(len(ids))
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = np.minimum(new, new[new])
        if (new == label).all():
            break
        label = new
    keep = (total > 0) | (label != np.arange(len(ids)))
    return ids[keep], rep[keep], rep[label][keep], total[keep]


def near_duplicates(vectors: DataFrame, threshold: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each vector: id, n_links (other vectors linked directly), component_id (smallest id reached by links), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors of unequal length never link.
    A null id is the smallest. Rows that repeat an id count as vectors of their own for n_links and share a component. Other columns are not
    read. Vectors of each length that occurs are compared by a plan of their own.
    """
    spark = vectors.sparkSession
    clean = F.when(F.size(vector_col) > 0, F.col(vector_col).cast("array<double>"))
    bad = F.exists(clean, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    zero = F.forall(clean, lambda v: v == 0)
    rows = vectors.select(id_or_least(id_col).alias("id"), F.when(~bad & ~zero, clean).alias("v"))
    folded = cut(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).withColumn("vec", F.monotonically_increasing_id()))
    lengths = [r.d for r in folded.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]
    parts = [links_of(folded.where(F.size("v") == d), d, threshold) for d in lengths]
    empty = spark.createDataFrame([], "vec long, id long, label long, links long")
    found = empty
    for p in parts:
        found = found.unionByName(p)
    found = cut(found)
    links = found.groupBy("vec").agg(F.sum("links").alias("links"))
    # rows of one vector link with each other; ids that share several vectors join their parts
    own = rows.where("v IS NOT NULL").join(folded, "v").select("id", "rep", "n", "vec")
    edges = found.where("id <> label").select(F.col("id").alias("a"), F.col("label").alias("b")).union(own.where("id <> rep").select("id", "rep"))
    component = connected_components(edges)
    counted = own.join(links, "vec", "left").select("id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = rows.where("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"))
    out = counted.unionByName(alone).join(component, "id", "left")
    return out.select(F.col("id").alias(id_col), "n_links", F.coalesce("component", "id").alias("component_id"), (F.coalesce("component", "id") == F.col("id")).alias("kept"))


def links_of(folded: DataFrame, d: int, threshold: float) -> DataFrame:
    """(vec, id, label, links) for distinct vectors of d components, one row for each block that a vector was in."""
    spark = folded.sparkSession
    total = folded.count()
    share = min(1.0, SAMPLE / max(1, total))
    drawn = folded.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= int(share * (1 << 30))).select("v").limit(2 * SAMPLE).toArrow()["v"]
    sample = np.array(drawn.to_pylist(), float).reshape(-1, d)
    sample = sample[np.lexsort(sample.T)]
    sample /= np.abs(sample).max(1, keepdims=True)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    mean = sample.mean(0)
    made = sample[np.random.default_rng(3).permutation(len(sample))[:2000]]
    bits = max(CHUNK_BITS, int(np.ceil(np.log2(max(2, total)))) - 2)
    plan = tables_for(made, mean, bits, threshold)
    if plan is None:
        mean = np.zeros(d)
        plan = tables_for(made, mean, bits, threshold) or (LEAST_BITS, TABLES)
    bits, tables = plan
    projection = learn(sample, mean, int(np.ceil(tables * bits / d)))
    index = spark.sparkContext.broadcast((mean, projection))

    def code(unit: np.ndarray) -> np.ndarray:
        return chunks(unit, *index.value, bits)[:, :tables].astype(np.uint32)

    apart = distance(code(made), code(at_threshold(made, threshold)))
    radius = int(np.ceil(np.quantile(apart, 1 - OUTSIDE))) + 1 if len(apart) else tables * bits

    def encode(batches):
        for pdf in batches:
            x = np.array(pdf["v"].tolist(), float).reshape(-1, d)
            x = x / np.abs(x).max(1, keepdims=True)
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            codes = code(unit)
            yield pd.DataFrame({"id": pdf["vec"], "rep": pdf["rep"], "n": pdf["n"], "unit": [u.tobytes() for u in unit], "keys": list(codes.astype(np.int64)), "codes": [c.tobytes() for c in codes]})

    coded = cut(folded.select("v", "vec", "rep", "n").mapInPandas(encode, "id long, rep long, n long, unit binary, keys array<long>, codes binary"))
    keyed = coded.select("id", F.posexplode("keys").alias("tbl", "key"), "codes")
    # only buckets beyond a block are looked up; their number is bounded by that of the rows over BLOCK
    large = coded.select(F.posexplode("keys").alias("tbl", "key")).groupBy("tbl", "key").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
    spread = keyed.join(large, ["tbl", "key"], "left").withColumn("blocks", F.coalesce(F.ceil(F.col("m") / BLOCK).cast("int"), F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # a row stands in the pair (i, i) of its own block and in one pair with each other block
    pairs = spread.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = pairs.select("id", "tbl", "key", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "codes")
    # buckets go in bundles, so that tasks get some thousand rows at a time
    def bundled(rows: DataFrame, n: int) -> DataFrame:
        bundles = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 8192)
        return rows.withColumn("bundle", F.pmod(F.xxhash64("tbl", "key", "i", "j"), F.lit(bundles)).cast("int"))

    def sift(table: pa.Table) -> pa.Table:
        return table.select(["id", "tbl", "key", "own", "i", "j"]).take(pa.array(Rows(table).mates(radius)))

    left = cut(bundled(placed, total * tables).groupBy("bundle").applyInArrow(sift, "id long, tbl int, key long, own int, i int, j int"))
    work = bundled(left, left.count()).join(coded.select("id", "rep", "n", "unit", "codes"), "id")

    def compare(table: pa.Table) -> pa.Table:
        return pa.table([pa.array(x, pa.int64()) for x in settle(Rows(table, d), threshold)], ["vec", "id", "label", "links"])

    return work.groupBy("bundle").applyInArrow(compare, "vec long, id long, label long, links long")
