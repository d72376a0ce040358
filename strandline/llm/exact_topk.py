"""Exact top-k by inner product: candidates in blocks by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds on the rest.

Vectors are folded to distinct ones (of equal vectors only the k + 1 smallest ids can matter) and packed in blocks of descending
length, queries likewise. Each block of queries meets the longest block first, which gives every query a score to beat; pairs of blocks whose lengths
can't reach it are never sent. The rest is dealt by (block of queries, stripe), and a task goes through its stripe by descending
length: a query drops out where length times length falls below its score to beat; else a partial sum over the leading rotated components plus the
product of the residual lengths bounds each score from above, first over an eighth of the components, then over half, and what is left is multiplied out exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm.common import NULL_ID, cut, id_or_least, text_batches

K = 5
SCALE = 256
#: Vectors and bytes of a block; candidates and queries that numpy compares at a time.
ROWS, BLOCK_BYTES, STEP = 4096, 1 << 20, 512
#: Distinct vectors that the rotation is learned from; longer vectors, and lengths beyond BASIS_BYTES, are bounded by their lengths alone.
SAMPLE, LONGEST, BASIS_BYTES = 2048, 2048, 32 << 20
#: Room for rounding, as a share of the product of the lengths.
SLACK = 1e-9
#: Whole numbers up to here are exact as doubles.
EXACT = 2.0**53
#: Lengths count up to here: the score of any such vector with another than zero is beyond a long or bounded by it, and products of lengths stay finite.
HUGE = 1e150
MOST = 2**63 - 1


def scaled(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(id, d, wide, codes, norm, own) of vectors that take part: floor(scale * x) as packed int16 (wide: double), length and squared length.

    Null vectors and those with null or non-finite components (scaled ones, too) take no part; a null id is the least.
    """

    def pack(batches):
        for batch in batches:
            vectors = batch.column(1)
            at, flat = vectors.offsets.to_numpy().astype(np.int64), vectors.values.to_numpy(zero_copy_only=False).astype(float)
            size = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), np.diff(at), -1)
            for d in np.unique(size[size >= 0]).tolist():
                rows = np.flatnonzero(size == d)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(flat[at[rows][:, None] + np.arange(d)] * scale) + 0.0
                good = np.isfinite(x).all(1)
                x, rows = x[good], rows[good]
                wide = np.abs(x).max(1, initial=0) >= 1 << 15
                codes = [(v if w else v.astype(np.int16)).tobytes() for v, w in zip(x, wide, strict=True)]
                largest = np.abs(x).max(1, initial=1)
                norm = np.minimum(HUGE, np.linalg.norm(x / largest[:, None], axis=1) * np.minimum(HUGE, largest))
                own = scores(x, x)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), d, np.int32)), pa.array(wide), pa.array(codes, pa.binary()), pa.array(norm), pa.array(own)], ["id", "d", "wide", "codes", "norm", "own"])

    rows = vectors.select(id_or_least(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(pack, "id long, d int, wide boolean, codes binary, norm double, own long")


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly; beyond a long they count as its ends."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([max(-MOST, min(MOST, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for p, q in zip(a, b, strict=True)], np.int64)


def blocks(distinct: DataFrame) -> DataFrame:
    """Blocks (d, at, n, wide, top, norms, codes, many, ids) of distinct vectors (d, wide, codes, norm, ids); ``at`` goes by descending length within d and wide."""

    def build(batches):
        held: list[dict] = []
        size = 0

        def out():
            ids = [i for r in held for i in r["ids"]]
            row = [held[0]["d"], len(held), held[0]["wide"], held[0]["norm"], np.array([r["norm"] for r in held]).tobytes(), b"".join(r["codes"] for r in held), np.array([len(r["ids"]) for r in held], np.int32).tobytes(), np.array(ids, np.int64).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names)

        names = ["d", "n", "wide", "top", "norms", "codes", "many", "ids"]
        kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.float64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
        for batch in batches:
            for r in batch.to_pylist():
                if held and ((r["d"], r["wide"]) != (held[0]["d"], held[0]["wide"]) or len(held) == ROWS or size + len(r["codes"]) > BLOCK_BYTES):
                    yield out()
                    held, size = [], 0
                held.append(r)
                size += len(r["codes"])
        if held:
            yield out()

    keys = ["d", F.desc("wide"), F.desc("norm"), F.xxhash64("codes")]
    placed = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys).select("d", "wide", "codes", "norm", "ids")
    made = placed.mapInArrow(build, "d int, n int, wide boolean, top double, norms binary, codes binary, many binary, ids binary")
    return cut(made.withColumn("at", F.monotonically_increasing_id()))


def rotations(distinct: DataFrame) -> dict[int, np.ndarray]:
    """By number of components, the leading right singular vectors of a sample of at most SAMPLE vectors, as columns."""
    drawn = distinct.where(F.col("d").between(4, LONGEST)).orderBy(F.xxhash64("codes", "d"), "codes").limit(SAMPLE).select("d", "wide", "codes").toArrow().to_pylist()
    by: dict[int, list] = {}
    for r in drawn:
        by.setdefault(r["d"], []).append(np.frombuffer(r["codes"], float if r["wide"] else np.int16).astype(float))
    out, room = {}, BASIS_BYTES
    for d in sorted(by, key=lambda d: (-len(by[d]), d)):
        x = np.array(by[d])
        x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1)
        _, _, v = np.linalg.svd(x, full_matrices=False)
        basis = np.ascontiguousarray(v[: max(2, d // 2)].T)
        room -= basis.nbytes
        if room < 0:
            break
        out[d] = basis
    return out


class Block:
    """Vectors of a block, their leading rotated components, and the lengths of what two numbers of them leave over."""

    def __init__(self, row: dict, basis: np.ndarray | None):
        d, n = row["d"], row["n"]
        self.x = np.frombuffer(row["codes"], float if row["wide"] else np.int16).reshape(n, d).astype(float)
        self.norm = np.frombuffer(row["norms"], float)
        self.many = np.frombuffer(row["many"], np.int32).astype(np.int64)
        self.ids, self.first = np.frombuffer(row["ids"], np.int64), np.cumsum(self.many) - self.many
        self.largest = float(np.abs(self.x).max(initial=0))
        self.lead = np.zeros((n, 0 if basis is None else basis.shape[1])) if basis is None or self.largest > HUGE / d else self.x @ basis
        self.parts = (max(1, self.lead.shape[1] // 4), self.lead.shape[1]) if self.lead.shape[1] else (0, 0)
        self.left = []
        for m in self.parts:
            part = self.lead[:, :m] / np.maximum(self.norm, 1e-300)[:, None]
            self.left.append(self.norm * np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", part, part)) + SLACK))


class Search:
    """The best k + 1 (score, id) so far of each query of a block."""

    def __init__(self, queries: Block, beat: np.ndarray, k: int):
        self.q, self.k, n = queries, k + 1, len(queries.x)
        self.score, self.id, self.filled = np.zeros((n, k + 1), np.int64), np.zeros((n, k + 1), np.int64), np.zeros(n, np.int64)
        self.beat = beat.copy()
        self.multiplied = 0

    def take(self, q: np.ndarray, j: np.ndarray, score: np.ndarray, c: Block) -> None:
        """New scores of queries with candidates join the lists."""
        many = c.many[j]
        within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        ids = c.ids[np.repeat(c.first[j], many) + within]
        q, score = np.repeat(q, many), np.repeat(score, many)
        touched = np.unique(q)
        old = np.repeat(touched, self.filled[touched])
        slot = np.arange(len(old)) - np.repeat(np.cumsum(self.filled[touched]) - self.filled[touched], self.filled[touched])
        q, score, ids = np.concatenate([old, q]), np.concatenate([self.score[old, slot], score]), np.concatenate([self.id[old, slot], ids])
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        top = rank < self.k
        self.score[q[top], rank[top]], self.id[q[top], rank[top]] = score[top], ids[top]
        self.filled[touched] = np.minimum(self.k, np.bincount(np.searchsorted(touched, q), minlength=len(touched)))
        full = touched[self.filled[touched] == self.k]
        self.beat[full] = np.maximum(self.beat[full], self.score[full, self.k - 1])

    def meet(self, c: Block) -> None:
        """All candidates of a block, which stand by descending length."""
        exact = self.q.largest * c.largest * max(1, self.q.x.shape[1]) < EXACT
        for i in range(0, len(c.x), STEP):
            near = c.norm[i : i + STEP]
            reach = self.q.norm * near[0] * (1 + SLACK)
            live = np.flatnonzero(reach >= self.beat)
            if not len(live):
                break
            for k in range(0, len(live), STEP):
                self.sift(live[k : k + STEP], np.arange(i, i + len(near)), c, exact)

    def sift(self, q: np.ndarray, j: np.ndarray, c: Block, exact: bool) -> None:
        own = self.q
        beat = self.beat[q]
        slack = SLACK * own.norm[q][:, None] * c.norm[j]
        m = own.parts[0]
        bound = own.lead[q, :m] @ c.lead[j, :m].T + own.left[0][q][:, None] * c.left[0][j] + slack
        open_ = bound >= beat[:, None]
        if exact and open_.mean() > 0.2:
            every = own.x[q] @ c.x[j].T
            self.multiplied += every.size
            if len(j) >= self.k:
                beat = np.maximum(beat, np.partition(every, -self.k, 1)[:, -self.k])
            a, b = np.nonzero(every >= beat[:, None])
            found = every[a, b].astype(np.int64)
        else:
            a, b = np.nonzero(open_)
            if own.parts[1] > m:
                m = own.parts[1]
                closer = np.einsum("ij,ij->i", own.lead[q[a], :m], c.lead[j[b], :m]) + own.left[1][q[a]] * c.left[1][j[b]] + slack[a, b]
                a, b = a[closer >= beat[a]], b[closer >= beat[a]]
            self.multiplied += len(a)
            found = scores(own.x[q[a]], c.x[j[b]])
            good = found >= beat[a]
            a, b, found = a[good], b[good], found[good]
        if len(a):
            self.take(q[a], j[b], found, c)

    def row(self, at: int) -> pa.RecordBatch:
        """The block of queries, their scores to beat, the least length of a candidate that reaches one of them, and what was found."""
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(self.beat <= 0, 0.0, np.where(self.q.norm > 0, self.beat / self.q.norm, np.inf))
        q = np.repeat(np.arange(len(self.filled)), self.filled)
        slot = np.arange(len(q)) - np.repeat(np.cumsum(self.filled) - self.filled, self.filled)
        found = pa.StructArray.from_arrays([pa.array(self.q.ids[q]), pa.array(self.score[q, slot]), pa.array(self.id[q, slot])], ["query", "score", "id"])
        lists = pa.ListArray.from_arrays(pa.array([0, len(q)], pa.int32()), found)
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([self.beat.tobytes()], pa.binary()), pa.array([float(need.min())]), lists], ["q", "beat", "need", "found"])


def searched(queries: DataFrame, candidates: DataFrame, pairs: DataFrame, basis, k: int) -> DataFrame:
    """(q, beat, need, found): the best k + 1 of each query of a block q among the blocks that ``pairs`` (q, at, stripe) joins it with, a row for each stripe.

    A task takes the candidates of one block of queries and one stripe by descending length. Queries that come with a score to beat keep to it (equal scores count).
    """
    keys = ["q", "stripe"]
    asked = pairs.select(*keys).distinct().join(queries, F.col("q") == F.col("at")).drop("at").withColumn("at", F.lit(-1).cast("long"))
    met = pairs.join(candidates, "at").withColumn("beat", F.lit(None).cast("binary"))
    dealt = asked.unionByName(met).repartition(*keys).sortWithinPartitions(*keys, "at")

    def run(batches):
        search, q = None, -1
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, basis.value.get(row["d"]))
                if row["at"] >= 0:
                    search.meet(block)
                    continue
                if search is not None:
                    yield search.row(q)
                beat = np.frombuffer(row["beat"], float) if row["beat"] is not None else np.full(row["n"], -np.inf)
                search, q = Search(block, beat, k), row["q"]
        if search is not None:
            yield search.row(q)

    return dealt.mapInArrow(run, "q long, beat binary, need double, found array<struct<query:long,score:long,id:long>>")


def top(found: DataFrame, k: int) -> DataFrame:
    """The best k + 1 of each query, ties by id, as an array of (score, id)."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1)
    return best.groupBy("query").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "score", "id"))), lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("best"))


def top_k(vectors: DataFrame, asked: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``asked`` its k best among all other rows of ``vectors`` by integer inner product.

    Rows of ``asked`` are rows of ``vectors``. Components become floor(256 * x); equal scores go to the smaller id; fewer rows than k give fewer. Vectors that are null or hold null or non-finite
    components (also after scaling) take no part. Only vectors of as many components as the query's are compared; vectors without components score 0 with each
    other. A null id is the smallest and is returned as null; rows that repeat an id are rows of their own, as queries too. Scores beyond a long
    count as its ends. Other columns are not read. No rows give no rows.
    """
    spark = vectors.sparkSession
    text_batches(spark)
    rows = scaled(vectors, id_col, vector_col)
    # of equal vectors only the k + 1 smallest ids can be among a query's best; each task drops the others before the exchange
    same = ["d", "codes", "wide", "norm"]
    few = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*same).orderBy("id"))).where(F.col("_rank") <= k + 1)
    folded = cut(few.groupBy(*same).agg(F.sort_array(F.collect_list("id")).alias("ids")))
    queries = scaled(asked, id_col, vector_col)
    distinct = cut(queries.groupBy(*same).agg(F.count("*").alias("_n")).drop("_n").withColumn("query", F.monotonically_increasing_id()))
    basis = spark.sparkContext.broadcast(rotations(folded))

    candidates, q = blocks(folded), blocks(distinct.withColumn("ids", F.array("query")))
    # every block of queries meets the longest block of its number of components: scores to beat
    longest = candidates.groupBy("d").agg(F.max_by("at", "top").alias("at"))
    opening = q.select(F.col("at").alias("q"), "d").join(longest, "d").select("q", "at", F.lit(0).alias("stripe"))
    first = cut(searched(q.withColumn("beat", F.lit(None).cast("binary")), candidates, opening, basis, k))
    # the others are sent where their lengths can reach one of these; the pairs hold numbers of blocks only
    armed = q.join(first.select(F.col("q").alias("at"), "beat"), "at")
    meta = q.select(F.col("at").alias("q"), "d").join(first.select("q", "need"), "q").withColumn("no", F.row_number().over(Window.partitionBy("d").orderBy("q")))
    counts = meta.groupBy("d").agg(F.max("no").alias("m"))
    stripes = max(1, -(-2 * spark.sparkContext.defaultParallelism // max(1, first.count())))
    tops = candidates.select("d", "at", "top").join(longest.select("at"), "at", "left_anti")
    pairs = tops.join(counts, "d").withColumn("no", F.explode(F.sequence(F.lit(1), F.col("m")))).join(meta, ["d", "no"]).where(F.col("top") * (1 + SLACK) >= F.col("need"))
    second = searched(armed, candidates, cut(pairs.select("q", "at", F.pmod(F.xxhash64("at"), F.lit(stripes)).cast("int").alias("stripe"))), basis, k)

    lists = top(first.select("found").unionByName(second.select("found")).select(F.inline("found")), k)
    own = queries.join(distinct, same).select("id", "own", "query").join(lists, "query")
    # the query's own row is one of its best, or k others with as good a score come before it
    at = F.array_position("best", F.struct(F.col("own").alias("score"), F.col("id").alias("id")))
    others = F.filter("best", lambda x, i: i != F.when(at > 0, at - 1).otherwise(k))
    out = own.select("id", F.posexplode(others).alias("rank", "x"))
    return out.select(F.col("id").alias("query_id"), (F.col("rank") + 1).alias("rank"), F.when(F.col("x.id") != NULL_ID, F.col("x.id")).alias(id_col), F.col("x.score").alias("score"))
