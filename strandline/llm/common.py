"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A null doc_id takes part as the smallest id.
NULL_ID = -(2**63)
#: Rows of an Arrow batch of whole texts.
BATCH_ROWS, SPARK_ROWS = 500, "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Whole texts go to Python tasks in batches of BATCH_ROWS: batches of Spark's own size hold tens of MB in each of a task's buffers. A size that the session was given stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == SPARK_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """The cluster names a shared folder in spark.checkpoint.dir; a local one is set only in local mode, where none is named (tests)."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandline-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit(b""))


def id_or_least(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def with_row(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> tuple[DataFrame, bool]:
    """Columns row (unique, in the order of the ids), id, t and, if asked, rest (a struct of the other columns); and whether row is the id.

    Where ids repeat, rows that share one are ordered by their text's hash, and wholly equal rows as they come; a null id is the least.
    """
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]).alias("rest")] if carry else []
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"), *rest)
    if base.groupBy(id_or_least("id").alias("i")).count().where("count > 1").isEmpty():
        return base.withColumn("row", id_or_least("id")), True
    keys = [id_or_least("id"), F.xxhash64("t"), F.col("_at")]
    ordered = base.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut(ordered.drop("_at").withColumn("row", F.monotonically_increasing_id())), False


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every vertex of ``edges`` (columns a, b; long): columns id, component.

    Alternates two star contractions: a vertex hands its smallest known neighbour to its larger
    neighbours, then to its smaller ones. Hot vertices only meet aggregates with map-side combine and a
    join that adaptive execution can split. Rounds follow the logarithm of the longest path and end
    once every vertex points to its smallest one.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        out = both.join(least, "a")
        if large:
            return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        own = least.where("m < a").select("a", F.col("m").alias("b"))
        return out.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).distinct()

    def settled(e: DataFrame) -> bool:
        ends = e.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
        counts = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return counts.where("up > 1 OR (up = 1 AND down = 1)").count() == 0

    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while not settled(e):
        e = cut(star(star(e, True), False))
    roots = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
