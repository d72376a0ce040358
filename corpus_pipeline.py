"""The corpus pipeline: quality, near duplicates, repeated bytes, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's docs. All but
the last return the columns that docs came with, whatever they are called. An empty table passes through every stage; null texts count as
empty; a null id is the smallest, and rows that share an id stay or go together; texts of any length are handled whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import classifiers, decontamination, near_dup, sentencepiece_spans, suffix_array_dedup
from strandline.llm.common import cut, id_or_least, table

TOKENIZER = "piece_bpe_32k.model"


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id (null: the smallest id) is not in the column doc_id of ids."""
    gone = "gone"
    while gone in docs.columns:
        gone += "_"
    return docs.join(ids.select(F.col("doc_id").alias(gone)).distinct(), id_or_least() == F.col(gone), "left_anti")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return classifiers.quality(docs, table(spark, sf_dir, "labels"), accept=True)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id. Rows that repeat an id stay together."""
    return without(docs, near_dup.classes(docs).where(~F.col("kept")))


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings that start earlier too; n_chars follows. A document may become empty."""
    done = suffix_array_dedup.remove_repeated_bytes(docs, carry=True)
    made = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept")}
    return done.select(*[(made[c] if c in made else F.col("rest").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without(docs, decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of each document's tokens and of their decoded text."""
    import public_tokenizers

    return sentencepiece_spans.token_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("suffix-array dedup", suffix_array),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

#: Learned scores, sampled bands and a tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
