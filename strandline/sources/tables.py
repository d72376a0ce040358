"""Tab-separated inputs: intervals, gene lists, coordinates, FASTA indexes and sequences, realignment hits, comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.sources import reference

BLAST8 = "query string, subject string, identity double, length int, mismatches int, gaps int, q_start int, q_end int, s_start long, s_end long, evalue double, bitscore double"
#: The 21 columns of PSL.
PSL = (
    "matches int, mismatches int, rep_matches int, n_count int, q_num_insert int, q_base_insert int, t_num_insert int, t_base_insert int, strand string, query string, q_size int, q_start int, q_end int, "
    "subject string, t_size long, s_start long, s_end long, block_count int, block_sizes string, q_starts string, t_starts string"
)


def _tsv(spark: SparkSession, path, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").option("comment", "#").option("quote", "").csv(path)


def read_bed(spark: SparkSession, path) -> DataFrame:
    """Intervals; a missing name is empty."""
    return _tsv(spark, path, "chrom string, start long, end long, name string").where("start IS NOT NULL").withColumn("name", F.coalesce("name", F.lit("")))


def write_bed(intervals: DataFrame, path: str, compression: str = "none") -> None:
    intervals.select("chrom", "start", "end", "name").write.mode("overwrite").option("sep", "\t").option("emptyValue", "").option("compression", compression).csv(path)


def chromosome_file(spark: SparkSession, folder: str, chrom: str) -> str:
    """A chromosome's interval file in a folder of any store that Spark reads: the gzipped one if it is there, else the plain one."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in (f"{folder}/chr{chrom}.bed.gz", f"{folder}/chr{chrom}.bed"):
        at = hadoop.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return path
    raise FileNotFoundError(f"no chr{chrom}.bed.gz or chr{chrom}.bed in {folder}")


def read_list(spark: SparkSession, path) -> DataFrame:
    """One entry a line."""
    return spark.read.text(path).select(F.trim("value").alias("entry")).where("entry <> '' AND NOT startswith(entry, '#')").distinct()


def read_coordinates(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, "chrom string, start long, stop long").where("start IS NOT NULL")


def read_fai(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, "name string, length long, offset long, linebases int, linewidth int")


def chrom_size(fai: DataFrame, chrom: str) -> int:
    """Length of a chromosome, with or without a chr prefix; -1 where it is not listed."""
    row = fai.where(F.col("name").isin(chrom, f"chr{chrom}")).agg(F.max("length").alias("n")).first()
    return row.n if row.n is not None else -1


def read_reference(spark: SparkSession, path, fai: DataFrame | None = None) -> DataFrame:
    """Reference bases (chrom, pos, base) of FASTA text, one row for each base; joins take the packed rows of ``reference.read_packed_reference``."""
    return reference.bases_of(reference.read_packed_reference(spark, path, fai))


def read_hits(spark: SparkSession, path, form: str = "blast") -> DataFrame:
    """Realignment hits with the parts of the query id: sample, chrom, pos, read name, base, bq, mq, flag, length."""
    hits = _tsv(spark, path, BLAST8 if form == "blast" else PSL).where("s_start IS NOT NULL")
    part = lambda k, t="string": F.get(F.split("query", "_"), k).cast(t)
    hits = hits.withColumns({"sample": part(0), "chrom": part(1), "pos": part(2, "long"), "read_name": part(3), "base": part(4), "bq": part(5, "int"), "mq": part(6, "int"), "flag": part(7, "int"), "read_length": part(8, "int")})
    return hits if form == "blast" else hits.withColumn("score", F.expr("matches + rep_matches - mismatches - q_num_insert - t_num_insert"))


def read_maf(spark: SparkSession, path) -> DataFrame:
    """Keys of a mutation table: chromosome and stop."""
    lines = spark.read.text(path).where(~F.col("value").startswith("#") & ~F.lower("value").startswith("hugo_symbol"))
    c = lambda k: F.get(F.split("value", "\t"), k)
    return lines.select(c(4).alias("chrom"), F.expr("try_cast(split(value, '\t')[6] AS bigint)").alias("pos")).where("pos IS NOT NULL")


def read_validation(spark: SparkSession, path) -> DataFrame:
    return _tsv(spark, path, "chrom string, start long, stop long, ref string, var string, source string, result string").where("stop IS NOT NULL").withColumn("pos", F.col("stop"))


def read_simulation(spark: SparkSession, path) -> DataFrame:
    schema = "type string, chrom string, start long, stop long, target_af double, pos long, change string, cov_in int, cov_out int, actual_af double, highest_af double"
    return _tsv(spark, path, schema).where("pos IS NOT NULL")
