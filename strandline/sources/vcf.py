"""Variant call files: header on the driver (it is small), records as DataFrames; and back."""

from __future__ import annotations

import glob
import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.strings import BARCODE, format_info, parse_info, parse_sample

#: The columns before the samples.
FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
#: Order of the FORMAT fields.
FORMAT = "GT:DP:AD:AF:INS:DEL:DP4:START:STOP:MQ0:MMQ:MQA:BQ:SB:MMP"


class HeaderError(ValueError):
    """A header without a column line, or with columns in the wrong order."""


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines in their order, down to the column line, of the first file under a path; no more of it is read than a little over the header."""
    files = sorted(spark.read.text(path).inputFiles())
    n = 256
    while files:
        lines = [r.value for r in spark.read.text(files[0]).limit(n).collect()]
        head = [x for x in lines if x.startswith("#")]
        if len(lines) < n or len(head) < len(lines):
            return head
        n *= 4
    return []


def check_paths(inputs: list[str], output: str | None = None) -> None:
    """Raises where an input file is missing or an output's folder is, for paths on a local file system."""
    local = lambda p: "://" not in p
    missing = [p for p in inputs if local(p) and not glob.glob(p)]
    if missing:
        raise FileNotFoundError(", ".join(missing))
    if output is not None and local(output) and not os.path.isdir(os.path.dirname(os.path.abspath(output))):
        raise FileNotFoundError(os.path.dirname(output))


def sample_columns(header: list[str]) -> list[str]:
    line = next((h for h in header if h.startswith("#CHROM")), None)
    if line is None:
        raise HeaderError("no #CHROM line")
    names = line.lstrip("#").split("\t")
    if names[: len(FIXED)] != FIXED[: len(names)]:
        raise HeaderError(f"columns {names[: len(FIXED)]}")
    return names[len(FIXED) :]


def parse_meta(line: str) -> tuple[str, dict[str, str]]:
    """Key and attributes of a ``##KEY=<...>`` line, or key and {"value"}."""
    m = re.match(r"##([^=]+)=<(.*)>$", line)
    if not m:
        key, _, value = line.lstrip("#").partition("=")
        return key, {"value": value}
    return m[1], {k: v.strip('"') for k, v in re.findall(r'(\w+)=("[^"]*"|[^,]*)', m[2])}


def generator_params(header: list[str]) -> dict[str, str]:
    """Run parameters that a ``##vcfGenerator`` line carries."""
    line = next((h for h in header if h.startswith("##vcfGenerator=")), "")
    return dict(re.findall(r"(\w+)=<([^>]*)>", line.partition("=")[2]))


def merge_headers(headers: list[list[str]]) -> list[str]:
    """One header: plain lines, samples, pedigrees, then filters, infos and formats by id, then the column line."""
    seen = {h: None for lines in headers for h in lines}
    kind = lambda h: parse_meta(h)[0]
    by_id = lambda h: parse_meta(h)[1].get("ID", h)
    groups = {k: [h for h in seen if h.startswith("##") and kind(h) == k] for k in ("SAMPLE", "PEDIGREE", "FILTER", "INFO", "FORMAT")}
    plain = [h for h in seen if h.startswith("##") and kind(h) not in groups]
    first = sorted(plain, key=lambda h: not h.startswith("##fileformat"))
    return [*first, *groups["SAMPLE"], *groups["PEDIGREE"], *(h for k in ("FILTER", "INFO", "FORMAT") for h in sorted(groups[k], key=by_id)), *[h for h in seen if h.startswith("#CHROM")][:1]]


def sample_line(name: str, patient: str, file: str, description: str, analyte: str, platform: str | None = None, source: str | None = None) -> str:
    """The ``##SAMPLE`` line of a sample; its name is the barcode in the file's name, or the patient."""
    found = re.search(BARCODE, file)
    fields = {"ID": name, "SampleName": found[0] if found else patient, "Individual": patient}
    quoted = {"Description": description, "File": file, "Analyte": analyte, "Platform": platform, "Source": source}
    return "##SAMPLE=<" + ",".join([*(f"{k}={v}" for k, v in fields.items()), *(f'{k}="{v}"' for k, v in quoted.items() if v is not None)]) + ">"


def header_lines(samples: list[str] | dict[str, str], params: dict[str, str], filters: dict[str, str] | None = None, infos: dict[str, tuple[str, str, str]] | None = None, formats: dict[str, tuple[str, str, str]] | None = None) -> list[str]:
    """Header lines; ``samples`` are names, or ``sample_line`` lines by name."""
    out = ["##fileformat=VCFv4.1", "##vcfGenerator=<" + ",".join(f"{k}=<{v}>" for k, v in params.items()) + ">"]
    names = list(samples)
    out += list(samples.values()) if isinstance(samples, dict) else [f"##SAMPLE=<ID={s}>" for s in samples]
    out += [f"##PEDIGREE=<Derived={s},Original={names[0]}>" for s in names[1:]]
    out += [f'##FILTER=<ID={k},Description="{v}">' for k, v in sorted((filters or {}).items())]
    for key, table in (("INFO", infos), ("FORMAT", formats)):
        out += [f'##{key}=<ID={k},Number={n},Type={t},Description="{d}">' for k, (n, t, d) in sorted((table or {}).items())]
    return [*out, "#" + "\t".join([*FIXED, *names])]


def read_vcf(spark: SparkSession, path: str | list[str], samples: list[str], passing_only: bool = False) -> DataFrame:
    """Records of text files (plain or gzip, globs too): id, ref, alt, filter, format arrays, info map, one map of values for each sample."""
    lines = spark.read.text(path).where((F.col("value") != "") & ~F.col("value").startswith("#"))
    c = lambda k: F.get(F.split("value", "\t"), k)
    listed = lambda k, sep: F.when((c(k) == ".") | c(k).isNull(), F.array().cast("array<string>")).otherwise(F.split(c(k), sep))
    out = lines.select(
        c(0).alias("chrom"), F.try_to_number(c(1), F.lit("999999999999")).cast("long").alias("pos"), listed(2, ";").alias("id"), listed(3, ",").alias("ref"), listed(4, ",").alias("alt"),
        F.expr("try_cast(nullif(split(value, '\t')[5], '.') AS double)").alias("qual"), listed(6, ";").alias("filter"), parse_info(c(7)).alias("info"), listed(8, ":").alias("format"),
        *[c(9 + k).alias(f"_s{k}") for k in range(len(samples))],
    )
    n = F.size("ref") + F.size("alt")
    for k, s in enumerate(samples):
        out = out.withColumn(s.lower(), F.when(F.col(f"_s{k}").isNotNull() & ~F.col(f"_s{k}").isin(".", "./."), parse_sample(F.col(f"_s{k}"), F.col("format"), n))).drop(f"_s{k}")
    return out.where(F.array_contains("filter", "PASS")) if passing_only else out


def joined(values: Column, sep: str) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, sep)).otherwise(".")


def format_lines(records: DataFrame, samples: list[str], *keep: str, info_sorted: bool = True) -> DataFrame:
    """Records as lines; an absent sample is ``./.``, on Y a dot. keep: columns that stay beside the line. info_sorted: INFO by key, else in the order in which the record has it."""
    empty = F.when(F.col("chrom").isin("Y", "chrY"), ".").otherwise("./.")

    def sample(s: str) -> Column:
        values = F.transform("format", lambda k: F.when(k == "GT", F.array_join(F.col(s.lower())[k], "/")).otherwise(F.array_join(F.col(s.lower())[k], ",")))
        return F.when(F.col(s.lower()).isNull(), empty).otherwise(F.array_join(values, ":"))

    qual = F.when(F.col("qual").isNull(), ".").when(F.col("qual") == F.floor("qual"), F.col("qual").cast("long").cast("string")).otherwise(F.col("qual").cast("string"))
    return records.select(*keep, F.concat_ws("\t", "chrom", F.col("pos").cast("string"), joined(F.col("id"), ";"), joined(F.col("ref"), ","), joined(F.col("alt"), ","), qual, joined(F.col("filter"), ";"), format_info(F.col("info"), info_sorted), joined(F.col("format"), ":"), *[sample(s) for s in samples]).alias("value"))


def write_vcf(records: DataFrame, samples: list[str], header: list[str], path: str, compression: str = "none", mode: str = "overwrite", info_sorted: bool = True) -> None:
    """A folder of text parts that, one after another by name, are one file: the header, then the records by chromosome and position.

    Mode "append" adds records to a folder that has a header; info_sorted: see ``format_lines``.
    """
    lines = format_lines(records, samples, "chrom", "pos", info_sorted=info_sorted).select(F.lit(1).alias("k"), F.expr("try_cast(chrom AS int)").alias("n"), "chrom", "pos", "value")
    if mode != "append":
        head = records.sparkSession.createDataFrame([(0, None, "", k, h) for k, h in enumerate(header)], "k int, n int, chrom string, pos long, value string")
        lines = head.unionByName(lines)
    ordered = lines.orderBy("k", F.col("n").asc_nulls_last(), "chrom", "pos")
    ordered.select("value").write.mode(mode).option("compression", compression).text(path)


def write_table(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Counts (run totals, positions with data, comparisons) as tab-separated text with a header line."""
    rows.write.mode(mode).option("sep", "\t").option("header", "true").csv(path)
