"""Parsing and formatting of the text fields of variant records, reads and annotations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(base: Column) -> Column:
    return F.translate(base, "ACGTN", "TGCAN")


def phred(char: Column) -> Column:
    return F.ascii(char) - 33


def parse_info(info: Column) -> Column:
    """Key -> values. A flag holds ["True"]; only the first "=" separates; "." and null are empty maps."""
    items = F.filter(F.split(info, ";"), lambda x: (x != "") & (x != "."))
    entry = lambda x: F.struct(F.split(x, "=", 2)[0].alias("k"), F.when(F.contains(x, F.lit("=")), F.split(F.get(F.split(x, "=", 2), 1), ",")).otherwise(F.array(F.lit("True"))).alias("v"))
    return F.map_from_entries(F.coalesce(F.transform(items, entry), F.array().cast("array<struct<k:string,v:array<string>>>")))


def format_info(info: Column, by_key: bool = True) -> Column:
    """Entries by key, or in the map's own order; flags as bare keys; an empty map is "."."""
    keys = F.array_sort(F.map_keys(info)) if by_key else F.map_keys(info)
    text = F.array_join(F.transform(keys, lambda k: F.when(info[k] == F.array(F.lit("True")), k).otherwise(F.concat(k, F.lit("="), F.array_join(info[k], ",")))), ";")
    return F.when(text == "", ".").otherwise(text)


#: FORMAT keys with one value for each allele.
PER_ALLELE = ["GT", "AD", "AF", "DP4", "MQ0", "MMQ", "MQA", "BQ", "SB", "MMP"]


def parse_sample(sample: Column, keys: Column, n_alleles: Column) -> Column:
    """FORMAT keys -> values; GT splits on "/", others on ","; a lone "." stands for every allele under a key that has one value each, and for itself under others."""
    return F.map_from_arrays(
        keys,
        F.zip_with(keys, F.split(sample, ":"), lambda k, v: F.when(v.isNull() | (v == "."), F.array_repeat(F.lit("."), F.when(k.isin(PER_ALLELE), n_alleles).otherwise(1))).otherwise(F.when(k == "GT", F.split(v, "/")).otherwise(F.split(v, ",")))),
    )


def parse_generator(line: Column) -> Column:
    """Parameters of a ``##vcfGenerator=<k=<v>,...>`` line."""
    body = F.regexp_extract(line, r"^##vcfGenerator=<(.*)>$", 1)
    return F.str_to_map(F.regexp_replace(F.regexp_replace(body, r">$", ""), r">,", "\x01"), F.lit("\x01"), F.lit("=<"))


def meta_id(line: Column) -> Column:
    return F.regexp_extract(line, r"ID=([^,>]*)", 1)


def meta_key(line: Column) -> Column:
    return F.regexp_extract(line, r"^##([^=]*)=", 1)


def derived_sample(line: Column) -> Column:
    return F.regexp_extract(line, r"Derived=([^,>]*)", 1)


#: Fixed value: a sample's barcode inside a file name.
BARCODE = r"TCGA-[0-9A-Za-z]{2}-[0-9A-Za-z]{4}-[0-9A-Za-z-]*"


def barcode(path: Column) -> Column:
    """A TCGA barcode inside a file name."""
    return F.regexp_extract(path, BARCODE, 0)


def parse_effects(effects: Column) -> Column:
    """SnpEff effects -> (effect, gene, biotype): parts 5 and 6 inside the brackets."""
    inside = lambda e: F.split(F.regexp_extract(e, r"\((.*)\)", 1), r"\|")
    return F.transform(effects, lambda e: F.struct(F.regexp_extract(e, r"^([^(]*)", 1).alias("effect"), F.coalesce(F.get(inside(e), 5), F.lit("")).alias("gene"), F.coalesce(F.get(inside(e), 6), F.lit("")).alias("biotype")))


def flag(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(bit) != 0


def psl_score(matches: Column, repeats: Column, mismatches: Column, q_inserts: Column, t_inserts: Column) -> Column:
    return matches + repeats - mismatches - q_inserts - t_inserts


def tissue_codes(names: Column, codes: Column) -> Column:
    """Comma list of tissue names -> comma list of codes, by a map; unknown names stay."""
    return F.array_join(F.transform(F.split(names, ","), lambda n: F.coalesce(codes[F.trim(n)], F.trim(n))), ",")


def pack_flags(flags: list[tuple[str, Column]]) -> Column:
    """(letter, yes/no) columns -> "AY,NN,..."."""
    return F.concat_ws(",", *[F.concat(F.lit(letter), F.when(c, "Y").otherwise("N")) for letter, c in flags])
