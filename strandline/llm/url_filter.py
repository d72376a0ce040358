"""URL allow/block rules: a trie over reversed host labels, then path segments; the longest match wins."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules that may be broadcast as a trie; a longer list is joined on its (host, path) keys instead.
TRIE_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ADDED = ("host", "path", "rule", "verdict")

#: The query's rules (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where the url is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    return (
        F.coalesce(F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER), F.lit("")),
        F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit("")),
    )


class Trie:
    """Nodes are dicts: host labels from the top-level domain down, then path segments under the key "/"."""

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for host, path, verdict in rules:
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            node = node.setdefault("/", {})
            *whole, last = path.split("/")
            for segment in whole:
                node = node.setdefault(("s", segment), {})
            # what follows the last slash may be the beginning of a longer segment
            node = node.setdefault(("p", last), {})
            if "rule" not in node or verdict > node["rule"][1]:
                node["rule"] = (host + path, verdict)

    def look_up(self, host: str, path: str) -> tuple[str, str] | None:
        node, tops = self.root, []
        if "/" in node:
            tops.append(node["/"])
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if "/" in node:
                tops.append(node["/"])
        segments = path.split("/")
        for top in reversed(tops):  # the deepest host that has a fitting path
            best, node = None, top
            for k, segment in enumerate(segments):
                starts = [(len(key[1]), key, child) for key, child in node.items() if key[0] == "p" and segment.startswith(key[1])] if len(node) <= 8 else [(n, key, node[key]) for n in range(len(segment) + 1) if (key := ("p", segment[:n])) in node]
                for _, _, child in sorted(starts, key=lambda x: x[0]):
                    best = child["rule"]
                node = node.get(("s", segment)) if k < len(segments) - 1 else None
                if node is None:
                    break
            if best:
                return best
        return None


def judge(pages: DataFrame, rules: DataFrame | list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict (those names are replaced where the input has them).

    A rule (host, path, verdict) fits its host and all subdomains if the url's path starts with the rule's
    path; the longest host wins, then the longest path; of equal rules "block" wins. Null or malformed urls,
    and urls that no rule fits, get a null rule and the default verdict. Rows, repeated ones too, and all other columns are
    kept one for one; urls of any length are judged whole.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(f"`{url_col}`"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ADDED]
    rows = pages.select(*kept, host.alias("host"), path.alias("path"))
    if isinstance(rules, DataFrame):
        rules = rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        few = rules.limit(TRIE_RULES + 1).count() <= TRIE_RULES
        return by_trie(rows, [tuple(r) for r in rules.collect()], default) if few else by_join(rows, rules, default)
    return by_trie(rows, rules, default) if len(rules) <= TRIE_RULES else by_join(rows, spark.createDataFrame(rules, "host string, path string, verdict string"), default)


def by_trie(rows: DataFrame, rules: list[tuple[str, str, str]], default: str) -> DataFrame:
    trie = rows.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf(T.StructType().add("rule", "string").add("verdict", "string"))
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        look_up = trie.value.look_up
        found = [look_up(h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    name = unused(rows, "m")
    return rows.withColumn(name, match("host", "path")).select(*named(rows), f"{name}.rule", f"{name}.verdict")


def unused(rows: DataFrame, name: str) -> str:
    """A column name that rows don't have."""
    while name.lower() in {c.lower() for c in rows.columns}:
        name += "_"
    return name


def named(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]


def by_join(rows: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """For rule lists beyond the broadcast bound: the host suffixes and whole path segments of each distinct (host, path), no deeper than the deepest rule, meet the rules by a hash and are then compared."""
    head = F.when(F.instr("path", "/") > 0, F.regexp_extract("path", r"(?s)\A.*/", 0)).otherwise("")
    r = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    r = r.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict", F.xxhash64("host", head).alias("key"))
    slashes = lambda c: F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit("")))
    most = r.agg(F.max(F.size(F.split("rule_host", r"\."))).alias("labels"), F.max(slashes(F.col("rule_path"))).alias("slashes")).first()
    sites = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most.labels or 1))), lambda k: F.array_join(F.slice(labels, -k, k), "."))
    keyed = sites.select("host", "path", F.explode(F.array_distinct(F.concat(hosts, F.array(F.lit(""))))).alias("h"))
    deep = F.sequence(F.lit(0), F.least(slashes(F.col("path")), F.lit(most.slashes or 0)))
    heads = F.transform(deep, lambda k: F.when(k > 0, F.concat(F.array_join(F.slice(F.split("path", "/"), F.lit(1), k), "/"), F.lit("/"))).otherwise(""))
    keyed = keyed.select("host", "path", "h", F.explode(heads).alias("p")).select("host", "path", F.xxhash64("h", "p").alias("key"))
    fits = ((F.col("rule_host") == "") | (F.col("host") == F.col("rule_host")) | F.endswith("host", F.concat(F.lit("."), "rule_host"))) & F.startswith("path", F.col("rule_path"))
    order = F.struct(F.length("rule_host").alias("h"), F.length("rule_path").alias("p"), F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    name = unused(rows, "m")
    best = keyed.join(r, "key").where(fits).groupBy("host", "path").agg(F.max(order).alias(name))
    joined = rows.join(best, ["host", "path"], "left")
    return joined.select(*named(rows), F.col(f"{name}.rule").alias("rule"), F.coalesce(f"{name}.verdict", F.lit(default)).alias("verdict"))
