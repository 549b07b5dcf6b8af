"""URL filtering by a trie over reversed host labels and path segments."""

from __future__ import annotations

import string
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rule tables up to this many rows are made into a broadcast trie.
TRIE_RULES = 1_000_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``? #`` or the end; empty without ``://``."""
    rest = _after_scheme(url)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


class HostTrie:
    """Rules as a trie: host labels from the right, then path segments from the left.

    The last segment of a rule's path may be the beginning of a url's segment. Of
    the rules that fit a url the longest wins: the one with most host labels,
    then the one with the longest path. Between equal rules ``block`` wins.
    """

    def __init__(self, rules: Iterable[tuple[str, str, str]]):
        self.root: dict = {}
        for verdict, host, path in rules:
            if path and not path.startswith("/"):
                raise ValueError(f"a rule's path starts with /: {path}")
            host = host.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault("hosts", {}).setdefault(label, {})
            if path:
                node = node.setdefault("paths", {})
                *whole, last = path[1:].split("/")
                for segment in whole:
                    node = node.setdefault("segments", {}).setdefault(segment, {})
            else:
                last = None
            ends = node.setdefault("ends", {})
            if last not in ends or verdict == "block":
                ends[last] = (host + path, verdict)
            node["lengths"] = sorted({len(e) for e in ends if e is not None}, reverse=True)

    def judge(self, host: str, path: str) -> tuple[str, str] | None:
        """``(rule, verdict)`` of the longest rule that fits, or None."""
        segments = path[1:].split("/") if path.startswith("/") else []
        best, node = self._on_path(self.root, segments), self.root
        for label in reversed(host.split(".")):
            node = node.get("hosts", {}).get(label)
            if node is None:
                break
            best = self._on_path(node, segments) or best
        return best

    @staticmethod
    def _on_path(node: dict, segments: list[str]):
        best, node = node.get("ends", {}).get(None), node.get("paths")
        for segment in segments:
            if node is None:
                break
            for length in node.get("lengths", ()):
                if (end := segment[:length]) in node["ends"]:
                    best = node["ends"][end]
                    break
            node = node.get("segments", {}).get(segment)
        return best


def judge_urls(
    pages: DataFrame, rules, id_column: str = "page_id", default: str = "allow",
    trie_rules: int = TRIE_RULES,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule and verdict of its ``url``.

    ``rules`` is a list of ``(verdict, host, path)`` or a DataFrame with these
    columns. A table is counted first: up to ``trie_rules`` rows it is broadcast as
    a trie, a larger one is joined on every host suffix, with equal results. A
    rule fits its host and all subdomains if the url's path starts with the
    rule's path. Where none fits, ``rule`` is null and ``verdict`` the default.
    Null urls and urls without ``://`` have an empty host and path. Repeated rows
    are judged each; a host of only empty labels is a host like any other.
    """
    spark = pages.sparkSession
    split = pages.select(
        F.col(id_column), F.col("url"), host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
    ).fillna("", ["host", "path"])
    if isinstance(rules, DataFrame):
        rules = rules.select("verdict", F.coalesce("host", F.lit("")).alias("host"),
                             F.coalesce("path", F.lit("")).alias("path"))
        if len(some := rules.limit(trie_rules + 1).collect()) > trie_rules:
            return _judge_by_join(split, rules, id_column, default)
        rules = [tuple(r) for r in some]
    trie = spark.sparkContext.broadcast(HostTrie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judged(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        found = [trie.value.judge(h, p) or (None, default) for h, p in zip(host, path, strict=True)]
        return pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return split.select(id_column, "host", "path", judged("host", "path").alias("_found")).select(
        id_column, "host", "path", "_found.rule", "_found.verdict"
    )


def _judge_by_join(split: DataFrame, rules: DataFrame, id_column: str, default: str) -> DataFrame:
    """The same for rule tables too large for one machine.

    Distinct (host, path) pairs are joined to the rules on each of the host's
    suffixes; AQE splits a suffix that many share.
    """
    labels = F.split("host", "[.]")
    suffixes = F.transform(
        F.sequence(F.lit(0), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."),
    )
    tried = split.select("host", "path").distinct().select(
        "host", "path", F.explode(F.array_distinct(suffixes)).alias("_suffix")
    )
    ranked = rules.select(
        F.translate("host", string.ascii_uppercase, string.ascii_lowercase).alias("_suffix"),
        F.col("path").alias("_start"), F.col("verdict").alias("_verdict"),
    )
    depth = F.when(F.col("_suffix") == "", 0).otherwise(F.size(F.split("_suffix", "[.]")))
    best = (
        tried.join(ranked, "_suffix")
        .filter(F.col("path").startswith(F.col("_start")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(
            depth.alias("depth"), F.length("_start").alias("length"),
            (F.col("_verdict") == "block").alias("block"),
            F.concat("_suffix", "_start").alias("rule"), F.col("_verdict").alias("verdict"),
        )).alias("_best"))
        .withColumnsRenamed({"host": "_host", "path": "_path"})
    )
    same = (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path"))
    return split.join(best, same, "left").select(
        id_column, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
