"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (a, b); the root is the smallest node reachable.

    Each turn hangs every node below its smallest neighbour, follows these hangings
    to their ends and carries on with the links between the ends, of which there
    are at most half as many. Minima are taken before rows are dealt out, so a
    node with very many links is no hot key. Nothing is collected.
    """
    pairs = stage(_distinct(links, F.col("a"), F.col("b")), "links")
    labels = None
    while labels is None or not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hung = stage(both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")
        ), "roots")
        while True:
            upper = hung.select(F.col("node").alias("_node"), F.col("root").alias("_upper"))
            hung = stage(
                hung.join(upper, F.col("root") == F.col("_node")).select(
                    "node", F.col("_upper").alias("root"), (F.col("root") != F.col("_upper")).alias("_moved")
                ), "roots",
            )
            if hung.filter("_moved").isEmpty():
                break
            hung = hung.drop("_moved")
        hung = hung.drop("_moved")
        if labels is None:
            labels = hung
        else:
            upper = hung.select(F.col("node").alias("_node"), F.col("root").alias("_upper"))
            labels = stage(labels.join(upper, F.col("root") == F.col("_node"), "left").select(
                "node", F.coalesce("_upper", "root").alias("root")
            ), "labels")
        ends = hung.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        moved = pairs.join(ends, F.col("a") == F.col("_node")).select(F.col("_root").alias("a"), "b")
        moved = moved.join(ends, F.col("b") == F.col("_node")).select("a", F.col("_root").alias("b"))
        pairs = stage(_distinct(moved, F.col("a"), F.col("b")), "links")
    return labels


def _distinct(links: DataFrame, a, b) -> DataFrame:
    return links.filter(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
