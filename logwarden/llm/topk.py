"""Exact top-k search by inner product, with a pivot table.

For whole-number vectors the inner product is (|q|^2 + |x|^2 - d(q, x)^2) / 2, and
any pivot p gives d(q, x) >= |d(q, p) - d(x, p)|. The largest of these lower bounds
over all pivots gives an upper bound of the score. Candidates are
evaluated by falling upper bound until the next bound is below the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

#: Sums of products of whole numbers up to here are exact in double precision.
_EXACT = 2.0**52


@dataclass(frozen=True)
class TopKConfig:
    """``pivots`` rows, those of smallest hash, are taken as pivots; any choice is exact."""

    k: int = 20
    scale: int = 64
    pivots: int = 16
    query_block: int = 1024
    block: int = 8192
    step: int = 256


def usable(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def top_k(rows: DataFrame, queries: Column, cfg: TopKConfig | None = None) -> DataFrame:
    """For each row of ``rows`` (vec_id, embedding) where ``queries`` holds: its best k others.

    Returns query_id, rank, vec_id, score: integer inner products of floor(scale * x),
    ties to the smaller vec_id, every row but those with the query's own id; fewer
    than k if there are fewer. Vectors that are null or hold null or non-finite
    components, and rows without an id, take no part; a shorter vector counts as 0 in what it lacks. Rows that
    share a vec_id are candidates each, and one query if equal. An empty table gives no rows.

    Rows are dealt to blocks by falling length, so early blocks hold high scores, and
    queries to blocks by hash; each pair of blocks is one unit of work. The k-th
    best score within the first block is each query's floor in all others.
    """
    cfg = cfg or TopKConfig()
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * cfg.scale).cast("double"))
    kept = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long"), whole.alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    kept = stage(kept.withColumn("square", square), "vectors")
    shape = kept.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = shape.n, max(1, shape.width or 0)
    pivots = kept.select("vec_id", "v").orderBy(F.xxhash64("v"), "vec_id").limit(cfg.pivots).collect()
    table = np.array([_padded(r.v, width) for r in pivots]).reshape(len(pivots), width)

    blocks = max(1, -(-n // cfg.block))
    edges = kept.agg(
        F.percentile_approx("square", [i / blocks for i in range(1, blocks)] or [1.0], 10_000)
    ).first()[0] or []
    above = F.lit(0)
    if blocks > 1:
        above = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e >= F.col("square")))
    # equal lengths would share a block, so long ties are cut by hash
    crowd = kept.groupBy(above.alias("_level")).agg(F.count("*").alias("_rows"))
    split = F.greatest(F.lit(1), F.ceil(F.col("_rows") / cfg.block)).cast("int")
    crowd = {r._level: r._split for r in crowd.withColumn("_split", split).collect()}
    starts, at = {}, 0
    for level in sorted(crowd):
        starts[level], at = at, at + crowd[level]
    deal = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair] or [F.lit(0), F.lit(0)])
    cuts = F.create_map(*[F.lit(x) for pair in crowd.items() for x in pair] or [F.lit(0), F.lit(1)])
    block = (deal[above] + F.pmod(F.xxhash64("vec_id"), cuts[above])).cast("int")

    asked = kept.filter("is_query").select("vec_id", "v").distinct()
    asked = stage(asked, "queries")
    query_blocks = max(1, -(-asked.count() // cfg.query_block))
    dealt = stage(kept.select(block.alias("block"), "vec_id", "v", "square"), "blocks")
    asked = asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(query_blocks)).cast("int"))
    no_floor = asked.withColumn("floor", F.lit(float("-inf")))

    first = _search(dealt.filter("block = 0"), no_floor, [0], query_blocks, table, width, cfg)
    first = stage(first, "first-block")
    if at <= 1:
        return _best(first, cfg)
    floors = _best(first, cfg).filter(F.col("rank") == cfg.k).select(
        F.col("query_id").alias("_query_id"), F.col("score").cast("double").alias("floor")
    )
    floored = asked.join(floors, F.col("vec_id") == F.col("_query_id"), "left").select(
        "vec_id", "v", "query_block", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    )
    rest = _search(
        dealt.filter("block > 0"), stage(floored, "floors"), list(range(1, at)), query_blocks, table, width, cfg
    )
    return _best(first.unionByName(rest), cfg)


def _best(found: DataFrame, cfg: TopKConfig) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cfg.k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _search(rows, asked, blocks, query_blocks, table, width, cfg) -> DataFrame:
    """(query_id, vec_id, score) of each query's best in each of ``blocks``, from its floor on.

    Rows go to every query block and queries to every block, so a unit of work
    gets one block of each.
    """
    each_query = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")
    each_block = F.explode(F.array(*[F.lit(b) for b in blocks])).alias("block")
    left = rows.select("block", each_query, "vec_id", "v")
    right = asked.select(each_block, "query_block", "vec_id", "v", "floor")

    def unit(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [*_unit(candidates, queries, table, width, cfg)]
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            {"query_id": [], "vec_id": [], "score": []}, dtype="int64"
        )

    keys = ["block", "query_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        unit, "query_id long, vec_id long, score long"
    )


def _padded(vector, width: int) -> np.ndarray:
    out = np.zeros(width)
    out[: len(vector)] = vector
    return out


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    if len(vectors) and all(len(v) == width for v in vectors):
        return np.stack(vectors.to_numpy())
    return np.array([_padded(v, width) for v in vectors]).reshape(len(vectors), width)


def _unit(candidates, queries, table, width, cfg) -> Iterator[pd.DataFrame]:
    if not len(candidates) or not len(queries):
        return
    candidates = candidates.sort_values("vec_id", ignore_index=True)
    ids, x = candidates["vec_id"].to_numpy("int64"), _matrix(candidates["v"], width)
    q = _matrix(queries["v"], width)
    largest = max(1.0, np.abs(x).max(), np.abs(q).max(), np.abs(table).max(initial=0))
    if width * largest * largest > _EXACT:
        yield from _exact_integers(ids, x, queries, q, cfg)
        return
    x_square, q_square = (x * x).sum(axis=1), (q * q).sum(axis=1)
    to_pivot = np.ascontiguousarray(_distances(x, x_square, table).T)
    q_to_pivot = _distances(q, q_square, table)
    for i, (query_id, floor) in enumerate(zip(queries["vec_id"], queries["floor"], strict=True)):
        near = np.abs(to_pivot - q_to_pivot[i][:, None]).max(axis=0, initial=0)
        # a little slack for the rounding of roots; evaluated scores are exact
        bound = (q_square[i] + x_square - near * near) / 2 * (1 + 1e-9) + 1
        bound[ids == query_id] = -np.inf
        yield _evaluate(int(query_id), floor, q[i], ids, x, bound, cfg)


def _distances(x: np.ndarray, square: np.ndarray, table: np.ndarray) -> np.ndarray:
    pivot_square = (table * table).sum(axis=1)
    return np.sqrt(np.maximum(square[:, None] + pivot_square - 2 * (x @ table.T), 0))


def _evaluate(query_id, floor, q, ids, x, bound, cfg) -> pd.DataFrame:
    """Candidates by falling bound, in growing steps, until none left can reach the k-th best."""
    left = np.flatnonzero(bound >= max(floor, np.finfo("float64").min))
    left = left[np.argsort(-bound[left], kind="stable")]
    scores, chosen = np.zeros(0), np.zeros(0, "int64")
    at, step = 0, cfg.step
    while at < len(left):
        if len(scores) >= cfg.k:
            left = left[: np.searchsorted(-bound[left], -scores[cfg.k - 1], "right")]
        some = left[at : at + step]
        # a step of much of the block is quicker as one product
        found = x[some] @ q if 4 * len(some) < len(x) else (x @ q)[some]
        if len(scores) >= cfg.k:
            some, found = some[found >= scores[cfg.k - 1]], found[found >= scores[cfg.k - 1]]
        scores, chosen = np.append(scores, found), np.append(chosen, some)
        best = np.lexsort((ids[chosen], -scores))[: cfg.k]
        scores, chosen = scores[best], chosen[best]
        at, step = at + step, 8 * step
    keep = scores >= floor
    return pd.DataFrame({
        "query_id": query_id, "vec_id": ids[chosen[keep]], "score": scores[keep].astype("int64")
    })


def _exact_integers(ids, x, queries, q, cfg) -> Iterator[pd.DataFrame]:
    """For components too large for exact doubles: Python integers; scores are held to bigint's range."""
    whole = [[int(a) for a in row] for row in x]
    for row, query_id in zip(q, queries["vec_id"], strict=True):
        row = [int(a) for a in row]
        found = [
            (-sum(a * b for a, b in zip(row, other, strict=True)), i)
            for i, other in zip(ids.tolist(), whole, strict=True) if i != query_id
        ]
        best = sorted(found)[: cfg.k]
        yield pd.DataFrame({
            "query_id": int(query_id), "vec_id": [i for _, i in best],
            "score": [max(-(2**63), min(2**63 - 1, -s)) for s, _ in best],
        }, dtype="int64")
