"""Isolation forest: each tree grown in its own task, scored in Arrow batches.

All random choices are digits of MD5 sums of (seed, tree) and (seed, tree, node), and
nodes are numbered as in a heap. So a forest depends on the rows and the seed only, and can
be grown again, tree by tree or level by level, by any engine.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DetectorConfig

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, "
    "left int, right int, depth int, size int"
)
_EULER = 0.5772156649015329
#: Rows are drawn by (a * key + b) modulo this prime, which keeps products in 64 bits.
_PRIME = 2**31 - 1
#: Groups that the trees of one of many forests are grown in.
BUNDLES = 8


def _digits(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def tree_factors(tree: int, seed: int) -> tuple[int, int]:
    """The ``a`` and ``b`` that deal a tree's rows."""
    digits = _digits(f"{seed}:{tree}")
    return 1 + int(digits[:15], 16) % (_PRIME - 1), int(digits[15:30], 16) % _PRIME


def node_draw(tree: int, node: int, seed: int) -> tuple[int, float]:
    """A number to choose the feature by, and where in [0, 1) of its range to split."""
    digits = _digits(f"{seed}:{tree}:{node}")
    return int(digits[:7], 16), int(digits[7:20], 16) / 2.0**52


def average_path(size: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a tree of ``size`` rows."""
    size = np.asarray(size, dtype=float)
    safe = np.maximum(size, 3.0)
    value = 2.0 * (np.log(safe - 1.0) + _EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, value))


def _room(n_rows, cfg: DetectorConfig) -> tuple:
    """Rows wanted for a tree, and the cut below which draws leave room for them."""
    if isinstance(n_rows, Column):
        wanted = F.least(F.lit(cfg.tree_sample), n_rows)
        room = wanted + 10.0 * F.sqrt(wanted) + 10.0
        return wanted, F.ceil(F.lit(float(_PRIME)) * F.least(F.lit(1.0), room / F.greatest(n_rows, F.lit(1))))
    wanted = min(cfg.tree_sample, n_rows)
    room = wanted + 10.0 * math.sqrt(wanted) + 10.0
    return wanted, math.ceil(_PRIME * min(1.0, room / max(n_rows, 1)))


def tree_samples(
    scaled: DataFrame, keys: list[str], n_rows: int | Column, cfg: DetectorConfig, by: tuple[str, ...] = ()
) -> DataFrame:
    """``(tree_id, draw, x)``: ``min(tree_sample, n)`` rows per tree, without replacement.

    A row joins a tree when its draw for that tree is small. The cut leaves room
    ten deviations above the wanted size, so the ranking that picks the exact
    number sees a few hundred rows per tree whatever the size of the table. Rows of
    different ``by`` are of different forests; ``n_rows`` is then a column, and so is ``wanted`` of the result.
    """
    wanted, cut = _room(n_rows, cfg)
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *keys).cast("binary")), 1, 15), 16, 10).cast("long")
    factors = [tree_factors(t, cfg.seed) for t in range(cfg.trees)]
    a, b = (F.lit(list(column)).cast("array<long>") for column in zip(*factors, strict=True))
    draws = F.transform(
        F.arrays_zip(a.alias("a"), b.alias("b")),
        lambda f, t: F.struct(
            t.alias("tree_id"), ((F.col("number") * f["a"] + f["b"]) % F.lit(_PRIME)).alias("draw")
        ),
    )
    picked = scaled.select(
        (number % F.lit(_PRIME)).alias("number"), *by, *keys, "x", F.lit(wanted).alias("wanted"), F.lit(cut).alias("cut")
    ).select(*by, *keys, "x", "wanted", F.inline(F.filter(draws, lambda d: d["draw"] < F.col("cut"))))
    # a fixed number of partitions: the rows are few, but growing the trees is the
    # work, so they must not be coalesced into one task
    tasks = min(cfg.trees, scaled.sparkSession.sparkContext.defaultParallelism)
    if by:
        picked = picked.withColumn("bundle", F.pmod("tree_id", F.lit(BUNDLES))).repartition(4 * tasks, *by, "bundle")
        by = (*by, "bundle")
    else:
        picked = picked.repartition(tasks, "tree_id")
    order = W.partitionBy(*by, "tree_id").orderBy("draw", *keys)
    return (
        picked.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= F.col("wanted"))
        .select(*by, *(["wanted"] if by else []), "tree_id", "rank", "x")
    )


def _grow(samples: pd.DataFrame, seed: int, max_depth: int) -> pd.DataFrame:
    """Trees of the samples: node n has the children 2n (up to the threshold) and 2n + 1.

    All trees grow by a level at a time, so a node costs no numpy calls of its own.
    """
    tree, x = samples["tree_id"].to_numpy(), np.vstack(samples["x"].to_numpy())
    node = np.ones(len(x), dtype=np.int64)
    levels = []
    for depth in range(max_depth + 1):
        order = np.lexsort((node, tree))
        tree, node, x = tree[order], node[order], x[order]
        first = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])])
        size = np.diff(np.r_[first, len(x)])
        low, high = np.minimum.reduceat(x, first, axis=0), np.maximum.reduceat(x, first, axis=0)
        splittable = high > low
        choices = splittable.sum(axis=1)
        grows = (choices > 0) & (depth < max_depth)
        trees, nodes = tree[first], node[first]
        feature, threshold = np.full(len(first), -1), np.zeros(len(first))
        if grows.any():
            draws = [node_draw(t, n, seed) for t, n in zip(trees[grows].tolist(), nodes[grows].tolist())]
            choice, place = np.array([d[0] for d in draws]), np.array([d[1] for d in draws])
            wanted = choice % choices[grows] + 1
            at = np.argmax(splittable[grows].cumsum(axis=1) == wanted[:, None], axis=1)
            least, most = low[grows, at], high[grows, at]
            cut = least + (most - least) * place
            feature[grows], threshold[grows] = at, np.where(cut >= most, least, cut)
        left = np.where(grows, 2 * nodes, -1)
        right = np.where(grows, 2 * nodes + 1, -1)
        levels.append((trees, nodes, feature, threshold, left, right, np.full(len(first), depth), size))
        goes_on = np.repeat(grows, size)
        if not goes_on.any():
            break
        of = np.repeat(np.arange(len(first)), size)[goes_on]
        tree, x = tree[goes_on], x[goes_on]
        node = np.where(x[np.arange(len(x)), feature[of]] <= threshold[of], left[of], right[of])
    names = [part.split()[0] for part in NODE_SCHEMA.split(", ")]
    columns = [np.concatenate(column) for column in zip(*levels, strict=True)]
    return pd.DataFrame(dict(zip(names, columns, strict=True))).sort_values(["tree_id", "node_id"], ignore_index=True)


def fit_forest(scaled: DataFrame, keys: list[str], n_rows: int, cfg: DetectorConfig) -> DataFrame:
    """The node table: at most ``trees * (2 * tree_sample - 1)`` rows."""
    samples = tree_samples(scaled, keys, n_rows, cfg)
    max_depth = math.ceil(math.log2(max(min(cfg.tree_sample, n_rows), 2)))
    seed = cfg.seed
    return samples.groupBy("tree_id").applyInPandas(
        lambda pdf: _grow(pdf, seed, max_depth), NODE_SCHEMA
    )


def fit_forests(scaled: DataFrame, keys: list[str], by: str, n_rows: Column, cfg: DetectorConfig) -> DataFrame:
    """The node tables of many forests, one for each ``by`` (an int), grown from rows of that key only."""
    samples = tree_samples(scaled, keys, n_rows, cfg, (by,))
    seed = cfg.seed

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        max_depth = math.ceil(math.log2(max(int(pdf["wanted"].iloc[0]), 2)))
        return _grow(pdf, seed, max_depth).assign(**{by: key[0]})

    return samples.groupBy(by, "bundle").applyInPandas(grow, f"{NODE_SCHEMA}, {by} int")


def _packed(table: pd.DataFrame, sample_size: int) -> dict:
    """A node table in order of tree and node as arrays."""
    starts = table.groupby("tree_id")["node_id"].size().cumsum().shift(fill_value=0)
    key = table["tree_id"].to_numpy(np.int64) << 32
    known = key + table["node_id"].to_numpy(np.int64)  # rising, as the table is ordered
    feature = table["feature"].to_numpy(dtype=np.int64)

    def child(side: str) -> np.ndarray:
        at = np.searchsorted(known, key + table[side].to_numpy(np.int64))
        return np.where(feature < 0, -1, at).astype(np.int64)

    return {
        "roots": starts.to_numpy(dtype=np.int64),
        "feature": feature,
        "threshold": table["threshold"].to_numpy(),
        "left": child("left"),
        "right": child("right"),
        "path": table["depth"].to_numpy() + average_path(table["size"].to_numpy()),
        "norm": float(average_path(np.array([sample_size]))[0]),
        "depth": int(table["depth"].max()),
    }


def _raw_scores(vectors: pd.Series, forest: dict) -> np.ndarray:
    x = np.vstack(vectors.to_numpy())
    rows = np.arange(len(x))
    total = np.zeros(len(x))
    for root in forest["roots"]:
        at = np.full(len(x), root)
        for _ in range(forest["depth"]):
            feature = forest["feature"][at]
            value = x[rows, np.maximum(feature, 0)]
            below = value <= forest["threshold"][at]
            step = np.where(below, forest["left"][at], forest["right"][at])
            at = np.where(feature < 0, at, step)
        total += forest["path"][at]
    mean_path = total / len(forest["roots"])
    return 0.5 - np.power(2.0, -mean_path / max(forest["norm"], 1e-12))


def score_forests(points: DataFrame, nodes: DataFrame, by: str) -> DataFrame:
    """``(by, rid, if_raw)`` of points ``(by, rid, x, sample)``, each by the forest of its key.

    A key's points and nodes meet in one task, so both have to be of bounded size.
    """

    def score(key: tuple, asked: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if len(asked) == 0 or len(table) == 0:
            return pd.DataFrame({by: pd.Series(dtype="int32"), "rid": pd.Series(dtype=object), "if_raw": pd.Series(dtype=float)})
        table = table.sort_values(["tree_id", "node_id"], ignore_index=True)
        raw = _raw_scores(asked["x"], _packed(table, int(asked["sample"].iloc[0])))
        return pd.DataFrame({by: key[0], "rid": asked["rid"].to_numpy(), "if_raw": raw})

    points = points.select(by, "rid", "x", "sample")
    return points.groupBy(by).cogroup(nodes.groupBy(by)).applyInPandas(score, f"{by} int, rid string, if_raw double")


def forest_scorer(nodes: DataFrame, sample_size: int):
    """A column function: scaled vector -> 0.5 - 2 ** (-mean path / c(sample)).

    Lower is stranger. The node table has a fixed upper size, so it is collected
    once and shipped to the executors as a broadcast variable.
    """
    table = nodes.orderBy("tree_id", "node_id").toPandas()
    shared = nodes.sparkSession.sparkContext.broadcast(_packed(table, sample_size))

    @F.pandas_udf("double")
    def raw_score(vectors: pd.Series) -> pd.Series:
        return pd.Series(_raw_scores(vectors, shared.value) if len(vectors) else [], dtype=float)

    def column(vector: Column) -> Column:
        return raw_score(vector)

    return column
