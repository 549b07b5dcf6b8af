"""Exact k-nearest-neighbour join and local-outlier-factor scores.

Equal vectors are folded into one weighted point first, so a crowd of identical
windows costs one row. The reference is cut into cells of bounded size along its main axes; a
query visits its own cell, and then only the cells whose box can still hold a nearer
point. Inside a cell it meets only leaves of nearby points in the same way, so few pairs
are built that cannot be nearest and none is dropped that can.
"""

from __future__ import annotations

import math
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

CHUNK_ROWS = 20_000
#: Points of a cell, sampled points that its cuts are fitted on, and points of a leaf inside a probe.
CELL_ROWS, SAMPLE_ROWS, LEAF_ROWS = 16_384, 64, 64
#: Main axes that boxes have ends on; the others tell little.
AXES = 12
#: Leaves in which a row finds its first bound.
HOME_LEAVES = 8
_DIGITS = 9
_SLACK = 1e-6
#: More than rounding can move two distances apart.
_ROUNDING = 4.0 * 10.0**-_DIGITS
_LRD_EPS = 1e-10
_PAIR = (
    "qid string, rid string, distance double, weight bigint, k_dist double, lrd double"
)


def weighted_points(scaled: DataFrame, key: str = "row_key", by: tuple[str, ...] = ()) -> DataFrame:
    """``(rid, x, weight)``: one row per distinct vector (of each ``by``)."""
    return scaled.groupBy(*by, "x").agg(F.min(key).alias("rid"), F.count("*").alias("weight"))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j][:, None] - b[:, j][None, :]
        total += gap * gap
    return np.round(np.sqrt(total), _DIGITS)


def _axes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and main axes of the finite ones of the rows; the first axis has the largest variance."""
    x = x[np.isfinite(x).all(axis=1)]
    if len(x) < 2:
        return np.zeros(x.shape[1]), np.eye(x.shape[1])
    centre = x.mean(axis=0)
    _, turned = np.linalg.eigh((x - centre).T @ (x - centre))
    return centre, np.ascontiguousarray(turned[:, ::-1][:, :AXES])


def _halved(y: np.ndarray, parts: int) -> list[np.ndarray]:
    """Row numbers of ``parts`` (a power of two) groups, cut at the median of the axis that varies most."""
    groups = [np.arange(len(y))]
    while len(groups) < parts:
        cut = []
        for rows in groups:
            order = rows[np.argsort(y[rows, _widest(y[rows])], kind="stable")]
            cut += [order[: len(order) // 2], order[len(order) // 2 :]]
        groups = cut
    return groups


def _widest(y: np.ndarray) -> int:
    return int(np.argmax(np.nan_to_num(np.ptp(y, axis=0) if len(y) < 8 else y.std(axis=0))))


def _box(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the rows' values on each axis, NaN left out."""
    return np.fmin.reduce(y, axis=0), np.fmax.reduce(y, axis=0)


def _gaps(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``[box, row]``: no point of the box is nearer to the row, whatever rounding does."""
    total = np.zeros((len(low), len(y)))
    for j in range(y.shape[1]):
        at = y[:, j][None, :]
        gap = np.maximum(low[:, j][:, None] - at, at - high[:, j][:, None])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        total += gap
    np.sqrt(total, out=total)
    size = np.abs(y).max(axis=1)[None, :] + np.maximum(np.abs(low), np.abs(high)).max(axis=1)[:, None]
    return total - 1e-12 * size - _ROUNDING


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances by a matrix product, and the room for its error."""
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
    error = 1e-13 * (np.fmax.reduce(squares, axis=None) + 1.0)
    squares -= 2.0 * (a @ b.T)
    return squares, error


def _candidates(x: np.ndarray, reference: np.ndarray, reach: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all pairs that can be among a row's ``k`` nearest within its reach.

    The reference is cut into leaves of nearby points with a box around each on its main axes. A row
    is bounded by its k-th nearest in leaves about it, and then meets only leaves whose
    box its reach touches; so only few pairs need their exact distance.
    """
    centre, turn = _axes(reference)
    y, points = (x - centre) @ turn, (reference - centre) @ turn
    wanted = max(1, len(points) // max(LEAF_ROWS, 2 * k))
    leaves = _halved(points, 2 ** int(math.log2(wanted)))
    boxes = [_box(points[leaf]) for leaf in leaves]
    gaps = _gaps(y, np.array([low for low, _ in boxes]), np.array([high for _, high in boxes]))
    reach = reach.copy()
    # rows without a bound get one from the leaves about the nearest one, which follow each other
    home = np.where(np.isfinite(reach), -1, gaps.argmin(axis=0) // HOME_LEAVES)
    for i in np.unique(home[home >= 0]):
        rows, about = np.flatnonzero(home == i), np.concatenate(leaves[i * HOME_LEAVES : (i + 1) * HOME_LEAVES])
        if len(about) >= k:
            squares, error = _squares(x[rows], reference[about])
            kth = np.partition(squares, k - 1, axis=1)[:, k - 1]
            reach[rows] = np.fmin(reach[rows], np.sqrt(np.maximum(kth, 0.0) + error) + _ROUNDING)
    found = []
    for i, leaf in enumerate(leaves):
        rows = np.flatnonzero(gaps[i] <= reach)
        if len(rows):
            squares, error = _squares(x[rows], reference[leaf])
            row, col = np.nonzero(squares <= ((reach[rows] + _ROUNDING) ** 2 + error)[:, None])
            found.append((rows[row], leaf[col]))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, the squares added up in the order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        gap = a[:, j] - b[:, j]
        total += gap * gap
    return np.round(np.sqrt(total), _DIGITS)


def _nearest(queries: pd.DataFrame, reference: dict, k: int) -> pd.DataFrame:
    """The k nearest reference rows of each query, ties by rid (reference is rid-sorted)."""
    x = np.vstack(queries["x"].to_numpy())
    reach = queries["reach"].to_numpy() if "reach" in queries else np.full(len(x), np.inf)
    block = 5_000
    rows, cols, dists = [], [], []
    for at in range(0, len(x), block):
        part, limit = x[at : at + block], reach[at : at + block]
        row, col = _candidates(part, reference["x"], limit, k)
        d = _pair_distances(part[row], reference["x"][col])
        near = d <= limit[row]
        row, col, d = row[near], col[near], d[near]
        order = np.lexsort((col, d, row))
        row, col, d = row[order], col[order], d[order]
        first = np.searchsorted(row, np.arange(len(part)))
        keep = np.arange(len(row)) - first[row] < k
        rows.append(row[keep] + at)
        cols.append(col[keep])
        dists.append(d[keep])
    row, col = np.concatenate(rows), np.concatenate(cols)
    return pd.DataFrame(
        {
            "qid": queries["qid"].to_numpy()[row],
            "rid": reference["rid"][col],
            "distance": np.concatenate(dists),
            **{c: reference[c][col] for c in ("weight", "k_dist", "lrd")},
        }
    )


def _as_arrays(points: pd.DataFrame) -> dict:
    points = points.sort_values("rid")
    return {
        "x": np.vstack(points["x"].to_numpy()),
        **{c: points[c].to_numpy() for c in ("rid", "weight", "k_dist", "lrd")},
    }


def _empty() -> pd.DataFrame:
    kinds = {"string": "object", "double": "float64", "bigint": "int64"}
    parts = [part.split() for part in _PAIR.split(", ")]
    return pd.DataFrame({name: pd.Series(dtype=kinds[kind]) for name, kind in parts})


def take_nearest(pairs: DataFrame, k: int | Column) -> DataFrame:
    """Keep each query's nearest pairs up to a total weight of ``k``; adds ``share``."""
    order = W.partitionBy("qid").orderBy("distance", "rid")
    before = F.coalesce(
        F.sum("weight").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        pairs.withColumn("before", before)
        .filter(F.col("before") < k)
        .withColumn("share", F.least(F.col("weight"), F.lit(k) - F.col("before")))
        .drop("before")
    )


@dataclass
class _Cells:
    """A tree of cuts over the main axes: node n has the children 2n (up to its threshold) and 2n + 1."""

    centre: np.ndarray
    turn: np.ndarray
    depth: int
    axis: np.ndarray
    threshold: np.ndarray

    def turned(self, vectors: pd.Series) -> np.ndarray:
        return (np.vstack(vectors.to_numpy()) - self.centre) @ self.turn

    def of(self, y: np.ndarray) -> np.ndarray:
        node = np.ones(len(y), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + (y[np.arange(len(y)), self.axis[node]] > self.threshold[node])
        return node - 2**self.depth


def _cells(reference: DataFrame, n_rows: int, k: int) -> _Cells:
    """Cells of about ``CELL_ROWS`` points, fitted on SAMPLE_ROWS hash-chosen ones for each; every point gets a cell.

    Small tables have up to 64 cells, for the sake of all cores, but some times ``k`` points in each.
    """
    wanted = min(max(n_rows / CELL_ROWS, min(math.sqrt(n_rows), 64)), max(n_rows / (4 * k), 1))
    depth = int(math.log2(max(wanted, 1)))
    chosen = reference.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE_ROWS * 2**depth).select("x").collect()
    x = np.array([r.x for r in chosen], dtype=float)
    centre, turn = _axes(x) if len(x) else (np.zeros(1), np.eye(1))
    axis, threshold = np.zeros(2**depth, dtype=np.int64), np.zeros(2**depth)
    of = {1: (x - centre) @ turn} if depth else {}
    for node in range(1, 2**depth):
        y = of.pop(node)
        if len(y):
            axis[node] = _widest(y)
            threshold[node] = np.nanmedian(y[:, axis[node]])
        right = y[:, axis[node]] > threshold[node]
        if 2 * node < 2**depth:
            of |= {2 * node: y[~right], 2 * node + 1: y[right]}
    return _Cells(centre, turn, depth, axis, threshold)


def _with_cell(points: DataFrame, cells: _Cells) -> DataFrame:
    shared = points.sparkSession.sparkContext.broadcast(astuple(cells))

    @F.pandas_udf("int")
    def cell_of(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype="int32")
        cells = _Cells(*shared.value)
        return pd.Series(cells.of(cells.turned(vectors)).astype("int32"))

    return points.withColumn("cell", cell_of("x"))


def _cell_boxes(reference: DataFrame, cells: _Cells) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's ends on the main axes; an empty cell's are infinitely far."""
    shared = reference.sparkSession.sparkContext.broadcast(astuple(cells))

    def ends(batches):
        cells = _Cells(*shared.value)
        for batch in batches:
            if len(batch) == 0:
                continue
            y, cell = cells.turned(batch["x"]), batch["cell"].to_numpy()
            for c in np.unique(cell):
                low, high = _box(y[cell == c])
                yield pd.DataFrame({"cell": c, "axis": np.arange(len(low)), "low": low, "high": high}).dropna()

    found = reference.select("x", "cell").mapInPandas(ends, "cell int, axis int, low double, high double")
    shape = (2**cells.depth, cells.turn.shape[1])
    low, high = np.full(shape, np.inf), np.full(shape, np.inf)
    for r in found.groupBy("cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        low[r.cell, r.axis], high[r.cell, r.axis] = r.low, r.high
    return low, high


def _probe_cells(visits: DataFrame, queries: DataFrame, reference: DataFrame, k: int | None) -> DataFrame:
    """Probe each visit (qid, cell, reach); big cells are cut on both sides.

    Without ``k`` the queries of a cell tell theirs in a column.
    """
    told = [] if k else ["k"]

    def parts(rows: DataFrame, name: str) -> DataFrame:
        chunks = F.ceil(F.count("*") / CHUNK_ROWS).cast("int")
        return rows.groupBy("cell").agg(chunks.alias(name))

    cuts = parts(reference, "rparts").join(parts(visits, "qparts"), "cell")

    def part(key: str, count: str):
        return F.pmod(F.xxhash64(key), F.col(count).cast("bigint")).cast("int")

    def all_parts(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    asked = visits.join(queries.select("qid", "x", *told), "qid").join(cuts, "cell").select(
        "qid", "x", "reach", *told, "cell", part("qid", "qparts").alias("qpart"),
        all_parts("rparts").alias("rpart"),
    )
    points = reference.join(cuts, "cell").select(
        "rid", "x", "weight", "k_dist", "lrd", "cell", part("rid", "rparts").alias("rpart"),
        all_parts("qparts").alias("qpart"),
    )

    def probe(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(r) == 0:
            return _empty()
        return _nearest(q, _as_arrays(r), k or int(q["k"].iloc[0]))

    keys = ["cell", "rpart", "qpart"]
    return asked.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInPandas(probe, _PAIR)


def _by_cells(queries: DataFrame, reference: DataFrame, n_rows: int, k: int) -> DataFrame:
    cells = _cells(reference, n_rows, k)
    reference = stage(_with_cell(reference, cells), "knn-reference")
    queries = stage(_with_cell(queries, cells), "knn-queries")
    home = queries.select("qid", "cell", F.lit(float("inf")).alias("reach"))
    own = stage(_probe_cells(home, queries, reference, k), "knn-own")
    known = own.groupBy("qid").agg(F.count("*").alias("found"), F.max("distance").alias("worst"))
    bounded = queries.join(known, "qid", "left").withColumn(
        "reach", F.when(F.col("found") >= k, F.col("worst") + F.lit(_SLACK)).otherwise(F.lit(float("inf")))
    )
    shared = queries.sparkSession.sparkContext.broadcast((astuple(cells), *_cell_boxes(reference, cells)))

    def route(batches):
        fitted, low, high = shared.value
        cells = _Cells(*fitted)
        filled = np.isfinite(low).all(axis=1)
        for batch in batches:
            if len(batch) == 0 or not filled.any():
                continue
            gaps = np.full((len(low), len(batch)), np.inf)
            gaps[filled] = _gaps(cells.turned(batch["x"]), low[filled], high[filled])
            visit = filled[:, None] & (gaps <= batch["reach"].to_numpy())
            visit &= np.arange(len(low))[:, None] != batch["cell"].to_numpy()
            cell, row = np.nonzero(visit)
            yield pd.DataFrame(
                {
                    "qid": batch["qid"].to_numpy()[row],
                    "cell": cell.astype("int32"),
                    "reach": batch["reach"].to_numpy()[row],
                }
            )

    visits = bounded.select("qid", "x", "cell", "reach").mapInPandas(
        route, "qid string, cell int, reach double"
    )
    visits = stage(visits, "knn-visits")  # ids only
    return own.union(_probe_cells(visits, queries, reference, k))


def knn_join(queries: DataFrame, reference: DataFrame, k: int) -> DataFrame:
    """``(qid, rid, distance, weight, k_dist, lrd, share)``: exact nearest neighbours.

    ``queries``: ``(qid, x)``; ``reference``: ``(rid, x, weight[, k_dist, lrd])``.
    """
    for column in ("k_dist", "lrd"):
        if column not in reference.columns:
            reference = reference.withColumn(column, F.lit(0.0))
    reference = reference.select("rid", "x", "weight", "k_dist", "lrd")
    queries = queries.select("qid", "x")
    return take_nearest(_by_cells(queries, reference, reference.count(), k), k)


def knn_within(queries: DataFrame, reference: DataFrame) -> DataFrame:
    """``knn_join`` inside each cell on its own: ``queries`` ``(qid, x, cell, k)``, ``reference`` with ``cell``.

    For many references that each fit a cell; the ids are of all cells. The pairs keep ``k``.
    """
    reference, queries = stage(reference, "knn-reference"), stage(queries, "knn-queries")
    home = queries.select("qid", "cell", F.lit(float("inf")).alias("reach"))
    pairs = _probe_cells(home, queries, reference, None).join(queries.select("qid", "k"), "qid")
    return take_nearest(pairs, F.col("k"))


def _shares(k: int | Column) -> Column:
    return F.max(k).cast("double") if isinstance(k, Column) else F.lit(float(k))


def _density(neighbours: DataFrame, k: int | Column):
    reach = F.greatest(F.col("k_dist"), F.col("distance"))
    return 1.0 / (F.sum(F.col("share") * reach) / _shares(k) + F.lit(_LRD_EPS))


def fit_lof(
    points: DataFrame, n_rows: int, k: int, save=None
) -> tuple[DataFrame, DataFrame]:
    """Reference table ``(rid, x, weight, k_dist, lrd)`` and raw training scores.

    ``points`` comes from ``weighted_points``; ``n_rows`` counts the rows behind it.
    One neighbour join serves both: without self pairs for the fit, with them for
    the scores of the training rows as new points. ``save`` stores the reference
    table and gives it back; by default it goes to the staging folder.
    """
    save = save or (lambda df: stage(df, "lof-reference"))
    k = max(1, min(k, n_rows - 1))
    pairs = stage(
        knn_join(points.select(F.col("rid").alias("qid"), "x"), points, k + 1).drop(
            "share", "k_dist", "lrd"
        ),
        "lof-pairs",
    )
    return _learned(points, pairs, k, save)


def fit_lof_within(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``fit_lof`` for many small tables at once: ``points`` ``(rid, x, weight, cell, k)``, one table per cell."""
    asked = points.select(F.col("rid").alias("qid"), "x", "cell", (F.col("k") + 1).alias("k"))
    none = points.withColumns({"k_dist": F.lit(0.0), "lrd": F.lit(0.0)})
    pairs = knn_within(asked, none).drop("share", "k_dist", "lrd").withColumn("k", F.col("k") - 1)
    return _learned(points, stage(pairs, "lof-pairs"), F.col("k"), lambda df: stage(df, "lof-reference"))


def _learned(points: DataFrame, pairs: DataFrame, k: int | Column, save) -> tuple[DataFrame, DataFrame]:
    own = F.col("qid") == F.col("rid")
    others = pairs.withColumn("weight", F.col("weight") - own.cast("int")).filter("weight > 0")
    others = take_nearest(others, k)
    k_dist = others.groupBy("qid").agg(F.max("distance").alias("k_dist"))
    neighbour_k = k_dist.withColumnRenamed("qid", "rid")
    density = others.join(neighbour_k, "rid").groupBy("qid").agg(_density(others, k).alias("lrd"))
    learned = k_dist.join(density, "qid").withColumnRenamed("qid", "rid")
    reference = save(points.join(learned, "rid"))
    scored = take_nearest(pairs, k).join(reference.select("rid", "k_dist", "lrd"), "rid")
    return reference, lof_raw(scored, k)


def lof_raw(neighbours: DataFrame, k: int | Column) -> DataFrame:
    """``(qid, lof_raw)`` = -mean(lrd of neighbours) / lrd(query)."""
    return neighbours.groupBy("qid").agg(
        (
            -(F.sum(F.col("share") * F.col("lrd")) / _shares(k)) / _density(neighbours, k)
        ).alias("lof_raw")
    )


def score_lof(
    scaled: DataFrame, reference: DataFrame, n_train: int, k: int
) -> DataFrame:
    """Add ``lof_raw`` to rows with ``row_key`` and ``x``."""
    k = max(1, min(k, n_train - 1))
    queries = weighted_points(scaled).select(F.col("rid").alias("qid"), "x")
    scores = lof_raw(knn_join(queries, reference, k), k)
    by_vector = queries.join(scores, "qid").select("x", "lof_raw")
    return scaled.join(by_vector, "x", "left")
