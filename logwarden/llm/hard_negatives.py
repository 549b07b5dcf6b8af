"""Hard negatives of anchors, by Fagin's threshold algorithm.

The score of a row is its integer inner product with the anchor, a sum of one
term for each dimension. Rows are dealt to blocks; a block holds one list of its rows
for each dimension, sorted by that component. A search reads all lists step by step, from
the top where the anchor's component is positive and from the bottom where it is
negative. Rows met for the first time are scored in full (random access). The sum of the
last terms read is the threshold: no row that was not met can score higher. A search
ends when the threshold falls strictly below the k-th best score of each
window (strictly, as ties go to the smaller id) or below the window itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

#: Sums of products of whole numbers up to here are exact in double precision.
_EXACT = 2.0**52
_NO_FLOOR, _NO_CEILING = -(10**60), 10**60


@dataclass(frozen=True)
class HardNegativeConfig:
    """A negative's score lies between ``low`` and ``high`` percent of the positive's.

    ``block`` and ``anchor_block`` are the rows and anchors of one unit of work, ``step``
    the rows that a search first reads of each list; they do not change the result.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    block: int = 8192
    anchor_block: int = 1024
    step: int = 32


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """Rows that take part, with v = floor(scale * x) as whole doubles in place of embedding.

    Left out are rows with a null vec_id, label or vector, or any null or non-finite component.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad
    )
    # rint of a double stays a double, where floor would be held to the range of a bigint
    scaled = F.transform("embedding", lambda x: x.cast("double") * scale)
    lower = F.transform(scaled, lambda x: F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0))
    return kept.select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), lower.alias("v"),
        *[c for c in kept.columns if c == "is_anchor"],
    )


def mine(rows: DataFrame, anchors: Column, cfg: HardNegativeConfig | None = None) -> DataFrame:
    """Hard negatives for each positive of each row of ``rows`` (vec_id, label, embedding) where ``anchors`` holds.

    Positives are an anchor's ``cfg.positives`` best rows of the same label, negatives the
    ``cfg.negatives`` best of other labels with low * positive_score <= 100 * negative_score
    <= high * positive_score. Returns anchor_id, positive_id, rank (int, from 1), negative_id,
    positive_score, negative_score; fewer rows where there are fewer. Ties go to the smaller
    vec_id. Rows with the anchor's own vec_id are no candidates; rows that repeat are candidates
    each, and one anchor if equal; a null condition is no anchor. A shorter vector counts
    as 0 in what it lacks. Products beyond 2^52 are computed in whole numbers of any size; a
    score beyond bigint's range counts as the end of that range. Other columns play no part; an
    empty table gives no rows.

    No label has to fit a task: the rows of a label with more than ``cfg.block`` are dealt to
    several blocks, and its anchors to several anchor blocks.
    """
    cfg = cfg or HardNegativeConfig()
    flagged = rows.withColumn("is_anchor", F.coalesce(anchors, F.lit(False)))
    kept = stage(whole_vectors(flagged, cfg.scale), "vectors")
    key = F.xxhash64("vec_id", "label", "v").alias("key")
    asked = stage(kept.filter("is_anchor").select("vec_id", "label", "v", key).distinct(), "anchors")

    found = stage(_positives(kept, asked, cfg), "positives")
    slot = F.row_number().over(W.partitionBy("key").orderBy(F.desc("score"), "other"))
    best = found.withColumn("slot", slot).filter(F.col("slot") <= cfg.positives)
    held = best.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("slot", "other", "score"))).alias("positive"))
    windowed = stage(
        asked.join(held.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key")).select(
            "key", "vec_id", "label", "v",
            F.transform("positive", lambda p: p["other"]).alias("positive_ids"),
            F.transform("positive", lambda p: p["score"]).alias("positive_scores"),
        ),
        "windows",
    )
    order = W.partitionBy("key", "slot").orderBy(F.desc("score"), "other")
    return (
        _negatives(kept, windowed, cfg)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= cfg.negatives)
        .select(
            "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


def _share(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts).cast("int")


def _each(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), parts - 1))


def _positives(kept: DataFrame, asked: DataFrame, cfg: HardNegativeConfig) -> DataFrame:
    """(key, other, score) of each anchor's best rows of its label in each block."""
    total = kept.groupBy("label").agg(F.count("*").alias("n"))
    anchors = asked.groupBy(F.col("label").alias("_label")).agg(F.count("*").alias("m"))
    sizes = stage(total.join(anchors, F.col("label") == F.col("_label")).select("_label", "n", "m"), "label-sizes")
    small = max(1, -(-(kept.count()) // cfg.block))
    # labels of few rows share blocks, a label of many has several
    large = F.col("n") > cfg.block
    part = F.when(large, F.col("label")).otherwise(_share("label", F.lit(small)))
    blocks = F.when(large, F.ceil(F.col("n") / cfg.block)).otherwise(1).cast("int")
    groups = F.when(large, F.ceil(F.col("m") / cfg.anchor_block)).otherwise(1).cast("int")
    keys = ["large", "part", "block", "anchors"]

    def dealt(table: DataFrame) -> DataFrame:
        return table.join(sizes, F.col("label") == F.col("_label")).withColumns(
            {"large": large, "part": part, "_blocks": blocks, "_groups": groups}
        )

    left = dealt(kept).withColumn("block", _share("vec_id", F.col("_blocks"))).select(
        "large", "part", "block", _each(F.col("_groups")).alias("anchors"), "vec_id", "label", "v"
    )
    right = dealt(asked).withColumn("anchors", _share("key", F.col("_groups"))).select(
        "large", "part", _each(F.col("_blocks")).alias("block"), "anchors", "key", "vec_id", "label", "v"
    )

    def unit(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        by_label = dict(iter(rows.groupby("label"))) if len(anchors) else {}
        for label, some in anchors.groupby("label"):
            if label not in by_label:
                continue
            lists = SortedLists(by_label[label], some["v"])
            for key, own, vector in zip(some["key"], some["vec_id"], lists.anchors, strict=True):
                (best,) = lists.search(vector, lists.ids != own, cfg.positives, [(_NO_FLOOR, _NO_CEILING)], cfg.step)
                out.extend((key, other, score) for score, other in best)
        return pd.DataFrame(out, columns=["key", "other", "score"])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(unit, "key long, other long, score long")


def _negatives(kept: DataFrame, windowed: DataFrame, cfg: HardNegativeConfig) -> DataFrame:
    """Each window's best rows of other labels in each block."""
    blocks = F.lit(max(1, -(-kept.count() // cfg.block)))
    groups = F.lit(max(1, -(-windowed.count() // cfg.anchor_block)))
    left = kept.select(_share("vec_id", blocks).alias("block"), _each(groups).alias("anchors"), "vec_id", "label", "v")
    right = windowed.select(_each(blocks).alias("block"), _share("key", groups).alias("anchors"), *windowed.columns)

    def unit(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        lists = SortedLists(rows, anchors["v"]) if len(rows) and len(anchors) else None
        for row, vector in zip(anchors.itertuples(), lists.anchors if lists else [], strict=True if lists else False):
            scores = [int(s) for s in row.positive_scores]
            windows = [(-(-cfg.low * s // 100), cfg.high * s // 100) for s in scores]
            allowed = (lists.labels != row.label) & (lists.ids != row.vec_id)
            for slot, best in enumerate(lists.search(vector, allowed, cfg.negatives, windows, cfg.step)):
                out.extend(
                    (row.key, slot, row.vec_id, int(row.positive_ids[slot]), scores[slot], other, score)
                    for score, other in best
                )
        return pd.DataFrame(out, columns=["key", "slot", "anchor_id", "positive_id", "positive_score", "other", "score"])

    keys = ["block", "anchors"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        unit,
        "key long, slot int, anchor_id long, positive_id long, positive_score long, other long, score long",
    )


class SortedLists:
    """The rows of a block with one list for each dimension, sorted by the component."""

    def __init__(self, rows: pd.DataFrame, anchors: pd.Series):
        rows = rows.sort_values("vec_id", kind="stable")
        width = max(1, max(map(len, rows["v"])), max(map(len, anchors)))
        self.ids, self.labels = rows["vec_id"].to_numpy("int64"), rows["label"].to_numpy("int64")
        self.x, self.anchors = _matrix(rows["v"], width), _matrix(anchors, width)
        self.order = np.argsort(self.x, axis=0, kind="stable").T.copy()
        largest = max(1.0, np.abs(self.x).max()) * max(1.0, np.abs(self.anchors).max())
        if largest * width > _EXACT:  # whole numbers of any size
            self.x, self.anchors = _integers(self.x), _integers(self.anchors)

    def search(self, anchor, allowed: np.ndarray, k: int, windows: list[tuple[int, int]], step: int) -> list[list]:
        """For each window (lowest and highest score) its k best (score, id) of the rows ``allowed``."""
        n = len(self.ids)
        dims = [d for d, a in enumerate(anchor) if a != 0]
        weights = anchor[dims]
        # signed access: rising lists are read from their end where the component is positive
        lists = [self.order[d][::-1] if anchor[d] > 0 else self.order[d] for d in dims]
        best = [([], []) for _ in windows]
        open_ = set(range(len(windows)))
        met = ~allowed
        at = 0
        while open_ and at < n:
            upto = min(n, at + step)
            if lists:
                fresh = np.zeros(n, bool)
                for ranked in lists:
                    fresh[ranked[at:upto]] = True
            else:  # an anchor of zeros: all scores are 0
                fresh, upto = np.ones(n, bool), n
            fresh &= ~met
            met |= fresh
            rows = np.flatnonzero(fresh)
            scores = self.x[rows] @ anchor
            if scores.dtype == object:
                scores = np.array([_bigint(s) for s in scores], object)
            last = [self.x[ranked[upto - 1], d] for ranked, d in zip(lists, dims, strict=True)]
            threshold = _bigint((np.array(last, self.x.dtype) * weights).sum()) if lists else 0
            for w in list(open_):
                low, high = windows[w]
                inside = ((scores >= low) & (scores <= high)).astype(bool)
                best[w] = _best(*best[w], scores[inside], self.ids[rows[inside]], k)
                found = best[w][0]
                if threshold < low or (len(found) == k and threshold < found[-1]):
                    open_.discard(w)
            at, step = upto, 2 * step
        return [[(int(s), int(i)) for s, i in zip(*kept, strict=True)] for kept in best]


def _best(scores, ids, more, more_ids, k: int) -> tuple[list, list]:
    """The k best by falling score, then rising id, of the kept and the new ones."""
    if len(more) > 4 * k and more.dtype != object:
        floor = np.partition(more, len(more) - k)[len(more) - k]
        more_ids, more = more_ids[more >= floor], more[more >= floor]
    both = sorted(zip([*scores, *map(int, more)], [*ids, *more_ids.tolist()], strict=True), key=lambda p: (-p[0], p[1]))
    return [s for s, _ in both[:k]], [i for _, i in both[:k]]


def _bigint(value: int) -> int:
    return max(-(2**63), min(2**63 - 1, int(value)))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, object)
    out.flat = [int(v) for v in x.flat]
    return out
