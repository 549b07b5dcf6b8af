"""Two-component 1-D Gaussian mixture over a batch's fused scores.

Fused scores lie in [0, 1] with four decimals, so their histogram has at most 10,001 bins
whatever the size of the batch. It is one row of arrays, and all rounds of the
expectation-maximisation are one expression over it, without Python and without a
job for each round.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Convergence rule of the fit.
TOLERANCE = 1e-3
ROUNDS = 100
VARIANCE_FLOOR = 1e-6
MASS_FLOOR = 1e-15
LEAST_ROWS = 4
LEAST_DEVIATION = 1e-9

_SIDES = ("low", "high")
_SUMS = ("mass", "x", "xx")


def _component(mass: Column, x: Column, xx: Column) -> dict[str, Column]:
    """Mass, mean and variance from weighted sums of 1, x and x squared."""
    mass = mass + MASS_FLOOR
    mean = x / mass
    return {"mass": mass, "mean": mean, "variance": F.greatest(xx / mass - mean * mean, F.lit(0.0)) + VARIANCE_FLOOR}


def _parameters(sums: dict[str, dict[str, Column]]) -> Column:
    return F.struct(
        *[c.alias(f"{side}_{name}") for side in _SIDES for name, c in _component(**sums[side]).items()]
    )


def _log_density(p: Column, side: str, x: Column, total: Column) -> Column:
    variance, gap = p[f"{side}_variance"], x - p[f"{side}_mean"]
    return F.log(p[f"{side}_mass"] / total) - 0.5 * (F.log(2.0 * math.pi * variance) + gap * gap / variance)


def _expected(p: Column, bins: Column, total: Column) -> Column:
    """Bins (x, w) with both log densities and the log of their sum."""
    both = F.transform(
        bins,
        lambda b: F.struct(
            b["x"].alias("x"), b["w"].alias("w"),
            *[_log_density(p, side, b["x"], total).alias(side) for side in _SIDES],
        ),
    )

    def norm(b: Column) -> Column:
        return F.greatest(b["low"], b["high"]) + F.log1p(F.exp(-F.abs(b["low"] - b["high"])))

    return F.transform(both, lambda b: F.struct(b.alias("at"), norm(b).alias("norm")))


def _round(p: Column, bins: Column, total: Column) -> Column:
    """The bound under parameters ``p``, and the weighted sums of both components."""
    zero = F.struct(
        F.lit(0.0).alias("bound"), *[F.lit(0.0).alias(f"{side}_{s}") for side in _SIDES for s in _SUMS]
    )

    def add(acc: Column, b: Column) -> Column:
        at, norm = b["at"], b["norm"]
        parts = [(acc["bound"] + at["w"] * norm).alias("bound")]
        for side in _SIDES:
            share = at["w"] * F.exp(at[side] - norm)
            for s, value in zip(_SUMS, (share, share * at["x"], share * at["x"] * at["x"]), strict=True):
                parts.append((acc[f"{side}_{s}"] + value).alias(f"{side}_{s}"))
        return F.struct(*parts)

    return F.aggregate(_expected(p, bins, total), zero, add)


def _start(histogram: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row (of each key): bins, total, flat (too few or equal values), and the parameters of the best two-way split."""
    upto = W.partitionBy(*keys).orderBy("x").rowsBetween(W.unboundedPreceding, 0)
    everything = W.partitionBy(*keys).orderBy("x").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    values = {"mass": F.col("w"), "x": F.col("w") * F.col("x"), "xx": F.col("w") * F.col("x") * F.col("x")}
    rows = histogram.withColumns(
        {f"low_{k}": F.sum(v).over(upto) for k, v in values.items()}
        | {f"all_{k}": F.sum(v).over(everything) for k, v in values.items()}
    ).withColumns({f"high_{k}": F.col(f"all_{k}") - F.col(f"low_{k}") for k in values})

    def squares(side: str) -> Column:
        return F.col(f"{side}_xx") - F.col(f"{side}_x") * F.col(f"{side}_x") / F.col(f"{side}_mass")

    rows = rows.withColumn("cost", F.when(F.col("high_mass") > 0, squares("low") + squares("high")))
    best = F.min_by(
        F.struct(*[F.col(f"{side}_{s}") for side in _SIDES for s in _SUMS]),
        F.when(F.col("cost").isNotNull(), F.struct("cost", "x")),
    )
    one = rows.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("x", "w"))).alias("bins"),
        F.max("all_mass").alias("total"), F.max("all_x").alias("sum"), best.alias("split"),
    )
    mean = F.col("sum") / F.col("total")
    spread = F.aggregate(
        "bins", F.lit(0.0), lambda acc, b: acc + b["w"] * (b["x"] - F.col("mean")) * (b["x"] - F.col("mean"))
    )
    flat = (F.col("total") < LEAST_ROWS) | (F.sqrt(F.col("spread") / F.col("total")) < LEAST_DEVIATION)
    sums = {side: {s: F.col(f"split.{side}_{s}") for s in _SUMS} for side in _SIDES}
    return (
        one.withColumn("mean", mean).withColumn("spread", spread)
        .withColumn("flat", F.col("split").isNull() | flat)
        .withColumn("p", _parameters(sums))
    )


def fit(histogram: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """From (x, w): one row (of each key) with bins, total, flat and p, the fitted mass, mean and variance of both components.

    Starts from the split with the least squares within its sides; ends when a round
    changes the mean log likelihood by less than ``TOLERANCE``, or after ``ROUNDS``.
    """
    start = F.struct(F.col("p"), F.lit(float("-inf")).alias("bound"), F.lit(False).alias("done"))

    def step(state: Column, i: Column) -> Column:
        return F.when(state["done"], state).otherwise(
            F.element_at(F.transform(F.array(_round(state["p"], F.col("bins"), F.col("total"))), lambda r: after(state, i, r)), 1)
        )

    def after(state: Column, i: Column, r: Column) -> Column:
        bound = r["bound"] / F.col("total")
        done = (F.abs(bound - state["bound"]) < TOLERANCE) | (i >= ROUNDS)
        sums = {side: {s: r[f"{side}_{s}"] for s in _SUMS} for side in _SIDES}
        return F.struct(
            F.when(done, state["p"]).otherwise(_parameters(sums)).alias("p"), bound.alias("bound"), done.alias("done")
        )

    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["p"])
    fitted = F.when(F.col("flat"), F.col("p")).otherwise(rounds)
    return _start(histogram, keys).select(*keys, "bins", "total", "flat", fitted.alias("p"))


def posteriors(histogram: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(x, posterior of the component with the larger mean, four decimals) for each bin of (x, w).

    All 0 for fewer than ``LEAST_ROWS`` rows or values that are all but equal; an empty
    histogram gives no rows.
    """
    upper = F.when(F.col("p.high_mean") > F.col("p.low_mean"), F.col("b.at.high")).otherwise(F.col("b.at.low"))
    rows = fit(histogram, keys).filter("size(bins) > 0").select(
        *keys, "p", "flat", F.explode(_expected(F.col("p"), F.col("bins"), F.col("total"))).alias("b")
    )
    posterior = F.when(F.col("flat"), F.lit(0.0)).otherwise(F.round(F.exp(upper - F.col("b.norm")), 4))
    return rows.select(*keys, F.col("b.at.x").alias("x"), posterior.alias("posterior"))


def with_anomaly_prob(scored: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add ``anomaly_prob``; the posteriors are joined back as a table of at most 10,001 rows (of each key)."""
    histogram = scored.groupBy(*keys, F.col("fused_score").alias("x")).agg(F.count("*").cast("double").alias("w"))
    found = posteriors(histogram.filter("x IS NOT NULL"), keys).select(
        *keys,
        F.col("x").alias("fused_score"), F.col("posterior").alias("anomaly_prob")
    )
    return scored.join(found if keys else F.broadcast(found), [*keys, "fused_score"], "left")
