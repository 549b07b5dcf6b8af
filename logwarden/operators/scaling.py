"""Column scaling: mean and population deviation per model input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS
from ..functions.quantiles import unpivot


def scaler_stats(windows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``(feature, mean, std)``, one row per model input (of each key); a zero deviation counts as 1."""
    deviation = F.stddev_pop("x")
    return (
        unpivot(windows, FEATURE_COLUMNS, keys)
        .groupBy(*keys, F.col("name").alias("feature"))
        .agg(
            F.avg("x").alias("mean"),
            F.when(deviation == 0, F.lit(1.0)).otherwise(deviation).alias("std"),
        )
    )


def collect_scaler(stats: DataFrame) -> dict[str, tuple[float, float]]:
    return {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}


#: Decimals of a scaled input: sums taken in another order give the same vector.
DIGITS = 9


def scale(windows: DataFrame, scaler: dict[str, tuple[float | Column, float | Column]]) -> DataFrame:
    """Add ``x``: the scaled model inputs in their fixed order, with ``DIGITS`` decimals."""
    scaled = [
        F.round((F.col(c).cast("double") - F.lit(scaler[c][0])) / F.lit(scaler[c][1]), DIGITS) + F.lit(0.0)
        for c in FEATURE_COLUMNS
    ]
    return windows.withColumn("x", F.array(*scaled))
