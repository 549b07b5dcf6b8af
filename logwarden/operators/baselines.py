"""Path popularity and per-path query baselines.

One pass over the log gives one small row per path template; the totals and the
global baseline are derived from those rows, not from a second log scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..functions.text import with_request_text
from ..session import stage

# measure name -> (request column, fixed floor of its deviation)
MEASURES = {
    "qlen": ("q_len", 1.0),
    "entropy": ("token_entropy", 0.5),
    "non_alnum": ("query_non_alnum_ratio", 0.05),
    "transition": ("transition_rate", 0.05),
}


PROFILE_TOTALS = (
    "total",
    "common_cutoff",
    *(f"{name}_{part}" for name in MEASURES for part in ("mean", "std")),
)


@dataclass
class PathProfile:
    """``paths``: one row per template. ``totals``: one row, as plain numbers.

    With ``keys`` it holds several profiles: ``paths`` has a row per key and template, and the totals are
    columns of the requests.
    """

    paths: DataFrame
    totals: dict[str, float | Column]
    keys: tuple[str, ...] = ()


def path_moments(text: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Count, mean and population deviation of each measure per template.

    Map-side partial aggregation: a template holding a third of the log still
    shuffles only one row per map task.
    """
    aggs = [F.count("*").alias("cnt")]
    for name, (column, _) in MEASURES.items():
        aggs.append(F.avg(column).alias(f"{name}_mean"))
        aggs.append(F.stddev_pop(column).alias(f"{name}_dev"))
    return text.groupBy(*keys, "path_norm").agg(*aggs)


def rarity(count: Column, total: Column) -> Column:
    return -F.log10((count + 1) / (total + 1))


def popularity_totals(moments: DataFrame) -> DataFrame:
    """One row: number of requests and the median rarity over unique paths.

    Rarity depends on the count alone, so paths are first folded to one row per
    distinct count (at most about sqrt(2 * requests) rows).
    """
    total = moments.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n")).scalar()
    per_count = moments.groupBy("cnt").agg(F.count("*").alias("paths"))
    scored = per_count.select("paths", rarity(F.col("cnt"), total).alias("rarity"), total.alias("n"))
    return scored.agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.percentile("rarity", F.lit(0.5), F.col("paths")), F.lit(0.0)).alias(
            "common_cutoff"
        ),
    )


def global_baseline(moments: DataFrame) -> DataFrame:
    """The baseline without a key, by pooling the per-path moments."""
    weight = F.sum("cnt")
    means = moments.agg(
        *[(F.sum(F.col("cnt") * F.col(f"{m}_mean")) / weight).alias(m) for m in MEASURES]
    )
    pooled_mean = means.select(F.struct(*MEASURES).alias("m")).scalar()
    aggs = []
    for name, (_, floor) in MEASURES.items():
        centre = pooled_mean.getField(name)
        spread = F.col(f"{name}_dev") * F.col(f"{name}_dev") + (
            F.col(f"{name}_mean") - centre
        ) * (F.col(f"{name}_mean") - centre)
        variance = F.sum(F.col("cnt") * spread) / weight
        aggs.append(F.coalesce(F.max(centre), F.lit(0.0)).alias(f"{name}_mean"))
        aggs.append(
            F.coalesce(F.greatest(F.sqrt(variance), F.lit(floor)), F.lit(floor)).alias(
                f"{name}_std"
            )
        )
    return moments.agg(*aggs)


def totals_by(moments: DataFrame, key: str) -> DataFrame:
    """``popularity_totals`` and ``global_baseline`` of each key's templates: one row per key."""
    weight = F.sum("cnt")
    means = [(F.sum(F.col("cnt") * F.col(f"{m}_mean")) / weight).alias(f"_{m}") for m in MEASURES]
    sums = stage(moments.groupBy(key).agg(weight.alias("_n"), *means), "profile-sums")
    per_count = moments.groupBy(key, "cnt").agg(F.count("*").alias("paths")).join(F.broadcast(sums), key)
    cutoffs = per_count.groupBy(key).agg(
        F.first("_n").alias("total"),
        F.percentile(rarity(F.col("cnt"), F.col("_n")), F.lit(0.5), F.col("paths")).alias("common_cutoff"),
    )
    aggs = []
    for name, (_, floor) in MEASURES.items():
        gap = F.col(f"{name}_mean") - F.col(f"_{name}")
        spread = F.col(f"{name}_dev") * F.col(f"{name}_dev") + gap * gap
        variance = F.sum(F.col("cnt") * spread) / weight
        aggs.append(F.coalesce(F.first(f"_{name}"), F.lit(0.0)).alias(f"{name}_mean"))
        aggs.append(F.coalesce(F.greatest(F.sqrt(variance), F.lit(floor)), F.lit(floor)).alias(f"{name}_std"))
    baselines = moments.join(F.broadcast(sums), key).groupBy(key).agg(*aggs)
    return cutoffs.join(baselines, key).select(key, *PROFILE_TOTALS)


def path_baseline(moments: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Templates with enough samples, deviations floored."""
    return moments.filter(F.col("cnt") >= cfg.min_path_samples).select(
        "path_norm",
        F.col("cnt").alias("n"),
        *[
            col
            for name, (_, floor) in MEASURES.items()
            for col in (
                F.col(f"{name}_mean"),
                F.greatest(f"{name}_dev", F.lit(floor)).alias(f"{name}_std"),
            )
        ],
    )


def build_profile(requests: DataFrame, cfg: DetectorConfig, paths: DataFrame | None = None) -> PathProfile:
    """Profile of a training log. ``paths``: the moments, when already stored.

    The moments are written out before use, so the join back to the requests is
    planned from the table's true size (see ``session.stage``).
    """
    if paths is None:
        paths = stage(path_moments(with_request_text(requests, cfg.min_ratio_length)), "paths")
    totals = popularity_totals(paths).first().asDict()
    return PathProfile(paths, {**totals, **global_baseline(paths).first().asDict()})
