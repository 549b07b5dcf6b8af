"""Per-request features and the entity-window roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS, DetectorConfig
from ..functions.text import with_request_text
from .baselines import MEASURES, PathProfile, rarity

# window column -> request column it averages / maximises
_MEANS = {
    "path_non_alnum_mean": "path_non_alnum_ratio",
    "query_non_alnum_mean": "query_non_alnum_ratio",
    "encoded_ratio": "encoded_ratio",
    "query_encoded_ratio": "query_encoded_ratio",
    "q_len_mean": "q_len",
    "token_entropy_mean": "token_entropy",
    "transition_rate_mean": "transition_rate",
    "param_count": "param_count",
    "path_rarity_mean": "path_rarity",
}
_MAXIMA = {
    "path_non_alnum_max": "path_non_alnum_ratio",
    "query_non_alnum_max": "query_non_alnum_ratio",
    "q_len_max": "q_len",
    "token_entropy_max": "token_entropy",
    "max_param_entropy": "max_param_entropy",
    "transition_rate_max": "transition_rate",
    "path_rarity_max": "path_rarity",
    "qlen_z_max": "qlen_z",
    "entropy_z_max": "entropy_z",
}
WINDOW_COLUMNS = (
    "ip",
    "window_ts",
    "n_requests",
    *FEATURE_COLUMNS[:21],
    "break_count",
    "break_ratio",
    "rare_path_count",
    "rare_path_ratio",
    "legit_path_ratio",
    "burst_rate",
)


def with_path_profile(text: DataFrame, profile: PathProfile, cfg: DetectorConfig) -> DataFrame:
    """Left join on the template; absent paths fall back to the global baseline.

    No broadcast hint: the profile is a stored table, so Spark broadcasts it only
    when its files are small, and otherwise splits hot templates as skewed
    partitions of a sort-merge join.
    """
    joined = text.join(profile.paths, [*profile.keys, "path_norm"], "left")
    known = F.col("cnt") >= cfg.min_path_samples
    columns = {"path_cnt": F.coalesce("cnt", F.lit(0))}
    for name, (_, floor) in MEASURES.items():
        columns[f"base_{name}_mean"] = F.when(known, F.col(f"{name}_mean")).otherwise(
            F.lit(profile.totals[f"{name}_mean"])
        )
        columns[f"base_{name}_std"] = F.when(
            known, F.greatest(f"{name}_dev", F.lit(floor))
        ).otherwise(F.lit(profile.totals[f"{name}_std"]))
    dropped = ["cnt"] + [f"{m}_{part}" for m in MEASURES for part in ("mean", "dev")]
    return joined.withColumns(columns).drop(*dropped)


def _z(measure: str, cfg: DetectorConfig) -> Column:
    column, _ = MEASURES[measure]
    gap = F.abs(F.col(column) - F.col(f"base_{measure}_mean"))
    return F.least(gap / F.col(f"base_{measure}_std"), F.lit(cfg.z_clip))


def request_features(
    requests: DataFrame, profile: PathProfile, cfg: DetectorConfig
) -> DataFrame:
    """All per-request measures against a given profile."""
    text = with_request_text(requests, cfg.min_ratio_length)
    joined = with_path_profile(text, profile, cfg)
    scored = joined.withColumns(
        {
            "path_rarity": rarity(F.col("path_cnt"), F.lit(profile.totals["total"])),
            "non_alnum_z": _z("non_alnum", cfg),
            "transition_z": _z("transition", cfg),
            "qlen_z": _z("qlen", cfg),
            "entropy_z": _z("entropy", cfg),
        }
    )
    long_query = F.length("query_dec") >= cfg.min_ratio_length
    long_path = F.length("path_dec") >= cfg.min_ratio_length
    return scored.withColumns(
        {
            "is_break": (
                long_query
                & ((F.col("non_alnum_z") > cfg.break_z) | (F.col("transition_z") > cfg.break_z))
            )
            | (F.col("q_len") > cfg.break_query_length)
            | (long_path & (F.col("path_non_alnum_ratio") > cfg.break_path_ratio)),
            "is_rare_path": (F.col("path_cnt") == 0) & long_path,
            "is_common_path": F.col("path_rarity") < profile.totals["common_cutoff"],
        }
    )


def time_window(ts: Column, cfg: DetectorConfig) -> Column:
    return F.window(ts, f"{cfg.window_minutes} minutes")


def _share_flag(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def shape_rollup(features: DataFrame, window: Column, cfg: DetectorConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """First level: one row per (window, ip, query shape).

    Spreads a loud (ip, window) over its shapes, and turns the exact distinct
    count of shapes into a plain count at the second level.
    """
    status = F.col("status")
    sums = [F.sum(c).alias(f"sum_{name}") for name, c in _MEANS.items()]
    maxima = [F.max(c).alias(name) for name, c in _MAXIMA.items()]
    return features.groupBy(window.alias("window"), *keys, "ip", "query_shape").agg(
        F.count("*").alias("n"),
        *sums,
        *maxima,
        _share_flag(F.col("is_break")).alias("breaks"),
        _share_flag(F.col("is_rare_path")).alias("rare_paths"),
        _share_flag(F.col("is_common_path")).alias("common_paths"),
        _share_flag(status.isin(*cfg.error_statuses)).alias("errors"),
        _share_flag((status >= 400) & (status < 500)).alias("client_errors"),
    )


def window_rollup(shapes: DataFrame, cfg: DetectorConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """Second level: one row per (ip, window) with the model inputs."""
    merged = shapes.groupBy("window", *keys, "ip").agg(
        F.sum("n").alias("n_requests"),
        _share_flag(F.col("query_shape") != "").alias("shapes"),
        *[F.sum(f"sum_{name}").alias(f"sum_{name}") for name in _MEANS],
        *[F.max(name).alias(name) for name in _MAXIMA],
        *[
            F.sum(c).alias(c)
            for c in ("breaks", "rare_paths", "common_paths", "errors", "client_errors")
        ],
    )
    n = F.col("n_requests")
    derived = {
        **{name: F.col(f"sum_{name}") / n for name in _MEANS},
        **{name: F.col(name).cast("double") for name in _MAXIMA},
        "break_count": F.col("breaks"),
        "break_ratio": F.col("breaks") / n,
        "rare_path_count": F.col("rare_paths"),
        "rare_path_ratio": F.col("rare_paths") / n,
        "status_500_ratio": F.col("errors") / n,
        "status_4xx_ratio": F.col("client_errors") / n,
        "query_diversity": F.col("shapes") / n,
        "legit_path_ratio": F.col("common_paths") / n,
        "burst_rate": n / F.lit(cfg.window_minutes),
        "window_ts": F.col("window.start"),
    }
    eligible = merged.filter(n >= cfg.min_requests)
    return eligible.select(*keys, "ip", "n_requests", *[c.alias(k) for k, c in derived.items()]).select(
        *keys, *WINDOW_COLUMNS
    )


def url_rollup(requests: DataFrame, window: Column, cfg: DetectorConfig) -> DataFrame:
    """One row per (window, ip, path, query): how often, with how many errors, and when first.

    All that windows and URL rankings need of the requests, whatever the model, and
    rows of parts of a log add up.
    """
    status = F.col("status")
    return requests.groupBy(window.alias("window"), "ip", "path", "query").agg(
        F.count("*").alias("n"),
        _share_flag(status.isin(*cfg.error_statuses)).alias("errors"),
        _share_flag((status >= 400) & (status < 500)).alias("client_errors"),
        F.min("ts").alias("ts"),
    )


def url_windows(urls: DataFrame, profile: PathProfile, cfg: DetectorConfig) -> DataFrame:
    """Entity windows from rows of ``url_rollup``: each distinct URL is measured once and weighs ``n``."""
    features = request_features(urls, profile, cfg)
    n = F.col("n")
    shapes = features.groupBy("window", "ip", "query_shape").agg(
        F.sum(n).alias("n"),
        *[F.sum(F.col(c) * n).alias(f"sum_{name}") for name, c in _MEANS.items()],
        *[F.max(c).alias(name) for name, c in _MAXIMA.items()],
        *[
            F.sum(F.when(F.col(flag), n).otherwise(0)).alias(name)
            for flag, name in (("is_break", "breaks"), ("is_rare_path", "rare_paths"), ("is_common_path", "common_paths"))
        ],
        F.sum("errors").alias("errors"), F.sum("client_errors").alias("client_errors"),
    )
    return window_rollup(shapes, cfg)


def entity_windows(features: DataFrame, cfg: DetectorConfig, keys: tuple[str, ...] = ()) -> DataFrame:
    """(ip, window) rows with at least ``min_requests`` requests; those of other ``keys`` are kept apart.

    Small windows are dropped after the aggregate, not before it: a count per
    window ahead of the features would shuffle every request, while this moves
    only partial aggregates.
    """
    window = time_window(F.col("ts"), cfg)
    return window_rollup(shape_rollup(features, window, cfg, keys), cfg, keys)


def feature_vector(windows: DataFrame) -> DataFrame:
    """The model inputs as one array in their fixed order."""
    vector = F.array(*[F.col(c).cast("double") for c in FEATURE_COLUMNS])
    return windows.withColumn("x", vector)
