"""Score normalisation, fusion, calibration and the alert gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..functions.quantiles import percentile_values, percentiles_by

_EPS = 1e-9


@dataclass(frozen=True)
class Calibration:
    """Scalars learned from the training scores; columns where rows are of several models."""

    if_low: float
    if_high: float
    lof_low: float
    lof_high: float
    fused_threshold: float
    catastrophic_threshold: float


def inverted_minmax(raw: Column, low: float, high: float) -> Column:
    scaled = 1.0 - (raw - F.lit(low)) / F.lit(high - low + _EPS)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))


def fuse(if_score: Column, lof_score: Column, known_share: Column) -> Column:
    """Mean of both scores, halved at most when all paths are well known."""
    return (1.0 - 0.5 * known_share) * 0.5 * (if_score + lof_score)


def score_bounds(raw: DataFrame, cfg: DetectorConfig) -> tuple[float, float, float, float]:
    low, high = cfg.score_low_pct / 100.0, cfg.score_high_pct / 100.0
    got = percentile_values(raw, {"if_raw": [low, high], "lof_raw": [low, high]})
    if not got:
        raise ValueError("no training scores to calibrate on")
    return got["if_raw", low], got["if_raw", high], got["lof_raw", low], got["lof_raw", high]


def training_scores(raw: DataFrame, bounds: tuple[float, float, float, float]) -> DataFrame:
    """Unrounded normalised and fused training scores."""
    if_score = inverted_minmax(F.col("if_raw"), bounds[0], bounds[1])
    lof_score = inverted_minmax(F.col("lof_raw"), bounds[2], bounds[3])
    return raw.withColumns({"if_score": if_score, "lof_score": lof_score}).withColumn(
        "fused_score", fuse(F.col("if_score"), F.col("lof_score"), F.col("legit_path_ratio"))
    )


def calibrate(raw: DataFrame, cfg: DetectorConfig) -> tuple[Calibration, DataFrame]:
    """Bounds, thresholds, and the scored training frame."""
    bounds = score_bounds(raw, cfg)
    scored = training_scores(raw, bounds)
    low, high = cfg.alert_pct / 100.0, cfg.catastrophic_pct / 100.0
    got = percentile_values(scored, {"fused_score": [low, high]})
    return (
        Calibration(*bounds, got["fused_score", low], got["fused_score", high]),
        scored,
    )


def normalise_scores(raw: DataFrame, calibration: Calibration) -> DataFrame:
    """``if_raw, lof_raw`` -> three scores in [0, 1], four decimals."""
    bounds = (calibration.if_low, calibration.if_high, calibration.lof_low, calibration.lof_high)
    scored = training_scores(raw, bounds)
    return scored.withColumns(
        {c: F.round(c, 4) for c in ("if_score", "lof_score", "fused_score")}
    )


def relative_score(fused: Column, low: float, high: float) -> Column:
    return F.round((fused - F.lit(low)) / F.greatest(F.lit(high - low), F.lit(_EPS)), 4)


def alert_gate(scored: DataFrame, calibration: Calibration, cfg: DetectorConfig) -> DataFrame:
    """Burst gate or catastrophic gate; non-alerts read ``burst``."""
    fused = F.col("fused_score")
    burst = (
        (fused >= calibration.fused_threshold)
        & (F.col("break_count") >= cfg.min_break_urls)
        & (F.col("break_ratio") >= cfg.min_break_ratio)
    )
    catastrophic = (fused >= calibration.catastrophic_threshold) & (F.col("status_500_ratio") > 0)
    return scored.withColumns(
        {
            "anomaly_flag": burst | catastrophic,
            "alert_kind": F.when(catastrophic & ~burst, "catastrophic").otherwise("burst"),
            "relative_score": relative_score(
                fused, calibration.fused_threshold, calibration.catastrophic_threshold
            ),
        }
    )


def with_severity(alerts: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """LOW / MEDIUM / HIGH by the batch's own 33rd and 66th percentile."""
    low, high = cfg.severity_low_pct / 100.0, cfg.severity_high_pct / 100.0
    got = percentile_values(alerts, {"fused_score": [low, high]})
    if not got:
        return alerts.withColumn("severity", F.lit(None).cast("string"))
    return alerts.withColumn("severity", _severity(got["fused_score", low], got["fused_score", high]))


def _severity(low: float | Column, high: float | Column) -> Column:
    fused = F.col("fused_score")
    return F.when(fused >= high, "HIGH").when(fused >= low, "MEDIUM").otherwise("LOW")


def with_severity_by(alerts: DataFrame, key: str, cfg: DetectorConfig) -> DataFrame:
    """``with_severity`` for each key's alerts, which have to be of bounded number."""
    probs = [cfg.severity_low_pct / 100.0, cfg.severity_high_pct / 100.0]
    cuts = percentiles_by(alerts, key, {"fused_score": probs}).select(key, F.col("fused_score").alias("_cuts"))
    both = alerts.join(F.broadcast(cuts), key)
    severity = F.when(F.col("_cuts")[0].isNotNull(), _severity(F.col("_cuts")[0], F.col("_cuts")[1]))
    return both.withColumn("severity", severity).drop("_cuts")
