"""Detector parameters. Every threshold the operators use comes from here."""

from __future__ import annotations

from dataclasses import dataclass

ENGINE_VERSION = "1.0"

# The model inputs, in the order the models see them.
FEATURE_COLUMNS = (
    "path_non_alnum_mean",
    "path_non_alnum_max",
    "query_non_alnum_mean",
    "query_non_alnum_max",
    "encoded_ratio",
    "query_encoded_ratio",
    "q_len_mean",
    "q_len_max",
    "token_entropy_mean",
    "token_entropy_max",
    "max_param_entropy",
    "transition_rate_mean",
    "transition_rate_max",
    "param_count",
    "status_500_ratio",
    "status_4xx_ratio",
    "query_diversity",
    "path_rarity_mean",
    "path_rarity_max",
    "qlen_z_max",
    "entropy_z_max",
    "break_ratio",
    "rare_path_ratio",
    "burst_rate",
)


@dataclass(frozen=True)
class DetectorConfig:
    # Defaults of the detector.
    window_minutes: int = 60
    min_requests: int = 20
    min_path_samples: int = 20
    min_ratio_length: int = 8
    break_z: float = 3.0
    break_query_length: int = 200
    break_path_ratio: float = 0.30
    z_clip: float = 20.0
    error_statuses: tuple[int, ...] = (500,)
    # models
    min_train_windows: int = 10
    trees: int = 200
    tree_sample: int = 256
    neighbours: int = 20
    seed: int = 42
    score_low_pct: float = 0.5
    score_high_pct: float = 99.5
    alert_pct: float = 99.9
    catastrophic_pct: float = 99.99
    rarity_pct: float = 95.0
    # alert gate
    min_break_urls: int = 25
    min_break_ratio: float = 0.05
    severity_low_pct: float = 33.0
    severity_high_pct: float = 66.0
    # drift and promotion
    drift_buckets: int = 10
    drift_threshold: float = 0.59
    drift_reject_above: float = 0.85
    weight_feature: float = 0.5
    weight_score: float = 0.3
    weight_threshold: float = 0.2
    psi_cap: float = 0.5
    # cadence
    train_days: float = 14.0
    retention_days: float = 28.0

    def fingerprint(self) -> dict[str, float]:
        """The entries two models must share to be comparable."""
        names = (
            "window_minutes",
            "min_requests",
            "neighbours",
            "break_z",
            "min_path_samples",
            "min_ratio_length",
            "min_break_urls",
            "min_break_ratio",
            "alert_pct",
            "catastrophic_pct",
            "z_clip",
            "score_low_pct",
            "score_high_pct",
        )
        return {name: float(getattr(self, name)) for name in names}
