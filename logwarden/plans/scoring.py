"""Scoring a batch of requests with a stored model."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..operators.alerts import (
    alert_context,
    alert_summary,
    filter_alerts,
    url_alerts,
    window_alerts,
    worst_urls,
)
from ..operators.baselines import PROFILE_TOTALS, PathProfile
from ..operators.features import entity_windows, request_features
from ..operators.mixture import with_anomaly_prob
from ..operators.scoring import Calibration, alert_gate, with_severity, with_severity_by
from ..session import stage
from .model import Model, ModelStore, score_windows, score_windows_each, with_row_key


def scored_windows(windows: DataFrame, model: Model, cfg: DetectorConfig) -> DataFrame:
    """Scores, gate and posterior. Windows and scores are stored in between: both
    are read several times and are tiny next to the requests."""
    windows = stage(with_row_key(windows), "windows")
    scored = stage(score_windows(windows, model, cfg), "scored")
    return alert_gate(with_anomaly_prob(scored), model.calibration, cfg)


def flagged_windows(windows: DataFrame, model: Model, cfg: DetectorConfig) -> DataFrame:
    """Alerting windows with their severity."""
    flagged = stage(scored_windows(windows, model, cfg).filter("anomaly_flag"), "flagged")
    return with_severity(flagged, cfg)


def score_requests(requests: DataFrame, model: Model, cfg: DetectorConfig) -> DataFrame:
    """Alerting windows of a batch. The model's own path tables are used, never new ones."""
    features = request_features(requests, model.profile, cfg)
    return flagged_windows(entity_windows(features, cfg), model, cfg)


def alerts_for(
    requests: DataFrame,
    alerts: DataFrame,
    model: Model,
    cfg: DetectorConfig,
    max_urls: int | None = None,
    form: str = "url",
    keep_pending: bool = False,
    **filters,
) -> DataFrame:
    """Alert records of flagged windows: per ``url``, per ``window``, or a ``summary``."""
    kept = filter_alerts(alerts, **filters)
    context = alert_context(kept, model.model_id, cfg, model.rarity_p95)
    if form == "summary":
        return alert_summary(context, worst_urls(requests, kept, cfg, 3))
    urls = worst_urls(requests, kept, cfg, max_urls)
    return url_alerts(context, urls, keep_pending) if form == "url" else window_alerts(context, urls)


def score_batch(
    requests: DataFrame, model: Model, cfg: DetectorConfig, max_urls: int | None = None, **filters
) -> DataFrame:
    """One alert per window and distinct URL."""
    alerts = score_requests(requests, model, cfg)
    return alerts_for(requests, alerts, model, cfg, max_urls, **filters)


def score_each(
    requests: DataFrame, named: DataFrame, store: ModelStore, cfg: DetectorConfig, max_urls: int | None = None, **filters
) -> DataFrame:
    """``score_batch`` for many slices at once, in as many jobs as for one: its alerts, with ``slice``.

    ``requests`` has ``slice``; ``named`` gives the model id of each. What a slice's alerts say depends on its own rows only.
    """
    key = "slice"
    scalars = store.read_each("scalars", named).join(named.withColumnRenamed("model_id", "_model_id"), key)
    told = stage(scalars.select(key, "_model_id", *[F.col(c).alias(f"_{c}") for c in scalars.columns if c not in (key, "_model_id")]), "told")
    totals = {c: F.col(f"_{c}") for c in PROFILE_TOTALS}
    profile = PathProfile(store.read_each("paths", named), totals, (key,))
    with_totals = requests.join(F.broadcast(told.select(key, *[f"_{c}" for c in PROFILE_TOTALS])), key)
    windows = stage(with_row_key(entity_windows(request_features(with_totals, profile, cfg), cfg, (key,))), "windows")
    windows = windows.join(F.broadcast(told.drop(*[f"_{c}" for c in PROFILE_TOTALS])), key)
    scored = stage(score_windows_each(windows, named, store, cfg), "scored")
    calibration = Calibration(*[F.col(f"_{f.name}") for f in fields(Calibration)])
    gated = alert_gate(with_anomaly_prob(scored, (key,)), calibration, cfg)
    flagged = with_severity_by(stage(gated.filter("anomaly_flag"), "flagged"), key, cfg)
    kept = stage(filter_alerts(flagged, **filters), "kept")
    context = alert_context(kept, F.col("_model_id"), cfg, F.col("_rarity_p95"), (key,))
    return url_alerts(context, worst_urls(requests, kept, cfg, max_urls, (key,)), keys=(key,))


def drop_join_helpers(alerts: DataFrame) -> DataFrame:
    return alerts.drop("break_count", "url_score", "first_ts", "url_rank")
