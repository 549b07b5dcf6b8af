"""Alert sinks: a whole run, or one idempotent folder per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.alerts import in_alert_order


def save_alerts(alerts: DataFrame, path: str) -> None:
    """All alerts of a run as JSON lines, strongest first."""
    in_alert_order(alerts).write.mode("overwrite").json(path)


def append_alerts(alerts: DataFrame, path: str, batch_id: int, run: str = "direct") -> None:
    """Alerts of one micro-batch of one query; a retried batch overwrites its own folder."""
    alerts.write.mode("overwrite").json(f"{path}/run={run}/batch_id={batch_id}")
