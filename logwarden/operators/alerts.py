"""Signals, URL ranking and alert records."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..functions.ranking import rank_within
from ..sources.log_table import time_range
from ..functions.text import full_url, shorten, url_suspicion, with_decoded
from .features import time_window

URLS_PER_PART = 1_000


def _num(column: str, digits: int, factor: float = 1.0) -> Column:
    return F.bround(F.col(column) * factor, digits)


def _text(pattern: str, *values: Column) -> Column:
    return F.format_string(pattern, *values)


def signal_rules(train_rarity_p95: float | None) -> list[tuple[str, Column, Column]]:
    """``(code, condition, text)`` in display order."""
    n, breaks, rare = F.col("n_requests"), F.col("break_count"), F.col("rare_path_count")
    rarity_limit = F.lit(float("inf") if train_rarity_p95 is None else train_rarity_p95)
    # Thresholds and wording of the signals.
    return [
        ("breaks", breaks > 0,
         _text("grammar-breaking URLs in window: %d of %d (%.0f%%)", breaks, n, _num("break_ratio", 0, 100.0))),
        ("rare_paths", rare > 0,
         _text("never-before-seen paths in window: %d of %d", rare, n)),
        ("query_non_alnum", F.col("query_non_alnum_max") > 0.15,
         _text("query non-alphanumeric char ratio (max): %.3f", _num("query_non_alnum_max", 3))),
        ("path_non_alnum", F.col("path_non_alnum_max") > 0.15,
         _text("path non-alphanumeric char ratio (max): %.3f", _num("path_non_alnum_max", 3))),
        ("query_encoded", F.col("query_encoded_ratio") > 0.08,
         _text("query pct-encoded char ratio: %.3f", _num("query_encoded_ratio", 3))),
        ("query_length", F.col("q_len_max") > 200,
         _text("max query length: %.0f chars", _num("q_len_max", 0))),
        ("token_entropy", F.col("token_entropy_max") > 4.0,
         _text("query token entropy (max): %.2f", _num("token_entropy_max", 2))),
        ("param_entropy", F.col("max_param_entropy") > 4.0,
         _text("single-parameter entropy (max): %.2f", _num("max_param_entropy", 2))),
        ("transitions", F.col("transition_rate_max") > 0.5,
         _text("char-class transition rate (max): %.2f (syntax-like structure)", _num("transition_rate_max", 2))),
        ("errors_500", F.col("status_500_ratio") > 0.05,
         _text("500-error ratio: %.2f (possible landed payload)", _num("status_500_ratio", 2))),
        ("errors_4xx", F.col("status_4xx_ratio") > 0.6,
         _text("4xx-error ratio: %.2f", _num("status_4xx_ratio", 2))),
        ("diversity", F.col("query_diversity") > 0.8,
         _text("query diversity: %.2f (many unique payload shapes)", _num("query_diversity", 2))),
        ("path_rarity", F.col("path_rarity_max") > rarity_limit,
         _text("path rarity (max): %.2f (rare vs. training traffic)", _num("path_rarity_max", 2))),
        ("length_deviation", F.col("qlen_z_max") > 3.0,
         _text("query length deviation for this path: %.1f std devs from this path's norm", _num("qlen_z_max", 1))),
        ("entropy_deviation", F.col("entropy_z_max") > 3.0,
         _text("query entropy deviation for this path: %.1f std devs from this path's norm", _num("entropy_z_max", 1))),
        ("burst_rate", F.col("burst_rate") > 20,
         _text("burst rate: %.1f req/min", _num("burst_rate", 1))),
    ]


# Shown when no rule fires.
_NO_SIGNAL = ("general", "general statistical URL anomaly — no single dominant signal")


def with_signals(windows: DataFrame, train_rarity_p95: float | None = None) -> DataFrame:
    """Add ``signals`` (texts) and ``signal_codes``."""
    rules = signal_rules(train_rarity_p95)

    def pick(index: int, fallback: str) -> Column:
        fired = F.array_compact(
            F.array(*[F.when(rule[1], F.lit(rule[0]) if index == 0 else rule[2]) for rule in rules])
        )
        return F.when(F.size(fired) == 0, F.array(F.lit(fallback))).otherwise(fired)

    return windows.withColumns(
        {"signal_codes": pick(0, _NO_SIGNAL[0]), "signals": pick(2, _NO_SIGNAL[1])}
    )


def requests_of(
    requests: DataFrame, windows: DataFrame, cfg: DetectorConfig, keys: tuple[str, ...] = ()
) -> DataFrame:
    """The requests behind the given ``(ip, window_ts)`` rows, with ``url_score``.

    The first and last window and their days are looked up first, so the second scan
    of the log skips other days and row groups.
    """
    wanted = windows.select(*keys, "ip", "window_ts").distinct()
    span = wanted.agg(F.min("window_ts").alias("first"), F.max("window_ts").alias("last")).first()
    if span.first is not None:
        requests = time_range(requests, span.first, span.last + timedelta(minutes=cfg.window_minutes))
    keyed = requests.withColumn("window_ts", time_window(F.col("ts"), cfg)["start"])
    return with_url_score(keyed.join(wanted, [*keys, "ip", "window_ts"], "left_semi"), cfg)


def with_url_score(requests: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Add ``url`` and ``url_score``."""
    return (
        with_decoded(requests)
        .withColumn("url", full_url(F.col("path"), F.col("query")))
        .withColumn("url_score", url_suspicion(cfg.min_ratio_length, cfg.break_query_length))
        .drop("path_dec", "query_dec")
    )


def distinct_urls(scored_requests: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per URL of a window: its best score and when that was first seen.

    Keyed by URL too, so a window with millions of requests is spread out, and
    repeats are folded before the shuffle. One URL can have two scores only when a
    path itself holds a question mark; the second step keeps the better one.
    """
    keys = [*keys, "ip", "window_ts", "url"]
    per_score = scored_requests.groupBy(*keys, "url_score").agg(F.min("ts").alias("first_ts"))
    return per_score.groupBy(*keys).agg(
        F.max("url_score").alias("url_score"),
        F.max_by("first_ts", "url_score").alias("first_ts"),
    )


def _url_order() -> list[Column]:
    return [-F.col("url_score"), F.col("first_ts"), F.col("url")]


def worst_urls(
    requests: DataFrame, windows: DataFrame, cfg: DetectorConfig, n: int | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct URLs of the windows; with ``n``, the ``n`` worst of each and their rank.

    The ranked form keeps only ``n`` rows per window and task before its shuffle
    (Spark's window group limit).
    """
    return ranked_urls(distinct_urls(requests_of(requests, windows, cfg, keys), keys), n, keys)


def ranked_urls(urls: DataFrame, n: int | None, keys: tuple[str, ...] = ()) -> DataFrame:
    """All ``urls``, or the ``n`` worst of each window and their rank."""
    if n is None:
        return urls
    order = W.partitionBy(*keys, "ip", "window_ts").orderBy(*_url_order())
    return urls.withColumn("url_rank", F.row_number().over(order)).filter(F.col("url_rank") <= n)


_CONTEXT = (
    "detected_by_model", "alert_kind", "severity", "ip", "window_start_utc", "window_minutes",
    "n_requests", "if_score", "lof_score", "fused_score", "relative_score", "anomaly_prob",
    "signals",
)


def alert_context(
    alerts: DataFrame, model_id: str | Column, cfg: DetectorConfig,
    train_rarity_p95: float | Column | None = None, keys: tuple[str, ...] = (),
) -> DataFrame:
    """The fields every alert record of a window shares, plus its join key."""
    if "anomaly_prob" not in alerts.columns:
        alerts = alerts.withColumn("anomaly_prob", F.lit(0.0))
    return with_signals(alerts, train_rarity_p95).select(
        *keys,
        F.lit(model_id).alias("detected_by_model"),
        F.col("window_ts").alias("window_start_utc"),
        F.lit(cfg.window_minutes).alias("window_minutes"),
        *[c for c in _CONTEXT if c not in ("detected_by_model", "window_start_utc", "window_minutes")],
        "break_count", "window_ts", "signal_codes",
    )


def url_alerts(
    context: DataFrame, urls: DataFrame, keep_pending: bool = False, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One alert per window and URL.

    With ``keep_pending`` a window whose URLs are not known yet gives one alert
    with a null URL, marked ``urls_pending``.
    """
    extra = [c for c in ("url", "url_score", "first_ts", "url_rank") if c in urls.columns]
    joined = context.join(urls, [*keys, "ip", "window_ts"], "left" if keep_pending else "inner")
    pending = [F.col("url").isNull().alias("urls_pending")] if keep_pending else []
    return joined.select(
        *keys, *_CONTEXT, "break_count", *extra, *pending, F.current_timestamp().alias("generated_at")
    )


def window_alerts(context: DataFrame, urls: DataFrame, urls_per_part: int = URLS_PER_PART) -> DataFrame:
    """One alert per window with its URLs, worst first.

    A row holds at most ``urls_per_part`` URLs; a window with more continues in
    further rows (``part`` = 1, 2, ...), so no URL is lost and no row is unbounded.
    """
    ranked = rank_within(urls, ["ip", "window_ts"], _url_order(), "url_rank")
    listed = (
        ranked.withColumn("part", F.floor((F.col("url_rank") - 1) / urls_per_part).cast("int") + 1)
        .groupBy("ip", "window_ts", "part")
        .agg(F.sort_array(F.collect_list(F.struct("url_rank", "url"))).alias("ranked"))
        .select(
            "ip", "window_ts", "part",
            F.transform("ranked", lambda r: r.getField("url")).alias("worst_urls"),
        )
    )
    return context.join(listed, ["ip", "window_ts"]).select(
        *_CONTEXT, "part", "worst_urls", F.current_timestamp().alias("generated_at")
    )


def alert_summary(context: DataFrame, urls: DataFrame, shown: int = 3) -> DataFrame:
    """A readable row per alert: window label, signals and the worst URLs, shortened."""
    listed = (
        urls.filter(F.col("url_rank") <= shown)
        .groupBy("ip", "window_ts")
        .agg(F.sort_array(F.collect_list(F.struct("url_rank", "url"))).alias("ranked"))
        .select(
            "ip", "window_ts",
            F.transform("ranked", lambda r: shorten(r.getField("url"))).alias("shown_urls"),
        )
    )
    return context.join(listed, ["ip", "window_ts"], "left").select(
        "detected_by_model", "severity", "fused_score", "anomaly_prob", "ip",
        F.date_format("window_ts", "yyyy-MM-dd HH:mm 'UTC'").alias("window_label"),
        "n_requests", "window_minutes", "if_score", "lof_score", "signals", "shown_urls",
    )


def filter_alerts(
    alerts: DataFrame,
    high_only: bool = False,
    require_landed_error: bool = False,
    min_relative_score: float | None = None,
) -> DataFrame:
    """The optional filters between the gate and the sink."""
    if high_only:
        alerts = alerts.filter(F.col("severity") == "HIGH")
    if require_landed_error:
        alerts = alerts.filter(F.col("status_500_ratio") > 0)
    if min_relative_score is not None:
        alerts = alerts.filter(F.col("relative_score") >= min_relative_score)
    return alerts


def in_alert_order(alerts: DataFrame) -> DataFrame:
    """Strongest first; for the sink only."""
    order = [F.desc("fused_score"), F.desc("break_count")]
    if "url_score" in alerts.columns:
        order += [F.col("ip"), F.col("window_start_utc"), F.desc("url_score"), F.col("first_ts")]
    return alerts.orderBy(*order)
