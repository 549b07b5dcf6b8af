"""Event-time alerts that carry their URLs, and corrections by late rows.

Both jobs keep, of each open window, one row per distinct URL with its counts
(``url_rollup``). That is enough for the window's features, under whatever model is active when it is
scored, and for its URL list, so no log table is read and no URL is missing.

``score_closed_windows`` holds these rows in Spark's own streaming state and scores a window once, when
the watermark passes its end; rows later than that are dropped and counted. ``score_with_corrections``
holds them in a table; a late row scores its window again, as a new version.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DetectorConfig
from ..operators.alerts import alert_context, distinct_urls, filter_alerts, ranked_urls, url_alerts, with_url_score
from ..operators.features import time_window, url_rollup, url_windows
from ..plans.model import Model
from ..plans.scoring import scored_windows
from ..operators.scoring import with_severity
from ..plans.workflows import Library
from ..session import stage, staged_inside
from ..sources.access_logs import is_good
from ..sources.alert_sink import append_alerts
from .scoring import _exists, _start, guarded, query_run

_URL = "window struct<start:timestamp,end:timestamp>, ip string, path string, query string, n bigint, errors bigint, client_errors bigint, ts timestamp"


_STORE = "spark.sql.streaming.stateStore"
_ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ON_DISK = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started in the block keep their state in RocksDB, in bounded memory.

    Spark's default holds every row of the state on the executors' heaps. Another provider that the
    session names is left as it is, and a query that goes on keeps the provider in its checkpoint.
    """
    if spark.conf.get(f"{_STORE}.providerClass", _ON_HEAP) != _ON_HEAP:
        yield
        return
    before = {key: spark.conf.get(key, None) for key in _ON_DISK}
    try:
        for key, value in _ON_DISK.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def closed_url_counts(records: DataFrame, cfg: DetectorConfig, delay: str = "10 minutes") -> DataFrame:
    """Rows of ``url_rollup`` for windows that the watermark has passed.

    The state is a row for each distinct URL of an open window, folded before the shuffle and
    spread by URL, so a loud window does not meet in one task. All rows of a window are
    emitted by the same micro-batch, as the watermark is one for all.
    """
    good = records.filter(is_good()).withWatermark("ts", delay)
    return url_rollup(good, time_window(F.col("ts"), cfg), cfg)


def alerts_of_urls(
    urls: DataFrame, scored: DataFrame, model: Model, cfg: DetectorConfig, max_urls: int | None = None, **filters
) -> DataFrame:
    """URL alerts of the flagged ones of ``scored`` windows, from the rows behind them."""
    flagged = with_severity(stage(scored.filter("anomaly_flag"), "flagged"), cfg)
    kept = filter_alerts(flagged, **filters)
    rows = urls.withColumn("window_ts", F.col("window.start")).join(
        kept.select("ip", "window_ts"), ["ip", "window_ts"], "left_semi"
    )
    worst = ranked_urls(distinct_urls(with_url_score(rows, cfg)), max_urls)
    return url_alerts(alert_context(kept, model.model_id, cfg, model.rarity_p95), worst)


def score_closed_windows(
    records: DataFrame, library: Library, cfg: DetectorConfig, out: str, checkpoint: str,
    delay: str = "10 minutes", quarantine: str | None = None, max_urls: int | None = None,
    trigger: dict | None = None, attempts: int = 3, **filters,
):
    """Alerts of each window as it closes, with all its URLs and the model active at that time."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        model = library.active()
        if model is None or batch.isEmpty():
            return
        with staged_inside(library.spark):
            urls = stage(batch, "closed-urls")
            scored = stage(scored_windows(url_windows(urls, model.profile, cfg), model, cfg), "closed-scored")
            append_alerts(alerts_of_urls(urls, scored, model, cfg, max_urls, **filters), out, batch_id, query_run(batch))

    stream = closed_url_counts(records, cfg, delay).writeStream.outputMode("append")
    stream = stream.foreachBatch(guarded(handle, quarantine, attempts)).option("checkpointLocation", checkpoint)
    with state_on_disk(records.sparkSession):  # one row for each URL: a replay of a long log has no bound
        return stream.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def _day(ts: Column) -> Column:
    """Days since 1970, in UTC."""
    return F.floor(F.unix_seconds(ts) / 86_400).cast("int")


class CorrectedWindows:
    """Window versions in tables under ``root``; every micro-batch overwrites its own folders only.

    ``counts``: URL rows of each batch by the day they fall in, in order of time. ``progress``: the newest
    event time of each batch. ``versions``: every scored window with the batch that scored it. ``alerts``: the
    URL alerts of that version. ``too_late``: rows of windows older than ``keep``, which are not scored.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), run

    def path(self, table: str, batch_id: int | None = None) -> str:
        at = f"{self.root}/{table}/run={self.run}"
        return at if batch_id is None else f"{at}/batch_id={batch_id}"

    def write(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.path(table, batch_id))

    def write_by_day(self, df: DataFrame, table: str, batch_id: int) -> None:
        """A day's rows go to few files, however many tasks there are; a batch can hold rows of any number of days."""
        order = ["day", "window", "ip"]
        spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
        spread.write.mode("overwrite").partitionBy("day").parquet(self.path(table, batch_id))

    def watermark(self, before: int, delay: str):
        """The newest event time of earlier batches less ``delay``; null at the start."""
        if not _exists(self.spark, self.path("progress")):
            return None
        earlier = self.spark.read.schema("newest timestamp, batch_id long").parquet(self.path("progress"))
        row = earlier.filter(F.col("batch_id") < before).agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("t"))
        return row.first().t

    def due(self, upto: int, closed, closes, late: DataFrame, cfg: DetectorConfig) -> DataFrame:
        """The URL rows, added up over all batches so far, of windows that end between the two times, and of ``late`` ones.

        Only days are read that these windows can lie in.
        """
        rows = self.spark.read.schema(f"{_URL}, day int, batch_id long").parquet(self.path("counts"))
        rows = rows.filter((F.col("window.end") <= F.lit(closes)) & (F.col("batch_id") <= upto))
        if closed is not None:
            first = _day(F.lit(closed) - F.expr(f"INTERVAL {cfg.window_minutes} MINUTES"))
            days = [r.day for r in late.select("day").distinct().collect()]  # at most those of ``keep``
            again = late.select(F.col("window").alias("_window"), F.col("ip").alias("_ip"), F.lit(True).alias("_late"))
            pair = (F.col("window") == F.col("_window")) & (F.col("ip") == F.col("_ip"))
            rows = rows.filter((F.col("day") >= first) | F.col("day").isin(days)).join(again, pair, "left")
            rows = rows.filter((F.col("window.end") > F.lit(closed)) | F.col("_late"))
        return rows.groupBy("window", "ip", "path", "query").agg(
            *[F.sum(c).alias(c) for c in ("n", "errors", "client_errors")], F.min("ts").alias("ts")
        )


def score_with_corrections(
    records: DataFrame, library: Library, cfg: DetectorConfig, root: str, checkpoint: str,
    delay: str = "10 minutes", keep: str = "28 days", quarantine: str | None = None, max_urls: int | None = None,
    trigger: dict | None = None, attempts: int = 3, **filters,
):
    """Scores windows as they close, and again when late rows fall in them.

    A batch adds its URL rows to a table, then scores the windows that it closes and the (ip,
    window) pairs that were closed before and have rows in it. Each result is a version, numbered by the
    batch; ``current_windows`` and ``current_alerts`` give the newest. A window that is
    no longer flagged loses its alerts with its new version. A batch that is run again
    reads the same tables and replaces what it has written.
    """
    spark = library.spark

    def handle(batch: DataFrame, batch_id: int) -> None:
        model = library.active()
        tables = CorrectedWindows(spark, root, query_run(batch))
        with staged_inside(spark):
            closed = tables.watermark(batch_id, delay)
            good = batch.filter(is_good())
            newest = stage(good.agg(F.max("ts").alias("newest")), "newest")
            urls = stage(url_rollup(good, time_window(F.col("ts"), cfg), cfg), "batch-urls")
            urls = urls.withColumn("day", _day(F.col("window.start")))
            ends = F.col("window.end")
            late = urls.filter(F.lit(False))
            if closed is not None:
                kept_from = F.lit(closed) - F.expr(f"INTERVAL {keep}")
                tables.write_by_day(urls.filter(ends <= kept_from), "too_late", batch_id)
                urls = urls.filter(ends > kept_from)
                late = urls.filter(ends <= F.lit(closed))
            tables.write_by_day(urls, "counts", batch_id)
            tables.write(newest, "progress", batch_id)
            closes = tables.watermark(batch_id + 1, delay)
            if model is None or closes is None:
                return
            late = stage(late.select("window", "ip", "day").distinct(), "late-windows")
            due = stage(tables.due(batch_id, closed, closes, late, cfg), "due-urls")
            if due.isEmpty():
                return
            scored = stage(scored_windows(url_windows(due, model.profile, cfg), model, cfg), "due-scored")
            tables.write(scored.drop("row_key"), "versions", batch_id)
            tables.write(alerts_of_urls(due, scored, model, cfg, max_urls, **filters), "alerts", batch_id)

    return _start(records, guarded(handle, quarantine, attempts), checkpoint, trigger)


def _newest(rows: DataFrame, versions: DataFrame, window: str) -> DataFrame:
    """The rows of each window's newest version. The runs of a root are kept apart."""
    keys = ["run", "ip", "window_ts"]
    newest = versions.groupBy(*keys).agg(F.max("batch_id").alias("version"))
    at = rows.withColumn("window_ts", F.col(window))
    return at.join(newest, keys).filter(F.col("batch_id") == F.col("version")).drop(
        "version", *(["window_ts"] if window != "window_ts" else [])
    )


def current_windows(spark: SparkSession, root: str) -> DataFrame:
    """The newest version (``batch_id``) of every scored window."""
    versions = spark.read.option("basePath", f"{root}/versions").parquet(f"{root}/versions")
    return _newest(versions, versions, "window_ts")


def current_alerts(spark: SparkSession, root: str) -> DataFrame:
    """The alerts of every window's newest version."""
    versions = spark.read.option("basePath", f"{root}/versions").parquet(f"{root}/versions")
    alerts = spark.read.option("basePath", f"{root}/alerts").parquet(f"{root}/alerts")
    return _newest(alerts, versions, "window_start_utc")
