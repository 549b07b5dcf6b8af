"""Streaming scoring: per micro-batch, or per closed event-time window."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..config import DetectorConfig
from ..operators.alerts import worst_urls
from ..operators.features import request_features, shape_rollup, time_window, window_rollup
from ..plans.model import Model
from ..plans.scoring import alerts_for, flagged_windows, score_batch
from ..plans.workflows import IngestCounts, Library, log_bad_records, prepare_history
from ..session import staged_inside
from ..sources.access_logs import flatten, is_good, observed_counts, parse_lines
from ..sources.alert_sink import append_alerts
from ..sources.appended_file import current_offsets, read_appended_file, read_lines_up_to
from ..sources.log_table import append_records, read_log_table

log = logging.getLogger(__name__)


def stream_directory(spark: SparkSession, path: str, max_files: int | None = 1) -> DataFrame:
    """Parsed records of each new file of a folder; the checkpoint keeps what was seen."""
    reader = spark.readStream.format("text").option("latestFirst", "false")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return flatten(parse_lines(reader.load(path)))


def _start(stream: DataFrame, handle: Callable, checkpoint: str, trigger: dict | None):
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def query_run(batch: DataFrame) -> str:
    """The id of the query behind a micro-batch: a restart keeps it, a new checkpoint does not."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def guarded(handle: Callable, quarantine: str | None, attempts: int = 3, pause: float = 1.0) -> Callable:
    """A batch is tried ``attempts`` times; then it is set aside with its rows, and the stream goes on.

    Without ``quarantine`` the last failure stops the stream, which repeats the
    batch when it is started again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(attempts):
            try:
                return handle(batch, batch_id)
            except Exception as error:
                log.exception("batch %s failed, attempt %s", batch_id, attempt + 1)
                if attempt + 1 < attempts:
                    time.sleep(pause * 2**attempt)
                elif quarantine is None:
                    raise
                else:
                    failed = batch.withColumn("error", F.lit(f"{type(error).__name__}: {error}"))
                    at = f"{quarantine}/run={query_run(batch)}/batch_id={batch_id}"
                    failed.write.mode("overwrite").parquet(at)

    return run


def replay_set_aside(spark: SparkSession, quarantine: str, handle: Callable) -> list[tuple[str, int]]:
    """Handles set-aside batches again, oldest first; returns the (run, batch id) that went well.

    ``handle`` takes (batch, batch id, run) and writes to the folders of that batch,
    so a batch that is handled twice leaves no duplicates. Batches that went well are noted in
    ``<quarantine>-done`` and left out the next time.
    """
    aside = spark.read.option("basePath", quarantine).parquet(quarantine)
    done = f"{quarantine}-done"
    keys = aside.select(F.col("run").cast("string"), F.col("batch_id").cast("int")).distinct()
    if _exists(spark, done):
        keys = keys.join(spark.read.schema("run string, batch_id int").parquet(done), ["run", "batch_id"], "left_anti")
    went_well = []
    for key in keys.orderBy("run", "batch_id").collect():  # one row per failed batch
        rows = spark.read.parquet(f"{quarantine}/run={key.run}/batch_id={key.batch_id}").drop("error")
        handle(rows, key.batch_id, key.run)
        spark.createDataFrame([key], "run string, batch_id int").write.mode("append").parquet(done)
        went_well.append((key.run, key.batch_id))
    return went_well


def batch_scorer(
    library: Library, cfg: DetectorConfig, out: str, log_table: str | None = None,
    bad_records: str | None = None, max_urls: int | None = None, **filters,
) -> Callable:
    """What is done with one micro-batch of records: ``handle(batch, batch_id, run=None)``."""

    def handle(batch: DataFrame, batch_id: int, run: str | None = None) -> None:
        run = run or query_run(batch)
        model = library.active()
        batch = batch.persist()
        try:
            with staged_inside(library.spark):
                good = batch.filter(is_good())
                if bad_records:
                    bad = batch.filter(~is_good())
                    bad.write.mode("overwrite").parquet(f"{bad_records}/run={run}/batch_id={batch_id}")
                if log_table:
                    append_records(good, log_table, batch_id, run)
                if model is not None:
                    append_alerts(score_batch(good, model, cfg, max_urls, **filters), out, batch_id, run)
        finally:
            batch.unpersist()

    return handle


def score_microbatches(
    records: DataFrame, library: Library, cfg: DetectorConfig, out: str, checkpoint: str,
    log_table: str | None = None, bad_records: str | None = None, quarantine: str | None = None,
    max_urls: int | None = None, trigger: dict | None = None, attempts: int = 3, **filters,
):
    """Each arriving batch is scored on its own, with the model active at that time.

    Good records also join the log table, from which retraining reads. Every output
    of a batch has its own folder, so a retried batch leaves no duplicates.
    """
    handle = batch_scorer(library, cfg, out, log_table, bad_records, max_urls, **filters)
    return _start(records, guarded(handle, quarantine, attempts), checkpoint, trigger)


def follow_file(
    spark: SparkSession, pattern: str, library: Library, cfg: DetectorConfig, out: str,
    checkpoint: str, log_table: str, history: str = "auto", mode: str = "safe", **options,
):
    """Catch up on what the growing file already holds, then score what is appended.

    The history step uses exactly the lines before ``start`` and keeps them as one
    run of the log table, which a restart replaces. The stream begins behind these
    lines, or at the beginning of the file if no history was used; after that its
    checkpoint decides where it goes on.
    """
    start = None
    if not _exists(spark, f"{checkpoint}/offsets") and (
        library.registry.active_id() is None or history == "replay"
    ):
        start = current_offsets(pattern)
        lines = flatten(parse_lines(read_lines_up_to(spark, pattern, start)))
        seen = Observation()
        append_records(observed_counts(lines, seen), log_table, run="history")
        log_bad_records(pattern, IngestCounts(seen.get["good"], seen.get["bad"]))
        prepare_history(read_log_table(spark, log_table, "history"), library, cfg, history, mode=mode)
    records = flatten(parse_lines(read_appended_file(spark, pattern, start=start)))
    return score_microbatches(records, library, cfg, out, checkpoint, log_table, **options)


def streaming_windows(
    records: DataFrame, model: Model, cfg: DetectorConfig, delay: str = "10 minutes"
) -> DataFrame:
    """Entity windows by event time, emitted once the watermark has passed their end.

    Two chained aggregations: the state holds one fixed-size row per query shape
    of an open window, never a collected set, and a loud window is spread out.
    """
    good = records.filter(is_good()).withWatermark("ts", delay)
    features = request_features(good, model.profile, cfg)
    shapes = shape_rollup(features, time_window(F.col("ts"), cfg), cfg)
    return window_rollup(shapes, cfg)


def score_event_time(
    records: DataFrame, library: Library, cfg: DetectorConfig, out: str, checkpoint: str,
    requests: Callable[[], DataFrame], delay: str = "10 minutes", quarantine: str | None = None,
    max_urls: int | None = None, trigger: dict | None = None, attempts: int = 3, **filters,
):
    """Score windows as they close, so a window split over batches is counted whole.

    ``requests`` gives the log table; the URLs of flagged windows are read from it. A
    window whose requests are not there yet gives an alert without a URL, marked
    ``urls_pending``; ``pending_url_alerts`` completes these later.
    The window features use the model active at the start of the query; restart the
    query after a promotion.
    """
    model = library.active()
    windows = streaming_windows(records, model, cfg, delay)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with staged_inside(library.spark):
            flagged = flagged_windows(batch, model, cfg)
            alerts = alerts_for(requests(), flagged, model, cfg, max_urls, keep_pending=True, **filters)
            append_alerts(alerts, out, batch_id, query_run(batch))

    stream = windows.writeStream.outputMode("append").foreachBatch(guarded(handle, quarantine, attempts))
    stream = stream.option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def pending_url_alerts(alerts: DataFrame, requests: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """The URL alerts of pending ones whose requests have arrived in the log since."""
    pending = alerts.filter("urls_pending").drop("url", "url_score", "first_ts", "urls_pending")
    windows = pending.withColumn("window_ts", F.col("window_start_utc").cast("timestamp"))
    requests = requests.withColumn("ts", F.col("ts").cast("timestamp"))
    return windows.join(worst_urls(requests, windows, cfg), ["ip", "window_ts"]).drop("window_ts")


class LateRowCounter(StreamingQueryListener):
    """Writes the rows that each batch dropped behind the watermark to a table.

    Register with ``spark.streams.addListener``; it counts all queries of the session.
    A batch that is reported again replaces its own row.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        if dropped:
            self._write(f"query={progress.id}/batch_id={progress.batchId}", dropped)

    def _write(self, batch: str, dropped: int) -> None:
        """One small file without a Spark job, as events come faster than jobs end."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{batch}/dropped.json")
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = files.create(place, True)
        out.writeBytes(f'{{"dropped": {dropped}}}\n')
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(spark: SparkSession, path: str, query_id: str | None = None) -> int:
    """Rows dropped so far, over all batches and restarts, as ``LateRowCounter`` has written."""
    if not _exists(spark, path):
        return 0
    schema = "dropped long, query string, batch_id long"
    table = spark.read.schema(schema).option("basePath", path).json(path)
    if query_id is not None:
        table = table.filter(F.col("query") == str(query_id))
    return table.agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("n")).first().n


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
