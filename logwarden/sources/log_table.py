"""The persisted access-log table, partitioned by day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACCESS_LOG


def append_records(records: DataFrame, path: str, batch_id: int = 0, run: str = "direct") -> None:
    """Append to the history; the same batch of the same run replaces itself.

    Rows are sorted inside each task, one run per day, so time filters skip row
    groups and the records are read once and not shuffled. ``compact`` merges small files.
    """
    columns = [f.name for f in ACCESS_LOG if f.name in records.columns]
    day = records.select(*columns, F.to_date("ts").alias("dt")).sortWithinPartitions("dt", "ts")
    day.write.mode("overwrite").partitionBy("dt").parquet(f"{path}/run={run}/batch={batch_id}")


def read_log_table(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """The whole history, or what one run has added."""
    schema = T.StructType([*ACCESS_LOG.fields, T.StructField("dt", T.DateType())])
    return spark.read.schema(schema).parquet(path if run is None else f"{path}/run={run}")


def compact(spark: SparkSession, path: str, out: str, days: float | None = None) -> None:
    """Writes the history as a new table in few large files by day and time.

    With ``days`` only rows no older than that before the newest one are taken over.
    Readers move to ``out`` when it is complete; ``path`` is left as it is.
    """
    log = read_log_table(spark, path)
    if days is not None:
        log = retained(log, days)
    log = log.drop("dt").withColumn("dt", F.to_date("ts"))
    spread = log.repartitionByRange("dt", "ts").sortWithinPartitions("dt", "ts")
    spread.write.mode("overwrite").partitionBy("dt").parquet(f"{out}/run=compacted/batch=0")


def time_range(log: DataFrame, start, end) -> DataFrame:
    """Half-open range ``[start, end)``; prunes day partitions when there are any."""
    ts = F.col("ts")
    kept = log.filter((ts >= F.lit(start)) & (ts < F.lit(end)))
    if "dt" in log.columns and isinstance(start, datetime):
        first, last = start.date() - timedelta(days=1), end.date() + timedelta(days=1)
        kept = kept.filter(F.col("dt").between(F.lit(first), F.lit(last)))
    return kept


def time_bounds(log: DataFrame) -> DataFrame:
    return log.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def _days(days: float) -> Column:
    return F.make_dt_interval(secs=F.lit(float(days) * 86_400.0))


def retained(log: DataFrame, days: float) -> DataFrame:
    """Rows no older than ``days`` before the newest one."""
    newest = log.agg(F.max("ts").alias("t")).scalar()
    return log.filter(F.col("ts") >= newest - _days(days))


def slice_number(ts: Column, origin: Column, days: float) -> Column:
    """Index of the fixed-width slice a time falls in, counted from ``origin``."""
    width = F.lit(int(days * 86_400_000_000))
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(origin.cast("timestamp"))
    return F.floor(micros / width).cast("int")


def with_slices(log: DataFrame, days: float) -> DataFrame:
    """Add ``slice``: consecutive windows anchored at the earliest record."""
    origin = log.agg(F.min("ts").alias("t")).scalar()
    return log.withColumn("slice", slice_number(F.col("ts"), origin, days))


def slice_starts(log: DataFrame, days: float) -> DataFrame:
    """``(slice, slice_start, slice_end, n)``: the non-empty slices."""
    origin = log.agg(F.min("ts").alias("t")).scalar()
    counts = with_slices(log, days).groupBy("slice").agg(F.count("*").alias("n"))
    start = origin + _days(1) * F.col("slice") * F.lit(days)
    return counts.select(
        "slice", start.alias("slice_start"), (start + _days(days)).alias("slice_end"), "n"
    )


def in_time_order(log: DataFrame) -> DataFrame:
    return log.orderBy("ts")
