"""An access log derived from the ``events`` and ``pages`` tables.

Used by the registered queries, the tests and the bench. Every event becomes a
request to the page its id points at; one address sends long escaped queries
during odd hours, so the alert gate has something to find at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SELECT = """
SELECT e.event_id,
  TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, 12 * e.event_id) AS ts,
  '10.0.0.' || CAST(e.user_id % 8 AS STRING) AS ip,
  regexp_extract(p.url, '^[a-z]+://[^/]+([^?#]*)', 1) AS path,
  CASE WHEN e.user_id % 8 = 3 AND e.event_id % 4 <> 0 AND (e.event_id div 300) % 2 = 1
       THEN 'id=' || CAST(e.event_id AS STRING) || repeat('%27%20OR%201%3D1--', 12)
       ELSE regexp_extract(p.url, '[?]([^#]*)', 1) END AS query,
  CASE e.event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END AS status
FROM {e} e JOIN {p} p ON p.page_id = e.pid
"""


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    page_count = pages.agg(F.count("*").alias("n")).scalar()
    events = events.select(
        "event_id", "user_id", "event_type", (F.col("event_id") % page_count).alias("pid")
    )
    log = spark.sql(_SELECT, e=events, p=pages)
    # spread over all cores, however many files there are
    return log.repartition(spark.sparkContext.defaultParallelism)
