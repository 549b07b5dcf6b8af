"""Session defaults and the shared staging folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

STAGING_KEY = "spark.checkpoint.dir"
#: Jobs that run beside each other.
AT_ONCE = 16
_local_staging: list[str] = []
#: Paths staged in the scope of this thread or task; None outside of any.
_scope: ContextVar[list[str] | None] = ContextVar("staging_scope", default=None)


def build_session(app_name: str = "logwarden", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # call-site capture costs a few milliseconds per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for local sessions."""
    root = spark.conf.get(STAGING_KEY, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {STAGING_KEY} to a folder all executors share")
    if not _local_staging:
        _local_staging.append(tempfile.mkdtemp(prefix="run-logwarden-"))
    return _local_staging[0]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, outlives_scope: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    planner the table's true size: a later join is broadcast only when the
    files really are below ``spark.sql.autoBroadcastJoinThreshold``. A table that
    ``outlives_scope`` is not removed by ``staged_inside``.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    scope = _scope.get()
    if scope is not None and not outlives_scope:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, by: str) -> DataFrame:
    """As ``stage``, in as many buckets of ``by`` as the session has shuffle partitions.

    Grouping or joining the table by ``by`` moves only the other side, so wide rows are
    stored once and not shuffled.
    """
    spark = df.sparkSession
    path, scope = staging_path(spark, name), _scope.get()
    if scope is not None:
        scope.append(path)
    table = f"staged_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(table)
    rows = spark.table(table)
    rows.schema  # resolved from here on: the catalog's entry is not needed, and the files stay
    spark.sql(f"DROP TABLE {table}")
    return rows


def stage_partitioned(df: DataFrame, name: str, by: str) -> str:
    """As ``stage``, with a folder ``<by>=<value>`` for each value; returns the path."""
    path, scope = staging_path(df.sparkSession, name), _scope.get()
    if scope is not None:
        scope.append(path)
    df.write.partitionBy(by).parquet(path)
    return path


def side_by_side(spark: SparkSession, calls: list[Callable]) -> list[Future]:
    """Runs independent jobs in ``AT_ONCE`` threads and waits for all; short ones alone leave most cores idle.

    Each thread has staging scopes of its own.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Deletes folders, as far as they are there."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def staged_inside(spark: SparkSession) -> Iterator[None]:
    """Tables staged in the block are removed at its end, so results must be written by then.

    Only this thread's own tables are: jobs that run beside it in other threads have scopes
    of their own, and a scope inside another removes what was staged in it.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        remove(spark, paths)
