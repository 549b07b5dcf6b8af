"""Model registry as an append-only event table. One writer is assumed."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ENGINE_VERSION, FEATURE_COLUMNS, DetectorConfig
from ..schemas import REGISTRY_EVENT

# event -> status the model has afterwards
_ACTIVATING = ("approved", "rolled_back")
_STATUS = ("candidate", "approved", "rejected", "rolled_back")


class RegistryError(ValueError):
    """An event the model's current status does not allow."""


def active_model(events: DataFrame) -> DataFrame:
    """``model_id`` of the latest activation; no row when there is none."""
    latest = events.filter(F.col("event").isin(*_ACTIVATING)).agg(
        F.max_by("model_id", "seq").alias("model_id")
    )
    return latest.filter(F.col("model_id").isNotNull())


def model_list(events: DataFrame) -> DataFrame:
    """One row per model with its latest status, newest first."""
    known = events.filter(F.col("event").isin(*_STATUS))

    def first(column: str) -> Column:
        return F.min_by(column, "seq").alias(column)

    return (
        known.groupBy("model_id")
        .agg(
            F.max_by("event", "seq").alias("status"),
            F.min("at").alias("created_at"),
            F.min("seq").alias("created_seq"),
            *[first(c) for c in ("train_window_start", "train_window_end", "n_train_windows",
                                 "fused_threshold", "catastrophic_threshold", "version")],
        )
        .orderBy(F.desc("created_at"), F.desc("created_seq"))
    )


def next_model_number(events: DataFrame) -> DataFrame:
    """Registered models so far, plus one; a skipped training registers nothing."""
    registered = F.when(F.col("event") == "candidate", F.col("model_id"))
    return events.agg((F.count_distinct(registered) + 1).alias("next_number"))


def compatibility(events: DataFrame, cfg: DetectorConfig, model_id: str | None = None) -> DataFrame:
    """``(model_id, item, saved, current)`` for each entry in which a saved model differs."""
    saved_rows = events.filter(F.col("event") == "candidate")
    if model_id is not None:
        saved_rows = saved_rows.filter(F.col("model_id") == model_id)
    current = {"version": ENGINE_VERSION, "features": ",".join(FEATURE_COLUMNS)}
    current.update({k: str(v) for k, v in cfg.fingerprint().items()})
    now = F.create_map(*[F.lit(text) for pair in sorted(current.items()) for text in pair])
    saved = F.map_concat(
        F.create_map(
            F.lit("version"), F.col("version"),
            F.lit("features"), F.array_join("features", ","),
        ),
        F.transform_values("config", lambda _, v: v.cast("string")),
    )
    both = saved_rows.select("model_id", saved.alias("saved"), now.alias("current"))
    items = F.array_union(F.map_keys("saved"), F.map_keys("current"))
    entry = both.select("*", F.explode(items).alias("item")).select(
        "model_id", "item",
        F.try_element_at("saved", F.col("item")).alias("saved"),
        F.try_element_at("current", F.col("item")).alias("current"),
    )
    return entry.filter(~F.col("saved").eqNullSafe(F.col("current")))


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _path(self) -> str:
        return f"{self.root}/events"

    def events(self) -> DataFrame:
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path)
        fs = hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(hadoop_path):
            return self.spark.createDataFrame([], REGISTRY_EVENT)
        return self.spark.read.schema(REGISTRY_EVENT).parquet(self._path)

    def record(self, steps: list[tuple[str, str, dict]]) -> None:
        """Append ``(event, model_id, fields)`` in their order, all or, if one is not allowed, none.

        However many steps there are, the history is read once and one file is written, so
        long histories should come as few calls. A step sees those before it.
        """
        wanted = sorted({model_id for event, model_id, _ in steps if event != "skipped"})
        frame = self.spark.createDataFrame([(m,) for m in wanted], "model_id string")
        states = self.events().agg(F.coalesce(F.max("seq"), F.lit(0)).alias("top")).withColumn("model_id", F.lit(None).cast("string"))
        named = F.col("event").isin(*_STATUS)
        known = self.events().filter(named).join(F.broadcast(frame), "model_id", "left_semi").groupBy("model_id").agg(
            F.max_by("event", "seq").alias("status"), F.max(F.col("event") == "approved").alias("approved")
        )
        rows = states.unionByName(known, allowMissingColumns=True).collect()  # one row per model of the steps
        top = next(r.top for r in rows if r.top is not None)
        status = {r.model_id: r.status for r in rows if r.top is None}
        approved = {r.model_id for r in rows if r.approved}
        table = []
        for seq, (event, model_id, fields) in enumerate(steps, top + 1):
            if event in ("approved", "rejected") and status.get(model_id) != "candidate":
                raise RegistryError(f"{model_id} is not a candidate")
            if event == "rolled_back" and model_id not in approved:
                raise RegistryError(f"{model_id} was never approved")
            if event in _STATUS:
                status[model_id] = event
            if event == "approved":
                approved.add(model_id)
            row = {**fields, "seq": seq, "model_id": model_id, "event": event, "at": datetime.now(timezone.utc)}
            table.append(tuple(row.get(name) for name in REGISTRY_EVENT.names))
        self.spark.createDataFrame(table, REGISTRY_EVENT).coalesce(1).write.mode("append").parquet(self._path)

    @staticmethod
    def candidate(model_id: str, cfg: DetectorConfig, **meta) -> tuple[str, str, dict]:
        """The step that registers a model."""
        fields = {"version": ENGINE_VERSION, "features": list(FEATURE_COLUMNS), "config": cfg.fingerprint()}
        return "candidate", model_id, {**fields, **meta}

    def register(self, model_id: str, cfg: DetectorConfig, **meta) -> None:
        self.record([self.candidate(model_id, cfg, **meta)])

    def skip(self, model_id: str, **meta) -> None:
        """A training window that was looked at but too small to train on."""
        self.record([("skipped", model_id, meta)])

    def approve(self, model_id: str) -> None:
        self.record([("approved", model_id, {})])

    def reject(self, model_id: str) -> None:
        self.record([("rejected", model_id, {})])

    def rollback(self, model_id: str) -> None:
        self.record([("rolled_back", model_id, {})])

    def active_id(self) -> str | None:
        row = active_model(self.events()).first()
        return row.model_id if row else None

    def models(self) -> DataFrame:
        return model_list(self.events())

    def next_model_id(self, prefix: str = "model_v") -> str:
        return self.next_model_ids(1, prefix)[0]

    def next_model_ids(self, n: int, prefix: str = "model_v") -> list[str]:
        """The ids of the next ``n`` models, if each is registered."""
        first = next_model_number(self.events()).first().next_number
        return [f"{prefix}{first + i}" for i in range(n)]

    def compatibility(self, model_id: str, cfg: DetectorConfig) -> DataFrame:
        return compatibility(self.events(), cfg, model_id)
