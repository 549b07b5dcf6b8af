"""Jobs: bootstrap, batch scoring, walk-forward backtest and retraining."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass, field
from functools import partial
from itertools import takewhile

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..config import FEATURE_COLUMNS, DetectorConfig
from ..operators.drift import (
    SCORE_COLUMNS,
    combine_drift,
    feature_drift,
    feature_drift_summary,
    promotion_decision,
    psi_kl_by,
    score_drift,
    score_drift_summary,
    threshold_drift,
)
from ..schemas import DECISION
from ..operators.features import time_window
from ..operators.neighbours import CELL_ROWS
from ..session import AT_ONCE, remove, side_by_side, stage, stage_partitioned, staged_inside, staging_path
from ..sources.access_logs import observed_counts, read_access_logs
from ..sources.alert_sink import save_alerts
from ..sources.log_table import (
    append_records,
    read_log_table,
    slice_starts,
    time_bounds,
    time_range,
    with_slices,
)
from .model import (
    Model,
    ModelStore,
    TooFewWindows,
    Trained,
    candidate_step,
    train_and_register,
    train_model,
    train_models,
)
from .registry import ModelRegistry
from .scoring import score_batch, score_each


log_messages = logging.getLogger(__name__)

#: Windows whose models are trained before the first of them is reviewed.
TOGETHER = 256


class NoActiveModel(LookupError):
    pass


def log_bad_records(path: str, counts: IngestCounts) -> None:
    if counts.bad:
        log_messages.warning("%s: %d records used, %d bad ones left out", path, counts.good, counts.bad)


@dataclass
class Library:
    """A model root: its tables and its registry."""

    spark: SparkSession
    root: str
    _loaded: Model | None = field(default=None, repr=False, compare=False)

    @property
    def store(self) -> ModelStore:
        return ModelStore(self.spark, self.root)

    @property
    def registry(self) -> ModelRegistry:
        return ModelRegistry(self.spark, self.root)

    def whole(self, model: Model | Trained | None) -> Model | None:
        """The tables of a model of which only the scalars are at hand."""
        return self.store.load(model.model_id) if isinstance(model, Trained) else model

    def active(self) -> Model | None:
        """The active model; it is loaded again only after another one became active."""
        model_id = self.registry.active_id()
        if model_id is None:
            return None
        if self._loaded is None or self._loaded.model_id != model_id:
            self._loaded = self.store.load(model_id)
        return self._loaded


def bootstrap(requests: DataFrame, library: Library, cfg: DetectorConfig) -> Model:
    """Train on the given requests and activate the model at once."""
    bounds = time_bounds(requests).first()
    with staged_inside(library.spark):  # all of a model is in the store
        model = train_and_register(
            requests, bounds.first_ts, bounds.last_ts, library.store, library.registry, cfg
        )
    library.registry.approve(model.model_id)
    return model


def score_with_active(
    requests: DataFrame, library: Library, cfg: DetectorConfig, **options
) -> DataFrame:
    model = library.active()
    if model is None:
        raise NoActiveModel(f"no approved model under {library.root}")
    return score_batch(requests, model, cfg, **options)


@dataclass(frozen=True)
class IngestCounts:
    good: int
    bad: int


def ingest(
    spark: SparkSession, path: str, log_table: str, layout: str = "auto", run: str | None = None
) -> tuple[DataFrame, IngestCounts]:
    """Parse JSON logs once into the day-partitioned log table.

    Returns the records this call has added, read back from the table, and how
    many were good and bad. Each call adds a run of its own, unless ``run`` names
    one to replace. ``read_log_table`` reads the whole table.
    """
    good, bad = read_access_logs(spark, path, layout)
    return _added(spark, good.unionByName(bad), log_table, run or f"ingest-{uuid.uuid4().hex}")


def _added(
    spark: SparkSession, records: DataFrame, log_table: str, run: str
) -> tuple[DataFrame, IngestCounts]:
    seen = Observation()
    append_records(observed_counts(records, seen), log_table, run=run)
    counts = seen.get
    return read_log_table(spark, log_table, run), IngestCounts(counts["good"], counts["bad"])


def score_file(
    spark: SparkSession, path: str, library: Library, cfg: DetectorConfig,
    out: str | None = None, log_table: str | None = None,
) -> DataFrame:
    """Score a log file or folder; with ``out``, also write the alerts.

    Scoring reads the requests twice (features, then the URLs of flagged windows), so the
    JSON is parsed once into columns, in ``log_table`` or a staged table. Bad records
    are counted and logged.
    """
    if log_table:
        requests, counts = ingest(spark, path, log_table)
    else:
        seen = Observation()
        good, bad = read_access_logs(spark, path)
        requests = stage(observed_counts(good.unionByName(bad), seen), "requests")
        counts = IngestCounts(seen.get["good"], seen.get["bad"])
    log_bad_records(path, counts)
    alerts = score_with_active(requests, library, cfg)
    if out:
        save_alerts(alerts, out)
    return alerts


_NO_REFERENCE = "no drift reference stored"


def compare_models(old: Model, new: Model, cfg: DetectorConfig) -> DataFrame:
    """One row: the three drift measures, the drift score, and the review flag."""
    spark = new.forest.sparkSession
    if old.training is None or new.training is None:
        feature = spark.sql(
            f"SELECT 0D AS aggregate_psi, 0D AS aggregate_kl, 0D AS feature_norm, '{_NO_REFERENCE}' AS note"
        )
        score = spark.sql("SELECT 0D AS if_psi, 0D AS lof_psi, 0D AS fused_psi, 0D AS score_norm")
    else:
        feature = feature_drift_summary(feature_drift(old.training, new.training, cfg), cfg)
        feature = feature.withColumn("note", F.lit(None).cast("string"))
        score = score_drift(old.training, new.training, cfg)
    pair = spark.createDataFrame(
        [
            (
                old.calibration.fused_threshold, new.calibration.fused_threshold,
                old.calibration.catastrophic_threshold, new.calibration.catastrophic_threshold,
            )
        ],
        "old_fused_threshold double, new_fused_threshold double, "
        "old_catastrophic_threshold double, new_catastrophic_threshold double",
    )
    return combine_drift(feature, score, threshold_drift(pair), cfg)


def review_candidate(
    candidate: Model, library: Library, cfg: DetectorConfig, mode: str,
    decisions: DataFrame | None = None,
) -> dict:
    """Apply the promotion policy to one candidate; returns what was decided."""
    registry = library.registry
    outcome = reviewed(library.active(), candidate, cfg, mode, decisions)
    if outcome["decision"] == "promote":
        registry.approve(candidate.model_id)
    elif outcome["decision"] == "reject":
        registry.reject(candidate.model_id)
    return outcome


def review_each(
    pairs: list[tuple], library: Library, cfg: DetectorConfig, mode: str, decisions: DataFrame | None = None
) -> list[dict]:
    """``reviewed`` for many pairs of stored models at once; none lacks its drift reference."""
    spark, key = library.spark, "pair"
    sides = [
        library.store.read_each("training", spark.createDataFrame(
            [(i, pair[side].model_id) for i, pair in enumerate(pairs)], f"{key} int, model_id string"
        ))
        for side in (0, 1)
    ]
    feature = feature_drift_summary(psi_kl_by(*sides, FEATURE_COLUMNS, key, cfg.drift_buckets), cfg, (key,))
    score = score_drift_summary(psi_kl_by(*sides, SCORE_COLUMNS, key, cfg.drift_buckets), cfg, (key,))
    thresholds = spark.createDataFrame(
        [
            (i, *[float(getattr(m.calibration, f"{kind}_threshold")) for kind in ("fused", "catastrophic") for m in pair])
            for i, pair in enumerate(pairs)
        ],
        f"{key} int, old_fused_threshold double, new_fused_threshold double, "
        "old_catastrophic_threshold double, new_catastrophic_threshold double",
    )
    ids = spark.createDataFrame([(i, new.model_id) for i, (_, new) in enumerate(pairs)], f"{key} int, model_id string")
    drift = combine_drift(feature, score, threshold_drift(thresholds), cfg, key).join(ids, key)
    rows = drift.select(key, "model_id", F.lit(True).alias("has_active"), "drift_score", "requires_approval")
    if decisions is None:
        decisions = spark.createDataFrame([], DECISION)
    # one row per pair
    found = {r.pair: r for r in promotion_decision(rows, decisions, mode, cfg).collect()}
    return [{"decision": found[i].decision, "drift_score": found[i].drift_score} for i in range(len(pairs))]


def reviewed(
    active: Model | None, candidate: Model, cfg: DetectorConfig, mode: str,
    decisions: DataFrame | None = None,
) -> dict:
    """What the promotion policy decides; nothing is registered."""
    if active is None:
        return {"decision": "promote", "drift_score": None}
    drift = compare_models(active, candidate, cfg).select("drift_score", "requires_approval")
    row = drift.select(
        F.lit(candidate.model_id).alias("model_id"), F.lit(True).alias("has_active"), "*"
    )
    if decisions is None:
        decisions = row.sparkSession.createDataFrame([], DECISION)
    decided = promotion_decision(row, decisions, mode, cfg).first()
    return {"decision": decided.decision, "drift_score": decided.drift_score}


def resolve_pending(
    library: Library, decisions: DataFrame, cfg: DetectorConfig
) -> list[tuple[str, str]]:
    """Apply analyst decisions to candidates that wait for one."""
    waiting = library.registry.models().filter(F.col("status") == "candidate")
    candidates = waiting.select(
        "model_id", F.lit(True).alias("has_active"),
        F.lit(None).cast("double").alias("drift_score"), F.lit(True).alias("requires_approval"),
    )
    # one row per waiting model
    rows = promotion_decision(candidates, decisions, "table", cfg).orderBy("model_id").collect()
    done = []
    for row in rows:
        if row.decision == "promote":
            library.registry.approve(row.model_id)
        elif row.decision == "reject":
            library.registry.reject(row.model_id)
        done.append((row.model_id, row.decision))
    return done


def ready_windows(log: DataFrame, events: DataFrame, cfg: DetectorConfig) -> DataFrame:
    """Complete training windows nobody has trained on yet, oldest first."""
    newest = log.agg(F.max("ts").alias("t")).scalar()
    complete = slice_starts(log, cfg.train_days).filter(F.col("slice_end") <= newest)
    seen = (
        events.filter(F.col("event").isin("candidate", "skipped"))
        .select(F.col("train_window_start").cast(complete.schema["slice_start"].dataType).alias("slice_start"))
    )
    return complete.join(seen, "slice_start", "left_anti").orderBy("slice")


def train_and_review(
    log: DataFrame, start, end, library: Library, cfg: DetectorConfig, mode: str,
    decisions: DataFrame | None = None,
) -> dict:
    """Train on ``[start, end)``, register, and apply the promotion policy."""
    registry = library.registry
    with staged_inside(library.spark):
        try:
            candidate = train_and_register(
                time_range(log, start, end), start, end, library.store, registry, cfg
            )
        except TooFewWindows:
            registry.skip(registry.next_model_id(), train_window_start=start, train_window_end=end)
            return {"model_id": None, "decision": "skipped", "drift_score": None}
        outcome = review_candidate(candidate, library, cfg, mode, decisions)
    return {"model_id": candidate.model_id, **outcome}


def retrain(
    log: DataFrame, library: Library, cfg: DetectorConfig, mode: str = "safe",
    decisions: DataFrame | None = None, all_ready: bool = False,
) -> list[dict]:
    """Train the oldest ready window, or all of them in order."""
    ready = ready_windows(log, library.registry.events(), cfg)
    if not all_ready:
        return [
            {
                "slice": r.slice,
                **train_and_review(log, r.slice_start, r.slice_end, library, cfg, mode, decisions),
            }
            for r in ready.limit(1).collect()
        ]
    windows = [(r.slice, r.slice_start, r.slice_end) for r in ready.collect()]
    if not windows:
        return []
    with staged_inside(library.spark):
        done = train_in_order(SlicedLog.of(log, cfg), windows, library, cfg, mode, decisions)
    return [{"slice": window[0], **result} for window, (_, result) in zip(windows, done, strict=True)]


@dataclass(frozen=True)
class SlicedLog:
    """A log that is read once and stored by slice, so that a slice's jobs read its own rows only."""

    spark: SparkSession
    path: str
    schema: StructType
    eligible: dict[int, int]  # entity windows of each slice that has any

    @classmethod
    def of(cls, log: DataFrame, cfg: DetectorConfig) -> SlicedLog:
        rows = with_slices(log, cfg.train_days).filter("slice IS NOT NULL")
        path = stage_partitioned(rows.repartitionByRange("slice", "ts"), "log-slices", "slice")
        stored = log.sparkSession.read.schema(rows.schema).parquet(path)
        windows = stored.groupBy("slice", time_window(F.col("ts"), cfg), "ip").agg(F.count("*").alias("n"))
        counts = windows.filter(F.col("n") >= cfg.min_requests).groupBy("slice").agg(F.count("*").alias("n"))
        # one row per slice
        return cls(log.sparkSession, path, log.schema, {r.slice: r.n for r in counts.collect()})

    def rows(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/slice={number}")

    def several(self, numbers: list[int]) -> DataFrame:
        """The rows of these slices, with ``slice``."""
        schema = StructType([*[f for f in self.schema if f.name != "slice"], StructField("slice", IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path).filter(F.col("slice").isin(numbers))

    def fits_a_cell(self, number: int) -> bool:
        return self.eligible.get(number, 0) <= CELL_ROWS


def _known(value) -> Future:
    done: Future = Future()
    done.set_result(value)
    return done


def _trained(
    log: SlicedLog, wanted: list[tuple], ids: list[str], library: Library, cfg: DetectorConfig
) -> list[Future]:
    """A model for each of the windows. Many small ones are trained by key in one go, all others side by side."""
    spark = library.spark

    def train(window: tuple, model_id: str) -> Model:
        with staged_inside(spark):  # all of a model is in the store
            return train_model(log.rows(window[0]), model_id, library.store, cfg)

    named = [(w[0], model_id) for w, model_id in zip(wanted, ids) if log.fits_a_cell(w[0])]
    made: dict[int, Trained] = {}
    if len(named) > AT_ONCE:
        try:
            with staged_inside(spark):
                frame = spark.createDataFrame(named, "slice int, model_id string")
                made = train_models(log.several([number for number, _ in named]), frame, library.store, cfg)
        except Exception:  # each on its own, so that only what cannot be trained fails
            log_messages.warning("%d slices could not be trained together", len(named), exc_info=True)
    alone = [partial(train, *each) for each in zip(wanted, ids) if each[0][0] not in made]
    others = iter(side_by_side(spark, alone))
    return [_known(made[w[0]]) if w[0] in made else next(others) for w in wanted]


def _reviews(
    pairs: list[tuple], library: Library, cfg: DetectorConfig, mode: str, decisions: DataFrame | None, review: Callable
) -> list[Future]:
    """What a review of each pair says; many small models are compared by key in one go."""
    together = [
        i for i, (old, new) in enumerate(pairs)
        if old is not None and all(
            m.n_train_windows <= CELL_ROWS and getattr(m, "training", m) is not None for m in (old, new)
        )
    ]
    made: dict[int, dict] = {}
    if len(together) > AT_ONCE:
        with staged_inside(library.spark):
            found = review_each([pairs[i] for i in together], library, cfg, mode, decisions)
        made = dict(zip(together, found, strict=True))
    alone = [partial(review, *pair) for i, pair in enumerate(pairs) if i not in made]
    others = iter(side_by_side(library.spark, alone))
    return [_known(made[i]) if i in made else next(others) for i in range(len(pairs))]


def train_in_order(
    log: SlicedLog, windows: list[tuple | None], library: Library, cfg: DetectorConfig, mode: str,
    decisions: DataFrame | None = None, score: Callable[[list[tuple[int, Model | Trained]]], None] | None = None,
) -> list[tuple[Model | None, dict]]:
    """``train_and_review`` for each window ``(slice, start, end)``; None trains nothing.

    Per window: the model active before it, and what came out. ``score`` gets the places of windows with the
    model before each. Training depends on a window's rows only, so up to ``TOGETHER`` windows are trained
    at once; then they are reviewed, each against the model before it, and scored. A
    review is made again if that model was not promoted. The registry gets all events in the windows' order.
    """
    registry, active, done = library.registry, library.active(), []
    nothing = {"model_id": None, "decision": None, "drift_score": None}

    def review(before: Model | Trained | None, model: Model | Trained) -> dict:
        with staged_inside(library.spark):
            return reviewed(library.whole(before), library.whole(model), cfg, mode, decisions)

    for at in range(0, len(windows), TOGETHER):
        part = windows[at : at + TOGETHER]
        enough = [w is not None and log.eligible.get(w[0], 0) >= cfg.min_train_windows for w in part]
        ids = registry.next_model_ids(sum(enough) + 1)  # a skipped window names the next model
        wanted = [w for w, trains in zip(part, enough, strict=True) if trains]
        training = _trained(log, wanted, ids, library, cfg)
        models = [t.result() for t in takewhile(lambda t: not t.exception(), training)]
        pairs = list(zip([active, *models], models))
        reviews = _reviews(pairs, library, cfg, mode, decisions, review)
        fitted = iter(zip(training, pairs + [None], reviews + [None]))
        steps, scoring = [], []
        try:
            for place, (window, trains) in enumerate(zip(part, enough, strict=True), at):
                before, result = active, nothing
                if score and active is not None:
                    scoring.append((place, active))
                if trains:
                    trained, pair, found = next(fitted)
                    model = trained.result()
                    result = {"model_id": model.model_id, **(found.result() if pair[0] is active else review(active, model))}
                    steps.append(candidate_step(model, *window[1:], cfg))
                    if result["decision"] == "promote":
                        steps.append(("approved", model.model_id, {}))
                        active = model
                    elif result["decision"] == "reject":
                        steps.append(("rejected", model.model_id, {}))
                elif window is not None:
                    named = ids[sum(event == "candidate" for event, *_ in steps)]
                    steps.append(("skipped", named, {"train_window_start": window[1], "train_window_end": window[2]}))
                    result = {**nothing, "decision": "skipped"}
                done.append((before, result))
        finally:
            if steps:
                registry.record(steps)
            if scoring:
                score(scoring)
    library._loaded = library.whole(active)
    return done


_REPORT = (
    "slice int, slice_start timestamp, n_records bigint, scored_by string, "
    "trained string, decision string, drift_score double"
)


def backtest(
    log: DataFrame, library: Library, cfg: DetectorConfig, lag: int = 1, mode: str = "safe",
    max_urls: int | None = None, out: str | None = None, **filters,
) -> tuple[DataFrame, DataFrame]:
    """Walk the slices in time order: score with the active model, then train.

    ``lag=1``: a slice is scored by the model of the slice before it. ``lag=2``: a
    training window only completes when a later record arrives, so each slice
    trains one step later and a gap adds to the delay. Returns ``(alerts, report)``.
    """
    if lag not in (1, 2):
        raise ValueError("lag must be 1 or 2")
    spark = log.sparkSession
    out = out or staging_path(spark, "backtest-alerts")
    # one row per slice of the time span
    slices = slice_starts(log, cfg.train_days).orderBy("slice").collect()
    if not slices:
        return spark.createDataFrame([], "slice int"), spark.createDataFrame([], _REPORT)
    width = slices[0].slice_end - slices[0].slice_start
    origin = slices[0].slice_start - slices[0].slice * width
    windows, boundary = [], 0
    for row in slices:
        if lag == 1:
            target = row.slice
        else:
            target = boundary if row.slice > boundary else None
            boundary += target is not None
        start = None if target is None else origin + target * width
        windows.append(None if target is None else (target, start, start + width))

    with staged_inside(spark):
        sliced = SlicedLog.of(log, cfg)

        def score_alone(number: int, model: Model | Trained) -> None:
            with staged_inside(spark):
                alerts = score_batch(sliced.rows(number), library.whole(model), cfg, max_urls, **filters)
                alerts.write.mode("overwrite").parquet(f"{out}/slice={number}")

        def score(wanted: list[tuple[int, Model | Trained]]) -> None:
            """Many small slices are scored by key in one go, all others side by side."""
            asked = [(slices[place].slice, model) for place, model in wanted]
            together = [(n, m) for n, m in asked if sliced.fits_a_cell(n) and m.n_train_windows <= CELL_ROWS]
            if len(together) > AT_ONCE:
                with staged_inside(spark):
                    named = [(number, model.model_id) for number, model in together]
                    named = spark.createDataFrame(named, "slice int, model_id string")
                    rows = sliced.several([number for number, _ in together])
                    alerts = stage(score_each(rows, named, library.store, cfg, max_urls, **filters), "alerts")
                    remove(spark, [f"{out}/slice={number}" for number, _ in together])
                    writer = alerts.hint("rebalance", F.col("slice")).write.mode("append").partitionBy("slice")
                    writer.parquet(out)
                    if alerts.isEmpty():  # the folder tells the columns at least
                        alerts.drop("slice").write.parquet(f"{out}/slice={together[0][0]}")
            else:
                together = []
            alone = [partial(score_alone, *each) for each in asked if each not in together]
            for scored in side_by_side(spark, alone):
                scored.result()

        done = train_in_order(sliced, windows, library, cfg, mode, score=score)
    report = [
        (row.slice, row.slice_start, row.n, model.model_id if model else None,
         result["model_id"], result["decision"], result["drift_score"])
        for row, (model, result) in zip(slices, done, strict=True)
    ]
    written = any(model for model, _ in done)
    alerts = spark.read.parquet(out) if written else spark.createDataFrame([], "slice int")
    return alerts, spark.createDataFrame(report, _REPORT)


def start_mode(library: Library, history: str = "auto") -> str:
    """``resume`` or ``replay``: an existing active model means resume."""
    if history == "auto":
        return "replay" if library.registry.active_id() is None else "resume"
    if history not in ("resume", "replay"):
        raise ValueError(f"unknown history mode {history!r}")
    return history


def prepare_history(
    log: DataFrame, library: Library, cfg: DetectorConfig, history: str = "auto",
    mode: str = "safe", **options,
) -> str:
    """Bring the library up to date before a stream starts; returns the mode used."""
    chosen = start_mode(library, history)
    if chosen == "replay":
        backtest(log, library, cfg, mode=mode, **options)
    elif library.registry.active_id() is None and not log.isEmpty():
        bootstrap(log, library, cfg)
    return chosen
