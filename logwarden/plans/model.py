"""Training a model and keeping it as tables, one folder per model id."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FEATURE_COLUMNS, DetectorConfig
from ..functions.quantiles import percentile_values, percentiles_by
from ..functions.text import with_request_text
from ..operators.baselines import PROFILE_TOTALS, PathProfile, build_profile, path_moments, totals_by
from ..operators.features import entity_windows, request_features
from ..operators.forest import fit_forest, fit_forests, forest_scorer, score_forests
from ..operators.neighbours import fit_lof, fit_lof_within, knn_within, lof_raw, score_lof, weighted_points
from ..operators.scaling import collect_scaler, scale, scaler_stats
from ..operators.scoring import Calibration, calibrate, normalise_scores, training_scores
from ..session import stage
from .registry import ModelRegistry

log = logging.getLogger(__name__)

_CALIBRATION = (
    "if_low", "if_high", "lof_low", "lof_high", "fused_threshold", "catastrophic_threshold",
)


class TooFewWindows(ValueError):
    """The training slice has too few entity windows for a meaningful model."""


@dataclass
class Model:
    model_id: str
    profile: PathProfile
    scaler: dict[str, tuple[float, float]]
    forest: DataFrame
    lof_reference: DataFrame
    calibration: Calibration
    rarity_p95: float
    n_train_windows: int
    training: DataFrame | None


class ModelStore:
    """Tables ``<root>/<table>/model_id=<id>``; reads touch only that folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def write(self, table: str, model_id: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{table}/model_id={model_id}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(self, table: str, model_id: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/model_id={model_id}")

    def write_each(self, table: str, rows: DataFrame, named: DataFrame) -> None:
        """``write`` for many models in one job: ``named`` gives the model id of each ``slice``."""
        rows = rows.join(F.broadcast(named), "slice").drop("slice").hint("rebalance", F.col("model_id"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("model_id").parquet(f"{self.root}/{table}")

    def read_each(self, table: str, named: DataFrame) -> DataFrame:
        """The tables of many models; a row of ``named`` gives a model id and what its rows get instead."""
        ids = [r.model_id for r in named.select("model_id").distinct().collect()]  # one row per model
        rows = self.spark.read.option("basePath", f"{self.root}/{table}").parquet(
            *[f"{self.root}/{table}/model_id={model_id}" for model_id in ids]
        )
        rows = rows.withColumn("model_id", F.col("model_id").cast("string"))
        return rows.join(F.broadcast(named), "model_id").drop("model_id")

    def load(self, model_id: str) -> Model:
        scalars = self.read("scalars", model_id).first().asDict()
        totals = {name: scalars[name] for name in PROFILE_TOTALS}
        try:
            training = self.read("training", model_id)
        except Exception:  # a model without its drift reference can still score
            log.warning("model %s has no training table; drift reads as 0", model_id)
            training = None
        return Model(
            model_id=model_id,
            profile=PathProfile(self.read("paths", model_id), totals),
            scaler=collect_scaler(self.read("scaler", model_id)),
            forest=self.read("forest", model_id),
            lof_reference=self.read("lof_reference", model_id),
            calibration=Calibration(*[scalars[c] for c in _CALIBRATION]),
            rarity_p95=scalars["rarity_p95"],
            n_train_windows=scalars["n_train_windows"],
            training=training,
        )


@dataclass(frozen=True)
class Trained:
    """What the registry and a review need of a stored model."""

    model_id: str
    calibration: Calibration
    n_train_windows: int


def with_row_key(windows: DataFrame) -> DataFrame:
    return windows.withColumn(
        "row_key", F.concat_ws("|", "ip", F.date_format("window_ts", "yyyy-MM-dd HH:mm:ss"))
    )


def train_model(
    requests: DataFrame, model_id: str, store: ModelStore, cfg: DetectorConfig
) -> Model:
    """Tables of a candidate model from the requests of one training window."""
    spark = requests.sparkSession
    moments = path_moments(with_request_text(requests, cfg.min_ratio_length))
    profile = build_profile(requests, cfg, store.write("paths", model_id, moments))

    windows = entity_windows(request_features(requests, profile, cfg), cfg)
    windows = stage(with_row_key(windows), "train-windows")
    n_rows = windows.count()
    if n_rows < cfg.min_train_windows:
        raise TooFewWindows(f"{n_rows} entity windows for {model_id}, need {cfg.min_train_windows}")

    scaler = collect_scaler(store.write("scaler", model_id, scaler_stats(windows)))
    scaled = scale(windows, scaler)
    forest = store.write("forest", model_id, fit_forest(scaled, ["row_key"], n_rows, cfg))

    points = stage(weighted_points(scaled), "lof-points")
    reference, lof_scores = fit_lof(
        points, n_rows, cfg.neighbours,
        save=lambda df: store.write("lof_reference", model_id, df),
    )
    by_vector = points.join(lof_scores.withColumnRenamed("qid", "rid"), "rid")
    if_raw = forest_scorer(forest, min(cfg.tree_sample, n_rows))
    raw = (
        scaled.join(by_vector.select("x", "lof_raw"), "x")
        .withColumn("if_raw", if_raw(F.col("x")))
        .drop("x")
    )
    raw = stage(raw, "train-raw")

    calibration, scored = calibrate(raw, cfg)
    training = store.write(
        "training", model_id,
        scored.select("ip", "window_ts", *FEATURE_COLUMNS, "if_score", "lof_score", "fused_score"),
    )
    p95 = cfg.rarity_pct / 100.0
    rarity_p95 = percentile_values(windows, {"path_rarity_max": [p95]})["path_rarity_max", p95]
    scalars = {
        **{c: float(getattr(calibration, c)) for c in _CALIBRATION},
        "rarity_p95": float(rarity_p95),
        "n_train_windows": n_rows,
        **profile.totals,
    }
    store.write("scalars", model_id, spark.createDataFrame([scalars]).coalesce(1))
    return Model(
        model_id, profile, scaler, forest, reference, calibration, rarity_p95, n_rows, training
    )


def _scalers(stats: DataFrame) -> tuple[DataFrame, dict]:
    """From ``(slice, feature, mean, std)``: a row per slice to be joined, and what ``scale`` takes of it."""
    of = [F.max(F.when(F.col("feature") == c, F.struct("mean", "std"))).alias(f"_{c}") for c in FEATURE_COLUMNS]
    return stats.groupBy("slice").agg(*of), {c: (F.col(f"_{c}")["mean"], F.col(f"_{c}")["std"]) for c in FEATURE_COLUMNS}


def train_models(
    requests: DataFrame, named: DataFrame, store: ModelStore, cfg: DetectorConfig
) -> dict[int, Trained]:
    """``train_model`` for many slices at once: the same steps and tables, in as many jobs as for one.

    ``requests`` has ``slice``, and ``named`` the model id of each. Rows, paths and windows of different slices never
    meet. A slice's windows have to fit one cell of ``neighbours``; its trees, neighbours and
    scores are found in tasks of its own.
    """
    key = "slice"
    moments = stage(path_moments(with_request_text(requests, cfg.min_ratio_length), (key,)), "paths")
    store.write_each("paths", moments, named)
    totals = stage(totals_by(moments, key), "totals")
    profile = PathProfile(moments, {c: F.col(f"_{c}") for c in PROFILE_TOTALS}, (key,))
    told = requests.join(F.broadcast(totals.select(key, *[F.col(c).alias(f"_{c}") for c in PROFILE_TOTALS])), key)
    windows = entity_windows(request_features(told, profile, cfg), cfg, (key,))
    windows = stage(with_row_key(windows), "train-windows")

    stats = stage(scaler_stats(windows, (key,)), "scaler")
    store.write_each("scaler", stats, named)
    sizes = stage(windows.groupBy(key).agg(F.count("*").cast("int").alias("n_rows")), "sizes")
    settings, scaler = _scalers(stats)
    scaled = scale(windows.join(F.broadcast(settings.join(sizes, key)), key), scaler).drop(*[f"_{c}" for c in FEATURE_COLUMNS])
    scaled = stage(scaled, "train-scaled")
    forest = stage(fit_forests(scaled, ["row_key"], key, F.col("n_rows"), cfg), "forest")
    store.write_each("forest", forest, named)

    k = F.greatest(F.lit(1), F.least(F.lit(cfg.neighbours), F.col("n_rows") - 1))
    point = F.concat_ws("|", key, "rid")  # ids of all slices
    points = stage(weighted_points(scaled, by=(key, "n_rows")), "lof-points")
    reference, lof_scores = fit_lof_within(
        points.select(point.alias("rid"), "x", "weight", F.col(key).alias("cell"), k.alias("k"))
    )
    rid = F.expr("substring(rid, instr(rid, '|') + 1)").alias("rid")
    store.write_each("lof_reference", reference.select(F.col("cell").alias(key), rid, "x", "weight", "k_dist", "lrd"), named)
    sample = F.least(F.lit(cfg.tree_sample), F.col("n_rows")).alias("sample")
    if_raw = score_forests(points.select(key, "rid", "x", sample), forest, key)
    by_vector = points.join(if_raw, [key, "rid"]).withColumn("qid", point).join(lof_scores, "qid")
    raw = scaled.join(by_vector.select(key, "x", "lof_raw", "if_raw"), [key, "x"]).drop("x", "n_rows")
    raw = stage(raw, "train-raw")

    low, high = cfg.score_low_pct / 100.0, cfg.score_high_pct / 100.0
    bounds = percentiles_by(raw, key, {"if_raw": [low, high], "lof_raw": [low, high]})
    ends = ("if_low", "if_high", "lof_low", "lof_high")
    values = [F.col(c)[i] for c in ("if_raw", "lof_raw") for i in (0, 1)]
    bounds = stage(bounds.select(key, *[v.alias(f"_{c}") for c, v in zip(ends, values, strict=True)]), "bounds")
    scored = training_scores(raw.join(F.broadcast(bounds), key), tuple(F.col(f"_{c}") for c in ends))
    scored = stage(scored.drop(*[f"_{c}" for c in ends]), "train-scored")
    store.write_each(
        "training",
        scored.select(key, "ip", "window_ts", *FEATURE_COLUMNS, "if_score", "lof_score", "fused_score"),
        named,
    )
    thresholds = percentiles_by(scored, key, {"fused_score": [cfg.alert_pct / 100.0, cfg.catastrophic_pct / 100.0]})
    rarity = percentiles_by(windows, key, {"path_rarity_max": [cfg.rarity_pct / 100.0]})
    scalars = sizes.join(bounds, key).join(thresholds, key).join(rarity, key).join(totals, key).select(
        key,
        *[F.col(f"_{c}").alias(c) for c in ends],
        F.col("fused_score")[0].alias("fused_threshold"), F.col("fused_score")[1].alias("catastrophic_threshold"),
        F.col("path_rarity_max")[0].alias("rarity_p95"),
        F.col("n_rows").cast("long").alias("n_train_windows"),
        *PROFILE_TOTALS,
    )
    scalars = stage(scalars, "scalars")
    found = scalars.join(F.broadcast(named), key).collect()  # one row per model
    for row in found:
        if row.n_train_windows < cfg.min_train_windows:
            raise TooFewWindows(f"{row.n_train_windows} entity windows for {row.model_id}, need {cfg.min_train_windows}")
    store.write_each("scalars", scalars, named)  # last: a model that has them is complete
    return {
        row.slice: Trained(row.model_id, Calibration(*[row[c] for c in _CALIBRATION]), row.n_train_windows)
        for row in found
    }


def train_and_register(
    requests: DataFrame, start, end, store: ModelStore, registry: ModelRegistry, cfg: DetectorConfig
) -> Model:
    model_id = registry.next_model_id()
    model = train_model(requests, model_id, store, cfg)
    registry.record([candidate_step(model, start, end, cfg)])
    return model


def candidate_step(model: Model, start, end, cfg: DetectorConfig) -> tuple[str, str, dict]:
    """The registry step of a model trained on ``[start, end)``."""
    return ModelRegistry.candidate(
        model.model_id, cfg,
        train_window_start=start, train_window_end=end,
        n_train_windows=model.n_train_windows,
        fused_threshold=float(model.calibration.fused_threshold),
        catastrophic_threshold=float(model.calibration.catastrophic_threshold),
    )


def score_windows_each(windows: DataFrame, named: DataFrame, store: ModelStore, cfg: DetectorConfig) -> DataFrame:
    """``score_windows`` for many slices at once, each by the model that ``named`` gives it.

    ``windows`` has ``slice``, the calibration and ``_n_train_windows`` as columns. A slice's windows and its model's have to
    fit one cell of ``neighbours``.
    """
    key = "slice"
    settings, scaler = _scalers(store.read_each("scaler", named))
    scaled = scale(windows.join(F.broadcast(settings), key), scaler).drop(*[f"_{c}" for c in FEATURE_COLUMNS])
    scaled = stage(scaled, "score-scaled")
    n_train = F.col("_n_train_windows")
    points = stage(weighted_points(scaled, by=(key, "_n_train_windows")), "score-points")
    point = F.concat_ws("|", key, "rid")  # ids of all slices
    k = F.greatest(F.lit(1), F.least(F.lit(cfg.neighbours), n_train - 1)).cast("int")
    reference = store.read_each("lof_reference", named)
    reference = reference.select(point.alias("rid"), "x", "weight", "k_dist", "lrd", F.col(key).alias("cell"))
    asked = points.select(point.alias("qid"), "x", F.col(key).alias("cell"), k.alias("k"))
    lof_scores = lof_raw(knn_within(asked, reference), F.col("k"))
    sample = F.least(F.lit(cfg.tree_sample), n_train).cast("int").alias("sample")
    if_raw = score_forests(points.select(key, "rid", "x", sample), store.read_each("forest", named), key)
    by_vector = points.join(if_raw, [key, "rid"]).withColumn("qid", point).join(lof_scores, "qid", "left")
    raw = scaled.join(by_vector.select(key, "x", "lof_raw", "if_raw"), [key, "x"], "left").drop("x")
    return normalise_scores(raw, Calibration(*[F.col(f"_{c}") for c in _CALIBRATION]))


def raw_scores(windows: DataFrame, model: Model, cfg: DetectorConfig) -> DataFrame:
    """Add ``if_raw`` and ``lof_raw`` to windows with ``row_key``."""
    scaled = scale(windows, model.scaler)
    if_raw = forest_scorer(model.forest, min(cfg.tree_sample, model.n_train_windows))
    with_lof = score_lof(scaled, model.lof_reference, model.n_train_windows, cfg.neighbours)
    return with_lof.withColumn("if_raw", if_raw(F.col("x"))).drop("x")


def score_windows(windows: DataFrame, model: Model, cfg: DetectorConfig) -> DataFrame:
    """Windows with ``if_score``, ``lof_score`` and ``fused_score``."""
    return normalise_scores(raw_scores(windows, model, cfg), model.calibration)
