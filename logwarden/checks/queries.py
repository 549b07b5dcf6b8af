"""The registered queries: one per operator, over the given tables.

All start from the access log derived in ``fixture``. Results that several queries
share (the path profile, the entity windows, a trained model) are derived once per
session and folder; ``reset()`` forgets them, as the bench does before each query.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ENGINE_VERSION, FEATURE_COLUMNS, DetectorConfig
from ..fixture import access_log
from ..functions import text as T
from ..functions.quantiles import percentile_arrays, percentile_values, unpivot
from ..functions.ranking import rank_within
from ..operators import alerts as A
from ..operators import baselines as B
from ..operators import drift as D
from ..operators import features as E
from ..operators import neighbours as N
from ..operators import scoring as S
from ..operators.forest import forest_scorer
from ..operators.mixture import with_anomaly_prob
from ..operators.scaling import collect_scaler, scale, scaler_stats
from ..plans import model as M
from ..plans import registry as R
from ..plans import scoring as P
from ..plans import workflows as J
from ..session import stage, staging_path
from ..sources import access_logs as L
from ..sources import log_table as H
from ..sources.alert_sink import append_alerts, save_alerts
from ..sources.appended_file import read_appended_file
from ..streaming import closed_windows as C
from ..streaming import scoring as X

CFG = DetectorConfig(alert_pct=95.0, catastrophic_pct=99.0, train_days=0.5, retention_days=0.5)
REQUEST = ("ts", "ip", "path", "query", "status")

_memo: dict = {}
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def reset() -> None:
    _memo.clear()


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _memo:
        _memo[key] = build()
    return _memo[key]


def query(function):
    @wraps(function)
    def run(spark, sf_dir):
        # the derived log is in UTC, and so are the JSON events written from it
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _queries[function.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


# --- shared derivations -------------------------------------------------------


def _text(spark, sf):
    return T.with_request_text(access_log(spark, sf))


def _profile(spark, sf) -> B.PathProfile:
    return _once(spark, sf, "profile", lambda: B.build_profile(access_log(spark, sf), CFG))


def _first_slice(spark, sf) -> DataFrame:
    return H.with_slices(access_log(spark, sf), CFG.train_days).filter("slice = 0").drop("slice")


def _first_profile(spark, sf) -> B.PathProfile:
    return _once(spark, sf, "first", lambda: B.build_profile(_first_slice(spark, sf), CFG))


def _features(spark, sf):
    return E.request_features(access_log(spark, sf), _profile(spark, sf), CFG)


def _features_first(spark, sf):
    return E.request_features(access_log(spark, sf), _first_profile(spark, sf), CFG)


def _windows(spark, sf) -> DataFrame:
    return _once(
        spark, sf, "windows", lambda: stage(E.entity_windows(_features(spark, sf), CFG), "windows")
    )


def _keyed(spark, sf) -> DataFrame:
    return M.with_row_key(_windows(spark, sf))


def _raw(spark, sf) -> DataFrame:
    """Windows with raw scores that plain SQL can also compute.

    Features to nine digits: engines add in different orders, and drift bins
    compare values for equality.
    """
    windows = _rounded(_windows(spark, sf), 9)
    if_raw = (
        F.lit(0.2) - 0.3 * F.col("query_encoded_ratio") - 0.2 * F.col("break_ratio")
        - 0.1 * F.col("status_500_ratio") - 0.05 * F.col("path_rarity_max")
    )
    lof_raw = (
        F.lit(-1.0) - 0.1 * F.col("entropy_z_max") - 0.05 * F.col("qlen_z_max")
        - 0.5 * F.col("status_4xx_ratio")
    )
    return windows.withColumns(
        {"if_raw": F.round(if_raw, 6), "lof_raw": F.round(lof_raw, 6)}
    )


def _calibrated(spark, sf):
    return _once(spark, sf, "calibrated", lambda: S.calibrate(_raw(spark, sf), CFG))


def _gated(spark, sf) -> DataFrame:
    calibration, _ = _calibrated(spark, sf)
    return S.alert_gate(S.normalise_scores(_raw(spark, sf), calibration), calibration, CFG)


def _flagged(spark, sf) -> DataFrame:
    return _gated(spark, sf).filter("anomaly_flag")


def _alerts(spark, sf) -> DataFrame:
    return _once(
        spark, sf, "alerts", lambda: stage(S.with_severity(_flagged(spark, sf), CFG), "alerts")
    )


def _rarity_p95(spark, sf) -> float:
    got = percentile_values(_windows(spark, sf), {"path_rarity_max": [0.95]})
    return got["path_rarity_max", 0.95]


def _context(spark, sf) -> DataFrame:
    return A.alert_context(_alerts(spark, sf), "model_v1", CFG, _rarity_p95(spark, sf))


def _urls(spark, sf, n=None) -> DataFrame:
    return A.worst_urls(access_log(spark, sf), _alerts(spark, sf), CFG, n)


def _halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Windows of the first half of the log's time span, and the later ones."""
    raw = _raw(spark, sf)
    log = access_log(spark, sf)
    seconds = [F.unix_seconds(f("ts").cast("timestamp")) for f in (F.min, F.max)]
    half = F.make_dt_interval(secs=F.floor((seconds[1] - seconds[0]) / 2).cast("int"))
    middle = log.agg((F.min("ts") + half).alias("t")).scalar()
    early = F.col("window_ts") < middle
    return raw.filter(early), raw.filter(~early)


def _calibrated_halves(spark, sf):
    return _once(
        spark, sf, "halves", lambda: [S.calibrate(half, CFG) for half in _halves(spark, sf)]
    )


def _library(spark, sf) -> J.Library:
    """A library whose active model was trained on the whole log."""

    def build():
        library = J.Library(spark, staging_path(spark, "models"))
        J.bootstrap(access_log(spark, sf), library, CFG)
        return library

    return _once(spark, sf, "library", build)


def _rounded(df: DataFrame, digits: int, *wanted: str) -> DataFrame:
    """Doubles to ``digits``, other columns as they are."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c)
            for c in wanted or df.columns
        ]
    )


def _six(df: DataFrame, *wanted: str) -> DataFrame:
    return _rounded(df, 6, *wanted)


def _ntz(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"}
    )


# --- sources and sinks --------------------------------------------------------


def _raw_lines(spark, sf) -> DataFrame:
    """``(event_id, ts, status, value)``: one JSON event per request."""
    log = access_log(spark, sf)
    return log.select("event_id", "ts", "status", L.raw_json(log).alias("value"))


def _lines_folder(spark, sf, broken: bool = False) -> str:
    """A folder of line-delimited JSON; ``broken``: lines of 404s are cut short."""

    def build():
        path = staging_path(spark, "ndjson")
        lines = _raw_lines(spark, sf)
        if broken:
            cut = F.substring("value", 1, 40)
            lines = lines.withColumn(
                "value", F.when(F.col("status") == 404, cut).otherwise(F.col("value"))
            )
        lines.select("value").write.text(path)
        return path

    return _once(spark, sf, f"lines-{broken}", build)


def _chunk_files(spark, sf, arrays: Column) -> str:
    """One file per 500 events: a JSON array where ``arrays`` holds, else lines."""

    def build():
        path = staging_path(spark, "chunks")
        chunked = _raw_lines(spark, sf).withColumn("chunk", F.floor(F.col("event_id") / 500))
        as_array = chunked.filter(arrays).groupBy("chunk").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")
        )
        as_lines = chunked.filter(~arrays).select("chunk", "value")
        both = as_array.unionByName(as_lines).repartition("chunk")
        both.write.partitionBy("chunk").text(path)
        return path

    return _once(spark, sf, f"chunks-{arrays}", build)


@query
def s1_ndjson_scan(spark, sf):
    good, _ = L.read_access_logs(spark, _lines_folder(spark, sf, broken=True), "ndjson")
    return _ntz(good.select(*REQUEST))


@query
def s2_json_array_scan(spark, sf):
    good, _ = L.read_access_logs(spark, _chunk_files(spark, sf, F.lit(True)), "array")
    return _ntz(good.select(*REQUEST))


@query
def s3_layout_detection(spark, sf):
    path = _chunk_files(spark, sf, F.col("chunk") % 2 == 0)
    return L.detect_layouts(spark, path).groupBy("layout").agg(F.count("*").alias("files"))


@query
def s3_mixed_layout_scan(spark, sf):
    good, _ = L.read_access_logs(spark, _chunk_files(spark, sf, F.col("chunk") % 2 == 0))
    return _ntz(good.select(*REQUEST))


@query
def s4_event_flattening(spark, sf):
    lines = _raw_lines(spark, sf)
    without_http = F.regexp_replace("value", r',"http":\{.*\}$', "}")
    lines = lines.withColumn(
        "value", F.when(F.col("status") == 200, without_http).otherwise(F.col("value"))
    )
    return _ntz(L.flatten(L.parse_lines(lines.select("value"))))


@query
def s5_bad_record_split(spark, sf):
    good, bad = L.read_access_logs(spark, _lines_folder(spark, sf, broken=True), "ndjson")
    kinds = good.select(F.lit("good").alias("kind")).union(bad.select(F.lit("bad").alias("kind")))
    return kinds.groupBy("kind").agg(F.count("*").alias("n"))


@query
def s1_whole_lines(spark, sf):
    """Lines with text or a second object behind the first are bad; 404.0 is 404."""
    kind = F.col("event_id") % 5
    value = (
        F.when(kind == 1, F.concat("value", F.lit(" behind")))
        .when(kind == 2, F.regexp_replace("value", r'"status_code":(\d+)', '"status_code":$1.0'))
        .when(kind == 3, F.concat("value", F.lit(" "), "value"))
        .otherwise(F.col("value"))
    )
    lines = _raw_lines(spark, sf).select("event_id", value.alias("value"))
    return L.flatten(L.parse_lines(lines)).select(
        "event_id", L.is_good().alias("good"), F.when(L.is_good(), F.col("status")).alias("status")
    )


def _drain(stream: DataFrame, checkpoint: str, out: str) -> None:
    """Run what has arrived so far, one folder per micro-batch."""

    def write(batch, batch_id):
        batch.filter(L.is_good()).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    started = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    started.trigger(availableNow=True).start().awaitTermination()


@query
def s6_directory_batches(spark, sf):
    source = _lines_folder(spark, sf)
    out = staging_path(spark, "s6-out")
    _drain(X.stream_directory(spark, source, 1), staging_path(spark, "s6-ckpt"), out)
    return _ntz(spark.read.parquet(out).select(*REQUEST))


@query
def s7_watched_directory(spark, sf):
    """Two runs over one folder: the second sees only the files added in between."""
    folder, out = staging_path(spark, "s7-in"), staging_path(spark, "s7-out")
    checkpoint = staging_path(spark, "s7-ckpt")
    lines = _raw_lines(spark, sf)
    for early in (True, False):
        lines.filter((F.col("status") == 200) == early).select("value").write.mode("append").text(folder)
        _drain(X.stream_directory(spark, folder, None), checkpoint, out)
    return _ntz(spark.read.parquet(out).select(*REQUEST))


@query
def s8_appended_file(spark, sf):
    """Line files read as growing files, in byte ranges that cut through lines."""
    folder = _lines_folder(spark, sf).removeprefix("file:")
    stream = read_appended_file(spark, f"{folder}/part-*", range_bytes=100_000)
    out = staging_path(spark, "s8-out")
    _drain(L.flatten(L.parse_lines(stream)), staging_path(spark, "s8-ckpt"), out)
    return _ntz(spark.read.parquet(out).select(*REQUEST))


_SINK = ("alert_kind", "severity", "ip", "n_requests", "fused_score", "url")
_SINK_SCHEMA = "alert_kind string, severity string, ip string, n_requests bigint, fused_score double, url string"


@query
def s9_alert_sink(spark, sf):
    out = staging_path(spark, "s9-out")
    save_alerts(A.url_alerts(_context(spark, sf), _urls(spark, sf)), out)
    return spark.read.schema(_SINK_SCHEMA).json(out)


@query
def s10_alert_append(spark, sf):
    """The same micro-batch written twice, as after a retry, counts once."""
    out = staging_path(spark, "s10-out")
    alerts = A.url_alerts(_context(spark, sf), _urls(spark, sf))
    for _ in range(2):
        append_alerts(alerts, out, batch_id=0)
    return spark.read.schema(_SINK_SCHEMA).json(f"{out}/run=direct/batch_id=0")


@query
def s11_model_tables(spark, sf):
    store = M.ModelStore(spark, staging_path(spark, "s11"))
    store.write("paths", "model_v1", B.path_moments(_text(spark, sf)))
    return store.read("paths", "model_v1").select("path_norm", "cnt")


# --- scalar functions ---------------------------------------------------------


@query
def p1_path_template(spark, sf):
    return access_log(spark, sf).select("event_id", T.path_template(F.col("path")).alias("path_norm"))


@query
def p2_query_template(spark, sf):
    return access_log(spark, sf).select("event_id", T.query_template(F.col("query")).alias("query_shape"))


@query
def p3_percent_decode(spark, sf):
    return T.with_decoded(access_log(spark, sf)).select("event_id", "path_dec", "query_dec")


def _measure(name: str):
    def run(spark, sf):
        return _six(_text(spark, sf), "event_id", name)

    return run


@query
def p4_entropy(spark, sf):
    return _measure("token_entropy")(spark, sf)


@query
def p5_non_alnum_ratio(spark, sf):
    decoded = T.with_decoded(access_log(spark, sf))
    ratio = T.non_alnum_ratio(F.col("query_dec"))
    return _six(decoded.select("event_id", ratio.alias("ratio")))


@query
def p6_transition_rate(spark, sf):
    return _measure("transition_rate")(spark, sf)


@query
def p7_max_param_entropy(spark, sf):
    return _measure("max_param_entropy")(spark, sf)


@query
def p8_full_url(spark, sf):
    return access_log(spark, sf).select(
        "event_id", T.full_url(F.col("path"), F.col("query")).alias("url")
    )


@query
def p9_percent_share(spark, sf):
    return _six(_text(spark, sf), "event_id", "encoded_ratio", "query_encoded_ratio")


@query
def p10_query_size(spark, sf):
    return _text(spark, sf).select("event_id", "q_len", "param_count")


@query
def p11_gated_ratios(spark, sf):
    return _six(_text(spark, sf), "event_id", "path_non_alnum_ratio", "query_non_alnum_ratio")


@query
def p12_path_rarity(spark, sf):
    return _six(_features_first(spark, sf), "event_id", "path_rarity")


@query
def p13_structure_z(spark, sf):
    return _six(_features_first(spark, sf), "event_id", "non_alnum_z", "transition_z")


@query
def p14_query_deviation(spark, sf):
    return _six(_features_first(spark, sf), "event_id", "qlen_z", "entropy_z")


@query
def p15_grammar_break(spark, sf):
    return _features(spark, sf).select("event_id", "is_break")


@query
def p16_unseen_path(spark, sf):
    return _features_first(spark, sf).select("event_id", "is_rare_path")


@query
def p17_request_features(spark, sf):
    return _six(
        _features(spark, sf),
        "event_id", "q_len", "param_count", "is_break", "is_rare_path",
        "path_non_alnum_ratio", "query_non_alnum_ratio", "encoded_ratio", "query_encoded_ratio",
        "token_entropy", "max_param_entropy", "transition_rate", "path_rarity", "qlen_z", "entropy_z",
    )


@query
def p18_minmax_score(spark, sf):
    return _six(_calibrated(spark, sf)[1], "ip", "window_ts", "if_score", "lof_score")


@query
def p19_score_fusion(spark, sf):
    return _six(_calibrated(spark, sf)[1], "ip", "window_ts", "fused_score")


@query
def p20_relative_score(spark, sf):
    return _gated(spark, sf).select("ip", "window_ts", "relative_score")


@query
def p21_url_suspicion(spark, sf):
    decoded = T.with_decoded(access_log(spark, sf))
    return _six(decoded.select("event_id", T.url_suspicion().alias("url_score")))


@query
def p22_display_url(spark, sf):
    url = T.full_url(F.col("path"), F.col("query"))
    return access_log(spark, sf).select("event_id", T.shorten(url).alias("shown"))


# --- filters ------------------------------------------------------------------


@query
def f1_eligible_windows(spark, sf):
    return _windows(spark, sf).select("ip", "window_ts", "n_requests")


@query
def f2_flagged_windows(spark, sf):
    return _flagged(spark, sf).select("ip", "window_ts", "alert_kind")


@query
def f3_high_only(spark, sf):
    return A.filter_alerts(_alerts(spark, sf), high_only=True).select("ip", "window_ts", "severity")


@query
def f4_landed_error_only(spark, sf):
    kept = A.filter_alerts(_alerts(spark, sf), require_landed_error=True)
    return _six(kept, "ip", "window_ts", "status_500_ratio")


@query
def f5_min_relative_score(spark, sf):
    kept = A.filter_alerts(_alerts(spark, sf), min_relative_score=0.5)
    return kept.select("ip", "window_ts", "relative_score")


@query
def f6_time_range(spark, sf):
    log = access_log(spark, sf)
    return H.time_range(log, datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 18)).select("event_id", "ts")


@query
def f7_retention(spark, sf):
    return H.retained(access_log(spark, sf), CFG.retention_days).select("event_id", "ts")


@query
def f8_sampled_paths(spark, sf):
    return B.path_baseline(_profile(spark, sf).paths, CFG).select("path_norm", "n")


@query
def f9_training_size(spark, sf):
    log = H.with_slices(access_log(spark, sf), CFG.train_days)
    per_window = log.groupBy("slice", "ip", E.time_window(F.col("ts"), CFG)).agg(F.count("*").alias("n"))
    eligible = per_window.filter(F.col("n") >= CFG.min_requests)
    return eligible.groupBy("slice").agg(
        F.count("*").alias("n_windows"),
        (F.count("*") >= CFG.min_train_windows).alias("trainable"),
    )


# --- joins --------------------------------------------------------------------


@query
def j1_path_popularity_join(spark, sf):
    return _features_first(spark, sf).select("event_id", "path_cnt")


@query
def j2_path_baseline_join(spark, sf):
    columns = [f"base_{m}_{part}" for m in B.MEASURES for part in ("mean", "std")]
    return _six(_features_first(spark, sf), "event_id", *columns)


@query
def j3_model_scalars(spark, sf):
    calibration, _ = _calibrated(spark, sf)
    return _six(
        _windows(spark, sf).select(
            "ip", "window_ts",
            F.lit(calibration.fused_threshold).alias("fused_threshold"),
            F.lit(calibration.catastrophic_threshold).alias("catastrophic_threshold"),
            F.lit(_rarity_p95(spark, sf)).alias("rarity_p95"),
        )
    )


def _points(spark, sf):
    def build():
        keyed = _keyed(spark, sf)
        scaled = stage(scale(keyed, collect_scaler(scaler_stats(keyed))), "scaled")
        return scaled, stage(N.weighted_points(scaled), "points"), scaled.count()

    return _once(spark, sf, "points", build)


@query
def j4_nearest_neighbours(spark, sf):
    _, points, _ = _points(spark, sf)
    queries_ = points.select(F.col("rid").alias("qid"), "x")
    pairs = N.knn_join(queries_, points, CFG.neighbours + 1)
    others = N.take_nearest(pairs.drop("share").filter("qid <> rid"), CFG.neighbours)
    return _six(others.select("qid", "rid", "distance"))


@query
def j5_histogram_join(spark, sf):
    old, new = _halves(spark, sf)
    return D.bin_counts(old, new, FEATURE_COLUMNS, CFG.drift_buckets)


def _model_slices(spark, sf) -> DataFrame:
    """Two-hour slices of the log as stand-ins for models and their reviews."""
    log = H.with_slices(access_log(spark, sf), 2.0 / 24.0)
    return log.groupBy("slice").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"),
        F.count(F.when(F.col("status") == 500, 1)).alias("errors"),
        F.count(F.when(F.col("status") == 404, 1)).alias("misses"),
    )


def _candidates(spark, sf) -> DataFrame:
    score = F.round(F.least(F.col("errors") * 3.5 / F.col("n"), F.lit(1.0)), 4)
    return _model_slices(spark, sf).select(
        F.concat(F.lit("model_"), "slice").alias("model_id"),
        (F.col("slice") > 0).alias("has_active"),
        score.alias("drift_score"),
        (score > CFG.drift_threshold).alias("requires_approval"),
        "first_ts", "misses",
    )


def _decisions(spark, sf) -> DataFrame:
    reviewed = _candidates(spark, sf).filter(F.col("misses") % 3 != 0)
    status = F.when(F.col("misses") % 2 == 0, "APPROVED").otherwise("REJECTED")
    return reviewed.select("model_id", status.alias("status"), F.col("first_ts").alias("at"))


def _promotion(spark, sf, mode: str) -> DataFrame:
    return D.promotion_decision(_candidates(spark, sf), _decisions(spark, sf), mode, CFG)


@query
def j6_analyst_decisions(spark, sf):
    return _promotion(spark, sf, "table").select("model_id", "drift_score", "analyst_status")


# --- aggregations -------------------------------------------------------------


@query
def a1_path_popularity(spark, sf):
    return B.path_moments(_text(spark, sf)).select("path_norm", "cnt")


@query
def a2_common_path_cutoff(spark, sf):
    return _six(B.popularity_totals(_profile(spark, sf).paths))


@query
def a3_path_baseline(spark, sf):
    return _six(B.path_baseline(B.path_moments(_text(spark, sf)), CFG))


@query
def a4_global_baseline(spark, sf):
    return _six(B.global_baseline(_profile(spark, sf).paths))


@query
def a5_entity_windows(spark, sf):
    return _six(E.entity_windows(_features(spark, sf), CFG))


@query
def a6_query_shapes(spark, sf):
    shaped = access_log(spark, sf).select(
        "ip", E.time_window(F.col("ts"), CFG)["start"].alias("window_ts"),
        T.query_template(F.col("query")).alias("shape"),
    )
    return shaped.groupBy("ip", "window_ts").agg(
        F.count_distinct(F.when(F.col("shape") != "", F.col("shape"))).alias("shapes")
    )


@query
def a7_conditional_ratios(spark, sf):
    return _six(
        _windows(spark, sf), "ip", "window_ts", "status_500_ratio", "status_4xx_ratio",
        "break_ratio", "rare_path_ratio", "legit_path_ratio",
    )


def _evidence(spark, sf) -> DataFrame:
    return A.requests_of(access_log(spark, sf), _alerts(spark, sf), CFG)


@query
def a8_window_requests(spark, sf):
    return _evidence(spark, sf).select("event_id", "ip", "window_ts", "url")


@query
def a9_score_bounds(spark, sf):
    bounds = S.score_bounds(_raw(spark, sf), CFG)
    return _scalars(spark, dict(zip(("if_low", "if_high", "lof_low", "lof_high"), bounds)))


def _scalars(spark, values: dict[str, float]) -> DataFrame:
    return _six(spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]))


@query
def a10_thresholds(spark, sf):
    calibration, _ = _calibrated(spark, sf)
    names = ("fused_threshold", "catastrophic_threshold")
    return _scalars(spark, {n: getattr(calibration, n) for n in names})


@query
def a11_rarity_p95(spark, sf):
    return _scalars(spark, {"rarity_p95": _rarity_p95(spark, sf)})


@query
def a12_severity_cuts(spark, sf):
    got = percentile_values(_flagged(spark, sf), {"fused_score": [0.33, 0.66]})
    return _scalars(spark, {"low": got["fused_score", 0.33], "high": got["fused_score", 0.66]})


@query
def a13_scaler_stats(spark, sf):
    return _six(scaler_stats(_windows(spark, sf)))


@query
def a14_time_bounds(spark, sf):
    return H.time_bounds(access_log(spark, sf))


@query
def a15_histogram(spark, sf):
    old, new = _halves(spark, sf)
    edges = D.bin_edges(unpivot(old, FEATURE_COLUMNS), CFG.drift_buckets)
    return D.histogram(unpivot(new, FEATURE_COLUMNS), edges)


@query
def a16_decile_edges(spark, sf):
    old, _ = _halves(spark, sf)
    edges = D.bin_edges(unpivot(old, FEATURE_COLUMNS), CFG.drift_buckets)
    spread = edges.select("name", F.posexplode("edges").alias("pos", "edge"))
    return _six(spread.select("name", (F.col("pos") + 1).alias("i"), "edge"))


# --- buckets, ranks, orders ---------------------------------------------------


@query
def w1_hour_bucket(spark, sf):
    start = E.time_window(F.col("ts"), CFG)["start"]
    return access_log(spark, sf).select("event_id", start.alias("window_ts"))


@query
def w2_anchored_slices(spark, sf):
    return H.with_slices(access_log(spark, sf), CFG.train_days).select("event_id", "slice")


@query
def w3_request_rank(spark, sf):
    order = [-F.col("url_score"), F.col("ts"), F.col("event_id")]
    ranked = rank_within(_evidence(spark, sf), ["ip", "window_ts"], order, "request_rank")
    return ranked.select("event_id", F.col("request_rank").cast("int").alias("request_rank"))


@query
def w4_distinct_urls(spark, sf):
    return _six(A.distinct_urls(_evidence(spark, sf)))


@query
def w5_top_urls(spark, sf):
    return _urls(spark, sf, 3).select("ip", "window_ts", "url", "url_rank")


def _history(spark, sf) -> DataFrame:
    """A registry history: each slice's model is registered, then reviewed."""
    slices = _model_slices(spark, sf).withColumn(
        "model_id", F.concat(F.lit("model_"), "slice")
    )
    outcome = (
        F.when(F.col("misses") % 3 == 0, "approved")
        .when(F.col("misses") % 3 == 1, "rejected")
        .otherwise("skipped_review")
    )
    saved = {k: F.lit(v) for k, v in CFG.fingerprint().items()}
    saved["alert_pct"] = F.lit(90.0) + F.col("misses") % 3
    steps = F.array(
        F.struct(
            (F.col("slice") * 2 + 1).cast("bigint").alias("seq"), F.lit("candidate").alias("event"),
            F.col("first_ts").alias("at"),
        ),
        F.struct(
            (F.col("slice") * 2 + 2).cast("bigint").alias("seq"), outcome.alias("event"),
            (F.col("first_ts") + F.expr("INTERVAL 1 HOUR")).alias("at"),
        ),
    )
    return slices.select(
        "model_id", F.inline(steps),
        F.col("first_ts").alias("train_window_start"), F.col("first_ts").alias("train_window_end"),
        F.col("n").alias("n_train_windows"), F.lit(0.3).alias("fused_threshold"),
        F.lit(0.4).alias("catastrophic_threshold"), F.lit(ENGINE_VERSION).alias("version"),
        F.array(*map(F.lit, FEATURE_COLUMNS)).alias("features"),
        F.create_map(*[c for k, v in saved.items() for c in (F.lit(k), v)]).alias("config"),
    )


@query
def w6_active_model(spark, sf):
    return R.active_model(_history(spark, sf))


@query
def o1_alert_order(spark, sf):
    return A.in_alert_order(_alerts(spark, sf)).select("ip", "window_ts", "fused_score", "break_count")


@query
def o2_newest_models(spark, sf):
    return R.model_list(_history(spark, sf)).select("model_id", "created_at")


@query
def o3_history_append(spark, sf):
    path = staging_path(spark, "o3-log")
    log = H.with_slices(access_log(spark, sf), CFG.train_days)
    H.append_records(log.filter("slice = 0"), path, 0)
    H.append_records(log.filter("slice > 0"), path, 1)
    return H.read_log_table(spark, path).groupBy("dt").agg(F.count("*").alias("n"))


@query
def o4_time_order(spark, sf):
    return H.in_time_order(access_log(spark, sf)).select("event_id", "ts")


# --- models -------------------------------------------------------------------


@query
def m1_scale(spark, sf):
    scaled, _, _ = _points(spark, sf)
    named = F.arrays_zip(F.array(*map(F.lit, FEATURE_COLUMNS)).alias("feature"), "x")
    return _six(scaled.select("row_key", F.inline(named)))


@query
def m2_forest_fit(spark, sf):
    return _six(_library(spark, sf).active().forest)


@query
def m3_forest_score(spark, sf):
    model = _library(spark, sf).active()
    scorer = forest_scorer(model.forest, min(CFG.tree_sample, model.n_train_windows))
    scaled = scale(_keyed(spark, sf), model.scaler)
    return _six(scaled.select("row_key", scorer(F.col("x")).alias("if_raw")))


def _lof(spark, sf):
    def build():
        _, points, n_rows = _points(spark, sf)
        return N.fit_lof(points, n_rows, CFG.neighbours)

    return _once(spark, sf, "lof", build)


@query
def m4_lof_fit(spark, sf):
    return _six(_lof(spark, sf)[0].select("rid", "k_dist", "lrd"))


@query
def m5_lof_score(spark, sf):
    scaled, _, n_rows = _points(spark, sf)
    scored = N.score_lof(scaled, _lof(spark, sf)[0], n_rows, CFG.neighbours)
    return _six(scored.select("row_key", "lof_raw"))


@query
def m6_mixture_posterior(spark, sf):
    return with_anomaly_prob(_gated(spark, sf)).select("ip", "window_ts", "fused_score", "anomaly_prob")


@query
def m7_calibration(spark, sf):
    calibration, scored = _calibrated(spark, sf)
    return _six(
        scored.select(
            F.lit(calibration.fused_threshold).alias("fused_threshold"),
            F.lit(calibration.catastrophic_threshold).alias("catastrophic_threshold"),
            "ip", "window_ts", "if_score", "lof_score", "fused_score",
        )
    )


@query
def m8_feature_vector(spark, sf):
    vectors = E.feature_vector(_windows(spark, sf))
    return _six(vectors.select("ip", "window_ts", F.posexplode("x").alias("i", "x")))


@query
def m9_score_windows(spark, sf):
    scored = M.score_windows(_keyed(spark, sf), _library(spark, sf).active(), CFG)
    return scored.select("ip", "window_ts", "if_score", "lof_score", "fused_score")


@query
def m10_train_candidate(spark, sf):
    model = _library(spark, sf).active()
    return _six(model.training.select("ip", "window_ts", "if_score", "lof_score", "fused_score"))


# --- alerts -------------------------------------------------------------------


@query
def l1_alert_gate(spark, sf):
    return _gated(spark, sf).select(
        "ip", "window_ts", "fused_score", "anomaly_flag", "alert_kind", "relative_score"
    )


@query
def l2_severity(spark, sf):
    return _alerts(spark, sf).select("ip", "window_ts", "fused_score", "severity")


@query
def l3_signals(spark, sf):
    signalled = A.with_signals(_alerts(spark, sf), _rarity_p95(spark, sf))
    return signalled.select("ip", "window_ts", F.array_join("signal_codes", ",").alias("signal_codes"))


@query
def l4_worst_urls(spark, sf):
    return _six(_urls(spark, sf))


@query
def l5_url_alerts(spark, sf):
    context = _context(spark, sf).withColumn("codes", F.array_join("signal_codes", ","))
    urls = _urls(spark, sf)
    alerts = A.url_alerts(context, urls)
    codes = context.select("ip", F.col("window_ts").alias("window_start_utc"), F.col("codes").alias("signal_codes"))
    return alerts.join(codes, ["ip", "window_start_utc"]).select(
        "alert_kind", "severity", "ip", "window_start_utc", "n_requests", "if_score", "lof_score",
        "fused_score", "relative_score", "signal_codes", "url",
    )


@query
def l6_window_alerts(spark, sf):
    listed = A.window_alerts(_context(spark, sf), _urls(spark, sf), urls_per_part=20)
    return listed.select(
        "ip", "window_start_utc", "part", "severity",
        F.size("worst_urls").cast("bigint").alias("n_urls"),
        F.array_join("worst_urls", " ").alias("urls"),
    )


@query
def l7_alert_summary(spark, sf):
    summary = A.alert_summary(_context(spark, sf), _urls(spark, sf, 3))
    return summary.select(
        "ip", "window_label", "severity", "fused_score", "n_requests",
        F.array_join("shown_urls", " ").alias("shown_urls"),
    )


# --- drift and promotion ------------------------------------------------------


def _feature_drift(spark, sf):
    return D.feature_drift(*_halves(spark, sf), CFG)


@query
def d1_psi(spark, sf):
    return _six(_feature_drift(spark, sf), "feature", "psi")


@query
def d2_kl(spark, sf):
    return _six(_feature_drift(spark, sf), "feature", "kl")


@query
def d3_feature_drift(spark, sf):
    return _six(D.feature_drift_summary(_feature_drift(spark, sf), CFG))


def _score_drift(spark, sf):
    (_, old), (_, new) = _calibrated_halves(spark, sf)
    return D.score_drift(old, new, CFG)


@query
def d4_score_drift(spark, sf):
    return _six(_score_drift(spark, sf))


def _threshold_drift(spark, sf):
    (old, _), (new, _) = _calibrated_halves(spark, sf)
    pair = spark.range(1).select(
        F.lit(old.fused_threshold).alias("old_fused_threshold"),
        F.lit(new.fused_threshold).alias("new_fused_threshold"),
        F.lit(old.catastrophic_threshold).alias("old_catastrophic_threshold"),
        F.lit(new.catastrophic_threshold).alias("new_catastrophic_threshold"),
    )
    return D.threshold_drift(pair)


@query
def d5_threshold_drift(spark, sf):
    return _six(
        _threshold_drift(spark, sf), "fused_rel_change", "catastrophic_rel_change", "threshold_norm"
    )


@query
def d6_combined_drift(spark, sf):
    combined = D.combine_drift(
        D.feature_drift_summary(_feature_drift(spark, sf), CFG),
        _score_drift(spark, sf), _threshold_drift(spark, sf), CFG,
    )
    return combined.select("drift_score", "requires_approval", "approval_threshold")


def _decision(spark, sf, mode):
    return _promotion(spark, sf, mode).select("model_id", "drift_score", "decision")


@query
def d7_promotion_auto(spark, sf):
    return _decision(spark, sf, "auto")


@query
def d7_promotion_safe(spark, sf):
    return _decision(spark, sf, "safe")


@query
def d7_promotion_table(spark, sf):
    return _decision(spark, sf, "table")


# --- registry -----------------------------------------------------------------


def _registry_run(spark, sf) -> DataFrame:
    """A model per training slice: even ones approved, odd ones rejected, then a
    rollback to the first."""

    def build():
        registry = R.ModelRegistry(spark, staging_path(spark, "registry"))
        rows = f9_training_size(spark, sf).orderBy("slice").collect()
        steps = []
        for row, model_id in zip(rows, registry.next_model_ids(len(rows)), strict=True):
            steps.append(registry.candidate(model_id, CFG, n_train_windows=row.n_windows))
            steps.append(("approved" if row.slice % 2 == 0 else "rejected", model_id, {}))
        registry.record([*steps, ("rolled_back", "model_v1", {})])
        return registry

    return _once(spark, sf, "registry", build)


def _events(spark, sf, event: str) -> DataFrame:
    return _registry_run(spark, sf).events().filter(F.col("event") == event)


@query
def r1_register_candidate(spark, sf):
    return _events(spark, sf, "candidate").select("model_id", "n_train_windows")


@query
def r2_approve(spark, sf):
    return _events(spark, sf, "approved").select("model_id")


@query
def r3_reject(spark, sf):
    return _events(spark, sf, "rejected").select("model_id")


@query
def r4_rollback(spark, sf):
    return R.active_model(_registry_run(spark, sf).events())


@query
def r5_active_model(spark, sf):
    return R.active_model(_history(spark, sf))


@query
def r6_model_list(spark, sf):
    return R.model_list(_history(spark, sf)).select("model_id", "status", "created_at")


@query
def r7_next_model_number(spark, sf):
    return R.next_model_number(_history(spark, sf))


@query
def r8_compatibility(spark, sf):
    return R.compatibility(_history(spark, sf), CFG)


# --- workflows and streaming --------------------------------------------------


@query
def t1_bootstrap(spark, sf):
    return _library(spark, sf).registry.models().select("model_id", "status", "n_train_windows")


@query
def t2_score_batch(spark, sf):
    alerts = J.score_with_active(access_log(spark, sf), _library(spark, sf), CFG)
    shown = alerts.withColumn("signals", F.array_join("signals", "; "))
    return P.drop_join_helpers(shown).drop("generated_at")


def _backtest(spark, sf, lag: int) -> DataFrame:
    library = J.Library(spark, staging_path(spark, f"backtest-{lag}"))
    _, report = J.backtest(access_log(spark, sf), library, CFG, lag=lag, mode="auto")
    return report.select("slice", "n_records", "scored_by", "trained")


@query
def t3_backtest(spark, sf):
    return _backtest(spark, sf, 1)


@query
def t3_backtest_two_behind(spark, sf):
    return _backtest(spark, sf, 2)


@query
def t4_microbatch_scoring(spark, sf):
    out, ckpt = staging_path(spark, "t4-out"), staging_path(spark, "t4-ckpt")
    records = X.stream_directory(spark, _lines_folder(spark, sf), None)
    run = X.score_microbatches(
        records, _library(spark, sf), CFG, out, ckpt, trigger={"availableNow": True}
    )
    run.awaitTermination()
    return spark.read.schema(_SINK_SCHEMA).json(f"{out}/*/*")


def _event_time_run(spark, sf, folder: str, max_files: int | None):
    """Closed windows of a stream over ``folder``, and the finished query."""
    out = staging_path(spark, "windows-out")
    profile = _profile(spark, sf)
    model = M.Model("given", profile, {}, None, None, None, 0.0, 0, None)
    windows = X.streaming_windows(X.stream_directory(spark, folder, max_files), model, CFG)
    started = (
        windows.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", staging_path(spark, "windows-ckpt")).option("path", out)
    )
    run = started.trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(windows.schema).parquet(out), run


@query
def t5_event_time_windows(spark, sf):
    closed, _ = _event_time_run(spark, sf, _lines_folder(spark, sf), None)
    return _six(_ntz(closed))


_ALERT_ROWS = ("alert_kind", "ip", "window_start_utc", "n_requests", "fused_score", "relative_score", "url")


@query
def t5_event_time_alerts(spark, sf):
    """No log table is there to look URLs up in."""
    out = staging_path(spark, "t5-out")
    run = C.score_closed_windows(
        X.stream_directory(spark, _lines_folder(spark, sf), None), _library(spark, sf), CFG, out,
        staging_path(spark, "t5-ckpt"), trigger={"availableNow": True},
    )
    run.awaitTermination()
    schema = (
        "alert_kind string, ip string, window_start_utc timestamp, n_requests bigint, fused_score double, "
        "relative_score double, url string"
    )
    return _ntz(spark.read.schema(schema).json(f"{out}/*/*"))


def _late_arrivals(spark, sf) -> tuple[str, int]:
    """Three arrivals, newest first, and the number of files of each."""

    def build():
        folder = staging_path(spark, "t6-in")
        newest = access_log(spark, sf).agg(F.max("ts").alias("t")).scalar()
        lines = _raw_lines(spark, sf)
        fresh = F.col("ts") >= newest - F.expr("INTERVAL 2 HOURS")
        kept = F.col("ts") >= newest - F.expr("INTERVAL 4 HOURS")
        arrivals = (fresh, ~fresh & kept, ~kept)
        files = spark.sparkContext.defaultParallelism
        file = F.pmod("event_id", F.lit(files)).cast("int")
        # as many files for each arrival, or a batch would not be one arrival
        filled = lines.agg(*[F.count_distinct(F.when(part, file)) for part in arrivals]).first()
        if set(filled) - {0, files}:
            files = 1
        for part in arrivals:
            rows = lines.filter(part)
            spread = rows.repartitionById(files, file) if files > 1 else rows.coalesce(1)
            spread.select("value").write.mode("append").text(folder)
        return folder, files

    return _once(spark, sf, "late", build)


@query
def t6_late_data(spark, sf):
    """A batch is held against the watermark of the one before it, so the second arrival
    still counts and the third is too late."""
    closed, _ = _event_time_run(spark, sf, *_late_arrivals(spark, sf))
    return _six(_ntz(closed))


def _corrected(spark, sf) -> str:
    def build():
        root = staging_path(spark, "t6-corrected")
        bounds = H.time_bounds(access_log(spark, sf)).first()
        # the whole log comes late, so no window may be too old to be scored
        days = max(28, (bounds.last_ts - bounds.first_ts).days + 2) if bounds.first_ts else 28
        run = C.score_with_corrections(
            X.stream_directory(spark, *_late_arrivals(spark, sf)), _library(spark, sf), CFG, root,
            staging_path(spark, "t6-corrected-ckpt"), keep=f"{days} days", trigger={"availableNow": True},
        )
        run.awaitTermination()
        return root

    return _once(spark, sf, "corrected", build)


@query
def t6_late_corrections(spark, sf):
    """The newest version of each window holds the late rows too."""
    windows = C.current_windows(spark, _corrected(spark, sf))
    return _six(_ntz(windows.select(*E.WINDOW_COLUMNS)))


@query
def t6_corrected_alerts(spark, sf):
    alerts = C.current_alerts(spark, _corrected(spark, sf))
    return _ntz(alerts.select(*_ALERT_ROWS))


@query
def t7_ready_windows(spark, sf):
    """The first slice is already trained on; the last one is not complete."""
    log = access_log(spark, sf)
    first = log.agg(F.min("ts").alias("train_window_start"))
    events = first.select(F.lit("candidate").alias("event"), "train_window_start")
    return J.ready_windows(log, events, CFG).select("slice", "n")


@query
def t8_retrain(spark, sf):
    library = J.Library(spark, staging_path(spark, "retrain"))
    done = J.retrain(access_log(spark, sf), library, CFG, mode="auto", all_ready=True)
    return spark.createDataFrame(
        [(r["slice"], r["model_id"], r["decision"]) for r in done],
        "slice int, model_id string, decision string",
    )


@query
def t9_start_mode(spark, sf):
    """A fresh root replays the history; a second start on it resumes."""
    library = J.Library(spark, staging_path(spark, "start"))
    log = access_log(spark, sf)
    rows = []
    for attempt in (1, 2):
        mode = J.prepare_history(log, library, CFG, "auto", mode="auto")
        rows.append((attempt, mode, library.registry.active_id()))
    return spark.createDataFrame(rows, "attempt int, mode string, active_model string")


@query
def t10_alert_filters(spark, sf):
    kept = _alerts(spark, sf).filter(F.col("severity") != "LOW")
    kept = A.filter_alerts(kept, require_landed_error=True, min_relative_score=0.1)
    urls = A.worst_urls(access_log(spark, sf), stage(kept, "t10"), CFG, 5)
    return urls.select("ip", "window_ts", "url", "url_rank")
