from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from logs import make_log
from logwarden.config import FEATURE_COLUMNS, DetectorConfig
from logwarden.operators import alerts as A
from logwarden.operators import scoring as S

CFG = DetectorConfig()
CAL = S.Calibration(0.0, 1.0, 0.0, 1.0, 0.5, 0.9)


def gate(spark, rows, calibration=CAL):
    df = spark.createDataFrame(
        rows, "id int, fused_score double, break_count int, break_ratio double, status_500_ratio double"
    )
    return {r.id: r for r in S.alert_gate(df, calibration, CFG).collect()}


def test_gate_edges(spark):
    got = gate(
        spark,
        [
            (1, 0.5, 25, 0.05, 0.0), (2, 0.5, 24, 0.5, 0.0), (3, 0.5, 100, 0.0499, 0.0),
            (4, 0.4999, 100, 0.5, 0.0), (5, 0.9, 0, 0.0, 0.01), (6, 0.9, 0, 0.0, 0.0),
            (7, 0.95, 30, 0.2, 0.5),
        ],
    )
    assert [got[i].anomaly_flag for i in range(1, 8)] == [True, False, False, False, True, False, True]
    assert [got[i].alert_kind for i in (1, 5, 6, 7)] == ["burst", "catastrophic", "burst", "burst"]
    assert got[1].relative_score == 0.0 and got[5].relative_score == 1.0


def test_equal_thresholds(spark):
    same = replace(CAL, catastrophic_threshold=0.5)
    assert gate(spark, [(1, 0.6, 0, 0.0, 0.0)], same)[1].relative_score == pytest.approx(1e8)


def test_normalised_scores_stay_in_range(spark):
    df = spark.createDataFrame(
        [(5.0, -9.0, 1.0), (-5.0, 9.0, 0.0)], "if_raw double, lof_raw double, legit_path_ratio double"
    )
    rows = S.normalise_scores(df, CAL).collect()
    assert [(r.if_score, r.lof_score, r.fused_score) for r in rows] == [(0, 1, 0.25), (1, 0, 0.5)]


def test_severity(spark):
    df = spark.createDataFrame([(i / 10,) for i in range(10)], "fused_score double")
    got = {r.fused_score: r.severity for r in S.with_severity(df, CFG).collect()}
    assert got[0.0] == "LOW" and got[0.3] == "MEDIUM" and got[0.5] == "MEDIUM" and got[0.6] == "HIGH"
    assert S.with_severity(df.limit(0), CFG).collect() == []


def window_rows(spark, changes):
    base = {c: 0.0 for c in FEATURE_COLUMNS}
    base.update(n_requests=40, break_count=0, rare_path_count=0)
    return spark.createDataFrame([{**base, **values, "id": i} for i, values in enumerate(changes)])


RULES = {
    "breaks": ({"break_count": 1, "break_ratio": 0.025}, {}, "grammar-breaking URLs in window: 1 of 40 (2%)"),
    "rare_paths": ({"rare_path_count": 3}, {}, "never-before-seen paths in window: 3 of 40"),
    "query_non_alnum": ({"query_non_alnum_max": 0.1504}, {"query_non_alnum_max": 0.15}, "query non-alphanumeric char ratio (max): 0.150"),
    "path_non_alnum": ({"path_non_alnum_max": 0.2}, {"path_non_alnum_max": 0.15}, "path non-alphanumeric char ratio (max): 0.200"),
    "query_encoded": ({"query_encoded_ratio": 0.09}, {"query_encoded_ratio": 0.08}, "query pct-encoded char ratio: 0.090"),
    "query_length": ({"q_len_max": 201.0}, {"q_len_max": 200.0}, "max query length: 201 chars"),
    "token_entropy": ({"token_entropy_max": 4.01}, {"token_entropy_max": 4.0}, "query token entropy (max): 4.01"),
    "param_entropy": ({"max_param_entropy": 4.5}, {"max_param_entropy": 4.0}, "single-parameter entropy (max): 4.50"),
    "transitions": ({"transition_rate_max": 0.625}, {"transition_rate_max": 0.5}, "char-class transition rate (max): 0.62 (syntax-like structure)"),
    "errors_500": ({"status_500_ratio": 0.125}, {"status_500_ratio": 0.05}, "500-error ratio: 0.12 (possible landed payload)"),
    "errors_4xx": ({"status_4xx_ratio": 0.7}, {"status_4xx_ratio": 0.6}, "4xx-error ratio: 0.70"),
    "diversity": ({"query_diversity": 0.9}, {"query_diversity": 0.8}, "query diversity: 0.90 (many unique payload shapes)"),
    "path_rarity": ({"path_rarity_max": 2.6}, {"path_rarity_max": 2.5}, "path rarity (max): 2.60 (rare vs. training traffic)"),
    "length_deviation": ({"qlen_z_max": 3.5}, {"qlen_z_max": 3.0}, "query length deviation for this path: 3.5 std devs from this path's norm"),
    "entropy_deviation": ({"entropy_z_max": 4.0}, {"entropy_z_max": 3.0}, "query entropy deviation for this path: 4.0 std devs from this path's norm"),
    "burst_rate": ({"burst_rate": 20.5}, {"burst_rate": 20.0}, "burst rate: 20.5 req/min"),
}


def test_each_signal(spark):
    general = "general statistical URL anomaly — no single dominant signal"
    changes = [values for fires, holds, _ in RULES.values() for values in (fires, holds)]
    rows = A.with_signals(window_rows(spark, changes), 2.5).orderBy("id").collect()
    for i, (code, (_, _, text)) in enumerate(RULES.items()):
        assert rows[2 * i].signals == [text] and rows[2 * i].signal_codes == [code]
        assert rows[2 * i + 1].signals == [general]


def test_rarity_signal_needs_a_model(spark):
    row = A.with_signals(window_rows(spark, [{"path_rarity_max": 99.0}])).first()
    assert row.signal_codes == ["general"]


@pytest.fixture(scope="module")
def loud(spark):
    rows = [(f"2024-01-01 10:{i % 60:02d}:00", "a", f"/p/{i % 30}", f"q={'%27' * (i % 9)}", 500) for i in range(300)]
    rows += [("2024-01-01 10:00:00", "b", "/calm", "", 200)]
    log = make_log(spark, rows)
    return log, spark.sql("SELECT 'a' AS ip, TIMESTAMP '2024-01-01 10:00:00' AS window_ts")


def test_urls_are_distinct_and_ranked(loud):
    log, flagged = loud
    every = A.worst_urls(log, flagged, CFG).collect()
    assert len(every) == len({r.url for r in every}) and {r.ip for r in every} == {"a"}
    expected = sorted(every, key=lambda r: (-r.url_score, r.first_ts, r.url))[:7]
    top = A.worst_urls(log, flagged, CFG, 7).orderBy("url_rank").collect()
    assert [r.url for r in top] == [r.url for r in expected]


def test_top_urls_are_cut_before_the_shuffle(loud):
    log, flagged = loud
    plan = A.worst_urls(log, flagged, CFG, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_window_alerts_keep_every_url(spark, loud):
    log, flagged = loud
    urls = A.worst_urls(log, flagged, CFG)
    context = flagged.selectExpr(
        "'m' detected_by_model", "'burst' alert_kind", "'HIGH' severity", "ip", "window_ts window_start_utc",
        "60 window_minutes", "300L n_requests", "1D if_score", "1D lof_score", "1D fused_score",
        "1D relative_score", "1D anomaly_prob", "array('s') signals", "5 break_count", "window_ts",
    )
    rows = A.window_alerts(context, urls, urls_per_part=25).orderBy("part").collect()
    assert all(len(r.worst_urls) == 25 for r in rows[:-1])
    listed = [u for r in rows for u in r.worst_urls]
    assert len(listed) == urls.count() and len(set(listed)) == len(listed)


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, "HIGH", 0.0, 2.0), (2, "HIGH", 0.1, 0.5), (3, "LOW", 0.1, 2.0)],
        "id int, severity string, status_500_ratio double, relative_score double",
    )

    def ids(**filters):
        return [r.id for r in A.filter_alerts(df, **filters).orderBy("id").collect()]

    assert ids() == [1, 2, 3]
    assert ids(high_only=True) == [1, 2]
    assert ids(require_landed_error=True) == [2, 3]
    assert ids(min_relative_score=1.0) == [1, 3]
    assert ids(high_only=True, require_landed_error=True, min_relative_score=1.0) == []
