from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logs import make_log
from logwarden.config import FEATURE_COLUMNS, DetectorConfig
from logwarden.fixture import access_log
from logwarden.operators import baselines as B
from logwarden.operators import features as E
from logwarden.functions.text import with_request_text

CFG = DetectorConfig()


def requests(n, ip="1.1.1.1", start="2024-01-01 10:00:00", path="/a/{i}", query="q={i}", step=1):
    t0 = datetime.fromisoformat(start)
    return [
        (str(t0 + timedelta(seconds=i * step)), ip, path.format(i=i), query.format(i=i), 200)
        for i in range(n)
    ]


def windows(log, cfg=CFG):
    return E.entity_windows(E.request_features(log, B.build_profile(log, cfg), cfg), cfg)


def test_minimum_requests(spark):
    log = make_log(spark, requests(19, "a") + requests(20, "b"))
    assert [r.ip for r in windows(log).collect()] == ["b"]


def test_hour_boundary(spark):
    rows = requests(20) + [("2024-01-01 10:59:59.999", "1.1.1.1", "/a", "", 200)]
    rows += requests(20, start="2024-01-01 11:00:00")
    got = {r.window_ts.hour: r.n_requests for r in windows(make_log(spark, rows)).collect()}
    assert got == {10: 21, 11: 20}


def test_empty_queries(spark):
    row = windows(make_log(spark, requests(20, query=""))).first()
    assert row.query_diversity == 0 and row.q_len_max == 0 and row.token_entropy_max == 0


def test_path_needs_twenty_samples(spark):
    log = make_log(spark, requests(19, path="/few/{i}") + requests(20, path="/many/{i}"))
    moments = B.path_moments(with_request_text(log))
    assert [r.path_norm for r in B.path_baseline(moments, CFG).collect()] == ["/many/#"]


def test_global_baseline_pools_paths(spark, sf_dir):
    text = with_request_text(access_log(spark, sf_dir)).cache()
    pooled = B.global_baseline(B.path_moments(text)).first()
    direct = text.agg(F.avg("q_len").alias("m"), F.stddev_pop("q_len").alias("s")).first()
    assert pooled.qlen_mean == pytest.approx(direct.m)
    assert pooled.qlen_std == pytest.approx(max(direct.s, 1.0))


def test_empty_training_log(spark):
    profile = B.build_profile(make_log(spark, []), CFG)
    assert profile.totals["total"] == 0 and profile.totals["common_cutoff"] == 0
    assert profile.totals["qlen_std"] == 1.0 and profile.totals["entropy_std"] == 0.5


def test_never_seen_path(spark):
    profile = B.build_profile(make_log(spark, requests(30)), CFG)
    log = make_log(spark, requests(1, path="/other/long") + requests(1, path="/new"))
    got = {r.path: r for r in E.request_features(log, profile, CFG).collect()}
    assert got["/other/long"].is_rare_path and not got["/new"].is_rare_path
    assert got["/new"].path_rarity == pytest.approx(np.log10(31))


def test_break_rules(spark):
    profile = B.build_profile(make_log(spark, requests(30, query="page={i}")), CFG)
    rows = [
        ("2024-01-01 10:00:00", "x", "/a/1", "y" * 201, 200),
        ("2024-01-01 10:00:00", "x", "/a/2", "y" * 200, 200),
        ("2024-01-01 10:00:00", "x", "/..//..//", "", 200),
        ("2024-01-01 10:00:00", "x", "/a/3", "'\"<>;--()", 200),
    ]

    def breaks(cfg):
        features = E.request_features(make_log(spark, rows), profile, cfg)
        return {r.path for r in features.filter("is_break").collect()}

    assert breaks(CFG) == {"/a/1", "/a/2", "/..//..//", "/a/3"}
    # deviations are clipped at 20, so only the length and path rules are left
    assert breaks(DetectorConfig(break_z=20.0)) == {"/a/1", "/..//..//"}


def test_layout_does_not_matter(spark, sf_dir):
    log = access_log(spark, sf_dir)
    order = ["ip", "window_ts"]
    plain = windows(log).orderBy(*order).toPandas()
    shuffled = windows(log.repartition(13, "query")).orderBy(*order).toPandas()
    assert list(plain["ip"]) == list(shuffled["ip"])
    for c in FEATURE_COLUMNS:
        np.testing.assert_allclose(plain[c], shuffled[c], rtol=1e-12, atol=1e-12)


def test_many_paths_without_broadcast(spark, sf_dir):
    log = access_log(spark, sf_dir)
    expected = windows(log).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = windows(log)
        assert "BroadcastHashJoin [path_norm" not in frame._jdf.queryExecution().toString()
        assert frame.count() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_vector_order(spark, sf_dir):
    row = E.feature_vector(windows(access_log(spark, sf_dir))).first()
    assert row.x == [float(row[c]) for c in FEATURE_COLUMNS]
