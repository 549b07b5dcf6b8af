import numpy as np
import pytest

from logwarden.config import DetectorConfig
from logwarden.operators import drift as D

CFG = DetectorConfig()


def numpy_drift(old, new, buckets=10):
    edges = np.unique(np.percentile(old, np.linspace(0, 100, buckets + 1)))
    if len(edges) < 3:
        return 0.0, 0.0
    e, a = (np.histogram(v, bins=edges)[0].astype(float) for v in (old, new))
    e, a = e / max(e.sum(), 1), a / max(a.sum(), 1)
    e[e == 0] = a[a == 0] = 1e-9
    return float(((a - e) * np.log(a / e)).sum()), float((a * np.log(a / e)).sum())


PAIRS = {
    "same": lambda g: (g.normal(size=400),) * 2,
    "shifted": lambda g: (g.normal(size=400), g.normal(0.7, 1, size=300)),
    "constant": lambda g: (np.full(50, 2.0), g.normal(size=40)),
    "two_values": lambda g: (g.integers(0, 2, 80).astype(float), g.normal(size=40)),
    "three_values": lambda g: (g.integers(0, 3, 80).astype(float), g.integers(0, 3, 80).astype(float)),
    "outside": lambda g: (g.uniform(0, 1, 200), g.uniform(5, 6, 100)),
    "last_edge": lambda g: (np.arange(101.0), np.full(30, 100.0)),
}


@pytest.mark.parametrize("name", PAIRS)
def test_equals_numpy(spark, name):
    old, new = PAIRS[name](np.random.default_rng(5))
    frames = [spark.createDataFrame([(float(v),) for v in xs], "v double") for xs in (old, new)]
    row = D.psi_kl(*frames, ["v"]).first()
    psi, kl = numpy_drift(old, new)
    assert row.psi == pytest.approx(psi, abs=1e-9) and row.kl == pytest.approx(kl, abs=1e-9)
    if name == "same":
        assert row.psi == 0


def test_open_ended_sees_a_shift_beyond_the_range(spark):
    old = spark.createDataFrame([(float(v),) for v in range(100)], "v double")
    new = spark.createDataFrame([(float(v),) for v in list(range(100)) + [500] * 100], "v double")
    assert D.psi_kl(old, new, ["v"]).first().psi == pytest.approx(0, abs=1e-9)
    assert D.psi_kl(old, new, ["v"], open_ended=True).first().psi > 0.3


def test_thresholds(spark):
    pair = spark.sql(
        "SELECT 0.5D old_fused_threshold, 0.6D new_fused_threshold, "
        "0.0D old_catastrophic_threshold, 0.0D new_catastrophic_threshold"
    )
    row = D.threshold_drift(pair).first()
    assert (row.fused_rel_change, row.catastrophic_rel_change) == (0.2, 0.0)
    assert row.threshold_norm == pytest.approx(0.1)


CANDIDATES = [
    ("first", False, None, None), ("calm", True, 0.59, False), ("moved", True, 0.60, True),
    ("edge", True, 0.85, True), ("wild", True, 0.86, True),
]


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("auto", ["promote"] * 5),
        ("safe", ["promote", "promote", "promote", "promote", "reject"]),
        ("table", ["promote", "promote", "promote", "reject", "pending"]),
    ],
)
def test_policy(spark, mode, expected):
    candidates = spark.createDataFrame(
        CANDIDATES, "model_id string, has_active boolean, drift_score double, requires_approval boolean"
    )
    decisions = spark.sql(
        "SELECT * FROM VALUES ('moved', 'REJECTED', TIMESTAMP '2024-01-01'), "
        "('moved', 'approved', TIMESTAMP '2024-01-02'), ('edge', 'Rejected', TIMESTAMP '2024-01-01'), "
        "('wild', 'PENDING', TIMESTAMP '2024-01-01') AS d(model_id, status, at)"
    )
    rows = D.promotion_decision(candidates, decisions, mode, CFG).collect()
    got = {r.model_id: r.decision for r in rows}
    assert [got[c[0]] for c in CANDIDATES] == expected


def test_unknown_mode(spark):
    frame = spark.createDataFrame(CANDIDATES, "model_id string, has_active boolean, drift_score double, requires_approval boolean")
    decisions = spark.createDataFrame([], "model_id string, status string, at timestamp")
    with pytest.raises(ValueError):
        D.promotion_decision(frame, decisions, "console", CFG)
