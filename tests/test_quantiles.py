import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logwarden.functions import quantiles
from logwarden.functions.quantiles import percentile_arrays, percentile_values, percentiles
from logwarden.functions.ranking import rank_within
from pyspark.sql import functions as F

PROBS = [0.0, 0.005, 0.33, 0.5, 0.9, 0.999, 0.9999, 1.0]


def samples():
    rng = np.random.default_rng(3)
    return {
        "normal": rng.normal(size=997),
        "ties": np.r_[np.zeros(600), rng.integers(0, 5, 300).astype(float)],
        "constant": np.full(50, 7.25),
        "single": np.array([3.0]),
        "heavy": rng.pareto(0.5, 800),
        "magnitudes": np.r_[rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200), 1.7e308, -1.7e308, 0.0, 5e-324],
        "near": 1e15 + rng.integers(0, 40, 300) / 8,
    }


@pytest.fixture(scope="module")
def long(spark):
    rows = [(name, float(v)) for name, xs in samples().items() for v in xs]
    return spark.createDataFrame(rows, "name string, x double").repartition(7)


@pytest.mark.parametrize("bins", [4096, 16])
def test_equals_numpy(long, bins):
    got = {(r.name, r.p): r.value for r in percentiles(long, PROBS, bins).collect()}
    for name, xs in samples().items():
        xs = np.sort(xs)
        for p in PROBS:
            rank = p * (len(xs) - 1)
            low, high = xs[int(rank)], xs[min(int(rank) + 1, len(xs) - 1)]
            assert got[name, p] == pytest.approx(low + (high - low) * (rank - int(rank)), rel=1e-12)


def test_passes_do_not_depend_on_the_number_of_values(spark, monkeypatch):
    passes = []
    plain = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: passes.append(1) or plain(*a))
    used = []
    for n in (3_000, 300_000):
        passes.clear()
        values = spark.range(n).select(F.lit("v").alias("name"), (F.rand(seed=1) * 50).alias("x"))
        got = percentiles(values, [0.5, 0.999]).count()
        used.append(len(passes))
    assert got == 2 and max(used) <= 3
    odd = spark.createDataFrame([("v", float("nan")), ("v", None), ("v", float("inf")), ("v", 1.0)], "name string, x double")
    assert [r.value for r in percentiles(odd, [0.0]).collect()] == [1.0]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60))
def test_one_and_many_buckets_agree(spark, xs):
    long = spark.createDataFrame([("v", x) for x in xs], "name string, x double")
    plain = {r.p: r.value for r in percentiles(long, PROBS).collect()}
    sliced = {r.p: r.value for r in percentiles(long, PROBS, 7).collect()}
    assert sliced == pytest.approx(plain, rel=1e-9, abs=1e-9)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "v double")
    assert percentile_values(empty, {"v": [0.5]}) == {}


def test_arrays_in_prob_order(long):
    arrays = {r.name: r["values"] for r in percentile_arrays(long, [0.9, 0.1]).collect()}
    assert arrays["normal"][0] < arrays["normal"][1]


def test_rank_in_a_hot_group(spark):
    rows = [("hot", i % 7, i) for i in range(3_000)] + [("cold", 1, i) for i in range(5)]
    rows += [(None, i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, score int, id int").repartition(5)
    ranked = rank_within(df, ["k"], [-F.col("score"), F.col("id")], "r").collect()
    assert len(ranked) == len(rows)
    for key in ("hot", "cold", None):
        mine = sorted([(-r.score, r.id, r.r) for r in ranked if r.k == key])
        assert [m[2] for m in mine] == list(range(1, len(mine) + 1))
