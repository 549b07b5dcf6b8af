import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logwarden.config import DetectorConfig
from logwarden.operators import forest as IF
from logwarden.operators import neighbours as N
from logwarden.operators.mixture import posteriors, with_anomaly_prob
from logwarden.operators.scaling import collect_scaler, scale, scaler_stats
from logwarden.session import stage

CFG = DetectorConfig(trees=40)


def vectors(spark, x):
    rows = [(f"k{i:05d}", [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "row_key string, x array<double>")


def test_average_path():
    got = IF.average_path(np.array([0, 1, 2, 256]))
    assert list(got[:3]) == [0.0, 0.0, 1.0]
    harmonic = np.log(255) + 0.5772156649015329
    assert got[3] == pytest.approx(2 * harmonic - 2 * 255 / 256)


def test_samples_are_exact_and_stable(spark):
    df = vectors(spark, np.random.default_rng(0).normal(size=(3_000, 3)))
    first = IF.tree_samples(df, ["row_key"], 3_000, CFG)
    sizes = first.groupBy("tree_id").count().toPandas()
    assert len(sizes) == CFG.trees and set(sizes["count"]) == {CFG.tree_sample}
    again = IF.tree_samples(df.repartition(9), ["row_key"], 3_000, CFG)
    assert first.exceptAll(again).isEmpty()


def test_hand_built_tree(spark):
    # root splits x0 at 1.0; left leaf holds one row, right leaf two
    nodes = spark.createDataFrame(
        [(0, 1, 0, 1.0, 2, 3, 0, 3), (0, 2, -1, 0.0, -1, -1, 1, 1), (0, 3, -1, 0.0, -1, -1, 1, 2)],
        IF.NODE_SCHEMA,
    )
    scorer = IF.forest_scorer(nodes, 3)
    got = [r.s for r in vectors(spark, [[0.0], [5.0]]).orderBy("row_key").select(scorer(F.col("x")).alias("s")).collect()]
    c3 = IF.average_path(np.array([3]))[0]
    assert got == pytest.approx([0.5 - 2 ** (-1 / c3), 0.5 - 2 ** (-2 / c3)])


def test_outliers_score_lowest(spark):
    x = np.random.default_rng(1).normal(size=(600, 4))
    x[:5] += 12
    df = vectors(spark, x)
    nodes = stage(IF.fit_forest(df, ["row_key"], 600, CFG), "nodes")
    assert nodes.count() <= CFG.trees * (2 * CFG.tree_sample - 1)
    scored = df.withColumn("s", IF.forest_scorer(nodes, 256)(F.col("x"))).orderBy("s").limit(5)
    assert {r.row_key for r in scored.collect()} == {f"k{i:05d}" for i in range(5)}


def test_constant_rows_make_single_leaves(spark):
    df = vectors(spark, np.ones((12, 2)))
    nodes = IF.fit_forest(df, ["row_key"], 12, CFG).toPandas()
    assert (nodes["feature"] == -1).all() and len(nodes) == CFG.trees


def clusters():
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(6, 5)) * 4
    x = np.vstack([centre[i % 6] + rng.normal(size=5) * 0.5 for i in range(700)])
    x[100:330] = x[100]  # a third of the rows are one and the same point
    return x


def brute_lof(x, k):
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    others = d.copy()
    np.fill_diagonal(others, np.inf)

    def nearest(m):
        idx = np.argsort(m, 1, kind="stable")[:, :k]
        return idx, np.take_along_axis(m, idx, 1)

    idx, dist = nearest(others)
    k_dist = dist[:, -1]
    lrd = 1 / (np.maximum(k_dist[idx], dist).mean(1) + 1e-10)
    idx2, dist2 = nearest(d)
    own = 1 / (np.maximum(k_dist[idx2], dist2).mean(1) + 1e-10)
    return k_dist, lrd, -lrd[idx2].mean(1) / own


@pytest.mark.parametrize("chunk", [20_000, 15])
def test_lof_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(N, "CHUNK_ROWS", chunk)
    x = clusters()
    df = vectors(spark, x)
    points = stage(N.weighted_points(df), "points")
    assert points.count() == 471
    k_dist, lrd, raw = brute_lof(x, 20)
    reference, scores = N.fit_lof(points, len(x), 20)
    for r in reference.collect():
        i = int(r.rid[1:])
        assert r.k_dist == pytest.approx(k_dist[i]) and r.lrd == pytest.approx(lrd[i])
    assert {int(r.qid[1:]): r.lof_raw for r in scores.collect()} == pytest.approx(
        {int(r.rid[1:]): raw[int(r.rid[1:])] for r in points.collect()}
    )
    scored = N.score_lof(df, reference, len(x), 20).collect()
    assert len(scored) == len(x)
    assert {int(r.row_key[1:]): r.lof_raw for r in scored} == pytest.approx(dict(enumerate(raw)))


def test_far_query_finds_its_neighbours(spark):
    x = clusters()
    points = stage(N.weighted_points(vectors(spark, x)), "points")
    far = vectors(spark, [[30.0] * 5, list(x[3] + 0.01)]).withColumnRenamed("row_key", "qid")
    found = N.knn_join(far, points, 20).collect()
    reference = {r.rid: (np.array(r.x), r.weight) for r in points.collect()}
    for query in far.collect():
        nearest, total = [], 0
        for d, rid in sorted((round(float(np.linalg.norm(np.array(query.x) - v)), 9), i) for i, (v, _) in reference.items()):
            if total >= 20:
                break
            nearest.append((d, rid))
            total += reference[rid][1]
        assert sorted((r.distance, r.rid) for r in found if r.qid == query.qid) == nearest


def test_mixture_prefers_the_larger_mean(spark):
    low, high = [0.1 + i / 1000 for i in range(30)], [0.8, 0.81, 0.82]
    df = spark.createDataFrame([(round(v, 4),) for v in low + high], "fused_score double")
    got = {r.fused_score: r.anomaly_prob for r in with_anomaly_prob(df).collect()}
    assert len(got) == 33
    assert min(got[v] for v in high) > 0.95 and max(got[round(v, 4)] for v in low) < 0.05


def em(x, w):
    """The same fit in plain numpy."""
    total, mean = w.sum(), (w * x).sum() / w.sum()
    if total < 4 or np.sqrt((w * (x - mean) ** 2).sum() / total) < 1e-9:
        return np.zeros(len(x))
    cost = [
        sum((w[p] * (x[p] - np.average(x[p], weights=w[p])) ** 2).sum() for p in (slice(0, i), slice(i, None)))
        for i in range(1, len(x))
    ]
    upper = (np.arange(len(x)) > int(np.argmin(cost))).astype(float)
    resp, previous = np.column_stack([1 - upper, upper]), -np.inf
    for i in range(101):
        mass = (resp * w[:, None]).sum(axis=0) + 1e-15
        mu = (resp * (w * x)[:, None]).sum(axis=0) / mass
        var = (resp * (w[:, None] * (x[:, None] - mu) ** 2)).sum(axis=0) / mass + 1e-6
        logp = np.log(mass / total) - 0.5 * (np.log(2 * np.pi * var) + (x[:, None] - mu) ** 2 / var)
        norm = np.logaddexp(logp[:, 0], logp[:, 1])
        resp, bound = np.exp(logp - norm[:, None]), (w * norm).sum() / total
        if abs(bound - previous) < 1e-3 or i == 99:
            break
        previous = bound
    return resp[:, int(np.argmax(mu))]


@pytest.mark.parametrize("seed", range(4))
def test_mixture_agrees_with_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(0.2, 0.05, 300), rng.normal(0.6 - seed / 10, 0.1, 40), [0.0] * 50])
    x, w = np.unique(np.round(np.clip(values, 0, 1), 4), return_counts=True)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, w)], "x double, w double").repartition(3)
    got = {r.x: r.posterior for r in posteriors(df).collect()}
    want = em(x, w.astype(float))
    assert max(abs(got[float(a)] - b) for a, b in zip(x, want)) < 2e-4


def test_mixture_degenerate(spark):
    def run(rows):
        return sorted(tuple(r) for r in posteriors(spark.createDataFrame(rows, "x double, w double")).collect())

    assert run([(0.1, 1.0), (0.5, 1.0), (0.9, 1.0)]) == [(0.1, 0.0), (0.5, 0.0), (0.9, 0.0)]  # fewer than four
    assert run([(0.4, 50.0)]) == [(0.4, 0.0)]  # flat
    assert run([]) == []
    df = spark.createDataFrame([(0.5,), (0.5,), (None,)], "fused_score double")
    assert sorted(with_anomaly_prob(df).collect(), key=str) == [(0.5, 0.0), (0.5, 0.0), (None, None)]


def test_scaler(spark):
    from logwarden.config import FEATURE_COLUMNS

    pdf = pd.DataFrame({c: [1.0, 1.0, 1.0] for c in FEATURE_COLUMNS})
    pdf["burst_rate"] = [1.0, 2.0, 6.0]
    df = spark.createDataFrame(pdf)
    scaler = collect_scaler(scaler_stats(df))
    assert scaler["q_len_max"] == (1.0, 1.0)
    assert scaler["burst_rate"] == pytest.approx((3.0, np.std([1, 2, 6])))
    x = np.array([r.x for r in scale(df, scaler).collect()])
    assert np.allclose(x[:, -1].std(), 1) and np.allclose(x[:, 0], 0)


def test_probes_measure_only_what_can_be_near(monkeypatch):
    """Same pairs, ties and distances as by brute force, of which few are measured exactly."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(3000, 24)) * rng.choice([0.0, 1.0, 300.0], size=24), 1)
    x[1500:1600] = x[:100]
    points = pd.DataFrame({"rid": [f"r{i:05d}" for i in range(3000)], "x": list(x), "weight": 1, "k_dist": 0.0, "lrd": 0.0})
    queries = pd.DataFrame({"qid": [f"q{i}" for i in range(200)], "x": list(x[:200]), "reach": rng.uniform(0.0, 900.0, 200)})
    d = N._distances(x[:200], x)
    wanted = []
    for i in range(200):
        near = sorted((d[i, j], j) for j in range(3000) if d[i, j] <= queries["reach"][i])[:21]
        wanted += [(f"q{i}", f"r{j:05d}", dist) for dist, j in near]
    measured, pair_distances = [], N._pair_distances
    monkeypatch.setattr(N, "_pair_distances", lambda a, b: measured.append(len(a)) or pair_distances(a, b))
    got = N._nearest(queries, N._as_arrays(points), 21)
    assert [tuple(r) for r in got[["qid", "rid", "distance"]].to_numpy()] == wanted
    assert sum(measured) < 200 * 60


def test_leaves_out_of_reach_are_not_measured(monkeypatch):
    """A cell's points meet only queries whose reach touches their leaf; the first bound comes from leaves nearby."""
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(8000, 3)) @ rng.normal(size=(3, 24)) + rng.normal(size=(8000, 24)) / 50, 9)
    points = pd.DataFrame({"rid": [f"r{i:05d}" for i in range(8000)], "x": list(x), "weight": 1, "k_dist": 0.0, "lrd": 0.0})
    queries = pd.DataFrame({"qid": [f"q{i}" for i in range(100)], "x": list(x[:100])})
    pairs, squares = [], N._squares
    monkeypatch.setattr(N, "_squares", lambda a, b: pairs.append(len(a) * len(b)) or squares(a, b))
    got = N._nearest(queries, N._as_arrays(points), 21)
    d = N._distances(x[:100], x)
    nearest = np.argsort(d, axis=1, kind="stable")[:, :21]
    assert list(got["rid"]) == [f"r{j:05d}" for j in nearest.ravel()]
    assert sum(pairs) < 100 * 8000 / 4


def test_neighbours_over_many_cells_with_rows_that_are_no_numbers(spark):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(900, 6)) * [9, 3, 1, 1, 0, 1], 1)
    x[700:] = np.round(x[700:], 0)
    x[5, 2] = np.nan
    points = stage(N.weighted_points(vectors(spark, x)), "points")
    asked = np.vstack([x[:150] + 0.05, [[1e4] * 6, [np.nan] * 6]])
    found = N.knn_join(vectors(spark, asked).withColumnRenamed("row_key", "qid"), points, 5).collect()
    assert N._cells(points, 900, 5).depth == 4
    reference = [(r.rid, np.array(r.x), r.weight) for r in points.collect() if np.isfinite(r.x).all()]
    for i, query in enumerate(asked[:151]):
        if not np.isfinite(query).all():
            continue
        nearest, total = [], 0
        for d, rid, weight in sorted((N._pair_distances(query[None], v[None])[0], rid, w) for rid, v, w in reference):
            if total >= 5:
                break
            nearest.append((d, rid))
            total += weight
        assert sorted((r.distance, r.rid) for r in found if r.qid == f"k{i:05d}") == nearest
    assert not [r for r in found if r.qid in ("k00005", "k00151")]
