"""Many slices are trained, reviewed and scored by key; that gives what one slice at a time gives."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logs import make_log
from logwarden.config import DetectorConfig
from logwarden.plans import workflows as J
from test_workflows import traffic

TABLES = ("paths", "scaler", "forest", "lof_reference", "training", "scalars")


def rounded(df):
    """All rows, whatever their order and the order of the columns."""
    def plain(value):
        if isinstance(value, float):
            return f"{value:.9g}" if abs(value) > 1e-12 else "0"
        return repr([plain(v) for v in value]) if isinstance(value, list) else repr(value)

    names = sorted(set(df.columns) - {"generated_at", "slice"})
    return sorted(tuple(plain(row[name]) for name in names) for row in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    """Six slices, the third too small; some rows without an address, a path or a query."""
    hours = [*range(6), *range(6, 12), 12, *range(18, 36)]
    loud = traffic(spark, [*range(2, 5), *range(20, 24), *range(26, 29)], ips=3, noise=9)
    odd = [(str(datetime(2024, 1, 1, 3, i)), ip, path, query, 200) for i in range(30)
           for ip, path, query in ((None, "/a", "b=1"), ("10.0.0.9", None, "b=2"), ("10.0.0.9", "/a", None))]
    return traffic(spark, hours).unionByName(loud).unionByName(make_log(spark, odd)).cache()


def test_by_key_as_one_by_one(spark, tmp_path, monkeypatch, log):
    mode = "safe"
    cfg = DetectorConfig(
        trees=12, tree_sample=16, alert_pct=90.0, catastrophic_pct=97.0, train_days=0.25,
        drift_threshold=0.3, drift_reject_above=0.45, min_break_urls=5,
    )
    found = {}
    calls = []
    for way, many in (("alone", 1_000), ("by_key", 1)):
        monkeypatch.setattr(J, "AT_ONCE", many)
        for name in ("train_models", "review_each", "score_each"):
            function = getattr(J, name)
            if many == 1:
                monkeypatch.setattr(J, name, lambda *a, f=function, n=name, **k: calls.append(n) or f(*a, **k))
        library = J.Library(spark, str(tmp_path / way))
        alerts, report = J.backtest(log, library, cfg, mode=mode, max_urls=4, out=str(tmp_path / f"{way}-out"))
        columns = ["seq", "event", "model_id", "train_window_start", "train_window_end", "n_train_windows", "fused_threshold"]
        found[way] = (library, alerts, report.collect(), library.registry.events().select(*columns).orderBy("seq").collect())
    assert set(calls) == {"train_models", "review_each", "score_each"}
    one, many = found["alone"], found["by_key"]
    # sums of features are added up in another order, and values that equal an edge of a drift bin may change sides
    assert [r[:6] for r in one[2]] == [r[:6] for r in many[2]]
    assert [r.drift_score for r in one[2]] == pytest.approx([r.drift_score for r in many[2]], abs=0.02)
    assert [r.trained is None for r in one[2]] == [False, False, True, False, False, False]
    assert one[3] == many[3]
    assert rounded(one[1]) == rounded(many[1]) != []
    by_slice = [r[1].groupBy("slice").count().orderBy("slice").collect() for r in (one, many)]
    assert by_slice[0] == by_slice[1]
    for row in one[2]:
        for table in TABLES if row.trained else ():
            assert rounded(one[0].store.read(table, row.trained)) == rounded(many[0].store.read(table, row.trained)), table
    models = [many[0].store.load(row.trained) for row in one[2][:4] if row.trained]
    pairs = [(models[1], models[0]), (models[0], models[2])]
    assert J.review_each(pairs, many[0], cfg, mode) == [J.reviewed(*pair, cfg, mode) for pair in pairs]


def test_a_slice_that_fails_does_not_take_the_others_along(spark, tmp_path, monkeypatch, log):
    """Training by key is given up then, and each slice is trained alone."""
    def broken(*_):
        raise RuntimeError("together")

    monkeypatch.setattr(J, "AT_ONCE", 1)
    monkeypatch.setattr(J, "train_models", broken)
    cfg = DetectorConfig(trees=4, tree_sample=8, train_days=0.25)
    done = J.retrain(log.filter(F.col("ts") < F.lit(datetime(2024, 1, 2))), J.Library(spark, str(tmp_path)), cfg, "auto", all_ready=True)
    assert [d["decision"] for d in done] == ["promote", "promote", "skipped"]
