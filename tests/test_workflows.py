from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logs import make_log
from logwarden.config import DetectorConfig
from logwarden.fixture import access_log
from logwarden.plans import workflows as J
from logwarden.sources.log_table import append_records, compact, read_log_table
from logwarden.plans.model import TooFewWindows, train_model
from logwarden.plans.registry import ModelRegistry, RegistryError
from logwarden.plans.scoring import score_batch, score_requests

CFG = DetectorConfig(trees=20, alert_pct=90.0, catastrophic_pct=99.0, train_days=0.25)


def traffic(spark, hours, ips=4, noise=0):
    """Twenty-five requests per address and hour."""
    rows = []
    for hour in hours:
        at = datetime(2024, 1, 1) + timedelta(hours=hour)
        for ip in range(ips):
            for i in range(25):
                loud = noise and ip == 0 and i % 2
                query = "id=" + "%27%20OR%201" * noise + str(i) if loud else f"page={(i * 7 + hour + ip) % 9}"
                rows.append((str(at + timedelta(seconds=60 * i + ip)), f"10.0.0.{ip}", f"/p{i % 5}/{i}", query, 500 if loud else 200))
    return make_log(spark, rows)


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    library = J.Library(spark, str(tmp_path_factory.mktemp("lib")))
    log = access_log(spark, "/root/testdata/sf0.001")
    J.bootstrap(log, library, CFG)
    return library, log


def test_bootstrap_and_score(trained):
    library, log = trained
    model = library.active()
    assert model.model_id == "model_v1" and model.n_train_windows == 24
    assert model.calibration.fused_threshold <= model.calibration.catastrophic_threshold
    alerts = J.score_with_active(log, library, CFG).cache()
    assert alerts.count() == alerts.select("ip", "window_start_utc", "url").distinct().count() > 0
    row = alerts.first()
    assert row.detected_by_model == "model_v1" and row.signals and row.window_minutes == 60
    assert 0 <= row.fused_score <= 1 and row.severity in ("LOW", "MEDIUM", "HIGH")


def test_scoring_uses_the_model_tables(trained):
    """Half of the batch scores exactly as it does within the whole batch."""
    library, log = trained
    model = library.active()
    whole = {(r.ip, r.window_ts): r.fused_score for r in score_requests(log, model, CFG).collect()}
    part = score_requests(log.filter("ip = '10.0.0.3'"), model, CFG).collect()
    assert {(r.ip, r.window_ts): r.fused_score for r in part} == {
        k: v for k, v in whole.items() if k[0] == "10.0.0.3"
    }


def test_reload_gives_the_same_model(trained):
    library, log = trained
    first = score_batch(log, library.active(), CFG).drop("generated_at")
    again = score_batch(log.repartition(5), library.store.load("model_v1"), CFG).drop("generated_at")
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_no_model_and_too_little_data(spark, tmp_path):
    library = J.Library(spark, str(tmp_path / "lib"))
    log = traffic(spark, range(2))
    with pytest.raises(J.NoActiveModel):
        J.score_with_active(log, library, CFG)
    with pytest.raises(TooFewWindows):
        J.bootstrap(log, library, CFG)
    assert library.registry.next_model_id() == "model_v1"


def test_same_model_has_no_drift(trained):
    library, _ = trained
    model = library.active()
    row = J.compare_models(model, model, CFG).first()
    assert row.drift_score == 0 and not row.requires_approval
    model.training = None
    row = J.compare_models(model, model, CFG).first()
    assert row.drift_score == 0 and row.note == "no drift reference stored"


def test_registry_rules(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path / "reg"))
    assert registry.active_id() is None and registry.models().isEmpty()
    for _ in range(3):
        registry.register(registry.next_model_id(), CFG)
    registry.skip("model_v4")
    assert registry.next_model_id() == "model_v4"
    registry.approve("model_v1")
    registry.approve("model_v2")
    registry.reject("model_v3")
    for call in (lambda: registry.approve("model_v3"), lambda: registry.approve("model_v1"),
                 lambda: registry.reject("model_v9"), lambda: registry.rollback("model_v3")):
        with pytest.raises(RegistryError):
            call()
    assert registry.active_id() == "model_v2"
    registry.rollback("model_v1")
    assert registry.active_id() == "model_v1"
    assert [r.model_id for r in registry.models().collect()] == ["model_v3", "model_v2", "model_v1"]
    assert registry.compatibility("model_v1", CFG).isEmpty()
    other = registry.compatibility("model_v1", DetectorConfig(trees=20, alert_pct=99.0, catastrophic_pct=99.0))
    assert [(r["item"], r.saved, r.current) for r in other.collect()] == [("alert_pct", "90.0", "99.0")]


def test_many_registry_steps_are_one_write(spark, tmp_path):
    """A long history costs one read and one file; a step sees those before it."""
    registry = ModelRegistry(spark, str(tmp_path / "reg"))
    registry.register(registry.next_model_id(), CFG)
    ids = registry.next_model_ids(400)
    assert ids[0] == "model_v2"
    steps = [("approved", "model_v1", {})]
    for model_id in ids:
        steps += [registry.candidate(model_id, CFG, n_train_windows=7), ("approved", model_id, {})]
    registry.record([*steps, ("rolled_back", "model_v1", {})])
    assert len(list((tmp_path / "reg" / "events").glob("part-*"))) == 2
    assert [r.seq for r in registry.events().orderBy("seq").collect()] == list(range(1, 804))
    assert registry.active_id() == "model_v1" and registry.next_model_id() == "model_v402"
    for wrong in (("approved", "model_v9", {}), ("rejected", "model_v500", {}), ("rolled_back", "model_v500", {})):
        with pytest.raises(RegistryError):
            registry.record([registry.candidate("model_v402", CFG), wrong])
    assert registry.events().count() == 803
    with pytest.raises(RegistryError):
        registry.record([("approved", "model_v402", {}), registry.candidate("model_v402", CFG)])


def test_retrain_takes_the_oldest_ready_window(spark, tmp_path):
    library = J.Library(spark, str(tmp_path / "lib"))
    log = traffic(spark, range(13)).cache()
    assert [r["slice"] for r in J.retrain(log, library, CFG)] == [0]
    second = J.retrain(log, library, CFG, mode="table")
    assert [r["slice"] for r in second] == [1] and second[0]["decision"] in ("promote", "pending")
    assert J.retrain(log, library, CFG) == []


def test_pending_candidate_waits_for_the_analyst(spark, tmp_path):
    cfg = DetectorConfig(trees=20, train_days=0.25, drift_threshold=-1.0)
    library = J.Library(spark, str(tmp_path / "lib"))
    log = traffic(spark, range(13)).cache()
    done = J.retrain(log, library, cfg, mode="table", all_ready=True)
    assert [d["decision"] for d in done] == ["promote", "pending"]
    none = spark.createDataFrame([], "model_id string, status string, at timestamp")
    assert J.resolve_pending(library, none, cfg) == [("model_v2", "pending")]
    yes = spark.sql("SELECT 'model_v2' model_id, 'approved' status, TIMESTAMP '2024-02-01' at")
    assert J.resolve_pending(library, yes, cfg) == [("model_v2", "promote")]
    assert library.registry.active_id() == "model_v2"


def test_ready_windows_train_side_by_side_as_one_by_one(spark, tmp_path, monkeypatch):
    """Slice 1 is too small. Of the others some are rejected, so the next review is against an older model."""
    cfg = DetectorConfig(trees=20, train_days=0.25, drift_threshold=0.4, drift_reject_above=0.5)
    hours = [*range(6), 6, *range(12, 31)]
    log = traffic(spark, hours).unionByName(traffic(spark, range(12, 18), ips=3, noise=9)).cache()
    single, several = (J.Library(spark, str(tmp_path / name)) for name in ("single", "several"))
    one_by_one = []
    while done := J.retrain(log, single, cfg):
        one_by_one += done
    read = []
    monkeypatch.setattr(J, "train_model", lambda rows, *rest: read.append(rows.inputFiles()) or train_model(rows, *rest))
    assert J.retrain(log, several, cfg, all_ready=True) == one_by_one
    assert [d["decision"] for d in one_by_one][:2] == ["promote", "skipped"]
    assert {"promote", "reject"} <= {d["decision"] for d in one_by_one[2:]}
    # a model's training reads its own slice only, and the events come in one write
    assert all(len({f.split("/slice=")[1].split("/")[0] for f in files}) == 1 for files in read) and len(read) == 4
    assert len(several.registry.events().inputFiles()) == 1
    columns = ["seq", "event", "model_id", "train_window_start", "train_window_end", "n_train_windows", "fused_threshold"]
    history = [lib.registry.events().select(*columns).orderBy("seq").collect() for lib in (single, several)]
    assert history[0] == history[1]


@pytest.mark.parametrize(
    "lag, scored, trained_on",
    [
        (1, [None, "model_v1", "model_v2"], ["model_v1", "model_v2", "model_v3"]),
        (2, [None, None, "model_v1"], [None, "model_v1", "model_v2"]),
    ],
)
def test_backtest_pairs_slices_and_models(spark, tmp_path, lag, scored, trained_on):
    """Six-hour slices 0, 1 and 3: slice 2 is empty."""
    library = J.Library(spark, str(tmp_path / "lib"))
    log = traffic(spark, [*range(12), *range(18, 24)], ips=2).cache()
    alerts, report = J.backtest(log, library, CFG, lag=lag, mode="auto")
    rows = report.orderBy("slice").collect()
    assert [r.slice for r in rows] == [0, 1, 3]
    assert [r.scored_by for r in rows] == scored
    assert [r.trained for r in rows] == trained_on
    assert "slice" in alerts.columns


def test_start_modes(spark, tmp_path):
    library = J.Library(spark, str(tmp_path / "lib"))
    assert J.start_mode(library) == "replay" and J.start_mode(library, "resume") == "resume"
    assert J.prepare_history(traffic(spark, range(6)), library, CFG, "resume") == "resume"
    assert library.registry.active_id() == "model_v1" and J.start_mode(library) == "resume"
    with pytest.raises(ValueError):
        J.start_mode(library, "never")


def test_score_file(spark, tmp_path):
    from logwarden.sources.access_logs import raw_json

    library = J.Library(spark, str(tmp_path / "lib"))
    log = traffic(spark, range(6))
    J.bootstrap(log, library, CFG)
    noisy = traffic(spark, range(6, 8), noise=20)
    noisy.select(raw_json(noisy).alias("value")).write.text(str(tmp_path / "in"))
    direct = J.score_file(spark, str(tmp_path / "in"), library, CFG, out=str(tmp_path / "out"))
    through = J.score_file(spark, str(tmp_path / "in"), library, CFG, log_table=str(tmp_path / "log"))
    keep = ["ip", "window_start_utc", "url", "fused_score", "severity"]
    assert direct.count() > 0
    assert direct.select(keep).exceptAll(through.select(keep)).isEmpty()
    assert spark.read.json(str(tmp_path / "out")).count() == direct.count()
    assert through.select(keep).exceptAll(direct.select(keep)).isEmpty()

    # a second file into the same table: only its own rows are scored
    later = traffic(spark, [9], noise=20)
    later.select(raw_json(later).alias("value")).write.text(str(tmp_path / "in2"))
    second = J.score_file(spark, str(tmp_path / "in2"), library, CFG, log_table=str(tmp_path / "log"))
    assert {r.window_start_utc.hour for r in second.select("window_start_utc").distinct().collect()} == {9}
    assert read_log_table(spark, str(tmp_path / "log")).count() == noisy.count() + later.count()


def test_ingest_counts_bad_records(spark, tmp_path):
    file = tmp_path / "x.json"
    good = '{"@timestamp":"2024-01-01T10:00:00Z","source":{"ip":"10.0.0.3"}}'
    file.write_text(f"{good}\n{{broken\n{good}\n\n")
    added, counts = J.ingest(spark, str(file), str(tmp_path / "log"))
    assert (added.count(), counts.good, counts.bad) == (2, 2, 1)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.json").write_text("\n")
    added, counts = J.ingest(spark, str(tmp_path / "none"), str(tmp_path / "log"))
    assert (added.count(), counts.good, counts.bad) == (0, 0, 0)


def test_compaction_keeps_recent_rows(spark, tmp_path):
    log = traffic(spark, range(8))
    for k, half in enumerate((log.filter("hour(ts) < 4"), log.filter("hour(ts) >= 4"))):
        append_records(half, str(tmp_path / "log"), k)
    compact(spark, str(tmp_path / "log"), str(tmp_path / "whole"))
    assert read_log_table(spark, str(tmp_path / "whole")).count() == log.count()
    compact(spark, str(tmp_path / "log"), str(tmp_path / "recent"), days=2 / 24)
    newest = log.selectExpr("max(ts) t").first().t
    kept = read_log_table(spark, str(tmp_path / "recent"))
    assert kept.count() == log.filter(F.col("ts") >= F.lit(newest) - F.expr("interval 2 hours")).count() > 0
