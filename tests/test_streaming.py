import json
import os
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from logwarden.checks import queries as Q
from logwarden.config import DetectorConfig
from logwarden.plans import workflows as J
from logwarden.session import staging_root
from logwarden.sources.access_logs import flatten, parse_lines, raw_json
from logwarden.sources.appended_file import AppendedFileReader, read_appended_file
from logwarden.streaming import scoring as X
from test_workflows import traffic

CFG = DetectorConfig(trees=20, alert_pct=90.0, catastrophic_pct=99.0, train_days=0.25)
NOW = {"availableNow": True}


def write_json(log, path, mode="append"):
    log.select(raw_json(log).alias("value")).coalesce(1).write.mode(mode).text(str(path))


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    library = J.Library(spark, str(tmp_path_factory.mktemp("lib")))
    J.bootstrap(traffic(spark, range(6)), library, CFG)
    return library


def read_alerts(spark, out):
    return spark.read.schema("ip string, url string, window_start_utc string").json(f"{out}/*/*")


def test_microbatches_restart_without_duplicates(spark, tmp_path, library):
    source, out = tmp_path / "in", str(tmp_path / "out")
    noisy = traffic(spark, [6, 7], noise=20)
    first = noisy.filter("hour(ts) = 6")
    write_json(first, source)
    options = dict(
        out=out, checkpoint=str(tmp_path / "ckpt"), log_table=str(tmp_path / "log"),
        bad_records=str(tmp_path / "bad"), trigger=NOW,
    )

    def run():
        X.score_microbatches(X.stream_directory(spark, str(source)), library, CFG, **options).awaitTermination()

    run()
    seen = read_alerts(spark, out).count()
    assert seen > 0
    run()  # nothing new arrived
    assert read_alerts(spark, out).count() == seen
    write_json(noisy.filter("hour(ts) = 7"), source)
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.mode("append").text(str(source))
    run()
    alerts = read_alerts(spark, out)
    assert alerts.count() > seen and alerts.distinct().count() == alerts.count()
    assert spark.read.parquet(str(tmp_path / "log")).count() == noisy.count()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def test_failing_batch_is_set_aside(spark, tmp_path, library):
    source = tmp_path / "in"
    log = traffic(spark, [6], noise=20)
    write_json(log, source)
    out, aside = str(tmp_path / "out"), str(tmp_path / "aside")

    class Broken:
        def active(self):
            raise RuntimeError("model root is unreadable")

    X.score_microbatches(
        X.stream_directory(spark, str(source)), Broken(), CFG, out, str(tmp_path / "ckpt"),
        quarantine=aside, trigger=NOW, attempts=1,
    ).awaitTermination()
    kept = spark.read.parquet(aside)
    assert kept.count() == log.count() and "unreadable" in kept.first().error

    table = str(tmp_path / "log")
    handle = X.batch_scorer(library, CFG, out, table)
    (run, batch_id), = X.replay_set_aside(spark, aside, handle)
    assert batch_id == 0 and spark.read.parquet(table).count() == log.count()
    assert read_alerts(spark, out).count() > 0
    assert X.replay_set_aside(spark, aside, handle) == []
    direct = str(tmp_path / "direct")
    X.score_microbatches(
        X.stream_directory(spark, str(source)), library, CFG, direct, str(tmp_path / "ckpt2"), trigger=NOW
    ).awaitTermination()
    assert sorted(read_alerts(spark, out).collect()) == sorted(read_alerts(spark, direct).collect())


def test_a_passing_failure_is_tried_again(spark, tmp_path):
    calls = []

    def handle(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("storage is busy")

    X.guarded(handle, None, attempts=3, pause=0)(spark.range(1), 7)
    assert calls == [7, 7, 7]
    calls.clear()
    with pytest.raises(OSError):
        X.guarded(handle, None, attempts=2, pause=0)(spark.range(1), 7)


def test_runs_do_not_overwrite_each_other(spark, tmp_path, library):
    """Two streams, and one with a new checkpoint, into the same folders."""
    out, table = str(tmp_path / "out"), str(tmp_path / "log")
    for k, hour in enumerate((6, 7)):
        write_json(traffic(spark, [hour], noise=20), tmp_path / f"in{k}")
        X.score_microbatches(
            X.stream_directory(spark, str(tmp_path / f"in{k}")), library, CFG, out,
            str(tmp_path / f"ckpt{k}"), log_table=table, trigger=NOW,
        ).awaitTermination()
    hours = {r.window_start_utc[11:13] for r in read_alerts(spark, out).collect()}
    assert hours == {"06", "07"}
    assert {r.h for r in spark.read.parquet(table).select(F.hour("ts").alias("h")).distinct().collect()} == {6, 7}


def test_three_batches_leave_no_staging_and_load_one_model(spark, tmp_path, monkeypatch):
    fresh = J.Library(spark, str(tmp_path / "lib"))
    J.bootstrap(traffic(spark, range(6)), fresh, CFG)
    for hour in (6, 7, 8):
        write_json(traffic(spark, [hour], noise=20), tmp_path / "in")
    loads, load = [], J.ModelStore.load
    monkeypatch.setattr(J.ModelStore, "load", lambda self, model_id: loads.append(model_id) or load(self, model_id))
    root = staging_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    X.score_microbatches(
        X.stream_directory(spark, str(tmp_path / "in")), fresh, CFG, str(tmp_path / "out"),
        str(tmp_path / "ckpt"), trigger=NOW,
    ).awaitTermination()
    assert read_alerts(spark, str(tmp_path / "out")).count() > 0
    assert len(loads) == 1
    assert set(os.listdir(root)) == before


def test_event_time_windows_join_split_batches(spark, tmp_path, library):
    """An hour spread over two files is one window; the last hour stays open."""
    log = traffic(spark, range(6, 9), noise=20)
    early = F.minute("ts") < 12
    for k, part in enumerate((log.filter(early), log.filter(~early & (F.hour("ts") < 8)), log.filter(~early & (F.hour("ts") == 8)))):
        write_json(part, tmp_path / f"in{k}")
    out = str(tmp_path / "out")
    stream = X.stream_directory(spark, str(tmp_path / "in[0-9]"), None)
    X.score_event_time(
        stream, library, CFG, out, str(tmp_path / "ckpt"), requests=lambda: log, trigger=NOW,
    ).awaitTermination()
    alerts = read_alerts(spark, out)
    hours = {r.window_start_utc[11:13] for r in alerts.filter("ip = '10.0.0.0'").collect()}
    assert hours == {"06", "07"}
    urls = log.filter("ip = '10.0.0.0' AND hour(ts) < 8").select("path", "query", F.hour("ts")).distinct()
    assert alerts.filter("ip = '10.0.0.0'").count() == urls.count()


def test_windows_ahead_of_the_log(spark, tmp_path, library):
    """A log table that lags loses no alert; the URLs follow when it has caught up."""
    log = traffic(spark, range(6, 9), noise=20)
    write_json(log.filter("hour(ts) < 8"), tmp_path / "in0")
    write_json(log.filter("hour(ts) = 8"), tmp_path / "in1")
    out = str(tmp_path / "out")
    X.score_event_time(
        X.stream_directory(spark, str(tmp_path / "in[0-9]"), None), library, CFG, out, str(tmp_path / "ckpt"),
        requests=lambda: log.filter("hour(ts) < 7"), trigger=NOW,
    ).awaitTermination()
    alerts = spark.read.json(f"{out}/*/*").filter("ip = '10.0.0.0'")
    pending = alerts.filter("urls_pending").collect()
    assert [r.window_start_utc[11:13] for r in pending] == ["07"]
    later = X.pending_url_alerts(alerts, log, CFG)
    urls = log.filter("ip = '10.0.0.0' AND hour(ts) = 7").select("path", "query").distinct()
    assert later.count() == urls.count() and later.filter("url IS NULL").count() == 0


def test_late_rows_are_counted(spark, tmp_path, library):
    """A batch is held against the watermark of the one before it."""
    table = str(tmp_path / "late")
    counter = X.LateRowCounter(spark, table)
    spark.streams.addListener(counter)
    for hour in (9, 8, 6):
        write_json(traffic(spark, [hour]), tmp_path / "in")
    windows = X.streaming_windows(
        X.stream_directory(spark, str(tmp_path / "in")), library.active(), CFG
    )
    out = str(tmp_path / "out")
    run = (
        windows.writeStream.outputMode("append").format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(**NOW).start()
    )
    run.awaitTermination()
    wait_for(lambda: X.late_rows(spark, table, run.id) > 0)
    spark.streams.removeListener(counter)
    assert X.late_rows(spark, table) == X.late_rows(spark, table, run.id)
    assert {r.window_ts.hour for r in spark.read.parquet(out).collect()} == {8}


def wait_for(condition, seconds=30):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end
        time.sleep(0.2)


@pytest.mark.parametrize("step", [1, 8])
def test_late_arrivals_have_equally_many_files(spark, tmp_path, step):
    """A batch is one arrival; ids that fill too few files go to one file for each arrival."""
    spark.range(1).selectExpr("id AS page_id", "'http://a.org/p?q=1' AS url").write.parquet(f"{tmp_path}/pages.parquet")
    events = spark.range(0, 2000, step).selectExpr("id AS event_id", "id AS user_id", "'view' AS event_type")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    folder, files = Q._late_arrivals(spark, str(tmp_path))
    assert files == (spark.sparkContext.defaultParallelism if step == 1 else 1)
    written = sorted((f for f in os.scandir(folder) if f.name.startswith("part-")), key=lambda f: f.stat().st_mtime_ns)
    assert len(written) == 3 * files
    rows = [sum(sum(1 for _ in open(f)) for f in written[i * files : (i + 1) * files]) for i in range(3)]
    ids = range(0, 2000, step)
    fresh, kept = (sum(ids[-1] - i <= 300 * hours for i in ids) for hours in (2, 4))
    assert rows == [fresh, kept - fresh, len(ids) - kept]


def test_late_rows_of_more_batches_than_a_query_remembers(spark, tmp_path):
    """130 reports, one of them repeated; a query keeps the progress of 100."""
    table = str(tmp_path / "late")
    counter = X.LateRowCounter(spark, table)
    for batch in [*range(130), 129]:
        operators = [SimpleNamespace(numRowsDroppedByWatermark=n) for n in (2, 1)]
        progress = SimpleNamespace(id="q1", batchId=batch, stateOperators=operators)
        counter.onQueryProgress(SimpleNamespace(progress=progress))
    assert X.late_rows(spark, table, "q1") == 390 == X.late_rows(spark, table)
    assert X.late_rows(spark, table, "q2") == 0 == X.late_rows(spark, str(tmp_path / "none"))


def lines(*numbers):
    return "".join(json.dumps({"n": n}) + "\n" for n in numbers)


def test_appended_file(spark, tmp_path):
    file = tmp_path / "log.json"
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

        stream = read_appended_file(spark, str(file), range_bytes=16)
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
        query.trigger(availableNow=True).start().awaitTermination()
        return sorted(json.loads(r.value)["n"] for r in spark.read.parquet(out).collect())

    file.write_text(lines(1, 2) + '{"n": 3')
    assert run() == [1, 2]
    with file.open("a") as f:
        f.write("}\r\n\n" + lines(4))
    assert run() == [1, 2, 3, 4]
    file.write_text(lines(9))  # rotated: shorter than the saved offset
    assert run() == [1, 2, 3, 4, 9]


def test_ranges_cover_each_line_once(tmp_path):
    file = tmp_path / "x.log"
    file.write_text("".join(f"line-{i}-é{'x' * (i % 13)}\n" for i in range(200)), encoding="utf-8")
    for size in (1, 7, 64, 10_000):
        reader = AppendedFileReader({"path": str(file), "rangeBytes": str(size)})
        got = [v for p in reader.partitions({}, reader.latestOffset()) for (v,) in reader.read(p)]
        assert got == file.read_text(encoding="utf-8").splitlines()


def test_many_short_ranges_share_tasks(tmp_path):
    """The number of tasks is bounded; no line is lost or read twice."""
    file = tmp_path / "log"
    lines = [f"line {i} " + "x" * (i % 40) for i in range(4000)]
    file.write_text("\n".join(lines) + "\n")
    reader = AppendedFileReader({"path": str(file), "rangeBytes": "50"})
    parts = reader.partitions({}, reader.latestOffset())
    assert sum(len(p.ranges) for p in parts) > 2000 and len(parts) <= 256
    assert [v for p in parts for (v,) in reader.read(p)] == lines


def test_follow_file(spark, tmp_path):
    """History first, then only what was appended."""
    log = traffic(spark, range(7))
    file = tmp_path / "access.log"

    def append(part):
        with file.open("a") as f:
            f.writelines(r.v + "\n" for r in part.select(raw_json(part).alias("v")).collect())

    append(log)
    library = J.Library(spark, str(tmp_path / "lib"))
    out, table = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        X.follow_file(
            spark, str(file), library, CFG, out, str(tmp_path / "ckpt"), table, trigger=NOW
        ).awaitTermination()
        return spark.read.parquet(table).count()

    assert run() == log.count() and library.registry.active_id() is not None
    models = library.registry.models().count()
    noisy = traffic(spark, [7], noise=20)
    append(noisy)
    assert run() == log.count() + noisy.count()
    assert library.registry.models().count() == models
    assert read_alerts(spark, out).filter("ip = '10.0.0.0'").count() > 0


def test_follow_file_with_a_model_starts_at_the_beginning(spark, tmp_path, library):
    """Existing lines that no history step has used are scored and logged."""
    noisy = traffic(spark, [6, 7], noise=20)
    file = tmp_path / "access.log"
    file.write_text("".join(r.v + "\n" for r in noisy.select(raw_json(noisy).alias("v")).collect()))
    out, table = str(tmp_path / "out"), str(tmp_path / "log")
    X.follow_file(spark, str(file), library, CFG, out, str(tmp_path / "ckpt"), table, trigger=NOW).awaitTermination()
    assert spark.read.parquet(table).count() == noisy.count()
    assert read_alerts(spark, out).filter("ip = '10.0.0.0'").count() > 0


def test_follow_file_replays_history_once(spark, tmp_path):
    log = traffic(spark, range(7))
    file = tmp_path / "access.log"
    file.write_text("".join(r.v + "\n" for r in log.select(raw_json(log).alias("v")).collect()))
    library, table = J.Library(spark, str(tmp_path / "lib")), str(tmp_path / "log")
    for ckpt in ("a", "a", "b"):  # a restart, and a new checkpoint
        X.follow_file(
            spark, str(file), library, CFG, str(tmp_path / "out"), str(tmp_path / ckpt), table,
            history="replay", trigger=NOW,
        ).awaitTermination()
        assert spark.read.parquet(table).count() == log.count()
