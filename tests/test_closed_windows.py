from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logwarden.config import DetectorConfig
from logwarden.operators.features import entity_windows, request_features, time_window, url_rollup, url_windows
from logwarden.plans import workflows as J
from logwarden.sources.access_logs import raw_json
from logwarden.streaming import closed_windows as C
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


def six(df):
    rows = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()]
    return sorted(rows, key=repr)


def test_urls_add_up_to_the_same_windows(spark, library):
    log = traffic(spark, [6, 7], noise=20).unionByName(traffic(spark, [7]))
    profile = library.active().profile
    urls = url_rollup(log, time_window(F.col("ts"), CFG), CFG)
    assert six(url_windows(urls, profile, CFG)) == six(entity_windows(request_features(log, profile, CFG), CFG))


def test_closed_windows_carry_all_urls(spark, tmp_path, library):
    """Window 6 arrives in two files and closes with the second; window 7 stays open."""
    noisy = traffic(spark, [6, 7], noise=20)
    at = "timestamp '2024-01-01 06:30:00'"
    write_json(noisy.filter(f"ts < {at}"), tmp_path / "in")
    write_json(noisy.filter(f"ts >= {at}"), tmp_path / "in")
    out = str(tmp_path / "out")
    for _ in range(2):  # a restart adds nothing
        C.score_closed_windows(
            X.stream_directory(spark, str(tmp_path / "in")), library, CFG, out, str(tmp_path / "ckpt"),
            delay="5 minutes", trigger=NOW,
        ).awaitTermination()
    got = spark.read.schema("ip string, url string, window_start_utc timestamp").json(f"{out}/*/*")
    want = J.score_with_active(noisy.filter("hour(ts) = 6"), library, CFG)
    assert want.count() > 0
    assert six(got.select("ip", "url")) == six(want.select("ip", "url"))


def arrivals(spark, tmp_path, *parts):
    for part in parts:
        write_json(part, tmp_path / "in")


def correct(spark, tmp_path, library, **options):
    C.score_with_corrections(
        X.stream_directory(spark, str(tmp_path / "in")), library, CFG, str(tmp_path / "root"),
        str(tmp_path / "ckpt"), delay="5 minutes", trigger=NOW, **options,
    ).awaitTermination()
    return str(tmp_path / "root")


def test_late_rows_make_a_new_version(spark, tmp_path, library):
    log = traffic(spark, [6, 7, 8], noise=20)
    late = (F.hour("ts") == 6) & (F.col("ip") == "10.0.0.0") & (F.minute("ts") >= 12)
    on_time = log.filter(~late)
    arrivals(spark, tmp_path, on_time.filter("hour(ts) < 8"), on_time.filter("hour(ts) = 8"))
    root = correct(spark, tmp_path, library)
    # 12 requests only: the window of the loud address is too small to be scored
    assert C.current_windows(spark, root).filter("ip = '10.0.0.0' AND hour(window_ts) = 6").count() == 0
    others = C.current_windows(spark, root).filter("ip <> '10.0.0.0'").select("ip", "window_ts", "batch_id")
    before = six(others)

    arrivals(spark, tmp_path, log.filter(late))
    correct(spark, tmp_path, library)
    profile = library.active().profile
    whole = entity_windows(request_features(log.filter("hour(ts) < 8"), profile, CFG), CFG)
    got = C.current_windows(spark, root).select(whole.columns)
    assert six(got) == six(whole)
    assert six(others) == before  # only the late pair was scored again
    alerts = C.current_alerts(spark, root).filter("ip = '10.0.0.0' AND hour(window_start_utc) = 6")
    want = log.filter("ip = '10.0.0.0' AND hour(ts) = 6").select("path", "query").distinct()
    assert alerts.count() == want.count() > 0


def test_newest_version_wins(spark):
    """A window whose newest version is not flagged has no alerts, and runs are kept apart."""
    schema = "run string, ip string, window_ts timestamp, batch_id int"
    at = datetime(2024, 1, 1, 6)
    versions = spark.createDataFrame([("r", "a", at, 0), ("r", "a", at, 4), ("r", "b", at, 1), ("s", "a", at, 2)], schema)
    alerts = spark.createDataFrame(
        [("r", "a", at, 0, "/old"), ("r", "b", at, 1, "/b"), ("s", "a", at, 2, "/s")], schema + ", url string"
    ).withColumnRenamed("window_ts", "window_start_utc")
    assert {r.url for r in C._newest(alerts, versions, "window_start_utc").collect()} == {"/b", "/s"}
    assert sorted((r.run, r.ip, r.batch_id) for r in C._newest(versions, versions, "window_ts").collect()) == [
        ("r", "a", 4), ("r", "b", 1), ("s", "a", 2)
    ]


def test_too_late_rows_are_set_aside(spark, tmp_path, library):
    arrivals(spark, tmp_path, traffic(spark, [30, 31]), traffic(spark, [6]))
    root = correct(spark, tmp_path, library, keep="12 hours")
    aside = spark.read.parquet(f"{root}/too_late")
    assert aside.agg(F.sum("n")).first()[0] == 100
    assert C.current_windows(spark, root).filter("hour(window_ts) = 6 AND day(window_ts) = 1").count() == 0


def test_a_late_batch_over_many_hours_writes_few_files(spark, tmp_path, library):
    """Its rows are spread over all tasks; each of these had a file for every hour."""
    late = traffic(spark, range(30))
    arrivals(spark, tmp_path, traffic(spark, [50, 51]), traffic(spark, [52]), late)
    root = correct(spark, tmp_path, library)
    counts = spark.read.parquet(f"{root}/counts").filter("batch_id = 2")
    assert counts.agg(F.sum("n")).first()[0] == late.count()
    # the days are 2, and a task writes another file only where a day begins
    assert len(counts.inputFiles()) <= 2 + int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert C.current_windows(spark, root).filter("window_ts < timestamp '2024-01-02 06:00:00'").count() == 30 * 4


def test_the_whole_log_is_corrected_however_long_it_is(spark, tmp_path):
    """The queries' log spans more than the 28 days that are kept by default."""
    from logwarden.checks import queries as Q

    ids = [*range(900), *range(300_000, 301_800)]  # three hours, and six hours 41 days later
    rows = [(i, i % 8, "error" if i % 50 == 0 else "view") for i in ids]
    spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string").write.parquet(str(tmp_path / "events.parquet"))
    pages = [(0, "https://a.example/p/1?page=2"), (1, "https://a.example/q")]
    spark.createDataFrame(pages, "page_id bigint, url string").write.parquet(str(tmp_path / "pages.parquet"))
    windows = Q.queries()["t6_late_corrections"](spark, str(tmp_path))
    assert windows.filter("window_ts < timestamp_ntz '2024-01-02 00:00:00'").agg(F.sum("n_requests")).first()[0] == 900


def test_state_of_open_windows_is_not_held_on_the_heap(spark, tmp_path, library):
    """A query that was started with another provider goes on with it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    write_json(traffic(spark, [6, 7]), tmp_path / "in")
    records = X.stream_directory(spark, str(tmp_path / "in"))

    def metrics(checkpoint):
        run = C.score_closed_windows(
            records, library, CFG, str(tmp_path / "out"), str(tmp_path / checkpoint), delay="5 minutes", trigger=NOW
        )
        run.awaitTermination()
        return run.lastProgress["stateOperators"][0]["customMetrics"]

    assert "rocksdbPutCount" in metrics("ckpt")
    assert spark.conf.get(key) == before
    started = C.closed_url_counts(records, CFG, "5 minutes").writeStream.outputMode("append")
    started = started.foreachBatch(lambda batch, _: batch.count()).option("checkpointLocation", str(tmp_path / "heap"))
    started.trigger(**NOW).start().awaitTermination()
    write_json(traffic(spark, [8]), tmp_path / "in")
    assert "rocksdbPutCount" not in metrics("heap")
