import json
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logwarden.schemas import ACCESS_LOG
from logwarden.sources import access_logs as L
from logwarden.sources import log_table as H

GOOD = {
    "@timestamp": "2024-01-01T10:00:00Z",
    "source": {"ip": "10.0.0.3"},
    "url": {"path": "/en/12", "query": "page=2"},
    "http": {"request": {"method": "POST"}, "response": {"status_code": 200, "body": {"bytes": 512}}},
    "user_agent": {"original": "ua"},
}


def event(**changes):
    return json.dumps({**GOOD, **changes})


EDGE_LINES = [
    event(),
    "",
    "   ",
    event()[:50],
    event(**{"@timestamp": None}),
    event(**{"@timestamp": "yesterday"}),
    event(**{"@timestamp": "2024"}),
    event(source={"ip": ""}),
    event(source={}),
    event(url=None, http=None, user_agent=None),
    event(**{"@timestamp": "2024-01-01T10:00:00+05:30"}),
    event(**{"@timestamp": "2024-01-02"}),
    event(**{"@timestamp": "20240103T101112Z"}),
    event(http={"request": {}, "response": {"status_code": None}}),
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.json").write_text("\n".join(EDGE_LINES) + "\n")
    return tmp_path


def test_ndjson_edges(spark, folder):
    good, bad = L.read_access_logs(spark, str(folder), "ndjson")
    rows = good.orderBy("ts").collect()
    assert bad.count() == 6 and len(rows) == 6
    assert [str(r.ts) for r in rows] == [
        "2024-01-01 04:30:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00", "2024-01-01 10:00:00",
        "2024-01-02 00:00:00", "2024-01-03 10:11:12",
    ]
    plain = [r for r in rows if r.path == ""][0]
    assert (plain.query, plain.method, plain.status, plain.bytes, plain.ua, plain.referrer) == (
        "", "GET", 0, 0, "", "",
    )
    assert sorted(r.status for r in rows) == [0, 0, 200, 200, 200, 200]
    assert good.schema.names == ACCESS_LOG.names


def test_layouts_are_found_per_file(spark, tmp_path):
    (tmp_path / "lines.json").write_text(event() + "\n" + event() + "\n")
    (tmp_path / "array.json").write_text(" \n\t[\n " + event() + ",\n " + event(source={}) + ", " + event() + "]\n")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "blank.json").write_text("\n  \n" * 3_000)
    layouts = {r.path.rsplit("/", 1)[1]: r.layout for r in L.detect_layouts(spark, str(tmp_path)).collect()}
    assert layouts == {"lines.json": "ndjson", "array.json": "array", "blank.json": "empty"}  # Spark lists no zero-byte files
    good, bad = L.read_access_logs(spark, str(tmp_path))
    assert (good.count(), bad.count()) == (4, 1)


def test_only_empty_files(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    good, bad = L.read_access_logs(spark, str(tmp_path))
    assert good.count() == 0 and bad.count() == 0 and good.schema.names == ACCESS_LOG.names


def test_counts_arrive_with_the_pass(spark, folder):
    seen = Observation("records")
    good = L.observed_counts(L.read_ndjson(spark, str(folder)), seen)
    assert good.count() == 6
    assert seen.get == {"good": 6, "bad": 6}


def records(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    return df.select(
        F.to_timestamp("s").alias("ts"), F.lit("1.1.1.1").alias("ip"), F.lit("GET").alias("method"),
        F.lit("/").alias("path"), F.lit("").alias("query"), F.lit(200).alias("status"),
        F.lit(0).cast("bigint").alias("bytes"), F.lit("").alias("ua"), F.lit("").alias("referrer"),
    )


STAMPS = ["2024-01-01 00:00:00", "2024-01-10 00:00:00", "2024-01-15 00:00:00", "2024-02-11 23:59:59"]


def test_log_table(spark, tmp_path):
    path = str(tmp_path / "log")
    H.append_records(records(spark, STAMPS[:2]), path, 0)
    H.append_records(records(spark, STAMPS[2:]), path, 1)
    H.append_records(records(spark, STAMPS[2:]), path, 1)  # a retried batch
    log = H.read_log_table(spark, path)
    assert log.count() == 4
    part = H.time_range(log, datetime(2024, 1, 10), datetime(2024, 1, 15))
    assert [str(r.ts) for r in part.collect()] == [STAMPS[1]]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThanOrEqual(ts" in plan


def test_retention_and_slices(spark):
    log = records(spark, STAMPS)
    assert H.retained(log, 28).count() == 2
    slices = {r.slice: (str(r.slice_start), r.n) for r in H.slice_starts(log, 14).collect()}
    assert slices == {
        0: (STAMPS[0], 2), 1: (STAMPS[2], 1), 2: ("2024-01-29 00:00:00", 1),
    }
