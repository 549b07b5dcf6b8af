"""JSON access-log sources: line-delimited or array files -> flat rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ACCESS_LOG, RAW_EVENT

_DATE_FORM = r"^\s*\d{4}-?\d{2}-?\d{2}"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2}))?"


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines -> ``event`` structs; blank lines drop, malformed ones are null.

    A line is one whole object: read as the only element of an array, text behind it
    is malformed too.
    """
    text = F.trim(F.regexp_replace(column, r"^[\s\uFEFF]+|\s+$", ""))
    kept = lines.withColumn(column, text).filter(F.col(column) != "")
    parsed = F.from_json(F.concat(F.lit("["), F.col(column), F.lit("]")), T.ArrayType(RAW_EVENT))
    whole = (F.size(parsed) == 1) & F.endswith(F.col(column), F.lit("}"))
    return kept.withColumn("event", F.when(whole, F.get(parsed, F.lit(0))))


def event_time(text: Column) -> Column:
    """ISO-8601 time, any offset or ``Z``; null when it is not a full date."""
    compact = F.regexp_replace(text, _COMPACT, "$1-$2-$3T$4:$5:$6")
    compact = F.regexp_replace(compact, "T::$", "")
    parsed = F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(compact))
    return F.when(text.rlike(_DATE_FORM), parsed)


def flatten(events: DataFrame, event: str = "event") -> DataFrame:
    """``event`` struct -> the nine access-log columns, defaults filled in."""

    def text(path: str, default: str = "") -> Column:
        return F.coalesce(F.col(f"{event}.{path}"), F.lit(default))

    response = f"{event}.http.response"
    return events.select(
        event_time(F.col(f"{event}.`@timestamp`")).alias("ts"),
        text("source.ip").alias("ip"),
        text("http.request.method", "GET").alias("method"),
        text("url.path").alias("path"),
        text("url.query").alias("query"),
        F.coalesce(F.col(f"{response}.status_code").try_cast("int"), F.lit(0)).alias("status"),
        F.coalesce(F.col(f"{response}.body.bytes").try_cast("bigint"), F.lit(0).cast("bigint")).alias("bytes"),
        text("user_agent.original").alias("ua"),
        text("http.request.referrer").alias("referrer"),
        *[c for c in events.columns if c not in (event, "value")],
    )


def is_good() -> Column:
    return F.col("ts").isNotNull() & (F.col("ip") != "")


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows with a valid time and an address, and the rest."""
    return records.filter(is_good()), records.filter(~is_good())


def observed_counts(records: DataFrame, observation) -> DataFrame:
    """Good rows; the numbers of good and bad ones arrive with the same pass."""
    counted = records.observe(
        observation,
        F.count(F.when(is_good(), 1)).alias("good"),
        F.count(F.when(~is_good(), 1)).alias("bad"),
    )
    return counted.filter(is_good())


def detect_layouts(spark: SparkSession, path: str) -> DataFrame:
    """``(path, layout)`` per file: ``array``, ``ndjson`` or ``empty``.

    Spark lists the files; tasks read only as many leading bytes of each as it
    takes to see its first non-blank character.
    """

    def first_char(batches):
        from urllib.parse import unquote, urlparse

        from pyarrow import fs

        for batch in batches:
            layouts = []
            for uri in batch["path"]:
                if urlparse(uri).scheme in ("file", ""):
                    store, name = fs.LocalFileSystem(), unquote(urlparse(uri).path)
                else:
                    store, name = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
                layout = "empty"
                with store.open_input_stream(name) as stream:
                    while chunk := stream.read(4096):
                        seen = chunk.decode("utf-8", "replace").lstrip(" \t\r\n\f\v\ufeff")
                        if seen:
                            layout = "array" if seen[0] == "[" else "ndjson"
                            break
                layouts.append(layout)
            yield pd.DataFrame({"path": batch["path"], "layout": layouts})

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(first_char, "path string, layout string")


def read_ndjson(spark: SparkSession, paths) -> DataFrame:
    return flatten(parse_lines(spark.read.text(paths)))


def read_json_arrays(spark: SparkSession, paths) -> DataFrame:
    """Array files; such a file cannot be split, so each is one task."""
    schema = T.StructType([*RAW_EVENT.fields, T.StructField("_corrupt", T.StringType())])
    events = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .json(paths)
    )
    fields = [F.col(f"`{name}`") for name in RAW_EVENT.names]
    return flatten(events.select(F.struct(*fields).alias("event")))


def read_access_logs(
    spark: SparkSession, path: str, layout: str = "auto"
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of a file or folder.

    ``layout``: ``ndjson``, ``array``, or ``auto`` to look at each file.
    """
    if layout == "ndjson":
        records = read_ndjson(spark, path)
    elif layout == "array":
        records = read_json_arrays(spark, path)
    else:
        # one short row per input file, the same list Spark's own listing holds
        found = detect_layouts(spark, path).collect()
        groups = {kind: [r.path for r in found if r.layout == kind] for kind in ("ndjson", "array")}
        parts = []
        if groups["ndjson"]:
            parts.append(read_ndjson(spark, groups["ndjson"]))
        if groups["array"]:
            parts.append(read_json_arrays(spark, groups["array"]))
        if not parts:
            records = spark.createDataFrame([], ACCESS_LOG)
        else:
            records = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return split_records(records)


def raw_json(log: DataFrame) -> Column:
    """Each flat row as one JSON event, for replays and tests."""

    def has(name: str, default) -> Column:
        return F.col(name) if name in log.columns else F.lit(default)

    response = F.struct(
        F.col("status").alias("status_code"),
        F.struct(has("bytes", 0).alias("bytes")).alias("body"),
    )
    return F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("@timestamp"),
            F.struct(F.col("ip")).alias("source"),
            F.struct("path", "query").alias("url"),
            F.struct(
                F.struct(has("method", "GET").alias("method")).alias("request"),
                response.alias("response"),
            ).alias("http"),
        )
    )
