"""Explicit schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T

RAW_EVENT = T.StructType(
    [
        T.StructField("@timestamp", T.StringType()),
        T.StructField(
            "url",
            T.StructType(
                [
                    T.StructField("path", T.StringType()),
                    T.StructField("query", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "http",
            T.StructType(
                [
                    T.StructField(
                        "request",
                        T.StructType(
                            [
                                T.StructField("method", T.StringType()),
                                T.StructField("referrer", T.StringType()),
                            ]
                        ),
                    ),
                    T.StructField(
                        "response",
                        T.StructType(
                            [
                                # numbers of any form: 404.0 is 404
                                T.StructField("status_code", T.DoubleType()),
                                T.StructField(
                                    "body",
                                    T.StructType([T.StructField("bytes", T.DoubleType())]),
                                ),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField("source", T.StructType([T.StructField("ip", T.StringType())])),
        T.StructField(
            "user_agent", T.StructType([T.StructField("original", T.StringType())])
        ),
    ]
)

ACCESS_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("ip", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("ua", T.StringType()),
        T.StructField("referrer", T.StringType()),
    ]
)

REGISTRY_EVENT = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("train_window_start", T.TimestampType()),
        T.StructField("train_window_end", T.TimestampType()),
        T.StructField("n_train_windows", T.LongType()),
        T.StructField("fused_threshold", T.DoubleType()),
        T.StructField("catastrophic_threshold", T.DoubleType()),
        T.StructField("version", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("config", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

DECISION = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)
