"""Access logs for tests."""


def make_log(spark, rows):
    """Rows of ``(ts, ip, path, query, status)`` as an access log."""
    return spark.createDataFrame(
        rows, "ts string, ip string, path string, query string, status int"
    ).selectExpr("cast(ts as timestamp) ts", "ip", "path", "query", "status")
