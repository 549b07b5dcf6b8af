"""Run registered queries in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import datetime
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return round(value, 5) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(value)
    return value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rows = df.collect()
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = _bag(df.columns, rows), _bag(names, expected)
    if got != want:
        only_got, only_want = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{len(rows)} rows vs {len(expected)}; spark only {only_got}; sql only {only_want}"
    return None


def schema_gap(df, con, sql: str) -> list[str]:
    """Columns whose types do not line up, for reading."""
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    result = con.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {r[0]: r[1] for r in result}
    return [f"{c}: {k} vs {duck_types.get(c)}" for c, k in df.dtypes if kinds.get(k) != duck_types.get(c)]


if __name__ == "__main__":
    import __spark_entry__ as entry

    from logwarden.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf_dir), entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                note = compare(df, con, sqls[name])
                gap = schema_gap(df, con, sqls[name])
                print("##", "OK  " if note is None else "DIFF", name, df.count(), note or "", gap or "",
                      f"{time.time() - start:.1f}s", flush=True)
            else:
                print("##", "ROWS", name, df.count(), f"{time.time() - start:.1f}s", flush=True)
        except Exception as error:
            print("##", "FAIL", name, str(error)[:600].replace("\n", " "), flush=True)
    missing = set(sqls) - set(entry.queries())
    print("## sql without query:", missing)
