"""Scalar measures against Python's own string handling."""

import math
import re
from collections import Counter
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from logwarden.functions import text as T

SAMPLES = [
    "", "a", "/a/b?x", "%41+b%zz%", "caf%C3%A9 x", "%FF%FEab", "😀%20😀a", "id=٣٤&x=12",
    "line\nbreak=1", "%%41", "100%", "a=1=2", "=5", "a=1&&z=", "page=2&ref=x", "k=12&k2=v12&n=007",
    "id=9%27%20OR%201%3D1--" * 12, "..//..", "ABCdef123",
]


def py_entropy(s):
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values()) if s else 0.0


def is_alnum(c):
    return c.isascii() and c.isalnum()


def py_ratio(s):
    return sum(not is_alnum(c) for c in s) / len(s) if s else 0.0


def py_transitions(s):
    if len(s) < 2:
        return 0.0
    return sum(is_alnum(a) != is_alnum(b) for a, b in zip(s, s[1:])) / (len(s) - 1)


def py_shape(q):
    done = []
    for part in q.split("&"):
        key, eq, value = part.partition("=")
        done.append(f"{key}=#" if eq and value and all(c.isdecimal() for c in value) else part)
    return "&".join(done)


def py_param_entropy(q):
    values = [p.partition("=")[2] if "=" in p else p for p in q.split("&")]
    return max([py_entropy(v) for v in values if v], default=0.0)


CASES = {
    "path_template": (T.path_template, lambda s: re.sub(r"\d+", "#", s)),
    "query_template": (T.query_template, py_shape),
    "percent_decode": (T.percent_decode, unquote),
    "entropy": (T.entropy, py_entropy),
    "non_alnum_ratio": (T.non_alnum_ratio, py_ratio),
    "gated": (lambda c: T.gated_non_alnum(c, 8), lambda s: py_ratio(s) if len(s) >= 8 else 0.0),
    "transition_rate": (T.transition_rate, py_transitions),
    "max_param_entropy": (T.max_param_entropy, py_param_entropy),
    "percent_share": (T.percent_share, lambda s: s.count("%") / max(len(s), 1)),
    "param_count": (T.param_count, lambda s: len(s.split("&")) if s else 0),
    "shorten": (T.shorten, lambda s: s if len(s) <= 100 else s[:97] + "..."),
}


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(s,) for s in SAMPLES], "s string")


@pytest.mark.parametrize("name", CASES)
def test_against_python(table, name):
    column, expected = CASES[name]
    for row in table.select("s", column(F.col("s")).alias("got")).collect():
        want = expected(row.s)
        if isinstance(want, float):
            assert row.got == pytest.approx(want, abs=1e-12), row.s
        else:
            assert row.got == want, row.s


def test_full_url(spark):
    df = spark.createDataFrame([("/a", ""), ("/a", "x=1")], "path string, query string")
    got = [r.u for r in df.select(T.full_url(F.col("path"), F.col("query")).alias("u")).collect()]
    assert got == ["/a", "/a?x=1"]


def test_bounds_hold_on_the_whole_log(spark, sf_dir):
    from logwarden.fixture import access_log

    text = T.with_request_text(access_log(spark, sf_dir))
    broken = text.filter(
        (F.col("token_entropy") < 0)
        | (F.col("token_entropy") > F.log2(F.greatest(F.length("query_dec"), F.lit(1))) + 1e-9)
        | ~F.col("transition_rate").between(0, 1)
        | ~F.col("encoded_ratio").between(0, 1)
    )
    assert broken.isEmpty()
