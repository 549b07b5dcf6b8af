"""URL and query text measures as native column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# \p{Nd}: any Unicode decimal digit; Java's \d is ASCII only.
_DIGITS = r"\p{Nd}+"
_NUMERIC_VALUE = r"(^|&)([^=&]*)=\p{Nd}+(?=&|$)"
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
_ALNUM = "[A-Za-z0-9]"


def path_template(path: Column) -> Column:
    """Each run of digits becomes ``#``."""
    return F.regexp_replace(path, _DIGITS, "#")


def query_template(query: Column) -> Column:
    """``k=<digits>`` becomes ``k=#``; every other part is kept."""
    return F.regexp_replace(query, _NUMERIC_VALUE, "$1$2=#")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and malformed escapes as they are."""
    guarded = F.replace(
        F.regexp_replace(text, _BAD_ESCAPE, "%25"), F.lit("+"), F.lit("%2B")
    )
    return F.when(F.instr(text, "%") > 0, F.url_decode(guarded)).otherwise(text)


def count_of(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, base 2; 0 for the empty text.

    Sorted characters fall into one run per distinct character, so the counts are
    the run lengths: log2(n) - sum(c * log2(c)) / n.
    """
    size = F.length(text)
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    runs = F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*"), F.lit(0))
    weighted = F.aggregate(
        F.transform(runs, F.length), F.lit(0.0), lambda total, c: total + c * F.log2(c)
    )
    return F.when(size == 0, F.lit(0.0)).otherwise(F.log2(size) - weighted / size)


def non_alnum_ratio(text: Column) -> Column:
    """Share of characters other than ASCII letters and digits."""
    other = F.length(F.regexp_replace(text, _ALNUM, ""))
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(other / F.length(text))


def gated_non_alnum(text: Column, min_length: int) -> Column:
    return F.when(F.length(text) >= min_length, non_alnum_ratio(text)).otherwise(F.lit(0.0))


def transition_rate(text: Column) -> Column:
    """Changes between the classes alphanumeric / other, per adjacent pair."""
    runs = F.regexp_replace(
        F.regexp_replace(text, _ALNUM + "+", "a"), "[^A-Za-z0-9]+", "_"
    )
    return F.when(F.length(text) < 2, F.lit(0.0)).otherwise(
        (F.length(runs) - 1) / (F.length(text) - 1)
    )


def max_param_entropy(query: Column) -> Column:
    """Largest entropy over the parameter values; empty values are skipped."""
    values = F.transform(
        F.split(query, "&"),
        lambda part: F.regexp_replace(part, r"^[^=]*=", ""),
    )
    return F.coalesce(
        F.array_max(F.transform(F.filter(values, lambda v: v != ""), entropy)), F.lit(0.0)
    )


def full_url(path: Column, query: Column) -> Column:
    return F.when(query == "", path).otherwise(F.concat(path, F.lit("?"), query))


def percent_share(text: Column) -> Column:
    return count_of(text, "%") / F.greatest(F.length(text), F.lit(1))


def param_count(query: Column) -> Column:
    return F.when(query == "", F.lit(0)).otherwise(F.size(F.split(query, "&")))


def shorten(text: Column, width: int = 100) -> Column:
    return F.when(
        F.length(text) > width,
        F.concat(F.substring(text, 1, width - 3), F.lit("...")),
    ).otherwise(text)


def with_decoded(requests: DataFrame) -> DataFrame:
    """Add ``path_dec`` and ``query_dec`` once, for all later measures."""
    return requests.withColumns(
        {
            "path_dec": percent_decode(F.col("path")),
            "query_dec": percent_decode(F.col("query")),
        }
    )


def with_request_text(requests: DataFrame, min_ratio_length: int = 8) -> DataFrame:
    """Every per-request measure that needs only the request's own text."""
    path, query = F.col("path"), F.col("query")
    path_dec, query_dec = F.col("path_dec"), F.col("query_dec")
    return with_decoded(requests).withColumns(
        {
            "path_norm": path_template(path),
            "query_shape": query_template(query),
            "path_non_alnum_ratio": gated_non_alnum(path_dec, min_ratio_length),
            "query_non_alnum_ratio": gated_non_alnum(query_dec, min_ratio_length),
            "encoded_ratio": percent_share(full_url(path, query)),
            "query_encoded_ratio": percent_share(query),
            "q_len": F.length(query),
            "param_count": param_count(query),
            "token_entropy": entropy(query_dec),
            "max_param_entropy": max_param_entropy(query_dec),
            "transition_rate": transition_rate(query_dec),
        }
    )


def url_suspicion(min_ratio_length: int = 8, long_query: int = 200) -> Column:
    """How suspicious one URL looks; reads ``path``, ``query`` and the decoded pair."""
    path_dec, query_dec = F.col("path_dec"), F.col("query_dec")
    # Weights of the URL score.
    return (
        gated_non_alnum(query_dec, min_ratio_length) * 20.0
        + gated_non_alnum(path_dec, min_ratio_length) * 10.0
        + transition_rate(query_dec) * 15.0
        + count_of(F.concat(F.col("query"), F.col("path")), "%") * 0.5
        + F.when(F.length(query_dec) > long_query, F.lit(5.0)).otherwise(F.lit(0.0))
    )
