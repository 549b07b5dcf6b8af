"""Exact interpolated percentiles by counting, without sorting and without edges.

The values of a rank are narrowed down by radix passes: a pass counts the values of the
ranges in question in BINS bins each, keeps the bins that hold wanted ranks, and goes on with
these, between the smallest and largest value found in them. A bin whose values are all
equal is the answer. A value costs one subtraction and division a pass, however many values there
are, and a pass returns at most BINS rows for each range.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins that one pass cuts a range into.
BINS = 4096
_LARGEST = 1.7976931348623157e308
#: Ranges whose ends are so many times apart are cut by the logarithm.
_WIDE = 1e6


def unpivot(df: DataFrame, columns, keys=()) -> DataFrame:
    """Long form ``(name, x)`` of the given numeric columns, behind the ``keys``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x")) for c in columns]
    )
    return df.select(*keys, F.inline(pairs))


@dataclass
class _Range:
    """The values of ``name`` from ``low`` to ``high``: their first rank, and the ranks wanted of them."""

    name: str
    low: float
    high: float
    start: int
    ranks: list[int]

    def row(self) -> tuple:
        """Ends on the scale the range is cut by: its logarithm if it spans many magnitudes."""
        apart, least = self.high - self.low, min(abs(self.low), abs(self.high))
        curved = not math.isfinite(apart) or apart > _WIDE * max(least, _TINY)
        low, high = (_curve(self.low), _curve(self.high)) if curved else (self.low, self.high)
        return self.name, self.low, self.high, curved, low, high - low


_ROW = "name string, low double, high double, curved boolean, from double, width double"


# The logarithm from 1e-300 on, shifted to begin at 0: a rising function, symmetric about 0.
_TINY, _SHIFT = 1e-300, 690.7755278982137


def _curve(x: float) -> float:
    return math.copysign(max(0.0, math.log(abs(x) + _TINY) + _SHIFT), x)


def _curved(x: Column) -> Column:
    return F.signum(x) * F.greatest(F.lit(0.0), F.log(F.abs(x) + _TINY) + _SHIFT)


def _counted(values: DataFrame, ranges: list[_Range], bins: int) -> dict[int, list]:
    """Each range's bins that hold values, rising: (bin, count, smallest, largest)."""
    spark = values.sparkSession
    table = spark.createDataFrame([(i, *r.row()) for i, r in enumerate(ranges)], f"range int, {_ROW}")
    table = table.withColumnRenamed("name", "_name")
    x = F.col("x")
    inside = (F.col("name") == F.col("_name")) & (x >= F.col("low")) & (x <= F.col("high"))
    place = (F.when(F.col("curved"), _curved(x)).otherwise(x) - F.col("from")) / F.col("width")
    bin_ = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(place * bins))).cast("int")
    found = values.join(F.broadcast(table), inside).groupBy("range", bin_.alias("bin")).agg(
        F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    by_range: dict[int, list] = {}
    for row in found.collect():  # at most ``bins`` rows a range
        by_range.setdefault(row.range, []).append(row)
    return {i: sorted(rows, key=lambda r: r.bin) for i, rows in by_range.items()}


def _selected(values: DataFrame, ranges: list[_Range], bins: int) -> dict[tuple[str, int], float]:
    """The value of each wanted rank (from 0)."""
    found = {}
    while ranges:
        for r in ranges:
            if r.low == r.high:
                found |= {(r.name, rank): r.low for rank in r.ranks}
        ranges = [r for r in ranges if r.low < r.high]
        if not ranges:
            break
        narrower = []
        for i, counted in _counted(values, ranges, bins).items():
            outer, start = ranges[i], ranges[i].start
            for row in counted:
                ranks = [k for k in outer.ranks if start <= k < start + row.n]
                if ranks and row.n == 2:  # both values are known
                    found |= {(outer.name, k): (row.low, row.high)[k - start] for k in ranks}
                elif ranks:
                    narrower.append(_Range(outer.name, row.low, row.high, start, ranks))
                start += row.n
        ranges = narrower
    return found


def percentile_rows(long: DataFrame, probs, bins: int = BINS) -> list[tuple[str, float, float]]:
    """(name, p, value) for each prob of each name; linear interpolation.

    ``long`` has ``(name, x)`` with a fixed, small set of names, and is read once for each pass, so
    it should be stored or cheap. Nulls and NaN are left out; infinite values count as the largest double.
    """
    x = F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), F.col("x")))
    values = long.filter(F.col("x").isNotNull() & ~F.isnan("x")).select("name", x.alias("x"))
    shape = values.groupBy("name").agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    shape = shape.collect()  # a row for each name
    probs = [float(p) for p in probs]
    ranges = []
    for row in shape:
        at = {p * (row.n - 1) for p in probs}
        ranks = sorted({math.floor(a) for a in at} | {min(math.floor(a) + 1, row.n - 1) for a in at})
        ranges.append(_Range(row.name, row.low, row.high, 0, ranks))
    of = _selected(values, ranges, bins)
    out = []
    for row in shape:
        for p in probs:
            rank = p * (row.n - 1)
            low = math.floor(rank)
            at, above = of[row.name, low], of[row.name, min(low + 1, row.n - 1)]
            out.append((row.name, p, at + (above - at) * (rank - low)))
    return out


def percentiles(long: DataFrame, probs, bins: int = BINS) -> DataFrame:
    """``percentile_rows`` as a table ``(name, p, value)``."""
    rows = percentile_rows(long, probs, bins)
    return long.sparkSession.createDataFrame(rows, "name string, p double, value double")


def percentile_values(df: DataFrame, wanted: dict[str, list[float]]) -> dict[tuple[str, float], float]:
    """Driver-side scalars: ``{(column, prob): value}``, one row per entry."""
    probs = sorted({p for ps in wanted.values() for p in ps})
    rows = percentile_rows(unpivot(df, list(wanted)), probs)
    return {(name, p): value for name, p, value in rows if p in wanted[name]}


def percentile_arrays(long: DataFrame, probs) -> DataFrame:
    """``(name, values)`` with the percentiles in prob order."""
    of: dict[str, list[float]] = {}
    for name, _, value in percentile_rows(long, sorted(float(p) for p in probs)):
        of.setdefault(name, []).append(value)
    return long.sparkSession.createDataFrame([*of.items()], "name string, values array<double>")


def percentiles_by(df: DataFrame, key: str, wanted: dict[str, list[float]]) -> DataFrame:
    """One row per key: each column's percentiles as an array in prob order, as ``percentile_rows`` has them.

    For groups of bounded size: a group's values are held in one row.
    """

    def of(column: str, probs: list[float]) -> Column:
        x = F.col(column).cast("double")
        x = F.when(~F.isnan(x), F.greatest(F.lit(-_LARGEST), F.least(F.lit(_LARGEST), x)))
        values = F.sort_array(F.collect_list(x))

        def at(p: float) -> Column:
            last = F.size(values) - 1
            rank = F.lit(float(p)) * last
            low = F.floor(rank).cast("int")
            here, above = F.get(values, low), F.get(values, F.least(low + 1, last))
            return here + (above - here) * (rank - low)

        return F.array(*[at(p) for p in probs]).alias(column)

    return df.groupBy(key).agg(*[of(column, probs) for column, probs in wanted.items()])
