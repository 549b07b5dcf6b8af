"""Broadcast of tables whose size is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a few numbers; about 40 MB on each executor.
BROADCAST_ROWS = 500_000


def sized(table: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (stored) to be broadcast if it has at most ``most`` rows; a larger one is shuffled."""
    return F.broadcast(table) if table.count() <= most else table
