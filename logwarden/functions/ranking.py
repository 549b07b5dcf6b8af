"""Row numbers inside groups, also when one group holds most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... (bigint) inside each group, by ``order`` (all ascending).

    The rows are range partitioned by (keys, order), so a large group is spread
    over many tasks, and stored. A row's rank is its place in its partition, less
    the place where its group starts there, plus the group's rows in earlier
    partitions. Null keys form a group. ``order`` should end in a unique column;
    ``df`` should be stored or cheap, because range partitioning samples it first.
    """
    placed = df.withColumns({f"_order{i}": c for i, c in enumerate(order)})
    by = [*keys, *(f"_order{i}" for i in range(len(order)))]
    spread = placed.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = stage(
        spread.drop(*by[len(keys):]).withColumns(
            {"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()}
        ),
        "ranks",
    )
    runs = rows.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_n").over(before), F.lit(0))
    starts = runs.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_part").alias("_run"),
        (earlier - F.col("_first") + 1).alias("_shift"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    joined = rows.join(starts, reduce(Column.__and__, same, F.col("_part") == F.col("_run")))
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))
