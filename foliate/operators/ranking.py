"""Numbering rows within a group when a group may be a large share of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.schema import quoted
from foliate.session import materialize


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    number_col: str,
    by_ranges: bool = False,
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``.

    The caller knows whether groups are bounded. As a rule a grouped window does the
    work. With ``by_ranges``, for groups without a bound, the rows are range-partitioned
    by key and order, so a hot group spreads over many partitions, numbered inside
    their partition, and shifted by the rows of the same group in earlier partitions.
    Both number alike where ``order`` has no ties.

    With no ``keys`` the whole table is one group and is numbered in its total order.
    """
    if keys and not by_ranges:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(number_col, F.row_number().over(window).cast("bigint"))
    return _number_by_ranges(df, keys, order, number_col)


def spread_by_range(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition by ``order``, splitting groups of rows that are equal in it.

    Rows that tie are told apart by a hash of their columns and, when they are
    copies of each other, by the partition they come from. Both stay the same when
    a task is retried, so no row is sent twice or lost.
    """
    hashable = [quoted(n) for n, t in df.dtypes if "map<" not in t and "variant" not in t]
    ties = {"__hash": F.xxhash64(*hashable), "__from": F.spark_partition_id()}
    return df.withColumns(ties).repartitionByRange(*order, *ties).drop(*ties)


def _number_by_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], number_col: str) -> DataFrame:
    ranged = spread_by_range(df, [*[quoted(k) for k in keys], *order])
    # Written once: counts and rows below must agree on which partition a row is in.
    placed = materialize(ranged.withColumn("__part", F.spark_partition_id()))
    slice_keys = [*keys, "__part"]
    counts = placed.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *[quoted(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__part").alias("__shift_part"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__shift"),
    )
    local = Window.partitionBy(*slice_keys).orderBy(*order)
    numbered = placed.withColumn("__local", F.row_number().over(local))
    same_slice = F.col("__part") == F.col("__shift_part")
    for i, k in enumerate(keys):
        same_slice = same_slice & quoted(k).eqNullSafe(F.col(f"__k{i}"))
    return numbered.join(shifts, same_slice).select(
        *[quoted(c) for c in df.columns], (F.col("__local") + F.col("__shift")).cast("bigint").alias(number_col)
    )
