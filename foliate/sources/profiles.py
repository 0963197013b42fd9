"""Profiles of stored datasets that merge from run to run.

A directory of a dataset is never changed, so what was counted in it holds as long as a
version names it. Counts, extremes and a distinct-values sketch are kept per
directory and column in ``<path>/profile``; a later profile reads only the directories that
merges have written since, and adds up the rest. Exact distinct counts need all rows
and are taken on request.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import MissingDataError
from foliate.operators import quality
from foliate.schema import quoted
from foliate.session import list_folder, remove_path, small_frame
from foliate.sources import store

#: A sketch has two to this power registers of one byte at most.
REGISTERS_LOG2 = 12
#: Three standard errors of a sketch: 1.04 by the root of its registers, each. United sketches have the same.
DISTINCT_ERROR = 3 * 1.04 / (1 << REGISTERS_LOG2) ** 0.5

#: The directory of a file: its bucket's, or the one of a dataset that has none.
_DIRECTORY = r"(data/[0-9a-f]{32}(?:/__bucket=-?\d+)?)/[^/]+$"


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype)
    return _has_map(dtype.elementType) if isinstance(dtype, T.ArrayType) else isinstance(dtype, T.MapType)


def _counted(field: T.StructField) -> Column:
    """What a sketch takes of a value: one text or number per value, whatever the width of an integer."""
    value = quoted(field.name)
    if isinstance(field.dataType, T.StringType):
        return value
    if isinstance(field.dataType, T.IntegralType):
        return value.cast("bigint")
    if _has_map(field.dataType):
        return F.to_json(F.struct(value)).cast("string")
    return F.when(value.isNotNull(), F.xxhash64(value))


def sketches(df: DataFrame, directory: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """``dir, column, rows, nulls, lowest, highest, sketch`` in one aggregation: only counts, extremes and sketches are shuffled."""
    fields = [f for f in df.schema if columns is None or f.name in columns]
    measured = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(quoted(f.name).isNull()).alias("nulls"),
            F.min(quoted(f.name).cast("string")).alias("lowest"),
            F.max(quoted(f.name).cast("string")).alias("highest"),
            F.hll_sketch_agg(_counted(f), REGISTERS_LOG2).alias("sketch"),
        )
        for f in fields
    ]
    return df.groupBy(directory.alias("dir")).agg(F.array(*measured).alias("measured")).select("dir", F.inline("measured"))


def _kept(spark: SparkSession, path: str) -> DataFrame | None:
    """All profiles written to their end, a directory's once even if two runs took it."""
    parts = [name for name in list_folder(spark, f"{path}/profile") if "_SUCCESS" in list_folder(spark, f"{path}/profile/{name}")]
    if not parts:
        return None
    rows = spark.read.parquet(*(f"{path}/profile/{name}" for name in sorted(parts)))
    return rows.dropDuplicates(["dir", "column"])


def _live(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """The directories of the current version. There are as many as buckets; their rows stay where they are."""
    dirs = sorted(set(store.layout(spark, path).dirs.values()))
    if not dirs:
        raise MissingDataError(f"{path} was never written")
    return dirs, small_frame(spark, [(d,) for d in dirs], "dir string")


def refresh(spark: SparkSession, path: str) -> int:
    """Profile the directories that have none yet; how many were read. One run at a time."""
    dirs, live = _live(spark, path)
    kept = _kept(spark, path)
    known = set() if kept is None else {r[0] for r in kept.join(live, "dir", "left_semi").select("dir").distinct().collect()}
    due = [d for d in dirs if d not in known]
    if due:
        rows = spark.read.parquet(*(f"{path}/{d}" for d in due))
        sketches(rows, F.regexp_extract(F.col("_metadata.file_path"), _DIRECTORY, 1)).write.parquet(f"{path}/profile/{uuid.uuid4().hex}")
    return len(due)


def dataset_profile(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """``column, rows, nulls, lowest, highest, distinct_values`` of the current rows of a stored dataset.

    Rows, nulls and extremes (of the values as text) are exact. ``distinct_values`` is an
    estimate whose standard error is a third of ``DISTINCT_ERROR``, or with ``exact``
    counted over all rows. A dataset without rows has no profile rows.

    Raises:
        MissingDataError: when the dataset was never written.
    """
    refresh(spark, path)
    _, live = _live(spark, path)
    kept = _kept(spark, path)
    if kept is None:
        raise MissingDataError(f"{path} has no profile")
    united = kept.join(live, "dir", "left_semi").groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"),
    )
    if not exact:
        return united
    return united.drop("distinct_values").join(quality.profile(store.read(spark, path)).select("column", "distinct_values"), "column")


def expected_values(profile: DataFrame, always_null: Sequence[str] = (), constant: Mapping[str, str] | None = None) -> DataFrame:
    """``column, expected, non_null, lowest, highest, holds`` for columns of a profile that should be empty, or hold one value.

    No row of the dataset is read: extremes that equal the expected value leave no room for another.
    """
    wanted = [(c, None) for c in always_null] + sorted((constant or {}).items())
    rules = small_frame(profile.sparkSession, wanted, "column string, expected string")
    non_null = F.col("rows") - F.col("nulls")
    one_value = F.col("lowest").eqNullSafe(F.col("expected")) & F.col("highest").eqNullSafe(F.col("expected"))
    return profile.join(rules, "column").select("column", "expected", non_null.alias("non_null"), "lowest", "highest", ((non_null == 0) | one_value).alias("holds"))


def vacuum(spark: SparkSession, path: str) -> int:
    """Write what is known of the live directories once, and remove all earlier profiles; how many folders went."""
    before = list(list_folder(spark, f"{path}/profile"))
    kept = _kept(spark, path)
    if kept is None or len(before) < 2:
        return 0
    _, live = _live(spark, path)
    kept.join(live, "dir", "left_semi").write.parquet(f"{path}/profile/{uuid.uuid4().hex}")
    for name in before:
        remove_path(spark, f"{path}/profile/{name}")
    return len(before)
