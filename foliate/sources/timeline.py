"""Timelines kept by granularity and day, so that a window of days is read and rewritten without the rest.

The folders are Spark's own partitions, ``interval=day/date=2024-06-01``. A merge reads the days
its delta names, upserts into them, and overwrites only those, by Spark's dynamic partition
overwrite. That takes many steps on most file systems, so the merged days are first written
whole beside the table: a run that dies while the days are exchanged is finished by the next
merge or by ``recover``, and a merge that dies earlier has changed nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import OptionError
from foliate.operators.merge import ARRIVAL, last_wins_of, upsert
from foliate.schema import quoted
from foliate.session import list_folder, remove_path

#: What timelines are kept by: the granularity, then the period.
PERIOD = ("interval", "date")
#: Written whole before the days are exchanged. Spark's readers leave out names with an underscore.
PENDING = "_pending"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # A given schema keeps the periods text: month and day would otherwise be guessed apart.
    return spark.read.schema(schema).parquet(path)


def _schema_of(spark: SparkSession, path: str) -> T.StructType:
    """The stored columns, the periods as text and last, whatever Spark would guess from their folders."""
    found = spark.read.parquet(path).schema
    return T.StructType([f for f in found if f.name not in PERIOD] + [T.StructField(c, T.StringType()) for c in PERIOD])


def _exchange(df: DataFrame, path: str) -> None:
    """Overwrite the periods that ``df`` has rows of; a large one is written by several tasks."""
    placed = df.hint("rebalance", *PERIOD)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PERIOD).parquet(path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish an exchange of periods that a run began and did not end; whether there was one."""
    pending = f"{path}/{PENDING}"
    if "_SUCCESS" not in list_folder(spark, pending):
        remove_path(spark, pending)
        return False
    _exchange(spark.read.parquet(pending), path)
    remove_path(spark, pending)
    return True


def read_points(spark: SparkSession, path: str) -> DataFrame | None:
    """The points, of which a filter on ``interval`` or ``date`` reads only its folders; ``None`` for a table never written."""
    if not any("=" in name for name in list_folder(spark, path)):
        return None
    return _read(spark, path, _schema_of(spark, path))


def _as_stored(df: DataFrame) -> DataFrame:
    missing = [c for c in PERIOD if c not in df.columns]
    if missing:
        raise OptionError(f"a timeline needs the column {missing[0]}")
    return df.withColumns({c: quoted(c).cast("string") for c in PERIOD})


def replace_points(df: DataFrame, path: str) -> DataFrame:
    """Make ``df`` the whole timeline. An empty one is a table without folders, whose columns are known to the caller."""
    spark, points = df.sparkSession, _as_stored(df)
    remove_path(spark, f"{path}/{PENDING}")
    points.hint("rebalance", *PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PERIOD).parquet(path)
    stored = read_points(spark, path)
    return points.limit(0) if stored is None else stored


def _periods(df: DataFrame) -> list[tuple[str | None, str | None]]:
    """The periods a delta names: as many as its window has days, however many rows it has."""
    return [tuple(r) for r in df.select(*PERIOD).distinct().collect()]


def in_periods(periods: Sequence[tuple[str | None, str | None]]) -> Column:
    """Whether a row is in one of the periods, as a filter that is settled on the folders' names."""
    test = F.lit(False)
    for interval in sorted({i for i, _ in periods}, key=lambda i: (i is not None, i)):
        dates = sorted(d for i, d in periods if i == interval and d is not None)
        mine = F.col("date").isin(dates) if dates else F.lit(False)
        if (interval, None) in periods:
            mine = mine | F.col("date").isNull()
        test = test | ((F.col("interval").isNull() if interval is None else F.col("interval") == interval) & mine)
    return test


def merge_points(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Upsert ``new`` into the timeline and return the whole of it. The keys must hold the period.

    Only the folders of the periods in ``new`` are read and written. ``new`` is read several
    times: stage what is costly to compute.
    """
    if not set(PERIOD) <= set(keys):
        raise OptionError(f"a timeline is merged by keys that hold {' and '.join(PERIOD)}")
    recover(spark, path)
    points = _as_stored(new)
    existing = read_points(spark, path)
    if existing is None:
        target = [c for c in points.columns if c not in order_cols or c not in ARRIVAL]
        return replace_points(last_wins_of(points, keys, order_cols).select(*[quoted(c) for c in target]), path)
    periods = _periods(points)
    if not periods:
        return existing
    merged = upsert(existing.where(in_periods(periods)), points, keys, order_cols)
    merged = merged.select(*[quoted(f.name).cast(f.dataType) for f in existing.schema], *[quoted(c) for c in merged.columns if c not in existing.columns])
    merged.write.mode("overwrite").parquet(f"{path}/{PENDING}")
    recover(spark, path)
    return read_points(spark, path)
