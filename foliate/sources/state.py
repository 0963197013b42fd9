"""Sync state: when datasets were last loaded, and the activity time seen per record."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.schema import quoted
from foliate.session import small_frame
from foliate.sources import store

logger = logging.getLogger(__name__)

MARKS_SCHEMA = "dataset string, mark string"
SEEN_SCHEMA = "dataset string, id bigint, last_activity string"


def load_state(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """The stored ``marks`` and ``seen`` frames; empty ones when absent or unreadable.

    A state whose files can't be parsed means a full load, so it is noticed here (by reading one
    row and the columns) instead of in the middle of a run.
    """
    state = {}
    for name, schema in (("marks", MARKS_SCHEMA), ("seen", SEEN_SCHEMA)):
        empty = spark.createDataFrame([], schema)
        try:
            stored = store.read(spark, f"{directory}/{name}")
            if stored is None:
                state[name] = empty
            else:
                stored.limit(1).collect()
                state[name] = stored.select(*empty.columns)
        except (PySparkException, Py4JJavaError) as e:
            # A storage that doesn't answer fails the run; only contents that can't be parsed count as no state.
            if "is not a Parquet file" not in str(e) and "malformed" not in str(e).lower():
                raise
            logger.warning("WARNING: %s/%s cannot be read, so everything is loaded anew: %s", directory, name, e)
            state[name] = empty
    return state


def mark_of(marks: DataFrame, dataset: str) -> str | None:
    row = marks.where(F.col("dataset") == dataset).select("mark").first()
    return row["mark"] if row else None


def seen_of(seen: DataFrame, dataset: str) -> DataFrame:
    return seen.where(F.col("dataset") == dataset).select("id", "last_activity")


def seen_from(records: DataFrame, dataset: str, key: str = "id", ts_col: str = "dateLastActivity") -> DataFrame:
    """What to remember of a merged dataset: each record's activity time."""
    return records.select(
        F.lit(dataset).alias("dataset"), quoted(key).cast("bigint").alias("id"), quoted(ts_col).alias("last_activity")
    )


SEEN_KEYS = ("dataset", "id")


def commit_state(spark: SparkSession, directory: str, marks: Mapping[str, str | None], seen: DataFrame, merge: bool = False) -> None:
    """Replace the state; with ``merge`` the given rows of ``seen`` go into the stored ones. To be called last, after every dataset is written.

    The seen table goes first: if the run dies between the two, the marks only make
    the next run read more than it needs.
    """
    if merge:
        store.merge_dataset(spark, f"{directory}/seen", seen, SEEN_KEYS, ["last_activity"])
    else:
        store.replace_dataset(seen, f"{directory}/seen", SEEN_KEYS)
    rows = [(k, v) for k, v in marks.items() if v is not None]
    store.replace_dataset(small_frame(spark, rows, MARKS_SCHEMA), f"{directory}/marks")
