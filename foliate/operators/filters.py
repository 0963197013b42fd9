"""Row selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import OptionError
from foliate.functions.dates import require_iso_date
from foliate.functions.text import has_text
from foliate.schema import quoted

# Timeline granularities, named groups of file stages.
INTERVALS = ("day", "month")
STAGE_GROUPS: dict[str, list[int] | None] = {
    "all": None,
    "galleys": [11],
    "review": [4, 15, 5],
}

# The code and the label of a published version.
PUBLISHED_CODE = 3
PUBLISHED_LABEL = "Published"


def keep_any_data(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows where at least one column outside ``keys`` is non-null and non-empty."""
    keys = set(keys)
    tests = [has_text(quoted(c)) for c in df.columns if c not in keys]
    if not tests:
        return df.where(F.lit(False))
    return df.where(reduce(lambda a, b: a | b, tests))


def keep_nonblank(df: DataFrame, column: str) -> DataFrame:
    return df.where(has_text(quoted(column)))


def drop_nonpositive(df: DataFrame, column: str) -> DataFrame:
    """Drop zero, negative and null measures; sums over the rest are unchanged for counts."""
    return df.where(quoted(column) > 0)


def keep_keyed(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows that could never join because a key is null."""
    return df.where(reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys]))


def stage_ids(group: str = "all", stages: Sequence[int] | None = None) -> list[int] | None:
    """The stage ids to keep: explicit ids, else those of a named group; ``None`` keeps all."""
    if stages:
        return list(stages)
    if group not in STAGE_GROUPS:
        raise OptionError(f"unknown file type {group!r}; expected one of: {', '.join(sorted(STAGE_GROUPS))}")
    return STAGE_GROUPS[group]


def select_files(
    files: DataFrame,
    ids: DataFrame | None = None,
    group: str = "all",
    stages: Sequence[int] | None = None,
    id_col: str = "_submission_id",
    stage_col: str = "fileStage",
) -> DataFrame:
    """File records of the given submissions and stages.

    ``ids`` is a frame whose first column holds submission ids. It stays a join,
    so its size is free; Spark broadcasts it when its measured size allows.
    """
    wanted = stage_ids(group, stages)
    if wanted is not None:
        files = files.where(quoted(stage_col).isin(wanted))
    if ids is not None:
        keys = ids.select(quoted(ids.columns[0]).alias("__id"))
        files = files.join(keys, quoted(id_col) == F.col("__id"), "left_semi")
    return files


def changed_since(df: DataFrame, since: str | None, ts_col: str) -> DataFrame:
    """Records newer than the mark; a record without a timestamp is kept.

    ``since`` is a ``Y-m-d H:i:s`` mark, compared strictly, or a plain date, which
    means that day and later. A text column in the same form orders the same way,
    so it is compared as it stands and the filter reaches the scan.
    """
    if since is None:
        return df
    ts = quoted(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        newer = ts > F.lit(since)
    else:
        mark = F.lit(since).cast("timestamp_ntz")
        newer = ts >= mark if len(since) == 10 else ts > mark
    return df.where(ts.isNull() | newer)


def date_window(df: DataFrame, date_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Points of a text-dated series between two days, both included.

    A month point (``YYYY-MM``) is compared with the month of the bound. The coarse
    month test is implied by the exact one; it is there because it can be pushed
    into the scan.
    """
    require_iso_date("start", start)
    require_iso_date("end", end)
    point = quoted(date_col)
    if start is not None:
        df = df.where((point >= start[:7]) & (point >= F.substring(F.lit(start), F.lit(1), F.length(point))))
    if end is not None:
        df = df.where((point <= end) & (point <= F.substring(F.lit(end), F.lit(1), F.length(point))))
    return df


def require_interval(interval: str) -> None:
    if interval not in INTERVALS:
        raise OptionError(f"unknown stats interval {interval!r}; expected one of: {', '.join(INTERVALS)}")


def of_interval(df: DataFrame, interval: str, column: str = "interval") -> DataFrame:
    """One granularity of a timeline; day and month points are never mixed."""
    require_interval(interval)
    return df.where(quoted(column) == interval)


def published_details(details: DataFrame, column: str = "status") -> DataFrame:
    return details.where(quoted(column) == PUBLISHED_CODE)


def published_rows(df: DataFrame, column: str = "status") -> DataFrame:
    return df.where(quoted(column) == PUBLISHED_LABEL)
