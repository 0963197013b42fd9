"""Upserts and high-water marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions.dates import SYNC_OVERLAP, mark_text, window_text
from foliate.operators.joins import arrival_order, last_wins
from foliate.schema import quoted

Key = str | Column

#: Columns that only say in which order rows arrived.
ARRIVAL = ("_landed_at", "_landed_file", "_seq")


def _with_keys(df: DataFrame, keys: Sequence[Key]) -> tuple[DataFrame, list[str]]:
    """Give expression keys a column, so that every key can be named."""
    extra = {f"__key{i}": k for i, k in enumerate(keys) if isinstance(k, Column)}
    names = [f"__key{i}" if isinstance(k, Column) else k for i, k in enumerate(keys)]
    return (df.withColumns(extra) if extra else df), names


def upsert(
    existing: DataFrame, new: DataFrame, keys: Sequence[Key], order_cols: Sequence[str]
) -> DataFrame:
    """``existing`` with every row of ``new`` put in place of the row with its key.

    The last duplicate in ``new`` wins (by ``order_cols``), null
    keys match each other, and repeating the call changes nothing. Only the keys of
    ``new`` meet ``existing``, in an anti join: with a small delta they are broadcast
    from their measured size and the existing rows are streamed through unshuffled.
    Order columns that ``existing`` lacks are used and left out.
    """
    existing, names = _with_keys(existing, keys)
    new, _ = _with_keys(new, keys)
    latest = last_wins(new, names, order_cols)
    touched = new.select(*[quoted(k).alias(f"__new{i}") for i, k in enumerate(names)]).distinct()
    same = None
    for i, k in enumerate(names):
        test = quoted(k).eqNullSafe(F.col(f"__new{i}"))
        same = test if same is None else same & test
    kept = existing.join(touched, same, "left_anti")
    helpers = [n for n in names if n.startswith("__key")]
    helpers += [c for c in order_cols if c not in existing.columns]
    return kept.unionByName(latest, allowMissingColumns=True).drop(*helpers)


def last_wins_of(new: DataFrame, keys: Sequence[Key], order_cols: Sequence[str]) -> DataFrame:
    """The rows an upsert of ``new`` into nothing leaves: the last one per key."""
    keyed, names = _with_keys(new, keys)
    return last_wins(keyed, names, order_cols).drop(*[n for n in names if n.startswith("__key")])


def upsert_positions(existing: DataFrame, new: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Upsert that keeps list order: a replaced row stays where it was, a new one is appended.

    ``seq`` is the position within its own input. The result carries ``source`` (0
    for the existing list, 1 for appended) and the ``seq`` of the place, which
    together order it. Existing duplicates of a key collapse to one row.
    """
    both = existing.withColumn("source", F.lit(0)).unionByName(
        new.withColumn("source", F.lit(1)), allowMissingColumns=True
    )
    place = F.struct("source", quoted(seq))
    fields = [c for c in existing.columns if c not in keys and c != seq]
    merged = both.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(F.struct(*[quoted(c) for c in fields]), place).alias("__row"), F.min(place).alias("__place")
    )
    return merged.select(
        *[quoted(c) if c in keys else F.col("__row")[c].alias(c) for c in existing.columns if c != seq],
        F.col("__place")["source"].alias("source"),
        F.col("__place")[seq].alias(seq),
    )


def high_water(df: DataFrame, ts_col: str, overlap: str = SYNC_OVERLAP) -> DataFrame:
    """One row with ``mark``: the latest activity less the overlap as text, null without any."""
    ts = quoted(ts_col)
    if dict(df.dtypes)[ts_col] == "string":
        ts = F.nullif(ts, F.lit("")).try_cast("timestamp_ntz")
    return df.agg(mark_text(F.max(ts), overlap).alias("mark"))


def high_water_mark(df: DataFrame, ts_col: str, overlap: str = SYNC_OVERLAP) -> str | None:
    return high_water(df, ts_col, overlap).first()["mark"]


def window_start(marks: DataFrame, dataset: str, overlap: str = SYNC_OVERLAP, fallback: str | None = None) -> str | None:
    """The day a windowed dataset is re-read from.

    Taken from the mark of ``dataset``, else from that of ``fallback``; ``None``
    without either means everything.
    """
    found = {
        row["dataset"]: row["day"]
        for row in marks.where(F.col("dataset").isin([dataset, fallback or dataset]))
        .select("dataset", window_text(F.col("mark").try_cast("timestamp_ntz"), overlap).alias("day"))
        .collect()
    }
    return found.get(dataset) or found.get(fallback)


def with_arrival(df: DataFrame, column: str = "_seq") -> DataFrame:
    """Give the rows of a fresh file read their order of arrival, so that "last" has a meaning later on."""
    return df.withColumn(column, arrival_order())
