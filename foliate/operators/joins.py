"""Joins, each written so that a hot key does not land in one task.

De-duplication before a join is an aggregation with a map-side half, so copies of
one key collapse before they are shuffled. Null keys, which can never match, are
spread over salts instead of meeting in one partition. No side is broadcast by
hint; Spark does that from the sizes it measures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.errors import MissingDataError, OptionError
from foliate.functions.text import literal_map
from foliate.schema import quoted
from foliate.session import small_frame


def arrival_order() -> Column:
    """Position of a row of a file read: its file's path, the block, then the place in the block.

    Only to be applied directly to a read. Spark plans files by size, so the number of
    a row in the scan alone would follow the sizes of the files and not their names.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def order_of(df: DataFrame) -> list[str]:
    """The order "the last one wins" goes by: ``_seq`` where the frame has it, else the values of its plain columns."""
    if "_seq" in df.columns:
        return ["_seq"]
    return [n for n, t in df.dtypes if not t.startswith(("map", "array", "struct", "variant"))]


def last_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order_cols``.

    Null keys form a group like any other value.

    Raises:
        OptionError: without an order, because rows have none of their own.
    """
    if not order_cols:
        raise OptionError("which row is the last? give order_cols")
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    order = F.struct(*[quoted(c) for c in order_cols])
    picked = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(F.struct(*[quoted(c) for c in others]), order).alias("__row")
    )
    return picked.select(*[quoted(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])


def left_join_last(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    order_cols: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """``left`` with the last matching ``right`` row, or nulls.

    ``unique`` states that the right key is already unique (as in a dataset kept by
    :func:`~foliate.operators.merge.upsert`), which saves the aggregation.
    """
    side = right if unique else last_wins(right, [right_key], order_cols)
    side = side.withColumnRenamed(right_key, "__right_key")
    return left.join(side, quoted(left_key) == F.col("__right_key"), "left").drop("__right_key")


def unambiguous_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value. Equal extremes say so without a distinct count."""
    keyed = df.where(quoted(key) != "") if dict(df.dtypes)[key] == "string" else df.where(quoted(key).isNotNull())
    return (
        keyed.groupBy(quoted(key).alias("__key"))
        .agg(F.min(quoted(value)).alias("__low"), F.max(quoted(value)).alias("__high"))
        .where(F.col("__low") == F.col("__high"))
        .select("__key", F.col("__low").alias("__value"))
    )


def ambiguous_keys(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that more than one distinct value claims, with how many and the extremes."""
    counted = df.where(quoted(key).isNotNull()).groupBy(quoted(key).alias(key)).agg(
        F.count_distinct(quoted(value)).alias("n_values"),
        F.min(quoted(value)).alias("lowest"),
        F.max(quoted(value)).alias("highest"),
    )
    return counted.where((F.col("n_values") > 1) & (quoted(key).cast("string") != ""))


def unambiguous_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    value_col: str,
    as_col: str | None = None,
    row_id: Sequence[str] | None = None,
) -> DataFrame:
    """``left`` with the one value its key maps to; null when the key maps to none or to several.

    Compared exactly, empty keys never match. Rows without a key carry a salt that
    the lookup side never has, so a large unmatched share is spread evenly. The
    salt is a hash of ``row_id`` (by default of all hashable columns): a retried
    task then sends each row to the same place again.
    """
    # Always 0, but not a literal: the optimizer would turn the comparison with one
    # into a filter and exchange on the key alone.
    zero = F.pmod(F.xxhash64("__key"), F.lit(1)).cast("bigint")
    lookup = unambiguous_values(right, right_key, value_col).withColumn("__salt_r", zero)
    usable = quoted(left_key).isNotNull()
    if dict(left.dtypes)[left_key] == "string":
        usable = F.coalesce(quoted(left_key) != "", F.lit(False))
    hashable = row_id or [n for n, t in left.dtypes if "map<" not in t and "variant" not in t]
    # The whole hash, made odd and so never 0: as many places as there are rows.
    spread = F.xxhash64(*[quoted(c) for c in hashable]).bitwiseOR(F.lit(1).cast("bigint"))
    salted = left.withColumn("__salt_l", F.when(usable, F.lit(0).cast("bigint")).otherwise(spread))
    joined = salted.join(
        lookup, (quoted(left_key) == F.col("__key")) & (F.col("__salt_l") == F.col("__salt_r")), "left"
    )
    return joined.select(*[quoted(c) for c in left.columns], F.col("__value").alias(as_col or value_col))


def inner_with_loss(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The inner join on ``key`` and the one-row count of left rows that it loses."""
    joined = left.join(right, key, "inner")
    lost = left.join(right.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("lost"))
    return joined, lost


def skip_unchanged(
    df: DataFrame,
    seen: DataFrame,
    key: str,
    ts_col: str,
    seen_key: str = "id",
    seen_ts: str = "last_activity",
) -> DataFrame:
    """Rows whose activity time differs from the one last seen.

    Null never equals anything, so a row without a time, or seen without one, is
    kept. The seen table is first cut to the keys at hand: with a small delta both
    joins then run against a small side.
    """
    prior = seen.select(quoted(seen_key).alias("__key"), quoted(seen_ts).alias("__ts")).where(
        F.col("__ts").isNotNull()
    )
    at_hand = df.select(quoted(key).alias("__wanted"))
    prior = prior.join(at_hand, F.col("__key") == F.col("__wanted"), "left_semi")
    same = (quoted(key) == F.col("__key")) & (quoted(ts_col) == F.col("__ts"))
    return df.join(prior, same, "left_anti")


def missing_keys(ids: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Requested ids (the first column of ``ids``) with no row in ``df``."""
    id_col = ids.columns[0]
    stored = df.select(quoted(key).alias("__stored"))
    return ids.join(stored, quoted(id_col) == F.col("__stored"), "left_anti")


def require_some_keys(ids: DataFrame, df: DataFrame, key: str) -> int:
    """How many requested ids have no row; raises when that is all of them."""
    requested = ids.distinct().count()
    missing = missing_keys(ids, df, key).distinct().count()
    if requested and missing == requested:
        raise MissingDataError(f"none of the {requested} requested id(s) has stored records")
    return missing


def dimension_label(
    df: DataFrame, key: str, out: str, dim: Mapping[int, str] | DataFrame, unknown: str = "Unknown"
) -> DataFrame:
    """Label of a key; ``Unknown (None)`` for null and ``Unknown (<key>)`` when unmapped.

    A dict is a small fixed table and becomes a map literal. A frame is read as
    (key, label) columns with unique keys and joined.
    """
    fallback = F.concat(F.lit(f"{unknown} ("), F.coalesce(quoted(key).cast("string"), F.lit("None")), F.lit(")"))
    if isinstance(dim, DataFrame):
        dim_key, dim_label = dim.columns[:2]
        side = dim.select(quoted(dim_key).alias("__key"), quoted(dim_label).alias("__label"))
        joined = df.join(side, quoted(key) == F.col("__key"), "left")
        return joined.withColumn(out, F.coalesce("__label", fallback)).drop("__key", "__label")
    if not dim:
        return df.withColumn(out, fallback)
    label = F.try_element_at(literal_map(dim), quoted(key).cast("bigint"))
    return df.withColumn(out, F.coalesce(label, fallback))


def rows_of_ids(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``ids``; null ids are ignored."""
    wanted = ids.select(quoted(id_col).alias("__id")).where(F.col("__id").isNotNull())
    return df.join(wanted, quoted(key) == F.col("__id"), "left_semi")


#: A key with more rows than this on the split side is dealt over several tasks.
HOT_ROWS = 1 << 20


def hot_slices(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``__hot`` and ``__slices``: the keys with more than ``hot_rows`` rows, and over how many tasks to deal each.

    The counts have a map-side half, and there are at most as many hot keys as ``hot_rows`` goes
    into the rows, so they pass through the driver and come back as a frame of known size.
    """
    counted = df.where(quoted(key).isNotNull()).groupBy(quoted(key).alias("__hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    rows = [(r["__hot"], -(-r["n"] // hot_rows)) for r in counted.collect()]
    return small_frame(df.sparkSession, rows, f"__hot {df.schema[key].dataType.simpleString()}, __slices bigint")


def split_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join whose hot keys may be hot on both sides.

    The rows of a hot key on the left are dealt over slices by a hash of themselves, and the rows
    of that key on the right are repeated for each slice, so a task holds one slice of the left and
    what the key has on the right. All other rows are joined as they are. Columns of both sides
    must differ by name.
    """
    hot = hot_slices(left, left_key, hot_rows)
    whole = F.xxhash64(*[quoted(n) for n, t in left.dtypes if "map<" not in t and "variant" not in t])
    dealt = left.join(hot, quoted(left_key) == F.col("__hot"), "left")
    dealt = dealt.withColumn("__slice", F.coalesce(F.pmod(whole, "__slices"), F.lit(0))).drop("__hot", "__slices")
    repeated = right.join(hot, quoted(right_key) == F.col("__hot"), "left")
    repeated = repeated.withColumn("__of", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("__slices", F.lit(1)) - 1))).drop("__hot", "__slices")
    same = (quoted(left_key) == quoted(right_key)) & (F.col("__slice") == F.col("__of"))
    return dealt.join(repeated, same, "inner").drop("__slice", "__of")


def files_with_rounds(files: DataFrame, assignments: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Submission files beside the review assignments of the same round.

    A round can have many files and many assignments; the files of a hot one are split.
    """
    rounds = assignments.select(
        F.col("round_id").alias("__round_id"),
        F.col("assignment_id"),
        F.col("round"),
        F.col("status").alias("assignment_status"),
    )
    return split_join(files, rounds, "review_round_id", "__round_id", hot_rows).drop("__round_id")


def pick_current(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    id_col: str,
    current_col: str,
    order_cols: Sequence[str],
) -> DataFrame:
    """Per key the child row that is current: the id the parent names, else the first by order.

    For children stored as rows. The pick is an aggregation, so a parent with very
    many children never sits in one task.
    """
    named = parents.select(quoted(key).alias("__pk"), quoted(current_col).alias("__current"))
    tagged = children.join(named, quoted(key) == F.col("__pk"), "left").drop("__pk")
    others = [c for c in children.columns if c != key]
    is_current = F.coalesce(quoted(id_col) == F.col("__current"), F.lit(False))
    rank = F.struct(F.when(is_current, 0).otherwise(1), *[quoted(c) for c in order_cols])
    picked = tagged.groupBy(quoted(key)).agg(F.min_by(F.struct(*[quoted(c) for c in others]), rank).alias("__row"))
    return picked.select(*[quoted(c) if c == key else F.col("__row")[c].alias(c) for c in children.columns])


def latest_row(
    df: DataFrame, keys: Sequence[str], rank_cols: Sequence[str], tie_cols: Sequence[str]
) -> DataFrame:
    """Per key the row with the greatest rank (null as 0); ties keep the first by ``tie_cols``.

    ``tie_cols`` must be numeric. For rounds stored as rows; see ``latest_by`` for arrays.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.coalesce(quoted(c), F.lit(0)) for c in rank_cols], *[-quoted(c) for c in tie_cols])
    picked = df.groupBy(*[quoted(k) for k in keys]).agg(
        F.max_by(F.struct(*[quoted(c) for c in others]), rank).alias("__row")
    )
    return picked.select(*[quoted(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
