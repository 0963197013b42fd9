"""Expressions over an array of structs inside one record.

Nothing here explodes or shuffles: each works on one row's own array. Only small
keys are compared and sorted, never the elements, so an element may hold maps.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliate.functions.text import numeric_or_zero


def array_len(col: Column) -> Column:
    """Number of elements; a null array counts 0."""
    return F.coalesce(F.size(F.coalesce(col, F.array())), F.lit(0)).cast("bigint")


def array_len_or_null(col: Column) -> Column:
    return F.nullif(array_len(col), F.lit(0).cast("bigint"))


def first_child(col: Column) -> Column:
    """The first element in array order, null when there is none."""
    return F.get(col, F.lit(0))


def current_child(col: Column, id_field: str, current_id: Column) -> Column:
    """The first element whose id is ``current_id``, else the first element."""
    matching = F.filter(col, lambda child: child[id_field] == current_id)
    return F.coalesce(F.get(matching, F.lit(0)), first_child(col))


def latest_by(col: Column, *fields: str) -> Column:
    """The element with the greatest ``fields``; null ranks as 0, ties keep the first."""
    ranks = F.transform(
        col,
        lambda child, pos: F.struct(
            *[F.coalesce(child[f], F.lit(0)).alias(f) for f in fields], (-pos).alias("neg_pos")
        ),
    )
    return F.get(col, -F.array_max(ranks)["neg_pos"])


def any_child_in(col: Column, field: str, values: Iterable) -> Column:
    """True when some element's ``field`` is among ``values``.

    An empty ``values`` selects every record; a null array matches nothing.
    """
    wanted = list(values)
    if not wanted:
        return F.lit(True)
    return F.coalesce(F.exists(col, lambda child: child[field].isin(wanted)), F.lit(False))


def in_order(col: Column, key_field: str) -> Column:
    """The array sorted by a numeric field, non-numbers as 0, equal keys in array order."""
    keys = F.transform(
        col, lambda child, pos: F.struct(numeric_or_zero(child[key_field]).alias("key"), pos.alias("pos"))
    )
    return F.transform(F.array_sort(keys), lambda k: F.get(col, k["pos"]))
