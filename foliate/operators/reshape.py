"""Wide to long, nested to flat, and unions of frames that differ.

Header lists are data that shapes the plan: the indices of a numbered block are
read off ``df.columns`` and every block becomes one ``inline(array(struct(...)))``,
so an export is scanned once however many indices it carries.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions.nested import in_order
from foliate.functions.text import has_text
from foliate.operators.filters import keep_any_data, keep_nonblank
from foliate.schema import quoted

# Header forms of the numbered blocks. A decision header carries two
# indices and also ends like an editor header, so it is recognised first.
DECISION_HEADER = re.compile(
    r"^(?P<kind>Editor Decision|Date decided) (?P<decision_number>\d+)\s+\(Editor (?P<editor_number>\d+)\)$"
)
DECISION_FIELDS = {"Editor Decision": "decision", "Date decided": "date_decided"}
NUMBERED_HEADER = r"^(?P<base>.+) \({label} (?P<n>\d+)\)$"


def entity_numbers(columns: Iterable[str], field_map: Mapping[str, str], label: str) -> list[int]:
    """Every index ``N`` for which some mapped ``<base> (<label> N)`` header exists."""
    pattern = re.compile(NUMBERED_HEADER.format(label=re.escape(label)))
    hits = (pattern.match(c) for c in columns if not DECISION_HEADER.match(c))
    return sorted({int(m["n"]) for m in hits if m and m["base"] in field_map})


def _inlined(df: DataFrame, id_col: str, id_name: str, slots: Sequence[Column]) -> DataFrame:
    return df.select(quoted(id_col).alias(id_name), F.inline(F.array(*slots)))


def unpivot_numbered(
    df: DataFrame,
    field_map: Mapping[str, str],
    id_col: str,
    number_col: str,
    label: str,
    id_name: str = "submission_id",
) -> DataFrame | None:
    """One row per entity index that holds any data; ``None`` without such headers.

    A field missing for one index is null there; a field missing for every index
    is left out.
    """
    present = set(df.columns)
    numbers = entity_numbers(df.columns, field_map, label)
    if not numbers:
        return None

    def header(base: str, n: int) -> str:
        return f"{base} ({label} {n})"

    fields = {b: name for b, name in field_map.items() if any(header(b, n) in present for n in numbers)}
    slots = [
        F.struct(
            F.lit(n).cast("bigint").alias(number_col),
            *[
                (quoted(header(b, n)) if header(b, n) in present else F.lit(None)).cast("string").alias(name)
                for b, name in fields.items()
            ],
        )
        for n in numbers
    ]
    return keep_any_data(_inlined(df, id_col, id_name, slots), keys=(id_name, number_col))


def numbered_count(df: DataFrame, base: str, label: str) -> Column:
    """How many ``<base> (<label> N)`` columns are non-blank in a row; 0 without any."""
    numbers = entity_numbers(df.columns, {base: base}, label)
    flags = [has_text(quoted(f"{base} ({label} {n})")).cast("bigint") for n in numbers]
    return reduce(lambda a, b: a + b, flags, F.lit(0).cast("bigint"))


def two_index_slots(
    columns: Iterable[str], header_regex: re.Pattern, number_cols: Sequence[str], kinds: Mapping[str, str]
) -> dict[tuple[int, ...], dict[str, str]]:
    """Headers grouped by their index pair: ``{(editor, decision): {field: header}}``, in index order."""
    slots: dict[tuple[int, ...], dict[str, str]] = {}
    for c in columns:
        m = header_regex.match(c)
        if m:
            slots.setdefault(tuple(int(m[n]) for n in number_cols), {})[kinds[m["kind"]]] = c
    return dict(sorted(slots.items()))


def unpivot_two_index(
    df: DataFrame,
    header_regex: re.Pattern,
    id_col: str,
    number_cols: Sequence[str],
    required_field: str,
    kinds: Mapping[str, str] = DECISION_FIELDS,
    id_name: str = "submission_id",
) -> DataFrame | None:
    """One row per index pair whose ``required_field`` holds text.

    A pair without a header for the required field is skipped; another field
    without a header is null for that pair.
    """
    found = two_index_slots(df.columns, header_regex, number_cols, kinds)
    usable = {numbers: fields for numbers, fields in found.items() if required_field in fields}
    if not usable:
        return None
    names = [f for f in kinds.values() if any(f in fields for fields in usable.values())]
    slots = [
        F.struct(
            *[F.lit(n).cast("bigint").alias(c) for n, c in zip(numbers, number_cols, strict=True)],
            *[(quoted(fields[f]) if f in fields else F.lit(None)).cast("string").alias(f) for f in names],
        )
        for numbers, fields in usable.items()
    ]
    return keep_nonblank(_inlined(df, id_col, id_name, slots), required_field)


def diagonal_union(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name, null where a frame lacks a column."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_series(series: Mapping[str, DataFrame], interval: str) -> DataFrame:
    """Stack named series, each row carrying its ``kind`` and the ``interval``."""
    return diagonal_union(
        *[df.withColumns({"kind": F.lit(kind), "interval": F.lit(interval)}) for kind, df in series.items()]
    )


def explode_children(df: DataFrame, array_col: str, keep: Sequence[str], child: str = "child") -> DataFrame:
    """One row per array element beside the kept columns; null and empty arrays give none."""
    return df.select(*[quoted(k) for k in keep], F.explode(quoted(array_col)).alias(child))


def explode_ordered(
    df: DataFrame, array_col: str, key_field: str, keep: Sequence[str], number_col: str, child: str = "child"
) -> DataFrame:
    """Elements numbered from 1 by ``key_field`` within their own record.

    The order is settled inside the row, so numbering needs no shuffle.
    """
    exploded = df.select(
        *[quoted(k) for k in keep], F.posexplode(in_order(quoted(array_col), key_field)).alias("__pos", child)
    )
    return exploded.select(*keep, (F.col("__pos") + 1).cast("bigint").alias(number_col), child)
