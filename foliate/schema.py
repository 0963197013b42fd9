"""Declared table schemas and the conformance step that applies them.

A :class:`TableSpec` is plain data: ordered columns with a Spark type, a
description and the raw header or field they come from. Everything else (the
``StructType``, rename maps, documentation rows, the final casting projection) is
derived from it.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.functions.dates import parse_date, parse_timestamp

logger = logging.getLogger(__name__)

LONG = T.LongType()
STRING = T.StringType()
BOOLEAN = T.BooleanType()
DATE = T.DateType()
DATETIME = T.TimestampNTZType()

RESERVED_NAMES = ("name", "description")

# The type names used in the documentation table.
DOC_TYPE_NAMES = {
    "bigint": "Int64",
    "string": "String",
    "boolean": "Boolean",
    "date": "Date",
    "timestamp_ntz": "Datetime",
}


def quoted(name: str) -> Column:
    """A column by its exact name, whatever dots, spaces or backticks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a normalized table.

    ``source`` is the raw header or field, or ``None`` for a derived column.
    ``dropped`` columns are documented but left out of the table; they are expected to
    be empty, or to hold nothing but ``constant``.
    """

    dtype: T.DataType
    description: str
    source: str | None = None
    name: str | None = None
    dropped: bool = False
    constant: str | None = None


@dataclass(frozen=True)
class TableSpec:
    """A named, ordered set of columns.

    ``columns`` maps an attribute name to its :class:`ColumnSpec`; the output name
    is the attribute name unless the spec carries its own ``name``. The attribute
    names ``name`` and ``description`` are reserved for the table itself.
    """

    name: str
    description: str
    columns: Mapping[str, ColumnSpec]
    sort: tuple[str, ...] = ()
    _resolved: tuple[ColumnSpec, ...] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        clash = [n for n in RESERVED_NAMES if n in self.columns]
        if clash:
            raise TypeError(
                f"table {self.name}: attribute {clash[0]!r} is reserved; "
                f"use another attribute and set name={clash[0]!r} on its ColumnSpec"
            )
        resolved = tuple(c if c.name else replace(c, name=attr) for attr, c in self.columns.items())
        object.__setattr__(self, "_resolved", resolved)

    def __iter__(self):
        return iter(self._resolved)

    def names(self) -> list[str]:
        return [c.name for c in self]

    def output_names(self) -> list[str]:
        return [c.name for c in self if not c.dropped]

    def struct_type(self, include_dropped: bool = True) -> T.StructType:
        """The declared schema, each field carrying its documentation as metadata."""
        return T.StructType(
            [
                T.StructField(c.name, c.dtype, True, _metadata(c))
                for c in self
                if include_dropped or not c.dropped
            ]
        )

    def rename_map(self) -> dict[str, str]:
        """Raw header to output name, for columns whose header differs."""
        return {c.source: c.name for c in self if c.source and c.source != c.name}

    def field_map(self, pattern: str) -> dict[str, str]:
        """Base header to output name for sources written ``<base> (<pattern>)``."""
        tail = f" ({pattern})"
        found: dict[str, str] = {}
        for c in self:
            if c.source and c.source.endswith(tail):
                found.setdefault(c.source[: -len(tail)], c.name)
        return found

    def source_columns(self) -> list[str]:
        return [c.source for c in self if c.source]

    def dropped_columns(self) -> list[str]:
        return [c.name for c in self if c.dropped]


def _metadata(c: ColumnSpec) -> dict[str, object]:
    meta: dict[str, object] = {"comment": c.description, "dropped": c.dropped}
    if c.source:
        meta["source"] = c.source
    return meta


def rename_from_source(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rename the raw headers that are present to their output names, in one step."""
    return df.withColumnsRenamed({s: n for s, n in spec.rename_map().items() if s in df.columns})


def lenient_cast(col: Column, from_type: T.DataType, to_type: T.DataType) -> Column:
    """Bring ``col`` to ``to_type``; a value that does not fit becomes null.

    Text becomes a date or timestamp only in the exact ``yyyy-MM-dd`` and
    ``yyyy-MM-dd HH:mm:ss`` forms. Spark's own cast accepts many more.
    """
    if from_type == to_type:
        return col
    if isinstance(from_type, T.StringType) and isinstance(to_type, T.DateType):
        return parse_date(col)
    if isinstance(from_type, T.StringType) and isinstance(to_type, T.TimestampNTZType):
        return parse_timestamp(col)
    if isinstance(from_type, T.NullType):
        return col.cast(to_type)
    return col.try_cast(to_type)


def conform(df: DataFrame, spec: TableSpec, fill_missing: bool = False) -> DataFrame:
    """Project ``df`` onto the declared, non-dropped columns, in order and cast.

    Columns the spec does not know are logged and left out. Declared columns that
    ``df`` lacks are omitted, or filled with nulls when ``fill_missing`` is set.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    unknown = unknown_columns(df, spec)
    if unknown:
        logger.warning("WARNING [%s]: dropping %d column(s) not in schema: %s", spec.name, len(unknown), unknown)
    picked: list[Column] = []
    for c in spec:
        if c.dropped:
            continue
        if c.name in present:
            value = lenient_cast(quoted(c.name), present[c.name], c.dtype)
        elif fill_missing:
            value = F.lit(None).cast(c.dtype)
        else:
            continue
        picked.append(value.alias(c.name, metadata=_metadata(c)))
    return df.select(picked)


def unknown_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    """Columns of ``df`` the spec neither outputs nor documents as dropped."""
    known = set(spec.names())
    return [c for c in df.columns if c not in known]


def unmapped_columns(columns: Iterable[str], specs: Iterable[TableSpec], claims: Iterable[re.Pattern] = ()) -> list[str]:
    """Raw headers that no spec claims, in input order.

    A header is claimed when it is a literal source, when it is a numbered form
    ``<base> (<label> 7)`` of a source written ``<base> (<label> N)``, or when one
    of the ``claims`` patterns matches it.
    """
    sources = {s for spec in specs for s in spec.source_columns()}
    claims = list(claims)

    def is_claimed(header: str) -> bool:
        if any(p.match(header) for p in claims):
            return True
        generic = re.sub(r" \((\w+) \d+\)$", r" (\1 N)", header)
        return generic in sources if generic != header else header in sources

    return [h for h in columns if not is_claimed(h)]


def empty_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """A zero-row frame with the whole declared schema."""
    return spark.createDataFrame([], spec.struct_type())
