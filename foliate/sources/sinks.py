"""Writing finished tables and their documentation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.errors import OptionError
from foliate.operators.quality import RunMetrics
from foliate.operators.ranking import spread_by_range
from foliate.schema import DOC_TYPE_NAMES, TableSpec, quoted
from foliate.session import small_frame

DOC_SCHEMA = (
    "table_name string, column_name string, data_type string, in_output string, "
    "original_column string, description string, table_description string"
)


def sort_columns(spec: TableSpec, present: Iterable[str]) -> list[Column]:
    """The declared row order; ``-name`` sorts descending. Nulls come first either way."""
    present = set(present)
    parts = [(s.lstrip("-"), s.startswith("-")) for s in spec.sort]
    return [quoted(n).desc_nulls_first() if down else quoted(n).asc_nulls_first() for n, down in parts if n in present]


def in_table_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows in the declared order, across partitions and within each.

    Partition bounds may fall inside a group of equal sort values, so a value that
    most rows share does not end up in one task.
    """
    order = sort_columns(spec, df.columns)
    return spread_by_range(df, order).sortWithinPartitions(*order) if order else df


def write_tables(
    tables: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    directory: str,
    fmt: str = "parquet",
    metrics: RunMetrics | None = None,
    extra: Mapping[str, Mapping[str, Column]] | None = None,
) -> dict[str, str]:
    """Write each table, in its declared order, to ``<directory>/<name>``.

    The sort is a range partitioning: file by file the rows are in order, and no
    task sees more than its range. Row counts, and the ``extra`` aggregates of a
    table, are observed behind the sort, because the sort samples what is before it.
    """
    if fmt not in ("parquet", "csv"):
        raise OptionError(f"unknown table format {fmt!r}; expected one of: csv, parquet")
    paths = {}
    for name, df in tables.items():
        ordered = in_table_order(df, specs[name]) if name in specs else df
        if metrics is not None:
            ordered = metrics.watch(ordered, name, **(extra or {}).get(name, {}))
        writer = ordered.write.mode("overwrite")
        paths[name] = f"{directory}/{name}"
        if fmt == "csv":
            writer.option("header", True).option("escape", '"').option(
                "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
            ).csv(paths[name])
        else:
            writer.parquet(paths[name])
    return paths


def doc_rows(specs: Iterable[TableSpec]) -> list[tuple[str, ...]]:
    return [
        (
            spec.name,
            c.name,
            DOC_TYPE_NAMES.get(c.dtype.simpleString(), c.dtype.simpleString()),
            "false" if c.dropped else "true",
            c.source or "N/A",
            c.description,
            spec.description,
        )
        for spec in specs
        for c in spec
    ]


def schema_docs(spark: SparkSession, specs: Iterable[TableSpec], profiles: DataFrame | None = None) -> DataFrame:
    """One row per declared column; with ``profiles`` beside its counts.

    ``profiles`` is keyed by ``table_name, column_name`` (see ``catalog.profile_tables``).
    """
    docs = small_frame(spark, doc_rows(specs), DOC_SCHEMA)
    return docs if profiles is None else docs.join(profiles, ["table_name", "column_name"], "left")


def column_counts(docs: DataFrame) -> DataFrame:
    return docs.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_columns"))


def write_schema_docs(docs: DataFrame, path: str) -> DataFrame:
    """Write the documentation table as CSV and return the columns per table."""
    docs.coalesce(1).orderBy("table_name").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return column_counts(docs)
