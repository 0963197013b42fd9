"""Checks and counts that ride along with the tables.

Every check of a table is one aggregation over it, however many columns it covers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from foliate.schema import quoted
from foliate.session import small_frame


def always_null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, non_null`` for the columns that are expected to stay empty."""
    present = [c for c in columns if c in df.columns]
    return _one_pass(df, present, {"non_null": lambda c: F.count(quoted(c))})


def constant_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``column, non_null, unexpected, lowest, highest`` for columns expected to hold one value.

    Any value other than the expected one shows as ``unexpected``; the extremes
    name offending values without collecting the distinct set.
    """
    present = [c for c in expected if c in df.columns]
    return _one_pass(
        df,
        present,
        {
            "non_null": lambda c: F.count(quoted(c)),
            "unexpected": lambda c: F.count_if(quoted(c).cast("string") != F.lit(expected[c])),
            "lowest": lambda c: F.min(quoted(c).cast("string")),
            "highest": lambda c: F.max(quoted(c).cast("string")),
        },
    )


def _one_pass(df: DataFrame, columns: Sequence[str], measures: Mapping[str, object]) -> DataFrame:
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, " + ", ".join(f"{m} bigint" for m in measures))
    aggregates = [
        F.struct(F.lit(c).alias("column"), *[measure(c).alias(m) for m, measure in measures.items()]) for c in columns
    ]
    return df.agg(F.array(*aggregates).alias("checks")).select(F.inline("checks"))


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, rows, nulls, distinct_values`` per column, exact.

    Columns are turned into (column, value) rows that are counted in two combining
    steps, so neither a wide table nor a dominant value is gathered anywhere.
    """
    columns = list(columns or df.columns)
    pairs = df.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns])
        )
    )
    counted = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0).cast("bigint")).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )


def preview(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    """The first rows of those of ``columns`` that exist."""
    return df.select(*[quoted(c) for c in columns if c in df.columns]).limit(n)


class RunMetrics:
    """Counts taken while the tables are written, with no pass of their own."""

    def __init__(self) -> None:
        self._observed: dict[str, Observation] = {}
        self._known: list[tuple[str, str, int]] = []

    def watch(self, df: DataFrame, dataset: str, **metrics: Column) -> DataFrame:
        """``df`` counting its rows, and any further aggregates, as it is consumed."""
        observation = Observation(f"foliate_{dataset}_{len(self._observed)}")
        self._observed[dataset] = observation
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[m.alias(k) for k, m in metrics.items()])

    def add(self, dataset: str, metric: str, value: int) -> None:
        self._known.append((dataset, metric, int(value)))

    def rows(self) -> list[tuple[str, str, int]]:
        """All metrics; waits for the writes that were being watched."""
        observed = [
            (dataset, metric, int(value))
            for dataset, observation in self._observed.items()
            for metric, value in observation.get.items()
        ]
        return self._known + observed

    def to_df(self, spark: SparkSession) -> DataFrame:
        return small_frame(spark, self.rows(), "dataset string, metric string, value bigint")
