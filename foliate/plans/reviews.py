"""The table of the long reviews report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.functions.html import clean_html
from foliate.functions.text import yes_to_bool
from foliate.plans import specs
from foliate.schema import conform, rename_from_source


def normalize_reviews(df: DataFrame) -> dict[str, DataFrame]:
    """Headers renamed, comments to plain text, Yes/No to a flag, then typed."""
    rows = rename_from_source(df, specs.REVIEWS)
    if "comments" in rows.columns:
        rows = clean_html(rows, {"comments": "text"})
    if "declined" in rows.columns:
        rows = rows.withColumn("declined", yes_to_bool(F.col("declined")))
    return {"reviews": conform(rows, specs.REVIEWS)}
