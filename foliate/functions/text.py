"""Small string and label rules, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Workflow stage ids of a file and their directory names.
FILE_STAGE_LABELS: dict[int, str] = {
    2: "submission",
    3: "note",
    4: "review_file",
    5: "review_attachment",
    6: "final",
    7: "fair_copy",
    8: "editor",
    9: "copyedit",
    10: "proof",
    11: "production_ready",
    13: "attachment",
    15: "review_revision",
    17: "dependent",
    18: "query",
}

# Fixed value: the association type that ties a file to a review round.
REVIEW_ROUND_ASSOC_TYPE = 521

# Characters a file name keeps, and the stand-in for an empty one.
# \w is A-Z, a-z, 0-9 and _ only, and Java tests it by one bit mask; spelled out as ranges the class took 20 times as long.
UNSAFE_NAME_CHARS = r"[^\w.-]+"
EMPTY_NAME = "file"


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def has_text(col: Column) -> Column:
    """True when the value is neither null nor, as text, empty; never null."""
    return F.coalesce(col.cast("string"), F.lit("")) != ""


def literal_map(labels: Mapping[int, str]) -> Column:
    pairs = [part for key, text in labels.items() for part in (F.lit(key).cast("bigint"), F.lit(text))]
    return F.create_map(*pairs)


def stage_label(col: Column, labels: Mapping[int, str] = FILE_STAGE_LABELS) -> Column:
    """Readable stage name; ``stage_<id>`` for an unknown id, ``stage_unknown`` without one."""
    stage = col.try_cast("bigint")
    return (
        F.when(stage.isNull(), "stage_unknown")
        .otherwise(F.coalesce(F.try_element_at(literal_map(labels), stage), F.concat(F.lit("stage_"), stage.cast("string"))))
    )


def review_round_id(type_col: Column, id_col: Column) -> Column:
    return F.when(type_col == REVIEW_ROUND_ASSOC_TYPE, id_col)


def yes_to_bool(col: Column) -> Column:
    return col == F.lit("Yes")


def numeric_or_zero(col: Column) -> Column:
    """A sort key that is never null: a non-number folds to 0."""
    return F.coalesce(col.try_cast("double"), F.lit(0.0))


def safe_name(col: Column) -> Column:
    """A file name with every run of unusual characters turned into one underscore."""
    cleaned = F.btrim(F.regexp_replace(F.coalesce(col, F.lit("")), UNSAFE_NAME_CHARS, "_"), F.lit("_"))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(EMPTY_NAME))


def mask_token(col: Column, param: str = "apiToken") -> Column:
    """Hide the value of a ``param=`` pair anywhere in a text or URL."""
    return F.regexp_replace(col, "(" + param + r"=)[^&\s'\")]+", "$1[REDACTED]")
