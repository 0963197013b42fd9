"""Dates and timestamps held as text, and marks derived from them."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliate.errors import OptionError

# The two temporal text forms, and the overlap of a repeated pull.
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}\z"
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"
SYNC_OVERLAP = "1 day"


def parse_date(col: Column) -> Column:
    return F.when(col.rlike(DATE_PATTERN), col.try_cast("date"))


def parse_timestamp(col: Column) -> Column:
    """Text to TIMESTAMP_NTZ: a naive local time has no zone to be shifted through."""
    return F.when(col.rlike(TIMESTAMP_PATTERN), col.try_cast("timestamp_ntz"))


def is_iso_date(col: Column) -> Column:
    """True for a real calendar date written exactly ``YYYY-MM-DD``; false otherwise."""
    return F.coalesce(parse_date(col).isNotNull(), F.lit(False))


def minus_overlap(col: Column, overlap: str = SYNC_OVERLAP) -> Column:
    return col - F.expr(f"INTERVAL {overlap}")


def mark_text(col: Column, overlap: str = SYNC_OVERLAP) -> Column:
    """A high-water timestamp less the overlap, in the ``Y-m-d H:i:s`` text form.

    Cut from the cast: ``date_format`` would take a naive time through the session
    zone and move it in the hour that summer time skips.
    """
    return F.substring(minus_overlap(col, overlap).cast("string"), 1, 19)


def window_text(col: Column, overlap: str = SYNC_OVERLAP) -> Column:
    """The day a re-read window starts on: the timestamp less the overlap, as a date."""
    return F.substring(minus_overlap(col, overlap).cast("string"), 1, 10)


def require_iso_date(option: str, value: str | None) -> None:
    """Reject a parameter that is not a real ``YYYY-MM-DD`` date."""
    if value is None:
        return
    try:
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
            raise ValueError(value)
        date.fromisoformat(value)
    except ValueError as e:
        raise OptionError(f"{option} must be YYYY-MM-DD, got {value!r}") from e
