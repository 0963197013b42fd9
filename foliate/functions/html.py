"""Free-text HTML columns to plain text.

Tag removal and whitespace rules run in the JVM. Entity decoding needs the full
HTML entity table, so it goes through one Arrow UDF; only values that hold an
ampersand are handed to it, every other row passes a null.
"""

from __future__ import annotations

import html
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import OptionError
from foliate.schema import quoted

# Tags that end a line, any other tag, and what counts as white space.
LINE_BREAK_TAGS = r"(?iU)<br\b[^>]*>|</(?:p|li|div)\s*>"
ANY_TAG = r"<[^>]++>"
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NO_BREAK_SPACE = "\xa0"

MODES = ("text", "lines")


@F.arrow_udf(T.StringType())
def decode_entities(values: pa.Array) -> pa.Array:
    """Named, decimal and hexadecimal character references to characters."""
    return pa.array([None if v is None else html.unescape(v) for v in values.to_pylist()], pa.string())


def without_tags(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(col, LINE_BREAK_TAGS, "\n"), ANY_TAG, "")


def normalize_breaks(col: Column) -> Column:
    spaced = F.replace(col, F.lit(NO_BREAK_SPACE), F.lit(" "))
    return F.replace(F.replace(spaced, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def as_text(col: Column) -> Column:
    """Paragraph form: three or more line breaks become two, ends trimmed."""
    return F.btrim(F.regexp_replace(col, r"\n{3,}", "\n\n"), F.lit(WHITE_SPACE))


def as_lines(col: Column) -> Column:
    """Line form: every line trimmed, blank lines dropped.

    The look-behind lets a match start only where a run of white space starts, so
    a long run without a line break is scanned once.
    """
    return F.btrim(F.regexp_replace(col, r"(?U)(?<!\s)\s*\n\s*", "\n"), F.lit(WHITE_SPACE))


def clean_html(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace HTML columns of ``df`` by plain text.

    ``columns`` maps a column name to ``"text"`` or ``"lines"``. Tags go first,
    then entities are decoded, so ``&lt;b&gt;`` stays as the text ``<b>``. The
    tag-free text is a column of its own: it is computed once, tested for ``&``
    and reused as the result where there is nothing to decode.
    """
    bad = sorted(set(columns.values()) - set(MODES))
    if bad:
        raise OptionError(f"unknown HTML mode {bad[0]!r}; expected one of: {', '.join(MODES)}")
    finish = {"text": as_text, "lines": as_lines}
    bare = {f"__bare_{c}": without_tags(quoted(c).cast("string")) for c in columns}
    staged = df.withColumns(bare)
    decoded = {}
    for c, mode in columns.items():
        text = quoted(f"__bare_{c}")
        plain = F.coalesce(decode_entities(F.when(F.contains(text, F.lit("&")), text)), text)
        decoded[c] = finish[mode](normalize_breaks(plain))
    cleaned = staged.withColumns(decoded).drop(*bare)
    # A step of its own: the cleaned text is tested and returned, but computed once.
    emptied = {c: F.nullif(quoted(c), F.lit("")) for c, mode in columns.items() if mode == "lines"}
    return cleaned.withColumns(emptied) if emptied else cleaned
