"""Values that are a locale map, a plain string or null.

Such a field is declared ``STRING``: the JSON reader keeps an object as its JSON
text and a plain string as it is. A value that starts with ``{`` and parses is
treated as a map, anything else as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_LOCALE = "en_US"


def _first_with_text(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v != ""), F.lit(0))


def localized(col: Column, locale: str = DEFAULT_LOCALE, fallback_any: bool = False) -> Column:
    """The text for ``locale``; empty counts as absent.

    With ``fallback_any`` the first non-empty value in document order stands in
    for a missing locale. The common case costs one path lookup: the whole map is
    only parsed for the fallback, and whether a text really is an object is only
    asked when the lookup finds nothing.
    """
    wanted = F.get_json_object(col, f"$['{locale}']")
    found = [wanted]
    if fallback_any:
        every = F.map_values(F.from_json(col, "map<string,string>"))
        found = [_first_with_text(F.array(wanted)), _first_with_text(every)]
    not_an_object = F.when(F.json_object_keys(col).isNull(), col)
    text = F.when(col.startswith("{"), F.coalesce(*found, not_an_object)).otherwise(col)
    return F.nullif(text, F.lit(""))


def join_list(col: Column, locale: str = DEFAULT_LOCALE, separator: str = "; ") -> Column:
    """The list for ``locale`` joined into one string; a missing or empty list is null.

    Held in a one-element array, the parsed list is tested and joined without
    being parsed again.
    """
    lists = F.when(col.startswith("{"), F.from_json(col, "map<string,array<string>>"))
    filled = F.filter(F.array(F.try_element_at(lists, F.lit(locale))), lambda items: F.size(items) > 0)
    return F.get(F.transform(filled, lambda items: F.array_join(items, separator)), F.lit(0))
