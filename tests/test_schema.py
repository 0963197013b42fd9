"""The schema layer."""

import datetime as dt
import logging

import pytest
from hypothesis import given
from hypothesis import strategies as st

from foliate.plans import articles, specs
from foliate.schema import (
    DATE,
    DATETIME,
    LONG,
    STRING,
    ColumnSpec,
    TableSpec,
    conform,
    empty_table,
    rename_from_source,
    unmapped_columns,
)
from foliate.sources.sinks import column_counts, doc_rows, schema_docs, write_schema_docs

#: Readings of moored buoys: what came from the logger, what was worked out, and what isn't published.
BUOYS = TableSpec(
    "buoys",
    "Hourly readings.",
    {
        "serial": ColumnSpec(STRING, "Maker's number.", "Serial", dropped=True),
        "read_at": ColumnSpec(DATETIME, "Local time of the reading.", "Clock"),
        "tide": ColumnSpec(LONG, "Millimetres above datum."),
        "sensor": ColumnSpec(STRING, "What was read.", "Probe (Mast N)"),
        "serviced": ColumnSpec(DATE, "Last visit.", "Visit"),
    },
)

COLUMNS = st.lists(
    st.tuples(st.text("abcdef", min_size=1, max_size=5), st.sampled_from([LONG, STRING, DATETIME, DATE]), st.sampled_from([None, "plain", "Mast N", "Buoy N"]), st.booleans()),
    unique_by=lambda c: c[0], max_size=7,
)


@given(COLUMNS)
def test_a_table_lists_its_columns(columns):
    """Names, sources and maps follow from the columns a table is declared with, in their order."""
    def source(name, form):
        return None if form is None else f"From {name}" if form == "plain" else f"From {name} ({form})"

    spec = TableSpec("t", "d", {n: ColumnSpec(kind, "x", source(n, form), dropped=gone) for n, kind, form, gone in columns})
    assert spec.names() == [n for n, *_ in columns]
    assert spec.output_names() == [n for n, _, _, gone in columns if not gone]
    assert spec.dropped_columns() == [n for n, _, _, gone in columns if gone]
    assert spec.source_columns() == [source(n, form) for n, _, form, _ in columns if form]
    assert spec.rename_map() == {source(n, form): n for n, _, form, _ in columns if form}
    for label in ("Mast N", "Buoy N"):
        assert spec.field_map(label) == {f"From {n}": n for n, _, form, _ in columns if form == label}
    fields = spec.struct_type()
    assert [(f.name, f.dataType, f.metadata["dropped"]) for f in fields] == [(n, kind, gone) for n, kind, _, gone in columns]


def test_documentation_travels_with_the_type():
    assert BUOYS.struct_type()["serviced"].metadata == {"comment": "Last visit.", "source": "Visit", "dropped": False}
    assert "Bio Statement (e.g., department and rank)" in specs.ARTICLE_AUTHORS.field_map("Author N")


def test_reserved_names():
    for name in ("name", "description"):
        with pytest.raises(TypeError, match="reserved"):
            TableSpec("t", "d", {name: ColumnSpec(STRING, "x")})
    spec = TableSpec("t", "d", {"file_name": ColumnSpec(STRING, "x", name="name")})
    assert spec.names() == ["name"]


def test_conform_casts_parses_and_orders(spark):
    # The second clock reading falls into the hour that summer time skips in the session's zone.
    raw = spark.createDataFrame(
        [("-340", None, "2021-12-31 23:59:59"), ("12 mm", "wave", "2022-03-13 02:15:00"), ("2500", "salt", "noon")], "tide string, sensor string, read_at string"
    )
    out = conform(raw, BUOYS)
    assert out.dtypes == [("read_at", "timestamp_ntz"), ("tide", "bigint"), ("sensor", "string")]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(dt.datetime(2021, 12, 31, 23, 59, 59), -340, None), (dt.datetime(2022, 3, 13, 2, 15), None, "wave"), (None, 2500, "salt")], key=repr
    )
    assert out.schema["tide"].metadata["comment"] == "Millimetres above datum."


def test_conform_reports_unknown_and_hides_dropped(spark, caplog):
    raw = spark.createDataFrame([("n", 4, "kelp", "calm")], "serial string, tide int, fouling string, sensor string")
    with caplog.at_level(logging.WARNING, logger="foliate"):
        out = conform(raw, BUOYS)
    assert out.columns == ["tide", "sensor"]
    assert "fouling" in caplog.text and "serial" not in caplog.text


def test_conform_can_fill_missing(spark, caplog):
    raw = spark.createDataFrame([(4,)], "tide int")
    assert conform(raw, BUOYS).columns == ["tide"]
    filled = conform(raw, BUOYS, fill_missing=True)
    assert filled.schema == BUOYS.struct_type(include_dropped=False)
    assert filled.first()["serviced"] is None
    assert "WARNING" not in caplog.text


def test_numbers_and_dates_are_lenient_but_exact(spark):
    spec = TableSpec("t", "d", {"n": ColumnSpec(LONG, "n"), "d": ColumnSpec(DATE, "d"), "s": ColumnSpec(STRING, "s")})
    raw = spark.createDataFrame(
        [("3", "2024-02-29", 5.0), ("3.0", "2023-02-29", None), ("", "2024-01-02 00:00:00", 1.5)], "n string, d string, s double"
    )
    rows = conform(raw, spec).collect()
    assert [r["n"] for r in rows] == [3, None, None]
    assert [r["d"] for r in rows] == [dt.date(2024, 2, 29), None, None]
    assert [r["s"] for r in rows] == ["5.0", None, "1.5"]


def test_rename_and_empty(spark):
    raw = spark.createDataFrame([(1, "x", 2)], "Depth int, Clock string, tide int")
    assert rename_from_source(raw, BUOYS).columns == ["Depth", "read_at", "tide"]
    empty = empty_table(spark, BUOYS)
    assert empty.count() == 0 and empty.columns == BUOYS.names()


@given(st.lists(st.integers(1, 500), unique=True, min_size=1, max_size=4), st.randoms())
def test_headers_no_table_accounts_for(numbers, order):
    known = [f"{base} (Author {n})" for base in specs.ARTICLE_AUTHORS.field_map("Author N") for n in numbers]
    known += [f"{kind} {n}  (Editor {n + 1})" for kind in ("Editor Decision", "Date decided") for n in numbers]
    unknown = [f"Keel ({label} {n})" for label in ("Author", "Editor", "Ship") for n in numbers] + ["Tonnage"]
    headers = known + unknown
    order.shuffle(headers)
    assert articles.unmapped_report_columns(headers) == [h for h in headers if h in unknown]
    assert unmapped_columns([*headers, "Visit", *(f"Probe (Mast {n})" for n in numbers)], [BUOYS]) == headers


def test_schema_docs(spark, rows, tmp_path):
    documented = {r[1]: r[2:5] for r in doc_rows([BUOYS])}
    assert documented["tide"] == ("Int64", "true", "N/A") and documented["read_at"] == ("Datetime", "true", "Clock")
    assert documented["serial"][1] == "false"
    docs = schema_docs(spark, specs.ARTICLE_TABLES)
    counts = write_schema_docs(docs, str(tmp_path / "docs"))
    assert rows(counts) == [("authors", 10), ("decisions", 5), ("editors", 6), ("submissions", 21)]
    back = spark.read.csv(str(tmp_path / "docs"), header=True, escape='"')
    assert back.where("in_output = 'false'").count() == 8
    assert rows(column_counts(back)) == rows(counts)


def test_table_column_counts():
    sizes = {(g, t.name): len(t.output_names()) for g, tables in specs.TABLE_GROUPS.items() for t in tables}
    assert sizes == {
        ("api", "submissions"): 20,
        ("api", "publications"): 24,
        ("api", "authors"): 9,
        ("api", "review_assignments"): 8,
        ("api", "users"): 11,
        ("api", "user_groups"): 5,
        ("api", "submission_files"): 16,
        ("api", "publication_stats"): 6,
        ("api", "views_timeline"): 5,
        ("api", "views_timeline_totals"): 4,
        ("articles", "submissions"): 13,
        ("articles", "authors"): 10,
        ("articles", "editors"): 6,
        ("articles", "decisions"): 5,
        ("reviews", "reviews"): 22,
    }
