"""Column expressions against hand-written values."""

import re

import pytest
from pyspark.sql import functions as F

from foliate.errors import OptionError
from foliate.functions import dates, multilingual, nested, text
from foliate.functions.html import clean_html


def clean(spark, mode, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["x"] for r in clean_html(df, {"x": mode}).orderBy("i").collect()]


def one(spark, column, ddl, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r["y"] for r in df.withColumn("y", column).orderBy("i").collect()]


def test_strip_html(spark):
    cases = {
        "<h2>Tide&nbsp;tables</h2> for &Eacute;tretat": "Tide tables for Étretat",
        "north<br>south<br/>east<BR clear=all>west": "north\nsouth\neast\nwest",
        "<div>first</div><ul><li>second</li><li>third</LI></ul>": "first\nsecond\nthird",
        "5 &gt; 3 &#38; 2 &#x3c; 4": "5 > 3 & 2 < 4",
        "twice &amp;amp; escaped": "twice &amp; escaped",
        "top\n\n\n\nbottom": "top\n\nbottom",
        " \u2003padded\t": "padded",
        "": "",
        "<em title='a b'>kept</em> whole": "kept whole",
    }
    assert clean(spark, "text", list(cases)) == list(cases.values())
    assert clean(spark, "text", [None]) == [None]


def test_strip_html_lines(spark):
    cases = {
        "Ada Quill<br>  Ben Stone  ": "Ada Quill\nBen Stone",
        "<p>Cy</p>\r\n\r\n<p>Di</p>": "Cy\nDi",
        "one\rtwo&#10;three": "one\ntwo\nthree",
        " &nbsp; <br> \t <div></div>": None,
        "&lt;li&gt; as text": "<li> as text",
        "": None,
        "none given": "none given",
    }
    assert clean(spark, "lines", list(cases)) == list(cases.values())
    assert clean(spark, "lines", [None]) == [None]


def test_clean_html_rejects_unknown_mode(spark):
    with pytest.raises(OptionError):
        clean_html(spark.range(1), {"id": "markdown"})


def test_clean_html_handles_several_columns_with_odd_names(spark):
    df = spark.createDataFrame([("<b>x</b>", "y<br>z", 1)], "`a.b` string, c string, k int")
    row = clean_html(df, {"a.b": "text", "c": "lines"}).first()
    assert (row["a.b"], row["c"], row["k"]) == ("x", "y\nz", 1)


def test_localized(spark):
    x = F.col("x")
    values = ['{"en_US": "T", "fr_CA": "F"}', '{"fr_CA": "F"}', '{"en_US": ""}', "plain", "", None, "{not json", '{"en_US": null}']
    assert one(spark, multilingual.localized(x), "string", *values) == ["T", None, None, "plain", None, None, "{not json", None]
    assert one(spark, multilingual.localized(x, fallback_any=True), "string", *values) == [
        "T", "F", None, "plain", None, None, "{not json", None,
    ]
    ordered = ['{"en_US": "", "zz": "", "fr_CA": "Groupe des lecteurs", "aa": "later"}']
    assert one(spark, multilingual.localized(x, fallback_any=True), "string", *ordered) == ["Groupe des lecteurs"]


def test_join_list(spark):
    values = ['{"en_US": ["a", "b"]}', '{"en_US": []}', '{"fr_CA": ["a"]}', None, '{"en_US": [""]}', '{"en_US": null}']
    assert one(spark, multilingual.join_list(F.col("x")), "string", *values) == ["a; b", None, None, None, "", None]


def test_stage_label_and_round(spark):
    x = F.col("x")
    assert one(spark, text.stage_label(x), "bigint", 4, 11, 999, None, 9_999_999_999) == [
        "review_file", "production_ready", "stage_999", "stage_unknown", "stage_9999999999",
    ]
    assert one(spark, text.stage_label(x), "string", "4", "abc") == ["review_file", "stage_unknown"]
    assert one(spark, text.review_round_id(x, F.lit(7)), "bigint", 521, 520, None) == [7, None, None]


def test_small_text_rules(spark):
    x = F.col("x")
    assert one(spark, text.safe_name(x), "string", "paper draft.pdf", "__a/../b__", "é", None, "") == [
        "paper_draft.pdf", "a_.._b", "file", "file", "file",
    ]
    assert one(spark, text.mask_token(x), "string", "GET https://h/x?apiToken=s3cret&p=1 'apiToken=b'", None) == [
        "GET https://h/x?apiToken=[REDACTED]&p=1 'apiToken=[REDACTED]'", None,
    ]
    assert one(spark, text.yes_to_bool(x), "string", "Yes", "No", None) == [True, False, None]
    assert one(spark, text.numeric_or_zero(x), "string", "2", "x", None) == [2.0, 0.0, 0.0]
    assert one(spark, text.blank_to_null(x), "string", "", "a", None) == [None, "a", None]


def test_iso_dates(spark):
    values = ["2024-02-29", "2023-02-29", "20260101", "2026-W01-1", "2026-1-01", "2024-01-02\n", " 2024-01-02", None]
    assert one(spark, dates.is_iso_date(F.col("x")), "string", *values) == [True] + [False] * 7
    for bad in ("20260101", "2026-W01-1", "2026-1-01", "2026-02-30"):
        with pytest.raises(OptionError):
            dates.require_iso_date("since", bad)
    dates.require_iso_date("since", "2024-02-29")


def test_timestamps_stay_naive_and_strict(spark):
    values = ["2024-03-10 02:30:00", "2024-02-30 00:00:00", "2024-01-02", "2024-1-2 3:4:5", "bad", None]
    got = one(spark, dates.parse_timestamp(F.col("x")).cast("string"), "string", *values)
    assert got == ["2024-03-10 02:30:00", None, None, None, None, None]


def test_marks(spark):
    ts = F.col("x").cast("timestamp_ntz")
    assert one(spark, dates.mark_text(ts), "string", "2024-06-15 08:30:00", "2024-03-11 02:30:00.5", None) == [
        "2024-06-14 08:30:00", "2024-03-10 02:30:00", None,
    ]
    assert one(spark, dates.window_text(ts), "string", "2024-03-01 00:00:00") == ["2024-02-29"]


ROUNDS = "array<struct<stageId:int,round:int,status:string,m:map<string,string>>>"


def test_latest_by(spark):
    col = nested.latest_by(F.col("x"), "stageId", "round")["status"]
    values = [
        [(2, 2, "a", {}), (3, 1, "b", {}), (2, 1, "c", {}), (None, None, "d", {})],
        [(3, 1, "first", {}), (3, 1, "second", {})],
        [(None, None, "only", {})],
        [],
        None,
    ]
    assert one(spark, col, ROUNDS, *values) == ["b", "first", "only", None, None]


def test_current_child(spark):
    ddl = "struct<cur:int,pubs:array<struct<id:int,t:string>>>"
    col = nested.current_child(F.col("x.pubs"), "id", F.col("x.cur"))["t"]
    pubs = [(1, "one"), (2, "two"), (2, "again")]
    assert one(spark, col, ddl, (2, pubs), (None, pubs), (9, pubs), (1, []), (1, None)) == ["two", "one", "one", None, None]


def test_counts_and_membership(spark):
    ddl = "array<struct<roleId:int>>"
    values = [[(4096,), (16,)], [(65536,)], [], None]
    assert one(spark, nested.array_len(F.col("x")), ddl, *values) == [2, 1, 0, 0]
    assert one(spark, nested.array_len_or_null(F.col("x")), ddl, *values) == [2, 1, None, None]
    assert one(spark, nested.any_child_in(F.col("x"), "roleId", [4096, 1]), ddl, *values) == [True, False, False, False]
    assert one(spark, nested.any_child_in(F.col("x"), "roleId", []), ddl, *values) == [True] * 4


def test_safe_names_keep_the_ascii_characters_only(spark):
    signs = [chr(i) for i in range(1, 0x3100)] + ["\U0001f600", "a \u00e9\u0660b", "__"]
    found = spark.createDataFrame([(s,) for s in signs], "s string").select("s", text.safe_name(F.concat(F.lit("a"), "s", F.lit("b"))).alias("name")).collect()
    assert {r["s"]: r["name"] for r in found} == {s: re.sub("[^A-Za-z0-9._-]+", "_", f"a{s}b") for s in signs}


def test_unsafe_characters_are_one_class_test():
    # Ranges are tried one after the other for each character; a predefined class is one look-up.
    assert "A-Z" not in text.UNSAFE_NAME_CHARS and "a-z" not in text.UNSAFE_NAME_CHARS
