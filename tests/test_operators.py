"""Reshape, filter, join, merge and numbering operators on small frames."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliate.errors import MissingDataError, OptionError
from foliate.operators import downloads, filters, joins, merge, quality, ranking, reshape
from foliate.plans import landing

AUTHOR_FIELDS = {"Family Name": "family_name", "Given Name": "given_name"}


# -- reshape ----------------------------------------------------------------


NUMBERS = st.lists(st.integers(1, 999), unique=True, max_size=5)


@given(st.data())
def test_numbers_are_those_of_mapped_fields(data):
    """Headers are made from a field, an entity and a number; which numbers count follows from how they were made."""
    fields = dict(zip("Harbour Mast Keel".split(), "harbour mast keel".split(), strict=True))
    made = [(field, entity, n) for field in [*fields, "Ballast"] for entity in ("Ship", "Buoy") for n in data.draw(NUMBERS)]
    headers = data.draw(st.permutations([f"{field} ({entity} {n})" for field, entity, n in made] + ["Log", "Harbour", "Harbour (Ship)", "Keel (Ship x)"]))
    for entity in ("Ship", "Buoy"):
        assert reshape.entity_numbers(headers, fields, entity) == sorted({n for field, e, n in made if e == entity and field in fields})


@given(NUMBERS, NUMBERS)
def test_a_header_with_two_numbers_is_no_entity(editors, decisions):
    headers = [f"{kind} {d}  (Editor {e})" for kind in reshape.DECISION_FIELDS for e in editors for d in decisions]
    mapped = {f"{kind} {d} ": "x" for kind in reshape.DECISION_FIELDS for d in decisions}
    assert reshape.entity_numbers(headers, mapped, "Editor") == []


@given(st.dictionaries(st.tuples(st.integers(1, 40), st.integers(1, 40)), st.sets(st.sampled_from(sorted(reshape.DECISION_FIELDS)), min_size=1), max_size=8), st.randoms())
def test_slots_pair_the_headers_of_two_numbers(wanted, order):
    headers = [f"{kind} {d}  (Editor {e})" for (e, d), kinds in wanted.items() for kind in kinds] + ["Given Name (Editor 2)"]
    order.shuffle(headers)
    slots = reshape.two_index_slots(headers, reshape.DECISION_HEADER, ("editor_number", "decision_number"), reshape.DECISION_FIELDS)
    assert list(slots) == sorted(wanted)
    for (e, d), kinds in wanted.items():
        assert slots[e, d] == {reshape.DECISION_FIELDS[kind]: f"{kind} {d}  (Editor {e})" for kind in kinds}


def test_unpivot_then_pivot_is_identity(spark, rows):
    wide = spark.createDataFrame(
        [(1, "L", "A", "M", ""), (2, None, "", "N", "B"), (3, None, None, None, None)],
        "`Submission ID` int, `Family Name (Author 1)` string, `Given Name (Author 1)` string, "
        "`Family Name (Author 10)` string, `Given Name (Author 10)` string",
    )
    long = reshape.unpivot_numbered(wide, AUTHOR_FIELDS, "Submission ID", "n", "Author")
    assert rows(long, "submission_id", "n", "family_name", "given_name") == [
        (1, 1, "L", "A"), (1, 10, "M", ""), (2, 10, "N", "B"),
    ]
    back = long.groupBy("submission_id").pivot("n", [1, 10]).agg(F.first("family_name"))
    assert rows(back) == [(1, "L", "M"), (2, None, "N")]
    scans = long._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")
    assert scans == 1


def test_unpivot_without_headers(spark):
    df = spark.createDataFrame([(1,)], "`Submission ID` int")
    assert reshape.unpivot_numbered(df, AUTHOR_FIELDS, "Submission ID", "n", "Author") is None


def test_unions(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "id int, p string"), spark.createDataFrame([(2, "y")], "id int, q string")
    assert rows(reshape.diagonal_union(a, b)) == [(1, "x", None), (2, None, "y")]
    tagged = reshape.tag_series({"abstract": a.select("id"), "galley": b.select("id")}, "month")
    assert rows(tagged) == [(1, "abstract", "month"), (2, "galley", "month")]


def test_explode_ordered_is_stable_and_null_safe(spark, rows):
    ddl = "id int, authors array<struct<name:string,seq:string>>"
    df = spark.createDataFrame(
        [(1, [("Beta", "2"), ("NullSeq", None), ("Text", "x"), ("Alpha", "1")]), (2, None), (3, [])], ddl
    )
    out = reshape.explode_ordered(df, "authors", "seq", ["id"], "n", "a").select("id", "n", "a.name")
    assert rows(out) == [(1, 1, "NullSeq"), (1, 2, "Text"), (1, 3, "Alpha"), (1, 4, "Beta")]


# -- filters ----------------------------------------------------------------


def test_changed_since(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-06-01 00:00:00"), (2, None), (3, "2024-05-31 23:59:59"), (4, "2024-06-02 00:00:00")], "id int, ts string"
    )
    typed = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for frame in (df, typed):
        assert rows(filters.changed_since(frame, "2024-06-01 00:00:00", "ts"), "id") == [(2,), (4,)]
        assert rows(filters.changed_since(frame, "2024-06-01", "ts"), "id") == [(1,), (2,), (4,)]
        assert filters.changed_since(frame, None, "ts") is frame


def test_date_window_is_inclusive_for_days_and_months(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-14",), ("2024-01-15",), ("2024-02-03",), ("2024-02-04",), ("2024-01",), ("2023-12",), ("2024-03",)], "date string"
    )
    got = rows(filters.date_window(df, "date", "2024-01-15", "2024-02-03"))
    assert got == [("2024-01",), ("2024-01-15",), ("2024-02-03",)]
    assert filters.date_window(df, "date").count() == 7
    with pytest.raises(OptionError):
        filters.date_window(df, "date", "2024-1-15")


def test_option_guards():
    assert filters.stage_ids("galleys") == [11]
    assert filters.stage_ids("review", [9]) == [9]
    assert filters.stage_ids() is None
    with pytest.raises(OptionError):
        filters.stage_ids("posters")
    with pytest.raises(OptionError):
        filters.require_interval("week")


def test_zero_points_do_not_change_the_sum(spark):
    df = spark.createDataFrame([(0,), (5,), (None,), (3,), (0,)], "views int")
    kept = filters.drop_nonpositive(df, "views")
    assert kept.count() == 2
    assert kept.agg(F.sum("views")).first()[0] == df.agg(F.sum("views")).first()[0]


# -- joins ------------------------------------------------------------------


def test_last_wins(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (None, 1, "n"), (None, 2, "m")], "k int, o int, v string")
    assert rows(joins.last_wins(df, ["k"], ["o"]), "k", "v") == [(None, "m"), (1, "c")]
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    got = joins.left_join_last(left, df, "id", "k", ["o"])
    assert rows(got, "id", "v") == [(None, None), (1, "c"), (2, None)]


def test_unambiguous_lookup(spark, rows):
    users = spark.createDataFrame(
        [(1, "dup@x.org"), (2, "dup@x.org"), (3, "u@x.org"), (5, "a@x.org"), (5, "a@x.org"), (6, ""), (7, None)],
        "id int, email string",
    )
    authors = spark.createDataFrame(
        [(1, "dup@x.org"), (2, "u@x.org"), (3, "a@x.org"), (4, ""), (5, None), (6, "U@x.org")], "n int, email string"
    )
    got = joins.unambiguous_lookup(authors, users, "email", "email", "id", "user_id")
    assert rows(got, "n", "user_id") == [(1, None), (2, 3), (3, 5), (4, None), (5, None), (6, None)]
    assert rows(joins.ambiguous_keys(users, "email", "id")) == [("dup@x.org", 2, 1, 2)]


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(0, 4000).select("id", F.when(F.col("id") < 0, "a").alias("email"))
    right = spark.createDataFrame([(1, "a")], "uid int, email string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.unambiguous_lookup(left, right, "email", "email", "uid", row_id=["id"])
        exchanges = [line for line in joined._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(email" in line]
        assert any("__salt_l" in line for line in exchanges)
        assert joined.where("uid is null").count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_skip_unchanged(spark, rows):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (5, "e")], "id int, ts string")
    seen = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, None)], "id int, last_activity string")
    assert rows(joins.skip_unchanged(now, seen, "id", "ts"), "id") == [(2,), (3,), (4,), (5,)]


def test_missing_keys(spark, rows):
    stored = spark.createDataFrame([(1,), (1,)], "sid int")
    ids = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(joins.missing_keys(ids, stored, "sid")) == [(2,)]
    assert joins.require_some_keys(ids, stored, "sid") == 1
    with pytest.raises(MissingDataError):
        joins.require_some_keys(ids.where("id = 2"), stored, "sid")


def test_dimension_label(spark, rows):
    df = spark.createDataFrame([(1,), (9,), (None,)], "k bigint")
    want = [(None, "Unknown (None)"), (1, "One"), (9, "Unknown (9)")]
    assert rows(joins.dimension_label(df, "k", "l", {1: "One"})) == want
    dim = spark.createDataFrame([(1, "One")], "id int, title string")
    assert rows(joins.dimension_label(df, "k", "l", dim)) == want
    assert rows(joins.dimension_label(df, "k", "l", {}))[1] == (1, "Unknown (1)")


def test_picks_over_child_rows(spark, rows):
    children = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 20, 2), (2, 21, 1), (3, 30, 1)], "k int, id int, o int")
    parents = spark.createDataFrame([(1, 11), (2, None), (3, 99)], "k int, cur int")
    assert rows(joins.pick_current(children, parents, "k", "id", "cur", ["o"]), "k", "id") == [(1, 11), (2, 21), (3, 30)]
    rounds = spark.createDataFrame([(1, 2, 2, 1), (1, 3, 1, 2), (1, 3, 1, 3), (2, None, None, 4)], "k int, st int, r int, id int")
    assert rows(joins.latest_row(rounds, ["k"], ["st", "r"], ["id"]), "k", "id") == [(1, 2), (2, 4)]


# -- merge ------------------------------------------------------------------


def test_upsert(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    new = spark.createDataFrame([(2, "B0", 1), (2, "B", 2), (3, "c", 3), (None, "N", 4)], "id int, v string, seq int")
    merged = merge.upsert(old, new, ["id"], ["seq"])
    assert merged.columns == ["id", "v"]
    assert rows(merged) == [(None, "N"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(merge.upsert(merged, new, ["id"], ["seq"])) == rows(merged)
    by_expression = merge.upsert(old, new, [F.col("id") * 2], ["seq"])
    assert rows(by_expression) == rows(merged)


def test_upsert_keeps_list_order(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id int, v string, seq int")
    new = spark.createDataFrame([(3, "c", 0), (2, "B", 1), (3, "C", 2)], "id int, v string, seq int")
    placed = merge.upsert_positions(old, new, ["id"], "seq").orderBy("source", "seq")
    assert [(r["id"], r["v"]) for r in placed.collect()] == [(1, "a"), (2, "B"), (3, "C")]


def test_composite_key_keeps_series_apart(spark, rows):
    ddl = "_submission_id int, interval string, date string, kind string, value int"
    old = spark.createDataFrame([(1, "day", "2024-01-01", "abstract", 1), (1, "month", "2024-01", "abstract", 9)], ddl)
    new = spark.createDataFrame([(1, "day", "2024-01-01", "abstract", 2), (1, "day", "2024-01-01", "galley", 4)], ddl)
    got = rows(merge.upsert(old, new, landing.MERGE_KEYS["views_timeline"], ["value"]), "interval", "kind", "value")
    assert got == [("day", "abstract", 2), ("day", "galley", 4), ("month", "abstract", 9)]


def test_high_water(spark):
    df = spark.createDataFrame([("2024-06-15 08:30:00",), (None,), ("",), ("2024-01-01 00:00:00",)], "ts string")
    assert merge.high_water_mark(df, "ts") == "2024-06-14 08:30:00"
    assert merge.high_water_mark(df.where("ts is null"), "ts") is None
    marks = spark.createDataFrame([("all", "2024-05-01 10:00:00"), ("stats", "2024-04-01 10:00:00")], "dataset string, mark string")
    assert merge.window_start(marks, "stats", fallback="all") == "2024-03-31"
    assert merge.window_start(marks.where("dataset = 'all'"), "stats", fallback="all") == "2024-04-30"
    assert merge.window_start(marks.limit(0), "stats", fallback="all") is None


# -- numbering --------------------------------------------------------------


@pytest.mark.parametrize("distinct_order", [False, True])
def test_number_rows_splits_a_hot_group_exactly(spark, distinct_order):
    df = spark.range(0, 3000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        (F.col("id") if distinct_order else F.col("id") % 7).alias("o"),
    )
    order = [F.col("o").asc_nulls_first()]
    plain = ranking.number_rows(df, ["k"], order, "n")
    split = ranking.number_rows(df, ["k"], order, "n", by_ranges=True)
    assert split.count() == 3000
    per_group = split.groupBy("k").agg(F.count("*").alias("c"), F.max("n").alias("m"), F.count_distinct("n").alias("d"))
    assert per_group.where("c <> m or c <> d").count() == 0
    assert split.groupBy("k", "o").agg(F.sum("n").alias("s")).exceptAll(
        plain.groupBy("k", "o").agg(F.sum("n").alias("s"))
    ).count() == 0


def test_copies_are_spread_over_ranges(spark):
    copies = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = ranking.spread_by_range(copies, [F.col("k")])
        sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and sum(sizes) == 20000


def test_number_rows_without_keys_is_the_total_order(spark):
    df = spark.range(500).select((499 - F.col("id")).alias("v"))
    numbered = ranking.number_rows(df, [], [F.col("v")], "n")
    assert numbered.where("n <> v + 1").count() == 0
    assert numbered.count() == 500


# -- quality ----------------------------------------------------------------


def test_reports_and_profile(spark, rows):
    df = spark.createDataFrame([("en_US", None), ("fr", "x"), (None, None)], "language string, rights string")
    assert rows(quality.always_null_report(df, ["rights", "absent"])) == [("rights", 1)]
    assert rows(quality.constant_report(df, {"language": "en_US"})) == [("language", 2, 1, "en_US", "fr")]
    assert rows(quality.profile(df)) == [("language", 3, 1, 2), ("rights", 3, 2, 1)]
    assert quality.preview(df, ["rights", "absent"], 2).columns == ["rights"]


def test_run_metrics(spark, tmp_path):
    metrics = quality.RunMetrics()
    df = metrics.watch(spark.range(10), "t", even=F.count_if(F.col("id") % 2 == 0))
    df.write.parquet(str(tmp_path / "t"))
    metrics.add("t", "fetched", 12)
    assert sorted(tuple(r) for r in metrics.to_df(spark).collect()) == [("t", "even", 5), ("t", "fetched", 12), ("t", "rows", 10)]


# -- downloads --------------------------------------------------------------

FILES_DDL = (
    "_submission_id bigint, id bigint, fileId bigint, fileStage bigint, name string, assocType bigint, assocId bigint, "
    "url string, revisions array<struct<fileId:bigint,url:string>>"
)


def test_download_targets(spark, rows):
    files = spark.createDataFrame(
        [
            (7, 1, 900, 4, '{"fr_CA": "paper draft.pdf"}', 521, 33, "u900", [(900, "again"), (880, "u880"), (880, "twice"), (0, "z")]),
            (8, 2, 700, 99, None, 1, 5, None, [(701, "u701"), (702, "")]),
            (9, 3, 600, None, "", None, None, "u600", None),
        ],
        FILES_DDL,
    )
    got = rows(downloads.download_targets(files), "file_id", "url", "stage", "review_round_id", "path")
    assert got == [
        (600, "u600", "stage_unknown", None, "9/stage_unknown/600_file"),
        (701, "u701", "stage_99", None, "8/stage_99/701_file"),
        (880, "u880", "review_file", 33, "7/review_file/880_paper_draft.pdf"),
        (900, "u900", "review_file", 33, "7/review_file/900_paper_draft.pdf"),
    ]
    assert rows(downloads.download_targets(files, include_revisions=False), "file_id") == [(600,), (900,)]


def test_download_plan_against_a_manifest(spark, rows):
    files = spark.createDataFrame([(1, i, i, 2, f"n{i}", None, None, "u", None) for i in (1, 2, 3, 4)], FILES_DDL)
    manifest = spark.createDataFrame(
        [(1, "1/submission/1_n1"), (2, "1/submission/2_old"), (4, "1/submission/4_n4")], "file_id bigint, path string"
    )
    assert rows(downloads.download_plan(files, None), "file_id", "stale_path") == [(1, None), (2, None), (3, None), (4, None)]
    assert rows(downloads.download_plan(files, manifest), "file_id", "stale_path") == [(2, "1/submission/2_old"), (3, None)]
    listing = spark.createDataFrame([("1/submission/1_n1",), ("1/submission/2_old",)], "path string")
    got = rows(downloads.download_plan(files, manifest, on_disk=listing), "file_id")
    assert got == [(2,), (3,), (4,)]


def test_paths_that_leave_the_folder_fail_the_job(spark):
    paths = spark.createDataFrame([("a/../../b",), ("/abs",), ("ok/..x/y",), ("..",), ("a/b",)], "path string")
    contained = [r["c"] for r in paths.select(downloads.is_contained(F.col("path")).alias("c")).collect()]
    assert contained == [False, False, True, False, True]
    with pytest.raises(Exception, match="refusing path"):
        downloads.guard_paths(paths).collect()


@pytest.mark.parametrize("hot_rows", [1, 7, 1 << 20])
def test_a_round_with_half_of_all_files(spark, rows, hot_rows):
    files = spark.createDataFrame([(i, 5 if i % 2 else (None if i % 10 == 0 else i)) for i in range(60)], "id bigint, review_round_id bigint")
    assignments = spark.createDataFrame([(5, a, 1, "s") for a in range(9)] + [(8, 70, 2, "t"), (None, 71, 2, "t"), (99, 72, 1, "u")], "round_id bigint, assignment_id bigint, round int, status string")
    got = joins.files_with_rounds(files, assignments, hot_rows)
    want = [(i, 5, a, 1, "s") for i in range(1, 60, 2) for a in range(9)] + [(8, 8, 70, 2, "t")]
    assert got.columns == ["id", "review_round_id", "assignment_id", "round", "assignment_status"]
    assert rows(got) == sorted(want)
    slices = {r["__hot"]: r["__slices"] for r in joins.hot_slices(files, "review_round_id", hot_rows).collect()}
    assert slices == ({} if hot_rows > 30 else {5: -(-30 // hot_rows)})
