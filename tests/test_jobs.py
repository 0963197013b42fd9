"""The jobs end to end, on landed files in a temporary folder."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import DataError, MissingDataError, OptionError
from foliate.plans import jobs, landing, specs
from foliate.sources import state, store, timeline
from foliate.streaming.sync_stream import seen_counts, sync_stream

TS = "2024-06-{:02d} 08:30:00"


def submission(i, day, **more):
    return {"id": i, "dateLastActivity": day and TS.format(day), "publications": [], **more}


def land(tmp_path, name, records):
    path = tmp_path / f"{name}.json"
    if name.startswith("_"):
        (tmp_path / name).mkdir(exist_ok=True)
        path = tmp_path / name / "part.json"
    path.write_text(json.dumps(records))


@pytest.fixture
def landing_dir(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    land(folder, "submissions", [submission(1, 1, statusLabel="Published"), submission(2, 15), submission(3, None)])
    land(folder, "_submissions", [{"id": i, "dateLastActivity": TS.format(1), "reviewAssignments": [{"id": i * 10}]} for i in (1, 2, 3)])
    land(folder, "publications", [{"_submission_id": i, "id": i, "status": 3, "version": 1, "authors": [{"email": "a@x.org"}]} for i in (1, 2, 3)])
    land(folder, "users", [{"id": 7, "email": "a@x.org", "groups": [{"id": 1, "roleId": 4096}]}, {"id": 8, "groups": None}])
    return folder


def counts(df):
    return {(r["dataset"], r["metric"]): r["value"] for r in df.collect()}


def test_normalize_api_job(spark, landing_dir, tmp_path, rows):
    out = str(tmp_path / "out")
    got = counts(jobs.run_normalize_api(spark, str(landing_dir), out))
    assert got[("submissions", "rows")] == 3 and got[("authors", "rows")] == 3
    assert got[("authors", "matched")] == 3 and got[("publications", "lost")] == 0
    assert ("views_timeline", "rows") not in got
    assert rows(spark.read.parquet(f"{out}/review_assignments"), "submission_id", "assignment_id") == [(1, 10), (2, 20), (3, 30)]
    (landing_dir / "users.json").rename(landing_dir / "users.off")
    with pytest.raises(MissingDataError, match="users"):
        jobs.run_normalize_api(spark, str(landing_dir), out)


def test_report_job(spark, tmp_path, rows):
    head = "Submission ID,Title,Family Name (Author 1)\n"
    (tmp_path / "articles-20240101.csv").write_text(head + "1,old,A\n")
    (tmp_path / "articles-20240201.csv").write_text(head + '2,"two\nlines",B\n')
    out = str(tmp_path / "out")
    got = counts(jobs.run_normalize_report(spark, "articles", out, downloads_dir=str(tmp_path)))
    assert got == {("submissions", "rows"): 1, ("authors", "rows"): 1, ("editors", "rows"): 0, ("decisions", "rows"): 0}
    assert rows(spark.read.parquet(f"{out}/submissions"), "submission_id", "title") == [(2, "two\nlines")]
    (tmp_path / "reviews-20240101.csv").write_text("<html>login</html>")
    with pytest.raises(DataError, match="web page"):
        jobs.run_normalize_report(spark, "reviews", out, downloads_dir=str(tmp_path))
    with pytest.raises(OptionError, match="articles, reviews"):
        jobs.run_normalize_report(spark, "editors", out, downloads_dir=str(tmp_path))


def test_sync_options_are_checked_first(spark):
    for options in (
        {"full": True, "incremental": True},
        {"full": True, "since": "2024-01-01"},
        {"user_roles": [1]},
        {"since": "20240101"},
        {"stats_since": "2024-02-30"},
        {"stats_until": "x"},
        {"stats_interval": "week"},
    ):
        with pytest.raises(OptionError):
            jobs.sync(spark, {}, "/nowhere", TS.format(1), **options)
    with pytest.raises(MissingDataError, match="submissions"):
        jobs.sync(spark, {}, "/nowhere", TS.format(1))


def test_sync_merges_what_changed(spark, landing_dir, tmp_path, rows):
    target = str(tmp_path / "target")

    def run(day, **options):
        return counts(jobs.sync(spark, str(landing_dir), target, TS.format(day), stats=False, **options))

    first = run(16, incremental=True)
    assert first[("run", "incremental")] == 0 and first[("submissions", "total")] == 3 and first[("submissions", "tracked")] == 3
    seen = state.seen_of(state.load_state(spark, f"{target}/state")["seen"], "submissions")
    assert rows(seen) == [(1, TS.format(1)), (2, TS.format(15)), (3, None)]

    # 1 changes without moving past the mark, 2 stays, 3 has no time, 4 is new.
    land(landing_dir, "submissions", [submission(1, 2, statusLabel="late"), submission(2, 15), submission(3, None), submission(4, 20), submission(4, 20, statusLabel="last")])
    land(landing_dir, "publications", [{"_submission_id": i, "id": i, "version": 2} for i in (1, 2, 3, 4)])
    second = run(21, incremental=True)
    assert second[("run", "incremental")] == 1
    assert second[("submissions", "fetched")] == 4 and second[("submissions", "total")] == 4
    assert second[("publications", "fetched")] == 2, "2 is unchanged and 1 is older than the mark"
    merged = store.read(spark, f"{target}/submissions")
    assert rows(merged, "id", "statusLabel") == [(1, "Published"), (2, None), (3, None), (4, "last")]
    assert rows(store.read(spark, f"{target}/publications"), "_submission_id", "version") == [(1, 1), (2, 1), (3, 2), (4, 2)]
    assert rows(seen_counts(state.load_state(spark, f"{target}/state")["seen"])) == [("submissions", 4, 3)]

    assert (second[("submissions", "added")], second[("submissions", "changed")], second[("submissions", "equal")]) == (1, 0, 2)
    assert second[("submissions", "skipped")] == 1 and second[("publications", "added")] == 1
    versions = {n: store.layout(spark, f"{target}/{n}").version for n in ("submissions", "_submissions")}
    third = run(22, since="2024-06-02")
    assert third[("submissions", "fetched")] == 5 and third[("submissions", "equal")] == 3
    assert versions == {n: store.layout(spark, f"{target}/{n}").version - (n == "submissions") for n in versions}, "equal rows write nothing"
    assert not list((tmp_path / "target").glob("delta")) and not list((tmp_path / "target").glob("landed"))
    land(landing_dir, "submissions", [submission(9, 9)])
    fourth = run(23, full=True)
    assert fourth[("submissions", "total")] == 1 and fourth[("submissions", "tracked")] == 1


def test_a_plain_run_leaves_the_state_alone(spark, landing_dir, tmp_path):
    target = str(tmp_path / "target")
    got = counts(jobs.sync(spark, str(landing_dir), target, TS.format(1), stats=False))
    assert got[("run", "sync_state_written")] == 0
    assert state.load_state(spark, f"{target}/state")["seen"].count() == 0


def test_files_have_their_own_mark(spark, landing_dir, tmp_path, rows):
    target = str(tmp_path / "target")
    land(landing_dir, "submission_files", [{"_submission_id": i, "id": i, "fileId": i} for i in (1, 2, 3)])

    def run(day, **options):
        return counts(jobs.sync(spark, str(landing_dir), target, TS.format(day), stats=False, incremental=True, **options))

    run(16)
    assert run(17, files=True)[("submission_files", "fetched")] == 3, "first use backfills"
    assert run(18, files=True)[("submission_files", "fetched")] == 1, "only the one without a time"
    run(19)
    seen = state.load_state(spark, f"{target}/state")["seen"]
    assert state.seen_of(seen, "files").count() == 3


def test_user_details_of_a_role_keep_the_others(spark, landing_dir, tmp_path, rows):
    target = str(tmp_path / "target")
    land(landing_dir, "user_details", [{"id": 7, "country": "NO"}, {"id": 8, "country": "SE"}])
    jobs.sync(spark, str(landing_dir), target, TS.format(1), stats=False, user_details=True)
    land(landing_dir, "user_details", [{"id": 7, "country": "DK"}, {"id": 8, "country": "FI"}])
    jobs.sync(spark, str(landing_dir), target, TS.format(2), stats=False, user_details=True, user_roles=[4096])
    assert rows(store.read(spark, f"{target}/user_details"), "id", "country", "_fetched_at") == [
        (7, "DK", TS.format(2)), (8, "SE", TS.format(1)),
    ]


def test_stats_window(spark, landing_dir, tmp_path, rows):
    target = str(tmp_path / "target")

    def points(value):
        return [{"_submission_id": s, "date": f"2024-06-{d:02d}", "value": value, "kind": "abstract", "interval": "day"} for s in (1, 5) for d in (10, 15, 16)]

    land(landing_dir, "publication_stats", [{"publication": {"id": 1}, "abstractViews": 3}, {"publication": None}])
    land(landing_dir, "views_timeline", points(1))
    land(landing_dir, "views_timeline_totals", [{"date": "2024-06", "value": 0, "kind": "abstract", "interval": "month"}])
    first = counts(jobs.sync(spark, str(landing_dir), target, TS.format(16), incremental=True))
    assert first[("run", "stats_ok")] == 1 and first[("views_timeline", "total")] == 3
    assert first[("views_timeline_totals", "total")] == 0, "only day points are taken"
    assert state.mark_of(state.load_state(spark, f"{target}/state")["marks"], "stats") == TS.format(16)

    # A run without stats moves the general mark but not the window.
    jobs.sync(spark, str(landing_dir), target, TS.format(28), incremental=True, stats=False)
    land(landing_dir, "views_timeline", points(2))
    jobs.sync(spark, str(landing_dir), target, TS.format(29), incremental=True)
    kept = timeline.read_points(spark, f"{target}/views_timeline")
    assert rows(kept, "date", "value") == [("2024-06-10", 1), ("2024-06-15", 2), ("2024-06-16", 2)]


def test_stored_datasets_are_profiled(spark, landing_dir, tmp_path):
    target = str(tmp_path / "target")
    jobs.sync(spark, str(landing_dir), target, TS.format(16), incremental=True, stats=False)
    stored = store.read(spark, f"{target}/submissions")
    found = {(r["dataset"], r["column"]): r for r in jobs.profile_datasets(spark, target, ["submissions", "users", "user_details"]).collect()}
    assert {d for d, _ in found} == {"submissions", "users"}
    assert {c for d, c in found if d == "submissions"} == set(stored.columns)
    assert found["submissions", "id"]["distinct_values"] == found["submissions", "id"]["rows"] == stored.count()
    with pytest.raises(MissingDataError):
        jobs.profile_datasets(spark, target, ["user_details"])


def test_a_failed_run_leaves_the_marks(spark, landing_dir, tmp_path):
    target = str(tmp_path / "target")
    jobs.sync(spark, str(landing_dir), target, TS.format(16), incremental=True, stats=False)
    land(landing_dir, "submissions", [submission(4, 20)])
    landed = {n: None for n in landing.SCHEMAS_DDL}
    from foliate.sources.records import read_datasets

    landed.update(read_datasets(spark, str(landing_dir), landing.required_schemas(), {}))
    landed["users"] = landed["users"].withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        jobs.sync(spark, landed, target, TS.format(21), incremental=True, stats=False)
    loaded = state.load_state(spark, f"{target}/state")
    assert state.mark_of(loaded["marks"], "all") == TS.format(16)
    assert state.seen_of(loaded["seen"], "submissions").count() == 3


def test_staged_frames_are_not_written_again(spark, rows, tmp_path):
    def frames(n):
        ids = store.deal(spark.range(n), ["id"], 16)
        found = {name: ids.select(*[(F.col("id") if f.name in ("id", "_submission_id") else F.lit(None)).cast(f.dataType).alias(f.name) for f in landing.schema_of(name)]) for name in landing.REQUIRED}
        return {**found, "submissions": found["submissions"].withColumn("dateLastActivity", F.lit(TS.format(n // 10)))}

    target, seen = str(tmp_path / "data"), []
    options = {"stats": False, "staged": True, "dealt": True, "buckets": 16, "before_commit": lambda: seen.append(os.path.exists(f"{target}/landed"))}
    jobs.sync(spark, frames(20), target, TS.format(3), full=True, **options)
    got = counts(jobs.sync(spark, frames(30), target, TS.format(4), incremental=True, **options))
    assert seen == [False, False] and got[("publications", "added")] == 10
    assert rows(store.read(spark, f"{target}/publications"), "_submission_id") == [(i,) for i in range(30)]
    with pytest.raises(OptionError, match="dealt frames need"):
        jobs.sync(spark, frames(20), target, TS.format(5), dealt=True)


def test_dealt_records_and_stored_rows_are_not_dealt_again(spark, rows, tmp_path, monkeypatch):
    def frames(ids, at, version):
        found = {name: spark.createDataFrame([], landing.schema_of(name)) for name in landing.REQUIRED}
        ids = spark.createDataFrame([(i,) for i in ids], "id bigint")
        found["submissions"] = ids.selectExpr("id", f"'{at}' as dateLastActivity")
        lines = ids.selectExpr("id as _submission_id", f"explode(array({version}, {version - 1})) as version")
        found["publications"] = store.deal(lines, ["_submission_id"], 16).withColumn("abstract", F.repeat(F.col("version").cast("string"), 9))
        return found

    plans, write = {}, store._write

    def seen(df, before, *args, **kwargs):
        plans[before.path] = df._jdf.queryExecution().optimizedPlan(), df
        return write(df, before, *args, **kwargs)

    target = str(tmp_path / "data")
    options = {"stats": False, "staged": True, "dealt": True, "buckets": 16}
    jobs.sync(spark, frames(range(40), TS.format(3), 2), target, TS.format(3), full=True, **options)
    monkeypatch.setattr(store, "_write", seen)
    got = counts(jobs.sync(spark, frames(range(30, 50), TS.format(9), 8), target, TS.format(9), incremental=True, **options))
    assert [got[("publications", m)] for m in ("fetched", "added", "changed", "equal", "total")] == [40, 10, 10, 0, 80]
    assert rows(store.read(spark, f"{target}/publications").where("_submission_id between 29 and 31"), "_submission_id", "version", "abstract") == [
        (29, 1, "1" * 9), (29, 2, "2" * 9), (30, 8, "8" * 9), (31, 8, "8" * 9),
    ]
    # What is shuffled on the way to the stored rows and to the delta: keys, places and, once, the records before they are wide.
    for path in (f"{target}/publications", f"{target}/delta/publications"):
        for line in plans[path][0].toString().split("RepartitionByExpression")[1:]:
            assert "abstract" not in line.split("\n")[1], line


def test_no_join_of_a_sync_is_broadcast_by_the_size_of_files(spark, rows, tmp_path, monkeypatch):
    found = {name: store.deal(spark.createDataFrame([], landing.schema_of(name)), ["id" if name != "publications" else "_submission_id"], 16) for name in landing.REQUIRED}
    role = "struct(id, 'G' as name, 'g' as abbrev, if(id % 2 = 0, 4096, 16) as roleId)"
    found["users"] = store.deal(spark.range(200).selectExpr("id", f"array({role}) as groups"), ["id"], 16)
    found["user_details"] = store.deal(spark.range(300).selectExpr("id", "'CA' as country"), ["id"], 16)
    plans, met, compared = [], store._met, store._compared

    def planned(step):
        def wrapped(*args, **kwargs):
            df = step(*args, **kwargs)
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
            return df

        return wrapped

    monkeypatch.setattr(store, "_met", planned(met))
    monkeypatch.setattr(store, "_compared", planned(compared))
    target = str(tmp_path / "data")
    options = {"stats": False, "staged": True, "dealt": True, "buckets": 16, "user_details": True}
    jobs.sync(spark, found, target, TS.format(3), full=True, user_roles=[4096], **options)
    got = counts(jobs.sync(spark, found, target, TS.format(9), incremental=True, user_roles=[16], **options))
    assert [got[("user_details", m)] for m in ("fetched", "added", "total")] == [100, 100, 200]
    assert rows(store.read(spark, f"{target}/user_details").groupBy("_fetched_at").count()) == [(TS.format(3), 100), (TS.format(9), 100)]
    assert len(plans) >= 5 and not any("BroadcastHashJoin" in plan for plan in plans)


def test_download_plan_job(spark, rows, tmp_path):
    files = spark.createDataFrame(
        [(1, 1, 10, 2, "a", "u"), (1, 2, 11, 11, "b", "u"), (2, 3, 12, 4, "c", "u")],
        "_submission_id bigint, id bigint, fileId bigint, fileStage bigint, name string, url string",
    ).withColumns(
        {"assocType": F.lit(None).cast("bigint"), "assocId": F.lit(None).cast("bigint"), "revisions": F.lit(None).cast("array<struct<fileId:bigint,url:string>>")}
    )
    plan = jobs.run_download_plan
    assert rows(plan(spark, files), "file_id") == [(10,), (11,), (12,)]
    assert rows(plan(spark, files, file_type="galleys"), "file_id") == [(11,)]
    assert rows(plan(spark, files, submission_ids=[2, 9]), "file_id") == [(12,)]
    assert rows(plan(spark, files, submissions=spark.createDataFrame([(1,)], "id bigint"), file_stages=[2]), "file_id") == [(10,)]
    with pytest.raises(MissingDataError):
        plan(spark, files, submission_ids=[9])
    with pytest.raises(OptionError):
        plan(spark, files, file_type="posters")
    path = str(tmp_path / "manifest")
    done = plan(spark, files).where("file_id < 12").select("file_id", "path")
    manifest = jobs.append_manifest(spark, path, done)
    manifest = jobs.append_manifest(spark, path, done.limit(1))
    assert manifest.count() == 2
    assert rows(plan(spark, files, manifest), "file_id") == [(12,)]


def test_schema_catalog_job(spark, rows, tmp_path):
    table = spark.createDataFrame([(1, "Accept"), (1, None)], "submission_id bigint, decision string")
    got = jobs.run_schema_catalog(spark, str(tmp_path), "articles", {"decisions": table})
    assert ("decisions", 5) in rows(got)
    docs = spark.read.csv(f"{tmp_path}/table_schemas", header=True, escape='"')
    assert rows(docs.where("table_name = 'decisions' and nulls is not null"), "column_name", "nulls", "distinct_values") == [
        ("decision", "1", "1"), ("submission_id", "0", "1"),
    ]
    with pytest.raises(OptionError):
        jobs.run_schema_catalog(spark, str(tmp_path), "posters")
    for group, tables in specs.TABLE_GROUPS.items():
        assert len(rows(jobs.run_schema_catalog(spark, str(tmp_path / group), group))) == len(tables)


def test_stream_takes_each_file_once(spark, rows, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    folder, target, checkpoint = (str(tmp_path / n) for n in ("landing", "data", "checkpoint"))
    (tmp_path / "landing").mkdir()

    def run():
        sync_stream(spark, folder, schema, target, ["id"], checkpoint).awaitTermination()
        return rows(store.read(spark, target))

    (tmp_path / "landing" / "a.json").write_text('{"id": 1, "v": "a"}\n{"id": 2, "v": "b"}\n{"id": 1, "v": "A"}\n')
    assert run() == [(1, "A"), (2, "b")]
    (tmp_path / "landing" / "b.json").write_text('{"id": 2, "v": "B"}\n{"id": 3, "v": "c"}\n')
    assert run() == [(1, "A"), (2, "B"), (3, "c")]
    versions = store.layout(spark, target).version
    assert run() == [(1, "A"), (2, "B"), (3, "c")]
    assert store.layout(spark, target).version == versions


def test_downloads_are_recorded_and_planned_again(spark, rows, tmp_path):
    target = str(tmp_path / "target")
    files = spark.createDataFrame(
        [(1, 1, 10, 2, "a", "u"), (1, 2, 11, 11, "b", "u"), (2, 3, 12, 4, "c", "u")],
        "_submission_id bigint, id bigint, fileId bigint, fileStage bigint, name string, url string",
    ).withColumns(
        {"assocType": F.lit(None).cast("bigint"), "assocId": F.lit(None).cast("bigint"), "revisions": F.lit(None).cast("array<struct<fileId:bigint,url:string>>")}
    )
    first = jobs.plan_downloads(spark, files, target)
    assert rows(first, "file_id") == [(10,), (11,), (12,)]
    outcomes = first.select("file_id", "path", F.when(F.col("file_id") == 11, "web page").alias("reason"))
    assert rows(jobs.record_downloads(spark, target, outcomes)) == [("refused", 1), ("stored", 2)]
    again = jobs.plan_downloads(spark, files, target)
    assert rows(again, "file_id") == [(11,)], "a refused file stays due"
    assert rows(store.read(spark, f"{target}/refused"), "file_id", "reason") == [(11, "web page")]
    jobs.record_downloads(spark, target, again.select("file_id", "path", F.lit(None).cast("string").alias("reason")))
    assert jobs.plan_downloads(spark, files, target).isEmpty()
    assert store.read(spark, f"{target}/manifest").count() == 3
