"""Readers, the dataset store and the sinks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import DataError, MissingDataError, OptionError
from foliate.plans import specs
from foliate.operators import joins
from foliate.sources import records, reports, sinks, state, store, timeline

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_records_keep_mixed_multilingual_fields(spark, rows, tmp_path):
    data = [{"id": 1, "name": {"en_US": "a", "fr": 'q"'}}, {"id": 2, "name": "plain"}, {"id": 3, "name": None}, {"id": 4}]
    (tmp_path / "x.json").write_text(json.dumps(data, indent=2))
    df = records.read_records(spark, str(tmp_path / "x.json"), ITEM)
    assert df.columns == ["id", "name", "_seq"]
    assert [json.loads(r["name"]) for r in df.where("id = 1").collect()] == [{"en_US": "a", "fr": 'q"'}]
    assert rows(df.where("id > 1"), "id", "name") == [(2, "plain"), (3, None), (4, None)]
    assert [r["id"] for r in df.orderBy("_seq").collect()] == [1, 2, 3, 4]


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1, "name": "a"}\n{"id": 2}\n')
    assert records.read_records(spark, str(tmp_path / "x.json"), ITEM, multiline=False).count() == 2


def test_required_and_optional_datasets(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    found = records.read_datasets(spark, str(tmp_path), {"a": ITEM}, {"b": ITEM})
    assert found["a"].count() == 0 and found["b"] is None
    with pytest.raises(MissingDataError, match="c.json"):
        records.read_datasets(spark, str(tmp_path), {"a": ITEM, "c": ITEM}, {})


def test_unwrap_pages(spark, rows):
    full = '[{"id": 1, "name": "a"}, {"id": 2}]'
    pages = [full, full, '{"items": [{"id": 3}], "itemsMax": 3}', '  [\n{"id": 4}]', "[]", '{"items": []}']
    df = spark.createDataFrame([(p, f"url{i}") for i, p in enumerate(pages)], "payload string, url string")
    assert rows(records.unwrap_pages(df, "payload", ITEM, "url"), "id") == [(1,), (2,), (3,), (4,)]
    for bad in ('{"error": "no"}', '"text"', "<html>"):
        broken = spark.createDataFrame([(bad, "http://x")], "payload string, url string")
        with pytest.raises(Exception, match="unexpected response shape from http://x"):
            records.unwrap_pages(broken, "payload", ITEM, "url").collect()


def test_latest_snapshot(spark, tmp_path):
    for name in ("articles-20240101.csv", "articles-20240301.csv", "reviews-20250101.csv"):
        (tmp_path / name).write_text("a\n1\n")
    assert reports.latest_snapshot(spark, str(tmp_path), "articles-*.csv").endswith("articles-20240301.csv")
    explicit = str(tmp_path / "articles-20240101.csv")
    assert reports.latest_snapshot(spark, str(tmp_path), "articles-*.csv", explicit) == explicit
    for glob, file in (("editors-*.csv", None), ("articles-*.csv", str(tmp_path / "gone.csv"))):
        with pytest.raises(MissingDataError):
            reports.latest_snapshot(spark, str(tmp_path), glob, file)
    with pytest.raises(MissingDataError):
        reports.latest_snapshot(spark, str(tmp_path / "nowhere"), "articles-*.csv")


def test_html_payloads_are_told_apart(spark, tmp_path):
    bodies = {
        "page.csv": "﻿ \n\n  <!DOCTYPE html><html>",
        "good.csv": "﻿Submission ID,Title\n1,<b>x</b>\n",
        "lines.csv": "\n\na,b\n<,>\n",
        "blank.csv": "\n",
    }
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body.encode())
    paths = [str(tmp_path / n) for n in bodies]
    verdict = {r["path"].rsplit("/", 1)[1]: r["is_html"] for r in reports.reject_html_payload(spark, paths).collect()}
    assert verdict == {"page.csv": True, "good.csv": False, "lines.csv": False, "blank.csv": False}
    accepted, pages = reports.accepted_reports(spark, paths)
    assert pages == [str(tmp_path / "page.csv")] and len(accepted) == 3


def test_report_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes('﻿ID,Text,"B (e.g., x) (Author 1)"\n007,"a ""q""\nline",caf\xe9\n,"",z\n'.encode("utf-8").replace("é".encode(), b"\xe9"))
    df = reports.read_report_csv(spark, str(tmp_path / "r.csv"))
    assert df.columns == ["ID", "Text", "B (e.g., x) (Author 1)"]
    first, second = df.collect()
    assert tuple(first) == ("007", 'a "q"\nline', "caf�") and tuple(second) == (None, None, "z")


def test_store_replace_and_merge(spark, rows, tmp_path):
    path = str(tmp_path / "d")
    assert store.read(spark, path) is None
    first = spark.createDataFrame([(1, "a", 1), (1, "A", 2), (2, "b", 3)], "id int, v string, _seq int")
    assert rows(store.merge_dataset(spark, path, first, ["id"], ["_seq"])) == [(1, "A"), (2, "b")]
    delta = spark.createDataFrame([(2, "B", 1), (3, "c", 2)], "id bigint, v string, _seq int")
    for _ in range(2):
        assert rows(store.merge_dataset(spark, path, delta, ["id"], ["_seq"])) == [(1, "A"), (2, "B"), (3, "c")]
    assert rows(store.merge_dataset(spark, path, delta.limit(0), ["id"], ["_seq"])) == [(1, "A"), (2, "B"), (3, "c")]
    assert rows(store.replace_dataset(delta.drop("_seq").where("id = 3"), path, ["id"])) == [(3, "c")]
    assert rows(store.read(spark, path)) == [(3, "c")]
    assert store.replace_dataset(delta.limit(0), path, ["id"]).count() == 0
    assert store.merge_dataset(spark, path, delta, ["id"], ["_seq"]).count() == 2


def test_a_write_without_a_pointer_is_not_read(spark, rows, tmp_path):
    path = str(tmp_path / "d")
    store.replace_dataset(spark.createDataFrame([(1,)], "id int"), path)
    spark.createDataFrame([(2,)], "id int").write.parquet(f"{path}/data/lost")
    assert rows(store.read(spark, path)) == [(1,)]


def test_another_layout_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "d")
    store.replace_dataset(spark.createDataFrame([(1, "old"), (2, "keep")], "id int, v string"), path)
    with pytest.raises(OptionError, match="kept in one piece"):
        store.merge_dataset(spark, path, spark.createDataFrame([(1, "new")], "id int, v string"), ["id"], ["v"])
    assert rows(store.read(spark, path)) == [(1, "old"), (2, "keep")]


def test_the_second_of_two_writers_is_refused(spark, rows, tmp_path):
    path = str(tmp_path / "d")
    frame = spark.createDataFrame([(1,)], "id int")
    store.replace_dataset(frame, path)
    before = store.layout(spark, path)
    store._write(frame, before, (), 1, None)
    with pytest.raises(DataError, match="another writer"):
        store._write(spark.createDataFrame([(9,)], "id int"), before, (), 1, None)
    assert rows(store.read(spark, path)) == [(1,)]


def test_a_merge_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    path = str(tmp_path / "d")
    store.replace_dataset(spark.range(30_000).selectExpr("id", "0 as v"), path, ["id"])
    before = store.layout(spark, path).dirs
    assert len(before) == store.BUCKETS
    merged = store.merge_dataset(spark, path, spark.createDataFrame([(7, 1), (99_999, 1)], "id bigint, v int"), ["id"], ["v"])
    after = store.layout(spark, path).dirs
    assert sum(before[b] != after[b] for b in before) <= 2
    assert merged.count() == 30_001 and merged.agg(F.sum("v")).first()[0] == 2
    wide = spark.range(25_000).selectExpr("id", "5 as v")
    assert store.merge_dataset(spark, path, wide, ["id"], ["v"]).where("v = 5").count() == 25_000
    with pytest.raises(OptionError, match="kept in 16 buckets of id"):
        store.merge_dataset(spark, path, wide, ["id"], ["v"], buckets=8)


def test_rows_dealt_by_bucket_move_once(spark, rows, tmp_path):
    path, plain = str(tmp_path / "d"), spark.range(40_000).selectExpr("id as k", "if(id % 3 = 0, null, id) as n", "cast(id as string) as wide")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(0, 50_000, 2).withColumnRenamed("id", "i")
        dealt = store.deal(plain.select("k", "n"), ["k"], 16).withColumn("wide", F.repeat("k", 3)).withColumnRenamed("k", "key")
        found = store.of_ids(dealt, "key", ids, "i", 16, dealt=True)
        stored = store.replace_dataset(found, path, ["key"], 16, dealt=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange of the rows, before they are wide; the others are of ids.
    assert not [line for line in plan.splitlines() if "Exchange" in line and "__mine" in line]
    # Every bucket is written by the one task that its rows were dealt to.
    assert stored.select("_metadata.file_path").distinct().count() == 16 == len(store.layout(spark, path).dirs)
    assert rows(stored.select("key")) == [(i,) for i in range(0, 40_000, 2)]
    # A null and text keys are looked for in the buckets they are in.
    nulls = str(tmp_path / "n")
    store.replace_dataset(plain.select("n", "k").where("k < 9"), nulls, ["n"])
    merged = store.merge_counted(spark, nulls, spark.createDataFrame([(None, 70), (4, 70), (50, 70)], "n int, k int"), ["n"], ["k"])
    assert (merged.added, merged.changed, merged.equal) == (1, 2, 0)
    assert rows(merged.rows) == [(None, 70), (1, 1), (2, 2), (4, 70), (5, 5), (7, 7), (8, 8), (50, 70)]


def test_stored_rows_stay_where_they_are_read(spark, rows, tmp_path, monkeypatch):
    # More rows in a file than a bitmap holds, a key stored twice, null keys.
    stored = spark.range(90_000).selectExpr("if(id % 30000 = 5, null, id div if(id < 4, 2, 1)) as k", "id as n")
    delta = spark.range(0, 100_000, 7).selectExpr("if(id = 7, null, id) as k", "-id as n")
    expected = None
    for name, files in (("places", 8), ("dealt", 0)):
        path = str(tmp_path / name)
        monkeypatch.setattr(store, "FILES_PER_BUCKET", files)
        store.replace_dataset(stored.coalesce(1), path, ["k"], 2)
        merged = store.merge_counted(spark, path, delta, ["k"], ["n"])
        got = merged.rows.agg(F.count("*"), F.count("k"), F.sum("k"), F.sum("n"), F.sum(F.hash("k", "n"))).first()
        assert expected in (None, got) and got[0] - got[1] == 1
        expected = got
        assert (merged.added, merged.changed + merged.equal) == (1428, 12858)
        assert rows(merged.rows.where("k < 9")) == [(0, 0), (1, 2), (1, 3), (4, 4), (6, 6), (7, 7), (8, 8)]


def test_a_merge_broadcasts_by_measured_size(spark, tmp_path, monkeypatch):
    name, plans, compared = "spark.sql.autoBroadcastJoinThreshold", [], store._compared

    def seen(*args):
        df = compared(*args)
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    def merge(stored, path):
        came = spark.range(500, 1500).selectExpr("id as k", "1 as n")
        store.replace_dataset(spark.range(stored).selectExpr("id as k", "0 as n"), f"{path}/kept", ["k"], 2)
        came = store.replace_dataset(store.deal(came, ["k"], 2), f"{path}/came", ["k"], 2, dealt=True)
        merged = store.merge_counted(spark, f"{path}/kept", came, ["k"], ["n"], 2, latest=True)
        assert spark.conf.get(name) == "4m" and spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) is None
        return merged.added, merged.changed, merged.rows.count()

    monkeypatch.setattr(store, "_compared", seen)
    spark.conf.set(name, "4m")
    try:
        # Digests of 100,000 rows are larger than 4 MB, their compressed files are not.
        assert merge(100_000, str(tmp_path / "many")) == (0, 1000, 100_000)
        assert merge(1000, str(tmp_path / "few")) == (500, 500, 1500)
    finally:
        spark.conf.unset(name)
    assert ["BroadcastHashJoin" in plan for plan in plans] == [False, True]


def test_state(spark, rows, tmp_path):
    directory = str(tmp_path / "state")
    empty = state.load_state(spark, directory)
    assert empty["marks"].count() == 0 and empty["seen"].columns == ["dataset", "id", "last_activity"]
    seen = state.seen_from(spark.createDataFrame([(1, "t"), (2, None)], "id int, dateLastActivity string"), "submissions")
    state.commit_state(spark, directory, {"all": "2024-01-01 00:00:00", "stats": None}, seen)
    loaded = state.load_state(spark, directory)
    assert rows(loaded["marks"]) == [("all", "2024-01-01 00:00:00")]
    assert rows(state.seen_of(loaded["seen"], "submissions")) == [(1, "t"), (2, None)]
    assert state.mark_of(loaded["marks"], "stats") is None
    for part in (tmp_path / "state" / "marks" / "data").rglob("*.parquet"):
        part.write_bytes(b"garbage")
    for crc in (tmp_path / "state" / "marks" / "data").rglob(".*.crc"):
        crc.write_bytes(b"")
    assert state.load_state(spark, directory)["marks"].count() == 0


def test_write_tables(spark, tmp_path):
    table = spark.createDataFrame(
        [(2, "x", dt.datetime(2024, 1, 1, 9)), (1, 'q"', None), (None, "n", None)], "submission_id bigint, decision string, date_decided timestamp_ntz"
    )
    specs_by_name = {"decisions": specs.DECISIONS}
    paths = sinks.write_tables({"decisions": table}, specs_by_name, str(tmp_path), "csv")
    text = "".join(p.read_text() for p in sorted((tmp_path / "decisions").glob("part-*.csv")))
    assert [line for line in text.splitlines() if not line.startswith("submission_id")] == [
        ",n,", '1,"q""",', "2,x,2024-01-01T09:00:00.000000",
    ]
    sinks.write_tables({"decisions": table}, specs_by_name, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p" / "decisions")).count() == 3
    assert paths == {"decisions": f"{tmp_path}/decisions"}
    with pytest.raises(OptionError):
        sinks.write_tables({}, {}, str(tmp_path), "xml")
    order = [c._jc.toString() for c in sinks.sort_columns(specs.PUBLICATIONS, specs.PUBLICATIONS.names())]
    assert order == ["date_published DESC NULLS FIRST", "submission_id ASC NULLS FIRST"]


def test_last_means_the_order_of_file_names(spark, rows, tmp_path):
    """The newer file is the larger one, which Spark plans first."""
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-1.json").write_text('{"id": 1, "name": "old"}\n{"id": 2, "name": "only"}\n')
    (folder / "part-2.json").write_text("".join(f'{{"id": {i}, "name": "new"}}\n' for i in [1, *range(10, 500)]))
    read = records.read_records(spark, str(folder), ITEM, multiline=False)
    latest = joins.last_wins(read, ["id"], ["_seq"])
    assert rows(latest.where("id <= 2"), "id", "name") == [(1, "new"), (2, "only")]
    with pytest.raises(OptionError):
        joins.last_wins(read, ["id"], [])


def test_a_page_in_a_folder_with_a_space_is_refused(spark, tmp_path):
    folder = tmp_path / "my down+loads %41"
    folder.mkdir()
    (folder / "a.csv").write_text("<html>")
    (folder / "aa.csv").write_text("x,y\n1,2\n")
    paths = [str(folder / "a.csv"), str(folder / "aa.csv")]
    assert reports.accepted_reports(spark, paths) == ([paths[1]], [paths[0]])


def test_a_storage_that_fails_is_not_an_empty_state(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise state.PySparkException("Connection timed out")

    monkeypatch.setattr(state.store, "read", broken)
    with pytest.raises(state.PySparkException):
        state.load_state(spark, str(tmp_path / "s"))


def test_a_merge_counts_and_leaves_equal_rows_alone(spark, tmp_path):
    path = str(tmp_path / "d")
    stored = spark.range(64).selectExpr("id", "cast(null as string) as v", "named_struct('a', id, 'b', cast(null as int)) as s")
    store.replace_dataset(stored, path, ["id"])
    before = store.layout(spark, path)
    again = store.merge_counted(spark, path, stored, ["id"], ["id"])
    assert (again.added, again.changed, again.equal) == (0, 0, 64)
    assert store.layout(spark, path) == before, "nothing is written"
    # A null and another column's value are told apart; a narrower number is the same value.
    delta = stored.where("id < 2").selectExpr("cast(id as int) id", "case when id = 1 then '' end as v", "s").unionByName(spark.createDataFrame([(900, "x", (1, 2))], "id int, v string, s struct<a:bigint,b:int>"))
    merged = store.merge_counted(spark, path, delta, ["id"], ["v"])
    assert (merged.added, merged.changed, merged.equal) == (1, 1, 1)
    after = store.layout(spark, path)
    assert 1 <= sum(before.dirs.get(b) != d for b, d in after.dirs.items()) <= 2
    assert merged.rows.count() == 65 and merged.rows.schema["id"].dataType.typeName() == "long"
    wider = stored.where("id = 5").withColumn("more", F.lit(None).cast("int"))
    assert store.merge_counted(spark, path, wider, ["id"], ["v"]).changed == 1


def test_copies_of_a_stored_key_collapse_and_count_as_a_change(spark, tmp_path):
    path = str(tmp_path / "d")
    store.replace_dataset(spark.createDataFrame([(1, "a"), (1, "a"), (None, "n")], "id int, v string"), path, ["id"])
    merged = store.merge_counted(spark, path, spark.createDataFrame([(1, "a"), (None, "n")], "id int, v string"), ["id"], ["v"])
    assert (merged.changed, merged.equal, merged.rows.count()) == (1, 1, 2)


def test_buckets_follow_the_rows_and_are_recorded(spark, tmp_path):
    assert [store.buckets_for(n) for n in (0, 1 << 20, 17 << 20, 1 << 30)] == [16, 16, 32, 1024]
    path = str(tmp_path / "d")
    store.replace_dataset(spark.range(100), path, ["id"], buckets=32)
    assert store.recorded_buckets(store.layout(spark, path)) == 32
    assert store.merge_dataset(spark, path, spark.range(90, 110), ["id"], ["id"]).count() == 110


def test_vacuum_keeps_the_last_versions(spark, rows, tmp_path):
    path = str(tmp_path / "d")
    assert store.vacuum(spark, path) == 0
    store.replace_dataset(spark.range(40).selectExpr("id", "0 as v"), path, ["id"], buckets=4)
    for v in (1, 2, 3):
        store.merge_dataset(spark, path, spark.createDataFrame([(7, v)], "id bigint, v int"), ["id"], ["v"])
    previous = {d for d in spark.read.schema(store.POINTER_SCHEMA).json(f"{path}/pointer/v=3").select("dir").toPandas()["dir"]}
    (tmp_path / "d" / "data" / "lost").mkdir()
    assert store.vacuum(spark, path, keep=2) == 2
    assert all((tmp_path / "d" / d).is_dir() for d in previous), "the version before is still whole"
    assert sorted(p.name for p in (tmp_path / "d" / "pointer").iterdir()) == ["v=3", "v=4"]
    assert (tmp_path / "d" / "data" / "lost").is_dir(), "it may be a writer's"
    assert store.vacuum(spark, path, keep=1, lost_after_hours=-1) == 2
    assert not (tmp_path / "d" / "data" / "lost").exists()
    assert rows(store.read(spark, path).where("v > 0")) == [(7, 3)] and store.read(spark, path).count() == 40
    with pytest.raises(OptionError):
        store.vacuum(spark, path, keep=0)


KEYS = ["_submission_id", "interval", "date", "kind"]


def point_rows(spark, values):
    return spark.createDataFrame([(i, d, v, k, n) for i, d, v, k, n in values], "_submission_id bigint, date string, value bigint, kind string, interval string")


def files_of(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet") if timeline.PENDING not in str(p)}


def test_a_window_leaves_the_files_of_other_days(spark, rows, tmp_path):
    path, folder = str(tmp_path / "t"), tmp_path / "t"
    assert timeline.read_points(spark, path) is None
    first = point_rows(spark, [(i, f"2024-06-{d:02d}", 1, "a", "day") for i in (1, 2) for d in range(1, 11)] + [(1, "2024-06", 9, "a", "month"), (3, None, 4, "a", "day")])
    assert timeline.merge_points(spark, path, first, KEYS, ["value"]).count() == 22
    before = files_of(folder)
    late = point_rows(spark, [(1, "2024-06-10", 5, "a", "day"), (1, "2024-06-10", 6, "a", "day"), (9, "2024-06-11", 7, "a", "day"), (3, None, 8, "a", "day")])
    merged = timeline.merge_points(spark, path, late, KEYS, ["value"])
    assert rows(merged.where("value > 1"), "_submission_id", "date", "value") == [(1, "2024-06", 9), (1, "2024-06-10", 6), (3, None, 8), (9, "2024-06-11", 7)]
    assert merged.count() == 23 and merged.schema["date"].dataType.typeName() == "string"
    gone = before - files_of(folder)
    assert gone and all("date=2024-06-10" in f or "date=__HIVE" in f for f in gone)
    assert timeline.merge_points(spark, path, late.limit(0), KEYS, ["value"]).count() == 23


def test_a_read_of_days_reads_only_their_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    timeline.replace_points(point_rows(spark, [(1, f"2024-06-{d:02d}", 1, "a", "day") for d in range(1, 11)]), path)
    few = timeline.read_points(spark, path).where(timeline.in_periods([("day", "2024-06-03"), ("day", "2024-06-04")]))
    assert few.count() == 2 and len(few.inputFiles()) >= 2
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert few.select(F.input_file_name()).distinct().count() == 2


def test_an_interrupted_exchange_of_days_is_finished(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    timeline.replace_points(point_rows(spark, [(1, "2024-06-01", 1, "a", "day"), (1, "2024-06-02", 1, "a", "day")]), path)
    exchange = timeline._exchange

    def dies(*_):
        raise RuntimeError("lost")

    late = point_rows(spark, [(1, "2024-06-02", 5, "a", "day")])
    monkeypatch.setattr(timeline, "_exchange", dies)
    with pytest.raises(RuntimeError):
        timeline.merge_points(spark, path, late, KEYS, ["value"])
    assert rows(timeline.read_points(spark, path), "date", "value") == [("2024-06-01", 1), ("2024-06-02", 1)]
    monkeypatch.setattr(timeline, "_exchange", exchange)
    assert timeline.recover(spark, path) and not timeline.recover(spark, path)
    assert rows(timeline.read_points(spark, path), "date", "value") == [("2024-06-01", 1), ("2024-06-02", 5)]


def test_a_timeline_needs_its_periods(spark, tmp_path):
    points = point_rows(spark, [(1, "2024-06-01", 1, "a", "day")])
    with pytest.raises(OptionError):
        timeline.merge_points(spark, str(tmp_path / "t"), points, ["_submission_id"], ["value"])
    with pytest.raises(OptionError):
        timeline.replace_points(points.drop("date"), str(tmp_path / "t"))
    assert timeline.replace_points(points.limit(0), str(tmp_path / "e")).count() == 0


def csv_cell(rng):
    return "".join(rng.choice(['"', "\n", "\r\n", ",", "a", "é", " ", "x y", ""]) for _ in range(rng.randint(0, 5)))


def quoted_cell(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\n\r') else text


@pytest.mark.parametrize("block, ends", [(3, "\n"), (7, "\r\n"), (16, "\n"), (41, "\n"), (1 << 20, "\r\n")])
def test_csv_by_blocks_equals_the_read_of_whole_files(spark, tmp_path, block, ends):
    import random

    rng = random.Random(block)
    for name in ("a", "b"):
        # The read of whole files guesses the line ends from the first one it meets.
        body = [["id", "two\nlines" if ends == "\n" else "one line", 'with "quotes"'], *([f"{name}{i}", csv_cell(rng), csv_cell(rng)] for i in range(25))]
        text = ends.join(",".join(map(quoted_cell, cells)) for cells in body)
        (tmp_path / f"r-{name}.csv").write_bytes((b"\xef\xbb\xbf" if name == "a" else b"") + text.encode() + (ends.encode() * (2 if ends == "\n" else 1) if name == "b" else b"") + (b"z,\xff\xfe,q" if name == "b" else b""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        want = reports.read_report_csv(spark, f"{tmp_path}/r-*.csv")
        got = reports.read_report_csv(spark, f"{tmp_path}/r-*.csv", by_blocks=True)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_empty_export_by_blocks(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id,name\n")
    got = reports.read_report_csv(spark, str(tmp_path / "r.csv"), by_blocks=True)
    assert got.columns == ["id", "name"] and got.collect() == []
