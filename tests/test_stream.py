"""All datasets of a landing folder through one streaming query, and landed pages."""

import json

import pytest
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from foliate.plans import jobs, landing
from foliate.sources import records, state, store, timeline
from foliate.streaming.sync_stream import merge_batch, sync_landing

AT = "2024-06-{:02d} 08:30:00"


def land(folder, name, part, items, as_page=False):
    (folder / name).mkdir(parents=True, exist_ok=True)
    text = json.dumps({"items": items, "itemsMax": len(items)}) if as_page else "".join(json.dumps(i) + "\n" for i in items)
    (folder / name / f"{part}.json").write_text(text)


def article(i, day, **more):
    return {"id": i, "dateLastActivity": day and AT.format(day), **more}


def metrics(df):
    return {(r["dataset"], r["metric"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("pages", [False, True])
def test_a_batch_that_failed_before_its_commit_is_repeated(spark, rows, tmp_path, pages):
    folder, target, checkpoint = tmp_path / "landing", str(tmp_path / "target"), str(tmp_path / "checkpoint")
    calls = []

    def run(before_commit=None):
        clock = lambda batch: calls.append(batch) or AT.format(20 + len(calls))
        sync_landing(spark, str(folder), target, checkpoint, pages=pages, clock=clock, before_commit=before_commit, files=True, user_details=True).awaitTermination()

    land(folder, "submissions", "a", [article(1, 1, statusLabel="one"), article(2, 15, statusLabel="two")], pages)
    land(folder, "_submissions", "a", [article(1, 1)], pages)
    land(folder, "publications", "a", [{"_submission_id": i, "id": i, "version": 1} for i in (1, 2)], pages)
    land(folder, "users", "a", [{"id": 7, "groups": [{"id": 1, "roleId": 16}]}, {"id": 8}], pages)
    land(folder, "publication_stats", "a", [{"publication": {"id": 1}}], pages)
    land(folder, "views_timeline", "a", [{"_submission_id": 1, "date": f"2024-06-{d}", "value": 1, "kind": "abstract", "interval": "day"} for d in (10, 15)], pages)
    run()
    marks = state.load_state(spark, f"{target}/state")["marks"]
    assert (state.mark_of(marks, "batch"), state.mark_of(marks, "stats")) == ("0", AT.format(21))
    versions = {n: store.layout(spark, f"{target}/{n}").version for n in ("users", "_submissions")}

    # 1 is older than the mark, 2 is unchanged, 3 is new; no users and no extended records land.
    land(folder, "submissions", "b", [article(1, 2, statusLabel="late"), article(2, 15, statusLabel="two"), article(3, 16, statusLabel="three"), article(3, 16, statusLabel="last")], pages)
    land(folder, "publications", "b", [{"_submission_id": i, "id": i, "version": 2} for i in (1, 2, 3)], pages)
    land(folder, "views_timeline", "b", [{"_submission_id": 1, "date": f"2024-06-{d}", "value": 2, "kind": "abstract", "interval": "day"} for d in (10, 20)], pages)
    land(folder, "user_details", "b", [{"id": 7, "country": "NO"}], pages)

    def fails(batch):
        raise RuntimeError(f"lost before the commit of batch {batch}")

    with pytest.raises(StreamingQueryException):
        run(fails)
    marks = state.load_state(spark, f"{target}/state")["marks"]
    assert state.mark_of(marks, "batch") == "0" and state.mark_of(marks, "all") == AT.format(21)
    run()
    kept = state.load_state(spark, f"{target}/state")
    assert state.mark_of(kept["marks"], "batch") == "1" and state.mark_of(kept["marks"], "all") == AT.format(22), "the time of the first attempt"
    assert rows(store.read(spark, f"{target}/submissions"), "id", "statusLabel") == [(1, "one"), (2, "two"), (3, "last")]
    assert rows(store.read(spark, f"{target}/publications"), "_submission_id", "version") == [(1, 1), (2, 1), (3, 2)]
    assert rows(timeline.read_points(spark, f"{target}/views_timeline"), "date", "value") == [("2024-06-10", 1), ("2024-06-15", 1), ("2024-06-20", 2)]
    assert rows(state.seen_of(kept["seen"], "submissions")) == [(1, AT.format(1)), (2, AT.format(15)), (3, AT.format(16))]
    assert versions == {n: store.layout(spark, f"{target}/{n}").version for n in versions}, "what did not land is left alone"
    assert sorted(p.name for p in (tmp_path / "target" / "staged").iterdir()) == ["batch=1"]

    # Committed here, but not in the query's own log: the number says that nothing is left to do.
    again = spark.createDataFrame([(json.dumps([article(9, 28)]), "x", "submissions")], "value string, landed string, dataset string")
    assert metrics(merge_batch(again, 1, target, pages=True)) == {("run", "repeated_batch"): 1}
    assert store.read(spark, f"{target}/submissions").count() == 3


def test_records_come_out_of_pages_one_by_one(spark, rows, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "submissions", "p1", [article(1, 1, statusLabel="a", publications=[{"id": 5, "fullTitle": {"en_US": "T <b>"}}])], True)
    (folder / "submissions" / "p2.json").write_text('\n [{"id": 1, "statusLabel": "b", "publications": "odd"}, {"id": 2, "dateLastActivity": null}]')
    (folder / "submissions" / "p3.json").write_text((folder / "submissions" / "p2.json").read_text())
    (folder / "submissions" / "p4.json").write_text('{"items": null}')
    (folder / "submissions" / "p5.json").write_text("[]")
    read = records.read_pages(spark, str(folder / "submissions"), landing.schema_of("submissions"))
    assert rows(read, "id", "statusLabel") == [(1, "a"), (1, "b"), (2, None)]
    assert read.where("statusLabel = 'a'").select(F.col("publications")[0]["fullTitle"]).first()[0] == '{"en_US":"T <b>"}'
    assert [r["statusLabel"] for r in read.where("id = 1").orderBy("_seq").collect()] == ["a", "b"]
    for name in ("_submissions", "publications", "users"):
        land(folder, name, "p", [{"id": 1, "_submission_id": 1}], True)
    got = metrics(jobs.run_normalize_api(spark, str(folder), str(tmp_path / "out"), pages=True))
    assert got[("users", "rows")] == 1
    for text in ('"x"', "<html>", '{"error": "no"}', ""):
        (folder / "submissions" / "p9.json").write_text(text or " ")
        with pytest.raises(Exception, match="unexpected response shape"):
            records.read_pages(spark, str(folder / "submissions"), landing.schema_of("submissions")).collect()


def test_staged_texts_are_packed(spark, rows, tmp_path):
    target = str(tmp_path / "data")
    texts = [(json.dumps({"id": i, "dateLastActivity": "2024-06-01 00:00:00"}), "2024-06-01 f", "submissions") for i in range(5)]
    merge_batch(spark.createDataFrame(texts, "value string, landed string, dataset string"), 0, target, stats=False)
    assert all(p.name.endswith(f".{store.COMPRESSION}.parquet") for p in (tmp_path / "data" / "staged").rglob("*.parquet") if p.is_file())
    assert rows(store.read(spark, f"{target}/submissions"), "id") == [(i,) for i in range(5)]
