"""Profiles kept beside a stored dataset."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from foliate.errors import MissingDataError
from foliate.sources import profiles, store

SCHEMA = "id bigint, word string, day date, tags array<string>, more map<string, int>, none string"


def stored(spark, n):
    return spark.range(n).selectExpr(
        "id", "concat('w', id % 700) AS word", "date_add(date'2024-01-01', cast(id % 30 AS int)) AS day",
        "IF(id % 4 = 0, NULL, array(cast(id % 5 AS string))) AS tags", "map('k', cast(id % 3 AS int)) AS more", "cast(NULL AS string) AS none"
    )


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def within(estimate, exact):
    return abs(estimate - exact) <= profiles.DISTINCT_ERROR * exact


def test_a_profile_counts_like_the_rows(spark, tmp_path):
    path = f"{tmp_path}/d"
    store.replace_dataset(stored(spark, 20_000), path, ["id"])
    got, exact = by_column(profiles.dataset_profile(spark, path)), by_column(profiles.dataset_profile(spark, path, exact=True))
    assert {c: (r["rows"], r["nulls"]) for c, r in got.items()} == {"id": (20_000, 0), "word": (20_000, 0), "day": (20_000, 0), "tags": (20_000, 5_000), "more": (20_000, 0), "none": (20_000, 20_000)}
    assert {c: r["distinct_values"] for c, r in exact.items()} == {"id": 20_000, "word": 700, "day": 30, "tags": 5, "more": 3, "none": 0}
    assert all(within(got[c]["distinct_values"], r["distinct_values"]) for c, r in exact.items())
    assert (got["day"]["lowest"], got["day"]["highest"], got["none"]["lowest"]) == ("2024-01-01", "2024-01-30", None)


def test_a_later_profile_reads_only_rewritten_buckets(spark, tmp_path):
    path = f"{tmp_path}/d"
    store.replace_dataset(stored(spark, 5_000).select("id", "word"), path, ["id"])
    assert profiles.refresh(spark, path) == store.BUCKETS
    assert profiles.refresh(spark, path) == 0
    store.merge_dataset(spark, path, spark.createDataFrame([(7, "zz", 1)], "id bigint, word string, at int"), ["id"], ["at"])
    assert profiles.refresh(spark, path) == 1
    got = by_column(profiles.dataset_profile(spark, path))
    assert got["word"]["highest"] == "zz" and got["word"]["rows"] == 5_000
    store.merge_dataset(spark, path, spark.createDataFrame([(7, "w7", 2)], "id bigint, word string, at int"), ["id"], ["at"])
    # A value that left the dataset leaves the profile.
    assert by_column(profiles.dataset_profile(spark, path))["word"]["highest"] == "w99"


def test_an_unfinished_profile_is_not_read_and_old_ones_go(spark, tmp_path):
    path = f"{tmp_path}/d"
    store.replace_dataset(stored(spark, 100).select("id"), path, ["id"])
    before = by_column(profiles.dataset_profile(spark, path))
    # The same directories once more, and a folder that a dead run left.
    first = next((tmp_path / "d" / "profile").iterdir()).name
    spark.read.parquet(f"{path}/profile/{first}").write.parquet(f"{path}/profile/again")
    (tmp_path / "d" / "profile" / "dead").mkdir()
    assert by_column(profiles.dataset_profile(spark, path)) == before
    assert profiles.vacuum(spark, path) == 3 and profiles.vacuum(spark, path) == 0
    assert profiles.refresh(spark, path) == 0 and by_column(profiles.dataset_profile(spark, path)) == before


def test_datasets_without_keys_and_without_rows(spark, tmp_path):
    with pytest.raises(MissingDataError):
        profiles.dataset_profile(spark, f"{tmp_path}/none")
    plain = f"{tmp_path}/a folder"
    store.replace_dataset(spark.createDataFrame([(dt.date(2024, 1, 2),), (None,)], "a date").withColumn("b.c", F.lit(1.5)), plain)
    got = by_column(profiles.dataset_profile(spark, plain))
    assert (got["a"]["rows"], got["a"]["nulls"], got["a"]["lowest"]) == (2, 1, "2024-01-02")
    assert (got["b.c"]["lowest"], got["b.c"]["distinct_values"]) == ("1.5", 1)
    empty = f"{tmp_path}/empty"
    store.replace_dataset(stored(spark, 0), empty, ["id"])
    assert profiles.dataset_profile(spark, empty).count() == 0


def test_expected_values_come_from_the_profile(spark, tmp_path):
    path = f"{tmp_path}/d"
    rows = [(1, "en", "1", None, "x"), (2, "en", "2", None, None)]
    store.replace_dataset(spark.createDataFrame(rows, "id int, lang string, grade string, empty string, full string"), path, ["id"])
    found = profiles.expected_values(profiles.dataset_profile(spark, path), ["empty", "full", "absent"], {"lang": "en", "grade": "1"})
    assert sorted((r["column"], r["non_null"], r["holds"]) for r in found.collect()) == [("empty", 0, True), ("full", 1, False), ("grade", 2, False), ("lang", 2, True)]
