"""Every named query against its SQL, on the smallest tables."""

import glob
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracles import compare, connect  # noqa: E402

import __spark_entry__ as entry_points  # noqa: E402
from foliate.workloads import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(QUERIES) == set(ORACLES)
    assert entry_points.entry(spark).columns[0] == "submission_id"


def test_download_rounds_write_no_copy_of_the_files(spark):
    QUERIES["download_rounds"](spark, SF_DIR)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert glob.glob(f"{folder}/downloads-*/plan") and not glob.glob(f"{folder}/downloads-*/landed")
