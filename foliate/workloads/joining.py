"""Joins, plans against a manifest, ordering and quality counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliate.operators.downloads import download_plan, download_targets
from foliate.operators.filters import select_files
from foliate.operators.joins import (
    ambiguous_keys,
    files_with_rounds,
    inner_with_loss,
    left_join_last,
    missing_keys,
    rows_of_ids,
    skip_unchanged,
    unambiguous_lookup,
)
from foliate.operators.quality import always_null_report, constant_report, preview, profile
from foliate.operators.ranking import number_rows
from foliate.plans import api, articles, specs
from foliate.plans.jobs import plan_downloads, profile_tables, record_downloads
from foliate.session import ensure_checkpoint_dir
from foliate.sources import store
from foliate.sources.sinks import DOC_SCHEMA, doc_rows, schema_docs
from foliate.workloads import records
from foliate.workloads.registry import ORACLES, query, table
from foliate.workloads.wide import articles_export, decisions_export

EMAILS_SQL = """
accounts AS (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN '' ELSE 'desk' || s_nationkey || '-' || CAST(floor(s_acctbal / 1000) AS BIGINT) || '@example.org' END AS email FROM supplier),
people AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '' WHEN c_mktsegment <> 'MACHINERY'
   THEN 'desk' || c_nationkey || '-' || CAST(floor(c_acctbal / 1000) AS BIGINT) || '@example.org' END AS email FROM customer)"""


def _desk(nation, balance):
    return F.concat(
        F.lit("desk"), nation.cast("string"), F.lit("-"), F.floor(balance / 1000).cast("string"), F.lit("@example.org")
    )


def _accounts(spark, sf_dir):
    desk = _desk(F.col("s_nationkey"), F.col("s_acctbal"))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") < 0, "").otherwise(desk).alias("email")
    )


@query(
    "unambiguous_lookup",
    f"""
WITH {EMAILS_SQL},
single AS (SELECT email, min(s_suppkey) AS suppkey FROM accounts WHERE email <> '' GROUP BY email HAVING count(DISTINCT s_suppkey) = 1)
SELECT c_custkey, people.email, suppkey FROM people LEFT JOIN single ON single.email = people.email""",
)
def unambiguous_lookup_query(spark, sf_dir):
    desk = _desk(F.col("c_nationkey"), F.col("c_acctbal"))
    segment = F.col("c_mktsegment")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(segment == "BUILDING", "").when(segment != "MACHINERY", desk).alias("email")
    )
    return unambiguous_lookup(people, _accounts(spark, sf_dir), "email", "email", "s_suppkey", "suppkey", ["c_custkey"])


@query(
    "ambiguous_keys",
    f"""
WITH {EMAILS_SQL}
SELECT email, count(DISTINCT s_suppkey) AS n_values, min(s_suppkey) AS lowest, max(s_suppkey) AS highest
FROM accounts WHERE email <> '' GROUP BY email HAVING count(DISTINCT s_suppkey) > 1""",
)
def ambiguous_keys_query(spark, sf_dir):
    return ambiguous_keys(_accounts(spark, sf_dir), "email", "s_suppkey")


@query(
    "last_wins_join",
    """
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT c_custkey, c_name, o_orderkey, o_orderdate, o_totalprice FROM customer LEFT JOIN ranked ON o_custkey = c_custkey AND rn = 1""",
)
def last_wins_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return left_join_last(people, orders, "c_custkey", "o_custkey", ["o_orderdate", "o_orderkey"])


def _finished_and_solvent(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice"
    )
    solvent = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_acctbal"
    )
    return inner_with_loss(finished, solvent, "custkey")


@query(
    "inner_with_loss",
    """
SELECT c_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_acctbal
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' AND c_acctbal > 0""",
)
def inner_with_loss_query(spark, sf_dir):
    return _finished_and_solvent(spark, sf_dir)[0]


@query(
    "join_loss",
    """
SELECT count(*) AS lost FROM orders WHERE o_orderstatus = 'F'
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""",
)
def join_loss(spark, sf_dir):
    return _finished_and_solvent(spark, sf_dir)[1]


@query(
    "skip_unchanged",
    """
WITH seen AS (SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'O' THEN o_orderdate - INTERVAL 1 DAY END AS last_activity
              FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders LEFT JOIN seen ON id = o_orderkey
WHERE last_activity IS NULL OR last_activity IS DISTINCT FROM o_orderdate""",
)
def skip_unchanged_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    seen = table(spark, sf_dir, "orders").where("o_orderpriority <> '1-URGENT'").select(
        F.col("o_orderkey").alias("id"),
        F.when(status == "F", date).when(status == "O", date - F.expr("INTERVAL 1 DAY")).alias("last_activity"),
    )
    return skip_unchanged(orders, seen, "o_orderkey", "o_orderdate")


@query(
    "missing_keys",
    "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def missing_keys_query(spark, sf_dir):
    large = table(spark, sf_dir, "orders").where("o_totalprice > 400000")
    return missing_keys(table(spark, sf_dir, "customer").select("c_custkey"), large, "o_custkey")


@query(
    "published_semi",
    """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM lineitem
WHERE l_linenumber IN (4, 15, 5) AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
)
def published_semi(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    review = select_files(lines, group="review", stage_col="l_linenumber")
    return rows_of_ids(review, "l_orderkey", finished, "o_orderkey")


@query(
    "round_join",
    f"""
WITH {records.FILES_SQL}, {records.ASSIGNMENTS_SQL}
SELECT f.submission_id, f.file_id, f.review_round_id, a.assignment_id, a.round, a.status AS assignment_status
FROM files f JOIN assignments a ON a.round_id = f.review_round_id""",
)
def round_join(spark, sf_dir):
    files = api.normalize_submission_files(records.submission_files(spark, sf_dir))
    assignments = api.normalize_review_assignments(records.submissions_ext(spark, sf_dir))
    joined = files_with_rounds(files, assignments)
    return joined.select("submission_id", "file_id", "review_round_id", "assignment_id", "round", "assignment_status")


TARGETS_SQL = f"""
{records.FILES_SQL},
entries AS (
  SELECT *, file_id AS fid, url AS furl, 0 AS place FROM files
  UNION ALL SELECT *, file_id, url || '?again', 1 FROM files WHERE has_revisions
  UNION ALL SELECT *, 1000000 + uploader_user_id, CASE WHEN file_stage <> 11 THEN url || '?old' END, 2 FROM files WHERE has_revisions
),
usable AS (SELECT *, row_number() OVER (PARTITION BY row_id, fid ORDER BY place) AS rn FROM entries WHERE fid <> 0 AND furl <> ''),
targets AS (
  SELECT submission_id, submission_file_id, fid AS file_id, file_stage, file_stage_label AS stage, review_round_id, furl AS url,
         fid || '_' || safe AS filename, submission_id || '/' || file_stage_label || '/' || fid || '_' || safe AS path
  FROM usable WHERE rn = 1
)"""


@query("download_targets", f"WITH {TARGETS_SQL} SELECT * FROM targets")
def download_targets_query(spark, sf_dir):
    return download_targets(records.submission_files(spark, sf_dir))


@query(
    "manifest_plan",
    f"""
WITH {TARGETS_SQL},
manifest AS (
  SELECT p_partkey AS file_id, CASE WHEN p_type = 'SMALL' THEN m.path || '.old' ELSE m.path END AS path
  FROM part JOIN (SELECT file_id, max(path) AS path FROM targets GROUP BY file_id) m ON m.file_id = p_partkey WHERE p_type <> 'LARGE')
SELECT t.*, CASE WHEN m.path <> t.path THEN m.path END AS stale_path
FROM targets t LEFT JOIN manifest m ON m.file_id = t.file_id WHERE m.file_id IS NULL OR m.path <> t.path""",
)
def manifest_plan(spark, sf_dir):
    files = records.submission_files(spark, sf_dir)
    latest = download_targets(files).groupBy("file_id").agg(F.max("path").alias("path"))
    parts = table(spark, sf_dir, "part").where("p_type <> 'LARGE'").select(F.col("p_partkey").alias("file_id"), "p_type")
    recorded = F.when(F.col("p_type") == "SMALL", F.concat("path", F.lit(".old"))).otherwise(F.col("path"))
    manifest = parts.join(latest, "file_id").select("file_id", recorded.alias("path"))
    return download_plan(files, manifest)


@query(
    "download_rounds",
    f"""
WITH {TARGETS_SQL},
manifest AS (SELECT file_id, max(path) AS path FROM targets WHERE file_id % 2 = 0 GROUP BY file_id)
SELECT t.submission_id, t.file_id, t.path, CASE WHEN m.path <> t.path THEN m.path END AS stale_path, CASE WHEN t.file_id % 2 = 1 THEN 'web page' END AS reason
FROM targets t LEFT JOIN manifest m ON m.file_id = t.file_id WHERE m.file_id IS NULL OR m.path <> t.path""",
)
def download_rounds(spark, sf_dir):
    """A plan, what came of it written down, and the plan after that, with the reason why a file is still due."""
    folder = f"{ensure_checkpoint_dir(spark)}/downloads-{uuid.uuid4()}"
    # A projection of a stored table, which both plans read.
    files = records.submission_files(spark, sf_dir)
    first = plan_downloads(spark, files, folder)
    record_downloads(spark, folder, first.select("file_id", "path", F.when(F.col("file_id") % 2 == 1, "web page").alias("reason")))
    refused = store.read(spark, f"{folder}/refused").select(F.col("file_id").alias("__refused"), "reason")
    second = plan_downloads(spark, files, folder)
    due = second.join(refused, F.col("file_id") == F.col("__refused"), "left")
    return due.select("submission_id", "file_id", "path", "stale_path", "reason")


@query(
    "newest_first",
    """
WITH dated AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS date_published FROM orders)
SELECT o_orderkey, date_published, row_number() OVER (ORDER BY date_published DESC NULLS FIRST, o_orderkey) AS place FROM dated""",
)
def newest_first(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("date_published")
    )
    order = [F.col("date_published").desc_nulls_first(), F.col("o_orderkey").asc()]
    return number_rows(dated, [], order, "place")


@query(
    "preview",
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 3",
)
def preview_query(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey")
    return preview(orders, ["o_orderkey", "o_orderdate", "no_such_column", "o_totalprice"])


CHECKED_SQL = """
checked AS (SELECT d.*, quality, toxic, CASE WHEN toxic = 1 THEN lang END AS rights FROM documents d LEFT JOIN labels USING (doc_id))"""


def _checked(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.withColumn("rights", F.when(F.col("toxic") == 1, F.col("lang")))


@query(
    "quality_checks",
    f"""
WITH {CHECKED_SQL}
SELECT 'rights' AS "column", count(rights) AS non_null FROM checked UNION ALL SELECT 'quality', count(quality) FROM checked""",
)
def quality_checks(spark, sf_dir):
    return always_null_report(_checked(spark, sf_dir), ["rights", "quality", "absent"])


@query(
    "constant_checks",
    f"""
WITH {CHECKED_SQL}
SELECT 'lang' AS "column", count(lang) AS non_null, count(*) FILTER (lang <> 'en') AS unexpected, min(lang) AS lowest, max(lang) AS highest FROM checked
UNION ALL SELECT 'quality', count(quality), count(*) FILTER (quality <> 1), min(CAST(quality AS VARCHAR)), max(CAST(quality AS VARCHAR)) FROM checked""",
)
def constant_checks(spark, sf_dir):
    return constant_report(_checked(spark, sf_dir), {"lang": "en", "quality": "1"})


PROFILED = ("doc_id", "lang", "source", "quality", "rights")


@query(
    "column_profile",
    f"WITH {CHECKED_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS distinct_values FROM checked"""
        for c in PROFILED
    ),
)
def column_profile(spark, sf_dir):
    return profile(_checked(spark, sf_dir), PROFILED)


# The columns each table of the wide exports holds; declared columns that an export lacks have no counts.
COUNTED = {
    "submissions": ("article_submissions", "submission_id author_name author_email author_count title submission_type status date_submitted last_modified"),
    "authors": ("article_authors", "submission_id author_number family_name email bio_statement"),
    "editors": ("article_editors", "submission_id editor_number family_name"),
    "decisions": ("article_decisions", "submission_id editor_number decision_number decision date_decided"),
}


def _schema_docs_sql() -> str:
    """The declared documentation as rows, joined with the counts over the SQL of each table."""
    literals = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in doc_rows(specs.ARTICLE_TABLES))
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS distinct_values FROM ({ORACLES[of]})"
        for name, (of, columns) in COUNTED.items()
        for c in columns.split()
    )
    names = ", ".join(part.split()[0] for part in DOC_SCHEMA.split(", "))
    return f"SELECT * FROM (VALUES {literals}) AS docs({names}) LEFT JOIN ({counts}) USING (table_name, column_name)"


@query("schema_docs", _schema_docs_sql())
def schema_docs_query(spark, sf_dir):
    """The documentation of the wide-report tables beside the counts of their columns."""
    export = articles_export(spark, sf_dir)
    tables = {
        "submissions": articles.extract_submissions_table(export),
        "authors": articles.extract_authors_table(export),
        "editors": articles.extract_editors_table(export),
        "decisions": articles.extract_decisions_table(decisions_export(spark, sf_dir)),
    }
    return schema_docs(spark, specs.ARTICLE_TABLES, profile_tables(tables))
