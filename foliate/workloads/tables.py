"""The table pipelines over datasets derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.operators.filters import date_window, of_interval
from foliate.plans import api
from foliate.plans.reviews import normalize_reviews
from foliate.workloads import records
from foliate.workloads.registry import query


def _submissions(spark, sf_dir):
    return api.normalize_submissions(
        records.submissions(spark, sf_dir), records.publications(spark, sf_dir), records.submissions_ext(spark, sf_dir)
    )


@query("submissions_like", f"WITH {records.SUBMISSIONS_SQL} SELECT * FROM submissions")
def submissions_like(spark, sf_dir):
    return _submissions(spark, sf_dir)


PUBLISHED_SQL = f"""
WITH {records.SUBMISSIONS_SQL},
versions_published AS (SELECT * FROM lineitem WHERE l_linestatus = 'F')"""


@query(
    "publications_table",
    f"""{PUBLISHED_SQL}
SELECT s.submission_id, v.l_orderkey * 10 + v.l_linenumber AS publication_id, date_published, title, 'Sub ' || v.l_partkey AS subtitle,
       CASE WHEN v.l_returnflag <> 'N' THEN v.l_returnflag END AS authors_string, author_count, doi, url, issue_id, submission_type,
       v.l_partkey || '-' || v.l_suppkey AS pages, CAST(v.l_linenumber AS BIGINT) AS seq, CAST(v.l_linenumber AS BIGINT) AS version,
       'en_US' AS locale, CAST(NULL AS VARCHAR) AS license_url, 'Holder ' || v.l_suppkey AS copyright_holder, year(v.l_shipdate) AS copyright_year,
       CAST(CASE WHEN v.l_returnflag = 'N' THEN 0 ELSE 2 END AS BIGINT) AS galley_count, keywords, abstract, author_name, author_email, date_submitted
FROM submissions s JOIN versions_published v ON v.l_orderkey = s.submission_id WHERE status = 'Published'""",
)
def publications_table(spark, sf_dir):
    return api.normalize_publications(_submissions(spark, sf_dir), records.publications(spark, sf_dir))


@query(
    "publications_lost",
    """
SELECT count(*) AS lost FROM orders WHERE o_orderstatus = 'F'
 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'F')""",
)
def publications_lost(spark, sf_dir):
    return api.publications_with_loss(_submissions(spark, sf_dir), records.publications(spark, sf_dir))[1]


@query(
    "authors_table",
    f"""
WITH {records.USERS_SQL},
single AS (SELECT email, min(id) AS user_id FROM accounts WHERE email IS NOT NULL GROUP BY email HAVING count(DISTINCT id) = 1),
authors AS (
  SELECT l_orderkey AS submission_id, CAST(2 AS BIGINT) AS author_number, 'Given ' || l_partkey AS given_name, 'Part ' || l_partkey AS family_name,
         CASE WHEN l_returnflag = 'A' THEN '0000-' || l_partkey END AS orcid_id, CASE WHEN l_returnflag <> 'A' THEN 'NO' END AS country,
         CAST(NULL AS VARCHAR) AS affiliation, 'c' || l_partkey || '@example.org' AS email
  FROM lineitem WHERE l_linenumber <> 7
  UNION ALL
  SELECT l_orderkey, 1, NULL, 'Supplier ' || l_suppkey, NULL, NULL, 'Plant ' || l_suppkey,
         CASE WHEN l_returnflag = 'A' THEN 'desk' || (l_suppkey % 25) || '@example.org' END
  FROM lineitem WHERE l_linenumber <> 7
)
SELECT authors.*, user_id FROM authors LEFT JOIN single ON single.email = authors.email""",
)
def authors_table(spark, sf_dir):
    return api.normalize_authors(records.publications(spark, sf_dir), records.users(spark, sf_dir))


@query("review_assignments_table", f"WITH {records.ASSIGNMENTS_SQL} SELECT * FROM assignments")
def review_assignments_table(spark, sf_dir):
    return api.normalize_review_assignments(records.submissions_ext(spark, sf_dir))


@query(
    "users_table",
    f"""
WITH {records.USERS_SQL},
details AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT id AS user_id, c_name AS username, email, c_name AS full_name, CAST(NULL AS VARCHAR) AS orcid, disabled,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS country,
       CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE 'Dept ' || o_orderpriority END AS affiliation,
       o_orderdate AS date_registered, CAST(NULL AS TIMESTAMP) AS date_last_login,
       CASE WHEN o_orderkey IS NOT NULL THEN TIMESTAMP '2024-06-15 08:30:00' END AS details_fetched_at
FROM accounts LEFT JOIN details ON o_custkey = id AND rn = 1""",
)
def users_table(spark, sf_dir):
    return api.normalize_users(records.users(spark, sf_dir), records.user_details(spark, sf_dir))


@query(
    "user_groups_table",
    """
SELECT c_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS group_id,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Groupe des lecteurs' ELSE 'Group ' || c_nationkey END AS group_name, 'G' AS group_abbrev,
       CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 4096 WHEN 'MACHINERY' THEN 16 ELSE 65536 END AS BIGINT) AS role_id
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
UNION ALL SELECT c_custkey, 99, 'Readers', NULL, 1048576 FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""",
)
def user_groups_table(spark, sf_dir):
    return api.normalize_user_groups(records.users(spark, sf_dir))


@query(
    "submission_files_table",
    f"""
WITH {records.FILES_SQL}
SELECT submission_id, submission_file_id, file_id, file_stage, file_stage_label, review_round_id, CAST(1 AS BIGINT) AS genre_id, name,
       'application/pdf' AS mimetype, 'pdf' AS document_type, uploader_user_id, CAST(NULL AS BIGINT) AS source_submission_file_id,
       CAST(CASE WHEN has_revisions THEN 2 ELSE 0 END AS BIGINT) AS revision_count, created_at, updated_at, url
FROM files""",
)
def submission_files_table(spark, sf_dir):
    return api.normalize_submission_files(records.submission_files(spark, sf_dir))


@query(
    "publication_stats_table",
    """
SELECT p_partkey AS submission_id, CAST(p_size AS BIGINT) AS abstract_views, CAST(p_size * 2 AS BIGINT) AS galley_views,
       CAST(p_size AS BIGINT) AS pdf_views, CAST(0 AS BIGINT) AS html_views, CAST(NULL AS BIGINT) AS other_views
FROM part WHERE p_type <> 'PROMO'""",
)
def publication_stats_table(spark, sf_dir):
    return api.normalize_publication_stats(records.publication_stats(spark, sf_dir))


POINTS_SQL = """
points AS (
  SELECT user_id AS submission_id, strftime(ts, '%Y-%m-%d') AS date, 'day' AS interval, count(*) AS views,
         CASE event_type WHEN 'view' THEN 'abstract' ELSE 'galley' END AS kind
  FROM events WHERE event_type IN ('view', 'click') GROUP BY ALL
)"""


@query("views_timeline", f"WITH {POINTS_SQL} SELECT * FROM points")
def views_timeline(spark, sf_dir):
    return api.normalize_views_timeline(records.views_timeline(spark, sf_dir))


@query(
    "views_window",
    f"WITH {POINTS_SQL} SELECT * FROM points WHERE date BETWEEN '2024-01-05' AND '2024-01-20'",
)
def views_window(spark, sf_dir):
    points = records.views_timeline(spark, sf_dir).unionByName(
        records.views_timeline(spark, sf_dir, "yyyy-MM", "month")
    )
    return api.normalize_views_timeline(date_window(of_interval(points, "day"), "date", "2024-01-05", "2024-01-20"))


@query(
    "timeline_totals",
    f"WITH {POINTS_SQL} SELECT interval, date, kind, CAST(sum(views) AS BIGINT) AS views FROM points GROUP BY ALL",
)
def timeline_totals(spark, sf_dir):
    return api.timeline_rollup(api.normalize_views_timeline(records.views_timeline(spark, sf_dir)))


@query(
    "views_timeline_totals_table",
    """
SELECT strftime(ts, '%Y-%m-%d') AS date, 'day' AS interval, count(*) FILTER (event_type = 'view') AS views, 'abstract' AS kind FROM events GROUP BY ALL
UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'day', count(*) FILTER (event_type = 'click'), 'galley' FROM events GROUP BY ALL""",
)
def views_timeline_totals_table(spark, sf_dir):
    return api.normalize_views_timeline_totals(records.timeline_totals(spark, sf_dir))


@query(
    "reviews_table",
    """
SELECT event_id AS submission_id, CAST(hour(ts) AS BIGINT) AS round, 'rev' || user_id AS username, 'Rae' AS given_name,
       CASE WHEN event_type = 'click' THEN date_trunc('second', ts) END AS date_assigned,
       CAST(NULL AS BIGINT) AS response_overdue_days, CASE WHEN event_type <> 'error' THEN CAST(minute(ts) AS BIGINT) END AS review_overdue_days,
       CASE WHEN event_type = 'purchase' THEN true WHEN event_type <> 'signup' THEN false END AS declined,
       'Good & ' || event_type || chr(10) || chr(10) || props AS comments
FROM events""",
)
def reviews_table(spark, sf_dir):
    return normalize_reviews(records.reviews_export(spark, sf_dir))["reviews"]


@query(
    "details_by_role",
    """
SELECT o_custkey AS user_id, count(*) AS n_details FROM orders JOIN customer ON c_custkey = o_custkey
WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY o_custkey""",
)
def details_by_role(spark, sf_dir):
    from foliate.functions.nested import any_child_in
    from foliate.operators.joins import rows_of_ids

    chosen = records.users(spark, sf_dir).where(any_child_in(F.col("groups"), "roleId", [4096, 16]))
    details = rows_of_ids(records.user_details(spark, sf_dir), "id", chosen, "id")
    return details.groupBy(F.col("id").alias("user_id")).agg(F.count(F.lit(1)).alias("n_details"))
