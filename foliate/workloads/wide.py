"""Wide exports derived from the given tables, and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.operators.reshape import (
    DECISION_HEADER,
    diagonal_union,
    numbered_count,
    tag_series,
    unpivot_numbered,
    unpivot_two_index,
)
from foliate.plans import articles
from foliate.schema import quoted
from foliate.workloads.registry import query, table

def _values(df, column):
    """The distinct values of a column that becomes headers: one small aggregate."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def articles_export(spark, sf_dir):
    """One wide row per order: its lines as author blocks, then the literal report columns.

    The pivot is a plain conditional aggregation, combined map-side; the blocks are
    the line numbers there are.
    """
    lines = table(spark, sf_dir, "lineitem")
    numbers = _values(lines, "l_linenumber")

    def block(base, value, label="Author"):
        return [
            F.max(F.when(F.col("l_linenumber") == n, value)).alias(f"{base} ({label} {n})") for n in numbers
        ]

    part = F.concat(F.lit("Part "), F.col("l_partkey").cast("string"))
    email = F.when(F.col("l_returnflag") != "N", F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit("@example.org"))).otherwise("")
    editor = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")))
    wide = lines.groupBy("l_orderkey").agg(
        *block("Family Name", F.when(F.col("l_returnflag") == "R", "").otherwise(part)),
        *block("Email", email),
        *block("Bio Statement (e.g., department and rank)", F.when(F.col("l_returnflag") == "A", F.col("l_linestatus"))),
        *block("Family Name", editor, "Editor"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Submission ID"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("Title"),
        F.lit("en_US").alias("Language"),
        F.when(F.col("o_orderstatus") == "P", "odd").alias("Rights"),
        F.col("o_orderpriority").alias("Section title"),
        F.col("o_orderstatus").alias("Status"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Date submitted"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Last modified"),
        F.lit("?").alias("Mystery Column"),
        "o_orderkey",
    )
    return orders.join(wide, orders.o_orderkey == wide.l_orderkey, "left").drop("o_orderkey", "l_orderkey")


BLOCKS_SQL = """
blocks AS (
  SELECT l_orderkey, l_linenumber,
         max(CASE WHEN l_returnflag = 'R' THEN '' ELSE 'Part ' || l_partkey END) AS family_name,
         max(CASE WHEN l_returnflag <> 'N' THEN 's' || l_suppkey || '@example.org' ELSE '' END) AS email,
         max(CASE WHEN l_returnflag = 'A' THEN l_linestatus END) AS bio_statement,
         max(CASE WHEN l_linestatus = 'F' THEN 'Supplier ' || l_suppkey END) AS editor
  FROM lineitem GROUP BY l_orderkey, l_linenumber
)"""


@query(
    "article_submissions",
    f"""
WITH {BLOCKS_SQL},
counted AS (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM blocks WHERE family_name <> '' GROUP BY l_orderkey)
SELECT o_orderkey AS submission_id, b.family_name AS author_name, b.email AS author_email, coalesce(n, 0) AS author_count,
       'Order ' || o_orderkey AS title, o_orderpriority AS submission_type, o_orderstatus AS status,
       o_orderdate AS date_submitted, CAST(NULL AS TIMESTAMP) AS last_modified
FROM orders LEFT JOIN blocks b ON b.l_orderkey = o_orderkey AND b.l_linenumber = 1 LEFT JOIN counted c ON c.l_orderkey = o_orderkey""",
)
def article_submissions(spark, sf_dir):
    return articles.extract_submissions_table(articles_export(spark, sf_dir))


@query(
    "article_authors",
    f"""
WITH {BLOCKS_SQL}
SELECT l_orderkey AS submission_id, CAST(l_linenumber AS BIGINT) AS author_number, family_name, email, bio_statement
FROM blocks JOIN orders ON o_orderkey = l_orderkey
WHERE family_name <> '' OR email <> '' OR coalesce(bio_statement, '') <> ''""",
)
def article_authors(spark, sf_dir):
    return articles.extract_authors_table(articles_export(spark, sf_dir))


@query(
    "article_editors",
    f"""
WITH {BLOCKS_SQL}
SELECT l_orderkey AS submission_id, CAST(l_linenumber AS BIGINT) AS editor_number, editor AS family_name
FROM blocks JOIN orders ON o_orderkey = l_orderkey WHERE editor IS NOT NULL""",
)
def article_editors(spark, sf_dir):
    return articles.extract_editors_table(articles_export(spark, sf_dir))


def decisions_export(spark, sf_dir):
    """One wide row per user: decision and date headers by event type (editor) and six-day period.

    The first editor's dates for period 5 have no decision column, and the last
    editor's decisions have no dates.
    """
    events = table(spark, sf_dir, "events").withColumn(
        "period", (F.floor((F.dayofmonth("ts") - 1) / 6) + 1).cast("int")
    )
    kinds, periods = _values(events, "event_type"), _values(events, "period")
    cells = []
    for editor, kind in enumerate(kinds, start=1):
        for n in periods:
            here = (F.col("event_type") == kind) & (F.col("period") == n)
            if (editor, n) != (1, 5):
                text = F.when(F.col("value") < 1, "").otherwise(F.concat(F.lit("Event "), F.col("event_id").cast("string")))
                cells.append(F.max(F.when(here, text)).alias(f"Editor Decision {n}  (Editor {editor})"))
            if editor != len(kinds):
                cells.append(
                    F.max(F.when(here, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias(f"Date decided {n}  (Editor {editor})")
                )
    return events.groupBy(F.col("user_id").cast("string").alias("Submission ID")).agg(*cells)


DECISIONS_SQL = """
WITH kinds AS (SELECT event_type, row_number() OVER (ORDER BY event_type) AS editor FROM (SELECT DISTINCT event_type FROM events)),
cells AS (
  SELECT user_id, editor,
         CAST(floor((day(ts) - 1) / 6) + 1 AS BIGINT) AS n,
         max(CASE WHEN value < 1 THEN '' ELSE 'Event ' || event_id END) AS decision,
         max(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS decided
  FROM events JOIN kinds USING (event_type) GROUP BY ALL)
SELECT user_id AS submission_id, CAST(editor AS BIGINT) AS editor_number, n AS decision_number, decision,
       CASE WHEN editor < (SELECT max(editor) FROM kinds) THEN strptime(decided, '%Y-%m-%d %H:%M:%S') END AS date_decided
FROM cells WHERE decision <> '' AND NOT (editor = 1 AND n = 5)"""


@query("unpivot_decisions", DECISIONS_SQL.replace("strptime(decided, '%Y-%m-%d %H:%M:%S')", "decided"))
def unpivot_decisions(spark, sf_dir):
    rows = unpivot_two_index(
        decisions_export(spark, sf_dir), DECISION_HEADER, "Submission ID", ("editor_number", "decision_number"), "decision"
    )
    return rows.withColumn("submission_id", F.col("submission_id").cast("bigint"))


@query("article_decisions", DECISIONS_SQL)
def article_decisions(spark, sf_dir):
    return articles.extract_decisions_table(decisions_export(spark, sf_dir))


@query(
    "unpivot_numbered",
    """
SELECT l_orderkey AS submission_id, CAST(l_linenumber AS BIGINT) AS author_number, CAST(max(l_partkey) AS VARCHAR) AS part
FROM lineitem GROUP BY l_orderkey, l_linenumber""",
)
def unpivot_numbered_query(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    wide = lines.groupBy("l_orderkey").agg(
        *[F.max(F.when(F.col("l_linenumber") == n, F.col("l_partkey"))).alias(f"Part (Author {n})") for n in _values(lines, "l_linenumber")]
    )
    return unpivot_numbered(wide, {"Part": "part"}, "l_orderkey", "author_number", "Author")


@query(
    "wide_author_count",
    "SELECT l_orderkey, count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_linenumber END) AS author_count FROM lineitem GROUP BY l_orderkey",
)
def wide_author_count(spark, sf_dir):
    here = F.col("l_returnflag") != "R"
    lines = table(spark, sf_dir, "lineitem")
    wide = lines.groupBy("l_orderkey").agg(
        *[
            F.max(F.when((F.col("l_linenumber") == n), F.when(here, "x").otherwise(""))).alias(f"Family Name (Author {n})")
            for n in _values(lines, "l_linenumber")
        ]
    )
    return wide.select("l_orderkey", numbered_count(wide, "Family Name", "Author").alias("author_count"))


@query(
    "diagonal_union",
    """
SELECT strftime(ts, '%Y-%m-%d') AS date, 'abstract' AS kind, 'day' AS interval, count(*) AS value, CAST(NULL AS BIGINT) AS users
FROM events WHERE event_type = 'view' GROUP BY ALL
UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'galley', 'day', count(*), NULL FROM events WHERE event_type = 'click' GROUP BY ALL
UNION ALL SELECT strftime(ts, '%Y-%m'), 'abstract', 'month', count(*), count(DISTINCT user_id) FROM events WHERE event_type = 'view' GROUP BY ALL""",
)
def diagonal_union_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")

    def series(event_type, fmt, *more):
        chosen = events.where(F.col("event_type") == event_type)
        return chosen.groupBy(F.date_format("ts", fmt).alias("date")).agg(F.count(F.lit(1)).alias("value"), *more)

    days = tag_series({"abstract": series("view", "yyyy-MM-dd"), "galley": series("click", "yyyy-MM-dd")}, "day")
    months = tag_series({"abstract": series("view", "yyyy-MM", F.count_distinct("user_id").alias("users"))}, "month")
    return diagonal_union(days, months).select("date", "kind", "interval", "value", quoted("users"))
