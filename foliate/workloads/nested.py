"""Arrays inside a record, and the same picks over child rows.

The arrays come from splitting each document's whole text, so no group of rows is
ever gathered into one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.functions.nested import any_child_in, array_len, array_len_or_null, current_child, first_child, latest_by
from foliate.functions.text import yes_to_bool
from foliate.operators.filters import keep_keyed
from foliate.operators.joins import latest_row, pick_current
from foliate.operators.ranking import number_rows
from foliate.operators.reshape import explode_children, explode_ordered
from foliate.workloads.registry import query, spread_table, table


def _words(documents):
    """Documents with the words of their whole texts as structs."""
    words = F.transform(
        F.split("text", " "),
        lambda w, i: F.struct(
            F.length(w).alias("stageId"), F.pmod(i, F.lit(7)).alias("round"), i.alias("id"), w.alias("word")
        ),
    )
    return documents.withColumn("children", words)


WORDS_SQL = """
words AS (
  SELECT doc_id, w.word AS word, length(w.word) AS stage, (w.pos - 1) % 7 AS round, w.pos - 1 AS id
  FROM (SELECT doc_id, unnest(list_zip(ws, range(1, len(ws) + 1))) AS z FROM
         (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)) t,
       LATERAL (SELECT z[1] AS word, z[2] AS pos) w
)"""


@query(
    "explode_children",
    "SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents",
)
def explode_children_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.split("text", "\n").alias("lines")
    )
    return explode_children(docs, "lines", ["doc_id", "lang"], "line")


@query(
    "ordered_children",
    """
WITH lines AS (
  SELECT doc_id, z[1] AS line, z[2] AS pos
  FROM (SELECT doc_id, unnest(list_zip(ls, range(1, len(ls) + 1))) AS z FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN length(line) > 40 THEN 0 ELSE length(line) END, pos) AS line_number, line
FROM lines""",
)
def ordered_children(spark, sf_dir):
    lines = F.transform(
        F.split("text", "\n"),
        lambda t: F.struct(t.alias("line"), F.when(F.length(t) <= 40, F.length(t)).alias("seq")),
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines"))
    numbered = explode_ordered(docs, "lines", "seq", ["doc_id"], "line_number")
    return numbered.select("doc_id", "line_number", F.col("child.line").alias("line"))


@query(
    "numbered_rows",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber END,
         l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS n
FROM lineitem""",
)
def numbered_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    seq = F.when(F.col("l_returnflag") == "N", 0).otherwise(F.col("l_linenumber"))
    ties = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    order = [seq.asc(), *[F.col(c).asc() for c in [*ties, "l_returnflag", "l_linestatus"]]]
    numbered = number_rows(lines, ["l_orderkey"], order, "n")
    return numbered.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "n")


@query(
    "current_version",
    """
WITH named AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN max(o_orderkey) END AS cur
               FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal),
ranked AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey
             ORDER BY CASE WHEN o_orderkey = cur THEN 0 ELSE 1 END, o_orderkey) AS rn
           FROM orders JOIN named ON c_custkey = o_custkey)
SELECT o_custkey, o_orderkey, o_orderstatus FROM ranked WHERE rn = 1""",
)
def current_version(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    rich = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    newest = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("newest"))
    named = rich.join(newest, "o_custkey").select(
        "o_custkey", F.when(F.col("c_acctbal") > 5000, F.col("newest")).alias("current")
    )
    return pick_current(orders, named, "o_custkey", "o_orderkey", "current", ["o_orderkey"])


@query(
    "current_version_nested",
    """
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN ws[CAST(doc_id % 50 + 1 AS BIGINT)] END, ws[1]) AS current_word, ws[1] AS first_word
FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)""",
)
def current_version_nested(spark, sf_dir):
    docs = _words(spread_table(spark, sf_dir, "documents"))
    current = F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 50)
    return docs.select(
        "doc_id",
        current_child(F.col("children"), "id", current)["word"].alias("current_word"),
        first_child(F.col("children"))["word"].alias("first_word"),
    )


@query(
    "latest_round",
    """
WITH ranked AS (SELECT user_id, event_id, event_type, CAST(hour(ts) AS INTEGER) AS stage, CAST(minute(ts) AS INTEGER) AS round,
    row_number() OVER (PARTITION BY user_id ORDER BY hour(ts) DESC, minute(ts) DESC, event_id) AS rn FROM events)
SELECT user_id, event_id, event_type, stage, round FROM ranked WHERE rn = 1""",
)
def latest_round(spark, sf_dir):
    rounds = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", F.hour("ts").alias("stage"), F.minute("ts").alias("round")
    )
    return latest_row(rounds, ["user_id"], ["stage", "round"], ["event_id"])


@query(
    "latest_round_nested",
    f"""
WITH {WORDS_SQL},
ranked AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY stage DESC, round DESC, id) AS rn FROM words)
SELECT d.doc_id, r.word AS latest_word FROM documents d LEFT JOIN ranked r ON r.doc_id = d.doc_id AND rn = 1""",
)
def latest_round_nested(spark, sf_dir):
    docs = _words(spread_table(spark, sf_dir, "documents"))
    return docs.select("doc_id", latest_by(F.col("children"), "stageId", "round")["word"].alias("latest_word"))


@query(
    "role_filter",
    f"""WITH {WORDS_SQL} SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM words WHERE stage IN (11, 13, 17))""",
)
def role_filter(spark, sf_dir):
    docs = _words(spread_table(spark, sf_dir, "documents"))
    return docs.where(any_child_in(F.col("children"), "stageId", [11, 13, 17])).select("doc_id", "lang")


@query(
    "array_counts",
    """
SELECT doc_id, coalesce(CAST(len(string_split(text, ' ')) AS BIGINT), 0) AS n, CAST(len(string_split(text, ' ')) AS BIGINT) AS n_or_null
FROM documents""",
)
def array_counts(spark, sf_dir):
    docs = _words(spread_table(spark, sf_dir, "documents"))
    children = F.col("children")
    return docs.select("doc_id", array_len(children).alias("n"), array_len_or_null(children).alias("n_or_null"))


@query(
    "child_counts",
    """
WITH counts AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(n, 0) AS line_count, n AS line_count_or_null, o_orderstatus = 'F' AS is_final
FROM orders LEFT JOIN counts ON l_orderkey = o_orderkey""",
)
def child_counts(spark, sf_dir):
    counts = keep_keyed(table(spark, sf_dir, "lineitem"), "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = table(spark, sf_dir, "orders")
    answer = F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No")
    return orders.join(counts, orders.o_orderkey == counts.l_orderkey, "left").select(
        "o_orderkey",
        F.coalesce("n", F.lit(0)).alias("line_count"),
        F.nullif(F.col("n"), F.lit(0)).alias("line_count_or_null"),
        yes_to_bool(answer).alias("is_final"),
    )
