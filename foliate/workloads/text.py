"""Text, multilingual values, labels, casts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliate.functions import dates
from foliate.functions.html import clean_html
from foliate.functions.multilingual import join_list, localized
from foliate.functions.text import blank_to_null, mask_token, review_round_id, safe_name, stage_label
from foliate.operators.joins import dimension_label
from foliate.schema import DATE, DATETIME, LONG, STRING, ColumnSpec, TableSpec, conform
from foliate.session import ensure_checkpoint_dir
from foliate.sources.reports import read_report_csv
from foliate.workloads.registry import query, spread_table, table

HTML_STEPS = r"""
WITH base AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '(?i)<br\b[^>]*>|</(?:p|li|div)\s*>', chr(10), 'g'), '<[^>]+>', '', 'g') AS t
  FROM pages
), dec AS (
  SELECT page_id, regexp_replace(replace(replace(replace(replace(t, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&nbsp;', ' '),
                                 '&amp;?', '&', 'g') AS t
  FROM base
), nl AS (
  SELECT page_id, regexp_replace(replace(t, chr(160), ' '), '\r\n?', chr(10), 'g') AS t FROM dec
)
"""


@query(
    "html_to_text",
    HTML_STEPS
    + r"""SELECT page_id, regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS text FROM nl""",
)
def html_to_text(spark, sf_dir):
    pages = spread_table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return clean_html(pages, {"text": "text"})


@query(
    "html_to_lines",
    HTML_STEPS
    + r"""SELECT page_id, nullif(regexp_replace(regexp_replace(t, '\s*\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g'), '') AS text FROM nl""",
)
def html_to_lines(spark, sf_dir):
    pages = spread_table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return clean_html(pages, {"text": "lines"})


def multilingual_name(segment, name):
    """A customer name in every form a multilingual field takes, by market segment."""

    def as_json(**locales):
        return F.to_json(F.struct(*[v.alias(k) for k, v in locales.items()]), {"ignoreNullFields": "false"})

    blank, nothing = F.lit(""), F.lit(None).cast("string")
    return (
        F.when(segment == "BUILDING", name)
        .when(segment == "AUTOMOBILE", as_json(fr_FR=name, en_US=blank))
        .when(segment == "MACHINERY", as_json(fr_FR=blank, de_DE=F.concat(name, F.lit(" de")), es_ES=name, en_US=nothing))
        .when(segment == "HOUSEHOLD", as_json(fr_FR=F.concat(name, F.lit(" fr")), en_US=name))
        .otherwise(blank)
    )


@query(
    "localized_text",
    """
SELECT c_custkey,
       CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN c_name END AS text,
       CASE c_mktsegment WHEN 'MACHINERY' THEN c_name || ' de' WHEN 'FURNITURE' THEN NULL ELSE c_name END AS any_text
FROM customer""",
)
def localized_text(spark, sf_dir):
    value = multilingual_name(F.col("c_mktsegment"), F.col("c_name"))
    named = table(spark, sf_dir, "customer").select("c_custkey", value.alias("v"))
    return named.select(
        "c_custkey",
        localized(F.col("v")).alias("text"),
        localized(F.col("v"), fallback_any=True).alias("any_text"),
    )


@query(
    "join_list",
    """
SELECT p_partkey, CASE WHEN p_type NOT IN ('SMALL', 'PROMO', 'LARGE') THEN replace(p_name, ' ', '; ') END AS keywords FROM part""",
)
def join_list_query(spark, sf_dir):
    words = F.split("p_name", " ")
    keywords = (
        F.when(F.col("p_type") == "PROMO", F.to_json(F.struct(words.alias("fr_FR"))))
        .when(F.col("p_type") == "SMALL", F.lit('{"en_US": []}'))
        .when(F.col("p_type") != "LARGE", F.to_json(F.struct(words.alias("en_US"))))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", keywords.alias("k"))
    return parts.select("p_partkey", join_list(F.col("k")).alias("keywords"))


@query(
    "blank_and_labels",
    """
SELECT l_orderkey, l_partkey, l_linenumber,
       CASE l_linenumber * 3 - 1 WHEN 2 THEN 'submission' WHEN 5 THEN 'review_attachment' WHEN 8 THEN 'editor'
            WHEN 11 THEN 'production_ready' WHEN 17 THEN 'dependent'
            ELSE 'stage_' || CAST(l_linenumber * 3 - 1 AS VARCHAR) END AS stage_label,
       CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS review_round_id,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
       CASE WHEN l_returnflag = 'A' THEN 'Unknown (None)'
            ELSE coalesce(r_name, 'Unknown (' || CAST(l_linenumber AS VARCHAR) || ')') END AS section
FROM lineitem LEFT JOIN region ON r_regionkey = l_linenumber AND r_name <> 'ASIA'""",
)
def blank_and_labels(spark, sf_dir):
    flag = F.col("l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        stage_label(F.col("l_linenumber") * 3 - 1).alias("stage_label"),
        review_round_id(F.when(flag == "R", 521).otherwise(515), F.col("l_suppkey")).alias("review_round_id"),
        blank_to_null(F.when(flag == "N", "").otherwise(flag)).alias("flag"),
        F.when(flag != "A", F.col("l_linenumber")).alias("section_id"),
    )
    sections = table(spark, sf_dir, "region").where("r_name <> 'ASIA'").select("r_regionkey", "r_name")
    return dimension_label(lines, "section_id", "section", sections).drop("section_id")


CAST_SPEC = TableSpec(
    "cast_sample",
    "Text values cast to declared types.",
    {
        "order_id": ColumnSpec(LONG, "Key."),
        "day": ColumnSpec(DATE, "A date in three text forms, one of them right."),
        "moment": ColumnSpec(DATETIME, "A timestamp in three text forms, one of them right."),
        "amount": ColumnSpec(LONG, "A number as text, some of it broken."),
        "note": ColumnSpec(STRING, "A number that becomes text."),
    },
)

CAST_FORMS = """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(o_orderdate, '%Y/%m/%d') END AS day,
       CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(o_orderdate, '%Y-13-%d %H:%M:%S') END AS moment,
       CASE WHEN o_orderpriority = '5-LOW' THEN o_orderpriority ELSE CAST(o_custkey AS VARCHAR) END AS amount,
       CAST(o_custkey AS VARCHAR) AS note
FROM orders"""


@query(
    "lenient_cast",
    f"""
WITH forms AS ({CAST_FORMS})
SELECT o_orderkey AS order_id,
       CASE WHEN regexp_full_match(day, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST(day AS DATE) END AS day,
       CASE WHEN length(moment) = 19 THEN try_strptime(moment, '%Y-%m-%d %H:%M:%S') END AS moment,
       TRY_CAST(amount AS BIGINT) AS amount, note
FROM forms""",
)
def lenient_cast_query(spark, sf_dir):
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    as_date, as_moment = F.date_format(date, "yyyy-MM-dd"), F.date_format(date, "yyyy-MM-dd HH:mm:ss")
    broken = F.date_format(date, "yyyy-'13'-dd HH:mm:ss")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("note"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(status == "F", as_date).when(status == "O", as_moment).otherwise(F.date_format(date, "yyyy/MM/dd")).alias("day"),
        F.when(status == "F", as_date).when(status == "O", as_moment).otherwise(broken).alias("moment"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string")).alias("amount"),
    )
    return conform(raw, CAST_SPEC)


@query(
    "mask_token",
    r"""
SELECT page_id, regexp_replace(url, '(ref=)[^&\s''")]+', '\1[REDACTED]', 'g') AS url,
       url || '#apiToken=[REDACTED]&lang=en' AS call
FROM pages""",
)
def mask_token_query(spark, sf_dir):
    call = F.concat("url", F.lit("#apiToken="), F.col("page_id").cast("string"), F.lit("x&lang=en"))
    return table(spark, sf_dir, "pages").select(
        "page_id", mask_token(F.col("url"), "ref").alias("url"), mask_token(call).alias("call")
    )


@query(
    "safe_name",
    r"""
WITH named AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN '__ ' WHEN p_type <> 'LARGE' THEN ' ' || p_name || ' (' || p_brand || ').pdf ' END AS n FROM part)
SELECT p_partkey, coalesce(nullif(trim(regexp_replace(n, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), ''), 'file') AS name FROM named""",
)
def safe_name_query(spark, sf_dir):
    name = F.concat(F.lit(" "), "p_name", F.lit(" ("), "p_brand", F.lit(").pdf "))
    form = F.when(F.col("p_type") == "PROMO", "__ ").when(F.col("p_type") != "LARGE", name)
    return table(spark, sf_dir, "part").select("p_partkey", safe_name(form).alias("name"))


@query(
    "iso_dates",
    """
WITH forms AS (
  SELECT o_orderkey, o_orderdate,
         CASE o_orderpriority WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m%d') WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d ')
              WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-31') WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
  FROM orders)
SELECT o_orderkey, day,
       coalesce(regexp_full_match(day, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_strptime(day, '%Y-%m-%d') IS NOT NULL, false) AS is_iso,
       strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS mark,
       strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS window_start,
       '2024-06-15 08:30:00' AS fetched_at
FROM forms""",
)
def iso_dates(spark, sf_dir):
    priority, date = F.col("o_orderpriority"), F.col("o_orderdate")
    day = (
        F.when(priority == "1-URGENT", F.date_format(date, "yyyyMMdd"))
        .when(priority == "2-HIGH", F.date_format(date, "yyyy-MM-dd "))
        .when(priority == "3-MEDIUM", F.date_format(date, "yyyy-MM-'31'"))
        .when(priority != "4-NOT SPECIFIED", F.date_format(date, "yyyy-MM-dd"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", day.alias("day"))
    return orders.select(
        "o_orderkey",
        "day",
        dates.is_iso_date(F.col("day")).alias("is_iso"),
        dates.mark_text(F.col("o_orderdate")).alias("mark"),
        dates.window_text(F.col("o_orderdate")).alias("window_start"),
        F.lit("2024-06-15 08:30:00").alias("fetched_at"),
    )


@query("report_by_blocks", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, source FROM documents")
def report_by_blocks(spark, sf_dir):
    """Whole texts, with their quotes and line breaks, out of an export that is read by blocks."""
    folder = f"{ensure_checkpoint_dir(spark)}/export-{uuid.uuid4()}"
    form = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table(spark, sf_dir, "documents").select("doc_id", "text", "source").write.csv(folder, **form)
    return read_report_csv(spark, folder, by_blocks=True)
