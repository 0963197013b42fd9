"""The landed datasets, derived row by row from the given tables.

Every builder is a projection (or one aggregation) of a whole table, so the work
of the pipelines on top grows with the tables. Arrays hold two or three structs
made from columns of their own row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from foliate.workloads.registry import dealt_table, spread_table, table

TEXT_TS = "yyyy-MM-dd HH:mm:ss"


def _s(col):
    return col.cast("string")


def _en(*parts):
    """A multilingual value with an English text, as landed JSON. The parts need no escaping."""
    return F.concat(F.lit('{"en_US":"'), *parts, F.lit('"}'))


def submissions(spark, sf_dir, buckets=None):
    """Orders as submissions with a draft and a current version."""
    key, status, date = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    priority = F.substring("o_orderpriority", 1, 1).cast("bigint")
    null = F.lit(None).cast("string")
    draft = F.struct(
        (key * 10 + 1).alias("id"),
        F.lit(1).cast("bigint").alias("sectionId"),
        _en(F.lit("Draft "), _s(key)).alias("fullTitle"),
        null.alias("urlPublished"),
        null.alias("pub-id::doi"),
        null.alias("datePublished"),
    )
    final = F.struct(
        (key * 10 + 2).alias("id"),
        F.when(priority < 5, priority * 2).alias("sectionId"),
        F.when(status == "P", F.concat(F.lit("Plain "), _s(key))).otherwise(_en(F.lit("Final "), _s(key))).alias("fullTitle"),
        F.concat(F.lit("https://example.org/"), _s(key)).alias("urlPublished"),
        F.concat(F.lit("10.1/"), _s(key)).alias("pub-id::doi"),
        F.date_format(date, "yyyy-MM-dd").alias("datePublished"),
    )
    rows = dealt_table(spark, sf_dir, "orders", "o_orderkey", buckets) if buckets else spread_table(spark, sf_dir, "orders")
    return rows.select(
        key.alias("id"),
        F.when(status == "F", "Published").when(status == "O", "Submission").otherwise("Review").alias("statusLabel"),
        F.date_format(date, TEXT_TS).alias("dateSubmitted"),
        F.date_format(date, "yyyy-MM-dd").alias("lastModified"),
        F.when(priority != 5, F.date_format(date, TEXT_TS)).alias("dateLastActivity"),
        priority.alias("stageId"),
        F.when(status != "O", key * 10 + 2).alias("currentPublicationId"),
        F.array(draft, final).alias("publications"),
    )


def publications(spark, sf_dir, buckets=None):
    """Order lines as version details; the last line of an order is its detail."""
    order, number = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    part, supplier, flag = _s(F.col("l_partkey")), _s(F.col("l_suppkey")), F.col("l_returnflag")
    abstract = _en(
        F.lit("<p>Part&nbsp;<b>"), part, F.lit("</b> &amp; co</p><div>from <i>supplier</i> &#35;"), supplier, F.lit("</div>")
    )
    reviewers = _en(F.lit("Referee <b>"), part, F.lit(r"</b><br />\r\n<br>  from supplier &lt;"), supplier, F.lit("&gt; <p></p>"))
    first = F.struct(
        F.lit(2.0).alias("seq"),
        _en(F.lit("Given "), part).alias("givenName"),
        _en(F.lit("Part "), part).alias("familyName"),
        F.when(flag == "A", F.concat(F.lit("0000-"), part)).otherwise("").alias("orcid"),
        F.when(flag != "A", "NO").alias("country"),
        F.lit('{"fr_FR": "Usine"}').alias("affiliation"),
        F.concat(F.lit("c"), part, F.lit("@example.org")).alias("email"),
    )
    second = F.struct(
        F.when(flag != "N", 1.0).alias("seq"),
        F.lit(None).cast("string").alias("givenName"),
        F.concat(F.lit("Supplier "), supplier).alias("familyName"),
        F.lit(None).cast("string").alias("orcid"),
        F.lit("").alias("country"),
        _en(F.lit("Plant "), supplier).alias("affiliation"),
        F.when(flag == "R", "").when(flag == "A", F.concat(F.lit("desk"), F.pmod(F.col("l_suppkey"), F.lit(25)).cast("string"), F.lit("@example.org"))).alias("email"),
    )
    ties = ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_extendedprice"]
    rows = dealt_table(spark, sf_dir, "lineitem", "l_orderkey", buckets) if buckets else spread_table(spark, sf_dir, "lineitem")
    return rows.select(
        order.alias("_submission_id"),
        (order * 10 + number).alias("id"),
        F.when(F.col("l_linestatus") == "F", 3).otherwise(1).cast("bigint").alias("status"),
        number.alias("version"),
        _en(F.lit("Sub "), part).alias("subtitle"),
        F.when(flag == "N", "").otherwise(flag).alias("authorsString"),
        F.concat(part, F.lit("-"), supplier).alias("pages"),
        number.alias("seq"),
        F.lit("en_US").alias("locale"),
        F.lit("").alias("licenseUrl"),
        F.concat(F.lit("Holder "), supplier).alias("copyrightHolder"),
        F.year("l_shipdate").cast("bigint").alias("copyrightYear"),
        F.col("l_suppkey").alias("issueId"),
        abstract.alias("abstract"),
        F.when(flag != "R", reviewers).alias("recommendedReviewers"),
        F.to_json(F.struct(F.array(flag, F.col("l_linestatus")).alias("en_US"))).alias("keywords"),
        F.when(flag != "N", F.array(F.struct(number.alias("id")), F.struct((number + 1).alias("id")))).alias("galleys"),
        F.when(number != 7, F.array(first, second)).alias("authors"),
        F.struct(*ties).alias("_seq"),
    )


DETAILS_SQL = """
details AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
            l_returnflag DESC, l_linestatus DESC, l_extendedprice DESC) AS rn
  FROM lineitem
)"""

ROUNDS_SQL = """
ext AS (
  SELECT event_id, CAST(CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN minute(ts)
           ELSE greatest(hour(ts), minute(ts)) END AS BIGINT) AS review_round,
         CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 'External' ELSE CASE WHEN hour(ts) >= minute(ts) THEN 'Internal' ELSE 'External' END END AS review_round_status
  FROM events
)"""

SUBMISSIONS_SQL = f"""
{DETAILS_SQL}, {ROUNDS_SQL},
versions AS (
  SELECT *, CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS priority, o_orderstatus = 'O' AS is_draft FROM orders
),
submissions AS (
  SELECT o_orderkey AS submission_id,
    CASE WHEN l_linenumber <> 7 THEN 'Part ' || l_partkey END AS author_name,
    CASE WHEN l_linenumber <> 7 THEN 'c' || l_partkey || '@example.org' END AS author_email,
    CASE WHEN l_linenumber <> 7 THEN CAST(2 AS BIGINT) END AS author_count,
    CASE WHEN is_draft THEN 'Draft ' || o_orderkey WHEN o_orderstatus = 'P' THEN 'Plain ' || o_orderkey ELSE 'Final ' || o_orderkey END AS title,
    'Part ' || l_partkey || ' & co' || chr(10) || 'from supplier #' || l_suppkey AS abstract,
    CASE WHEN is_draft THEN 'Peer-reviewed Articles' WHEN priority = 5 THEN 'Unknown (None)' WHEN priority = 1 THEN 'Commentary'
         WHEN priority = 2 THEN 'Peer-reviewed Research Notes'
         WHEN priority = 3 THEN 'Special Issue: Digital Intersectionality and Marginalization in Majority World' ELSE 'Unknown (8)' END AS submission_type,
    l_returnflag || '; ' || l_linestatus AS keywords,
    CASE WHEN l_returnflag <> 'R' THEN 'Referee ' || l_partkey || chr(10) || 'from supplier <' || l_suppkey || '>' END AS recommended_reviewers,
    CASE o_orderstatus WHEN 'F' THEN 'Published' WHEN 'O' THEN 'Submission' ELSE 'Review' END AS status,
    CASE WHEN NOT is_draft THEN 'https://example.org/' || o_orderkey END AS url,
    CASE WHEN NOT is_draft THEN '10.1/' || o_orderkey END AS doi,
    o_orderdate AS date_submitted, CAST(NULL AS TIMESTAMP) AS last_modified,
    CASE WHEN priority <> 5 THEN o_orderdate END AS date_last_activity,
    CASE WHEN NOT is_draft THEN CAST(o_orderdate AS DATE) END AS date_published,
    priority AS stage_id, review_round, review_round_status, l_suppkey AS issue_id
  FROM versions LEFT JOIN details ON l_orderkey = o_orderkey AND rn = 1 LEFT JOIN ext ON event_id = o_orderkey
)"""


def submissions_ext(spark, sf_dir, buckets=None):
    """Events as extended records: two review rounds and two assignments each."""
    kind, ts = F.col("event_type"), F.col("ts")
    hour, minute = F.hour(ts).cast("bigint"), F.minute(ts).cast("bigint")

    def rnd(number, stage, status):
        return F.struct(
            F.col("event_id").alias("id"), number.alias("round"), stage.alias("stageId"), F.lit(None).cast("bigint").alias("statusId"), F.lit(status).alias("status")
        )

    def assignment(offset, number, status):
        return F.struct(
            (F.col("event_id") * 2 + offset).alias("id"),
            number.alias("round"),
            F.col("event_id").alias("roundId"),
            F.lit(offset).cast("bigint").alias("statusId"),
            F.lit(status).alias("status"),
            F.date_format(ts, "yyyy-MM-dd").alias("due"),
            F.when(kind == "click", F.date_format(ts, TEXT_TS)).otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("responseDue"),
        )

    two = F.lit(2).cast("bigint")
    later = F.when(kind == "purchase", F.lit(3)).otherwise(F.lit(2)).cast("bigint")
    rows = dealt_table(spark, sf_dir, "events", "event_id", buckets) if buckets else table(spark, sf_dir, "events")
    return rows.select(
        F.col("event_id").alias("id"),
        F.date_format(ts, TEXT_TS).alias("dateLastActivity"),
        F.when(kind != "error", F.array(rnd(hour, two, "Internal"), rnd(minute, later, "External"))).alias("reviewRounds"),
        F.when(kind != "signup", F.array(assignment(0, hour, "Invited"), assignment(1, minute, "Late"))).alias("reviewAssignments"),
    )


ASSIGNMENTS_SQL = """
assignments AS (
  SELECT event_id AS submission_id, event_id * 2 + k AS assignment_id, CAST(CASE k WHEN 0 THEN hour(ts) ELSE minute(ts) END AS BIGINT) AS round,
         event_id AS round_id, CAST(k AS BIGINT) AS status_id, CASE k WHEN 0 THEN 'Invited' ELSE 'Late' END AS status,
         CAST(ts AS DATE) AS due, CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS response_due
  FROM events, (VALUES (0), (1)) v(k) WHERE event_type <> 'signup'
)"""


def users(spark, sf_dir, buckets=None):
    """Customers as accounts; those of one market segment share the email of their nation."""
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    role = F.when(segment == "BUILDING", 4096).when(segment == "MACHINERY", 16).otherwise(65536).cast("bigint")
    own = F.struct(
        nation.cast("bigint").alias("id"),
        F.when(segment == "MACHINERY", F.lit('{"en_US": "", "fr_CA": "Groupe des lecteurs"}')).otherwise(_en(F.lit("Group "), _s(nation))).alias("name"),
        F.lit("G").alias("abbrev"),
        role.alias("roleId"),
    )
    reader = F.struct(
        F.lit(99).cast("bigint").alias("id"), F.lit("Readers").alias("name"), F.lit("").alias("abbrev"), F.lit(1048576).cast("bigint").alias("roleId")
    )
    rows = dealt_table(spark, sf_dir, "customer", "c_custkey", buckets) if buckets else table(spark, sf_dir, "customer")
    return rows.select(
        key.alias("id"),
        F.col("c_name").alias("userName"),
        F.when(segment == "BUILDING", F.concat(F.lit("desk"), _s(nation), F.lit("@example.org")))
        .when(segment != "FURNITURE", F.concat(F.lit("c"), _s(key), F.lit("@example.org")))
        .otherwise("")
        .alias("email"),
        F.col("c_name").alias("fullName"),
        F.lit("").alias("orcid"),
        (F.col("c_acctbal") < 0).alias("disabled"),
        F.when(segment != "HOUSEHOLD", F.array(own, reader)).alias("groups"),
    )


USERS_SQL = """
accounts AS (
  SELECT c_custkey AS id, c_name, c_acctbal < 0 AS disabled, c_mktsegment, c_nationkey,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'desk' || c_nationkey || '@example.org'
              WHEN c_mktsegment <> 'FURNITURE' THEN 'c' || c_custkey || '@example.org' END AS email
  FROM customer
)"""


def user_details(spark, sf_dir, buckets=None):
    """Orders as account details; the newest order of a customer is the valid one."""
    status, date = F.col("o_orderstatus"), F.col("o_orderdate")
    rows = dealt_table(spark, sf_dir, "orders", "o_custkey", buckets) if buckets else spread_table(spark, sf_dir, "orders")
    return rows.select(
        F.col("o_custkey").alias("id"),
        F.when(status == "F", "").otherwise(status).alias("country"),
        F.when(status == "P", F.to_json(F.struct(F.lit("").alias("en_US"), F.col("o_orderpriority").alias("de_DE"))))
        .otherwise(_en(F.lit("Dept "), F.col("o_orderpriority")))
        .alias("affiliation"),
        F.date_format(date, TEXT_TS).alias("dateRegistered"),
        F.date_format(date, "yyyy-MM-dd").alias("dateLastLogin"),
        F.lit("2024-06-15 08:30:00").alias("_fetched_at"),
        F.struct("o_orderdate", "o_orderkey").alias("_seq"),
    )


def submission_files(spark, sf_dir):
    """Order lines as files, with two earlier uploads, one of them repeating the current file."""
    part, flag = F.col("l_partkey"), F.col("l_returnflag")
    stage = F.col("l_linenumber").cast("bigint") * 3 - 1
    url = F.when(stage != 2, F.concat(F.lit("https://example.org/f/"), _s(part)))
    again = F.struct(part.alias("fileId"), F.concat(url, F.lit("?again")).alias("url"))
    older = F.struct(
        (F.col("l_suppkey") + 1000000).alias("fileId"), F.when(stage != 11, F.concat(url, F.lit("?old"))).alias("url")
    )
    return spread_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("_submission_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        part.alias("fileId"),
        stage.alias("fileStage"),
        F.lit(1).cast("bigint").alias("genreId"),
        F.when(flag == "N", F.lit('{"fr_FR": "épreuve finale"}')).otherwise(_en(F.lit("paper "), _s(part), F.lit(".pdf"))).alias("name"),
        F.lit("application/pdf").alias("mimetype"),
        F.lit("pdf").alias("documentType"),
        F.col("l_suppkey").alias("uploaderUserId"),
        F.lit(None).cast("bigint").alias("sourceSubmissionFileId"),
        F.when(flag == "R", 521).otherwise(515).cast("bigint").alias("assocType"),
        part.alias("assocId"),
        F.date_format("l_shipdate", TEXT_TS).alias("createdAt"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("updatedAt"),
        url.alias("url"),
        F.when(F.col("l_linestatus") == "F", F.array(again, older)).alias("revisions"),
    )


FILES_SQL = """
files AS (
  SELECT row_number() OVER () AS row_id, l_orderkey AS submission_id, l_orderkey * 10 + l_linenumber AS submission_file_id, l_partkey AS file_id,
         CAST(l_linenumber * 3 - 1 AS BIGINT) AS file_stage,
         CASE l_linenumber WHEN 1 THEN 'submission' WHEN 2 THEN 'review_attachment' WHEN 3 THEN 'editor' WHEN 4 THEN 'production_ready'
              WHEN 6 THEN 'dependent' ELSE 'stage_' || CAST(l_linenumber * 3 - 1 AS VARCHAR) END AS file_stage_label,
         CASE WHEN l_returnflag = 'R' THEN l_partkey END AS review_round_id,
         CASE WHEN l_returnflag <> 'N' THEN 'paper ' || l_partkey || '.pdf' END AS name,
         CASE WHEN l_returnflag = 'N' THEN 'preuve_finale' ELSE 'paper_' || l_partkey || '.pdf' END AS safe,
         l_suppkey AS uploader_user_id, l_linestatus = 'F' AS has_revisions,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(l_shipdate, '%Y-%m-%d') AS updated_at,
         CASE WHEN l_linenumber <> 1 THEN 'https://example.org/f/' || l_partkey END AS url
  FROM lineitem
)"""


def publication_stats(spark, sf_dir):
    """Parts as cumulative counts, those of one type without a publication."""
    size = F.col("p_size").cast("bigint")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") != "PROMO", F.struct(F.col("p_partkey").alias("id"))).alias("publication"),
        size.alias("abstractViews"),
        (size * 2).alias("galleyViews"),
        size.alias("pdfViews"),
        F.lit(0).cast("bigint").alias("htmlViews"),
        F.lit(None).cast("bigint").alias("otherViews"),
    )


def views_timeline(spark, sf_dir, fmt="yyyy-MM-dd", interval="day"):
    """Counts per user and period, zero where a period has events of other kinds only."""
    events = table(spark, sf_dir, "events")
    counted = events.groupBy("user_id", F.date_format("ts", fmt).alias("date")).agg(
        F.count_if(F.col("event_type") == "view").alias("abstract"), F.count_if(F.col("event_type") == "click").alias("galley")
    )
    points = counted.select(
        F.col("user_id").alias("_submission_id"),
        "date",
        F.inline(
            F.array(
                F.struct(F.col("abstract").alias("value"), F.lit("abstract").alias("kind")),
                F.struct(F.col("galley").alias("value"), F.lit("galley").alias("kind")),
            )
        ),
    )
    return points.withColumn("interval", F.lit(interval))


def timeline_totals(spark, sf_dir):
    return views_timeline(spark, sf_dir).groupBy("date", "kind", "interval").agg(F.sum("value").alias("value"))


def reviews_export(spark, sf_dir):
    """Events as the long reviews report."""
    kind, ts = F.col("event_type"), F.col("ts")
    day, second = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, TEXT_TS)
    return table(spark, sf_dir, "events").select(
        _s(F.col("event_id")).alias("Submission ID"),
        _s(F.hour(ts)).alias("Round"),
        F.concat(F.lit("rev"), _s(F.col("user_id"))).alias("Reviewer"),
        F.lit("Rae").alias("Given Name"),
        F.when(kind == "click", second).when(kind == "view", day).alias("Date Assigned"),
        _s(F.col("value")).alias("Response Overdue Days"),
        F.when(kind == "error", "x7").otherwise(_s(F.minute(ts))).alias("Review Overdue Days"),
        F.when(kind == "purchase", "Yes").when(kind != "signup", "No").alias("Declined"),
        F.concat(F.lit("<p>Good &amp; "), kind, F.lit("</p><br>"), F.col("props")).alias("Comments On Submission"),
        F.lit("review").alias("Stage"),
        F.lit("?").alias("Mystery"),
    )
