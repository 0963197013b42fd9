"""Upserts, changed-since selection and the incremental jobs."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.operators.filters import changed_since
from foliate.operators.merge import high_water, high_water_mark, upsert, upsert_positions
from foliate.plans import landing
from foliate.plans.jobs import sync
from foliate.session import ensure_checkpoint_dir, small_frame
from foliate.sources import profiles, store, timeline
from foliate.sources.records import unwrap_pages
from foliate.sources.state import load_state, mark_of
from foliate.streaming.sync_stream import sync_landing, sync_stream
from foliate.workloads import records
from foliate.workloads.registry import query, table
from foliate.workloads.tables import POINTS_SQL

CUT = "2024-01-20 00:00:00"


def _old_and_new(spark, sf_dir):
    """Events up to a mark, and everything after the mark less a day, with raised values."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut = F.lit(CUT).cast("timestamp_ntz")
    old = events.where(F.col("ts") <= cut)
    new = events.where(F.col("ts") > cut - F.expr("INTERVAL 1 DAY")).withColumn("value", F.col("value") + 1)
    return old, new


@query(
    "upsert_events",
    f"""
SELECT event_id, ts, user_id, event_type, CASE WHEN ts > TIMESTAMP '{CUT}' - INTERVAL 1 DAY THEN value + 1 ELSE value END AS value FROM events""",
)
def upsert_events(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return upsert(old, new, ["event_id"], ["ts"])


@query(
    "upsert_positions",
    f"""
SELECT event_id, CASE WHEN ts > TIMESTAMP '{CUT}' - INTERVAL 1 DAY THEN value + 1 ELSE value END AS value,
       CASE WHEN ts > TIMESTAMP '{CUT}' THEN 1 ELSE 0 END AS source, event_id AS seq
FROM events""",
)
def upsert_positions_query(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    columns = ["event_id", "value", F.col("event_id").alias("seq")]
    return upsert_positions(old.select(*columns), new.select(*columns), ["event_id"], "seq")


UPSERT_TIMELINE_SQL = """
days AS (SELECT user_id, 'day' AS interval, strftime(ts, '%Y-%m-%d') AS date, event_type AS kind, count(*) AS value FROM events GROUP BY ALL),
months AS (SELECT user_id, 'month' AS interval, strftime(ts, '%Y-%m') AS date, event_type AS kind, count(*) AS value FROM events GROUP BY ALL)"""


@query(
    "upsert_timeline",
    f"""
WITH {UPSERT_TIMELINE_SQL},
both_sides AS (
  SELECT *, 0 AS src FROM days WHERE date <= '2024-01-20' UNION ALL SELECT *, 0 FROM months WHERE kind <> 'view'
  UNION ALL SELECT user_id, interval, date, kind, value * 10, 1 FROM days WHERE date >= '2024-01-19'
  UNION ALL SELECT user_id, interval, date, kind, value * 10, 1 FROM months WHERE kind IN ('view', 'click')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, interval, date, kind ORDER BY src DESC) AS rn FROM both_sides)
SELECT user_id AS _submission_id, interval, date, kind, value FROM ranked WHERE rn = 1""",
)
def upsert_timeline(spark, sf_dir):
    events = table(spark, sf_dir, "events")

    def points(interval, fmt):
        return (
            events.groupBy(F.col("user_id").alias("_submission_id"), F.date_format("ts", fmt).alias("date"), F.col("event_type").alias("kind"))
            .agg(F.count(F.lit(1)).alias("value"))
            .withColumn("interval", F.lit(interval))
        )

    days, months = points("day", "yyyy-MM-dd"), points("month", "yyyy-MM")
    old = days.where("date <= '2024-01-20'").unionByName(months.where("kind <> 'view'"))
    new = days.where("date >= '2024-01-19'").unionByName(months.where("kind IN ('view', 'click')"))
    new = new.withColumn("value", F.col("value") * 10)
    keys = landing.MERGE_KEYS["views_timeline"]
    return upsert(old, new, keys, ["value"]).select("_submission_id", "interval", "date", "kind", "value")


@query(
    "changed_since",
    """
WITH dated AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS ts FROM orders)
SELECT o_orderkey, ts FROM dated
WHERE ts IS NULL OR ts > (SELECT max(ts) - INTERVAL 1 DAY FROM dated WHERE o_orderstatus = 'F')""",
)
def changed_since_query(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("ts")
    )
    mark = high_water_mark(dated.where("o_orderstatus = 'F'"), "ts")
    return changed_since(dated, mark, "ts").select("o_orderkey", "ts")


@query(
    "high_water",
    "SELECT strftime(max(o_orderdate) - INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS mark FROM orders WHERE o_orderpriority <> '5-LOW'",
)
def high_water_query(spark, sf_dir):
    return high_water(records.submissions(spark, sf_dir), "dateLastActivity")


def work_dir(spark, name):
    """A fresh folder in the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


SYNC_CUT = "2000-01-01 00:00:00"


def _landed(spark, sf_dir, buckets):
    """The datasets as projections of tables that are dealt out by key."""
    return {
        "submissions": records.submissions(spark, sf_dir, buckets),
        "_submissions": records.submissions_ext(spark, sf_dir, buckets),
        "publications": records.publications(spark, sf_dir, buckets).withColumn("_seq", F.col("_seq.l_linenumber")),
        "users": records.users(spark, sf_dir, buckets),
        "publication_stats": records.publication_stats(spark, sf_dir),
        "views_timeline": records.views_timeline(spark, sf_dir),
    }


def _buckets(spark, sf_dir):
    """As many as the largest dataset takes, by the footers of its table."""
    return store.buckets_for(table(spark, sf_dir, "lineitem").count())


@query(
    "sync_incremental",
    f"""
WITH dated AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS ts FROM orders),
mark AS (SELECT max(ts) - INTERVAL 1 DAY AS m FROM dated WHERE ts <= TIMESTAMP '{SYNC_CUT}')
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_activity,
       CASE WHEN ts <= (SELECT m FROM mark) THEN 'first' ELSE 'second' END AS loaded_by
FROM dated""",
)
def sync_incremental(spark, sf_dir):
    """A full load up to a cut, then an incremental run over everything that landed.

    The second run starts a day before the newest record of the first one; it takes
    what is newer than that, and what has no activity time.
    """
    merged = store.read(spark, f"{_synced_twice(spark, sf_dir)}/submissions")
    return merged.select("id", F.col("dateLastActivity").alias("last_activity"), F.col("statusLabel").alias("loaded_by"))


STATS_RUNS = ("2024-01-20 00:00:00", "2024-01-31 00:00:00")


def _synced_twice(spark, sf_dir, stats=False):
    """The folder of a full load up to a cut and an incremental run over everything, in which recent points have other values."""
    target = work_dir(spark, "sync")
    names = (*landing.REQUIRED, "publication_stats", "views_timeline") if stats else landing.REQUIRED
    # Projections of stored tables: the runs read those, and nothing is written twice.
    options = {"staged": True, "dealt": True, "buckets": _buckets(spark, sf_dir), "stats": stats}
    landed = {name: df for name, df in _landed(spark, sf_dir, options["buckets"]).items() if name in names}
    # An aggregate is worth a copy.
    landed |= {name: store.replace_dataset(landed[name], f"{target}-landed/{name}") for name in names if name == "views_timeline"}
    everything, activity = landed["submissions"], F.col("dateLastActivity")
    landed["submissions"] = everything.where(activity.isNull() | (activity <= SYNC_CUT)).withColumn("statusLabel", F.lit("first"))
    sync(spark, landed, target, STATS_RUNS[0], full=True, **options)
    landed["submissions"] = everything.withColumn("statusLabel", F.lit("second"))
    if stats:
        landed["views_timeline"] = landed["views_timeline"].withColumn("value", F.col("value") * 10)
    sync(spark, landed, target, STATS_RUNS[1], incremental=True, **options)
    return target


@query(
    "sync_seen",
    """
SELECT 'submissions' AS dataset, o_orderkey AS id,
       CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS last_activity
FROM orders""",
)
def sync_seen(spark, sf_dir):
    """The state those two runs leave: each submission once, with its newest activity time."""
    return load_state(spark, f"{_synced_twice(spark, sf_dir)}/state")["seen"]


@query(
    "sync_user_details",
    """
SELECT DISTINCT o_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN '2024-06-01 00:00:00' ELSE '2024-06-02 00:00:00' END AS fetched_at
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
)
def sync_user_details(spark, sf_dir):
    """Details fetched for one role in a full run and for another later: the first ones stay as they were, each stamped with its run."""
    target = work_dir(spark, "details")
    options = {"staged": True, "dealt": True, "buckets": _buckets(spark, sf_dir), "stats": False, "user_details": True}
    landed = {**_landed(spark, sf_dir, options["buckets"]), "user_details": records.user_details(spark, sf_dir, options["buckets"])}
    landed = {name: landed[name] for name in (*landing.REQUIRED, "user_details")}
    sync(spark, landed, target, "2024-06-01 00:00:00", full=True, user_roles=[4096], **options)
    sync(spark, landed, target, "2024-06-02 00:00:00", incremental=True, user_roles=[16], **options)
    return store.read(spark, f"{target}/user_details").select("id", F.col("_fetched_at").alias("fetched_at")).distinct()


@query(
    "merge_slices",
    f"""
WITH {POINTS_SQL}
SELECT submission_id AS _submission_id, date, interval, kind, CASE WHEN date >= '2024-01-20' THEN views * 10 ELSE views END AS value FROM points""",
)
def merge_slices(spark, sf_dir):
    """A timeline stored in hash buckets; the merge rewrites those that keys of its delta fall into."""
    path, keys = work_dir(spark, "buckets"), landing.MERGE_KEYS["views_timeline"]
    points = records.views_timeline(spark, sf_dir).where("value > 0")
    store.replace_dataset(points.where("date < '2024-01-25'"), path, keys)
    late = points.where("date >= '2024-01-20'").withColumn("value", F.col("value") * 10)
    return store.merge_dataset(spark, path, late, keys, ["value"])


@query(
    "stream_upsert",
    """
SELECT event_id, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN value + 1 ELSE value END AS value FROM events""",
)
def stream_upsert(spark, sf_dir):
    """Landed files merged by a streaming query that is started twice; the second start sees only new files."""
    root = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    schema = T.StructType([f for f in events.schema.fields if f.name != "ts"])

    def land_and_merge(rows):
        rows.drop("ts").write.mode("append").json(f"{root}/landing")
        sync_stream(
            spark, f"{root}/landing", schema, f"{root}/events", ["event_id"], f"{root}/checkpoint"
        ).awaitTermination()

    land_and_merge(events.where("ts < '2024-01-20'"))
    land_and_merge(events.where("ts >= '2024-01-10'").withColumn("value", F.col("value") + 1))
    return store.read(spark, f"{root}/events")


@query(
    "sync_datasets",
    f"""
WITH {POINTS_SQL}
SELECT 'publications' AS dataset, l_orderkey AS id, '' AS part, CAST(max(l_linenumber) AS BIGINT) AS value FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'users', c_custkey, '', 1 FROM customer
UNION ALL SELECT 'publication_stats', CASE WHEN p_type <> 'PROMO' THEN p_partkey END, '', CAST(p_size AS BIGINT) FROM part
UNION ALL SELECT 'views_timeline', submission_id, date || ' ' || kind, CASE WHEN date >= '2024-01-19' THEN views * 10 ELSE views END FROM points
  WHERE submission_id IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')
""",
)
def sync_datasets(spark, sf_dir):
    """What the two runs leave of the other datasets: the last detail of each submission, all users, totals, and points of published submissions.

    The second run takes the points of its window, from a day before the first run on.
    """
    target = _synced_twice(spark, sf_dir, stats=True)

    def rows(df, dataset, key, part, value):
        return df.select(F.lit(dataset).alias("dataset"), F.expr(key).cast("bigint").alias("id"), F.expr(part).alias("part"), F.expr(value).cast("bigint").alias("value"))

    points = timeline.read_points(spark, f"{target}/views_timeline").where("value > 0")
    # A full load keeps all rows that landed; only a merge leaves one per submission.
    details = store.read(spark, f"{target}/publications").groupBy("_submission_id").agg(F.max("version").alias("version"))
    return (
        rows(details, "publications", "_submission_id", "''", "version")
        .unionByName(rows(store.read(spark, f"{target}/users"), "users", "id", "''", "1"))
        .unionByName(rows(store.read(spark, f"{target}/publication_stats"), "publication_stats", "publication.id", "''", "abstractViews"))
        .unionByName(rows(points, "views_timeline", "_submission_id", "concat(date, ' ', kind)", "value"))
    )


@query(
    "timeline_window",
    f"""
WITH {POINTS_SQL}
SELECT submission_id AS _submission_id, date, interval, kind, CASE WHEN date >= '2024-01-20' THEN views * 10 ELSE views END AS value,
       date >= '2024-01-20' AS rewritten FROM points""",
)
def timeline_window(spark, sf_dir):
    """A window of days merged into a timeline kept by day: ``rewritten`` says whether a row's file is a new one."""
    path, keys = work_dir(spark, "timeline"), landing.MERGE_KEYS["views_timeline"]
    points = records.views_timeline(spark, sf_dir).where("value > 0")
    stored = timeline.replace_points(points.where("date < '2024-01-25'"), path)
    file = F.col("_metadata.file_path")
    # A few files per day.
    before = [r[0] for r in stored.select(file).distinct().collect()]
    late = store.replace_dataset(points.where("date >= '2024-01-20'").withColumn("value", F.col("value") * 10), f"{path}-delta")
    merged = timeline.merge_points(spark, path, late, keys, ["value"])
    return merged.select("_submission_id", "date", "interval", "kind", "value", (~file.isin(before)).alias("rewritten"))


@query(
    "merge_counts",
    f"""
SELECT metric, CAST(count(*) AS BIGINT) AS value FROM (
  SELECT CASE WHEN ts > TIMESTAMP '{CUT}' THEN 'added' WHEN event_type = 'view' THEN 'changed' ELSE 'equal' END AS metric
  FROM events WHERE ts > TIMESTAMP '{CUT}' - INTERVAL 1 DAY) GROUP BY metric""",
)
def merge_counts(spark, sf_dir):
    """What a merge found in its delta: rows that are new, that change a stored row, and that are stored already."""
    path = work_dir(spark, "counts")
    old, _ = _old_and_new(spark, sf_dir)
    store.replace_dataset(old, path, ["event_id"])
    recent = table(spark, sf_dir, "events").select(*old.columns).where(F.col("ts") > F.lit(CUT).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    came = recent.withColumn("value", F.when(F.col("event_type") == "view", F.col("value") + 1).otherwise(F.col("value")))
    merged = store.merge_counted(spark, path, came, ["event_id"], ["ts"])
    return small_frame(spark, [(k, getattr(merged, k)) for k in ("added", "changed", "equal")], "metric string, value bigint").where("value > 0")


PROFILED_SQL = f"""
stored AS (
  SELECT event_id, user_id, CASE WHEN late AND event_type = 'click' THEN 'tap' ELSE event_type END AS event_type, props, 'web' AS channel,
         CASE WHEN late AND event_type = 'error' THEN 'late' END AS remark
  FROM (SELECT *, ts > TIMESTAMP '{CUT}' - INTERVAL 1 DAY AS late FROM events)
)"""
PROFILED = ("event_id", "user_id", "event_type", "props", "channel", "remark")


def _profiled(spark, sf_dir):
    """The folder of events that were stored and profiled up to a cut, then merged with what came later or says otherwise."""
    path = work_dir(spark, "profiled")
    events = table(spark, sf_dir, "events").withColumn("channel", F.lit("web")).withColumn("remark", F.lit(None).cast("string"))
    cut, kind = F.lit(CUT).cast("timestamp_ntz"), F.col("event_type")
    store.replace_dataset(events.where(F.col("ts") <= cut).select(*PROFILED), path, ["event_id"])
    profiles.refresh(spark, path)
    late = events.where(F.col("ts") > cut - F.expr("INTERVAL 1 DAY")).withColumn("remark", F.when(kind == "error", "late"))
    late = late.withColumn("event_type", F.when(kind == "click", "tap").otherwise(kind))
    store.merge_dataset(spark, path, late.select(*PROFILED, "ts"), ["event_id"], ["ts"])
    return path


def _profile_sql(column):
    text = f"CAST({column} AS VARCHAR)"
    return (
        f"SELECT '{column}' AS \"column\", count(*) AS \"rows\", count(*) - count({column}) AS nulls, min({text}) AS lowest, max({text}) AS highest, "
        f"count(DISTINCT {column}) AS distinct_values, true AS near FROM stored"
    )


@query("profile_over_runs", f"WITH {PROFILED_SQL} " + " UNION ALL ".join(_profile_sql(c) for c in PROFILED))
def profile_over_runs(spark, sf_dir):
    """A profile united from what two runs wrote, with exact distinct counts; ``near``: the sketches agree with them within their error."""
    path = _profiled(spark, sf_dir)
    sketched = profiles.dataset_profile(spark, path).select("column", F.col("distinct_values").alias("estimate"))
    exact = profiles.dataset_profile(spark, path, exact=True)
    near = F.abs(F.col("estimate") - F.col("distinct_values")) <= F.lit(profiles.DISTINCT_ERROR) * F.col("distinct_values")
    return exact.join(sketched, "column").withColumn("near", near).drop("estimate")


def _expected_sql(column, expected):
    value = "NULL" if expected is None else f"'{expected}'"
    return (
        f"SELECT '{column}' AS \"column\", CAST({value} AS VARCHAR) AS expected, count({column}) AS non_null, min({column}) AS lowest, max({column}) AS highest, "
        f"count({column}) FILTER (WHERE {column} IS DISTINCT FROM CAST({value} AS VARCHAR)) = 0 AS holds FROM stored"
    )


EXPECTED = {"channel": "web", "event_type": "view"}


@query("stored_expectations", f"WITH {PROFILED_SQL} " + " UNION ALL ".join(_expected_sql(c, v) for c, v in [("remark", None), *EXPECTED.items()]))
def stored_expectations(spark, sf_dir):
    """Columns that should be empty or constant, judged by the kept profile of a dataset that two runs wrote."""
    return profiles.expected_values(profiles.dataset_profile(spark, _profiled(spark, sf_dir)), ["remark"], EXPECTED)


@query(
    "landed_pages",
    """
SELECT c_custkey AS id, c_name AS user_name, CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(2 AS BIGINT) END AS n_groups, c_acctbal < 0 AS disabled FROM customer""",
)
def landed_pages(spark, sf_dir):
    """Accounts out of response pages of at most a hundred, in both forms, each page landed twice."""
    accounts = records.users(spark, sf_dir)
    page = F.floor(F.col("id") / 100)
    listed = accounts.groupBy(page.alias("page")).agg(F.to_json(F.collect_list(F.struct(*accounts.columns))).alias("items"), F.count("*").alias("n"))
    text = F.when(F.col("page") % 2 == 0, F.col("items")).otherwise(F.format_string('{"itemsMax": %d, "items": %s}', "n", "items"))
    pages = listed.select(text.alias("payload"), F.format_string("page %d", "page").alias("source"))
    read = unwrap_pages(pages.unionAll(pages), "payload", landing.schema_of("users"), "source")
    return read.select("id", F.col("userName").alias("user_name"), F.size("groups").cast("bigint").alias("n_groups"), "disabled")


@query(
    "sync_streamed",
    f"""
WITH dated AS (SELECT o_orderkey AS id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS ts FROM orders),
mark AS (SELECT max(ts) - INTERVAL 1 DAY AS m FROM dated WHERE ts <= TIMESTAMP '{SYNC_CUT}')
SELECT id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_activity,
       CASE WHEN ts <= (SELECT m FROM mark) THEN 'first' ELSE 'second' END AS loaded_by, '1' AS committed
FROM dated""",
)
def sync_streamed(spark, sf_dir):
    """The same two loads as files that land, through one stream: its second batch dies before its commit and is repeated by the next start."""
    root = work_dir(spark, "landing")
    everything, activity = records.submissions(spark, sf_dir), F.col("dateLastActivity")
    accounts = records.users(spark, sf_dir)

    def run(batch_of, label, fails=False):
        def before_commit(batch):
            if fails:
                raise RuntimeError(f"batch {batch} is lost")

        if batch_of is not None:
            batch_of.withColumn("statusLabel", F.lit(label)).write.mode("append").option("compression", "gzip").json(f"{root}/landing/submissions")
        clock = "2024-06-0{} 00:00:00".format
        stream = sync_landing(spark, f"{root}/landing", f"{root}/data", f"{root}/checkpoint", clock=lambda batch: clock(batch + 1), before_commit=before_commit, stats=False)
        try:
            stream.awaitTermination()
        except StreamingQueryException:
            if not fails:
                raise

    # JSON Lines repeat their field names: packed they take a tenth, and the stream reads them as they are.
    accounts.write.option("compression", "gzip").json(f"{root}/landing/users")
    run(everything.where(activity.isNull() | (activity <= SYNC_CUT)), "first")
    run(everything, "second", fails=True)
    run(None, "second")
    committed = mark_of(load_state(spark, f"{root}/data/state")["marks"], "batch")
    kept = store.read(spark, f"{root}/data/submissions")
    return kept.select("id", activity.alias("last_activity"), F.col("statusLabel").alias("loaded_by"), F.lit(committed).alias("committed"))
