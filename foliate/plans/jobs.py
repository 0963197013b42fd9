"""End-to-end jobs: normalize, sync, plan downloads, document."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.errors import DataError, MissingDataError, OptionError
from foliate.functions.dates import require_iso_date
from foliate.functions.nested import any_child_in
from foliate.operators.downloads import download_plan, is_contained
from foliate.operators.filters import changed_since, date_window, of_interval, require_interval, select_files, stage_ids
from foliate.operators.joins import ambiguous_keys, order_of, require_some_keys, rows_of_ids, skip_unchanged
from foliate.operators.merge import high_water_mark, window_start
from foliate.operators.quality import RunMetrics, profile
from foliate.plans import api, landing, specs
from foliate.plans.articles import articles_checks, normalize_articles
from foliate.plans.reviews import normalize_reviews
from foliate.schema import TableSpec
from foliate.session import broadcast_by_measure, remove_path, small_frame
from foliate.sources import profiles, store, timeline
from foliate.sources.records import read_datasets
from foliate.sources.reports import accepted_reports, latest_snapshot, read_report_csv
from foliate.sources.sinks import schema_docs, write_schema_docs, write_tables
from foliate.sources.state import commit_state, load_state, mark_of, seen_from, seen_of


@dataclass(frozen=True)
class ReportSpec:
    """How one report is found, normalized and documented."""

    glob: str
    normalize: Callable[[DataFrame], dict[str, DataFrame]]
    tables: tuple[TableSpec, ...]
    checks: Callable[[DataFrame], dict[str, DataFrame]] | None = None


REPORTS: dict[str, ReportSpec] = {
    "articles": ReportSpec("articles-*.csv", normalize_articles, specs.ARTICLE_TABLES, articles_checks),
    "reviews": ReportSpec("reviews-*.csv", normalize_reviews, specs.REVIEW_TABLES),
}


def report_spec(report: str) -> ReportSpec:
    if report not in REPORTS:
        raise OptionError(f"unknown report {report!r}; expected one of: {', '.join(sorted(REPORTS))}")
    return REPORTS[report]


def _by_name(tables: Sequence[TableSpec]) -> dict[str, TableSpec]:
    return {t.name: t for t in tables}


def run_normalize_api(
    spark: SparkSession, api_dir: str, out_dir: str, fmt: str = "parquet", multiline: bool = True, pages: bool = False
) -> DataFrame:
    """Normalize a landing folder into its tables; returns the run's metrics.

    JSON is parsed once: each dataset is first written as Parquet, and every table
    reads only its columns from there. Submissions is written before publications
    is built on it, so the HTML of the abstracts is cleaned once. With ``pages`` the folder
    holds response pages.
    """
    landed = read_datasets(spark, api_dir, landing.required_schemas(), landing.optional_schemas(), multiline, pages)
    datasets = {
        name: None if df is None else store.replace_dataset(df, f"{out_dir}/staging/landed/{name}")
        for name, df in landed.items()
    }
    metrics = RunMetrics()
    tables = api.normalize_api(datasets)
    submissions = store.replace_dataset(tables["submissions"], f"{out_dir}/staging/submissions")
    publications, lost = api.publications_with_loss(submissions, datasets["publications"])
    tables |= {"submissions": submissions, "publications": publications}
    write_tables(
        tables, _by_name(specs.API_TABLES), out_dir, fmt, metrics, extra={"authors": {"matched": F.count("user_id")}}
    )
    metrics.add("publications", "lost", lost.first()["lost"])
    write_checks({"ambiguous_emails": ambiguous_keys(datasets["users"], "email", "id")}, out_dir)
    return metrics.to_df(spark)


def run_normalize_report(
    spark: SparkSession,
    report: str,
    out_dir: str,
    downloads_dir: str | None = None,
    input_file: str | None = None,
    fmt: str = "parquet",
    by_blocks: bool = False,
) -> DataFrame:
    """Normalize the newest export of a report (or the given file); returns the run's metrics.

    The export is parsed once into Parquet and every table is built from that. ``by_blocks``
    parses it in many tasks.
    """
    spec = report_spec(report)
    if input_file is None and downloads_dir is None:
        raise OptionError("give downloads_dir or input_file")
    source = latest_snapshot(spark, downloads_dir or "", spec.glob, input_file)
    accepted, pages = accepted_reports(spark, [source])
    if pages:
        raise DataError(f"{source} is a web page, not a CSV export")
    raw = read_report_csv(spark, accepted, by_blocks)
    # Parquet field names may not hold every character a header does, so the staged
    # table has plain names and the headers are put back on top of it.
    plain = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    staged = store.replace_dataset(plain, f"{out_dir}/staging/{report}").toDF(*raw.columns)
    metrics = RunMetrics()
    write_tables(spec.normalize(staged), _by_name(spec.tables), out_dir, fmt, metrics)
    if spec.checks:
        write_checks(spec.checks(staged), out_dir)
    return metrics.to_df(spark)


def write_checks(checks: Mapping[str, DataFrame], out_dir: str) -> None:
    """Write what a run found out about its input to ``checks/<name>``, beside the tables."""
    for name, found in checks.items():
        found.write.mode("overwrite").parquet(posixpath.join(out_dir, "checks", name))


def run_download_plan(
    spark: SparkSession,
    files: DataFrame,
    manifest: DataFrame | None = None,
    submission_ids: Sequence[int] | None = None,
    submissions: DataFrame | None = None,
    file_type: str = "all",
    file_stages: Sequence[int] | None = None,
    revisions: bool = True,
    on_disk: DataFrame | None = None,
    guard: bool = True,
) -> DataFrame:
    """What is still to be downloaded for the chosen submissions and stages.

    Explicit ids must have stored file records, at least one of them. Without ids
    the given submissions are used, else every file record.
    """
    stage_ids(file_type, file_stages)
    ids = None
    if submission_ids:
        ids = small_frame(spark, [(int(i),) for i in submission_ids], "id bigint")
        require_some_keys(ids, files, "_submission_id")
    elif submissions is not None:
        ids = submissions.select("id")
    chosen = select_files(files, ids, file_type, file_stages)
    return download_plan(chosen, manifest, revisions, on_disk, guard)


UNSAFE_PATH = "path outside the download folder"


def plan_downloads(spark: SparkSession, files: DataFrame, target: str, **options) -> DataFrame:
    """Write what is due under ``target`` to ``plan`` and return it.

    What ``record_downloads`` wrote down before is left out. A path that would leave the download
    folder is no reason to stop: its file goes to ``refused`` and not into the plan.
    """
    manifest = store.read(spark, f"{target}/manifest")
    due = run_download_plan(spark, files, manifest, guard=False, **options)
    planned = store.replace_dataset(due.withColumn("__safe", F.coalesce(is_contained(F.col("path")), F.lit(True))), f"{target}/plan")
    unsafe = planned.where(~F.col("__safe")).select("file_id", "path", F.lit(UNSAFE_PATH).alias("reason"))
    if not unsafe.isEmpty():
        append_manifest(spark, f"{target}/refused", unsafe)
    store.vacuum(spark, f"{target}/plan")
    return planned.where("__safe").drop("__safe")


def record_downloads(spark: SparkSession, target: str, outcomes: DataFrame) -> DataFrame:
    """Write down what came of a plan; returns ``outcome, files``.

    ``outcomes`` has ``file_id``, ``path`` and ``reason``, which is null for a file that was
    stored. Stored files go to ``manifest`` and are not planned again; the others go to
    ``refused`` with their reason, and stay due. A file recorded before is replaced in either.
    """
    staged = store.replace_dataset(outcomes.select("file_id", "path", "reason"), f"{target}/outcomes")
    stored, refused = staged.where("reason IS NULL").drop("reason"), staged.where("reason IS NOT NULL")
    for name, rows in (("manifest", stored), ("refused", refused)):
        if not rows.isEmpty():
            append_manifest(spark, f"{target}/{name}", rows)
        store.vacuum(spark, f"{target}/{name}")
    store.vacuum(spark, f"{target}/outcomes")
    return staged.groupBy(F.when(F.col("reason").isNull(), "stored").otherwise("refused").alias("outcome")).agg(F.count("*").alias("files"))


def append_manifest(spark: SparkSession, path: str, records: DataFrame) -> DataFrame:
    """Record downloaded (or refused) files; a file id recorded before is replaced."""
    return store.merge_dataset(spark, path, records, ["file_id"], order_of(records))


class _Run:
    """The datasets of one sync run and what it counted."""

    def __init__(self, spark: SparkSession, target: str, incremental: bool, buckets: int | None, landed_rows: Mapping[str, int], dealt: bool = False) -> None:
        self.spark, self.target, self.incremental, self.buckets, self.landed_rows = spark, target, incremental, buckets, landed_rows
        self.dealt = dealt
        self.metrics = RunMetrics()

    def load(self, name: str, records: DataFrame, merge: bool | None = None, of: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
        """Merge or replace a dataset; returns what this run brought and the whole dataset.

        A replaced dataset is written once, straight from the records. A delta is
        staged first, because it is read for its keys, its rows and its count; of dealt records
        only the last of each key, and what this run brought are the records themselves. ``of``: only
        records whose key is the ``id`` of one of these rows.
        """
        path = f"{self.target}/{name}"
        keys = landing.MERGE_KEYS.get(name, ())
        buckets = self.buckets or store.buckets_for(self.landed_rows.get(name, 0))
        # Files are kept by their own ids, but looked up by their submissions'.
        dealt = self.dealt and bool(keys) and name != "submission_files"
        replaced = not (self.incremental if merge is None else merge)
        if dealt and not replaced:
            last = store.last_of(records, keys, order_of(records), buckets, of)
            last = store.replace_dataset(last, f"{self.target}/delta/{name}", keys, buckets, dealt=True)
            merged = store.merge_counted(self.spark, path, last.drop(store.RECORDS), keys, order_of(records), buckets, latest=True)
            fetched = last.agg(F.sum(store.RECORDS)).first()[0] or 0
            return records, self._counted(name, merged, fetched)
        if of is not None:
            # The rows of a full load are looked up where they are written, so they move once.
            records = store.of_ids(records, keys[0], of, "id", buckets, dealt) if replaced else rows_of_ids(records, keys[0], of, "id")
        if replaced:
            saved = store.replace_dataset(records.drop("_seq"), path, keys, buckets, dealt=dealt or of is not None)
            return saved, self._counted(name, store.Merged(saved, 0, 0, 0), saved.count(), ())
        delta = store.replace_dataset(records, f"{self.target}/delta/{name}")
        merged = store.merge_counted(self.spark, path, delta, keys, order_of(delta), self.buckets)
        return delta, self._counted(name, merged, delta.count())

    def _counted(self, name: str, merged: store.Merged, fetched: int, changes: Sequence[str] = ("added", "changed", "equal")) -> DataFrame:
        """The rows of a dataset that was just written. Their number is read from the footers, not the rows."""
        for metric in changes:
            self.metrics.add(name, metric, getattr(merged, metric))
        self.metrics.add(name, "fetched", fetched)
        self.metrics.add(name, "total", merged.rows.count())
        store.vacuum(self.spark, f"{self.target}/{name}")
        return merged.rows

    def load_points(self, name: str, points: DataFrame) -> None:
        """Merge or replace a timeline, which is kept by granularity and day."""
        path = f"{self.target}/{name}"
        if self.incremental:
            delta = store.replace_dataset(points, f"{self.target}/delta/{name}")
            saved = timeline.merge_points(self.spark, path, delta, landing.MERGE_KEYS[name], order_of(delta))
            self.metrics.add(name, "fetched", delta.count())
        else:
            saved = timeline.replace_points(points.drop("_seq"), path)
            self.metrics.add(name, "fetched", saved.count())
        self.metrics.add(name, "total", saved.count())


@broadcast_by_measure
def sync(
    spark: SparkSession,
    landed: str | Mapping[str, DataFrame | None],
    target: str,
    run_ts: str,
    *,
    incremental: bool = False,
    since: str | None = None,
    full: bool = False,
    stats: bool = True,
    files: bool = False,
    stats_interval: str = "day",
    stats_since: str | None = None,
    stats_until: str | None = None,
    user_details: bool = False,
    user_roles: Sequence[int] | None = None,
    multiline: bool = True,
    pages: bool = False,
    buckets: int | None = None,
    batch: int | None = None,
    before_commit: Callable[[], None] | None = None,
    staged: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Bring the datasets under ``target`` up to date from a landing folder.

    A plain run replaces every dataset. An incremental run (or one with ``since``)
    merges what changed after the stored mark; without a mark it is a full load. A
    ``full`` run replaces everything and resets the marks. Marks are written last,
    and only by incremental and full runs. ``run_ts`` (``Y-m-d H:i:s``) is the one
    time stamp of the run. With ``pages`` the folder holds response pages. ``buckets`` is the number every dataset is kept in; without it, it
    follows the rows of the first load. ``staged`` says that the landed frames are projections of stored
    tables, cheap to read again; others are first written to Parquet. ``dealt`` says that they come from
    ``store.deal`` by their merge keys and ``buckets``, so that none is dealt out again. The last two versions of a dataset are kept.

    ``batch`` is the number of a streamed batch: its run is incremental, datasets that did not land
    with it are left alone, users merge, and a number that is committed already changes nothing.
    ``before_commit`` is called when everything but the state is written. Returns ``dataset, metric,
    value`` rows: records ``fetched``, of these ``added``, ``changed`` and ``equal`` to what was
    stored, submissions whose details were ``skipped`` as unchanged, and the ``total``.
    """
    if full and (incremental or since):
        raise OptionError("full cannot be combined with incremental/since")
    if user_roles and not user_details:
        raise OptionError("user_roles requires user_details")
    for option, value in (("since", since), ("stats_since", stats_since), ("stats_until", stats_until)):
        require_iso_date(option, value)
    if stats:
        require_interval(stats_interval)
    incremental = incremental or since is not None or batch is not None
    if dealt and not (staged and buckets):
        raise OptionError("dealt frames need staged and buckets")
    if batch is not None and full:
        raise OptionError("a streamed batch cannot be a full run")

    if isinstance(landed, str):
        landed = read_datasets(spark, landed, landing.required_schemas(), landing.optional_schemas(), multiline, pages)
    missing = [name for name in landing.REQUIRED if landed.get(name) is None]
    if missing and batch is None:
        raise MissingDataError(f"dataset {missing[0]} has not landed")

    state_dir = f"{target}/state"
    state = load_state(spark, state_dir)
    if not incremental:
        state = {name: frame.limit(0) for name, frame in state.items()}
    if batch is not None and int(mark_of(state["marks"], "batch") or -1) >= batch:
        repeated = RunMetrics()
        repeated.add("run", "repeated_batch", batch)
        return repeated.to_df(spark)
    # Parsed once: most datasets are read several times.
    landed = {name: df if df is None or staged else store.replace_dataset(df, f"{target}/landed/{name}") for name, df in landed.items()}
    rows = {} if buckets else {name: df.count() for name, df in landed.items() if df is not None}
    seen = seen_of(state["seen"], "submissions")
    mark = since or (high_water_mark(seen, "last_activity") if incremental else None)
    run = _Run(spark, target, batch is not None or (incremental and mark is not None), buckets, rows, dealt)

    def landed_now(name: str) -> bool:
        return landed.get(name) is not None

    def newer(name: str) -> DataFrame:
        return changed_since(landed[name], mark, "dateLastActivity") if run.incremental else landed[name]

    brought = merged = None
    if landed_now("submissions"):
        brought, merged = run.load("submissions", newer("submissions"))
        if dealt and run.incremental:
            # What is asked of it below, once.
            brought = store.replace_dataset(brought.select("id", "dateLastActivity"), f"{target}/delta/brought")
    if landed_now("_submissions"):
        run.load("_submissions", newer("_submissions"))

    if brought is not None:
        changed = brought
        if run.incremental:
            changed = skip_unchanged(brought, seen, "id", "dateLastActivity")
            run.metrics.add("submissions", "skipped", brought.count() - changed.count())
        if landed_now("publications"):
            run.load("publications", landed["publications"], of=changed)

    if files and merged is not None and landed_now("submission_files"):
        due = merged
        if run.incremental:
            due = skip_unchanged(merged, seen_of(state["seen"], "files"), "id", "dateLastActivity")
            run.metrics.add("submission_files", "skipped", merged.count() - due.count())
        run.load("submission_files", rows_of_ids(landed["submission_files"], "_submission_id", due, "id"))

    users = None
    if landed_now("users"):
        _, users = run.load("users", landed["users"], merge=batch is not None)

    if user_details and users is not None and landed_now("user_details"):
        chosen = users.where(any_child_in(F.col("groups"), "roleId", user_roles or []))
        run.load("user_details", landed["user_details"].withColumn("_fetched_at", F.lit(run_ts)), merge=True, of=chosen)

    stats_ok = False
    if stats and (landed_now("publication_stats") or (batch is not None and any(map(landed_now, TIMELINES)))):
        start = stats_since
        if start is None and run.incremental:
            # A stream's general mark moves with every batch, so only its own mark says from where points are missing.
            start = window_start(state["marks"], "stats", fallback=None if batch is not None else "all")
        stats_ok = _sync_stats(run, landed, stats_interval, start, stats_until)

    if before_commit is not None:
        before_commit()
    if incremental or full:
        _commit(spark, state_dir, state, brought, merged, run_ts, stats_ok, files, run.incremental, batch)
        if merged is not None:
            run.metrics.add("submissions", "tracked", merged.count())
    for done in ("landed", "delta"):
        remove_path(spark, f"{target}/{done}")
    run.metrics.add("run", "incremental", run.incremental)
    run.metrics.add("run", "stats_ok", stats_ok)
    run.metrics.add("run", "sync_state_written", incremental or full)
    return run.metrics.to_df(spark)


#: The period series; the cumulative totals beside them are no series.
TIMELINES = ("views_timeline", "views_timeline_totals")


def _sync_stats(
    run: _Run, landed: Mapping[str, DataFrame | None], interval: str, start: str | None, end: str | None
) -> bool:
    """Cumulative totals are replaced whole; only the period series are windowed and merged. False if no totals are known."""
    if landed.get("publication_stats") is not None:
        totals, _ = run.load("publication_stats", landed["publication_stats"], merge=False)
    else:
        totals = store.read(run.spark, f"{run.target}/publication_stats")
        if totals is None:
            return False
    published = totals.select(F.col("publication.id").alias("id"))
    for name in TIMELINES:
        points = landed.get(name)
        if points is None:
            continue
        points = date_window(of_interval(points, interval), "date", start, end)
        if name == "views_timeline":
            points = rows_of_ids(points, "_submission_id", published, "id")
        run.load_points(name, points)
    return True


def _commit(
    spark: SparkSession,
    state_dir: str,
    state: Mapping[str, DataFrame],
    brought: DataFrame | None,
    merged: DataFrame | None,
    run_ts: str,
    stats_ok: bool,
    files: bool,
    merge: bool,
    batch: int | None,
) -> None:
    """Advance what this run loaded; carry over what it did not."""
    marks = {"all": run_ts, "stats": run_ts if stats_ok else mark_of(state["marks"], "stats")}
    marks["batch"] = mark_of(state["marks"], "batch") if batch is None else str(batch)
    if merged is None:
        seen = state["seen"].limit(0)
    else:
        seen = seen_from(brought if merge else merged, "submissions")
        if files:
            seen = seen.unionByName(seen_from(merged, "files"))
    if not merge and not files:
        seen = seen.unionByName(state["seen"].where(F.col("dataset") == "files"))
    commit_state(spark, state_dir, marks, seen, merge)
    for name in ("marks", "seen"):
        store.vacuum(spark, f"{state_dir}/{name}")


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, column_name, rows, nulls, distinct_values`` over several tables."""
    parts = [
        profile(df).select(F.lit(name).alias("table_name"), F.col("column").alias("column_name"), "rows", "nulls", "distinct_values")
        for name, df in tables.items()
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def profile_datasets(spark: SparkSession, target: str, names: Sequence[str]) -> DataFrame:
    """``dataset, column, rows, nulls, lowest, highest, distinct_values`` of the stored datasets a sync keeps in ``target``.

    Reads only what syncs have written since the last profile; distinct counts are estimates
    (``sources.profiles``). Timelines, kept by day, and datasets never written are left out.
    """
    found = None
    for name in names:
        path = f"{target}/{name}"
        if store.read(spark, path) is None:
            continue
        profiles.refresh(spark, path)
        profiles.vacuum(spark, path)
        part = profiles.dataset_profile(spark, path).select(F.lit(name).alias("dataset"), "*")
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise MissingDataError(f"none of {', '.join(names)} was ever written to {target}")
    return found


def run_schema_catalog(
    spark: SparkSession, out_dir: str, group: str, tables: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Write the documentation table of a table group; returns its columns per table.

    With ``tables``, each documented column carries its row, null and distinct counts.
    """
    if group not in specs.TABLE_GROUPS:
        raise OptionError(f"unknown table group {group!r}; expected one of: {', '.join(sorted(specs.TABLE_GROUPS))}")
    docs = schema_docs(spark, specs.TABLE_GROUPS[group], profile_tables(tables) if tables else None)
    return write_schema_docs(docs, posixpath.join(out_dir, "table_schemas"))
