"""Upserts of landed files as they arrive: one dataset (``sync_stream``), or all of a landing folder (``sync_landing``).

The file source remembers which files it has read and the checkpoint advances only
after a batch is merged. A batch that is repeated after a failure merges to the
same rows, because the upsert is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from foliate.operators.merge import ARRIVAL, Key
from foliate.plans import jobs, landing
from foliate.schema import quoted
from foliate.session import list_folder, remove_path
from foliate.sources import store
from foliate.sources.records import unwrap_pages


def landed_stream(
    spark: SparkSession, folder: str, schema: T.StructType, multiline: bool = False, max_files: int | None = None
) -> DataFrame:
    """Records of a landing folder as a stream, with when and where each one landed."""
    reader = spark.readStream.schema(schema).option("multiLine", multiline)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder).select(
        "*",
        F.col("_metadata.file_modification_time").alias("_landed_at"),
        F.col("_metadata.file_name").alias("_landed_file"),
    )


def sync_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: str,
    keys: Sequence[Key],
    checkpoint: str,
    multiline: bool = False,
    max_files: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Merge every newly landed file into the dataset at ``target``.

    Within a batch the last record of a key wins: by landing time, then file name,
    then place in the file. With ``available_now`` the query stops when it has
    caught up.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        # Written once: the merge reads the batch for its buckets, its keys and its rows.
        arrived = batch.withColumn("_seq", F.monotonically_increasing_id())
        staged = store.replace_dataset(arrived, f"{checkpoint}/staged")
        store.merge_dataset(batch.sparkSession, target, staged, keys, list(ARRIVAL))
        for path in (target, f"{checkpoint}/staged"):
            store.vacuum(batch.sparkSession, path)

    stream = landed_stream(spark, folder, schema, multiline, max_files)
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _now(_: int) -> str:
    return datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def _records(staged: DataFrame, name: str, pages: bool) -> DataFrame:
    """The records of one dataset out of a staged batch, with their order of arrival."""
    rows, schema = staged.where(F.col("dataset") == name), landing.schema_of(name)
    if pages:
        return unwrap_pages(rows, "value", schema, "landed", arrival=True)
    order = F.struct(F.col("landed").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("row"))
    return rows.select(F.from_json("value", schema).alias("record"), order.alias("_seq")).select("record.*", "_seq")


def merge_batch(
    batch: DataFrame, batch_id: int, target: str, pages: bool = False, clock: Callable[[int], str] = _now, before_commit: Callable[[int], None] | None = None, **options
) -> DataFrame:
    """Bring the datasets under ``target`` up to date with one batch of landed texts; the run's metrics.

    The batch is first written whole, with the time of its run. If it is repeated, it is read
    from there, so a repetition does to the letter what the first attempt would have done. The
    number of the batch is committed together with the marks, after every dataset: a batch that
    was committed changes nothing, one that wasn't merges again to the same rows.
    """
    spark, folder = batch.sparkSession, f"{target}/staged"
    path = f"{folder}/batch={batch_id}"
    if "_SUCCESS" not in list_folder(spark, path):
        staged = batch.withColumns({"row": F.monotonically_increasing_id(), "run_ts": F.lit(clock(batch_id))})
        staged.write.mode("overwrite").option("compression", store.COMPRESSION).partitionBy("dataset").parquet(path)
    schema = T.StructType.fromDDL("value string, landed string, row bigint, run_ts string, dataset string")
    staged = spark.read.schema(schema).parquet(path)
    present = {r["dataset"]: r["run_ts"] for r in staged.groupBy("dataset").agg(F.min("run_ts").alias("run_ts")).collect()}
    landed = {name: _records(staged, name, pages) if name in present else None for name in landing.SCHEMAS_DDL}
    run_ts = min(present.values()) if present else clock(batch_id)
    hook = None if before_commit is None else lambda: before_commit(batch_id)
    metrics = jobs.sync(spark, landed, target, run_ts, batch=batch_id, before_commit=hook, **options)
    for name in list_folder(spark, folder):
        if name != f"batch={batch_id}":
            remove_path(spark, f"{folder}/{name}")
    return metrics


def sync_landing(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    *,
    pages: bool = False,
    max_files: int | None = None,
    available_now: bool = True,
    clock: Callable[[int], str] = _now,
    before_commit: Callable[[int], None] | None = None,
    **options,
) -> StreamingQuery:
    """Keep all datasets of a landing folder in step, by one query: marks, overlap, skipped details, windows and files of their own.

    ``folder`` has one folder per dataset, of JSON Lines or, with ``pages``, of response
    pages. All files that arrive between two batches are one incremental run of
    ``jobs.sync``, whose further ``options`` can be given. A file is taken once it
    has landed; of records with one key the last counts, by the landing time and name of its file, then its place.
    """
    stream = spark.readStream.format("text").option("wholetext", pages)
    if max_files is not None:
        stream = stream.option("maxFilesPerTrigger", max_files)
    at, file = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    texts = stream.load(f"{folder}/{{{','.join(landing.SCHEMAS_DDL)}}}").select(
        "value", F.concat_ws(" ", F.date_format(at, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.element_at(F.split(file, "/"), -1)).alias("landed"), F.element_at(F.split(file, "/"), -2).alias("dataset")
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, target, pages, clock, before_commit, **options)

    writer = texts.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def seen_counts(seen: DataFrame, ts_col: str = "last_activity") -> DataFrame:
    """How many records a state table tracks, and how many carry an activity time."""
    return seen.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("tracked"), F.count(quoted(ts_col)).alias("with_activity")
    )
