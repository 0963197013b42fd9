"""Which physical files are still to be fetched, decided against a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions.multilingual import localized
from foliate.functions.text import review_round_id, safe_name, stage_label

TARGET_COLUMNS = (
    "submission_id",
    "submission_file_id",
    "file_id",
    "file_stage",
    "stage",
    "review_round_id",
    "url",
    "filename",
    "path",
)


def download_targets(files: DataFrame, include_revisions: bool = True) -> DataFrame:
    """One row per physical file of a record: the current upload, then its revisions.

    An entry without a file id or a URL is left out, and an id that a record
    repeats counts once, at its first usable place. All of this stays within the
    record's own array, so nothing is shuffled.
    """
    entries = F.array(F.struct(F.col("fileId").alias("fileId"), F.col("url").alias("url")))
    if include_revisions:
        earlier = F.coalesce(F.col("revisions"), F.array().cast("array<struct<fileId:bigint,url:string>>"))
        entries = F.concat(entries, earlier)
    usable = F.filter(entries, lambda e: F.coalesce((e["fileId"] != 0) & (e["url"] != ""), F.lit(False)))
    # Labels and names are settled once per record, before it is exploded.
    records = files.select(
        F.col("_submission_id").alias("submission_id"),
        F.col("id").alias("submission_file_id"),
        F.col("fileStage").alias("file_stage"),
        stage_label(F.col("fileStage")).alias("stage"),
        review_round_id(F.col("assocType"), F.col("assocId")).alias("review_round_id"),
        safe_name(localized(F.col("name"), fallback_any=True)).alias("__name"),
        usable.alias("__usable"),
    )
    entered = records.select("*", F.posexplode("__usable").alias("__place", "__entry"))
    first_of_its_id = F.array_position(F.col("__usable.fileId"), F.col("__entry.fileId")) == F.col("__place") + 1
    targets = entered.where(first_of_its_id).select(
        "submission_id",
        "submission_file_id",
        F.col("__entry.fileId").alias("file_id"),
        "file_stage",
        "stage",
        "review_round_id",
        F.col("__entry.url").alias("url"),
        F.concat(F.col("__entry.fileId").cast("string"), F.lit("_"), F.col("__name")).alias("filename"),
    )
    folder = F.coalesce(F.col("submission_id").cast("string"), F.lit("None"))
    return targets.withColumn("path", F.concat_ws("/", folder, F.col("stage"), F.col("filename")))


def is_contained(path: Column) -> Column:
    """True for a relative path without a parent step."""
    return ~path.startswith("/") & ~path.rlike(r"(^|/)\.\.(/|\z)")


def guard_paths(df: DataFrame, column: str = "path") -> DataFrame:
    """Fail the job on a path that would leave the download folder."""
    path = F.col(column)
    refusal = F.raise_error(F.concat(F.lit("refusing path outside the download folder: "), path)).cast("string")
    return df.withColumn(column, F.when(is_contained(path) | path.isNull(), path).otherwise(refusal))


def download_plan(
    files: DataFrame,
    manifest: DataFrame | None,
    include_revisions: bool = True,
    on_disk: DataFrame | None = None,
    guard: bool = True,
) -> DataFrame:
    """Targets that are not yet recorded under the path they resolve to now.

    A renamed file is planned again and brings the recorded path as ``stale_path``.
    With ``on_disk``, a listing with a ``path`` column, a recorded file that is
    missing from it is planned again as well. Without ``guard`` the caller sees to paths
    that leave the download folder.
    """
    targets = download_targets(files, include_revisions)
    targets = guard_paths(targets) if guard else targets
    if manifest is None:
        return targets.withColumn("stale_path", F.lit(None).cast("string"))
    recorded = manifest.select(F.col("file_id").alias("__file_id"), F.col("path").alias("__path"))
    if on_disk is not None:
        here = on_disk.select(F.col("path").alias("__here")).distinct()
        recorded = recorded.join(here, F.col("__path") == F.col("__here"), "left").withColumn(
            "__lost", F.col("__here").isNull()
        )
    else:
        recorded = recorded.withColumn("__lost", F.lit(False))
    joined = targets.join(recorded, F.col("file_id") == F.col("__file_id"), "left")
    due = F.col("__file_id").isNull() | ~F.col("path").eqNullSafe(F.col("__path")) | F.col("__lost")
    stale = F.when(F.col("__path") != F.col("path"), F.col("__path"))
    return joined.where(due).select(*TARGET_COLUMNS, stale.alias("stale_path"))
