"""Nested records landed as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.errors import MissingDataError
from foliate.operators.merge import with_arrival
from foliate.schema import quoted
from foliate.session import spread


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can list ``path``, on whatever file system it names."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_records(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = True, arrival: bool = True, partitions: int | None = None
) -> DataFrame:
    """Records of a dataset with an explicit schema.

    ``multiline`` reads files that hold one JSON array; such a file is one task.
    JSON Lines (``multiline=False``) splits freely and is the form to land large
    datasets in. With ``arrival`` the order of files and records is kept as ``_seq``, so
    that a later "last one wins" has a meaning: files count in the order of their names.
    ``partitions`` deals the records out, which pays for arrays in few files.
    """
    records = spark.read.schema(schema).option("multiLine", multiline).json(path)
    records = with_arrival(records) if arrival else records
    return records if partitions is None else spread(records, partitions)


def read_datasets(
    spark: SparkSession,
    directory: str,
    required: Mapping[str, T.StructType],
    optional: Mapping[str, T.StructType],
    multiline: bool = True,
    pages: bool = False,
) -> dict[str, DataFrame | None]:
    """Every dataset of a landing folder; an absent optional one is ``None``.

    A dataset is ``<name>.json`` (a file, or a folder of parts) or the folder ``<name>``.
    Spark's readers leave out files whose names begin with an underscore, so such a dataset
    (``_submissions``) lands as a folder of that name. With ``pages`` every file is a response
    page, as the service sent it.

    Raises:
        MissingDataError: naming the first required dataset that is absent.
    """
    found: dict[str, DataFrame | None] = {}
    for name, schema in {**required, **optional}.items():
        candidates = [f"{directory}/{name}"] if name.startswith("_") else [f"{directory}/{name}.json", f"{directory}/{name}"]
        path = next((p for p in candidates if path_exists(spark, p)), None)
        if path is None and name in required:
            raise MissingDataError(f"{candidates[0]} not found")
        read = (lambda p, s: read_pages(spark, p, s)) if pages else (lambda p, s: read_records(spark, p, s, multiline))
        found[name] = None if path is None else read(path, schema)
    return found


def read_pages(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Records of a folder whose files are response pages, in the order of the pages' names (``_seq``)."""
    pages = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("__file"))
    return unwrap_pages(pages, "value", schema, "__file", arrival=True)


def unwrap_pages(df: DataFrame, payload_col: str, schema: T.StructType, source_col: str | None = None, arrival: bool = False) -> DataFrame:
    """Records out of landed response pages.

    A page is a JSON array or an ``{items, itemsMax}`` envelope; anything else fails
    the job, naming the page's source and the start of its text. A page that
    repeats another verbatim is taken once: pages are matched by digest, so copies
    collapse before they are shuffled. A page is parsed once, into a variant, and its
    records come out of that one at a time; no array of typed records is built. With
    ``arrival`` their order is kept as ``_seq``: the page's source, then the place in it.
    """
    payload = quoted(payload_col)
    source = quoted(source_col) if source_col else F.lit("a landed page")
    pages = (
        df.select(payload.alias("__payload"), source.alias("__source"), F.sha2(payload, 256).alias("__digest"))
        .groupBy("__digest")
        .agg(F.first("__payload").alias("__payload"), F.min("__source").alias("__source"))
    )
    page, listed = F.try_parse_json("__payload"), F.col("__items")
    refusal = F.raise_error(
        F.concat(F.lit("unexpected response shape from "), F.col("__source"), F.lit(": "), F.substring("__payload", 1, 300))
    ).cast("variant")
    has_items = F.coalesce(F.array_contains(F.json_object_keys("__payload"), "items"), F.lit(False))
    items = F.when(F.schema_of_variant(page).startswith("ARRAY"), page).when(has_items & page.isNotNull(), F.variant_get(page, "$.items", "variant")).otherwise(refusal)
    spark = df.sparkSession
    lists = pages.select("__source", items.alias("__items")).where(F.schema_of_variant(listed).startswith("ARRAY"))
    each = lists.lateralJoin(spark.tvf.variant_explode(listed.outer()))
    # Read from the text of the record, as a file of records would be: one odd value never fails the rest.
    record = F.from_json(F.to_json("value"), schema)
    if not arrival:
        return each.select(record.alias("__record")).select("__record.*")
    order = F.struct(F.col("__source").alias("file"), F.lit(0).cast("bigint").alias("block"), F.col("pos").cast("bigint").alias("row"))
    return each.select(record.alias("__record"), order.alias("_seq")).select("__record.*", "_seq")
