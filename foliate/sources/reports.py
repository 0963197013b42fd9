"""Report exports landed as CSV."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.errors import MissingDataError
from foliate.sources.records import path_exists


CSV_FORM = {"quote": '"', "escape": '"', "multiLine": True}


def read_report_csv(spark: SparkSession, path: str | Sequence[str], by_blocks: bool = False) -> DataFrame:
    """A report with every column as text.

    Fields may hold line breaks and doubled quotes. A byte-order mark is removed
    and bytes that are not UTF-8 become U+FFFD. Because of the line breaks one file
    is one task; ``by_blocks`` reads a large export in as many tasks as it has blocks.
    """
    whole = spark.read.csv(path, header=True, inferSchema=False, **CSV_FORM)
    return _read_by_blocks(spark, path, whole.columns) if by_blocks else whole


def _read_by_blocks(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The same rows, in no order, from blocks that begin and end anywhere.

    A line begins a record if the quotes before it in its file are even in number. Quotes are
    summed inside each block, the sums of the blocks (one row each) from block to block, and both
    together say which lines begin one. Records of one line stay where they are; only lines of
    longer ones, and those at the end of a block, meet by the number of their record. Quotes must
    be what CSV makes of them: around a field, or doubled inside one.
    """
    text, at = F.make_valid_utf8("value"), F.monotonically_increasing_id()
    lines = spark.read.option("lineSep", "\n").text(path).select(
        text.alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), at.alias("row")
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    inside = Window.partitionBy("file", "block").orderBy("row")
    before = F.coalesce(F.sum(quotes).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = lines.withColumn("odd", before % 2)
    # Whether a block begins inside a field is not known yet, so both cases are counted.
    blocks = counted.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("flips"), F.count_if(F.col("odd") == 0).alias("even_starts"), F.count_if(F.col("odd") == 1).alias("odd_starts"), F.min_by(F.col("line").endswith("\r"), "row").alias("returns"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    entered = blocks.withColumn("within", F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("within") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    # A file whose first line ends in a carriage return has them before all its line breaks, and they are no data.
    whole_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = entered.select("file", "block", "within", F.coalesce(F.sum(starts).over(earlier), F.lit(0)).alias("records"), F.first("returns").over(whole_file).alias("returns"))
    begins = F.col("odd") == F.col("within")
    known = counted.join(offsets, ["file", "block"]).withColumn("begins", begins)
    known = known.withColumn("line", F.when(F.col("returns"), F.regexp_replace("line", r"\r\z", "")).otherwise(F.col("line")))
    number = F.col("records") + F.sum(F.col("begins").cast("bigint")).over(inside)
    alone = F.col("begins") & F.coalesce(F.lead("begins").over(inside), F.lit(False))
    placed = known.select("file", "block", "row", "line", number.alias("record"), alone.alias("alone"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "line")))
    longer = placed.where("NOT alone").groupBy("file", "record").agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("line"))
    # The first record of a file is its header.
    records = placed.where("alone").select("record", "line").unionByName(longer.select("record", "line")).where("record > 1")
    plain = [f"c{i}" for i in range(len(columns))]
    read = F.from_csv("line", ", ".join(f"{c} STRING" for c in plain), {k: str(v).lower() for k, v in CSV_FORM.items()})
    return records.where("line != ''").select(read.alias("cells")).select("cells.*").toDF(*columns)


def latest_snapshot(spark: SparkSession, directory: str, glob: str, explicit: str | None = None) -> str:
    """The newest export: the greatest name among the files that match ``glob``.

    Date-stamped names order like their dates. Only the listing is read.
    """
    if explicit is not None:
        if not path_exists(spark, explicit):
            raise MissingDataError(f"{explicit} not found")
        return explicit
    try:
        files = spark.read.format("binaryFile").load(f"{directory}/{glob}")
        newest = files.agg(F.max("path")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is None:
        raise MissingDataError(f"no file matching {glob} in {directory}")
    return newest


def reject_html_payload(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``path, is_html`` for landed files: a body that opens with ``<`` is a web page.

    Byte-order marks and white space before it do not count. Only lines of a file's
    first block are compared, and one line per file and task survives the map side,
    so the size of the files does not matter.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    opening = F.regexp_replace("value", r"(?U)^[\x{FEFF}\s]+", "")
    ordered = lines.withColumn("line", F.monotonically_increasing_id()).withColumn("opening", F.substring(opening, 1, 1))
    spoken = F.when((F.col("opening") != "") & (F.col("start") == 0), F.col("line"))
    return ordered.groupBy("path").agg(
        F.coalesce(F.min_by("opening", spoken) == "<", F.lit(False)).alias("is_html")
    )


def accepted_reports(spark: SparkSession, paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """The given files split into CSV to ingest and web pages to quarantine."""
    verdicts = {_plain_path(unquote(row["path"])): row["is_html"] for row in reject_html_payload(spark, list(paths)).collect()}
    pages = {p for p in paths if verdicts.get(_plain_path(p), False)}
    return [p for p in paths if p not in pages], [p for p in paths if p in pages]


def _plain_path(path: str) -> str:
    """The path part of a location, without scheme and host and with single slashes: the same for all its spellings."""
    return re.sub(r"/+", "/", re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path))
