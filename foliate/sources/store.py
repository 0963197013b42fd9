"""Datasets kept as hash buckets of their keys, and one pointer that names the current directories.

``<path>/data/<id>/`` directories are written once and never changed.
``<path>/pointer/v=<n>`` names the directory of each bucket and the keys that bucket by;
it is written last, so a run that dies leaves readers on the previous state. A
pointer is never overwritten: of two writers that start from one version the second is
refused, on file systems where making a folder that exists fails. A merge rewrites only the
buckets that hold a row it adds or changes; rows of the delta that are stored as they come
rewrite nothing. Stored rows aren't shuffled for it: the places of those that are replaced go
out to the scan, a bit for each row. ``vacuum`` removes what only older versions name.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.errors import DataError, OptionError
from foliate.operators.merge import ARRIVAL, Key, last_wins_of
from foliate.schema import quoted
from foliate.session import broadcast_by_measure, list_folder, remove_path, settings, small_frame

POINTER_SCHEMA = "bucket int, dir string, keys string"
#: A merge rewrites one bucket at least: give a large dataset as many as make one a task's work.
BUCKETS = 16
#: A dataset whose number of rows is known gets a bucket for each of so many.
ROWS_PER_BUCKET = 1 << 20
#: A version is written once and kept beside another one: half as large as by Spark's default for text.
COMPRESSION = "zstd"
#: The one directory of a dataset that has no keys, or no rows.
WHOLE = -1
#: A task whose rows come bucket after bucket keeps so many files open instead of sorting its rows by bucket.
OPEN_FILES = 64
#: Up to so many stored rows, the places of replaced ones are broadcast (64 MB); beyond, or with more files a bucket, stored rows are dealt out again.
PLACED_ROWS = 1 << 29
FILES_PER_BUCKET = 8
#: A bitmap of Spark's holds so many bits.
BITS = 1 << 15
#: How many records a row of ``last_of`` stands for.
RECORDS = "__records"


@dataclass(frozen=True)
class Layout:
    """Which directory holds each bucket now, the keys that bucket by, and the version that says so."""

    path: str
    dirs: Mapping[int, str]
    keys: str
    version: int

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None) -> DataFrame | None:
        wanted = self.dirs if buckets is None else set(buckets) & set(self.dirs)
        return spark.read.parquet(*(f"{self.path}/{self.dirs[b]}" for b in sorted(wanted))) if wanted else None


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that were written to their end, by a listing: of a table with many versions only one pointer is read."""
    numbers = sorted(int(name[2:]) for name in list_folder(spark, f"{path}/pointer") if name.startswith("v="))
    return [v for v in numbers if "_SUCCESS" in list_folder(spark, f"{path}/pointer/v={v}")]


def layout(spark: SparkSession, path: str) -> Layout:
    """The layout of the last completed write; no directories for a dataset never written."""
    versions = _versions(spark, path)
    if not versions:
        return Layout(path, {}, "", 0)
    rows = spark.read.schema(POINTER_SCHEMA).json(f"{path}/pointer/v={versions[-1]}").collect()
    return Layout(path, {r["bucket"]: r["dir"] for r in rows}, rows[0]["keys"], versions[-1])


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The current rows; ``None`` for a dataset never written."""
    return layout(spark, path).read(spark)


def _named(keys: Sequence[Key], buckets: int) -> str:
    # The function is named too: other ones deal the same keys out otherwise.
    return f"{buckets} buckets of {', '.join(str(k) for k in keys)} by hash" if keys else ""


def _texts(keys: Sequence[Key]) -> list[Column]:
    """Keys count as text, so that one key has one bucket whatever its width as a number; a null is no key's text."""
    return [F.coalesce(F.concat(F.lit("="), (k if isinstance(k, Column) else quoted(k)).cast("string")), F.lit("")) for k in keys]


def _bucket(keys: Sequence[Key], buckets: int) -> Column:
    """The bucket of a row: the partition that ``repartition`` by the texts of its keys deals it to."""
    return F.pmod(F.hash(*_texts(keys)), F.lit(buckets)).cast("int")


def deal(df: DataFrame, keys: Sequence[Key], buckets: int) -> DataFrame:
    """``df`` with a partition for each bucket of its keys. Projections that keep the keys stay dealt, so narrow rows can move before wide ones are made of them."""
    return df.repartition(buckets, *_texts(keys))


def _met(rows: DataFrame, keys: Sequence[Key], others: DataFrame, other_keys: Sequence[Key], buckets: int, how: str, dealt: bool = False) -> DataFrame:
    """The rows whose keys are (``left_semi``) or are not (``left_anti``) among those of ``others``, dealt out by bucket: whole rows move once, or not if ``dealt``."""
    names = [f"__mine{i}" for i in range(len(keys))]
    mine = rows.withColumns(dict(zip(names, _texts(keys), strict=True)))
    mine = mine if dealt else mine.repartition(buckets, *names)
    theirs = [f"__their{i}" for i in range(len(names))]
    met = others.select(*[t.alias(n) for t, n in zip(_texts(other_keys), theirs, strict=True)]).distinct().repartition(buckets, *theirs)
    same = None
    for a, b in zip(names, theirs, strict=True):
        test = F.col(a) == F.col(b)
        same = test if same is None else same & test
    return mine.join(met, same, how).drop(*names)


def of_ids(df: DataFrame, key: str, ids: DataFrame, id_col: str, buckets: int, dealt: bool = False) -> DataFrame:
    """The rows whose key is among ``ids``, dealt out by buckets of the key; null ids are ignored. ``dealt``: they are already."""
    wanted = ids.select(quoted(id_col).alias("__id")).where(F.col("__id").isNotNull())
    return _met(df, [key], wanted, ["__id"], buckets, "left_semi", dealt)


def last_of(df: DataFrame, keys: Sequence[Key], order_cols: Sequence[str], buckets: int, ids: DataFrame | None = None) -> DataFrame:
    """The last row per key of a frame from ``deal``, with the number of its records, where it was dealt to: nothing moves. ``ids``: only rows whose first key is an ``id`` of theirs."""
    if ids is not None:
        df = of_ids(df, keys[0], ids, "id", buckets, dealt=True)
    names = [f"__mine{i}" for i in range(len(keys))]
    cells = F.struct(*[quoted(c) for c in df.columns])
    order = F.struct(*[quoted(c) for c in order_cols])
    dealt = df.select(*[t.alias(n) for t, n in zip(_texts(keys), names, strict=True)], cells.alias("__row"), order.alias("__order"))
    return dealt.groupBy(*names).agg(F.max_by("__row", "__order").alias("__row"), F.count("*").alias(RECORDS)).select("__row.*", RECORDS)


def _open_files(spark: SparkSession) -> AbstractContextManager[None]:
    """Tasks that meet few buckets write them without a sort, which would hold or spill all their rows."""
    return settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)})


def _write(df: DataFrame, before: Layout, keys: Sequence[Key], buckets: int, replaced: Iterable[int] | None, dealt: bool = False) -> DataFrame:
    """Write ``df`` in place of some buckets, or of all, then the pointer; returns the rows of the new state. ``dealt``: rows of ``df`` come bucket after bucket."""
    spark, path = df.sparkSession, before.path
    dirs = {} if replaced is None else {b: d for b, d in before.dirs.items() if b not in set(replaced) and b != WHOLE}
    target = f"data/{uuid.uuid4().hex}"
    if keys:
        placed = df.withColumn("__bucket", _bucket(keys, buckets))
        # Rebalance by bucket: few files per bucket, and a large one is split over several tasks.
        placed = placed if dealt else placed.hint("rebalance", "__bucket")
        with _open_files(spark) if dealt else nullcontext():
            placed.write.option("compression", COMPRESSION).partitionBy("__bucket").parquet(f"{path}/{target}")
        # As many names as there are buckets at most.
        written = spark.read.schema("__bucket int").parquet(f"{path}/{target}").select("__bucket").distinct().collect()
        dirs |= {r[0]: f"{target}/__bucket={r[0]}" for r in written}
    if not dirs:
        target = f"data/{uuid.uuid4().hex}"
        df.write.option("compression", COMPRESSION).parquet(f"{path}/{target}")
        dirs = {WHOLE: target}
    after = Layout(path, dirs, _named(keys, buckets), before.version + 1)
    pointer = small_frame(spark, [(b, d, after.keys) for b, d in sorted(dirs.items())], POINTER_SCHEMA)
    try:
        pointer.coalesce(1).write.mode("errorifexists").json(f"{path}/pointer/v={after.version}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise DataError(f"{path}: another writer has made version {after.version}") from e
    return after.read(spark)


def buckets_for(rows: int) -> int:
    """How many buckets a dataset of so many rows is written in: a power of two, 16 at least."""
    return max(BUCKETS, 1 << max(0, (-(-rows // ROWS_PER_BUCKET) - 1)).bit_length())


def recorded_buckets(at: Layout) -> int | None:
    """The number of buckets a dataset is kept in; ``None`` for one without keys."""
    found = re.match(r"(\d+) buckets of ", at.keys)
    return int(found[1]) if found else None


def replace_dataset(df: DataFrame, path: str, keys: Sequence[Key] = (), buckets: int = BUCKETS, dealt: bool = False) -> DataFrame:
    """Make ``df`` the whole dataset and return it as written. ``keys``: those later merges go by, if there are any. ``dealt``: ``df`` comes from ``deal`` or ``of_ids``."""
    return _write(df, layout(df.sparkSession, path), keys, buckets, None, dealt)


@dataclass(frozen=True)
class Merged:
    """The rows after a merge, and how many rows of the delta were added, changed a stored row, or were stored already."""

    rows: DataFrame
    added: int
    changed: int
    equal: int


def merge_dataset(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[Key], order_cols: Sequence[str], buckets: int | None = None
) -> DataFrame:
    """``merge_counted`` without the counts."""
    return merge_counted(spark, path, new, keys, order_cols, buckets).rows


@broadcast_by_measure
def merge_counted(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[Key], order_cols: Sequence[str], buckets: int | None = None, latest: bool = False
) -> Merged:
    """Upsert ``new`` into the dataset.

    ``new`` is read several times: stage what is costly to compute. Order columns that
    only say what arrived last (``ARRIVAL``) aren't stored in a new dataset. Without
    ``buckets`` the recorded number stays, or a new dataset gets ``BUCKETS``. ``latest``: ``new``
    is stored in the same buckets and has one row per key, the last.

    Raises:
        OptionError: when the dataset is kept in other buckets; a key would then be looked for in the wrong one.
    """
    before = layout(spark, path)
    buckets = buckets or recorded_buckets(before) or BUCKETS
    if not before.dirs:
        target = [c for c in new.columns if c not in order_cols or c not in ARRIVAL]
        rows = _write((new if latest else last_wins_of(new, keys, order_cols)).select(*[quoted(c) for c in target]), before, keys, buckets, None, dealt=latest)
        return Merged(rows, rows.count(), 0, 0)
    if before.keys != _named(keys, buckets):
        raise OptionError(f"{path} is kept in {before.keys or 'one piece'}, not in {_named(keys, buckets)}")
    met = [r[0] for r in new.select(_bucket(keys, buckets)).distinct().collect()]
    if not met:
        return Merged(before.read(spark), 0, 0, 0)
    existing = before.read(spark, met)
    if existing is None:
        # Only new buckets: the stored rows say nothing but the columns.
        existing = before.read(spark).limit(0)
    counts = {(r["bucket"], r["change"]): r["n"] for r in _compared(existing, new, keys, order_cols, buckets, latest).groupBy("bucket", "change").agg(F.count("*").alias("n")).collect()}
    sums = {kind: sum(n for (_, k), n in counts.items() if k == kind) for kind in ("added", "changed", "equal")}
    touched = sorted({b for b, kind in counts if kind != "equal"})
    if not touched:
        return Merged(before.read(spark), **sums)
    came = new.where(_bucket(keys, buckets).isin(touched))
    merged = (came if latest else deal(last_wins_of(came, keys, order_cols), keys, buckets)).drop(*[c for c in order_cols if c not in existing.columns])
    kept = before.read(spark, touched)
    if kept is not None:
        if kept.count() <= PLACED_ROWS and len(kept.inputFiles()) <= FILES_PER_BUCKET * len(touched):
            left = _left(kept, keys, came, buckets)
        else:
            left = _met(kept, keys, came, keys, buckets, "left_anti")
        merged = left.unionByName(merged, allowMissingColumns=True)
    # All buckets keep the stored types; a row that lacks a stored column has null there.
    cells = [(quoted(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in existing.schema]
    more = [quoted(c) for c in merged.columns if c not in existing.columns]
    rows = _write(merged.select(*cells, *more), before, keys, buckets, touched, dealt=True)
    return Merged(rows, **sums)


def _left(kept: DataFrame, keys: Sequence[Key], came: DataFrame, buckets: int) -> DataFrame:
    """Stored rows whose keys are not among those of ``came``, as the scan gives them: only their keys and places are shuffled."""
    names, place = [f"__mine{i}" for i in range(len(keys))], ("__bucket", "__file", "__block")
    at = F.col("_metadata.row_index")
    where = [_bucket(keys, buckets), F.col("_metadata.file_name"), F.expr(f"_metadata.row_index div {BITS}")]
    where = [c.alias(n) for c, n in zip(where, place, strict=True)]
    stored = kept.select(*[t.alias(n) for t, n in zip(_texts(keys), names, strict=True)], *where, F.pmod(at, F.lit(BITS)).alias("__bit"))
    replaced = _same_texts(stored, names, came, keys, buckets)
    bits = replaced.groupBy(*place).agg(F.bitmap_construct_agg("__bit").alias("__bits"))
    rows = kept.select("*", *where, F.pmod(at, F.lit(BITS)).cast("int").alias("__bit")).join(F.broadcast(bits), list(place), "left")
    # Bit n is bit n % 8 of byte n / 8, from the lowest.
    byte = F.conv(F.hex(F.expr("substring(__bits, __bit div 8 + 1, 1)")), 16, 10).cast("int")
    gone = F.getbit(byte, F.col("__bit") % 8) == 1
    return rows.where(F.col("__bits").isNull() | ~gone).select(*[quoted(c) for c in kept.columns])


def _same_texts(stored: DataFrame, names: Sequence[str], came: DataFrame, keys: Sequence[Key], buckets: int) -> DataFrame:
    """The rows of ``stored`` whose texts in ``names`` are those of a key of ``came``."""
    theirs = [f"__their{i}" for i in range(len(names))]
    wanted = came.select(*[t.alias(n) for t, n in zip(_texts(keys), theirs, strict=True)]).distinct().repartition(buckets, *theirs)
    same = None
    for a, b in zip(names, theirs, strict=True):
        test = F.col(a) == F.col(b)
        same = test if same is None else same & test
    return stored.repartition(buckets, *names).join(wanted, same, "left_semi")


def _compared(existing: DataFrame, new: DataFrame, keys: Sequence[Key], order_cols: Sequence[str], buckets: int, latest: bool = False) -> DataFrame:
    """``bucket`` and ``change`` of each key of the delta: ``added``, ``changed`` or ``equal``, by digests of the rows."""
    stored = existing.schema
    more = [c for c in new.columns if c not in stored.names and c not in order_cols]
    names = [f"__k{i}" for i in range(len(keys))]

    def digested(df: DataFrame, digest: str, *others: Column) -> DataFrame:
        # The text of a row names its fields, so a null can't be taken for another column's. Two rows of one key are compared: half of a SHA-256 tells them apart.
        cells = [(quoted(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in stored]
        row = F.substring(F.unhex(F.sha2(F.to_json(F.struct(*cells)), 256)), 1, 16)
        return df.select(*[t.alias(n) for t, n in zip(_texts(keys), names, strict=True)], row.alias(digest), *others)

    # Only digests move, of the delta's last rows too, and once: the join goes by the texts that both sides are grouped by.
    if latest:
        arrived = digested(new, "__new")
    else:
        ordered = digested(new, "__new", F.struct(*[quoted(c) for c in order_cols]).alias("__order"))
        arrived = ordered.groupBy(*names).agg(F.max_by("__new", "__order").alias("__new"))
    present = digested(existing, "__old").groupBy(*names).agg(F.min("__old").alias("__old"), F.count("*").alias("__copies"))
    change = F.when(F.col("__copies").isNull(), "added").when((F.col("__old") == F.col("__new")) & (F.col("__copies") == 1) & F.lit(not more), "equal").otherwise("changed")
    bucket = F.pmod(F.hash(*names), F.lit(buckets)).cast("int")
    return arrived.join(present, names, "left").select(bucket.alias("bucket"), change.alias("change"))


def vacuum(spark: SparkSession, path: str, keep: int = 2, lost_after_hours: float = 24) -> int:
    """Remove the directories that none of the last ``keep`` versions names, and the pointers before them; how many directories went.

    Readers of the kept versions are not disturbed. A directory that no version names, left by
    a run that died or made by one that is still writing, goes once it is that old.
    """
    if keep < 1:
        raise OptionError("keep one version at least")
    versions = _versions(spark, path)
    folders = list_folder(spark, f"{path}/data")
    if len(versions) <= keep and all(time.time() * 1000 - changed <= lost_after_hours * 3_600_000 for changed in folders.values()):
        return 0
    pointers = spark.read.schema(POINTER_SCHEMA).option("basePath", f"{path}/pointer").json([f"{path}/pointer/v={v}" for v in versions]) if versions else None
    named = {(r["v"], r["dir"]) for r in pointers.select("v", "dir").collect()} if versions else set()
    live = {d for v, d in named if v in versions[-keep:]}
    gone = {d for _, d in named} - live
    # The pointers go first: a version without its directories must not be readable.
    for v in versions[:-keep]:
        remove_path(spark, f"{path}/pointer/v={v}")
    for d in gone:
        remove_path(spark, f"{path}/{d}")
    used = {d.split("/")[1] for d in live}
    known = {d.split("/")[1] for _, d in named}
    for name, changed in folders.items():
        lost = name not in known and time.time() * 1000 - changed > lost_after_hours * 3_600_000
        if lost or name in known - used:
            remove_path(spark, f"{path}/data/{name}")
        if lost:
            gone.add(f"data/{name}")
    return len(gone)
