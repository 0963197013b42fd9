"""Arrow helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliate.session import ensure_checkpoint_dir

#: Bytes of text that one step of numpy work takes at a time; a longer text is a step of its own.
STEP_BYTES = 2 << 20

#: What a task makes of a list of texts: one list (or array) per result column.
TextFunction = Callable[[list[str | None]], dict[str, Sequence]]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = STEP_BYTES, max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``max_bytes`` together, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + max_bytes, side="right"))
        stop = min(max(stop, start + 1), start + max_rows)
        yield batch.slice(start, stop - start)
        start = stop


def map_texts(df: DataFrame, make: Callable[[], TextFunction], fields: str | T.StructType, text: str = "text") -> DataFrame:
    """Replace the column ``text`` by the columns a function computes from it, in Arrow batches.

    ``make`` is called once per task and gives the function, so that what it sets up
    (compressors, tables, memos) lives as long as the task. The other columns pass
    through untouched; no row is moved.
    """
    added = T.StructType.fromDDL(fields) if isinstance(fields, str) else fields
    keep = [f for f in df.schema if f.name != text]
    new = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, text):
                made = fn(part.column(text).to_pylist())
                columns = [part.column(f.name) for f in keep] + [pa.array(made[f.name], f.type) for f in new]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([part.schema.field(f.name) for f in keep] + list(new)))

    return df.mapInArrow(run, T.StructType([*keep, *added.fields]))


def filter_texts(df: DataFrame, make: Callable[[], Callable[[list[str | None]], Sequence[bool]]], text: str = "text") -> DataFrame:
    """The rows for whose text the function says true; all columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array(fn(part.column(text).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def store(df: DataFrame, name: str) -> str:
    """Write the rows of ``df`` as a Parquet table of its own in the shared folder; its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, read from a table in the shared folder, of which later steps read the columns they need."""
    return df.sparkSession.read.parquet(store(df, name))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a stored table that nothing reads any more: what was computed from it is stored itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators read, so that no other column can clash with a result."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: Column) -> Column:
    """The fold of a row: the CRC-32 of its id as text, modulo 3. Fold 1 is held out of all learning."""
    return F.crc32(id_col.cast("string").cast("binary")) % 3


def held_out(id_col: Column) -> Column:
    """Whether a row is in the held-out fold; rows without an id are not."""
    return F.coalesce(fold(id_col) == 1, F.lit(False))


def learning(id_col: Column) -> Column:
    """Whether a row may be learned from: it has an id and isn't held out."""
    return F.coalesce(fold(id_col) != 1, F.lit(False))


def joined_bytes(texts: Sequence[bytes], pad: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array with ``pad`` zero bytes behind, and where each starts (one more at the end)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts) + bytes(pad), np.uint8), starts
