"""Session settings and the shared-folder rule for checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliate.errors import OptionError


def build_session(master: str | None = None, app_name: str = "foliate", **conf: str) -> SparkSession:
    """A session with the settings the pipelines rely on.

    Only settings that hold at any scale are fixed here. Shuffle width is left to
    AQE: it starts from ``spark.sql.shuffle.partitions`` and coalesces or splits
    from the sizes it observes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Bounds an Arrow batch by bytes, so a run of long texts cannot build a huge one.
        "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only a
    single-machine session without one gets a temporary folder; on a cluster a
    missing setting is an error, because other machines could not read it.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise OptionError("set spark.checkpoint.dir to a folder every executor can read")
            configured = tempfile.mkdtemp(prefix="foliate-checkpoint-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and continue from the written rows.

    Everything derived from the result sees the same rows, whatever is recomputed
    after an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def list_folder(spark: SparkSession, path: str) -> dict[str, int]:
    """The names in a folder of any file system Spark can reach, with when each was changed (milliseconds); empty if it isn't there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName(): f.getModificationTime() for f in system.listStatus(folder)} if system.exists(folder) else {}


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, wherever Spark keeps it; nothing happens if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings, which are put back."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def broadcast_by_measure[T](job: Callable[..., T]) -> Callable[..., T]:
    """``job``, whose first argument is the session, with joins that are broadcast only by the measured size of a side, up to Spark's threshold.

    Before it has run, a side that is read from files counts as large as these are when compressed, a small
    part of what its keys and digests take in memory. AQE keeps a broadcast that was planned so,
    whatever it measures, if the other join needs one more shuffle; all of it then passes through the driver.
    """

    @wraps(job)
    def measured(spark: SparkSession, *args, **kwargs) -> T:
        planned, running = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
        most = spark.conf.get(running, None) or spark.conf.get(planned)
        with settings(spark, {planned: "-1", running: most}):
            return job(spark, *args, **kwargs)

    return measured


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Deal rows that come in few pieces over ``partitions``, before work that takes long for each row.

    One JSON array, one CSV with line breaks or one Parquet row group is one task, and
    so would be all per-row work behind it. This moves all rows once; it is for the
    caller, who knows how the input was landed, to ask for it.
    """
    return df.repartition(partitions)


def small_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A frame of driver-side rows (log lines, marks, documentation), handed over as Arrow."""
    schema = T.StructType.fromDDL(ddl)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), to_arrow_schema(schema), strict=True)]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)
