"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # split hot keys of a join even where that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # sides are broadcast by Spark's own check of their size only; no hints anywhere
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # the state of streams on disk, of which a batch writes its changes only
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # the expressions are large: do not record the Python call site of each of their parts
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# folders named by this process, so that a job can remove its own
_made: list[str] = []


def session(app: str = "citeloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are made for; partitions are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share, below the one the cluster names.

    Only a local session that names none gets a temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="citeloom-")
    folder = f"{base.rstrip('/')}/citeloom-{uuid.uuid4()}"
    _made.append(folder)
    return folder


def cut_lineage(df: DataFrame, rows_a_file: int = 0) -> DataFrame:
    """The frame written as a Parquet table in the shared folder, and read back.

    Lost executors then cost no recomputation, readers take only the columns they need,
    and the planner knows the true size when it picks a join. ``rows_a_file`` makes one task write several
    files, which many tasks can read.
    """
    folder = shared_folder(df.sparkSession)
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def temporary_cuts(spark: SparkSession) -> Iterator[None]:
    """Folders that ``cut_lineage`` writes inside the block are removed when the block ends.

    Frames that read them must be used up, or written, before that.
    """
    first = len(_made)
    try:
        yield
    finally:
        for folder in _made[first:]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        del _made[first:]


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """A scan dealt out over so many tasks, as it is without a number.

    Meant for a few files that do not split (gzip, or one row group) before costly expressions;
    a large dump has more files than there are cores and needs no such shuffle.
    """
    return df if partitions is None else df.repartition(partitions)
