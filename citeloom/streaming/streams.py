"""The same records as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.functions.records import parse_records

MONDAY = "4 days"  # windows count from a Thursday


def stream_dump(spark: SparkSession, root: str, pattern: str = "*.jsonl.gz") -> DataFrame:
    """Raw records of files as they arrive; the checkpoint of the query remembers the files done."""
    lines = (
        spark.readStream.format("text")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )
    return parse_records(lines, keep=("file_path",))


def slice_counts(rows: DataFrame, ts: str, interval: str) -> DataFrame:
    """Rows per update slice: slice_start, slice_end, n_rows. Rows without a time are in no slice."""
    offset = MONDAY if "week" in interval or interval == "7 days" else None
    window = F.window(ts, interval, startTime=offset) if offset else F.window(ts, interval)
    counted = rows.groupBy(window.alias("w")).agg(F.count("*").alias("n_rows"))
    return counted.select(F.col("w.start").alias("slice_start"), F.col("w.end").alias("slice_end"), "n_rows")


def stream_slice_counts(stream: DataFrame, ts: str, interval: str, delay: str) -> DataFrame:
    """Rows per closed update slice; ``delay`` is how much later than its slice a row may still come.

    In append mode a slice is written once, when the watermark has passed it, and leaves the state then, which
    so holds the slices of about one delay. Rows that come later than that are not counted here, and the
    last slices stay open: :func:`slice_count_sink` counts both.
    """
    return slice_counts(stream.withWatermark(ts, delay), ts, interval)


def batch_sink(path: str, made: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: what is made of a micro-batch goes to a folder of its own, and replaces it on a retry."""

    def write(batch: DataFrame, batch_id: int) -> None:
        made(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def slice_count_sink(path: str, ts: str, interval: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: the rows each micro-batch adds to its slices, however late they are.

    A batch is counted on its own, so nothing is kept between batches; :func:`read_slice_counts` adds up.
    """
    return batch_sink(path, lambda batch: slice_counts(batch, ts, interval))


def read_slice_counts(spark: SparkSession, path: str) -> DataFrame:
    """All rows of each slice that :func:`slice_count_sink` has written, open slices included."""
    parts = spark.read.parquet(path)
    return parts.groupBy("slice_start", "slice_end").agg(F.sum("n_rows").alias("n_rows"))


def stream_keep_first(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    """One row per key within the watermark; which one of a micro-batch is not defined.

    Rows without a key are no duplicates of each other: they all pass, beside the state.
    """
    marked = stream.withWatermark(ts, delay)
    first = marked.where(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return first.union(marked.where(F.col(key).isNull()))


def stream_keep_first_in_order(stream: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """Rows whose key no earlier micro-batch has had; of one batch the first by ``order``.

    To be run in update mode. The state store holds the first row of each key, so a batch looks up
    its own keys only and reads nothing of what was written before; rows of a hot key are combined before the
    shuffle. A key is new when all its rows carry the time of one batch, which Spark keeps for
    retries. ``order`` is ascending. Rows without a key all pass, beside the state.
    """
    arrived = stream.withColumn("_arrived", F.current_timestamp())
    place = F.struct("_arrived", *order)
    state = arrived.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.min_by(F.struct(*stream.columns), place).alias("_first"),
        F.min("_arrived").alias("_earliest"),
        F.max("_arrived").alias("_latest"),
    )
    new = state.where("_earliest = _latest").select("_first.*")
    return new.union(stream.where(F.col(key).isNull()))


def run_available(stream: DataFrame, checkpoint: str, **sink) -> None:
    """Process what is there and stop. ``sink`` gives ``path`` and ``format``, or ``foreach_batch`` and ``mode``."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if "foreach_batch" in sink:
        writer = writer.outputMode(sink.get("mode", "append")).foreachBatch(sink["foreach_batch"])
    else:
        writer = writer.format(sink["format"]).option("path", sink["path"])
    writer.start().awaitTermination()
