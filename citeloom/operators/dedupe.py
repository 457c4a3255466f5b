"""Keep-first and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from citeloom.constants import BATCH_END_MARK
from citeloom.functions.values import is_version_copy
from citeloom.session import cut_lineage


def drop_version_copies(df: DataFrame, doi: str = "id", plain_publisher: str = "publisher_text") -> DataFrame:
    return df.where(~is_version_copy(doi, plain_publisher))


def file_batches(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """``(file_path, file_rank, batch)`` of distinct dump files.

    Files are taken in descending order of their path; a new batch starts after each file
    whose name carries the closing mark. Two passes of a prefix sum: paths are dealt out by range and
    counted, then numbered within their range from what the ranges before it hold. Of each range
    two numbers reach the driver, so no task sees all paths.
    """
    spark = files.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    closing = F.contains("file_path", F.lit(BATCH_END_MARK))
    ranged = files.select("file_path").distinct().repartitionByRange(partitions, F.desc("file_path"))
    # written, as the limits of the ranges come from a sample
    ranged = cut_lineage(ranged.select("file_path", closing.alias("closing"), F.spark_partition_id().alias("part")))
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"), F.count_if("closing").alias("n_closing")).collect()
    offsets, files_before, closed_before = [], 0, 0
    for row in sorted(counts):
        offsets.append((row.part, files_before, closed_before))
        files_before, closed_before = files_before + row.n, closed_before + row.n_closing
    before = spark.createDataFrame(offsets, "part int, files_before long, closed_before long")
    order = Window.partitionBy("part").orderBy(F.desc("file_path"))
    closed = F.count_if("closing").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return ranged.join(before, "part").select(
        "file_path",
        (F.row_number().over(order) + F.col("files_before")).alias("file_rank"),
        (closed + F.col("closed_before")).alias("batch"),
    )


def keep_first(
    df: DataFrame, key: str, batch: list[str], order: list[Column | str], row_id: str
) -> DataFrame:
    """First row of each key within its batch; rows without a key all stay.

    A row without a key becomes its own group, so no null group piles up. The rank filter
    is turned into a limit per group *before* the shuffle: of a hot key each task sends on
    one row.
    """
    group = F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("r"), F.col(row_id).cast("string")))
    w = Window.partitionBy(*batch, group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def flag_duplicates(df: DataFrame, key: str) -> DataFrame:
    """Every row with ``has_duplicate``.

    Counting first and joining the repeated keys back keeps a hot key out of a single
    window partition.
    """
    repeated = duplicate_keys(df, key).select(key, F.lit(True).alias("has_duplicate"))
    return df.join(repeated, key, "left").fillna(False, ["has_duplicate"])


def first_of(df: DataFrame, keys: list[str], order: Column | str, columns: list[str]) -> DataFrame:
    """First row of each group by an explicit order."""
    first = F.min_by(F.struct(*columns), order).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def most_frequent(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value per group, ties to the one seen first; nulls count as values."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    best = F.max_by(value, F.struct("n", -F.col("seen"))).alias(value)
    return counts.groupBy(*keys).agg(best)
