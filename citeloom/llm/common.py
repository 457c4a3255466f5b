"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows a Python worker turns into objects at once; Spark's batches are larger.
ROWS_AT_ONCE = 256

LETTERS_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` on batches of a few MB.

    Spark's default of 64 MB a batch is held several times over, inside and outside of the heap,
    by every task. A session that has set another size keeps it.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if df.sparkSession.conf.get(size) in ("67108864b", "64MB", "67108864"):
        df.sparkSession.conf.set(size, "4m")
    return df.mapInArrow(function, schema)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task in slices of ``ROWS_AT_ONCE`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, LETTERS_UP, LETTERS_UP.lower())


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def alive(docs: DataFrame, kept: DataFrame, id_col: str, kept_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is among the kept ids; a null id equals a null id."""
    return docs.join(kept, docs[id_col].eqNullSafe(kept[kept_col]), "left_semi")


def learnable(labels: DataFrame, limit: int, column: str) -> DataFrame:
    """Labels to learn from (labelled, label): known, not held out, at most ``limit``, in the order of a hash.

    Every fifth id by ``remainder`` is held out.
    """
    rows = labels.where((remainder(F.col("doc_id"), 5) != 0) & F.col(column).isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.select(F.col("doc_id").alias("labelled"), F.col(column).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(limit)
