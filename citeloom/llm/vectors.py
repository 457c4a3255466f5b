"""Which vectors of a table count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_whole(vector: Column) -> Column:
    """Whether a vector is there, has entries, and all of them are finite numbers."""
    number = lambda c: c.cast("double")
    bad = F.exists(
        vector,
        lambda c: c.isNull() | F.isnan(number(c)) | (number(c) == float("inf")) | (number(c) == float("-inf")),
    )
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def whole_vectors(rows: DataFrame, column: str = "vector") -> DataFrame:
    """The rows whose vector is whole and of the length that most of these have (of equal counts the longest).

    Entries missing at the end are null ones. The lengths are counted in one aggregation, of which
    one number reaches the driver.
    """
    rows = rows.where(is_whole(F.col(column)))
    usual = (
        rows.groupBy(F.size(column).alias("length"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max(F.struct("n", "length")).alias("usual"))
        .first()
        .usual
    )
    return rows.where(F.size(column) == F.lit(0 if usual is None else usual.length))
