"""Harvest bookkeeping: time slices, coverage, registries of jobs and files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from citeloom.constants import SLICE_PREFIX, SLICE_STAMP

SECONDS = {"minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}

HARVEST_STATE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("number_missed", T.IntegerType()),
        T.StructField("number_slices", T.IntegerType()),
        T.StructField("start_date", T.TimestampType()),
        T.StructField("end_date", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("current_directory", T.StringType()),
        T.StructField("processed", T.BooleanType()),
        T.StructField("slice_type", T.StringType()),
    ]
)
PROCESS_STATE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("number_of_dois", T.IntegerType()),
        T.StructField("number_of_dois_with_null_attributes", T.IntegerType()),
        T.StructField("number_of_non_null_dois", T.IntegerType()),
        T.StructField("process_date", T.TimestampType()),
        T.StructField("processed", T.BooleanType()),
    ]
)
PYTHON_TYPES = {
    T.IntegerType(): int,
    T.LongType(): int,
    T.StringType(): str,
    T.BooleanType(): bool,
    T.TimestampType(): datetime,
}


def slice_length(interval: str) -> str:
    """Known interval names as they are, anything else means minutes."""
    return interval if interval in (*SECONDS, "month") else "minute"


def time_slices(spark: SparkSession, start: datetime, end: datetime, interval: str = "minute") -> DataFrame:
    """Half-open slices ``[slice_start, slice_end)`` that cover ``[start, end)``; the last may be short.

    Slices come from a distributed range, not from one exploded array.
    """
    interval = slice_length(interval)
    begin, stop = F.lit(start), F.lit(end)
    if interval == "month":
        count = max(0, (end.year - start.year) * 12 + end.month - start.month + 1)

        def edge(n: Column) -> Column:
            return F.timestamp_add("MONTH", n.cast("int"), begin)

    else:
        length = SECONDS[interval]
        count = max(0, -int(-(end - start).total_seconds() // length))

        def edge(n: Column) -> Column:
            return F.timestamp_add("SECOND", (n * length).cast("int"), begin)

    return (
        spark.range(count)
        .select(edge(F.col("id")).alias("slice_start"), F.least(edge(F.col("id") + 1), stop).alias("slice_end"))
        .where(F.col("slice_start") < stop)
    )


def calendar(bounds: DataFrame, interval: str = "minute") -> DataFrame:
    """The slices of :func:`time_slices` for bounds that are data: one row with columns ``start`` and ``end``.

    The calendar is part of the plan, so nothing runs before the result is asked for. Null bounds
    give no slices.
    """
    interval = slice_length(interval)
    unit = "MONTH" if interval == "month" else "SECOND"
    length = 1 if interval == "month" else SECONDS[interval]
    span = F.timestamp_diff(unit, F.col("start"), F.col("end"))
    # whole slices that fit, and one more that may be short or begin at the end
    last = F.floor(span / length).cast("int")
    edges = bounds.where("start < end").select("start", "end", F.explode(F.sequence(F.lit(0), last)).alias("i"))

    def edge(i: Column) -> Column:
        return F.timestamp_add(unit, (i * length).cast("int"), F.col("start"))

    return edges.select(
        edge(F.col("i")).alias("slice_start"), F.least(edge(F.col("i") + 1), F.col("end")).alias("slice_end")
    ).where(F.col("slice_start") < F.col("slice_end"))


def slice_name(start: Column | str, end: Column | str, prefix: str = SLICE_PREFIX) -> Column:
    """Name of the file of a slice, without its suffix."""
    return F.concat(
        F.lit(prefix), F.date_format(start, SLICE_STAMP), F.lit("-"), F.date_format(end, SLICE_STAMP)
    )


def assign_slices(df: DataFrame, ts: str, interval: str = "minute") -> DataFrame:
    """Rows with the calendar slice of a timestamp; weeks start on Monday."""
    interval = slice_length(interval)
    start = F.date_trunc(interval, ts)
    end = F.timestamp_add(interval.upper(), F.lit(1), start)
    return df.withColumns({"slice_start": start, "slice_end": end})


def in_window(df: DataFrame, ts: str, start: datetime | Column, end: datetime | Column) -> DataFrame:
    """Rows updated from start to end, both included; the limits may be scalar subqueries."""
    return df.where(F.col(ts).between(F.lit(start), F.lit(end)))


def pending_slices(slices: DataFrame, found: DataFrame, prefix: str = SLICE_PREFIX) -> DataFrame:
    """Slices whose file is not among ``found(name)`` yet."""
    named = slices.withColumn("name", slice_name("slice_start", "slice_end", prefix))
    return named.join(found.select("name"), "name", "left_anti")


def slice_coverage(
    slices: DataFrame, found: DataFrame, start: datetime | Column, end: datetime | Column, prefix: str = SLICE_PREFIX
) -> DataFrame:
    """One row: expected slices, found files, missed, and the status of the job.

    A file counts when its name lies strictly between the names of the two limits, as text.
    """
    low, high = (F.concat(F.lit(prefix), F.date_format(F.lit(t), SLICE_STAMP)) for t in (start, end))
    inside = found.where(F.contains("name", F.lit(prefix)) & (F.col("name") > low) & (F.col("name") < high))
    expected = slices.select(F.lit(1).alias("expected"), F.lit(0).alias("found"))
    downloaded = inside.select(F.lit(0).alias("expected"), F.lit(1).alias("found"))
    counts = expected.unionByName(downloaded).agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("number_slices"),
        F.coalesce(F.sum("found"), F.lit(0)).alias("number_found"),
    )
    missed = F.col("number_slices") - F.col("number_found")
    return counts.select(
        "number_slices",
        "number_found",
        missed.alias("number_missed"),
        F.when(missed == 0, "done").otherwise("error").alias("status"),
    )


def first_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the first by the values of all columns, in their order."""
    return df.groupBy(*keys).agg(F.min(F.struct(*df.columns)).alias("_first")).select("_first.*")


def register_job(state: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """New jobs that may start: none of the same directory and dates exists without error.

    Of equal new jobs the one with the smallest id starts, unless ``force`` lets all of them. A
    job in a known directory takes over the slice type of the first job there.
    """
    keys = ["current_directory", "start_date", "end_date"]
    new = new if force else first_rows(new, keys)
    accepted = new if force else new.join(state.where("status != 'error'").select(*keys), keys, "left_anti")
    first = state.groupBy("current_directory").agg(F.min_by("slice_type", "id").alias("_first"))
    return (
        accepted.join(first, "current_directory", "left")
        .withColumn("slice_type", F.coalesce("_first", "slice_type"))
        .select(*new.columns)
    )


def check_conditions(df: DataFrame, values: dict) -> None:
    """Unknown columns and values of another type are errors."""
    kinds = {f.name: PYTHON_TYPES.get(f.dataType) for f in df.schema.fields}
    for name, value in values.items():
        if name not in kinds:
            raise ValueError(f"no column {name!r} in this state table")
        if type(value) is not kinds[name]:
            raise TypeError(f"column {name!r} takes {kinds[name]}, not {type(value)}")


def _matches(where: dict) -> Column:
    condition = F.lit(True)
    for name, value in where.items():
        condition = condition & (F.col(name) == F.lit(value))
    return condition


def query_state(state: DataFrame, where: dict | None = None) -> DataFrame:
    """Rows that equal the given values, by id."""
    check_conditions(state, where or {})
    return state.where(_matches(where or {})).orderBy("id")


def update_state(state: DataFrame, values: dict, where: dict | None = None) -> DataFrame:
    """State table with the given values set in the matching rows."""
    check_conditions(state, values)
    check_conditions(state, where or {})
    hit = F.coalesce(_matches(where or {}), F.lit(False))
    changed = {
        n: F.when(hit, F.lit(v).cast(state.schema[n].dataType)).otherwise(F.col(n)) for n, v in values.items()
    }
    return state.withColumns(changed)


def register_files(state: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of files whose name is not registered yet, each name once."""
    files = first_rows(files, ["file_name"])
    return files.join(state.select("file_name"), "file_name", "left_anti").select(*files.columns)


def pending_files(files: DataFrame, done: DataFrame, key: str = "file_path") -> DataFrame:
    """Distinct files that are not done."""
    return files.select(key).distinct().join(done.select(key), key, "left_anti")
