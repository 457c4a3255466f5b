"""Writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F, types as T

from citeloom.operators.harvest import first_rows
from citeloom.session import cut_lineage

HEAVY_FIELDS = ["description", "methods"]


def null_if_empty_column(c: Column, kind: T.DataType) -> Column:
    """Null for '', [], {} and NaN; structs are cleaned inside, list elements are not."""
    if isinstance(kind, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.StructType):
        fields = [null_if_empty_column(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        filled = F.coalesce(*[F.when(f.isNotNull(), F.lit(True)) for f in fields])
        return F.when(filled, F.struct(*fields))
    return c


def null_if_empty(df: DataFrame) -> DataFrame:
    """Empty values of every column to null, so that JSON output leaves them out."""
    return df.select(
        *[null_if_empty_column(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )


def renamed_type(kind: T.DataType, names: dict[str, str]) -> T.DataType:
    """The type with fields renamed at every level."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [
                T.StructField(names.get(f.name, f.name), renamed_type(f.dataType, names), f.nullable)
                for f in kind.fields
            ]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(renamed_type(kind.elementType, names), kind.containsNull)
    return kind


def rename_columns(df: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """Columns and nested fields under other names; a projection without any copying."""
    if not names:
        return df
    return df.select(
        *[
            F.col(f"`{f.name}`").cast(renamed_type(f.dataType, names)).alias(names.get(f.name, f.name))
            for f in df.schema.fields
        ]
    )


def write_catalogue(
    df: DataFrame,
    path: str,
    names: dict[str, str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Catalogue as gzipped JSON lines without null and empty fields.

    ``names`` renames fields on the way out, nested ones too, for readers that expect other
    names.
    """
    rename_columns(null_if_empty(df), names).write.json(path, mode=mode, compression="gzip")


def write_affiliations(detailed: DataFrame, consolidated: DataFrame, path: str, mode: str = "errorifexists") -> None:
    detailed.write.parquet(f"{path}/detailed", mode=mode)
    consolidated.write.parquet(f"{path}/consolidated", mode=mode)


def rows_by_institution(df: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per catalogue row and known institution (``ids`` has a column ``institution``)."""
    return df.withColumn("institution", F.explode("local_affiliations")).join(
        ids.select("institution"), "institution", "left_semi"
    )


def flat_columns(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for CSV."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def write_by_institution(df: DataFrame, ids: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines and CSV per institution.

    The exploded rows are written once and both forms come from that copy, so the job behind them
    runs once. Rebalancing by institution keeps the number of files low and still spreads an
    institution that holds a large share of the rows over several tasks.
    """
    rows = cut_lineage(rows_by_institution(null_if_empty(df), ids)).hint("rebalance", F.col("institution"))
    rows.write.partitionBy("institution").json(f"{path}/jsonl", mode=mode)
    flat_columns(rows.drop(*HEAVY_FIELDS)).write.partitionBy("institution").csv(
        f"{path}/csv", mode=mode, header=True, escape='"'
    )


def append_state(df: DataFrame, path: str, keys: list[str]) -> None:
    """Adds the rows whose keys the state table does not hold yet, each key once.

    Null keys equal null keys. The table is made when it is not there.
    """
    new = first_rows(df, keys)
    try:
        held = df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(k).alias(f"_held_{k}") for k in keys])
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
        new = new.join(held, same, "left_anti")
    new.write.parquet(path, mode="append")
