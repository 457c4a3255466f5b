"""Exact dedup: groups by a 128-bit hash of the normalised text, bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.session import cut_lineage

BLANKS = r"[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def hashed(docs: DataFrame, id_col: str, text_col: str, text_hash) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), normalized(F.col(text_col)).alias("bytes"))
    return rows.select("id", "bytes", text_hash(F.col("bytes").cast("binary")).alias("hash"))


def sha256(text: str) -> Column:
    return F.sha2(F.col(text).cast("binary"), 256)


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", text_hash=F.md5) -> DataFrame:
    """One row per different text: hash, keep_id, group_size, text_sha256.

    Rows meet by hash **and** normalised bytes, so texts that share a hash stay apart. The
    aggregation combines before the shuffle: a text is sent once per task however many copies it
    has. Written as a table, as the texts end here.
    """
    groups = (
        hashed(docs, id_col, text_col, text_hash)
        .groupBy("hash", "bytes")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    return cut_lineage(groups.select("hash", "keep_id", "group_size", sha256("bytes").alias("text_sha256")))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", text_hash=F.md5) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are byte-equal after white space is normalised; null counts as empty,
    and very long texts are hashed and compared whole. Of a group the row with the smallest id
    stays. Null ids come last: a group with null ids only has a null ``keep_id``. Rows that repeat
    an id and a text get the same answer each. An empty table gives an empty result; other columns
    of the input, whatever their names, are not looked at.
    """
    groups = text_groups(docs, id_col, text_col, text_hash)
    rows = hashed(docs, id_col, text_col, text_hash)
    if groups.groupBy("hash").count().where("count > 1").isEmpty():
        joined = rows.select("id", "hash").join(groups, "hash")
    else:  # texts that share a hash are told apart by their digests
        joined = rows.select("id", "hash", sha256("bytes").alias("text_sha256")).join(groups, ["hash", "text_sha256"])
    return joined.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without exact copies, all columns kept; of a repeated row one stays.

    Cases as in ``exact_groups``; an empty table comes back empty.
    """
    # a null id is no empty text
    named = lambda c: F.concat(F.when(c.isNull(), "n").otherwise("v"), F.coalesce(c.cast("string"), F.lit("")))
    keys = text_groups(docs, id_col, text_col).select(F.col("text_sha256").alias("sha"), named(F.col("keep_id")).alias("keep"))
    rows = docs.select(
        F.struct("*").alias("row"),
        F.sha2(normalized(F.col(text_col)).cast("binary"), 256).alias("sha"),
        named(F.col(id_col)).alias("keep"),
    )
    kept = rows.join(keys, ["sha", "keep"], "left_semi")
    return kept.dropDuplicates(["sha", "keep"]).select("row.*")
