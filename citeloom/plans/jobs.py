"""Whole jobs, composed of operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.functions.records import empty_array, record_columns
from citeloom.operators.affiliations import consolidate, explode_affiliations, file_stats
from citeloom.operators.catalogue import (
    add_structures,
    catalogue_row,
    drop_parts,
    with_genre,
    with_institutions,
)
from citeloom.operators.dedupe import drop_version_copies, file_batches, keep_first
from citeloom.operators.registry import match_registry
from citeloom.operators.signals import national_signals
from citeloom.session import cut_lineage
from citeloom.sources.readers import DUMP_PATTERN, dump_files, read_dump
from citeloom.sources.sinks import write_affiliations, write_by_institution, write_catalogue


def affiliation_tables(raw: DataFrame, origin: str = "origin_file") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Detailed rows, distinct rows, and counts per file."""
    detailed = explode_affiliations(raw, origin)
    return detailed, consolidate(detailed), file_stats(raw, origin)


def save_affiliation_tables(raw: DataFrame, path: str, origin: str = "origin_file", **options) -> DataFrame:
    """Write the three tables below a folder and return the counts per file.

    The text is parsed once: the few columns the tables need are written first.
    """
    kept = cut_lineage(raw.select("id", "publisher", "_client", "creators", "contributors", origin))
    detailed, consolidated, statistics = affiliation_tables(kept, origin)
    write_affiliations(detailed, consolidated, path, **options)
    statistics.write.parquet(f"{path}/statistics", **options)
    return raw.sparkSession.read.schema(statistics.schema).parquet(f"{path}/statistics")


def kept_records(
    records: DataFrame,
    lookup: DataFrame,
    *,
    batch: list[str],
    order: list[Column | str],
    batches: DataFrame | None = None,
    row_id: str = "rec_id",
    ror_on: str = "creator",
    last_names: list[str] | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
    reasons: DataFrame | None = None,
) -> DataFrame:
    """The records that become catalogue rows, with their signals and genre.

    Cheap rejects come first, national records are few, and only those go through the
    keep-first shuffle. Parts are dropped after keep-first, as a dropped part may stand
    for later rows of the same key.

    ``batches`` (of :func:`file_batches`) adds batch and rank of the file of a record, late,
    to the few rows that need it. ``cut`` writes the narrow table of reasons on the way (see
    :func:`national_signals`).
    """
    accepted = national_signals(drop_version_copies(records), lookup, row_id, ror_on, last_names, cut, reasons)
    if batches is not None:
        accepted = with_batches(accepted, batches)
    return drop_parts(with_genre(keep_first(accepted, "natural_key", batch, order, row_id)))


def build_catalogue(
    records: DataFrame,
    lookup: DataFrame,
    *,
    lists: DataFrame | None = None,
    structures: DataFrame | None = None,
    fix_units: bool = False,
    **keeping,
) -> DataFrame:
    """The catalogue out of typed records (``record_columns``) and side tables.

    ``keeping`` goes to :func:`kept_records`.
    """
    catalogue = catalogue_row(kept_records(records, lookup, **keeping), fix_units)
    if lists is not None:
        catalogue = with_institutions(catalogue, lists)
    else:
        catalogue = catalogue.withColumn("local_affiliations", empty_array("string"))
    if structures is not None:
        catalogue = add_structures(catalogue, structures)
    return catalogue


def catalogue_from_dump(
    spark: SparkSession,
    root: str,
    lookup: DataFrame,
    pattern: str = DUMP_PATTERN,
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Read a dump, cut the lineage once at the typed records, build the catalogue.

    The cut parses the text once although two branches read the records, fixes the ids of
    the lines, and lets each branch read only the columns it needs. Version copies are left
    out before. Wrap the job in ``session.temporary_cuts`` to remove the copy at its end.
    """
    keep = ("rec_id", "file_path", "file_block", "line_no")
    raw = read_dump(spark, root, pattern, partitions)
    records = cut_lineage(drop_version_copies(record_columns(raw, keep=keep)))
    return build_catalogue(
        records,
        cut_lineage(lookup),
        batch=["batch"],
        order=["file_rank", "file_block", "line_no"],
        batches=file_batches(dump_files(spark, root, pattern)),
        cut=cut_lineage,
        **options,
    )


def with_batches(records: DataFrame, batches: DataFrame) -> DataFrame:
    """Batch and rank of the file of each record; a record of an unlisted file stops the job."""
    joined = records.join(batches, "file_path", "left")
    unlisted = F.raise_error(F.concat(F.lit("no batch for the file "), F.coalesce("file_path", F.lit("null"))))
    known = [F.coalesce(F.col(c), unlisted.cast("long")).alias(c) for c in ("file_rank", "batch")]
    return joined.select(*[c for c in joined.columns if c not in ("file_rank", "batch")], *known)


def split_by_institution(catalogue: DataFrame, ids: DataFrame, path: str, **options) -> None:
    write_by_institution(catalogue, ids, path, **options)


def save_catalogue(catalogue: DataFrame, path: str, **options) -> None:
    write_catalogue(catalogue, path, **options)


def enrich_repositories(catalogue: DataFrame, index: DataFrame) -> DataFrame:
    """Catalogue with the registry entry behind the URL of each row, by distinct URL.

    URLs repeat, so they are looked up once each.
    """
    urls = catalogue.where(F.col("url") != "").select("url").distinct()
    found = match_registry(urls.withColumn("url_id", F.col("url")), index).select(
        F.col("url_id").alias("url"), F.col("entry").alias("repository")
    )
    return catalogue.join(found, "url", "left")
