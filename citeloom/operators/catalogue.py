"""Catalogue rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.constants import PART_WORDS
from citeloom.functions.records import authors, external_ids, record_affiliations, related_dois
from citeloom.functions.values import genre_features, normalize_format, normalize_publisher, size_features

CATALOGUE_COLUMNS = [
    "id", "doi", "external_ids", "year", "authors", "affiliations", "title", "genre_raw", "genre",
    "genre_detail", "nb_parts", "subparts", "resourceType", "abstract", "grants", "url", "publisher_raw",
    "publisher", "classifications", "language", "licenses", "methods", "description", "created",
    "registered", "doi_supplement_to", "doi_version_of", "client_id", "size", "fr_reasons",
    "fr_reasons_concat", "rors", "local_affiliations_from_publications", "fr_authors_orcid",
    "fr_authors_name", "fr_publications_linked", "natural_key", "update_date", "format_raw", "format",
    "size_total_mb", "units", "has_size", "size_cat",
]


def is_part(genre_detail: Column) -> Column:
    return reduce(Column.__or__, [F.contains(genre_detail, F.lit(word)) for word in PART_WORDS])


def drop_parts(df: DataFrame) -> DataFrame:
    """Rows that are versions or files of another record go; runs after keep-first."""
    return df.where(~is_part(F.col("genre_detail")))


def with_genre(df: DataFrame) -> DataFrame:
    features = genre_features(F.col("genre_raw"), F.col("publisher_raw"), F.col("related"))
    return df.withColumn("_g", features).select("*", "_g.*").drop("_g")


def catalogue_row(df: DataFrame, fix_units: bool = False) -> DataFrame:
    """Catalogue columns out of records with signals and genre; one projection."""
    c = F.col
    return (
        df.withColumns({"_size": size_features("size", fix_units), "doi": c("id")})
        .withColumns(
            {
                "id": F.concat(F.lit("doi"), c("doi")),
                "external_ids": external_ids(c("doi")),
                "authors": authors(c("people")),
                "affiliations": record_affiliations(c("people")),
                "abstract": F.array(
                    F.struct(c("abstract_text").alias("abstract"), c("language").alias("lang"))
                ),
                "publisher": normalize_publisher("doi", "publisher_raw"),
                "doi_supplement_to": related_dois(c("related"), "IsSupplementTo"),
                "doi_version_of": related_dois(c("related"), "IsVersionOf"),
                "format": F.transform("format_raw", normalize_format),
            }
        )
        .select("*", "_size.*")
        .select(*CATALOGUE_COLUMNS)
    )


def with_institutions(catalogue: DataFrame, lists: DataFrame) -> DataFrame:
    """Adds ``local_affiliations`` of the institution lists (ids there are lower case)."""
    return catalogue.join(lists, "id", "left")


def add_structures(catalogue: DataFrame, structures: DataFrame) -> DataFrame:
    """Protein rows next to the records, not de-duplicated."""
    return structures.unionByName(catalogue, allowMissingColumns=True)


def run_counters(records: DataFrame, reasons: DataFrame, kept: DataFrame, by: str, row_id: str = "rec_id") -> DataFrame:
    """Rows, rows per reason kind, and rows kept, of each file.

    ``records`` are those not skipped as version copies, ``reasons`` the narrow table of
    ``national_reasons`` and ``kept`` the records that become catalogue rows.
    """

    def having(reason: str) -> Column:
        return F.count_if(F.array_contains("fr_reasons", reason))

    counted = records.select(row_id, by).join(reasons.select(row_id, "fr_reasons"), row_id, "left").groupBy(by).agg(
        F.count("*").alias("n_rows"),
        having("country").alias("n_country"),
        having("publisher").alias("n_publisher"),
        having("clientId").alias("n_client"),
    )
    written = kept.groupBy(by).agg(F.count("*").alias("n_kept"))
    return counted.join(written, by, "left").fillna(0, ["n_kept"])
