"""Protein entries as catalogue rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citeloom.constants import STRUCTURE_DOI, STRUCTURE_GENRE, STRUCTURE_ID_TYPE, STRUCTURE_PUBLISHER
from citeloom.functions.records import empty_array, not_empty
from citeloom.functions.text import strip
from citeloom.operators.signals import REASONS, PUBLICATION


def structure_rows(entries: DataFrame) -> DataFrame:
    """Entries with DOI, year, authors and the DOI of the article they supplement."""
    head, tail = STRUCTURE_DOI.split("{id}")
    doi = F.concat(F.lit(head), F.lower("rcsb_id"), F.lit(tail))
    cited = strip(F.lower("rcsb_primary_citation.pdbx_database_id_doi"))
    names = not_empty(F.transform("audit_author", lambda a: a["name"]))
    return entries.select(
        F.col("struct.title").alias("title"),
        doi.alias("doi"),
        F.array(F.struct(F.lit(STRUCTURE_ID_TYPE).alias("id_type"), doi.alias("id_value"))).alias("external_ids"),
        F.substring("rcsb_accession_info.initial_release_date", 1, 4).try_cast("int").alias("year"),
        F.lit(STRUCTURE_PUBLISHER).alias("publisher"),
        F.lit(STRUCTURE_GENRE).alias("genre"),
        F.lit(STRUCTURE_GENRE).alias("genre_raw"),
        F.lit(STRUCTURE_GENRE).alias("genre_detail"),
        not_empty(F.array(cited)).alias("doi_supplement_to"),
        F.transform(
            F.coalesce(names, empty_array("string")),
            lambda n: F.struct(n.alias("full_name"), F.lit("creator").alias("role")),
        ).alias("authors"),
    )


def structures_to_catalogue(entries: DataFrame, publications: DataFrame, with_id: bool = False) -> DataFrame:
    """Rows of entries whose article is a national publication.

    As defined these rows carry no ``id``; ``with_id`` adds it.
    """
    rows = structure_rows(entries).withColumn("_doi", F.try_element_at("doi_supplement_to", F.lit(1)))
    known = publications.select(
        F.col("doi").alias("_doi"), "rors", F.col("local_affiliations").alias("_local")
    )
    reasons = F.array(F.lit(REASONS[PUBLICATION]))
    linked = rows.join(known, "_doi").withColumns(
        {
            "fr_reasons": reasons,
            "fr_reasons_concat": F.array_join(reasons, ";"),
            "fr_publications_linked": F.array(
                F.struct(
                    F.col("_doi").alias("doi"),
                    "rors",
                    F.col("_local").alias("local_affiliations_from_publications"),
                )
            ),
            "local_affiliations_from_publications": F.col("_local"),
        }
    )
    if with_id:
        linked = linked.withColumn("id", F.concat(F.lit("doi"), "doi"))
    person = F.transform(
        "authors",
        lambda a: F.struct(
            a["role"].alias("role"),
            F.lit(None).cast("string").alias("first_name"),
            F.lit(None).cast("string").alias("last_name"),
            a["full_name"].alias("full_name"),
            F.lit(None).cast("array<variant>").alias("affiliations"),
            F.lit(None).cast("string").alias("orcid"),
        ),
    )
    return linked.withColumn("authors", person).drop("_doi", "_local")
