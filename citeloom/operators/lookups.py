"""Side tables: publications, authors, organisations, institution lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citeloom.constants import FIRST_AUTHOR_YEAR, TERRITORY_CODES
from citeloom.functions.text import normalize, string_array


def publication_lookup(publications: DataFrame, order: str = "row_order") -> DataFrame:
    """``(doi, rors, local_affiliations)`` of national publications; the last row of a DOI wins."""

    def parts(name: str):
        return F.coalesce(F.split(name, r"\|"), F.array().cast("array<string>"))

    rows = publications.where(F.col("doi").isNotNull() & F.contains("country", F.lit("fr"))).select(
        "doi",
        order,
        F.struct(
            F.transform(parts("rors"), lambda r: F.substring_index(r, "/", -1)).alias("rors"),
            parts("local_affiliations").alias("local_affiliations"),
        ).alias("info"),
    )
    last = rows.groupBy("doi").agg(F.max_by("info", order).alias("info"))
    return last.select("doi", "info.*")


def author_keys(authors: DataFrame) -> DataFrame:
    """One row per author and key: normalised display name (without a dot in it), ORCID."""
    by_name = F.when(~F.contains("display_name", F.lit(".")), normalize("display_name"))
    by_orcid = F.upper(F.substring_index("orcid", "/", -1))
    affiliated = F.filter(
        F.coalesce("affiliations", F.array().cast(authors.schema["affiliations"].dataType)),
        lambda a: a["institution"]["ror"].isNotNull(),
    )
    slim = F.transform(
        affiliated,
        lambda a: F.struct(
            F.substring_index(a["institution"]["ror"], "/", -1).alias("ror"), a["years"].alias("years")
        ),
    )
    keyed = authors.select(
        F.filter(F.array(by_name, by_orcid), lambda k: k.isNotNull()).alias("keys"), slim.alias("affs")
    )
    return keyed.select(F.explode("keys").alias("author_key"), "affs")


def author_lookup(authors: DataFrame, min_year: int = FIRST_AUTHOR_YEAR) -> DataFrame:
    """``(author_key, year, rors)``; keys met in more than one author are left out.

    Counting and carrying one payload per key in the same aggregation needs one shuffle,
    and of a much repeated name each task sends on one row only.
    """
    unique = (
        author_keys(authors)
        .groupBy("author_key")
        .agg(F.count("*").alias("n"), F.first("affs").alias("affs"))
        .where("n = 1")
    )
    years = F.array_distinct(F.flatten(F.transform("affs", lambda a: a["years"])))
    rors = F.transform(
        F.filter("affs", lambda a: F.array_contains(a["years"], F.col("year"))), lambda a: a["ror"]
    )
    return (
        unique.withColumn("year", F.explode(years))
        .where(F.col("year") >= min_year)
        .select("author_key", "year", rors.alias("rors"))
    )


def national_orgs(orgs: DataFrame, codes: list[str] = TERRITORY_CODES) -> DataFrame:
    """``(ror)``: ids of organisations with a location in one of the territories."""
    known = string_array(codes)
    located = F.exists(
        "locations",
        lambda place: F.array_contains(known, F.lower(place["geonames_details"]["country_code"])),
    )
    return orgs.where(located).select(F.lower(F.substring_index("id", "/", -1)).alias("ror")).distinct()


def institution_lookup(lists: DataFrame) -> DataFrame:
    """``(id, local_affiliations)`` from ``(file_name, doi)``; labels come from the file stem.

    The set per id holds labels of institutions, so its size is bounded by their number.
    """
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    rows = lists.select(
        F.concat(F.lit("doi"), "doi").alias("id"), F.explode(F.split(stem, "_")).alias("label")
    )
    return rows.groupBy("id").agg(F.array_sort(F.collect_set("label")).alias("local_affiliations"))
