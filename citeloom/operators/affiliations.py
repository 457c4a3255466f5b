"""Affiliation tables: explode, consolidate, match, merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.functions.records import affiliation_list, affiliation_string, empty_array, object_name, or_empty, PERSON
from citeloom.functions.text import file_key
from citeloom.functions.values import has_national_country, is_national_client, is_national_publisher_name
from citeloom.session import cut_lineage

MATCH_TYPES = ["country", "grid", "rnsr", "ror"]
CONSOLIDATED = ["doi_publisher", "doi_client_id", "affiliation"]
MERGED = [
    "doi", "doi_file_name", "affiliation", "countries", "ror", "grid", "rnsr", "creator_contributor",
    "is_publisher_fr", "is_clientId_fr", "is_countries_fr",
]


def explode_affiliations(raw: DataFrame, origin: str = "origin_file") -> DataFrame:
    """Detailed rows: one per affiliation of each creator and contributor.

    A person without affiliations gives one row with an empty text; a record without
    people gives none.
    """
    row = F.transform

    def of(name: str) -> Column:
        present = F.filter(or_empty(F.col(name), PERSON), lambda p: p.isNotNull())

        def texts(p: Column) -> Column:
            listed = F.transform(affiliation_list(p), affiliation_string)
            return F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit("")))

        return F.flatten(
            row(
                present,
                lambda p: row(
                    texts(p),
                    lambda a: F.struct(
                        F.lit(name).alias("type"), object_name(p).alias("name"), a.alias("affiliation")
                    ),
                ),
            )
        )

    publisher = F.try_variant_get("publisher", "$.name", "string")
    rows = raw.select(
        F.lower("id").alias("doi_id"),
        F.lower(file_key("id")).alias("doi_file_name"),
        F.lower(F.coalesce(publisher, F.lit(""))).alias("doi_publisher"),
        F.coalesce("_client", F.lit("")).alias("doi_client_id"),
        F.explode(F.concat(of("creators"), of("contributors"))).alias("p"),
        F.col(origin).alias("origin_file"),
    )
    return rows.select(
        "doi_id", "doi_file_name", "p.type", "p.name", "doi_publisher", "doi_client_id", "p.affiliation", "origin_file"
    )


def consolidate(detailed: DataFrame) -> DataFrame:
    """Distinct (publisher, client, affiliation); repeats are dropped before the shuffle."""
    return detailed.select(*CONSOLIDATED).distinct()


def file_stats(raw: DataFrame, origin: str = "origin_file") -> DataFrame:
    """Records per file, with and without people; counted on the records, without exploding them."""
    n_people = F.size(or_empty(F.col("creators"), PERSON)) + F.size(or_empty(F.col("contributors"), PERSON))
    return raw.groupBy(F.col(origin).alias("file_name")).agg(
        F.count("*").alias("number_of_dois"),
        F.count_if(n_people == 0).alias("number_of_dois_with_null_attributes"),
        F.count_if(n_people > 0).alias("number_of_non_null_dois"),
    )


def pivot_results(results: DataFrame) -> DataFrame:
    """Match results ``(match_type, query, results)`` as one row per query with an array per type.

    Of several results for one query and type the first by value is taken.
    """
    return results.groupBy("query").agg(
        *[F.min(F.when(F.col("match_type") == t, F.col("results"))).alias(t) for t in MATCH_TYPES]
    )


def match_affiliations(consolidated: DataFrame, results: DataFrame) -> DataFrame:
    """Consolidated rows with countries, national flags and, for national rows, ids.

    The lookup of a text is one join on the distinct texts; a text without results gets
    empty arrays.
    """
    joined = consolidated.join(
        pivot_results(results).withColumnRenamed("query", "affiliation"), "affiliation", "left"
    )
    none = empty_array("string")
    flagged = joined.withColumn("countries", F.coalesce("country", none)).withColumns(
        {
            "is_publisher_fr": is_national_publisher_name("doi_publisher"),
            "is_clientId_fr": is_national_client("doi_client_id", fold=True),
            "is_countries_fr": has_national_country("countries"),
        }
    )
    national = F.col("is_publisher_fr") | F.col("is_clientId_fr") | F.col("is_countries_fr")
    ids = {t: F.when(national, F.coalesce(t, none)).otherwise(none) for t in MATCH_TYPES[1:]}
    return flagged.withColumns(ids).select(
        *CONSOLIDATED, "countries", "is_publisher_fr", "is_clientId_fr", "is_countries_fr", "grid", "rnsr", "ror"
    )


def merge_affiliations(matched: DataFrame, detailed: DataFrame) -> DataFrame:
    """Matched rows left-joined with the detailed rows they came from, distinct.

    Missing keys match each other; an empty text counts as missing. A large share of the
    detailed rows may have one key (no affiliation at all), and an outer join cannot split
    the side it does not preserve. So the join is an inner one, which can be split or
    broadcast on either side, and matched rows without detailed rows are added.
    """

    def keyed(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumns({f"{prefix}{k}": F.nullif(k, F.lit("")) for k in CONSOLIDATED})

    left = keyed(matched.distinct(), "_l_").drop("doi_publisher", "doi_client_id", "affiliation")
    right = keyed(
        detailed.withColumnsRenamed({"doi_id": "doi", "type": "creator_contributor"}), "_r_"
    ).select("doi", "doi_file_name", "creator_contributor", *[f"_r_{k}" for k in CONSOLIDATED])
    on = reduce(Column.__and__, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in CONSOLIDATED])
    found = right.join(left, on)
    keys = right.select(*[f"_r_{k}" for k in CONSOLIDATED]).distinct()
    alone = left.join(keys, on, "left_anti")
    merged = found.unionByName(alone, allowMissingColumns=True)
    return merged.withColumnRenamed("_l_affiliation", "affiliation").select(*MERGED).distinct()


def _bucket_keys(df: DataFrame) -> DataFrame:
    """The join keys as ``_k_...``: a missing value is an empty text, so plain equality serves."""
    return df.withColumns({f"_k_{k}": F.coalesce(k, F.lit("")) for k in CONSOLIDATED})


BUCKET_KEYS = [f"_k_{k}" for k in CONSOLIDATED]


def bucket_detailed(detailed: DataFrame, table: str, path: str, buckets: int) -> None:
    """Save the detailed rows as a table bucketed and sorted by the keys that they are merged on.

    The rows are shuffled once, here; every :func:`merge_bucketed` after that reads its buckets as
    they lie. A bucketed scan cannot be split where one key is hot, so the rows of a key with more than
    an average bucket's rows are dealt out to so many parts (``_part``) that each part fits one; there
    are fewer such keys than buckets, kept in the table ``{table}_hot``. ``path`` is a folder that all
    executors share.
    """
    spark = detailed.sparkSession
    rows = _bucket_keys(detailed.withColumnsRenamed({"doi_id": "doi", "type": "creator_contributor"}))
    rows = cut_lineage(rows.select("doi", "doi_file_name", "creator_contributor", *BUCKET_KEYS))
    fair = max(1, -(-rows.count() // buckets))
    counts = rows.groupBy(*BUCKET_KEYS).agg(F.count("*").alias("n")).where(F.col("n") > fair)
    hot = counts.select(*BUCKET_KEYS, F.ceil(F.col("n") / fair).cast("int").alias("_parts"))
    hot.write.option("path", f"{path}/hot").saveAsTable(f"{table}_hot")
    part = F.pmod(F.xxhash64("doi", "doi_file_name", "creator_contributor"), "_parts").cast("int")
    dealt = rows.join(spark.table(f"{table}_hot"), BUCKET_KEYS, "left").withColumns(
        {"_part": F.coalesce(part, F.lit(0)), "_met": F.lit(True)}
    )
    by = [*BUCKET_KEYS, "_part"]
    written = dealt.drop("_parts").repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    written.option("path", f"{path}/rows").saveAsTable(table)


def merge_bucketed(matched: DataFrame, table: str) -> DataFrame:
    """:func:`merge_affiliations` with a table of :func:`bucket_detailed`.

    The table is read once and not shuffled. A matched row of a hot key meets each part of it; such
    a key has detailed rows, so a part without any is left out instead of kept as an unmatched row.
    """
    spark = matched.sparkSession
    left = _bucket_keys(matched.distinct()).drop("doi_publisher", "doi_client_id")
    left = left.join(spark.table(f"{table}_hot"), BUCKET_KEYS, "left")
    left = left.withColumn("affiliation", F.nullif("affiliation", F.lit("")))
    left = left.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts") - 1, F.lit(0)))))
    merged = left.join(spark.table(table), [*BUCKET_KEYS, "_part"], "left")
    return merged.where("_parts IS NULL OR _met").select(*MERGED).distinct()


def affiliation_detail(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """First match of each affiliation of a record, defaults when there is none.

    ``rows`` has ``doi, affiliation``; the first match is taken by creators before
    contributors, then by the ids found.
    """
    fields = ["countries", "ror", "grid", "rnsr", "creator_contributor", "is_publisher_fr", "is_clientId_fr", "is_countries_fr"]
    order = F.struct(F.col("creator_contributor") != "creators", "countries", "ror", "grid", "rnsr")
    first = merged.groupBy("doi", "affiliation").agg(F.min_by(F.struct(*fields), order).alias("m"))
    defaults = {
        **{f: empty_array("string") for f in ("countries", "ror", "grid", "rnsr")},
        "creator_contributor": F.lit(""),
        **{f: F.lit(False) for f in ("is_publisher_fr", "is_clientId_fr", "is_countries_fr")},
    }
    joined = rows.join(first, ["doi", "affiliation"], "left")
    return joined.select(*rows.columns, *[F.coalesce(f"m.{f}", d).alias(f) for f, d in defaults.items()])


def resolve_conflicts(matched: DataFrame, order: str) -> DataFrame:
    """One row per affiliation text: per field the shortest non-empty list, the first on ties."""

    def best(field: str) -> Column:
        filled = F.size(field) > 0
        return F.min_by(
            F.when(filled, F.array_sort(field)), F.when(filled, F.struct(F.size(field), F.col(order)))
        ).alias(field)

    present = matched.where(F.col("affiliation").isNotNull())
    return present.groupBy("affiliation").agg(*[best(f) for f in ("countries", "grid", "rnsr", "ror")])
