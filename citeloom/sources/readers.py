"""Readers. Each returns a lazy DataFrame; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.constants import (
    EXCLUDED_LAST_NAMES,
    MIN_AUTHOR_WORKS,
    MIN_DOI_LENGTH,
    ORG_SCHEMA_VERSION,
    TERRITORY_CODES,
)
from citeloom.functions.records import RECORD_SCHEMA, flatten_record, parse_records
from citeloom.functions.text import clean_doi
from citeloom.session import cut_lineage, spread

DUMP_PATTERN = "updated*/*.jsonl.gz"
# Lines of a block when a large file that does not split is written again.
BLOCK_LINES = 20_000
AFFILIATION_COLUMNS = [
    "doi_id", "doi_file_name", "type", "name", "doi_publisher", "doi_client_id", "affiliation", "origin_file",
]

AUTHOR_SCHEMA = (
    "id string, orcid string, display_name string, works_count long, "
    "last_known_institutions array<struct<country_code string>>, "
    "affiliations array<struct<institution struct<ror string>, years array<int>>>"
)
ORG_SCHEMA = (
    "id string, admin struct<last_modified struct<schema_version string>>, "
    "locations array<struct<geonames_details struct<country_code string>>>"
)
STRUCTURE_SCHEMA = (
    "rcsb_id string, struct struct<title string>, "
    "rcsb_accession_info struct<initial_release_date string>, "
    "rcsb_primary_citation struct<pdbx_database_id_doi string>, "
    "audit_author array<struct<name string>>"
)
REPOSITORY_SCHEMA = (
    "id string, name string, doi string, names array<struct<name string, lang string>>, url string, "
    "descriptions array<struct<description string, lang string>>, type string, language string, "
    "subjects array<struct<subject string, scheme string>>, "
    "contents array<struct<content string, scheme string>>, keywords array<string>, "
    "institutions array<struct<name string, country string, type string, url string>>, "
    "pid array<string>"
)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: file, start of the block they were read from, running number.

    The running number grows along the lines of one block, so (block, number) orders a file.
    """
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("line_no"),
    )


def explode_envelopes(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One raw record per element of ``data``; blank and broken lines give nothing."""
    page = F.from_json("value", f"struct<data:array<{RECORD_SCHEMA}>>")
    records = lines.where(F.trim("value") != "").select(*keep, F.inline(page["data"]))
    return flatten_record(records, keep)


def read_envelope(spark: SparkSession, path: str) -> DataFrame:
    """Raw records of page envelopes (``{"data": [...]}`` per line), with their file."""
    lines = text_lines(spark, path).withColumnRenamed("file_name", "origin_file")
    return explode_envelopes(lines, keep=("origin_file",))


def broken_lines(lines: DataFrame) -> DataFrame:
    """Per file: lines, and lines that are not JSON."""
    filled = lines.where(F.trim("value") != "")
    return filled.groupBy("origin_file").agg(
        F.count("*").alias("lines"),
        F.count_if(F.try_parse_json("value").isNull()).alias("broken"),
    )


def read_dump(
    spark: SparkSession, root: str, pattern: str = DUMP_PATTERN, partitions: int | None = None
) -> DataFrame:
    """Raw records of a flat dump: gzipped files in ``updated*`` folders, one record per line.

    ``rec_id`` names a line. It is stable only for one reading of the files: write or
    checkpoint the parsed table before using it on both sides of a join. A gzip file is one
    task, so where there are fewer files than cores the lines are first written as blocks, once, with their
    numbers, which all cores then parse. ``partitions`` deals lines out by a shuffle instead.
    """
    lines = text_lines(spark, f"{root}/{pattern}").withColumn(
        "rec_id", F.concat_ws("#", "file_path", "file_block", "line_no")
    )
    if partitions is None and lines.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        lines = cut_lineage(lines, BLOCK_LINES)
    return parse_records(spread(lines, partitions), keep=("rec_id", "file_path", "file_block", "line_no"))


def dump_files(spark: SparkSession, root: str, pattern: str = DUMP_PATTERN) -> DataFrame:
    """The files of a dump, from the listing alone: their content is not read."""
    listing = spark.read.format("binaryFile").load(f"{root}/{pattern}")
    # the same spelling of the path as next to the lines: escaped, with its scheme
    return listing.select(F.col("_metadata.file_path").alias("file_path"))


def read_publications(
    spark: SparkSession,
    path: str,
    country: str = "country",
    local_affiliations: str = "local_affiliations",
) -> DataFrame:
    """``;`` separated publications; the names of two columns may differ by provider."""
    rows = spark.read.csv(path, sep=";", header=True)
    return rows.select(
        "doi",
        F.col(country).alias("country"),
        "rors",
        F.col(local_affiliations).alias("local_affiliations"),
        F.struct(
            F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
        ).alias("row_order"),
    )


def split_csv(line: Column, separator: str) -> Column:
    """Cells of a line; separators inside double quotes do not split.

    Every second piece between quotes is quoted: its separators are hidden while the line is split. Each
    step passes over the line once, whatever its length.
    """
    hidden = "\U0010ffff"  # no character

    def quoted(text: Column) -> Column:
        pieces = F.transform(
            F.split(text, '"'),
            lambda piece, i: F.when(i % 2 == 1, F.translate(piece, separator, hidden)).otherwise(piece),
        )
        cells = F.split(F.array_join(pieces, '"'), separator)
        return F.transform(cells, lambda cell: F.translate(cell, hidden, separator))

    cells = F.when(F.contains(line, F.lit('"')), quoted(line)).otherwise(F.split(line, separator))
    return F.transform(cells, lambda c: F.trim(F.regexp_replace(F.trim(c), '^"|"$', "")))


def doi_column(header: Column) -> Column:
    """``struct(separator, position)`` of the first column named like a DOI, null without one."""

    def position(separator: str) -> Column:
        names = F.transform(split_csv(header, separator), F.lower)
        hits = F.filter(
            F.transform(names, lambda n, i: F.when(F.contains(n, F.lit("doi")), i)),
            lambda i: i.isNotNull(),
        )
        return F.try_element_at(hits, F.lit(1)) + 1

    with_comma = position(",")
    name = F.element_at(split_csv(header, ","), with_comma)
    semicolons = F.contains(name, F.lit(";"))
    found = F.struct(
        F.when(semicolons, ";").otherwise(",").alias("separator"),
        F.when(semicolons, position(";")).otherwise(with_comma).alias("position"),
    )
    return F.when(with_comma.isNotNull(), found)


def doi_list_rows(lines: DataFrame) -> DataFrame:
    """``(file_name, doi)`` out of the lines of many CSV files with a header each.

    The header is the first line of its file, known by its path: two folders may hold files of
    one name. There is one per file, so that side of the join stays as small as the listing.
    """
    header = (
        lines.groupBy("file_path")
        .agg(F.min(F.struct("file_block", "line_no", "value")).alias("first"))
        .select(
            "file_path",
            F.struct("first.file_block", "first.line_no").alias("header_at"),
            doi_column(F.col("first.value")).alias("at"),
        )
        .where(F.col("at").isNotNull())
    )
    body = lines.join(header, "file_path").where(
        F.struct("file_block", "line_no") != F.col("header_at")
    )
    cell = F.when(
        F.col("at.separator") == ";",
        F.try_element_at(split_csv(F.col("value"), ";"), F.col("at.position")),
    ).otherwise(F.try_element_at(split_csv(F.col("value"), ","), F.col("at.position")))
    return body.select("file_name", clean_doi(cell).alias("doi")).where(
        F.char_length("doi") >= MIN_DOI_LENGTH
    )


def read_doi_lists(spark: SparkSession, path: str) -> DataFrame:
    """DOI lists of institutions, one CSV per institution (or several joined by ``_``)."""
    return doi_list_rows(text_lines(spark, path))


def read_affiliations(
    spark: SparkSession, path: str, names: list[str] = AFFILIATION_COLUMNS
) -> DataFrame:
    """Headerless affiliation CSV, everything text; empty cells are null."""
    return spark.read.csv(path, schema=", ".join(f"{n} string" for n in names), header=False)


def union_tables(*parts: DataFrame) -> DataFrame:
    """Partition tables as one, columns by name (parts in one folder are simply read together)."""
    return reduce(DataFrame.unionByName, parts)


def read_authors(spark: SparkSession, path: str) -> DataFrame:
    """Author dump (JSON lines), narrowed to national authors with enough works."""
    rows = spark.read.json(path, schema=AUTHOR_SCHEMA)
    return national_authors(rows)


def national_authors(rows: DataFrame) -> DataFrame:
    return rows.where(
        F.exists("last_known_institutions", lambda i: F.lower(i["country_code"]) == TERRITORY_CODES[0])
        & (F.col("works_count") > MIN_AUTHOR_WORKS)
    )


def read_orgs(spark: SparkSession, path: str) -> DataFrame:
    """Organisation registry (a JSON array per file), of the supported schema version."""
    rows = spark.read.json(path, schema=ORG_SCHEMA, multiLine=True)
    return rows.where(F.col("admin.last_modified.schema_version") == ORG_SCHEMA_VERSION)


def read_structures(spark: SparkSession, path: str) -> DataFrame:
    """Protein entries; the declared schema leaves the heavy parts unread."""
    return spark.read.json(path, schema=STRUCTURE_SCHEMA)


def read_repositories(spark: SparkSession, path: str) -> DataFrame:
    """Repository registry (one JSON array), with the order of its rows."""
    rows = spark.read.json(path, schema=REPOSITORY_SCHEMA, multiLine=True)
    return rows.withColumn("row_order", F.monotonically_increasing_id())


def excluded_last_names(spark: SparkSession, path: str | None = None) -> list[str]:
    """Family names that identify nobody: a CSV with a ``key`` column, or the built-in list."""
    if path is None:
        return list(EXCLUDED_LAST_NAMES)
    return [row.key for row in spark.read.csv(path, header=True).select("key").toLocalIterator()]
