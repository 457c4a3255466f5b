"""Registry of repositories, protein rows, harvest bookkeeping, files and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.operators import catalogue as C, harvest as H, lookups as L, registry as G, structures as P
from citeloom.plans.jobs import catalogue_from_dump, enrich_repositories, save_affiliation_tables, save_catalogue
from citeloom.session import shared_folder
from citeloom.sources import readers, sinks
from citeloom.streaming import streams
from suite import views as v
from suite.record_queries import DETAILED, PERSONS, RECORDS, envelope_lines, raw_records, typed_records, with_js
from suite.registry import query
from suite.table_queries import (
    AUTHORS,
    CATALOGUE,
    LISTS,
    ORGS,
    PUBS,
    SIDES,
    SIGNALS,
    author_rows,
    institution_lists,
    lookup,
    org_rows,
    publications,
)
from suite.text_queries import url_ctes


# ---------------------------------------------------------------- repository registry

HOST = "split_part(split_part(url, '/', 3), '?', 1)"
REGISTRY = (
    f"SELECT page_id, CASE page_id % 25 WHEN 3 THEN 'https://data.ifremer.fr/' WHEN 4 THEN 'http://urgi.versailles.inrae.fr/gnpis' WHEN 5 THEN NULL "
    f"WHEN 6 THEN 'x' WHEN 7 THEN url WHEN 8 THEN 'http://www.' || {HOST} || '/en/' ELSE 'https://' || {HOST} || '/index.html' END AS url, "
    "'re3' || CAST(page_id AS STRING) AS id, page_id AS row_order FROM pages"
)
PAGE_URLS = (
    "SELECT page_id, CASE page_id % 20 WHEN 1 THEN 'https://campagnes.flotteoceanographique.fr/campagnes/1' WHEN 2 THEN 'http://urgi.versailles.inra.fr/x' "
    "WHEN 3 THEN 'https://catalogue.data.ifremer.fr/x' ELSE url END AS url FROM pages"
)
ALIASES = (
    "VALUES ('urgi.versailles.inrae.fr', 'urgi.versailles.inrae.fr/gnpis'), ('urgi.versailles.inra.fr', 'urgi.versailles.inrae.fr/gnpis'), "
    "('campagnes.flotteoceanographique.fr', 'data.ifremer.fr'), ('cdsarc.cds.unistra.fr', 'cdsweb.u-strasbg.fr')"
)
INDEX = f"""{url_ctes(REGISTRY, 'r')},
base_index AS (SELECT normalized AS signature, max(page_id) AS row_order FROM rsigned GROUP BY normalized),
aliases(alias, target) AS ({ALIASES}),
known AS (SELECT alias AS signature, row_order FROM aliases JOIN base_index ON target = signature),
index AS (SELECT * FROM base_index WHERE signature NOT IN (SELECT signature FROM known) UNION ALL SELECT * FROM known)"""


def registry_rows(spark, sf_dir) -> DataFrame:
    return v.frame(spark, sf_dir, REGISTRY).select("id", "url", "row_order")


@query("registry_index", f"WITH {INDEX} SELECT signature, 're3' || row_order AS id FROM index")
def _(spark, sf_dir):
    return G.registry_index(registry_rows(spark, sf_dir)).select("signature", "entry.id")


@query("duplicate_signatures", f"WITH {url_ctes(REGISTRY, 'r')} SELECT normalized AS signature, CAST(count(*) AS BIGINT) AS n_rows FROM rsigned GROUP BY 1 HAVING count(*) > 1")
def _(spark, sf_dir):
    return G.duplicate_signatures(registry_rows(spark, sf_dir))


MATCHES = f"""{INDEX}, {url_ctes(PAGE_URLS, 'u')},
probes AS (SELECT page_id, unnest(signatures) AS signature, generate_subscripts(signatures, 1) AS pos FROM usigned),
best AS (SELECT page_id, arg_min(signature, pos) AS signature, arg_min(row_order, pos) AS row_order FROM probes JOIN index USING (signature) GROUP BY page_id)"""


@query("match_registry", f"WITH {MATCHES} SELECT page_id, signature, 're3' || row_order AS id FROM best")
def _(spark, sf_dir):
    urls = v.frame(spark, sf_dir, PAGE_URLS)
    found = G.match_registry(urls, G.registry_index(registry_rows(spark, sf_dir)), row_id="page_id")
    return found.select("page_id", "signature", "entry.id")


@query("enrich_repositories", f"WITH {MATCHES} SELECT p.page_id, p.url, 're3' || row_order AS repository FROM ({PAGE_URLS}) p LEFT JOIN best USING (page_id)")
def _(spark, sf_dir):
    rows = enrich_repositories(v.frame(spark, sf_dir, PAGE_URLS), G.registry_index(registry_rows(spark, sf_dir)))
    return rows.select("page_id", "url", F.col("repository.id").alias("repository"))


SUBJECTS = (
    "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'other' ELSE 'DFG' END AS scheme, "
    "substr('205-01', 1, 1 + CAST(p_partkey % 6 AS INT)) || ' ' || p_name || ' ' || p_type AS subject FROM part"
)


@query(
    "registry_subjects",
    "SELECT p_partkey, scheme, CASE WHEN scheme = 'DFG' THEN substr(subject, strpos(subject, ' ') + 1) ELSE subject END AS subject, "
    "CASE WHEN scheme = 'DFG' THEN split_part(subject, ' ', 1) END AS subject_code, "
    f"CASE WHEN scheme = 'DFG' THEN CAST(length(split_part(subject, ' ', 1)) AS VARCHAR) END AS level FROM ({SUBJECTS})",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, SUBJECTS).select("p_partkey", F.array(F.struct("subject", "scheme")).alias("s"))
    split = rows.select("p_partkey", F.inline(G.registry_subjects("s")))
    return split.withColumn("level", F.col("level").cast("string"))


# ---------------------------------------------------------------- protein rows

ENTRIES = (
    "SELECT p_partkey, '1A' || CAST(p_partkey AS STRING) AS rcsb_id, p_name AS title, CAST(1990 + p_size AS STRING) || '-02-03T00:00:00Z' AS released, "
    "CASE p_partkey % 3 WHEN 0 THEN ' 10.7777/PUB.' || CAST((p_partkey * 7) % 1100 AS STRING) WHEN 1 THEN '10.1/none' ELSE NULL END AS cited, "
    "p_brand AS author FROM part"
)


def entries(spark, sf_dir) -> DataFrame:
    return v.frame(spark, sf_dir, ENTRIES).select(
        "rcsb_id",
        F.struct("title").alias("struct"),
        F.struct(F.col("released").alias("initial_release_date")).alias("rcsb_accession_info"),
        F.struct(F.col("cited").alias("pdbx_database_id_doi")).alias("rcsb_primary_citation"),
        F.array(F.struct(F.col("author").alias("name")), F.struct(F.lit("").alias("name"))).alias("audit_author"),
    )


STRUCTURES = (
    "SELECT '10.2210/pdb' || lower(rcsb_id) || '/pdb' AS doi, title, CAST(substr(released, 1, 4) AS INTEGER) AS year, 'Worldwide Protein Data Bank' AS publisher, "
    "'dataset' AS genre, pubs.doi AS linked, array_to_string(rors, '|') AS rors, author AS authors, 'linked_article' AS fr_reasons_concat "
    f"FROM ({ENTRIES}) JOIN pubs ON pubs.doi = trim(lower(cited))"
)


@query("structures_to_catalogue", f"WITH {PUBS} {STRUCTURES}")
def _(spark, sf_dir):
    rows = P.structures_to_catalogue(entries(spark, sf_dir), publications(spark, sf_dir))
    return rows.select(
        "doi", "title", "year", "publisher", "genre", F.col("fr_publications_linked")[0]["doi"].alias("linked"),
        F.array_join("rors", "|").alias("rors"), F.array_join(F.transform("authors", lambda a: a["full_name"]), "|").alias("authors"),
        "fr_reasons_concat",
    )


@query(
    "catalogue_with_structures",
    f"WITH {PUBS}, s AS ({STRUCTURES}) SELECT NULL AS id, doi, title FROM s UNION ALL SELECT 'doi' || {v.RECORD_ID}, {v.RECORD_ID}, source FROM documents",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, f"SELECT 'doi' || {v.RECORD_ID} AS id, {v.RECORD_ID} AS doi, source AS title FROM documents")
    both = C.add_structures(rows, P.structures_to_catalogue(entries(spark, sf_dir), publications(spark, sf_dir)))
    return both.select("id", "doi", "title")


# ---------------------------------------------------------------- harvest bookkeeping


def events(spark, sf_dir) -> DataFrame:
    return v.frame(spark, sf_dir, "SELECT event_id, ts, user_id FROM events")


def event_span(spark, sf_dir) -> DataFrame:
    """First day and the day after the last of the events: one row, start and end."""
    day = F.date_trunc("day", "ts")
    return events(spark, sf_dir).agg(F.min(day).alias("start"), F.max(F.timestamp_add("DAY", F.lit(1), day)).alias("end"))


for interval in ("hour", "day", "week", "month"):

    @query(
        f"slice_counts_{interval}",
        f"SELECT date_trunc('{interval}', ts) AS slice_start, date_trunc('{interval}', ts) + INTERVAL 1 {interval} AS slice_end, "
        "CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY ALL",
    )
    def _(spark, sf_dir, interval=interval):
        rows = H.assign_slices(events(spark, sf_dir), "ts", interval)
        return rows.groupBy("slice_start", "slice_end").agg(F.count("*").alias("n_rows"))


SPAN = "(SELECT min(date_trunc('day', ts)) AS a, max(date_trunc('day', ts)) + INTERVAL 1 DAY AS b FROM events)"
HOURS = f"(SELECT unnest(generate_series(a, b - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slice_start FROM {SPAN})"
MINUTES = f"(SELECT unnest(generate_series(a, b - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS slice_start FROM {SPAN})"
STAMP = "'%Y%m%d%H%M%S'"


@query("events_in_window", "SELECT event_id FROM events WHERE ts BETWEEN (SELECT min(ts) FROM events) + INTERVAL 2 DAY AND (SELECT max(ts) FROM events) - INTERVAL 2 DAY")
def _(spark, sf_dir):
    rows = events(spark, sf_dir)
    first = events(spark, sf_dir).agg(F.timestamp_add("DAY", F.lit(2), F.min("ts"))).scalar()
    last = events(spark, sf_dir).agg(F.timestamp_add("DAY", F.lit(-2), F.max("ts"))).scalar()
    return H.in_window(rows, "ts", first, last).select("event_id")


@query(
    "time_slices",
    f"SELECT slice_start, slice_start + INTERVAL 1 HOUR AS slice_end, CAST(count(event_id) AS BIGINT) AS n_rows "
    f"FROM {HOURS} LEFT JOIN events ON date_trunc('hour', ts) = slice_start GROUP BY ALL",
)
def _(spark, sf_dir):
    slices = H.calendar(event_span(spark, sf_dir), "hour")
    counts = H.assign_slices(events(spark, sf_dir), "ts", "hour").groupBy("slice_start").agg(F.count("*").alias("n_rows"))
    return slices.join(counts, "slice_start", "left").fillna(0, ["n_rows"])


def found_minutes(spark, sf_dir) -> DataFrame:
    """Names of the minute files that exist: those of minutes with events."""
    rows = H.assign_slices(events(spark, sf_dir), "ts", "minute")
    return rows.select(H.slice_name("slice_start", "slice_end").alias("name")).distinct()


@query(
    "pending_slices",
    f"SELECT slice_start, slice_start + INTERVAL 1 MINUTE AS slice_end, 'dcdump-' || strftime(slice_start, {STAMP}) || '-' || "
    f"strftime(slice_start + INTERVAL 1 MINUTE, {STAMP}) AS name FROM {MINUTES} WHERE slice_start NOT IN (SELECT date_trunc('minute', ts) FROM events)",
)
def _(spark, sf_dir):
    slices = H.calendar(event_span(spark, sf_dir), "minute")
    return H.pending_slices(slices, found_minutes(spark, sf_dir))


@query(
    "slice_coverage",
    f"SELECT CAST(n AS BIGINT) AS number_slices, CAST(f AS BIGINT) AS number_found, CAST(n - f AS BIGINT) AS number_missed, CASE WHEN n = f THEN 'done' ELSE 'error' END AS status "
    f"FROM (SELECT (SELECT count(*) FROM {MINUTES}) AS n, (SELECT count(DISTINCT date_trunc('minute', ts)) FROM events) AS f)",
)
def _(spark, sf_dir):
    span = event_span(spark, sf_dir)
    limits = [event_span(spark, sf_dir).select(name).scalar() for name in ("start", "end")]
    return H.slice_coverage(H.calendar(span, "minute"), found_minutes(spark, sf_dir), *limits)


def harvest_jobs(directory: str) -> str:
    """Jobs out of orders: a directory per customer, dates from the order."""
    return (
        "SELECT CAST(o_orderkey AS INT) AS id, CAST(0 AS INT) AS number_missed, CAST(1 AS INT) AS number_slices, o_orderdate AS start_date, o_orderdate AS end_date, "
        "CASE o_orderstatus WHEN 'F' THEN 'error' WHEN 'O' THEN 'done' ELSE 'in progress' END AS status, "
        f"{directory} AS current_directory, o_orderkey % 2 = 0 AS processed, CASE o_orderkey % 3 WHEN 0 THEN 'day' WHEN 1 THEN 'hour' ELSE 'minute' END AS slice_type FROM orders"
    )


STATE = harvest_jobs("'d' || CAST(o_custkey AS STRING)")
# every new job twice, under another id
NEW_JOBS = "SELECT * FROM ({0}) AS a UNION ALL SELECT id + 10000000, number_missed, number_slices, start_date, end_date, status, current_directory, processed, slice_type FROM ({0}) AS b"
NEW_JOBS = NEW_JOBS.replace("{0}", harvest_jobs("'d' || CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_custkey + 1 WHEN o_orderkey % 7 = 0 THEN -1 ELSE o_custkey END AS STRING)").replace(
    "o_orderdate AS end_date", "CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS end_date"
))


@query(
    "register_jobs",
    f"WITH state AS ({STATE}), firsts AS (SELECT current_directory, arg_min(slice_type, id) AS first_type FROM state GROUP BY 1) "
    f"SELECT id, current_directory, start_date, end_date, status, coalesce(first_type, slice_type) AS slice_type FROM ({NEW_JOBS}) n LEFT JOIN firsts USING (current_directory) "
    "WHERE NOT EXISTS (SELECT 1 FROM state s WHERE s.current_directory = n.current_directory AND s.start_date = n.start_date AND s.end_date = n.end_date AND s.status <> 'error') "
    "QUALIFY row_number() OVER (PARTITION BY current_directory, start_date, end_date ORDER BY id) = 1",
)
def _(spark, sf_dir):
    accepted = H.register_job(v.frame(spark, sf_dir, STATE), v.frame(spark, sf_dir, NEW_JOBS))
    return accepted.select(F.col("id").cast("int"), "current_directory", "start_date", "end_date", "status", "slice_type")


@query("query_state", f"SELECT id, current_directory, status FROM ({STATE}) WHERE status = 'done' AND processed")
def _(spark, sf_dir):
    found = H.query_state(v.frame(spark, sf_dir, STATE), {"status": "done", "processed": True})
    return found.select("id", "current_directory", "status")


@query(
    "update_state",
    f"SELECT id, CASE WHEN status = 'error' THEN 'retry' ELSE status END AS status, CASE WHEN status = 'error' THEN 3 ELSE number_missed END AS number_missed FROM ({STATE})",
)
def _(spark, sf_dir):
    changed = H.update_state(v.frame(spark, sf_dir, STATE), {"status": "retry", "number_missed": 3}, {"status": "error"})
    return changed.select("id", "status", "number_missed")


FILES = "SELECT doc_id, 'f' || CAST(CAST(floor(doc_id / 5) AS BIGINT) AS STRING) AS file_name FROM documents"
DONE = "SELECT DISTINCT 'f' || CAST(CAST(floor(doc_id / 5) AS BIGINT) AS STRING) AS file_name FROM labels WHERE toxic = 1"


@query("pending_files", f"SELECT DISTINCT file_name FROM ({FILES}) WHERE file_name NOT IN (SELECT file_name FROM ({DONE}))")
def _(spark, sf_dir):
    return H.pending_files(v.frame(spark, sf_dir, FILES), v.frame(spark, sf_dir, DONE), "file_name")


@query(
    "register_files",
    f"SELECT min(doc_id) AS doc_id, file_name FROM ({FILES}) WHERE file_name NOT IN (SELECT file_name FROM ({DONE})) GROUP BY file_name",
)
def _(spark, sf_dir):
    return H.register_files(v.frame(spark, sf_dir, DONE), v.frame(spark, sf_dir, FILES))


# ---------------------------------------------------------------- files


@query("dump_round_trip", with_js() + "SELECT j->>'$.id' AS id, replace(split_part(file_path, '/', 2), 'updated_', '') AS folder, j->>'$.attributes.language' AS language FROM js")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    lines = v.frame(spark, sf_dir, v.record_json(v.SPARK)).select(
        F.concat(F.lit("a"), F.regexp_extract("file_path", "updated_([0-9]+)", 1)).alias("updated"), "value"
    )
    lines.write.partitionBy("updated").text(folder, compression="gzip")
    raw = readers.read_dump(spark, folder, "updated*/*.txt.gz")
    return raw.select("id", F.regexp_extract("file_path", "updated=a([0-9]+)", 1).alias("folder"), "language")


def dump_on_disk(spark, sf_dir) -> str:
    """The records as a dump: one gzip file per folder, names with a blank, lines in order."""
    folder = f"{shared_folder(spark)}/the dump"
    lines = v.frame(spark, sf_dir, v.record_json(v.SPARK)).select(
        F.regexp_replace(F.regexp_replace("file_path", "^dump/updated_", "of "), "/", " ").alias("updated"), "line_no", "value"
    )
    lines = lines.repartition("updated").sortWithinPartitions("updated", "line_no").select("updated", "value")
    lines.write.partitionBy("updated").text(folder, compression="gzip")
    return folder


@query(
    "catalogue_from_dump",
    with_js(PERSONS, RECORDS, SIDES, SIGNALS, CATALOGUE, LISTS)
    + f""", structures AS ({STRUCTURES})
    SELECT id AS doi, nullif(title, '') AS title, fr_reasons_concat, natural_key, genre, coalesce(array_to_string(local_affiliations, '|'), '') AS local_affiliations
    FROM (SELECT rows.*, local_affiliations FROM rows LEFT JOIN (SELECT id AS list_id, local_affiliations FROM lists) ON list_id = 'doi' || rows.id)
    UNION ALL SELECT doi, title, fr_reasons_concat, NULL, genre, '' FROM structures""",
)
def _(spark, sf_dir):
    """The whole job as it ships: reader, one cut, signals, keep-first, protein rows, lists, writer."""
    catalogue = catalogue_from_dump(
        spark, dump_on_disk(spark, sf_dir), lookup(spark, sf_dir), "updated*/*.txt.gz", lists=institution_lists(spark, sf_dir),
        structures=P.structures_to_catalogue(entries(spark, sf_dir), publications(spark, sf_dir)),
    )
    out = shared_folder(spark)
    save_catalogue(catalogue, out)
    fields = "doi string, title string, fr_reasons_concat string, natural_key string, genre string, local_affiliations array<string>"
    rows = spark.read.json(out, schema=fields)
    return rows.withColumn("local_affiliations", F.coalesce(F.array_join("local_affiliations", "|"), F.lit("")))


@query("listed_dump_files", f"SELECT CAST(count(DISTINCT {v.FILE_PATH}) AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_rows FROM documents")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    lines = v.frame(spark, sf_dir, f"SELECT {v.FILE_PATH} AS file_path, doc_id FROM documents").select(
        F.concat(F.lit("a"), F.regexp_replace("file_path", "[^0-9]+", "-")).alias("updated"), F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"))).alias("value")
    )
    lines.repartition("updated").write.partitionBy("updated").text(folder, compression="gzip")
    files = readers.dump_files(spark, folder, "updated*/*.txt.gz")
    rows = readers.read_dump(spark, folder, "updated*/*.txt.gz")
    counts = rows.groupBy("file_path").agg(F.count("*").alias("n")).join(files, "file_path")
    return counts.agg(F.count("*").alias("n_files"), F.sum("n").alias("n_rows"))


@query("read_publications", f"WITH {PUBS} SELECT doi, array_to_string(rors, '|') AS rors FROM pubs")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    v.frame(spark, sf_dir, v.publications_sql()).orderBy("row_order").drop("row_order").write.csv(folder, sep=";", header=True)
    found = L.publication_lookup(readers.read_publications(spark, folder))
    return found.select("doi", F.array_join("rors", "|").alias("rors"))


LIST_LINES = (
    "SELECT file_name, CAST(0 AS BIGINT) AS file_block, doc_id + 1 AS line_no, CASE file_name WHEN 'paris.csv' THEN '\"' || typed || '\";a,b' "
    "WHEN 'lyon.csv' THEN typed || ',\"x, y\"' ELSE '\"a,b\",' || typed END AS value FROM ({rows}) AS d UNION ALL "
    "SELECT DISTINCT file_name, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CASE file_name WHEN 'paris.csv' THEN 'DOI;other' WHEN 'lyon.csv' THEN 'my doi,b' "
    "WHEN 'caen.csv' THEN 'a,b' ELSE 'x,Doi' END FROM ({rows}) AS h"
).replace("{rows}", v.doi_lists_sql())


@query(
    "doi_list_files",
    f"SELECT file_name, doi FROM (SELECT file_name, nullif(regexp_extract(replace(trim(lower(typed)), '%2f', '/'), '(10\\.[^\\n]*?)( |$)', 1), '') AS doi FROM ({v.doi_lists_sql()})) "
    "WHERE length(doi) >= 5 AND file_name <> 'caen.csv'",
)
def _(spark, sf_dir):
    lines = v.frame(spark, sf_dir, LIST_LINES).withColumn("file_path", F.concat(F.lit("lists/"), "file_name"))
    return readers.doi_list_rows(lines)


@query(
    "affiliation_files",
    f"SELECT DISTINCT doi_publisher, doi_client_id, nullif(affiliation, '') AS affiliation FROM ({v.customer_affiliations_sql()})",
)
def _(spark, sf_dir):
    folder = shared_folder(spark)
    rows = v.frame(spark, sf_dir, v.customer_affiliations_sql()).select(*readers.AFFILIATION_COLUMNS)
    rows.write.csv(folder, escape='"')
    read = readers.read_affiliations(spark, folder)
    return read.select("doi_publisher", "doi_client_id", "affiliation").distinct()


@query("affiliation_tables_on_disk", f"SELECT 'detailed' AS name, CAST(count(*) AS BIGINT) AS n FROM ({v.customer_affiliations_sql()}) UNION ALL "
       f"SELECT 'consolidated', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT doi_publisher, doi_client_id, affiliation FROM ({v.customer_affiliations_sql()}))")
def _(spark, sf_dir):
    from citeloom.operators.affiliations import consolidate

    folder = shared_folder(spark)
    detailed = v.frame(spark, sf_dir, v.customer_affiliations_sql())
    sinks.write_affiliations(detailed, consolidate(detailed), folder)
    parts = [
        spark.read.parquet(f"{folder}/{name}").select(F.lit(name).alias("name")) for name in ("detailed", "consolidated")
    ]
    return readers.union_tables(*parts).groupBy("name").agg(F.count("*").alias("n"))


@query("read_authors", f"WITH {AUTHORS} SELECT author_key, year, array_to_string(rors, '|') AS rors FROM authors")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    author_rows(spark, sf_dir).write.json(folder)
    found = L.author_lookup(readers.read_authors(spark, folder))
    return found.select("author_key", "year", F.array_join("rors", "|").alias("rors"))


@query("read_envelope_files", with_js() + "SELECT j->>'$.id' AS id, j->>'$.attributes.url' AS url FROM js")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    envelope_lines(spark, sf_dir).select("value").write.text(folder, compression="gzip")
    return readers.read_envelope(spark, folder).select("id", "url")


@query(
    "read_doi_list_files",
    f"WITH {LISTS} SELECT split_part(file_name, '.', 1) AS name, doi, CAST(count(*) AS BIGINT) AS n FROM "
    f"(SELECT file_name, nullif(regexp_extract(replace(trim(lower(typed)), '%2f', '/'), '(10\\.[^\\n]*?)( |$)', 1), '') AS doi FROM ({v.doi_lists_sql()})) "
    "WHERE length(doi) >= 5 GROUP BY ALL",
)
def _(spark, sf_dir):
    """Lists of one name in two folders, each with a header of its own: other separator, other place of the DOI."""
    folder = shared_folder(spark)
    rows = v.frame(spark, sf_dir, v.doi_lists_sql()).select("file_name", "typed", (F.hash("typed") % 2 == 0).alias("even"))
    name = F.regexp_replace("file_name", "[.].*", "")
    for part, header, line in (("a", "DOI;other", F.concat("typed", F.lit(";1,2"))), ("b", "x,my doi", F.concat(F.lit('"1;2",'), "typed"))):
        listed = rows.where(F.col("even") == (part == "a")).select(name.alias("name"), line.alias("value"), F.lit(1).alias("k"))
        head = listed.select("name", F.lit(header), F.lit(0)).distinct()
        ordered = listed.union(head).repartition("name").sortWithinPartitions("name", "k").select("name", "value")
        ordered.write.partitionBy("name").text(f"{folder}/{part}")
    lines = readers.text_lines(spark, f"{folder}/*/*")
    # every part file is one list; its name is that of its folder
    named = lines.withColumn("file_name", F.regexp_extract("file_path", "name=([^/]+)/", 1))
    return readers.doi_list_rows(named).groupBy(F.col("file_name").alias("name"), "doi").agg(F.count("*").alias("n"))


# Rows of one JSON array, so files grow in number with the table and not in size.
ROWS_A_FILE = 200


def write_arrays(rows: DataFrame, folder: str) -> None:
    """The rows, in files of one JSON array each; ``number`` numbers them and is left out."""
    columns = [c for c in rows.columns if c != "number"]
    files = rows.groupBy(F.expr(f"number div {ROWS_A_FILE}").alias("file"))
    arrays = files.agg(F.to_json(F.collect_list(F.struct(*columns))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(folder)


@query("read_org_files", f"WITH {ORGS} SELECT ror FROM orgs")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    version = F.struct(F.struct(F.lit("2.1").alias("schema_version")).alias("last_modified"))
    other = F.struct(F.struct(F.lit("1.0").alias("schema_version")).alias("last_modified"))
    rows = org_rows(spark, sf_dir)
    old = rows.withColumn("id", F.concat("id", F.lit("old"))).withColumn("admin", other)
    both = rows.withColumn("admin", version).union(old)
    write_arrays(both.withColumn("number", F.monotonically_increasing_id()), folder)
    return L.national_orgs(readers.read_orgs(spark, folder))


@query("read_repository_files", "SELECT 're3' || page_id AS id, 'R ' || page_id AS name, url FROM pages")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    rows = v.frame(spark, sf_dir, "SELECT 're3' || CAST(page_id AS STRING) AS id, 'R ' || CAST(page_id AS STRING) AS name, url, html AS unread, page_id AS number FROM pages")
    write_arrays(rows, folder)
    return readers.read_repositories(spark, folder).select("id", "name", "url")


@query(
    "saved_affiliation_tables",
    with_js(PERSONS, RECORDS, DETAILED)
    + """SELECT 'detailed' AS part, concat_ws('@', doi_id, type, name, doi_publisher, doi_client_id, affiliation) AS row FROM detailed
    UNION ALL SELECT 'consolidated', concat_ws('@', doi_publisher, doi_client_id, affiliation) FROM (SELECT DISTINCT doi_publisher, doi_client_id, affiliation FROM detailed)
    UNION ALL SELECT 'statistics', file_path || '@' || count(*) FROM js GROUP BY file_path""",
)
def _(spark, sf_dir):
    folder = shared_folder(spark)
    statistics = save_affiliation_tables(raw_records(spark, sf_dir), folder, origin="file_path")
    shapes = {
        "detailed": ["doi_id", "type", "name", "doi_publisher", "doi_client_id", "affiliation"],
        "consolidated": ["doi_publisher", "doi_client_id", "affiliation"],
    }
    parts = [
        spark.read.parquet(f"{folder}/{part}").select(F.lit(part).alias("part"), F.concat_ws("@", *columns).alias("row"))
        for part, columns in shapes.items()
    ]
    parts.append(statistics.select(F.lit("statistics").alias("part"), F.concat_ws("@", "file_name", "number_of_dois").alias("row")))
    return readers.union_tables(*parts)


@query("read_structures", f"SELECT '10.2210/pdb' || lower(rcsb_id) || '/pdb' AS doi, title, nullif(trim(lower(cited)), '') AS cited FROM ({ENTRIES})")
def _(spark, sf_dir):
    folder = shared_folder(spark)
    entries(spark, sf_dir).withColumn("cell", F.lit("heavy")).write.json(folder)
    rows = P.structure_rows(readers.read_structures(spark, folder))
    return rows.select("doi", "title", F.try_element_at("doi_supplement_to", F.lit(1)).alias("cited"))


WRITTEN = "id string, title string, year string, licenses array<string>, natural_key string, client_id string"


@query(
    "catalogue_on_disk",
    with_js(PERSONS, RECORDS)
    + """SELECT id, nullif(title, '') AS title, CAST(year AS VARCHAR) AS year, natural_key, nullif(client_id, '') AS client_id FROM keyed""",
)
def _(spark, sf_dir):
    folder = shared_folder(spark)
    sinks.write_catalogue(typed_records(spark, sf_dir).drop("doc_id", "rec_id", "file_path", "line_no"), folder)
    return spark.read.json(folder, schema=WRITTEN).drop("licenses")



def local_rows(spark, sf_dir) -> DataFrame:
    rows = v.frame(spark, sf_dir, f"SELECT doc_id, 'doi' || lower({v.RECORD_ID}) AS id, lang AS description, source AS methods, source AS title FROM documents")
    return C.with_institutions(rows, institution_lists(spark, sf_dir))


BY_INSTITUTION = (
    f"WITH {LISTS}, docs AS (SELECT doc_id, 'doi' || lower({v.RECORD_ID}) AS id, source AS title, lang FROM documents) "
    "SELECT {what} FROM (SELECT docs.*, unnest(local_affiliations) AS institution FROM docs JOIN lists USING (id)) WHERE institution IN ('lyon', 'paris', 'nantes')"
)


@query("with_institutions", BY_INSTITUTION.split("SELECT {what}")[0] + "SELECT doc_id, coalesce(array_to_string(local_affiliations, '|'), '') AS local_affiliations FROM docs LEFT JOIN lists USING (id)")
def _(spark, sf_dir):
    rows = local_rows(spark, sf_dir)
    return rows.select("doc_id", F.coalesce(F.array_join("local_affiliations", "|"), F.lit("")).alias("local_affiliations"))


@query("rows_by_institution", BY_INSTITUTION.format(what="doc_id, institution"))
def _(spark, sf_dir):
    ids = v.frame(spark, sf_dir, LABELS_KNOWN)
    return sinks.rows_by_institution(local_rows(spark, sf_dir), ids).select("doc_id", "institution")


# the labels that are known institutions, met in the lists themselves
LABELS_KNOWN = (
    f"SELECT DISTINCT split_part(file_name, '.', 1) AS institution FROM ({v.doi_lists_sql()}) AS d WHERE file_name IN ('lyon.csv', 'paris.csv', 'nantes.csv')"
)


@query("institution_files", BY_INSTITUTION.format(what="institution, id, title, CAST(lang AS VARCHAR) AS description, false AS heavy_in_csv"))
def _(spark, sf_dir):
    folder = shared_folder(spark)
    sinks.write_by_institution(local_rows(spark, sf_dir), v.frame(spark, sf_dir, LABELS_KNOWN), folder)
    lines = spark.read.json(f"{folder}/jsonl", schema="id string, title string, description string, institution string")
    table = spark.read.csv(f"{folder}/csv", header=True)
    heavy = bool(set(sinks.HEAVY_FIELDS) & set(table.columns))
    return lines.join(table.select("id", "institution").distinct(), ["id", "institution"], "left_semi").select(
        "institution", "id", "title", "description", F.lit(heavy).alias("heavy_in_csv")
    )


@query("append_state", f"SELECT id, status, slice_type FROM ({STATE})")
def _(spark, sf_dir):
    folder, state = shared_folder(spark), v.frame(spark, sf_dir, STATE)
    # a part, then all of it with every row twice
    for rows in (state.where("id % 2 = 0"), state.union(state)):
        sinks.append_state(rows, folder, ["id"])
    return spark.read.parquet(folder).select("id", "status", "slice_type")


# ---------------------------------------------------------------- streams


@query("stream_records", with_js() + "SELECT j->>'$.id' AS id, j->>'$.attributes.language' AS language FROM js")
def _(spark, sf_dir):
    folder, out = shared_folder(spark), shared_folder(spark)
    v.frame(spark, sf_dir, v.record_json(v.SPARK)).select("value").write.text(f"{folder}/in", compression="gzip")
    raw = streams.stream_dump(spark, f"{folder}/in", "*.txt.gz").select("id", "language")
    streams.run_available(raw, f"{folder}/checkpoint", format="parquet", path=f"{out}/rows")
    return spark.read.schema("id string, language string").parquet(f"{out}/rows")


def event_rows(spark, sf_dir) -> DataFrame:
    rows = v.frame(spark, sf_dir, "SELECT event_id, ts, user_id FROM events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withColumn("key", F.when(F.col("user_id") % 7 != 0, F.col("user_id").cast("string")))


def stream_in_parts(rows: DataFrame, part: Column, run: Callable[[DataFrame, str], None], n: int = 3) -> None:
    """The rows arrive in ``n`` parts; after each one the stream ``run`` starts goes on from its checkpoint."""
    spark = rows.sparkSession
    folder = shared_folder(spark)
    for i in range(n):
        rows.where(part == i).write.mode("append").parquet(f"{folder}/in")
        run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), f"{folder}/checkpoint")


def third() -> Column:
    """Parts that each lie over the whole time, so later ones bring late rows."""
    return F.pmod("event_id", F.lit(3))


@query(
    "stream_slice_counts",
    "SELECT date_trunc('hour', ts) AS slice_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS slice_end, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY ALL",
)
def _(spark, sf_dir):
    out = f"{shared_folder(spark)}/rows"
    sink = streams.slice_count_sink(out, "ts", "1 hour")

    def run(stream, checkpoint):
        streams.run_available(stream, checkpoint, foreach_batch=sink)

    stream_in_parts(event_rows(spark, sf_dir), third(), run)
    return streams.read_slice_counts(spark, out)


@query(
    "stream_closed_slices",
    "SELECT date_trunc('hour', ts) AS slice_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS slice_end, CAST(count(*) AS BIGINT) AS n_rows FROM events "
    "WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 HOUR FROM events) GROUP BY ALL",
)
def _(spark, sf_dir):
    out = f"{shared_folder(spark)}/rows"
    rows = event_rows(spark, sf_dir)
    first, last = (rows.agg(f("ts")).scalar() for f in (F.min, F.max))
    # three parts in the order of time
    share = F.timestamp_diff("MICROSECOND", first, F.col("ts")) * 3 / (F.timestamp_diff("MICROSECOND", first, last) + 1)

    def run(stream, checkpoint):
        counted = streams.stream_slice_counts(stream, "ts", "1 hour", "2 hours")
        streams.run_available(counted, checkpoint, format="parquet", path=out)

    stream_in_parts(rows, F.floor(share), run)
    return spark.read.parquet(out)


@query(
    "stream_keep_first",
    "SELECT CAST(user_id AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n FROM events WHERE user_id % 7 <> 0 GROUP BY user_id "
    "UNION ALL SELECT NULL, CAST(count(*) AS BIGINT) FROM events WHERE user_id % 7 = 0",
)
def _(spark, sf_dir):
    out = f"{shared_folder(spark)}/rows"

    def run(stream, checkpoint):
        first = streams.stream_keep_first(stream, "key", "ts", "3650 days").select("key")
        streams.run_available(first, checkpoint, format="parquet", path=out)

    stream_in_parts(event_rows(spark, sf_dir), third(), run)
    return spark.read.schema("key string").parquet(out).groupBy("key").agg(F.count("*").alias("n"))


@query(
    "stream_keep_first_in_order",
    "SELECT CAST(user_id AS VARCHAR) AS key, min_by(event_id, (event_id % 3) * 1000000000000 + event_id) AS event_id FROM events WHERE user_id % 7 <> 0 GROUP BY 1 "
    "UNION ALL SELECT NULL, event_id FROM events WHERE user_id % 7 = 0",
)
def _(spark, sf_dir):
    """The first row of a key in the first part that has it."""
    out = f"{shared_folder(spark)}/rows"

    def run(stream, checkpoint):
        first = streams.stream_keep_first_in_order(stream.select("key", "event_id"), "key", ["event_id"])
        streams.run_available(first, checkpoint, foreach_batch=streams.batch_sink(out), mode="update")

    stream_in_parts(event_rows(spark, sf_dir), third(), run)
    return spark.read.parquet(out).select("key", "event_id")
