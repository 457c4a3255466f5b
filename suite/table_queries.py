"""Side tables, signals, affiliation tables and the catalogue."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from citeloom.constants import AFFILIATION_KEYWORDS, EXCLUDED_LAST_NAMES, NAME_KEYWORDS, TERRITORY_CODES
from citeloom.functions.text import plain_word
from citeloom.operators import affiliations as A, catalogue as C, dedupe as D, lookups as L, signals as S
from citeloom.plans.jobs import build_catalogue, kept_records
from citeloom.session import cut_lineage, shared_folder
from citeloom.sources.readers import excluded_last_names, national_authors
from suite import views as v
from suite.record_queries import (
    FORMAT_LIST, GENRES, PERSONS, RECORDS, attribute, descriptions, dois, items, joined, typed_records, with_js,
)
from suite.registry import query
from suite.text_queries import duck_normalize
from suite.value_queries import CODES, DUCK_FOLD, DUCK_FORMAT, DUCK_PUBLISHER, EDGE, WORDS, duck_size

# ---------------------------------------------------------------- side tables


def publications(spark, sf_dir) -> DataFrame:
    return L.publication_lookup(v.frame(spark, sf_dir, v.publications_sql()))


PUBS = f"""pubs AS (
  SELECT doi, list_transform(coalesce(string_split(rors, '|'), []), lambda r: split_part(r, '/', -1)) AS rors,
    coalesce(string_split(local_affiliations, '|'), []) AS local_affiliations
  FROM ({v.publications_sql()}) WHERE contains(country, 'fr')
  QUALIFY row_number() OVER (PARTITION BY doi ORDER BY row_order DESC) = 1)"""


@query("publication_lookup", f"WITH {PUBS} SELECT doi, array_to_string(rors, '|') AS rors, array_to_string(local_affiliations, '|') AS local_affiliations FROM pubs")
def _(spark, sf_dir):
    return publications(spark, sf_dir).select(
        "doi", F.array_join("rors", "|").alias("rors"), F.array_join("local_affiliations", "|").alias("local_affiliations")
    )


def author_rows(spark, sf_dir) -> DataFrame:
    """Authors in the nested shape of the dump."""
    rows = v.frame(spark, sf_dir, v.authors_sql())

    def affiliation(ror: str, first: str, last: str):
        return F.struct(F.struct(F.col(ror).alias("ror")).alias("institution"), F.sequence(first, last).alias("years"))

    return rows.select(
        F.col("author_id").alias("id"),
        "orcid",
        "display_name",
        "works_count",
        F.array(F.struct("country_code")).alias("last_known_institutions"),
        F.array(affiliation("ror1", "from1", "to1"), affiliation("ror2", "from2", "to2")).alias("affiliations"),
    )


def authors(spark, sf_dir) -> DataFrame:
    return L.author_lookup(national_authors(author_rows(spark, sf_dir)))


AUTHORS = f"""people AS (SELECT * FROM ({v.authors_sql()}) WHERE country_code = 'FR' AND works_count > 5),
author_keys AS (
  SELECT author_id, {duck_normalize('display_name')} AS author_key FROM people WHERE NOT contains(display_name, '.')
  UNION ALL SELECT author_id, upper(split_part(orcid, '/', -1)) FROM people WHERE orcid IS NOT NULL),
unique_keys AS (SELECT author_key, any_value(author_id) AS author_id FROM author_keys GROUP BY author_key HAVING count(*) = 1),
author_years AS (
  SELECT author_id, 1 AS place, split_part(ror1, '/', -1) AS ror, unnest(range(from1, to1 + 1)) AS year FROM people WHERE ror1 IS NOT NULL
  UNION ALL SELECT author_id, 2, split_part(ror2, '/', -1), unnest(range(from2, to2 + 1)) FROM people WHERE ror2 IS NOT NULL),
authors AS (
  SELECT author_key, CAST(year AS INTEGER) AS year, list(ror ORDER BY place) AS rors
  FROM unique_keys JOIN author_years USING (author_id) WHERE year > 2012 GROUP BY author_key, year)"""


@query("author_lookup", f"WITH {AUTHORS} SELECT author_key, year, array_to_string(rors, '|') AS rors FROM authors")
def _(spark, sf_dir):
    return authors(spark, sf_dir).select("author_key", "year", F.array_join("rors", "|").alias("rors"))


def org_rows(spark, sf_dir) -> DataFrame:
    def place(name: str):
        return F.struct(F.struct(F.col(name).alias("country_code")).alias("geonames_details"))

    rows = v.frame(spark, sf_dir, v.orgs_sql()).where("schema_version = '2.1'")
    return rows.select("id", F.array(place("country1"), place("country2")).alias("locations"))


def orgs(spark, sf_dir) -> DataFrame:
    return L.national_orgs(org_rows(spark, sf_dir))


ORGS = (
    f"orgs AS (SELECT DISTINCT lower(split_part(id, '/', -1)) AS ror FROM ({v.orgs_sql()}) WHERE schema_version = '2.1' "
    f"AND (coalesce(lower(country1), '') IN ({CODES}) OR coalesce(lower(country2), '') IN ({CODES})))"
)


@query("national_organisations", f"WITH {ORGS} SELECT ror FROM orgs")
def _(spark, sf_dir):
    return orgs(spark, sf_dir)


def institution_lists(spark, sf_dir) -> DataFrame:
    from citeloom.functions.text import clean_doi

    rows = v.frame(spark, sf_dir, v.doi_lists_sql()).select("file_name", clean_doi("typed").alias("doi"))
    return L.institution_lookup(rows.where(F.char_length("doi") >= 5))


LISTS = f"""typed AS (
  SELECT string_split(split_part(file_name, '.', 1), '_') AS labels,
    nullif(regexp_extract(replace(trim(lower(typed)), '%2f', '/'), '(10\\.[^\\n]*?)( |$)', 1), '') AS doi FROM ({v.doi_lists_sql()})),
lists AS (
  SELECT 'doi' || doi AS id, list_sort(list(DISTINCT label)) AS local_affiliations
  FROM (SELECT doi, unnest(labels) AS label FROM typed WHERE length(doi) >= 5) GROUP BY doi)"""


@query("institution_lookup", f"WITH {LISTS} SELECT id, array_to_string(local_affiliations, '|') AS local_affiliations FROM lists")
def _(spark, sf_dir):
    return institution_lists(spark, sf_dir).select("id", F.array_join("local_affiliations", "|").alias("local_affiliations"))


# ---------------------------------------------------------------- signals

KEYWORDS = "[" + ", ".join(f"'{k}'" for k in AFFILIATION_KEYWORDS) + "]"
NAMES = "[" + ", ".join(f"'{k}'" for k in NAME_KEYWORDS) + "]"
def name_list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in (plain_word(n).replace("'", "''") for n in names)) + "]"


EXCLUDED = name_list(EXCLUDED_LAST_NAMES)

# one element of an affiliation list as searchable text
AFFILIATION_SEARCH = (
    "CASE json_type(a) WHEN 'VARCHAR' THEN " + duck_normalize("a->>'$'") + " WHEN 'OBJECT' THEN ' ' || "
    + duck_normalize("concat_ws(' , ', a->>'$.affiliationIdentifier', a->>'$.affiliationIdentifierScheme', a->>'$.name')")
    + " || ' ' END"
)
SIGNALS = f"""
forms AS (
  SELECT doc_id, n, {duck_normalize("replace(name, ',', ' ')")} AS n1, {duck_normalize('given')} AS g, {duck_normalize('family')} AS f FROM named),
name_forms AS (
  SELECT DISTINCT doc_id, n, form FROM (
    SELECT doc_id, n, n1 AS form FROM forms UNION ALL SELECT doc_id, n, g || ' ' || f FROM forms UNION ALL SELECT doc_id, n, f || ' ' || g FROM forms)
  WHERE form IS NOT NULL),
publication_hits AS (
  SELECT doc_id, i, lower(e->>'$.relatedIdentifier') AS doi, rors, local_affiliations
  FROM (SELECT doc_id, unnest(rel) AS e, generate_subscripts(rel, 1) AS i
        FROM (SELECT doc_id, coalesce(TRY_CAST(j->'$.attributes.relatedIdentifiers' AS JSON[]), []) AS rel FROM js))
  JOIN pubs ON pubs.doi = lower(e->>'$.relatedIdentifier') WHERE (e->>'$.relationType') = 'IsSupplementTo'),
orcid_hits AS (
  SELECT doc_id, n, k AS i, author_key, rors
  FROM (SELECT doc_id, n, unnest(ids) AS e, generate_subscripts(ids, 1) AS k FROM named) JOIN rec USING (doc_id)
  JOIN authors ON author_key = upper(split_part(e->>'$.nameIdentifier', '/', -1)) AND authors.year = lookup_year
  WHERE trim(lower(e->>'$.nameIdentifierScheme')) = 'orcid'),
name_hits AS (
  SELECT doc_id, n, form, rors FROM name_forms JOIN rec USING (doc_id) JOIN authors ON author_key = form AND authors.year = lookup_year
  WHERE NOT (form = 'anne houles' AND coalesce(publisher_text = 'UNITE Community', false))
    AND len(list_intersect(string_split(form, ' '), {EXCLUDED})) = 0),
named_rors AS (
  SELECT DISTINCT doc_id, split_part(lower(p->>'$.affiliationIdentifier'), '/', -1) AS ror FROM named
  WHERE len(affs) > 0 AND contains(lower(p->>'$.affiliationIdentifier'), 'ror')),
affiliation_hits AS (
  SELECT DISTINCT doc_id, 'affiliation_' || kw AS reason
  FROM (SELECT doc_id, unnest(affs) AS a FROM named) AS listed, (SELECT unnest({KEYWORDS}) AS kw)
  WHERE contains({AFFILIATION_SEARCH}, kw)),
name_keyword_hits AS (
  SELECT DISTINCT doc_id, 'name_' || kw AS reason FROM forms, (SELECT unnest({NAMES}) AS kw) WHERE contains(n1, kw)),
reasons AS (
  SELECT doc_id, 'linked_article' AS reason FROM publication_hits
  UNION SELECT doc_id, 'french_orcid' FROM orcid_hits
  UNION SELECT doc_id, 'french_author' FROM name_hits
  UNION SELECT doc_id, 'french_ror' FROM named_rors JOIN orgs USING (ror)
  UNION SELECT * FROM affiliation_hits
  UNION SELECT * FROM name_keyword_hits
  UNION SELECT doc_id, 'publisher' FROM rec WHERE regexp_matches(lower(publisher_raw), '(^|{EDGE})({WORDS})($|{EDGE})')
  UNION SELECT doc_id, 'clientId' FROM rec WHERE starts_with(client_id, 'inist.')),
reason_lists AS (SELECT doc_id, string_agg(reason, ';' ORDER BY reason) AS fr_reasons_concat FROM reasons GROUP BY doc_id),
ror_lists AS (
  SELECT doc_id, string_agg(DISTINCT ror, '|' ORDER BY ror) AS rors FROM (
    SELECT doc_id, ror FROM named_rors UNION ALL SELECT doc_id, unnest(rors) FROM publication_hits
    UNION ALL SELECT doc_id, unnest(rors) FROM orcid_hits UNION ALL SELECT doc_id, unnest(rors) FROM name_hits) GROUP BY doc_id),
local_lists AS (
  SELECT doc_id, string_agg(DISTINCT label, '|' ORDER BY label) AS local_from_publications
  FROM (SELECT doc_id, unnest(local_affiliations) AS label FROM publication_hits) GROUP BY doc_id),
linked_lists AS (
  SELECT doc_id, string_agg(doi || '@' || array_to_string(rors, ','), '|' ORDER BY i) AS linked FROM publication_hits GROUP BY doc_id),
orcid_lists AS (
  SELECT doc_id, string_agg(n || '@' || array_to_string(rors, ','), '|' ORDER BY n, i) AS by_orcid FROM orcid_hits GROUP BY doc_id),
name_lists AS (
  SELECT doc_id, string_agg(form || '@' || array_to_string(rors, ','), '|' ORDER BY form, n) AS by_name FROM name_hits GROUP BY doc_id)"""
SIDES = ", ".join([PUBS, AUTHORS, ORGS])


def signal_sql(select: str) -> str:
    return with_js(PERSONS, RECORDS, SIDES, SIGNALS) + select


@query("linked_publications", signal_sql("SELECT doc_id AS rec_id, linked FROM linked_lists"))
def _(spark, sf_dir):
    found = S.linked_publications(typed_records(spark, sf_dir), publications(spark, sf_dir))
    linked = F.transform(
        "fr_publications_linked", lambda x: F.concat_ws("@", x["doi"], F.array_join(x["rors"], ","))
    )
    return found.select("rec_id", F.array_join(linked, "|").alias("linked"))


LINKS = (
    "SELECT concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS rec_id, "
    "CASE l_linenumber % 3 WHEN 0 THEN 'IsSupplementTo' WHEN 1 THEN 'IsCitedBy' ELSE 'IsSupplementTo' END AS relation, "
    "'10.7777/PUB.' || CAST(l_orderkey AS STRING) AS identifier FROM lineitem"
)


@query(
    "linked_publications_of_lines",
    f"WITH {PUBS} SELECT rec_id, doi, CAST(len(rors) AS INTEGER) AS n_rors FROM ({LINKS}) JOIN pubs ON doi = lower(identifier) WHERE relation = 'IsSupplementTo'",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, LINKS)
    related = F.array(
        F.struct(
            F.col("relation").alias("relationType"),
            F.col("identifier").alias("relatedIdentifier"),
            F.lit("DOI").alias("relatedIdentifierType"),
        )
    )
    found = S.linked_publications(rows.select("rec_id", related.alias("related")), publications(spark, sf_dir))
    return found.select("rec_id", F.inline("fr_publications_linked")).select("rec_id", "doi", F.size("rors").alias("n_rors"))


@query(
    "orcid_signal",
    signal_sql("SELECT doc_id AS rec_id, author_key AS key, CAST(n AS INTEGER) AS pos, array_to_string(rors, '|') AS rors FROM orcid_hits"),
)
def _(spark, sf_dir):
    hits = S.orcid_signal(typed_records(spark, sf_dir), authors(spark, sf_dir))
    return hits.select("rec_id", "key", "pos", F.array_join("rors", "|").alias("rors"))


@query(
    "author_name_signal",
    signal_sql("SELECT doc_id AS rec_id, form AS key, CAST(n AS INTEGER) AS pos, array_to_string(rors, '|') AS rors FROM name_hits"),
)
def _(spark, sf_dir):
    hits = S.author_name_signal(typed_records(spark, sf_dir), authors(spark, sf_dir))
    return hits.select("rec_id", "key", "pos", F.array_join("rors", "|").alias("rors"))


# an own list of names that identify nobody: every second one of the built-in list
OWN_NAMES = EXCLUDED_LAST_NAMES[::2]


@query(
    "author_name_signal_own_list",
    signal_sql("SELECT doc_id AS rec_id, form AS key, CAST(n AS INTEGER) AS pos, array_to_string(rors, '|') AS rors FROM name_hits").replace(
        EXCLUDED, name_list(OWN_NAMES)
    ),
)
def _(spark, sf_dir):
    folder = shared_folder(spark)
    spark.createDataFrame([(n,) for n in OWN_NAMES], "key string").write.csv(folder, header=True)
    names = excluded_last_names(spark, folder)
    hits = S.author_name_signal(typed_records(spark, sf_dir), authors(spark, sf_dir), last_names=names)
    return hits.select("rec_id", "key", "pos", F.array_join("rors", "|").alias("rors"))


@query(
    "ror_signal",
    signal_sql("SELECT doc_id AS rec_id, named_rors.ror, orgs.ror IS NOT NULL AS is_national FROM named_rors LEFT JOIN orgs USING (ror)"),
)
def _(spark, sf_dir):
    return S.ror_signal(typed_records(spark, sf_dir), orgs(spark, sf_dir))


@query(
    "ror_signal_on_affiliation",
    with_js(PERSONS, ORGS)
    + """, named_rors AS (SELECT DISTINCT doc_id, split_part(lower(a->>'$.affiliationIdentifier'), '/', -1) AS ror
      FROM (SELECT doc_id, unnest(affs) AS a FROM named) WHERE json_type(a) = 'OBJECT' AND contains(lower(a->>'$.affiliationIdentifier'), 'ror'))
    SELECT doc_id AS rec_id, named_rors.ror, orgs.ror IS NOT NULL AS is_national FROM named_rors LEFT JOIN orgs USING (ror)""",
)
def _(spark, sf_dir):
    return S.ror_signal(typed_records(spark, sf_dir), orgs(spark, sf_dir), ror_on="affiliation")


@query(
    "keyword_reasons",
    signal_sql(
        "SELECT js.doc_id, coalesce(string_agg(reason, ';' ORDER BY reason), '') AS reasons FROM js "
        "LEFT JOIN (SELECT * FROM affiliation_hits UNION ALL SELECT * FROM name_keyword_hits) USING (doc_id) GROUP BY js.doc_id"
    ),
)
def _(spark, sf_dir):
    found = F.concat(
        S.affiliation_keyword_reasons(S.affiliation_text(F.col("people"))),
        S.name_keyword_reasons(S.normalized_names(F.col("people"))),
    )
    return typed_records(spark, sf_dir).select("doc_id", F.array_join(S.collect_reasons(found), ";").alias("reasons"))


# keywords searched in the whole text of documents and conversations
PADDED = f"' ' || {duck_normalize('text')} || ' '"


@query(
    "document_keyword_reasons",
    f"SELECT doc_id, coalesce(string_agg('affiliation_' || kw, ';' ORDER BY kw), '') AS reasons FROM (SELECT doc_id, {PADDED} AS t FROM documents) "
    f"LEFT JOIN (SELECT unnest({KEYWORDS}) AS kw) ON contains(t, kw) GROUP BY doc_id",
)
def _(spark, sf_dir):
    from citeloom.functions.text import normalize

    padded = F.concat(F.lit(" "), normalize("text"), F.lit(" "))
    rows = v.frame(spark, sf_dir, "SELECT doc_id, text FROM documents")
    return rows.select(
        "doc_id", F.array_join(S.collect_reasons(S.affiliation_keyword_reasons(padded)), ";").alias("reasons")
    )


def cut_records(spark, sf_dir) -> DataFrame:
    """The typed records, parsed and written once: signals and the wide rows behind them are branches of their own."""
    return cut_lineage(typed_records(spark, sf_dir))


def lookup(spark, sf_dir) -> DataFrame:
    return S.lookup_table(publications(spark, sf_dir), authors(spark, sf_dir), orgs(spark, sf_dir))


def signal_texts() -> list:
    people = F.transform("fr_authors_orcid", lambda x: F.array_join(x["rors"], ","))
    return [
        "fr_reasons_concat",
        F.array_join("rors", "|").alias("rors"),
        F.array_join("local_affiliations_from_publications", "|").alias("local_from_publications"),
        F.array_join(
            F.transform("fr_publications_linked", lambda x: F.concat_ws("@", x["doi"], F.array_join(x["rors"], ","))), "|"
        ).alias("linked"),
        F.array_join(people, "|").alias("by_orcid"),
        F.array_join(
            F.array_sort(
                F.transform("fr_authors_name", lambda x: F.concat_ws("@", x["author"]["name"], F.array_join(x["rors"], ",")))
            ),
            "|",
        ).alias("by_name"),
    ]


SIGNAL_COLUMNS = (
    "coalesce(fr_reasons_concat, '') AS fr_reasons_concat, coalesce(rors, '') AS rors, coalesce(local_from_publications, '') AS local_from_publications, "
    "coalesce(linked, '') AS linked, coalesce(regexp_replace(by_orcid, '[0-9]+@', '', 'g'), '') AS by_orcid, coalesce(by_name, '') AS by_name"
)
SIGNAL_JOINS = (
    "LEFT JOIN reason_lists USING (doc_id) LEFT JOIN ror_lists USING (doc_id) LEFT JOIN local_lists USING (doc_id) "
    "LEFT JOIN linked_lists USING (doc_id) LEFT JOIN orcid_lists USING (doc_id) LEFT JOIN name_lists USING (doc_id)"
)


ACCEPTED = "fr_reasons_concat <> '' AND NOT (fr_reasons_concat = 'clientId;publisher' AND coalesce(genre_raw = 'image', true))"


@query("national_signals", signal_sql(f"SELECT doc_id, {SIGNAL_COLUMNS} FROM rec {SIGNAL_JOINS} WHERE {ACCEPTED}"))
def _(spark, sf_dir):
    signalled = S.national_signals(cut_records(spark, sf_dir), lookup(spark, sf_dir))
    return signalled.select("doc_id", *signal_texts())


# ---------------------------------------------------------------- keep-first and catalogue

BATCHES = """
file_list AS (SELECT DISTINCT file_path FROM js),
batches AS (
  SELECT file_path, row_number() OVER (ORDER BY file_path DESC) AS file_rank,
    count(*) FILTER (contains(file_path, '0000.jsonl.gz')) OVER (ORDER BY file_path DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS batch
  FROM file_list)"""


def batches(spark, sf_dir) -> DataFrame:
    return D.file_batches(v.frame(spark, sf_dir, f"SELECT DISTINCT {v.FILE_PATH} AS file_path FROM documents"))


@query("file_batches", with_js(BATCHES) + "SELECT file_path, CAST(file_rank AS BIGINT) AS file_rank, CAST(batch AS BIGINT) AS batch FROM batches")
def _(spark, sf_dir):
    return batches(spark, sf_dir).select("file_path", F.col("file_rank").cast("bigint"), F.col("batch").cast("bigint"))


FIRST = "row_number() OVER (PARTITION BY batch, coalesce('k' || natural_key, 'r' || doc_id) ORDER BY file_rank, line_no) = 1"


@query(
    "keep_first",
    with_js(PERSONS, RECORDS, BATCHES)
    + f"SELECT doc_id, CAST(batch AS BIGINT) AS batch, natural_key FROM keyed JOIN batches USING (file_path) QUALIFY {FIRST}",
)
def _(spark, sf_dir):
    records = typed_records(spark, sf_dir).select("rec_id", "doc_id", "file_path", "line_no", "natural_key")
    records = records.join(batches(spark, sf_dir), "file_path")
    kept = D.keep_first(records, "natural_key", ["batch"], ["file_rank", "line_no"], "rec_id")
    return kept.select("doc_id", F.col("batch").cast("bigint"), "natural_key")


@query(
    "keep_first_by_id",
    "SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY l_orderkey",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS STRING) AS key FROM lineitem")
    return D.keep_first(rows, "key", [], ["l_linenumber"], "l_linenumber").select("l_orderkey", "l_linenumber")


@query(
    "flag_duplicates",
    "SELECT doc_id, count(*) OVER (PARTITION BY split_part(text, chr(10), 1)) > 1 AS has_duplicate FROM documents",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT doc_id, split_part(text, chr(10), 1) AS head FROM documents")
    return D.flag_duplicates(rows, "head").select("doc_id", "has_duplicate")


CATALOGUE = f"""
{BATCHES},
candidates AS (
  SELECT keyed.*, {SIGNAL_COLUMNS}, file_rank, batch FROM keyed JOIN batches USING (file_path) {SIGNAL_JOINS}
  WHERE NOT (regexp_matches(lower(id), '(^|\\.)v[0-9]+$') AND
    (coalesce(lower(publisher_text) IN ('figshare', '4tu.researchdata'), false) OR contains(lower(id), 'figshare')))),
accepted AS (
  SELECT * FROM candidates WHERE fr_reasons_concat <> '' AND NOT (fr_reasons_concat = 'clientId;publisher' AND genre_raw = 'image')),
kept AS (SELECT * FROM accepted QUALIFY {FIRST}),
{GENRES},
rows AS (
  SELECT kept.*, genre.* EXCLUDE (doc_id) FROM kept JOIN genre USING (doc_id)
  WHERE NOT contains(genre_detail, 'version') AND NOT contains(genre_detail, 'file'))"""
FORMATS_OF = f"CASE WHEN len({FORMAT_LIST}) > 0 THEN {FORMAT_LIST} ELSE [''] END"


@query(
    "catalogue",
    with_js(PERSONS, RECORDS, SIDES, SIGNALS, CATALOGUE, LISTS)
    + f"""SELECT 'doi' || rows.id AS id, rows.id AS doi, CAST(year AS VARCHAR) AS year, title, genre_raw, genre, genre_detail, nb_parts, publisher_raw,
    client_id, natural_key, {', '.join(c.strip().split(' AS ')[-1] for c in SIGNAL_COLUMNS.split(' AS ')[1:])},
    array_to_string({dois('IsSupplementTo')}, '|') AS supplement_to, array_to_string({FORMATS_OF}, '|') AS format_raw,
    array_to_string(list_transform({FORMATS_OF}, lambda raw: {DUCK_FORMAT}), '|') AS format,
    coalesce(array_to_string(local_affiliations, '|'), '') AS local_affiliations, CAST((SELECT count(*) FROM named WHERE named.doc_id = rows.doc_id) AS INTEGER) AS n_authors
    FROM rows LEFT JOIN lists ON lists.id = 'doi' || rows.id""".replace(
        ", ".join(c.strip().split(" AS ")[-1] for c in SIGNAL_COLUMNS.split(" AS ")[1:]),
        "fr_reasons_concat, rors, local_from_publications, linked, by_orcid, by_name",
    ),
)
def _(spark, sf_dir):
    return catalogue_rows(spark, sf_dir).select(
        "id", "doi", F.col("year").cast("string"), "title", "genre_raw", "genre", "genre_detail", "nb_parts", "publisher_raw",
        "client_id", "natural_key", *signal_texts(),
        F.array_join("doi_supplement_to", "|").alias("supplement_to"),
        F.array_join("format_raw", "|").alias("format_raw"),
        F.array_join("format", "|").alias("format"),
        F.coalesce(F.array_join("local_affiliations", "|"), F.lit("")).alias("local_affiliations"),
        F.size("authors").alias("n_authors"),
    )


def catalogue_rows(spark, sf_dir) -> DataFrame:
    return build_catalogue(
        cut_records(spark, sf_dir),
        lookup(spark, sf_dir),
        batches=batches(spark, sf_dir),
        batch=["batch"],
        order=["file_rank", "line_no"],
        lists=institution_lists(spark, sf_dir),
    )


SIZE_LIST = "coalesce(TRY_CAST(j->'$.attributes.sizes' AS VARCHAR[]), [])"
SIZE_MB, SIZE_UNIT = duck_size("s")
DETAILS = f"""sized AS (
  SELECT doc_id, list_filter(list_transform({SIZE_LIST}, lambda s: CAST({SIZE_MB} AS DOUBLE)), lambda m: m <> 0) AS mbs,
    list_filter(list_transform({SIZE_LIST}, lambda s: {SIZE_UNIT}), lambda u: u IS NOT NULL) AS units FROM rows),
people AS (
  SELECT doc_id, string_agg(concat_ws('@', role, full_name, orcid), '|' ORDER BY n) AS authors FROM named GROUP BY doc_id),
part_of AS (
  SELECT doc_id, array_to_string(list_transform(list_filter({items('relatedIdentifiers')}, lambda e: (e->>'$.relatedIdentifierType') = 'DOI' AND
    (e->>'$.relationType') = 'IsPartOf'), lambda e: concat_ws('@', e->>'$.relatedIdentifier', e->>'$.relatedIdentifierType', e->>'$.relationType',
    e->>'$.resourceTypeGeneral', e->>'$.schemeUri', CAST(len(json_keys(e)) AS VARCHAR))), '|') AS subparts FROM rows)"""


def whole_relation(relation):
    fields = ("relatedIdentifier", "relatedIdentifierType", "relationType", "resourceTypeGeneral", "schemeUri")
    n_keys = F.size(F.map_keys(F.try_variant_get(relation, "$", "map<string,string>")))
    return F.concat_ws("@", *[F.try_variant_get(relation, f"$.{f}", "string") for f in fields], n_keys.cast("string"))


@query(
    "catalogue_details",
    with_js(PERSONS, RECORDS, SIDES.replace("people AS", "author_people AS").replace("FROM people", "FROM author_people"), SIGNALS, CATALOGUE, DETAILS)
    + f"""SELECT 'doi' || id AS id, 'datacite@' || id AS external_ids, {DUCK_PUBLISHER.replace('publisher', 'publisher_raw')} AS publisher, {descriptions('Abstract')} || '@' || {attribute('language')} AS abstract,
    {descriptions('Methods')} AS methods, {descriptions('Other')} AS description, coalesce(authors, '') AS authors, subparts,
    CAST(list_sum(mbs) AS DOUBLE) AS size_total_mb, array_to_string(units, '|') AS units, len(mbs) > 0 AS has_size,
    CASE WHEN len(mbs) = 0 THEN 'N/A' WHEN list_sum(mbs) < 1 THEN '< 1 Mo' WHEN list_sum(mbs) <= 10 THEN '1 - 10 Mo' WHEN list_sum(mbs) <= 100 THEN '10 - 100 Mo'
    WHEN list_sum(mbs) <= 1000 THEN '100Mo - 1 Go' ELSE '>= 1 Go' END AS size_cat, {attribute('url')} AS url, {attribute('updated')} AS update_date,
    array_to_string({dois('IsVersionOf')}, '|') AS version_of
    FROM rows LEFT JOIN sized USING (doc_id) LEFT JOIN people USING (doc_id) LEFT JOIN part_of USING (doc_id)""",
)
def _(spark, sf_dir):
    return catalogue_rows(spark, sf_dir).select(
        "id", joined("external_ids", "id_type", "id_value").alias("external_ids"), "publisher",
        joined("abstract", "abstract", "lang").alias("abstract"), "methods", "description",
        joined("authors", "role", "full_name", "orcid").alias("authors"),
        F.array_join(F.transform("subparts", whole_relation), "|").alias("subparts"),
        "size_total_mb", F.array_join("units", "|").alias("units"), "has_size", "size_cat", "url", "update_date",
        F.array_join("doi_version_of", "|").alias("version_of"),
    )


@query(
    "run_counters",
    with_js(PERSONS, RECORDS, SIDES, SIGNALS, CATALOGUE)
    + """SELECT file_path, CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_country,
    CAST(count(*) FILTER (regexp_matches(fr_reasons_concat, '(^|;)publisher(;|$)')) AS BIGINT) AS n_publisher,
    CAST(count(*) FILTER (regexp_matches(fr_reasons_concat, '(^|;)clientId(;|$)')) AS BIGINT) AS n_client,
    CAST(count(*) FILTER (doc_id IN (SELECT doc_id FROM rows)) AS BIGINT) AS n_kept
    FROM candidates GROUP BY file_path""",
)
def _(spark, sf_dir):
    records = D.drop_version_copies(cut_records(spark, sf_dir))
    reasons = cut_lineage(S.national_reasons(records, lookup(spark, sf_dir)))
    kept = kept_records(
        records, lookup(spark, sf_dir), reasons=reasons, batches=batches(spark, sf_dir), batch=["batch"], order=["file_rank", "line_no"]
    )
    return C.run_counters(records, reasons, kept, "file_path")


# ---------------------------------------------------------------- affiliation tables


def detailed_rows(spark, sf_dir) -> DataFrame:
    return v.frame(spark, sf_dir, v.customer_affiliations_sql())


def match_results(spark, sf_dir) -> DataFrame:
    """Results in the long shape of the matcher: one row per type and query."""
    rows = v.frame(spark, sf_dir, v.match_results_sql())
    results = [
        rows.select(
            F.lit(t).alias("match_type"), "query", F.filter(F.split(F.col(t), r"\|"), lambda x: x != "").alias("results")
        ).where("results IS NOT NULL")
        for t in A.MATCH_TYPES
    ]
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def matched_rows(spark, sf_dir) -> DataFrame:
    return A.match_affiliations(A.consolidate(detailed_rows(spark, sf_dir)), match_results(spark, sf_dir))


def split_or_empty(c: str) -> str:
    return f"list_filter(coalesce(string_split({c}, '|'), []), lambda x: x <> '')"


MATCHED = f"""detailed AS (SELECT * FROM ({v.customer_affiliations_sql()})),
consolidated AS (SELECT DISTINCT doi_publisher, doi_client_id, affiliation FROM detailed),
results AS (SELECT * FROM ({v.match_results_sql()})),
flagged AS (
  SELECT c.*, {split_or_empty('country')} AS countries, {split_or_empty('grid')} AS g, {split_or_empty('rnsr')} AS r, {split_or_empty('ror')} AS o,
    coalesce({DUCK_FOLD.format('doi_publisher')} IN ('recherche data gouv', 'universite de lorraine', 'nakala', 'cirad', 'inrae', 'datasuds'), false) AS is_publisher_fr,
    coalesce(starts_with({DUCK_FOLD.format('doi_client_id')}, 'inist.'), false) AS is_clientId_fr,
    len(list_intersect({split_or_empty('country')}, [{CODES}])) > 0 AS is_countries_fr
  FROM consolidated c LEFT JOIN results ON query = affiliation),
matched AS (
  SELECT doi_publisher, doi_client_id, affiliation, countries, is_publisher_fr, is_clientId_fr, is_countries_fr,
    CASE WHEN nat THEN g ELSE [] END AS grid, CASE WHEN nat THEN r ELSE [] END AS rnsr, CASE WHEN nat THEN o ELSE [] END AS ror
  FROM (SELECT *, is_publisher_fr OR is_clientId_fr OR is_countries_fr AS nat FROM flagged))"""
LIST_TEXTS = ", ".join(f"array_to_string({c}, '|') AS {c}" for c in ("countries", "grid", "rnsr", "ror"))


def list_texts() -> list:
    return [F.array_join(c, "|").alias(c) for c in ("countries", "grid", "rnsr", "ror")]


@query(
    "match_affiliations",
    f"WITH {MATCHED} SELECT doi_publisher, doi_client_id, affiliation, is_publisher_fr, is_clientId_fr, is_countries_fr, {LIST_TEXTS} FROM matched",
)
def _(spark, sf_dir):
    flags = ["is_publisher_fr", "is_clientId_fr", "is_countries_fr"]
    return matched_rows(spark, sf_dir).select(*A.CONSOLIDATED, *flags, *list_texts())


MERGED = f"""{MATCHED},
merged AS (
  SELECT DISTINCT d.doi_id AS doi, d.doi_file_name, nullif(m.affiliation, '') AS affiliation, countries, ror, grid, rnsr, d.type AS creator_contributor,
    is_publisher_fr, is_clientId_fr, is_countries_fr
  FROM matched m LEFT JOIN detailed d ON nullif(m.doi_publisher, '') IS NOT DISTINCT FROM nullif(d.doi_publisher, '')
    AND nullif(m.doi_client_id, '') IS NOT DISTINCT FROM nullif(d.doi_client_id, '') AND nullif(m.affiliation, '') IS NOT DISTINCT FROM nullif(d.affiliation, ''))"""


def merged_rows(spark, sf_dir) -> DataFrame:
    return A.merge_affiliations(matched_rows(spark, sf_dir), detailed_rows(spark, sf_dir))


@query(
    "merge_affiliations",
    f"WITH {MERGED} SELECT doi, doi_file_name, affiliation, creator_contributor, is_publisher_fr, is_clientId_fr, is_countries_fr, {LIST_TEXTS} FROM merged",
)
def _(spark, sf_dir):
    plain = ["doi", "doi_file_name", "affiliation", "creator_contributor", "is_publisher_fr", "is_clientId_fr", "is_countries_fr"]
    return merged_rows(spark, sf_dir).select(*plain, *list_texts())


@query(
    "merge_bucketed_affiliations",
    f"WITH {MERGED} SELECT doi, doi_file_name, affiliation, creator_contributor, is_publisher_fr, is_clientId_fr, is_countries_fr, {LIST_TEXTS} FROM merged",
)
def _(spark, sf_dir):
    """The detailed rows as a table made for the merge."""
    plain = ["doi", "doi_file_name", "affiliation", "creator_contributor", "is_publisher_fr", "is_clientId_fr", "is_countries_fr"]
    table = f"detailed_{uuid.uuid4().hex}"
    A.bucket_detailed(detailed_rows(spark, sf_dir), table, shared_folder(spark), 16)
    return A.merge_bucketed(matched_rows(spark, sf_dir), table).select(*plain, *list_texts())


PROBES = (
    "SELECT DISTINCT doi_id AS doi, CASE WHEN o = 0 THEN affiliation ELSE affiliation || '?' END AS affiliation "
    f"FROM (SELECT *, length(name) % 4 AS o FROM ({v.customer_affiliations_sql()}) AS d) AS p WHERE affiliation <> ''"
)


@query(
    "affiliation_detail",
    f"""WITH {MERGED},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doi, affiliation ORDER BY creator_contributor <> 'creators', countries, ror, grid, rnsr) AS rn FROM merged)
    SELECT p.doi, p.affiliation, coalesce(creator_contributor, '') AS creator_contributor, coalesce(is_publisher_fr, false) AS is_publisher_fr,
    coalesce(is_countries_fr, false) AS is_countries_fr, {', '.join(f"coalesce(array_to_string({c}, '|'), '') AS {c}" for c in ('countries', 'grid', 'rnsr', 'ror'))}
    FROM ({PROBES}) p LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) r ON p.doi = r.doi AND p.affiliation = r.affiliation""",
)
def _(spark, sf_dir):
    found = A.affiliation_detail(v.frame(spark, sf_dir, PROBES), merged_rows(spark, sf_dir))
    return found.select("doi", "affiliation", "creator_contributor", "is_publisher_fr", "is_countries_fr", *list_texts())


CONFLICTS = (
    "SELECT o_orderkey, 'lab ' || CAST(o_custkey % 200 AS STRING) AS affiliation, "
    "CASE o_orderkey % 4 WHEN 0 THEN 'fr|be' WHEN 1 THEN 'fr' WHEN 2 THEN '' ELSE 'de|us|fr' END AS countries, "
    "CAST(o_orderkey % 7 AS STRING) || '|' || CAST(o_orderkey % 5 AS STRING) AS grid, "
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'r' || CAST(o_orderkey % 11 AS STRING) END AS rnsr, '' AS ror FROM orders"
)


def duck_best(field: str) -> str:
    lists = f"list_sort(list_filter(string_split({field}, '|'), lambda x: x <> ''))"
    return (
        f"coalesce(arg_min(array_to_string({lists}, '|'), len({lists}) * 1000000000 + o_orderkey) FILTER (len({lists}) > 0), '') AS {field}"
    )


@query(
    "resolve_conflicts",
    f"SELECT affiliation, {', '.join(duck_best(f) for f in ('countries', 'grid', 'rnsr', 'ror'))} FROM ({CONFLICTS}) GROUP BY affiliation",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, CONFLICTS)
    for f in ("countries", "grid", "rnsr", "ror"):
        rows = rows.withColumn(f, F.filter(F.split(f, r"\|"), lambda x: x != ""))
    best = A.resolve_conflicts(rows, "o_orderkey")
    return best.select(
        "affiliation", *[F.coalesce(F.array_join(f, "|"), F.lit("")).alias(f) for f in ("countries", "grid", "rnsr", "ror")]
    )


@query(
    "most_frequent",
    "SELECT o_custkey, arg_max(o_orderpriority, n * 1000000000 - seen) AS o_orderpriority FROM "
    "(SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS seen FROM orders GROUP BY ALL) GROUP BY o_custkey",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT o_custkey, o_orderpriority, o_orderkey FROM orders")
    return D.most_frequent(rows, ["o_custkey"], "o_orderpriority", "o_orderkey")


@query(
    "first_of_group",
    "SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT o_custkey, o_orderstatus, o_orderkey FROM orders")
    return D.first_of(rows, ["o_custkey"], "o_orderkey", ["o_orderstatus", "o_orderkey"])
