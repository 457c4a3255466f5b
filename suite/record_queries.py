"""Fields of DOI records, against the JSON functions of the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citeloom.functions import records as R
from citeloom.functions.values import genre_features
from citeloom.operators.affiliations import consolidate, explode_affiliations, file_stats
from citeloom.operators.dedupe import drop_version_copies
from citeloom.sources.readers import broken_lines, explode_envelopes
from citeloom.sources.sinks import null_if_empty
from suite import views as v
from suite.registry import query
from suite.text_queries import duck_strip

KEEP = ("doc_id", "file_path", "line_no")


def raw_records(spark, sf_dir) -> DataFrame:
    return R.parse_records(v.frame(spark, sf_dir, v.record_json(v.SPARK)), keep=KEEP)


def typed_records(spark, sf_dir) -> DataFrame:
    return R.record_columns(raw_records(spark, sf_dir), keep=KEEP).withColumn("rec_id", F.col("doc_id"))


def joined(c, *fields: str):
    """An array of structs as one text."""
    return F.array_join(F.transform(c, lambda x: F.concat_ws("@", *[x[f] for f in fields])), "|")


# ---------------------------------------------------------------- the same in DuckDB


def items(field: str) -> str:
    return f"list_filter(coalesce(TRY_CAST(j->'$.attributes.{field}' AS JSON[]), []), lambda e: e IS NOT NULL AND json_type(e) <> 'NULL')"


def texts(field: str, path: str, condition: str = "true") -> str:
    """Non-empty texts at a path of the elements that meet a condition."""
    return (
        f"list_filter(list_transform(list_filter({items(field)}, lambda e: {condition}), lambda e: e->>'{path}'), lambda x: x <> '')"
    )


def attribute(name: str) -> str:
    return f"(j->>'$.attributes.{name}')"


TITLE = (
    f"CASE WHEN len(list_filter({items('titles')}, lambda e: len(json_keys(e)) > 0 AND NOT json_exists(e, '$.title'))) > 0 THEN '' "
    f"ELSE trim(array_to_string({texts('titles', '$.title')}, ' ')) END"
)
YEAR = (
    f"CASE WHEN regexp_matches({attribute('publicationYear')}, '^\\s*[+-]?[0-9]+\\s*$') THEN CAST({attribute('publicationYear')} AS INTEGER) END"
)
DUCK_JS = f"js AS (SELECT doc_id, file_path, line_no, CAST(value AS JSON) AS j FROM ({v.record_json(v.DUCK)}))"


def fos(e: str) -> str:
    return f"ltrim({e}, 'FOS: ')"


FOS_ITEM = "(e->>'$.subjectScheme') = 'Fields of Science and Technology (FOS)'"


def descriptions(kind: str) -> str:
    chosen = texts(
        "descriptions", "$.description",
        f"(e->>'$.descriptionType') = '{kind}' AND json_type(e->'$.description') = 'VARCHAR'",
    )
    return duck_strip(f"array_to_string({chosen}, ' ')")


def dois(relation: str) -> str:
    return texts(
        "relatedIdentifiers", "$.relatedIdentifier",
        f"(e->>'$.relationType') = '{relation}' AND (e->>'$.relatedIdentifierType') = 'DOI'",
    )


PERSONS = """
numbered AS (
  SELECT doc_id, 'creator' AS role, 0 AS r, unnest(CAST(j->'$.attributes.creators' AS JSON[])) AS p,
    generate_subscripts(CAST(j->'$.attributes.creators' AS JSON[]), 1) AS pos FROM js
  UNION ALL
  SELECT doc_id, 'contributor', 1, unnest(coalesce(TRY_CAST(j->'$.attributes.contributors' AS JSON[]), [])),
    generate_subscripts(coalesce(TRY_CAST(j->'$.attributes.contributors' AS JSON[]), []), 1) FROM js),
persons AS (
  SELECT *, p->>'$.name' AS name, p->>'$.givenName' AS given, p->>'$.familyName' AS family,
    row_number() OVER (PARTITION BY doc_id ORDER BY r, pos) - 1 AS n,
    CASE json_type(p->'$.nameIdentifiers') WHEN 'ARRAY' THEN CAST(p->'$.nameIdentifiers' AS JSON[])
      WHEN 'OBJECT' THEN [p->'$.nameIdentifiers'] ELSE [] END AS ids,
    CASE json_type(p->'$.affiliation') WHEN 'ARRAY' THEN CAST(p->'$.affiliation' AS JSON[]) ELSE [] END AS affs
  FROM numbered WHERE p IS NOT NULL AND json_type(p) <> 'NULL'),
named AS (
  SELECT *, coalesce(nullif(trim(concat_ws(' ', nullif(given, ''), nullif(family, ''))), ''), trim(nullif(name, ''))) AS full_name,
    split_part(list_filter(ids, lambda i: (i->>'$.nameIdentifierScheme') = 'ORCID')[-1]->>'$.nameIdentifier', '/', -1) AS orcid
  FROM persons)"""

RECORDS = f"""
rec AS (
  SELECT doc_id, file_path, line_no, j, j->>'$.id' AS id, {TITLE} AS title, {YEAR} AS year,
    CASE WHEN json_type(j, '$.attributes.publicationYear') IN ('UBIGINT', 'BIGINT') THEN {YEAR} END AS lookup_year,
    CASE WHEN json_type(j, '$.attributes.publisher') = 'OBJECT' THEN coalesce(j->>'$.attributes.publisher.name', '') ELSE '' END AS publisher_raw,
    CASE WHEN json_type(j, '$.attributes.publisher') = 'VARCHAR' THEN {attribute('publisher')} END AS publisher_text,
    coalesce(j->>'$.relationships.client.data.id', '') AS client_id,
    lower(coalesce(j->>'$.attributes.types.resourceTypeGeneral', '')) AS genre_raw
  FROM js),
firsts AS (SELECT doc_id, full_name FROM named WHERE r = 0 AND pos = 1),
keyed AS (
  SELECT rec.*, CASE WHEN title <> '' AND full_name <> '' AND year <> 0 AND publisher_raw <> ''
    THEN concat_ws(';', title, full_name, CAST(year AS VARCHAR), publisher_raw) END AS natural_key
  FROM rec LEFT JOIN firsts USING (doc_id))"""


def with_js(*ctes: str) -> str:
    return "WITH " + ", ".join([DUCK_JS, *ctes]) + "\n"


@query(
    "record_scalars",
    with_js(PERSONS, RECORDS)
    + f"SELECT doc_id, id, title, CAST(year AS VARCHAR) AS year, CAST(lookup_year AS VARCHAR) AS lookup_year, publisher_raw, publisher_text, client_id, genre_raw, natural_key, "
    f"{attribute('language')} AS language, {attribute('url')} AS url, {attribute('created')} AS created, "
    f"coalesce({attribute('registered')}, '') AS registered, {attribute('updated')} AS update_date, "
    "lower(j->>'$.attributes.types.resourceType') AS resourceType FROM keyed",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select(
        "doc_id", "id", "title", F.col("year").cast("string"), F.col("lookup_year").cast("string"), "publisher_raw", "publisher_text", "client_id", "genre_raw",
        "natural_key", "language", "url", "created", "registered", "update_date", "resourceType",
    )


@query(
    "record_descriptions",
    with_js()
    + f"SELECT doc_id, {descriptions('Abstract')} AS abstract, {descriptions('Other')} AS description, {descriptions('Methods')} AS methods FROM js",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select(
        "doc_id", F.col("abstract_text").alias("abstract"), "description", "methods"
    )


PLAIN_SUBJECTS = texts("subjects", "$.subject", "NOT json_exists(e, '$.subjectScheme')")
FOS_SUBJECTS = f"list_filter(list_transform({texts('subjects', '$.subject', FOS_ITEM)}, lambda x: {fos('x')}), lambda x: x <> '')"


@query(
    "record_classifications",
    with_js()
    + f"""SELECT doc_id, array_to_string({PLAIN_SUBJECTS}, '|') AS plain, array_to_string({FOS_SUBJECTS}, '|') AS fos,
    array_to_string(list_transform(list_filter(list_zip(c, range(len(c))), lambda z: NOT list_contains(c[1:z[2]], z[1])), lambda z: z[1]), '|') AS classifications
    FROM (SELECT *, list_concat(list_transform({PLAIN_SUBJECTS}, lambda x: x || '@subject-datacite'),
      list_transform({FOS_SUBJECTS}, lambda x: x || '@FOS-datacite')) AS c FROM js)""",
)
def _(spark, sf_dir):
    return raw_records(spark, sf_dir).select(
        "doc_id",
        F.array_join(R.subjects_plain(F.col("subjects")), "|").alias("plain"),
        F.array_join(R.subjects_fos(F.col("subjects")), "|").alias("fos"),
        joined(R.classifications(F.col("subjects")), "label", "reference").alias("classifications"),
    )


@query(
    "record_licenses",
    with_js()
    + f"""SELECT doc_id, CASE WHEN len(list_filter({items('rightsList')}, lambda e: len(json_keys(e)) > 0 AND NOT json_exists(e, '$.rightsIdentifier'))) > 0
    THEN '' ELSE array_to_string(list_sort(list_distinct(list_transform({texts('rightsList', '$.rightsIdentifier')}, lambda x: lower(trim(x))))), '|') END AS licenses FROM js""",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select("doc_id", F.array_join("licenses", "|").alias("licenses"))


GRANT = "concat_ws('@', nullif(e->>'$.funderName', ''), nullif(e->>'$.awardNumber', ''))"


@query(
    "record_grants",
    with_js()
    + f"SELECT doc_id, array_to_string(list_filter(list_transform({items('fundingReferences')}, lambda e: {GRANT}), lambda x: x <> ''), '|') AS grants FROM js",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select("doc_id", joined("grants", "agency", "grantid").alias("grants"))


@query(
    "related_dois",
    with_js()
    + f"SELECT doc_id, array_to_string({dois('IsSupplementTo')}, '|') AS supplement_to, array_to_string({dois('IsVersionOf')}, '|') AS version_of FROM js",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select(
        "doc_id",
        F.array_join(R.related_dois(F.col("related"), "IsSupplementTo"), "|").alias("supplement_to"),
        F.array_join(R.related_dois(F.col("related"), "IsVersionOf"), "|").alias("version_of"),
    )


FORMAT_LIST = (
    "CASE json_type(j, '$.attributes.formats') WHEN 'ARRAY' THEN CAST(j->'$.attributes.formats' AS VARCHAR[]) WHEN 'VARCHAR' THEN "
    f"[{attribute('formats')}] ELSE [] END"
)


@query(
    "raw_lists",
    with_js()
    + f"""SELECT doc_id, array_to_string(CASE WHEN len({FORMAT_LIST}) > 0 THEN {FORMAT_LIST} ELSE [''] END, '|') AS formats,
    CAST(len(CASE WHEN len({FORMAT_LIST}) > 0 THEN {FORMAT_LIST} ELSE [''] END) AS BIGINT) AS n_formats,
    array_to_string(TRY_CAST(j->'$.attributes.sizes' AS VARCHAR[]), '|') AS sizes,
    array_to_string(list_transform({items('relatedIdentifiers')}, lambda e: concat_ws('@', e->>'$.relationType', e->>'$.relatedIdentifier', e->>'$.relatedIdentifierType')), '|') AS related
    FROM js""",
)
def _(spark, sf_dir):
    return typed_records(spark, sf_dir).select(
        "doc_id",
        F.array_join("format_raw", "|").alias("formats"),
        F.size("format_raw").cast("bigint").alias("n_formats"),
        F.array_join("size", "|").alias("sizes"),
        joined("related", "relationType", "relatedIdentifier", "relatedIdentifierType").alias("related"),
    )


@query(
    "record_authors",
    with_js(PERSONS)
    + "SELECT doc_id, CAST(n AS BIGINT) AS n, role, nullif(given, '') AS first_name, nullif(family, '') AS last_name, full_name, orcid, CAST(len(affs) AS BIGINT) AS n_affiliations FROM named",
)
def _(spark, sf_dir):
    rows = typed_records(spark, sf_dir).select("doc_id", F.posexplode(R.authors(F.col("people"))).alias("n", "a"))
    return rows.select(
        "doc_id", F.col("n").cast("bigint").alias("n"), "a.role", "a.first_name", "a.last_name", "a.full_name", "a.orcid",
        F.coalesce(F.size("a.affiliations"), F.lit(0)).cast("bigint").alias("n_affiliations"),
    )


@query(
    "record_affiliations",
    with_js(PERSONS)
    + """, listed AS (SELECT doc_id, n, unnest(affs) AS a, generate_subscripts(affs, 1) AS i FROM named),
    firsts AS (SELECT doc_id, CAST(a AS VARCHAR) AS t, min(n * 1000 + i) AS place FROM listed GROUP BY doc_id, CAST(a AS VARCHAR)),
    shown AS (SELECT doc_id, place, coalesce(CASE WHEN json_type(CAST(t AS JSON)) = 'VARCHAR' THEN CAST(t AS JSON)->>'$' ELSE CAST(t AS JSON)->>'$.name' END, '~') AS name FROM firsts)
    SELECT js.doc_id, coalesce(string_agg(name, '|' ORDER BY place), '') AS affiliations FROM js LEFT JOIN shown USING (doc_id) GROUP BY js.doc_id""",
)
def _(spark, sf_dir):
    def name(a):
        return F.coalesce(R.text_only(a), F.try_variant_get(a, "$.name", "string"), F.lit("~"))

    listed = F.transform(R.record_affiliations(F.col("people")), name)
    return typed_records(spark, sf_dir).select("doc_id", F.array_join(listed, "|").alias("affiliations"))


@query(
    "people_with_affiliations",
    with_js(PERSONS)
    + """, told AS (SELECT doc_id, n, full_name, list_transform(list_filter(affs, lambda a: json_type(a) = 'OBJECT'),
      lambda a: concat_ws(',', nullif(a->>'$.affiliationIdentifier', ''), nullif(a->>'$.affiliationIdentifierScheme', ''), nullif(a->>'$.name', ''))) AS t
      FROM named WHERE len(list_filter(affs, lambda a: json_type(a) = 'OBJECT')) > 0)
    SELECT js.doc_id, coalesce(string_agg(full_name || '@' || array_to_string(t, ';'), '|' ORDER BY n), '') AS people
    FROM js LEFT JOIN told USING (doc_id) GROUP BY js.doc_id""",
)
def _(spark, sf_dir):
    def mapped(a):
        maps = F.transform(a["affiliations"], lambda x: F.try_variant_get(x, "$", "map<string,string>"))
        maps = F.filter(maps, lambda m: m.isNotNull())
        return F.struct(
            *[a[f].alias(f) for f in ("role", "first_name", "last_name", "full_name", "orcid")],
            F.when(F.size(maps) > 0, maps).alias("affiliations"),
        )

    people = R.strip_people(F.transform(R.authors(F.col("people")), mapped))
    told = F.transform(
        people,
        lambda p: F.concat(
            p["full_name"], F.lit("@"),
            F.array_join(F.transform(p["affiliations"], lambda m: F.array_join(F.map_values(m), ",")), ";"),
        ),
    )
    return typed_records(spark, sf_dir).select("doc_id", F.array_join(told, "|").alias("people"))


@query(
    "safe_values",
    "SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) = 0 THEN 'none' ELSE coalesce(json_extract_string(props, '$.k'), 'none') END AS k, "
    "'none' AS missing FROM events",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT event_id, parse_json(props) AS p FROM events")
    return rows.select(
        "event_id", R.safe_get("p", "$.k", "none").alias("k"), R.safe_get("p", "$.x.y", "none").alias("missing")
    )


GENRES = f"""genres AS (
  SELECT doc_id, genre_raw, publisher_raw, list_filter({items('relatedIdentifiers')}, lambda e: (e->>'$.relatedIdentifierType') = 'DOI') AS rel FROM rec),
decided AS (
  SELECT *, CASE list_filter(rel, lambda e: (e->>'$.relationType') IN ('IsVersionOf', 'IsPartOf', 'IsIdenticalTo'))[-1]->>'$.relationType'
      WHEN 'IsVersionOf' THEN 'version' WHEN 'IsPartOf' THEN 'file' WHEN 'IsIdenticalTo' THEN 'identical' END AS override,
    CASE WHEN publisher_raw IN ('HEPData', 'PANGAEA') THEN 'dataset' ELSE CASE genre_raw WHEN 'journalarticle' THEN 'journal-article'
      WHEN 'bookchapter' THEN 'book-chapter' WHEN 'book' THEN 'book' WHEN 'conferencepaper' THEN 'proceedings' WHEN 'conferenceproceeding' THEN 'proceedings'
      WHEN 'dataset' THEN 'dataset' WHEN 'image' THEN 'dataset' WHEN 'sound' THEN 'dataset' WHEN 'audiovisual' THEN 'dataset' WHEN 'film' THEN 'dataset'
      WHEN 'physicalobject' THEN 'dataset' WHEN 'datapaper' THEN 'datapaper' ELSE 'other' END END AS base,
    CAST(len(list_filter(rel, lambda e: (e->>'$.relationType') = 'HasPart')) AS INTEGER) AS nb_parts,
    CAST(len(list_filter(rel, lambda e: (e->>'$.relationType') = 'IsPartOf')) AS INTEGER) AS nb_subparts FROM genres),
genre AS (
  SELECT doc_id, coalesce(override, base) AS genre, CASE WHEN override IS NOT NULL THEN override || '_' || genre_raw ELSE genre_raw END AS genre_detail,
    nb_parts, nb_subparts FROM decided)"""


@query("record_genres", with_js(RECORDS.split("firsts AS")[0].rstrip().rstrip(","), GENRES) + "SELECT * FROM genre")
def _(spark, sf_dir):
    g = genre_features(F.col("genre_raw"), F.col("publisher_raw"), F.col("related"))
    rows = typed_records(spark, sf_dir).select("doc_id", g.alias("g"))
    return rows.select("doc_id", "g.genre", "g.genre_detail", "g.nb_parts", F.size("g.subparts").alias("nb_subparts"))


@query(
    "without_version_copies",
    with_js(RECORDS.split("firsts AS")[0].rstrip().rstrip(","))
    + "SELECT doc_id, id FROM rec WHERE NOT (regexp_matches(lower(id), '(^|\\.)v[0-9]+$') AND "
    "(coalesce(lower(publisher_text) IN ('figshare', '4tu.researchdata'), false) OR contains(lower(id), 'figshare')))",
)
def _(spark, sf_dir):
    return drop_version_copies(typed_records(spark, sf_dir)).select("doc_id", "id")


SPARSE = (
    "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment, "
    "CASE WHEN c_custkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS balance, c_nationkey FROM customer"
)


@query(
    "empty_to_null",
    f"SELECT c_custkey, nullif(name, '') AS name, nullif(segment, '') AS segment, CASE WHEN NOT isnan(balance) THEN balance END AS balance, "
    f"name = '' AS no_list, name = '' AND segment = '' AS no_struct FROM ({SPARSE})",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, SPARSE).withColumns(
        {"listed": R.not_empty(F.array("name")), "pair": F.struct("name", "segment")}
    )
    return null_if_empty(rows).select(
        "c_custkey", "name", "segment", "balance", F.col("listed").isNull().alias("no_list"), F.col("pair").isNull().alias("no_struct")
    )


# ---------------------------------------------------------------- envelopes and affiliations


# good elements between ones that are no objects: as many as the remainder of the id says
BROKEN = (
    "SELECT doc_id, '{\"id\":\"10.1/' || CAST(doc_id AS STRING) || '\",\"attributes\":{\"creators\":[{\"name\":\"A\"},\"x\",null,{\"name\":\"B ' || source || '\"},5],"
    "\"contributors\":' || CASE WHEN doc_id % 3 = 0 THEN '[[1],{\"name\":\"C\"}]' ELSE '[]' END || ',\"titles\":[\"t\",{\"title\":\"T' || lang || '\"}],"
    "\"relatedIdentifiers\":[true,{\"relationType\":\"IsSupplementTo\",\"relatedIdentifierType\":\"DOI\",\"relatedIdentifier\":\"10.2/' || CAST(doc_id AS STRING) || '\"}]}}' AS value FROM documents"
)


@query(
    "broken_elements",
    "SELECT doc_id, 'T' || lang AS title, 'A|B ' || source || CASE WHEN doc_id % 3 = 0 THEN '|C' ELSE '' END AS names, "
    "'10.2/' || doc_id AS linked, CAST(4 + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS unreadable FROM documents",
)
def _(spark, sf_dir):
    raw = R.parse_records(v.frame(spark, sf_dir, BROKEN), keep=("doc_id",))
    return R.record_columns(raw, keep=("doc_id", "unreadable")).select(
        "doc_id", "title", F.array_join(F.transform("people", lambda p: p["person"]["name"]), "|").alias("names"),
        F.array_join(R.related_dois(F.col("related"), "IsSupplementTo"), "|").alias("linked"), "unreadable",
    )


def envelope_lines(spark, sf_dir) -> DataFrame:
    """Ten records per line, and a blank and a broken line for each of them."""
    rows = v.frame(spark, sf_dir, v.record_json(v.SPARK)).withColumn("page", F.floor(F.col("doc_id") / 10))
    name = F.substring_index("file_path", "dump/", -1).alias("origin_file")
    pages = rows.groupBy(name, "page").agg(F.collect_list("value").alias("records"))
    line = F.concat(F.lit('{"data":['), F.array_join("records", ","), F.lit("]}"))
    return pages.select("origin_file", F.explode(F.array(line, F.lit("  "), F.lit('{"data":[{'))).alias("value"))


FILE = "replace(file_path, 'dump/', '')"


@query("read_envelopes", with_js() + f"SELECT {FILE} AS origin_file, j->>'$.id' AS id, j->>'$.attributes.url' AS url FROM js")
def _(spark, sf_dir):
    return explode_envelopes(envelope_lines(spark, sf_dir), keep=("origin_file",)).select("origin_file", "id", "url")


@query(
    "broken_lines",
    f"SELECT {FILE} AS origin_file, CAST(2 * count(DISTINCT floor(doc_id / 10)) AS BIGINT) AS lines, CAST(count(DISTINCT floor(doc_id / 10)) AS BIGINT) AS broken "
    f"FROM (SELECT doc_id, {v.FILE_PATH} AS file_path FROM documents) GROUP BY 1",
)
def _(spark, sf_dir):
    return broken_lines(envelope_lines(spark, sf_dir))


AFFILIATION_TEXT = (
    "CASE WHEN a IS NULL OR json_type(a) = 'NULL' THEN '' WHEN json_type(a) = 'VARCHAR' THEN lower(a->>'$') "
    "ELSE lower(coalesce(a->>'$.affiliationIdentifier', nullif(a->>'$.name', ''), '')) END"
)
DETAILED = f"""detailed AS (
  SELECT lower(j->>'$.id') AS doi_id, replace(replace(replace(lower(j->>'$.id'), '/', '_'), ':', '-'), '*', '') AS doi_file_name,
    role || 's' AS type, trim(coalesce(nullif(name, ''), coalesce(given, '') || ' ' || coalesce(family, ''))) AS name,
    lower(publisher_raw) AS doi_publisher, client_id AS doi_client_id, {AFFILIATION_TEXT} AS affiliation, file_path AS origin_file
  FROM (SELECT doc_id, role, name, given, family, unnest(CASE WHEN len(affs) > 0 THEN affs ELSE [NULL] END) AS a FROM named)
  JOIN rec USING (doc_id))"""


@query("affiliation_rows", with_js(PERSONS, RECORDS, DETAILED) + "SELECT * FROM detailed")
def _(spark, sf_dir):
    return explode_affiliations(raw_records(spark, sf_dir), origin="file_path")


@query(
    "consolidated_affiliations",
    with_js(PERSONS, RECORDS, DETAILED) + "SELECT DISTINCT doi_publisher, doi_client_id, affiliation FROM detailed",
)
def _(spark, sf_dir):
    return consolidate(explode_affiliations(raw_records(spark, sf_dir), origin="file_path"))


@query(
    "file_statistics",
    with_js(PERSONS)
    + """SELECT file_path AS file_name, CAST(count(*) AS BIGINT) AS number_of_dois,
    CAST(count(*) FILTER (n_people = 0) AS BIGINT) AS number_of_dois_with_null_attributes,
    CAST(count(*) FILTER (n_people > 0) AS BIGINT) AS number_of_non_null_dois
    FROM (SELECT js.doc_id, any_value(file_path) AS file_path, count(named.doc_id) AS n_people FROM js LEFT JOIN named USING (doc_id) GROUP BY js.doc_id)
    GROUP BY file_path""",
)
def _(spark, sf_dir):
    return file_stats(raw_records(spark, sf_dir), origin="file_path")
