"""Inputs derived from the driver's tables, as the same SQL for both engines.

Every view is a function of whole tables: no row is left out. Attributes the tables do not
have (publishers, people, relations, ...) are spelled from the row's own numbers.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from citeloom.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents pages conversations labels benchmark"
).split()
TEXT_TABLES = ["documents", "conversations", "pages"]

SPARK, DUCK = "spark", "duck"


def case(number: str, *values: str) -> str:
    """CASE over the remainder of a number; the last value is the ELSE."""
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {number} {whens} ELSE {values[-1]} END"


def json_text(expr: str, engine: str) -> str:
    """A text as JSON string, quotes included."""
    if engine == DUCK:
        return f"CAST(to_json({expr}) AS VARCHAR)"
    escaped = expr
    for code, letter in ((92, "chr(92)"), (34, "'\"'"), (10, "'n'"), (13, "'r'"), (9, "'t'")):
        escaped = f"replace({escaped}, chr({code}), chr(92) || {letter})"
    return f"concat('\"', {escaped}, '\"')"


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def quotient(expr: str, by: int) -> str:
    return f"CAST(floor(({expr}) / {by}) AS BIGINT)"


# ---------------------------------------------------------------- people


def base_number(k: str) -> str:
    """People 4, 9, 14, ... bear the name of the person before them."""
    return f"(CASE WHEN {k} % 5 = 4 THEN {k} - 1 ELSE {k} END)"


def letters(k: str) -> str:
    return f"chr(97 + CAST({k} % 26 AS INT)) || chr(97 + CAST({quotient(k, 26)} % 26 AS INT)) || chr(97 + CAST({quotient(k, 676)} % 26 AS INT))"


def given_name(k: str) -> str:
    b = base_number(k)
    names = case(f"{b} % 8", "'Anne'", "'José'", "'Li'", "'Marie-Claude'", "'Çağla'", "'Jean'", "'Zoë'", "'Émile'")
    return f"(CASE WHEN {k} = 7 THEN 'Anne' ELSE {names} END)"


def family_name(k: str) -> str:
    b = base_number(k)
    names = case(
        f"{b} % 12", "'Houlès'", "'Dupont'", "'Müller'", "'Wang'", "'Garçon'", "'Martin'", "'Œstreich'", "'Ñandú'",
        "'Kováč'", "'Lefèvre'", "'Åström'", "'Cheng'",
    )
    return f"(CASE WHEN {k} = 7 THEN 'Houlès' ELSE {names} || ' ' || {letters(b)} END)"


def orcid(k: str) -> str:
    def digits(e: str) -> str:
        return f"lpad({text(e)}, 4, '0')"

    return f"'0000-000' || {text(f'{k} % 10')} || '-' || {digits(k)} || '-' || {digits(f'({k} * 7) % 1000')} || 'x'"


# ---------------------------------------------------------------- records


def documents_numbered(engine: str) -> str:
    """Documents with the numbers and JSON pieces their records are spelled from."""
    numbered = (
        "SELECT doc_id, text, lang, source, n_chars AS h, (n_chars * 7) % 1500 AS k1, (doc_id * 11 + 5) % 1500 AS k2, "
        "split_part(text, chr(10), 1) AS head FROM documents"
    )
    people = ", ".join(
        f"{given_name(f'k{i}')} AS given{i}, {family_name(f'k{i}')} AS family{i}, {orcid(f'k{i}')} AS orcid{i}" for i in (1, 2)
    )
    named = f"SELECT *, {people} FROM ({numbered}) AS numbered"
    pieces = ", ".join(
        f"{json_text(f'given{i}', engine)} AS given_json{i}, {json_text(f'family{i}', engine)} AS family_json{i}, "
        f"{json_text(f'family{i} || {chr(39)}, {chr(39)} || given{i}', engine)} AS name_json{i}"
        for i in (1, 2)
    )
    return f"SELECT *, {json_text('head', engine)} AS title_json, {pieces} FROM ({named}) AS named"


RECORD_ID = (
    "CASE WHEN doc_id % 13 = 0 THEN '10.6084/m9.figshare.' || CAST(doc_id AS STRING) || "
    "CASE WHEN doc_id % 2 = 0 THEN '.v' || CAST(doc_id % 4 AS STRING) ELSE '' END "
    "ELSE '10.5555/' || source || '.' || CAST(doc_id AS STRING) || CASE WHEN doc_id % 17 = 0 THEN '.v2' ELSE '' END END"
)
PUBLISHERS = [
    '{"name":"Zenodo (CERN)"}', '{"name":"Université de Lorraine"}', '{"name":"NAKALA - https://nakala.fr (Huma-Num)"}',
    '{"name":"figshare"}', '"figshare"', '{"name":"INRAP"}', '{"name":"Portail Data INRAE"}', '{"name":"PANGAEA"}',
    '{"name":"Strasbourg (CDS)"}', '{"name":"Ifremer Sismer"}', '{"name":"FIZ Karlsruhe GmbH"}', '"UNITE Community"',
    '{"name":"École des Hautes Études en Sciences Sociales"}', "null", '{"name":"Universität Wien"}', '{"name":"HAL CCSD"}',
]
CLIENTS = ["inist.cnrs", "cern.zenodo", "figshare.ars", None, "ethz.seals", "inist.ird", "gdcc.harvard", "ethz.da", "tib.pangaea"]
TYPES = [
    '"Dataset"', '"Image"', '"JournalArticle"', '"BookChapter"', '"Book"', '"ConferencePaper"', '"Software"', '"Text"',
    '"DataPaper"', '"Film"', "null", '"Collection"',
]
AFFILIATIONS = [
    '[{"name":"CNRS UMR 5558, Lyon"}]',
    '[{"name":"Université de Nantes","affiliationIdentifier":"https://ror.org/03GNR7B55","affiliationIdentifierScheme":"ROR"}]',
    '[{"name":"Ocean Institute"}]',
    '[null,{"name":"Uni Wien"}]',
    '["Sorbonne Université, Paris"]',
    '[{"name":"Uni Wien"},{"name":"Uni Wien"},{"affiliationIdentifierScheme":"ROR","name":"ETH  Zürich"}]',
    "[]",
    "null",
    '[{"name":"Universität Bern"}]',
    '[{"name":"École Normale Supérieure, Lyon, France"},{"name":"INRAE"}]',
    '[{"name":null,"affiliationIdentifier":"grid.1","affiliationIdentifierScheme":"GRID"}]',
    '[{"name":"MIT"}]',
]
SUBJECTS = [
    '[{"subject":"Biology"},{"subject":"FOS: Social sciences","subjectScheme":"Fields of Science and Technology (FOS)"}]',
    '[{"subject":"Hidden","subjectScheme":null},null]',
    "[]",
    "null",
    '[{"subject":""},{"subject":"Biology"},{"subject":"Biology"},{"subject":"Water","lang":"en"}]',
    '[{"subject":"FOS: FOS: Other","subjectScheme":"Fields of Science and Technology (FOS)"},{"subject":"q","subjectScheme":"x"}]',
]
RIGHTS = [
    '[{"rightsIdentifier":" CC-BY-4.0 "},{"rightsIdentifier":"cc0-1.0"},{"rightsIdentifier":"CC-BY-4.0"},null]',
    '[{"rights":"open"},{"rightsIdentifier":"cc"}]',
    '[{"rightsIdentifier":null},{"rightsIdentifier":"MIT"}]',
    "[]",
    "null",
]
SIZES = [
    '["12 MB","3 pages"]', '["1,024 bytes"]', "[]", '["5 kbytes"]', "null", '["0.5 GB","900 kb"]', '["2 TB"]',
    '["x",null,"1.5e3 Mo"]', '["250 KB","0 kb"]', '["99 Mo"]',
]
FORMATS = ['["text/csv","application/pdf"]', '"application/vnd.ms-excel"', "[]", "null", '["Image/JPEG","tar.gz"]', '["MPEG","Foo"]']


def sql_strings(values: list[str]) -> list[str]:
    return [f"'{v}'" for v in values]


def person_json(i: int, affiliation: str, extra: str = "''") -> str:
    """JSON of a person, with the shapes that occur: no parts of a name, a single identifier, none."""
    k, given, family, name = f"k{i}", f"given_json{i}", f"family_json{i}", f"name_json{i}"
    scheme = f"CASE WHEN {k} % 9 = 2 THEN ' orcid ' WHEN {k} % 9 = 3 THEN 'ISNI' ELSE 'ORCID' END"
    one = (
        f"'{{\"nameIdentifier\":\"https://orcid.org/' || orcid{i} || '\",\"nameIdentifierScheme\":\"' || {scheme} || '\"}}'"
    )
    identifiers = (
        f"CASE WHEN {k} % 7 = 1 THEN {one} WHEN {k} % 7 = 2 THEN '[]' WHEN {k} % 7 = 3 THEN "
        f"'[{{\"nameIdentifier\":\"x/1\",\"nameIdentifierScheme\":\"ISNI\"}},' || {one} || ']' ELSE '[' || {one} || ']' END"
    )
    parts = (
        f"CASE WHEN {k} % 6 = 0 THEN '' WHEN {k} % 6 = 1 THEN ',\"familyName\":' || {family} "
        f"ELSE ',\"givenName\":' || {given} || ',\"familyName\":' || {family} END"
    )
    keyword = f"CASE WHEN {k} % 40 = 6 THEN '\"Inserm, U1016\"' ELSE {name} END"
    return (
        f"concat_ws('', '{{\"name\":', {keyword}, {parts}, {extra}, ',\"affiliation\":', {affiliation}, "
        f"',\"nameIdentifiers\":', {identifiers}, '}}')"
    )


def related_json() -> str:
    def one(relation: str, identifier: str, kind: str = "DOI") -> str:
        return (
            f"'{{\"relationType\":\"{relation}\",\"relatedIdentifier\":\"' || {identifier} || "
            f"'\",\"relatedIdentifierType\":\"{kind}\",\"resourceTypeGeneral\":\"Text\",\"schemeUri\":\"u/{relation}\"}}'"
        )

    pub = f"'10.7777/PUB.' || {text('(doc_id * 29) % 1100')}"
    other = f"'10.5555/other.' || {text('doc_id')}"
    join = " || ',' || "
    supplement = one("IsSupplementTo", pub)
    lists = {
        "doc_id % 25 = 0": join.join([supplement, one("IsSupplementTo", pub, "URL"), "'null'", one("HasPart", other)]),
        "doc_id % 5 = 0": supplement,
        "doc_id % 15 = 1": join.join([one("HasPart", other), one("HasPart", other), one("IsPartOf", other, "URL")]),
        "doc_id % 20 = 2": join.join([one("IsPartOf", other), supplement]),
        "doc_id % 20 = 3": join.join([one("IsVersionOf", other), one("IsIdenticalTo", other)]),
        "doc_id % 20 = 7": one("IsVersionOf", other),
        "doc_id % 20 = 11": join.join([one("IsPartOf", other), one("IsIdenticalTo", other), one("HasPart", other)]),
        "doc_id % 20 = 12": one("IsSupplementTo", f"'10.7777/pub.' || {text('(doc_id * 31) % 1100')}", "Handle"),
    }
    whens = " ".join(f"WHEN {cond} THEN '[' || {items} || ']'" for cond, items in lists.items())
    return f"CASE {whens} WHEN doc_id % 4 = 1 THEN 'null' ELSE '[]' END"


def record_json(engine: str) -> str:
    """One DOI record per document, as JSON text."""
    title = "title_json"
    titles = (
        f"CASE WHEN doc_id % 41 = 1 THEN '[{{\"lang\":\"en\"}},{{\"title\":' || {title} || '}}]' "
        f"WHEN doc_id % 43 = 1 THEN '[null,{{\"title\":null}},{{}}]' "
        f"WHEN doc_id % 47 = 1 THEN '[{{\"title\":' || {title} || '}},{{\"title\":\" Part two \"}}]' "
        f"ELSE '[{{\"title\":' || {title} || '}}]' END"
    )
    year = (
        "CASE WHEN h % 19 = 0 THEN '\"' || CAST(2010 + h % 15 AS STRING) || '\"' WHEN h % 53 = 0 THEN '\"about 2010\"' "
        "ELSE CAST(2010 + h % 15 AS STRING) END"
    )
    aff1 = case("doc_id % 12", *sql_strings(AFFILIATIONS))
    aff2 = case("(doc_id + 5) % 12", *sql_strings(AFFILIATIONS))
    own_ror = (
        f"CASE WHEN doc_id % 21 = 0 THEN ',\"affiliationIdentifier\":\"https://ROR.org/0' || {text('doc_id % 97')} || '\"' "
        "ELSE '' END"
    )
    first = person_json(1, aff1, own_ror)
    second = person_json(2, aff2)
    creators = (
        f"CASE WHEN doc_id % 37 = 5 THEN '[]' WHEN doc_id % 37 = 6 THEN '[' || {first} || ',null]' "
        f"WHEN doc_id % 11 = 3 THEN '[' || {first} || ',' || {second} || ']' ELSE '[' || {first} || ']' END"
    )
    contributors = f"CASE WHEN doc_id % 4 = 0 THEN '[' || {second} || ']' WHEN doc_id % 31 = 1 THEN 'null' ELSE '[]' END"
    descriptions = (
        f"'[{{\"descriptionType\":\"Abstract\",\"description\":' || {json_text('text', engine)} || '}},null,"
        f"{{\"descriptionType\":\"Methods\",\"description\":\" m' || {text('doc_id')} || ' \"}},"
        f"{{\"descriptionType\":\"Other\",\"description\":5}}'"
        f" || CASE WHEN doc_id % 3 = 0 THEN ',{{\"descriptionType\":\"Other\",\"description\":\"a note\"}},"
        f"{{\"descriptionType\":\"Other\",\"description\":\"\"}},{{\"descriptionType\":\"Other\",\"description\":\"more\"}}' ELSE '' END || ']'"
    )
    funding = (
        f"CASE WHEN doc_id % 3 = 0 THEN '[{{\"funderName\":\"ANR\",\"awardNumber\":\"ANR-' || {text('doc_id')} || '\"}},"
        "{\"funderName\":\"\"},{\"awardNumber\":\"9\"},null]' WHEN doc_id % 3 = 1 THEN 'null' ELSE '[]' END"
    )
    clients = [
        "''" if c is None else f"',\"relationships\":{{\"client\":{{\"data\":{{\"id\":\"{c}\",\"type\":\"clients\"}}}}}}'" for c in CLIENTS
    ]
    stamp = f"'2024-01-' || lpad({text('1 + doc_id % 28')}, 2, '0') || 'T00:00:00Z'"
    fields = [
        f"'{{\"id\":\"' || {RECORD_ID} || '\",\"attributes\":{{\"titles\":' || {titles}",
        f"',\"publicationYear\":' || {year}",
        f"',\"publisher\":' || {case('h % 16', *sql_strings(PUBLISHERS))}",
        f"',\"types\":{{\"resourceType\":\"Raw Data\",\"resourceTypeGeneral\":' || {case('doc_id % 12', *sql_strings(TYPES))} || '}}'",
        f"',\"creators\":' || {creators}",
        f"',\"contributors\":' || {contributors}",
        f"',\"relatedIdentifiers\":' || {related_json()}",
        f"',\"subjects\":' || {case('doc_id % 6', *sql_strings(SUBJECTS))}",
        f"',\"rightsList\":' || {case('doc_id % 5', *sql_strings(RIGHTS))}",
        f"',\"sizes\":' || {case('doc_id % 10', *sql_strings(SIZES))}",
        f"',\"formats\":' || {case('doc_id % 6', *sql_strings(FORMATS))}",
        f"',\"descriptions\":' || {descriptions}",
        f"',\"fundingReferences\":' || {funding}",
        f"',\"language\":\"' || lang || '\"'",
        f"',\"url\":\"https://www.repo' || {text('doc_id % 40')} || '.example.org/en/item/' || {text('doc_id % 7')} || '\"'",
        f"',\"created\":\"' || {stamp} || '\",\"updated\":\"' || {stamp} || '\"}}'",
        case("doc_id % 9", *clients),
        "'}'",
    ]
    joined = ",\n ".join(fields)
    return f"SELECT doc_id, {PLACE}, concat_ws('', {joined}) AS value FROM ({documents_numbered(engine)}) AS d"


FILE_PATH = (
    "'dump/updated_' || lpad(CAST(CAST(floor(doc_id / 400) AS BIGINT) AS STRING), 6, '0') || '/part_' || "
    "lpad(CAST(CAST(floor(doc_id / 100) AS BIGINT) % 4 AS STRING), 4, '0') || '.jsonl.gz'"
)
PLACE = f"{FILE_PATH} AS file_path, doc_id % 100 AS line_no"


# ---------------------------------------------------------------- side tables


def publications_sql() -> str:
    number = f"{quotient('o_orderkey', 4)} * 3 + CASE WHEN o_orderkey % 4 = 3 THEN 2 ELSE o_orderkey % 4 END"
    rors = case(
        "o_orderkey % 3", f"'https://ror.org/0' || {text('o_custkey % 97')}",
        f"'https://ror.org/0' || {text('o_custkey % 97')} || '|https://ror.org/1' || {text('o_orderkey % 31')}", "NULL",
    )
    local = case("o_orderkey % 5", "'lyon|nantes'", "'paris'", "NULL", "'nantes'", "NULL")
    country = case("o_orderkey % 6", "'fr'", "'fr|de'", "'de'", "'fr'", "NULL", "'gp|fr'")
    return (
        f"SELECT '10.7777/pub.' || {text(number)} AS doi, {country} AS country, {rors} AS rors, "
        f"{local} AS local_affiliations, o_orderkey AS row_order FROM orders"
    )


def authors_sql() -> str:
    """Authors with two affiliations each, by first and last year."""
    k = "c_custkey"
    display = f"CASE WHEN {k} % 23 = 0 THEN 'J. ' ELSE '' END || {given_name(k)} || ' ' || {family_name(k)}"
    return (
        f"SELECT c_custkey AS author_id, {display} AS display_name, "
        f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE 'https://orcid.org/' || {orcid(k)} END AS orcid, "
        f"CASE WHEN {k} % 10 = 3 THEN 'DE' ELSE 'FR' END AS country_code, {k} % 20 + 4 AS works_count, "
        f"'https://ror.org/0' || {text(f'{k} % 97')} AS ror1, 2008 + {k} % 6 AS from1, 2014 + {k} % 8 AS to1, "
        f"CASE WHEN {k} % 4 = 0 THEN NULL ELSE 'https://ror.org/1' || {text(f'{k} % 31')} END AS ror2, "
        f"2013 AS from2, 2020 AS to2 FROM customer"
    )


def orgs_sql() -> str:
    country = case("s_nationkey % 5", "'FR'", "'GP'", "'DE'", "'US'", "NULL")
    second = case("s_suppkey % 3", "'fr'", "'be'", "NULL")
    return (
        f"SELECT 'https://ror.org/0' || {text('s_suppkey % 120')} AS id, {country} AS country1, {second} AS country2, "
        "CASE WHEN s_suppkey % 50 = 49 THEN '1.0' ELSE '2.1' END AS schema_version FROM supplier"
    )


def doi_lists_sql() -> str:
    """Rows of institution lists: a file name and a DOI as typed in."""
    stem = case("doc_id % 7", "'lyon.csv'", "'nantes_paris.csv'", "'paris.csv'", "'caen.csv'", "'lyon_caen.csv'", "'nantes.csv'", "'reims.csv'")
    typed = case(
        "doc_id % 4", f"'https://doi.org/' || {RECORD_ID}", f"upper({RECORD_ID})",
        f"' ' || replace({RECORD_ID}, '/', '%2F') || ' '", "'n/a'",
    )
    return f"SELECT doc_id, {stem} AS file_name, {typed} AS typed FROM documents"


def match_results_sql() -> str:
    """Matcher results per affiliation text: a country and ids for texts built from suppliers."""
    return (
        f"SELECT 'lab ' || {text('s_suppkey')} AS query, {case('s_suppkey % 5', chr(39)+'fr'+chr(39), chr(39)+'gp|fr'+chr(39), chr(39)+'de'+chr(39), chr(39)+chr(39), 'NULL')} AS country, "
        f"'grid.' || {text('s_suppkey % 10')} AS grid, CASE WHEN s_suppkey % 2 = 0 THEN 'r' || {text('s_suppkey')} ELSE NULL END AS rnsr, "
        f"'0' || {text('s_suppkey')} || '|1' || {text('s_suppkey')} AS ror FROM supplier"
    )


def customer_affiliations_sql() -> str:
    """Detailed affiliation rows out of orders: who, where, which lab."""
    lab = f"CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'lab ' || {text('o_custkey % 130')} END"
    publisher = case("o_custkey % 5", "'Nakala'", "'université de lorraine'", "'zenodo'", "NULL", "'inrae'")
    client = case("o_custkey % 4", "'inist.ird'", "'cern.zenodo'", "NULL", "'ÍNIST.cnrs'")
    return (
        f"SELECT '10.5555/o.' || {text(quotient('o_orderkey', 3))} AS doi_id, '10.5555_o.' || {text(quotient('o_orderkey', 3))} AS doi_file_name, "
        "CASE WHEN o_orderkey % 2 = 0 THEN 'creators' ELSE 'contributors' END AS type, "
        f"'P ' || {text('o_custkey')} AS name, {publisher} AS doi_publisher, {client} AS doi_client_id, {lab} AS affiliation, "
        f"'f' || {text('o_orderkey % 10')} AS origin_file FROM orders"
    )


# ---------------------------------------------------------------- Spark side


def tables(spark: SparkSession, sf_dir: str, sql: str) -> None:
    """Register the driver's tables a statement names as views of this session."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", sql):
            table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            # the small test files are one row group, which is one task's work however many splits it has: deal
            # the rows out for the texts' sake where there are fewer splits than cores
            cores = spark.sparkContext.defaultParallelism
            few = name in TEXT_TABLES and table.rdd.getNumPartitions() < cores
            spread(table, cores if few else None).createOrReplaceTempView(name)


def frame(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables(spark, sf_dir, sql)
    return spark.sql(sql)
