"""Canonical publishers, formats, sizes and the rules on single values."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.constants import NATIONAL_PUBLISHER_WORDS, TERRITORY_CODES
from citeloom.functions import values as V
from suite import views as v
from suite.registry import query
from suite.text_queries import duck_normalize

# ---------------------------------------------------------------- publishers

PUBLISHER_NAMES = [
    "École des Hautes Études en Sciences Sociales", "nakala.fr", "SAGE Publications", "Figshare Ltd",
    "Centre de Données (Strasbourg (CDS))", "UMS PatriNat (OFB-CNRS)", "INRAE", "Portail Data INRAE", "IFREMER - Sismer",
    "Délégation Ifremer Brest", "ZENODO", "The Cambridge Crystallographic Data Centre", "FIZ Karlsruhe - ICSD",
    "ICOS ERIC -- Carbon Portal", "Dryad", "INRAP", "Université de Lorraine", "data-InDoRES", "HAL CCSD", "éfrance", "Paris!",
    "PROGEDO Adisp", "Institut Français", "Nouvelle-calédonie", "recherche data gouv", "Universite de Lorraine", "DataSuds",
    "CIRAD", "Message board", "SUPAÉRO",
]
PUBLISHERS = (
    f"SELECT doc_id, {v.RECORD_ID} AS id, {v.case('(doc_id * 7 + n_chars) % 31', *v.sql_strings(PUBLISHER_NAMES), 'NULL')} AS publisher, "
    f"{v.case('doc_id % 6', *v.sql_strings(['inist.cnrs', 'INIST.ird', 'ÍNIST.x', 'cern.zenodo', 'xinist.a']), 'NULL')} AS client_id, "
    f"{v.case('doc_id % 5', *v.sql_strings(['figshare', 'FigShare', '4TU.ResearchData', 'Zenodo']), 'NULL')} AS plain_publisher FROM documents"
)
N = duck_normalize("publisher")


DUCK_PUBLISHER = f"""CASE
    WHEN contains(lower(id), 'figshare') THEN 'figshare'
    WHEN contains({N}, 'cole des hautes etudes en sciences sociales') THEN 'EHESS'
    WHEN contains({N}, 'nakala') THEN 'NAKALA'
    WHEN contains({N}, 'sage') THEN 'SAGE'
    WHEN contains({N}, 'figshare') THEN 'figshare'
    WHEN contains({N}, 'strasbourg ( cds )') THEN 'Centre Données Strasbourg (CDS)'
    WHEN contains({N}, 'ums patrinat') THEN 'UMS PatriNat'
    WHEN publisher IN ('Portail Data INRAE', 'INRAE') THEN 'Portail Data INRAE'
    WHEN starts_with(lower(publisher), 'ifremer') OR contains({N}, 'delegation ifremer') THEN 'IFREMER'
    WHEN starts_with(lower(publisher), 'zenodo') THEN 'Zenodo'
    WHEN contains(lower(publisher), 'cambridge crystallographic') THEN 'Cambridge Structural Database (CSD)'
    WHEN contains(lower(publisher), 'fiz karlsruhe') THEN 'Inorganic Crystal Structure Database (ICSD)'
    WHEN contains(lower(publisher), 'sage journal') THEN 'SAGE'
    WHEN contains({N}, 'icos eric -- carbon portal') THEN 'ICOS ERIC - Carbon Portal'
    ELSE publisher END"""


@query("publisher_forms", f"SELECT doc_id, {DUCK_PUBLISHER} AS canonical FROM ({PUBLISHERS})")
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, PUBLISHERS)
    return rows.select("doc_id", V.normalize_publisher("id", "publisher").alias("canonical"))


EDGE = r"[^\p{L}\p{N}_]"
WORDS = "|".join(w.lower() for w in NATIONAL_PUBLISHER_WORDS)
DUCK_FOLD = r"lower(regexp_replace(strip_accents({}), '[^\x00-\x7F]', '', 'g'))"


@query(
    "national_by_name",
    f"SELECT doc_id, coalesce(regexp_matches(lower(publisher), '(^|{EDGE})({WORDS})($|{EDGE})'), false) AS by_word, "
    f"coalesce({DUCK_FOLD.format('publisher')} IN ('recherche data gouv', 'universite de lorraine', 'nakala', 'cirad', 'inrae', 'datasuds'), false) AS by_name, "
    "coalesce(starts_with(client_id, 'inist.'), false) AS by_client, "
    f"coalesce(starts_with({DUCK_FOLD.format('client_id')}, 'inist.'), false) AS by_folded_client FROM ({PUBLISHERS})",
)
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, PUBLISHERS).select(
        "doc_id",
        V.is_national_publisher("publisher").alias("by_word"),
        V.is_national_publisher_name("publisher").alias("by_name"),
        V.is_national_client("client_id").alias("by_client"),
        V.is_national_client("client_id", fold=True).alias("by_folded_client"),
    )


@query(
    "version_copies",
    f"SELECT doc_id, id FROM ({PUBLISHERS}) WHERE NOT (regexp_matches(lower(id), '(^|\\.)v[0-9]+$') AND "
    "(coalesce(lower(plain_publisher) IN ('figshare', '4tu.researchdata'), false) OR contains(lower(id), 'figshare')))",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, PUBLISHERS)
    return rows.where(~V.is_version_copy("id", "plain_publisher")).select("doc_id", "id")


CODES = ", ".join(f"'{c}'" for c in TERRITORY_CODES)
COUNTRIES = (
    "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'fr|de' WHEN 1 THEN 'de' WHEN 2 THEN '' WHEN 3 THEN 'us|gp' WHEN 4 THEN 'FR' ELSE NULL END AS listed FROM orders"
)


@query(
    "national_by_country",
    f"SELECT o_orderkey, coalesce(len(list_intersect(string_split(listed, '|'), [{CODES}])) > 0, false) AS national FROM ({COUNTRIES})",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, COUNTRIES)
    return rows.select("o_orderkey", V.has_national_country(F.split("listed", r"\|")).alias("national"))


# ---------------------------------------------------------------- formats

FORMAT_NAMES = [
    "text/csv", "application/PDF", "image/jpeg", "JPG", "audio/mp3", "mpeg", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.ms-excel", "Word doc", "x.tar.gz", "zip", "SPSS sav", "R code", "powerpoint", "shp", "Shapefile", "foo", "netCDF", "FITS",
    "record", "MS Access", "application/x-javascript", "rtf", "", "tiff", "SQL dump",
]
FORMATS = f"SELECT p_partkey, {v.case('(p_partkey * 3 + p_size) % 27', *v.sql_strings(FORMAT_NAMES), 'NULL')} AS raw FROM part"


def like_any(column: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({column}), '{p}')" for p in parts) + ")"


SELF_NAMED = "image audio video text pdf json zip fits xml csv netcdf html javascript sql rdata access".split()
DUCK_FORMAT = (
    "CASE "
    + " ".join(f"WHEN contains(lower(raw), '{f}') THEN '{f}'" for f in SELF_NAMED)
    + f" WHEN {like_any('raw', 'jpg jpeg gif tiff svg tif png'.split())} THEN 'image'"
    + f" WHEN {like_any('raw', 'mp4 mpeg mpg rec'.split())} THEN 'video'"
    + f" WHEN {like_any('raw', 'word txt rtf'.split())} THEN 'text'"
    + f" WHEN {like_any('raw', 'excel spreadsheet xls'.split())} THEN 'spreadsheet'"
    + " WHEN contains(lower(raw), 'tar') THEN 'zip'"
    + f" WHEN {like_any('raw', ['spss', 'stata', 'sas', 'r '])} THEN 'sas / stata / spss / R'"
    + f" WHEN {like_any('raw', ['powerpoint', 'slides'])} THEN 'slides'"
    + " WHEN contains(lower(raw), 'shp') OR contains(lower(raw), 'shapefile') THEN 'shapefile' ELSE lower(raw) END"
)


@query("file_formats", f"SELECT p_partkey, {DUCK_FORMAT} AS format FROM ({FORMATS})")
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, FORMATS).select("p_partkey", V.normalize_format("raw").alias("format"))


# ---------------------------------------------------------------- sizes

SIZE_TAILS = [
    " bytes", "byte", " KB", "kib", " kbytes", " Mo", "MB", " megabytes", ",000 Go", " gb", " TB", "to", " pages", " files", "", " datapoints", "e2 mb",
    "d kb", ". mo", " stations",
]
SIZES = (
    f"SELECT p_partkey, CASE WHEN p_partkey % 50 = 49 THEN NULL ELSE CAST(p_size AS STRING) || {v.case('p_partkey % 20', *v.sql_strings(SIZE_TAILS))} END AS size, "
    f"CAST(p_retailprice AS STRING) || {v.case('p_partkey % 7', *v.sql_strings([' kb', ' MB', ' Go', ' bytes', ' words', ' x', '0 ko']))} AS other FROM part"
)
NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$'"
UNIT_LISTS = [
    ("bytes byte", "/ 1000000"), ("ko kb kbyte kbytes kio kib kilobytes", "/ 1000"), ("mo mb mib mio mbyte mbytes megabytes", "* 1"),
    ("go gb gib gbyte gbytes gigabytes", "* 1000"), ("to tb tib tbyte tbytes terabytes", "* NULL"),
]
COUNTED = "page datapoint station word interaction file earthquake dataset spectrum spectra".split()


def duck_size(column: str) -> tuple[str, str]:
    """Megabytes and unit of a size text."""
    x = f"replace(replace(lower({column}), ',', ''), ' ', '')"
    mb, unit = [], []
    for names, scale in UNIT_LISTS:
        for u in names.split():
            number = f"replace({x}, '{u}', '')"
            value = f"CASE WHEN regexp_matches({number}, {NUMBER}) THEN TRY_CAST({number} AS DOUBLE) END {scale}"
            mb.append(f"WHEN contains({x}, '{u}') THEN {value}")
            unit.append(f"WHEN contains({x}, '{u}') THEN CASE WHEN ({value}) IS NOT NULL THEN '{u}' END")
    unit += [f"WHEN contains({x}, '{u}') THEN '{u}'" for u in COUNTED]
    return f"CASE {' '.join(mb)} END", f"CASE {' '.join(unit)} END"


MB, UNIT = duck_size("size")


@query("size_texts", f"SELECT p_partkey, CAST({MB} AS DOUBLE) AS mb, {UNIT} AS unit FROM ({SIZES})")
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, SIZES).select("p_partkey", V.parse_size("size").alias("s"))
    return rows.select("p_partkey", "s.mb", "s.unit")


MB2, UNIT2 = duck_size("other")


@query(
    "size_totals",
    f"""WITH parsed AS (SELECT p_partkey, {MB} AS a, {UNIT} AS ua, {MB2} AS b, {UNIT2} AS ub FROM ({SIZES})),
    summed AS (SELECT *, CASE WHEN coalesce(a, 0) <> 0 OR coalesce(b, 0) <> 0 THEN coalesce(a, 0) + coalesce(b, 0) END AS total FROM parsed)
    SELECT p_partkey, CAST(total AS DOUBLE) AS size_total_mb, concat_ws('|', ua, ub) AS units, total IS NOT NULL AS has_size,
    CASE WHEN total IS NULL THEN 'N/A' WHEN total < 1 THEN '< 1 Mo' WHEN total <= 10 THEN '1 - 10 Mo' WHEN total <= 100 THEN '10 - 100 Mo'
    WHEN total <= 1000 THEN '100Mo - 1 Go' ELSE '>= 1 Go' END AS size_cat FROM summed""",
)
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, SIZES).select("p_partkey", V.size_features(F.array("size", "other")).alias("s"))
    return rows.select(
        "p_partkey", "s.size_total_mb", F.array_join("s.units", "|").alias("units"), "s.has_size", "s.size_cat"
    )
