"""Text normalisation over whole documents, conversations and page URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from citeloom.functions import text as X
from citeloom.functions.urls import url_signature
from suite import views as v
from suite.registry import query

# the oracle's spelling of the same rules
WORD = r"[\p{L}\p{N}\p{M}\p{Pc}]"
TOKENS = rf"{WORD}+|[^\p{{L}}\p{{N}}\p{{M}}\p{{Pc}}\s]+"
PUNCT = r"[!-/:-@\[-`{-~]"


def duck_normalize(e: str) -> str:
    return (
        f"array_to_string(regexp_extract_all(regexp_replace(lower(strip_accents({e})), '[<>$]', ' ', 'g'), '{TOKENS}'), ' ')"
    )


def duck_strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def documents(spark, sf_dir):
    return v.frame(spark, sf_dir, "SELECT * FROM documents")


@query("normalize_documents", f"SELECT doc_id, {duck_normalize('text')} AS normalized FROM documents")
def _(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.normalize("text").alias("normalized"))


@query("normalize_conversations", f"SELECT conv_id, turn, {duck_normalize('text')} AS normalized FROM conversations")
def _(spark, sf_dir):
    rows = v.frame(spark, sf_dir, "SELECT * FROM conversations")
    return rows.select("conv_id", "turn", X.normalize("text").alias("normalized"))


@query(
    "normalize_long_words",
    f"SELECT doc_id, array_to_string(list_filter(string_split({duck_normalize('text')}, ' '), "
    "lambda t: length(t) > 3 OR contains('0123456789', t)), ' ') AS normalized FROM documents",
)
def _(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", X.normalize("text", min_length=3).alias("normalized"))


@query(
    "normalize_key",
    f"SELECT doc_id, array_to_string(regexp_extract_all(regexp_replace(lower(strip_accents(text)), '{PUNCT}', ' ', 'g'), '{TOKENS}'), '') AS key, "
    f"array_to_string(regexp_extract_all(regexp_replace(lower(strip_accents(text)), '{PUNCT}', ' ', 'g'), '{TOKENS}'), ' ') AS spaced FROM documents",
)
def _(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", X.normalize_key("text").alias("key"), X.normalize_key("text", remove_space=False).alias("spaced")
    )


@query(
    "fold_text",
    "SELECT doc_id, strip_accents(text) AS bare, "
    f"regexp_replace(lower(text), '{PUNCT}', ' ', 'g') AS unpunctuated, "
    r"lower(regexp_replace(strip_accents(text), '[^\x00-\x7F]', '', 'g')) AS ascii FROM documents",
)
def _(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id",
        X.strip_accents("text").alias("bare"),
        X.delete_punctuation("text").alias("unpunctuated"),
        X.ascii_fold("text").alias("ascii"),
    )


ELIDED = (
    rf"regexp_replace(text, '(?i)(^|[^\p{{L}}\p{{N}}_])(l|m|t|qu|n|s|j|d|c|jusqu|quoiqu|lorsqu|puisqu)[''’]', '\1', 'g')"
)


@query("search_text", f"SELECT doc_id, {duck_normalize(ELIDED)} AS searchable FROM (SELECT doc_id, 'L''été d’hiver: ' || text AS text FROM documents)")
def _(spark, sf_dir):
    rows = documents(spark, sf_dir).withColumn("text", F.concat(F.lit("L'été d’hiver: "), "text"))
    return rows.select("doc_id", X.search_text("text").alias("searchable"))


@query(
    "distinct_sorted_lines",
    "SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(text, chr(10)), lambda x: x <> ''))), '|') AS lines FROM documents",
)
def _(spark, sf_dir):
    lines = X.dedup_sort(F.split("text", "\n"))
    return documents(spark, sf_dir).select("doc_id", F.array_join(lines, "|").alias("lines"))


@query("nested_words", "SELECT doc_id, lang || ' ' || source || '  ' || text || ' ' AS words FROM documents")
def _(spark, sf_dir):
    nested = F.struct(
        F.array(F.struct("lang", F.struct("source").alias("b"))).alias("a"),
        F.struct(F.lit(5).alias("n"), F.col("text")).alias("c"),
        F.lit(True).alias("d"),
    )
    rows = documents(spark, sf_dir).select("doc_id", nested.alias("nested"))
    return rows.select("doc_id", X.words("nested", rows.schema["nested"].dataType).alias("words"))


@query(
    "clean_dois",
    f"SELECT doc_id, nullif(regexp_extract(replace({duck_strip('lower(typed)')}, '%2f', '/'), '(10\\.[^\\n]*?)( |$)', 1), '') AS doi "
    f"FROM ({v.doi_lists_sql()})",
)
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, v.doi_lists_sql()).select("doc_id", X.clean_doi("typed").alias("doi"))


IDS = "SELECT o_orderkey, ' ' || CAST(o_orderkey AS STRING) || '.0 , ' || o_orderpriority AS a, o_orderpriority || ', x' AS b FROM orders"


@query(
    "clean_ids",
    "SELECT o_orderkey, trim(split_part(lower(trim(replace(a, '.0', ''))), ',', 1)) AS number, "
    f"trim(split_part(lower(trim(replace(b, '.0', ''))), ',', 1)) AS word FROM ({IDS})",
)
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, IDS).select("o_orderkey", X.clean_id("a").alias("number"), X.clean_id("b").alias("word"))


PEOPLE_IDS = (
    f"SELECT c_custkey, 'https://orcid.org/' || {v.orcid('c_custkey')} AS uri, "
    "CASE c_custkey % 4 WHEN 0 THEN 'ORCID' WHEN 1 THEN 'ROR' WHEN 2 THEN 'orcid' ELSE NULL END AS scheme, "
    "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE c_name || '/a:b*' END AS plain FROM customer"
)


@query(
    "identifier_tails",
    "SELECT c_custkey, split_part(uri, '/', -1) AS tail, split_part(plain, '/', -1) AS plain_tail, "
    "CASE WHEN scheme = 'ORCID' THEN split_part(uri, '/', -1) END AS orcid, "
    "CASE WHEN scheme = 'ROR' THEN split_part(plain, '/', -1) END AS ror, "
    f"replace(replace(replace(plain, '/', '_'), ':', '-'), '*', '') AS file_key FROM ({PEOPLE_IDS})",
)
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, PEOPLE_IDS).select(
        "c_custkey",
        X.uri_tail("uri").alias("tail"),
        X.uri_tail("plain").alias("plain_tail"),
        X.id_if_scheme("uri", "scheme", "ORCID").alias("orcid"),
        X.id_if_scheme("plain", "scheme", "ROR").alias("ror"),
        X.file_key("plain").alias("file_key"),
    )


LISTED = (
    "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '[' || chr(39) || c_mktsegment || chr(39) || ', ' || chr(39) || c_name || chr(39) || ']' "
    "WHEN 1 THEN '[]' ELSE c_name END AS listed, c_mktsegment, c_name FROM customer"
)


@query(
    "list_literals",
    f"SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || '|' || c_name ELSE '' END AS items FROM ({LISTED})",
)
def _(spark, sf_dir):
    return v.frame(spark, sf_dir, LISTED).select("c_custkey", F.array_join(X.listify("listed"), "|").alias("items"))


# URLs as they are, and with the path words that do not count
URLS = (
    "SELECT page_id, url FROM pages UNION ALL "
    "SELECT page_id + 1000000, ' HTTP://www.' || replace(replace(url, 'https://', ''), 'http://', '') || '/index.html' FROM pages UNION ALL "
    "SELECT page_id + 2000000, replace(url, '/en/', '//home/index/') FROM pages"
)
URL_TEXT = "trim(replace(replace(replace(split_part(lower(trim(url)), '?', 1), 'http://', ''), 'https://', ''), 'www.', ''))"


def url_ctes(source: str, p: str = "") -> str:
    """CTEs ending in ``{p}signed(page_id, normalized, signatures)`` of the URLs of a query."""
    return f"""
{p}cleaned AS (SELECT page_id, string_split({URL_TEXT}, '/') AS parts, {URL_TEXT} AS cleaned FROM ({source})),
{p}kept AS (
  SELECT page_id, list_transform(list_filter(list_zip(parts, range(len(parts))), lambda z: z[1] <> '' AND
    (z[2] = 0 OR NOT regexp_matches(z[1], '^(en|index|home)(\\.|$)'))), lambda z: z[1]) AS segs
  FROM {p}cleaned WHERE length(cleaned) >= 2),
{p}labelled AS (SELECT page_id, segs, list_filter(string_split(segs[1], '.'), lambda s: s <> '') AS labels FROM {p}kept WHERE len(segs) > 0),
{p}suffixed AS (
  SELECT page_id, array_to_string(segs, '/') AS normalized,
    list_transform(range(2, len(labels) + 1), lambda n: array_to_string(labels[len(labels) - n + 1:], '.')) AS suffixes,
    list_transform(range(1, len(segs) + 1), lambda n: array_to_string(segs[1:n], '/')) AS prefixes
  FROM {p}labelled),
{p}signed AS (
  SELECT page_id, normalized,
    list_concat(suffixes, list_filter(prefixes, lambda p: NOT list_contains(suffixes, p))) AS signatures
  FROM {p}suffixed)"""


@query("url_signatures", f"WITH {url_ctes(URLS)} SELECT page_id, normalized, array_to_string(signatures, ' ') AS signatures FROM signed")
def _(spark, sf_dir):
    s = v.frame(spark, sf_dir, URLS).select("page_id", url_signature("url").alias("s")).where("s IS NOT NULL")
    return s.select("page_id", "s.normalized", F.array_join("s.signatures", " ").alias("signatures"))
