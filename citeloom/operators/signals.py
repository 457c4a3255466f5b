"""Why a record counts as national.

Signals that need nothing but the record (keywords, publisher, client) are column
expressions. Signals that need a side table are *probes*: every record yields an array of
keys, exploded once into a narrow table, looked up in one join against the union of all
side tables, and gathered back by record in one aggregation. The wide record is read past
that join, never carried through it.

A key that a third of the records share (one much cited article, one frequent name) only
makes the probe side of an equi-join skewed; no rows of one key are ever grouped together.
The join is a sort-merge join of narrow rows, of which adaptive skew handling splits the hot
partition; it can because the aggregation that follows has its own exchange by record.
"""

from __future__ import annotations

from collections.abc import Callable

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citeloom.constants import (
    AFFILIATION_KEYWORDS,
    EXCLUDED_FULL_NAMES,
    EXCLUDED_FULL_NAMES_PUBLISHER,
    EXCLUDED_LAST_NAMES,
    NAME_KEYWORDS,
    NOISE_REASONS,
    NOISE_TYPE,
)
from citeloom.functions.records import affiliation_list, empty_array, identifiers, text_only
from citeloom.functions.text import let, normalize, plain_word, string_array, string_map
from citeloom.functions.values import is_national_client, is_national_publisher

PUBLICATION, ORCID, NAME, ORGANISATION = "publication", "orcid", "name", "organisation"
REASONS = {
    PUBLICATION: "linked_article",
    ORCID: "french_orcid",
    NAME: "french_author",
    ORGANISATION: "french_ror",
}
PROBE = "struct<signal:string,source:string,key:string,year:int,pos:int,sub:int>"
NO_YEAR = 0
LOOKUP = "source string, key string, year int, rors array<string>, local_affiliations array<string>"


# ---------------------------------------------------------------- in-record signals


def normalized_names(everyone: Column) -> Column:
    """Per person the normalised name, given name and family name."""
    return F.transform(
        everyone,
        lambda p: F.struct(
            normalize(F.replace(p["person"]["name"], F.lit(","), F.lit(" "))).alias("name"),
            normalize(p["person"]["givenName"]).alias("given"),
            normalize(p["person"]["familyName"]).alias("family"),
        ),
    )


def keyword_hits(text: Column, keywords: list[str], prefix: str) -> Column:
    """The keywords a text contains, each behind a prefix; the text is computed once.

    Keywords are looked for in bytes, which is the same in UTF-8 and takes two thirds of the time. One
    pattern for all of them (alternatives, a trie, either behind classes of first letters) took longer.
    """
    found = let(
        text.cast("binary"),
        lambda t: F.filter(string_array(keywords), lambda k: F.contains(t, k.cast("binary"))),
    )
    return F.transform(found, lambda k: F.concat(F.lit(prefix), k))


def name_keyword_reasons(names: Column) -> Column:
    """Reasons from keywords in the normalised names of :func:`normalized_names`."""
    text = F.array_join(F.transform(names, lambda n: n["name"]), "\n")
    return keyword_hits(text, NAME_KEYWORDS, "name_")


def affiliation_text(everyone: Column) -> Column:
    """Normalised text of all affiliations of a record.

    Values are joined by a comma between blanks, so that no phrase spans two of them, and
    normalised in one go. An affiliation given as plain text gets no blanks at its ends:
    keywords that begin or end with one do not match there.
    """
    listed = F.flatten(F.transform(everyone, lambda p: affiliation_list(p["person"])))
    values = F.flatten(
        F.transform(
            listed,
            lambda a: F.coalesce(
                F.map_values(F.try_variant_get(a, "$", "map<string,string>")), empty_array("string")
            ),
        )
    )
    plain = F.filter(F.transform(listed, text_only), lambda t: t != "")
    structured = normalize(F.nullif(F.array_join(values, " , "), F.lit("")))
    texts = F.array_join(F.transform(plain, lambda t: normalize(t)), "\n")
    return F.concat_ws("\n", F.concat(F.lit(" "), structured, F.lit(" ")), texts)


def affiliation_keyword_reasons(text: Column) -> Column:
    return keyword_hits(text, AFFILIATION_KEYWORDS, "affiliation_")


def publisher_reasons(publisher: Column, client: Column) -> Column:
    return F.filter(
        F.array(
            F.when(is_national_publisher(publisher), "publisher"),
            F.when(is_national_client(client), "clientId"),
        ),
        lambda r: r.isNotNull(),
    )


def record_rors(everyone: Column, ror_on: str = "creator") -> Column:
    """Organisation ids named by the people of a record, lower case.

    As defined the identifier is read on the person (once it has affiliations), although
    it normally lives on the affiliation; ``ror_on="affiliation"`` reads it there.
    """
    if ror_on == "affiliation":
        listed = F.flatten(F.transform(everyone, lambda p: affiliation_list(p["person"])))
        found = F.transform(listed, lambda a: F.try_variant_get(a, "$.affiliationIdentifier", "string"))
    else:
        found = F.transform(
            everyone,
            lambda p: F.when(
                F.size(affiliation_list(p["person"])) > 0, p["person"]["affiliationIdentifier"]
            ),
        )
    rors = F.filter(F.transform(found, F.lower), lambda r: F.contains(r, F.lit("ror")))
    return F.array_distinct(F.transform(rors, lambda r: F.substring_index(r, "/", -1)))


# ---------------------------------------------------------------- probes


def _probe(signal: str, source: str, key: Column, year: Column, pos: Column, sub: Column) -> Column:
    return F.struct(
        F.lit(signal).alias("signal"),
        F.lit(source).alias("source"),
        key.alias("key"),
        year.cast("int").alias("year"),
        pos.cast("int").alias("pos"),
        sub.cast("int").alias("sub"),
    )


def _known(probes: Column) -> Column:
    return F.filter(probes, lambda p: p["key"].isNotNull() & p["year"].isNotNull())


def publication_probes(related: Column) -> Column:
    """Publications a record supplements, whatever the type of the identifier."""
    chosen = F.filter(related, lambda r: r["relationType"] == "IsSupplementTo")
    return _known(
        F.transform(
            chosen,
            lambda r, i: _probe(
                PUBLICATION, PUBLICATION, F.lower(r["relatedIdentifier"]), F.lit(NO_YEAR), i, F.lit(0)
            ),
        )
    )


def orcid_probes(everyone: Column, year: Column) -> Column:
    def of_person(p: Column, i: Column) -> Column:
        return F.transform(
            identifiers(p["person"]),
            lambda d, j: _probe(
                ORCID,
                "author",
                F.when(
                    F.trim(F.lower(d["scheme"])) == "orcid",
                    F.upper(F.substring_index(d["identifier"], "/", -1)),
                ),
                year,
                i,
                j,
            ),
        )

    return _known(F.flatten(F.transform(everyone, of_person)))


def name_forms(n: Column) -> Column:
    """Distinct forms of a normalised name: as given, given-family, family-given."""
    both = n["given"].isNotNull() & n["family"].isNotNull()
    forms = F.array(
        n["name"],
        F.when(both, F.concat(n["given"], F.lit(" "), n["family"])),
        F.when(both, F.concat(n["family"], F.lit(" "), n["given"])),
    )
    return F.array_distinct(F.filter(forms, lambda f: f.isNotNull()))


def is_excluded_name(
    name: Column, plain_publisher: Column, last_names: list[str] | None = None
) -> Column:
    """Names that never count: listed full names at one publisher, or a listed family name."""
    listed = string_array([plain_word(x) for x in last_names or EXCLUDED_LAST_NAMES])
    full = name.isin(EXCLUDED_FULL_NAMES) & (plain_publisher == EXCLUDED_FULL_NAMES_PUBLISHER)
    return F.coalesce(full, F.lit(False)) | F.arrays_overlap(F.split(name, " "), listed)


def name_probes(
    names: Column, year: Column, plain_publisher: Column, last_names: list[str] | None = None
) -> Column:
    def of_person(n: Column, i: Column) -> Column:
        kept = F.filter(name_forms(n), lambda f: ~is_excluded_name(f, plain_publisher, last_names))
        return F.transform(kept, lambda f, j: _probe(NAME, "author", f, year, i, j))

    return _known(F.flatten(F.transform(names, of_person)))


def organisation_probes(rors: Column) -> Column:
    return _known(
        F.transform(
            rors, lambda r, i: _probe(ORGANISATION, ORGANISATION, r, F.lit(NO_YEAR), i, F.lit(0))
        )
    )


# ---------------------------------------------------------------- lookup


def lookup_table(
    publications: DataFrame | None = None,
    authors: DataFrame | None = None,
    orgs: DataFrame | None = None,
) -> DataFrame:
    """All side tables as one: ``(source, key, year, rors, local_affiliations)``, unique keys."""
    none = empty_array("string")
    parts = []
    if publications is not None:
        parts.append(
            publications.select(
                F.lit(PUBLICATION).alias("source"),
                F.col("doi").alias("key"),
                F.lit(NO_YEAR).alias("year"),
                "rors",
                "local_affiliations",
            )
        )
    if authors is not None:
        parts.append(
            authors.select(
                F.lit("author").alias("source"),
                F.col("author_key").alias("key"),
                F.col("year").cast("int").alias("year"),
                "rors",
                none.alias("local_affiliations"),
            )
        )
    if orgs is not None:
        parts.append(
            orgs.select(
                F.lit(ORGANISATION).alias("source"),
                F.col("ror").alias("key"),
                F.lit(NO_YEAR).alias("year"),
                none.alias("rors"),
                none.alias("local_affiliations"),
            )
        )
    if not parts:
        return SparkSession.active().createDataFrame([], LOOKUP)
    return reduce(DataFrame.unionByName, parts)


def probe_hits(records: DataFrame, probes: Column, lookup: DataFrame, row_id: str = "rec_id") -> DataFrame:
    """One row per probe that is found: ``(row_id, signal, key, year, pos, sub, rors, local_affiliations)``.

    Both sides are sorted, whatever their estimated size: that of a lookup is the size of the columns it is made
    from, and every task would hold its rows, many more and wider, in a hash table.
    """
    exploded = records.select(row_id, F.explode(probes).alias("p")).select(row_id, "p.*")
    return exploded.join(lookup.hint("merge"), ["source", "key", "year"]).drop("source")


def gather_hits(hits: DataFrame, row_id: str = "rec_id") -> DataFrame:
    """``(row_id, hits)``: found probes of a record in the order of the record.

    The list is bounded by the record itself, from whose arrays the probes came.
    """
    hit = F.struct("signal", "pos", "sub", "key", "rors", "local_affiliations")
    return hits.groupBy(row_id).agg(F.array_sort(F.collect_list(hit)).alias("hits"))


def hits_of(hits: Column, signal: str) -> Column:
    return F.filter(hits, lambda h: h["signal"] == signal)


def linked(hits: Column) -> Column:
    """Publications linked to a record."""
    return F.transform(
        hits_of(hits, PUBLICATION),
        lambda h: F.struct(
            h["key"].alias("doi"),
            h["rors"].alias("rors"),
            h["local_affiliations"].alias("local_affiliations_from_publications"),
        ),
    )


def linked_publications(records: DataFrame, publications: DataFrame, row_id: str = "rec_id") -> DataFrame:
    """``(row_id, fr_publications_linked)`` of records linked to a national publication."""
    hits = probe_hits(records, publication_probes(F.col("related")), lookup_table(publications), row_id)
    return gather_hits(hits, row_id).select(row_id, linked(F.col("hits")).alias("fr_publications_linked"))


def orcid_signal(records: DataFrame, authors: DataFrame, row_id: str = "rec_id") -> DataFrame:
    """Found ORCID probes of the people of each record."""
    probes = orcid_probes(F.col("people"), F.col("lookup_year"))
    return probe_hits(records, probes, lookup_table(authors=authors), row_id)


def author_name_signal(
    records: DataFrame, authors: DataFrame, row_id: str = "rec_id", last_names: list[str] | None = None
) -> DataFrame:
    """Found author-name probes of the people of each record."""
    probes = name_probes(
        normalized_names(F.col("people")), F.col("lookup_year"), F.col("publisher_text"), last_names
    )
    return probe_hits(records, probes, lookup_table(authors=authors), row_id)


def ror_signal(
    records: DataFrame, orgs: DataFrame, row_id: str = "rec_id", ror_on: str = "creator"
) -> DataFrame:
    """``(row_id, ror, is_national)`` for every organisation id a record names."""
    named = records.select(row_id, F.explode(record_rors(F.col("people"), ror_on)).alias("ror"))
    known = orgs.select("ror", F.lit(True).alias("is_national"))
    return named.join(known, "ror", "left").fillna(False, ["is_national"])


def collect_reasons(reasons: Column) -> Column:
    return F.array_sort(F.array_distinct(reasons))


def national_reasons(
    records: DataFrame,
    lookup: DataFrame,
    row_id: str = "rec_id",
    ror_on: str = "creator",
    last_names: list[str] | None = None,
) -> DataFrame:
    """``(row_id, genre_raw, fr_reasons, fr_reasons_concat, hits)`` of the records that have a reason.

    Everything here is narrow: what a record says itself (keywords, publisher, client) and what it
    finds in the side tables become rows of one small table, gathered once per record.
    """
    c = F.col
    hit = "struct<signal:string,pos:int,sub:int,key:string,rors:array<string>,local_affiliations:array<string>>"
    names = normalized_names(c("people"))
    probes = F.concat(
        publication_probes(c("related")),
        orcid_probes(c("people"), c("lookup_year")),
        name_probes(names, c("lookup_year"), c("publisher_text"), last_names),
        organisation_probes(record_rors(c("people"), ror_on)),
    )
    found = probe_hits(records, probes, lookup, row_id).select(
        row_id,
        F.struct("signal", "pos", "sub", "key", "rors", "local_affiliations").alias("hit"),
        empty_array("string").alias("own"),
        F.lit(None).cast("string").alias("genre_raw"),  # only records with own reasons can be noise
    )
    own = F.concat(
        name_keyword_reasons(names),
        affiliation_keyword_reasons(affiliation_text(c("people"))),
        publisher_reasons(c("publisher_raw"), c("client_id")),
    )
    said = records.select(row_id, F.lit(None).cast(hit).alias("hit"), own.alias("own"), "genre_raw")
    said = said.where(F.size("own") > 0)
    # lists are bounded by the record, from whose arrays they came
    gathered = found.unionByName(said).groupBy(row_id).agg(
        F.array_sort(F.collect_list("hit")).alias("hits"),
        F.flatten(F.collect_list("own")).alias("own"),
        F.max("genre_raw").alias("genre_raw"),
    )
    reason = string_map(REASONS)
    reasons = collect_reasons(F.concat(c("own"), F.transform("hits", lambda h: reason[h["signal"]])))
    return gathered.withColumn("fr_reasons", reasons).select(
        row_id, "genre_raw", "fr_reasons", F.array_join("fr_reasons", ";").alias("fr_reasons_concat"), "hits"
    )


def drop_noise(df: DataFrame) -> DataFrame:
    """Images known by client and publisher alone go."""
    return df.where((F.col("fr_reasons_concat") != NOISE_REASONS) | (F.col("genre_raw") != NOISE_TYPE))


def national_signals(
    records: DataFrame,
    lookup: DataFrame,
    row_id: str = "rec_id",
    ror_on: str = "creator",
    last_names: list[str] | None = None,
    cut: Callable[[DataFrame], DataFrame] | None = None,
    reasons: DataFrame | None = None,
) -> DataFrame:
    """The national records with reasons, organisation ids and the lists behind them.

    ``records`` is the typed record table; ``lookup`` comes from :func:`lookup_table`. Reasons are
    settled in a narrow table first (:func:`national_reasons`, or the one given), and the wide
    records meet it in an inner join. National records are few next to the records of the world.
    ``cut`` may write the narrow table, so that its true size is known: a small one is then
    broadcast and no wide record is shuffled; for a larger one Spark may prune the wide side by a
    filter before the shuffle.
    """
    c = F.col
    if reasons is None:
        reasons = national_reasons(records, lookup, row_id, ror_on, last_names)
        reasons = cut(reasons) if cut else reasons
    found = records.join(drop_noise(reasons).drop("genre_raw"), row_id)
    rors = F.concat(record_rors(c("people"), ror_on), F.flatten(F.transform("hits", lambda h: h["rors"])))
    local = F.flatten(F.transform("hits", lambda h: h["local_affiliations"]))
    return found.withColumns(
        {
            "rors": F.array_sort(F.array_distinct(rors)),
            "local_affiliations_from_publications": F.array_sort(F.array_distinct(local)),
            "fr_publications_linked": linked(c("hits")),
            "fr_authors_orcid": F.transform(
                hits_of(c("hits"), ORCID),
                lambda h: F.struct(
                    F.try_element_at(c("people"), h["pos"] + 1)["person"].alias("author"),
                    h["rors"].alias("rors"),
                ),
            ),
            "fr_authors_name": F.transform(
                hits_of(c("hits"), NAME),
                lambda h: F.struct(F.struct(h["key"].alias("name")).alias("author"), h["rors"].alias("rors")),
            ),
        }
    ).drop("hits")
