"""Fields of a DOI record.

A record is one JSON object. It is parsed once, into :data:`RECORD_SCHEMA`, where
fields whose shape varies stay VARIANT and elements whose *missing* keys matter are
maps (a missing key and a null value then differ). The functions below turn those raw
columns into the typed fields of the catalogue. Null arrays and null elements count as
empty everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.constants import (
    EXTERNAL_ID_TYPE,
    FOS_PREFIX_CHARACTERS,
    FOS_REFERENCE,
    FOS_SCHEME,
    SUBJECT_REFERENCE,
)
from citeloom.functions.text import as_column, let, strip

PERSON = (
    "struct<name:string,nameType:string,givenName:string,familyName:string,"
    "affiliationIdentifier:string,affiliation:variant,nameIdentifiers:variant>"
)
RELATED = "struct<relationType:string,relatedIdentifier:string,relatedIdentifierType:string,whole:variant>"
# lists of objects, and what an element of each becomes
ELEMENTS = {
    "titles": "map<string,string>",
    "subjects": "map<string,string>",
    "rightsList": "map<string,string>",
    "descriptions": "struct<description:variant,descriptionType:string>",
    "fundingReferences": "struct<funderName:string,awardNumber:string>",
    "creators": PERSON,
    "contributors": PERSON,
}

RECORD_SCHEMA = f"""struct<
  id:string,
  attributes:struct<
    publisher:variant, publicationYear:variant, language:string, url:string,
    created:string, registered:string, updated:string,
    types:struct<resourceType:string,resourceTypeGeneral:string>,
    titles:array<variant>, subjects:array<variant>, rightsList:array<variant>,
    descriptions:array<variant>, fundingReferences:array<variant>,
    relatedIdentifiers:array<variant>, creators:array<variant>, contributors:array<variant>,
    sizes:variant, formats:variant>,
  relationships:struct<client:struct<data:struct<id:string>>>>"""

ORCID_SCHEME = "ORCID"


# ---------------------------------------------------------------- small helpers


def empty_array(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def or_empty(c: Column, kind: str) -> Column:
    return F.coalesce(c, empty_array(kind))


def not_empty(c: Column) -> Column:
    """Keep truthy texts."""
    return F.filter(c, lambda x: x != "")


def safe_get(v: Column | str, path: str, default: str = "", kind: str = "string") -> Column:
    """Value at a path of a VARIANT; missing, null and falsy values give the default."""
    value = F.try_variant_get(as_column(v), path, kind)
    if kind == "string":
        shape = F.schema_of_variant(F.try_variant_get(as_column(v), path, "variant"))
        falsy = (value == "") | (
            (shape != "STRING") & value.isin("0", "0.0", "false", "[]", "{}")
        )
        value = F.when(~falsy, value)
    return F.coalesce(value, F.lit(default))


def text_only(v: Column) -> Column:
    """The string in a VARIANT, null when it holds anything else."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def as_list(v: Column) -> Column:
    """Array of a VARIANT that holds a list or one single element."""
    listed = F.try_variant_get(v, "$", "array<variant>")
    single = F.when(v.isNotNull() & ~F.is_variant_null(v), F.array(v))
    return F.filter(
        F.coalesce(listed, single, empty_array("variant")),
        lambda e: e.isNotNull() & ~F.is_variant_null(e),
    )


def identifiers(person: Column) -> Column:
    """Name identifiers of a person as array of (scheme, identifier)."""
    return F.transform(
        as_list(person["nameIdentifiers"]),
        lambda i: F.struct(
            text_only(F.try_variant_get(i, "$.nameIdentifierScheme", "variant")).alias("scheme"),
            text_only(F.try_variant_get(i, "$.nameIdentifier", "variant")).alias("identifier"),
        ),
    )


def affiliation_list(person: Column) -> Column:
    """Affiliations of a person as array of VARIANT, null elements kept."""
    return or_empty(F.try_variant_get(person["affiliation"], "$", "array<variant>"), "variant")


def people(creators: Column, contributors: Column) -> Column:
    """Creators then contributors, each with its role."""

    def with_role(c: Column, role: str) -> Column:
        present = F.filter(or_empty(c, PERSON), lambda p: p.isNotNull())
        return F.transform(present, lambda p: F.struct(F.lit(role).alias("role"), p.alias("person")))

    return F.concat(with_role(creators, "creator"), with_role(contributors, "contributor"))


# ---------------------------------------------------------------- fields


def title(titles: Column) -> Column:
    """Titles joined; one element without the key blanks the whole field."""
    present = F.filter(or_empty(titles, "map<string,string>"), lambda t: F.size(t) > 0)
    broken = F.exists(present, lambda t: ~F.map_contains_key(t, "title"))
    joined = F.array_join(not_empty(F.transform(present, lambda t: t["title"])), " ")
    return F.when(broken, "").otherwise(strip(joined))


def description(descriptions: Column, kind: str) -> Column:
    """Descriptions of one type joined; values that are not text are left out."""
    chosen = F.filter(
        or_empty(descriptions, "struct<description:variant,descriptionType:string>"),
        lambda d: d["descriptionType"] == kind,
    )
    return strip(
        F.array_join(not_empty(F.transform(chosen, lambda d: text_only(d["description"]))), " ")
    )


def subjects_plain(subjects: Column) -> Column:
    """Subjects without the scheme key at all."""
    chosen = F.filter(
        or_empty(subjects, "map<string,string>"), lambda s: ~F.map_contains_key(s, "subjectScheme")
    )
    return not_empty(F.transform(chosen, lambda s: s["subject"]))


def subjects_fos(subjects: Column, fix_fos: bool = False) -> Column:
    """Subjects of the fields-of-science scheme.

    The prefix is taken off as a set of characters, which may eat the first letters of
    the label; ``fix_fos`` takes off the prefix as a word instead.
    """
    chosen = F.filter(
        or_empty(subjects, "map<string,string>"), lambda s: s["subjectScheme"] == FOS_SCHEME
    )

    def label(s: Column) -> Column:
        if fix_fos:
            return F.regexp_replace(s["subject"], f"^{FOS_PREFIX_CHARACTERS}", "")
        return F.ltrim(s["subject"], F.lit(FOS_PREFIX_CHARACTERS))

    return not_empty(F.transform(chosen, label))


def classifications(subjects: Column, fix_fos: bool = False) -> Column:
    def labelled(c: Column, reference: str) -> Column:
        return F.transform(
            c, lambda s: F.struct(s.alias("label"), F.lit(reference).alias("reference"))
        )

    return F.array_distinct(
        F.concat(
            labelled(subjects_plain(subjects), SUBJECT_REFERENCE),
            labelled(subjects_fos(subjects, fix_fos), FOS_REFERENCE),
        )
    )


def licenses(rights: Column) -> Column:
    """Distinct licence ids, sorted; one element without the key empties the list."""
    present = F.filter(or_empty(rights, "map<string,string>"), lambda r: F.size(r) > 0)
    broken = F.exists(present, lambda r: ~F.map_contains_key(r, "rightsIdentifier"))
    found = not_empty(F.transform(present, lambda r: r["rightsIdentifier"]))
    listed = F.array_sort(F.array_distinct(F.transform(found, lambda r: F.lower(strip(r)))))
    return F.when(broken, empty_array("string")).otherwise(listed)


def grants(funding: Column) -> Column:
    kept = F.transform(
        or_empty(funding, "struct<funderName:string,awardNumber:string>"),
        lambda g: F.struct(
            F.nullif(g["funderName"], F.lit("")).alias("agency"),
            F.nullif(g["awardNumber"], F.lit("")).alias("grantid"),
        ),
    )
    return F.filter(kept, lambda g: g["agency"].isNotNull() | g["grantid"].isNotNull())


def related_dois(related: Column, relation: str) -> Column:
    chosen = F.filter(
        or_empty(related, RELATED),
        lambda r: (r["relationType"] == relation) & (r["relatedIdentifierType"] == "DOI"),
    )
    return not_empty(F.transform(chosen, lambda r: r["relatedIdentifier"]))


def full_name(person: Column) -> Column:
    """Given and family name, else the name; null when there is none."""
    built = strip(F.concat_ws(" ", person["givenName"], person["familyName"]))
    return F.coalesce(F.nullif(built, F.lit("")), strip(F.nullif(person["name"], F.lit(""))))


def object_name(person: Column) -> Column:
    """The name, else given and family name; '' when there is none."""
    parts = F.concat_ws(
        " ", F.coalesce(person["givenName"], F.lit("")), F.coalesce(person["familyName"], F.lit(""))
    )
    return strip(F.coalesce(F.nullif(person["name"], F.lit("")), parts))


def orcid(person: Column) -> Column:
    """Tail of the last identifier under the exact ORCID scheme."""
    found = F.filter(
        identifiers(person), lambda i: (i["scheme"] == ORCID_SCHEME) & i["identifier"].isNotNull()
    )
    return F.substring_index(F.try_element_at(found, F.lit(-1))["identifier"], "/", -1)


def authors(everyone: Column) -> Column:
    def author(p: Column) -> Column:
        person = p["person"]
        filled = let(affiliation_list(person), lambda a: F.when(F.size(a) > 0, a))
        return F.struct(
            p["role"].alias("role"),
            F.nullif(person["givenName"], F.lit("")).alias("first_name"),
            F.nullif(person["familyName"], F.lit("")).alias("last_name"),
            full_name(person).alias("full_name"),
            filled.alias("affiliations"),
            orcid(person).alias("orcid"),
        )

    return F.transform(everyone, author)


def record_affiliations(everyone: Column) -> Column:
    """Distinct affiliations of the record in first-seen order.

    VARIANT values do not compare, so they are told apart by their JSON text, whose keys
    come sorted.
    """
    listed = F.flatten(F.transform(everyone, lambda p: affiliation_list(p["person"])))
    return F.transform(F.array_distinct(F.transform(listed, lambda a: F.to_json(a))), F.parse_json)


def strip_people(everyone: Column) -> Column:
    """Authors that have affiliations (as maps), empty values of both left out."""

    def clean(p: Column) -> Column:
        texts = ("first_name", "last_name", "full_name", "orcid")
        filled = F.transform(
            p["affiliations"], lambda a: F.map_filter(a, lambda _, value: value.isNotNull() & (value != ""))
        )
        return F.struct(
            p["role"].alias("role"),
            *[F.nullif(p[t], F.lit("")).alias(t) for t in texts],
            filled.alias("affiliations"),
        )

    return F.transform(F.filter(everyone, lambda p: p["affiliations"].isNotNull()), clean)


def affiliation_string(v: Column) -> Column:
    """The identifier of an affiliation when the key holds a value, else its other values
    joined by blanks; lower case. Keys are taken in alphabetical order."""
    entries = F.try_variant_get(v, "$", "map<string,variant>")
    texts = F.map_from_entries(
        F.transform(
            F.map_entries(entries),
            lambda e: F.struct(
                e["key"].alias("key"),
                F.when(~F.is_variant_null(e["value"]), F.try_variant_get(e["value"], "$", "string")).alias(
                    "value"
                ),
            ),
        )
    )
    others = F.map_filter(texts, lambda k, _: k != "affiliationIdentifierScheme")
    joined = F.array_join(not_empty(F.map_values(others)), " ")
    return F.lower(F.coalesce(texts["affiliationIdentifier"], joined, text_only(v), F.lit("")))


def first_creator_name(creators: Column) -> Column:
    return full_name(F.try_element_at(creators, F.lit(1)))


def natural_key(record_title: Column, name: Column, year: Column, publisher: Column) -> Column:
    """``title;first creator;year;publisher``, null unless all four are there."""
    complete = (
        (record_title != "") & (name != "") & (year.isNotNull() & (year != 0)) & (publisher != "")
    )
    return F.when(complete, F.concat_ws(";", record_title, name, year.cast("string"), publisher))


# ---------------------------------------------------------------- typed record table


def parse_records(df: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON lines and flatten one level; lines that do not parse or have no id go."""
    # a generator, so that the filter on its output does not parse the text a second time
    parsed = df.select(*keep, F.inline(F.array(F.from_json(text, RECORD_SCHEMA))))
    return flatten_record(parsed, keep)


def flatten_record(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, attributes, relationships`` to raw columns, records without id dropped.

    The elements of lists are typed one by one: one that is no object becomes null, its
    neighbours stay, and ``unreadable`` counts such elements of the record.
    """
    raw = parsed.where(F.col("id").isNotNull()).select(
        *keep, "id", "attributes.*", F.col("relationships.client.data.id").alias("_client")
    )
    typed = {name: each_as(name, kind) for name, kind in ELEMENTS.items()}
    typed["relatedIdentifiers"] = F.transform("relatedIdentifiers", relation)
    return raw.withColumns({**typed, "unreadable": sum((lost(name, c) for name, c in typed.items()), F.lit(0))})


def each_as(name: str, kind: str) -> Column:
    return F.transform(name, lambda e: F.try_variant_get(e, "$", kind))


def relation(e: Column) -> Column:
    """A related identifier: the three fields that rules look at, and the whole object."""
    fields = [F.try_variant_get(e, f"$.{f}", "string").alias(f) for f in ("relationType", "relatedIdentifier", "relatedIdentifierType")]
    is_object = F.try_variant_get(e, "$", "struct<relationType:variant>").isNotNull()
    return F.when(is_object, F.struct(*fields, e.alias("whole")))


def lost(name: str, typed: Column) -> Column:
    """How many elements of a list are neither null nor objects."""
    filled = F.size(F.filter(name, lambda e: e.isNotNull() & ~F.is_variant_null(e)))
    return F.greatest(filled - F.size(F.filter(typed, lambda e: e.isNotNull())), F.lit(0))


def record_columns(raw: DataFrame, keep: tuple[str, ...] = (), fix_fos: bool = False) -> DataFrame:
    """Typed, narrow record table out of :func:`parse_records`.

    One row per record, no shuffle. Every later step reads these columns only, so a
    Parquet copy of this table is the natural place to cut a long job in two.
    """
    c = F.col
    publisher = F.try_variant_get(c("publisher"), "$.name", "string")
    year_text = F.try_variant_get(c("publicationYear"), "$", "string")
    year = F.when(year_text.rlike(r"^\s*[+-]?[0-9]+\s*$"), strip(year_text).try_cast("int"))
    # a year of 0 is falsy in the source and therefore missing
    year = F.when(year != 0, year)
    everyone = people(c("creators"), c("contributors"))
    record_title = title(c("titles"))
    publisher_name = F.coalesce(publisher, F.lit(""))
    formats = F.coalesce(
        F.try_variant_get(c("formats"), "$", "array<string>"),
        F.when(text_only(c("formats")).isNotNull(), F.array(text_only(c("formats")))),
    )
    return raw.select(
        *keep,
        c("id"),
        record_title.alias("title"),
        year.alias("year"),
        F.when(F.schema_of_variant(c("publicationYear")) == "BIGINT", year).alias("lookup_year"),
        publisher_name.alias("publisher_raw"),
        text_only(c("publisher")).alias("publisher_text"),
        F.coalesce(c("_client"), F.lit("")).alias("client_id"),
        F.coalesce(c("language"), F.lit("")).alias("language"),
        F.coalesce(c("url"), F.lit("")).alias("url"),
        F.coalesce(c("created"), F.lit("")).alias("created"),
        F.coalesce(c("registered"), F.lit("")).alias("registered"),
        F.coalesce(c("updated"), F.lit("")).alias("update_date"),
        F.lower(F.coalesce(c("types.resourceType"), F.lit(""))).alias("resourceType"),
        F.lower(F.coalesce(c("types.resourceTypeGeneral"), F.lit(""))).alias("genre_raw"),
        description(c("descriptions"), "Abstract").alias("abstract_text"),
        description(c("descriptions"), "Other").alias("description"),
        description(c("descriptions"), "Methods").alias("methods"),
        classifications(c("subjects"), fix_fos).alias("classifications"),
        licenses(c("rightsList")).alias("licenses"),
        grants(c("fundingReferences")).alias("grants"),
        F.filter(or_empty(c("relatedIdentifiers"), RELATED), lambda r: r.isNotNull()).alias("related"),
        everyone.alias("people"),
        F.when(
            F.size(or_empty(formats, "string")) > 0, formats
        ).otherwise(F.array(F.lit(""))).alias("format_raw"),
        F.try_variant_get(c("sizes"), "$", "array<string>").alias("size"),
        natural_key(
            record_title, first_creator_name(c("creators")), year, publisher_name
        ).alias("natural_key"),
    )


def external_ids(doi: Column) -> Column:
    return F.array(
        F.struct(F.lit(EXTERNAL_ID_TYPE).alias("id_type"), doi.alias("id_value"))
    )
