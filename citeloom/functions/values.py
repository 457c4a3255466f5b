"""Canonical forms of publishers, file formats, sizes and genres."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from citeloom.constants import (
    DATASET_PUBLISHERS,
    FORMAT_CLASSES,
    GENRE_OF_RELATION,
    GENRE_OF_TYPE,
    GENRE_OTHER,
    NATIONAL_CLIENT_PREFIX,
    NATIONAL_PUBLISHER_NAMES,
    NATIONAL_PUBLISHER_WORDS,
    PUBLISHER_FORMS,
    SIZE_CAT_NONE,
    SIZE_CATS,
    SIZE_COUNT_UNITS,
    SIZE_UNITS,
    TERRITORY_CODES,
    VERSION_COPY_ID_WORD,
    VERSION_COPY_PUBLISHERS,
)
from citeloom.functions.text import (
    as_column,
    ascii_fold,
    ascii_word,
    let,
    normalize,
    string_array,
    string_map,
    strip,
)

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"


def first_hit(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """One CASE expression over (condition, value) pairs in order."""
    condition, value = rules[0]
    case = F.when(condition, value)
    for condition, value in rules[1:]:
        case = case.when(condition, value)
    return case.otherwise(otherwise)


def normalize_publisher(doi: Column | str, publisher: Column | str) -> Column:
    doi, publisher = as_column(doi), as_column(publisher)

    def canonical(plain: Column) -> Column:
        small = F.lower(publisher)
        conditions = {
            "id": lambda text: F.contains(F.lower(doi), F.lit(text)),
            "norm": lambda text: F.contains(plain, F.lit(text)),
            "exact": lambda text: publisher == text,
            "prefix": lambda text: small.startswith(text),
            "lower": lambda text: F.contains(small, F.lit(text)),
        }
        rules = [(conditions[where](text), F.lit(name)) for where, text, name in PUBLISHER_FORMS]
        return first_hit(rules, publisher)

    return let(normalize(publisher), canonical)


def normalize_format(c: Column | str) -> Column:
    small = F.lower(as_column(c))
    rules = [
        (reduce(Column.__or__, [F.contains(small, F.lit(p)) for p in parts]), F.lit(name))
        for name, parts in FORMAT_CLASSES
    ]
    return first_hit(rules, small)


def parse_size(c: Column | str, fix_units: bool = False) -> Column:
    """``struct(mb, unit)`` of a size text, null when there is neither a value nor a unit.

    As defined, terabytes never give a value, and units that contain a shorter unit
    ("kbytes") are read as the shorter one and fail; ``fix_units`` repairs both.
    """
    order = SIZE_UNITS
    if fix_units:
        longest_first = [(sorted(units, key=len, reverse=True), scale) for units, scale in SIZE_UNITS]
        order = longest_first[1:] + longest_first[:1]
    names = [u for units, _ in order for u in units] + SIZE_COUNT_UNITS

    def detected(text: Column) -> Column:
        return first_hit([(F.contains(text, F.lit(u)), F.lit(u)) for u in names], F.lit(None))

    def valued(text: Column, unit: Column) -> Column:
        number = strip(F.replace(text, unit, F.lit("")))
        value = F.when(number.rlike(NUMBER), number.try_cast("double"))
        rules = []
        for units, scale in order:
            operator, factor = scale.split()
            amount = value / int(factor) if operator == "/" else value * int(factor)
            terabytes = "tb" in units
            rules.append((unit.isin(units), F.lit(None) if terabytes and not fix_units else amount))
        return first_hit(rules, F.lit(None)).cast("double")

    def size(text: Column, unit: Column) -> Column:
        mb = valued(text, unit)
        return let(mb, lambda m: F.when(m.isNotNull() | unit.isin(SIZE_COUNT_UNITS), _size(m, unit)))

    squeezed = F.regexp_replace(F.lower(as_column(c)), "[, ]", "")
    return let(squeezed, lambda text: let(detected(text), lambda unit: size(text, unit)))


def _size(mb: Column, unit: Column) -> Column:
    return F.struct(mb.alias("mb"), unit.alias("unit"))


def size_features(sizes: Column | str, fix_units: bool = False) -> Column:
    """``struct(size_total_mb, units, has_size, size_cat)`` of an array of size texts."""
    sizes = F.coalesce(as_column(sizes), F.array().cast("array<string>"))
    parsed = F.filter(F.transform(sizes, lambda s: parse_size(s, fix_units)), lambda p: p.isNotNull())

    def features(parsed: Column) -> Column:
        values = F.filter(F.transform(parsed, lambda p: p["mb"]), lambda mb: mb != 0)
        total = F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, b: a + b))
        return let(
            total,
            lambda t: F.struct(
                t.alias("size_total_mb"),
                F.transform(parsed, lambda p: p["unit"]).alias("units"),
                t.isNotNull().alias("has_size"),
                size_category(t).alias("size_cat"),
            ),
        )

    return let(parsed, features)


def size_category(total: Column) -> Column:
    edges = [total < 1, total <= 10, total <= 100, total <= 1000]
    rules = [(total.isNull(), F.lit(SIZE_CAT_NONE))]
    rules += [(edge, F.lit(name)) for edge, name in zip(edges, SIZE_CATS)]
    return first_hit(rules, F.lit(SIZE_CATS[-1]))


def is_national_publisher(publisher: Column | str) -> Column:
    """Any of the listed words as whole words, whatever the case."""
    pattern = "|".join(rf"\b{word}\b" for word in NATIONAL_PUBLISHER_WORDS)
    return F.coalesce(as_column(publisher).rlike(f"(?iU)({pattern})"), F.lit(False))


def is_national_publisher_name(publisher: Column | str) -> Column:
    """Older rule: one of six names, compared after ASCII folding."""
    names = [ascii_word(name) for name in NATIONAL_PUBLISHER_NAMES]
    return F.coalesce(ascii_fold(publisher).isin(names), F.lit(False))


def is_national_client(client_id: Column | str, fold: bool = False) -> Column:
    c = ascii_fold(client_id) if fold else as_column(client_id)
    return F.coalesce(c.startswith(NATIONAL_CLIENT_PREFIX), F.lit(False))


def has_national_country(countries: Column | str) -> Column:
    return F.coalesce(F.arrays_overlap(as_column(countries), string_array(TERRITORY_CODES)), F.lit(False))


def is_version_copy(doi: Column | str, plain_publisher: Column | str) -> Column:
    """DOI ending in ``.v<digits>`` from a repository whose versions are copies.

    ``plain_publisher`` is the publisher when the record gives it as plain text.
    """
    small = F.lower(as_column(doi))
    versioned = small.rlike(r"(^|\.)v[0-9]+\z")
    copied = F.lower(as_column(plain_publisher)).isin(VERSION_COPY_PUBLISHERS)
    return versioned & (F.coalesce(copied, F.lit(False)) | F.contains(small, F.lit(VERSION_COPY_ID_WORD)))


def genre_features(resource_type: Column, publisher: Column, related: Column) -> Column:
    """``struct(genre, genre_detail, nb_parts, subparts)``; subparts are whole relation objects.

    The last relation to another DOI that names a version, a part or a copy overrides
    the genre of the general resource type.
    """
    mapped = string_map(GENRE_OF_TYPE)
    genre = F.when(publisher.isin(DATASET_PUBLISHERS), "dataset").otherwise(
        F.coalesce(mapped[resource_type], F.lit(GENRE_OTHER))
    )
    to_doi = F.filter(related, lambda r: r["relatedIdentifierType"] == "DOI")
    deciding = F.filter(to_doi, lambda r: r["relationType"].isin(list(GENRE_OF_RELATION)))
    override = string_map(GENRE_OF_RELATION)[F.try_element_at(deciding, F.lit(-1))["relationType"]]
    return F.struct(
        F.coalesce(override, genre).alias("genre"),
        F.when(override.isNotNull(), F.concat_ws("_", override, resource_type))
        .otherwise(resource_type)
        .alias("genre_detail"),
        F.size(F.filter(to_doi, lambda r: r["relationType"] == "HasPart")).alias("nb_parts"),
        F.transform(F.filter(to_doi, lambda r: r["relationType"] == "IsPartOf"), lambda r: r["whole"]).alias("subparts"),
    )
