"""Comparable forms of URLs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from citeloom.constants import URL_NOISE_WORDS
from citeloom.functions.text import as_column, let, strip


def url_segments(c: Column | str) -> Column:
    """Host and telling path segments, lower case; null for texts shorter than two characters."""
    text = F.split(strip(F.lower(as_column(c))), r"\?")[0]
    for part in ("http://", "https://", "www."):
        text = F.replace(text, F.lit(part), F.lit(""))
    text = strip(text)
    noise = rf"^({'|'.join(URL_NOISE_WORDS)})(\.|\z)"

    def telling(text: Column) -> Column:
        segments = F.filter(
            F.split(text, "/"), lambda s, i: (s != "") & ((i == 0) | ~s.rlike(noise))
        )
        return F.when(F.char_length(text) >= 2, segments)

    return let(let(text, telling), lambda s: F.when(F.size(s) > 0, s))


def url_signature(c: Column | str) -> Column:
    """``struct(normalized, signatures)``: the joined segments; host suffixes of two labels
    and more, shortest first, then path prefixes, shortest first."""

    def suffixes(labels: Column) -> Column:
        lengths = F.when(F.size(labels) >= 2, F.sequence(F.lit(2), F.size(labels)))
        joined = F.transform(lengths, lambda n: F.array_join(F.slice(labels, -n, n), "."))
        return F.coalesce(joined, F.array().cast("array<string>"))

    def signature(segments: Column) -> Column:
        labels = F.filter(F.split(segments[0], r"\."), lambda s: s != "")
        prefixes = F.transform(
            F.sequence(F.lit(1), F.size(segments)),
            lambda n: F.array_join(F.slice(segments, 1, n), "/"),
        )
        both = F.struct(
            F.array_join(segments, "/").alias("normalized"),
            F.array_distinct(F.concat(let(labels, suffixes), prefixes)).alias("signatures"),
        )
        return F.when(segments.isNotNull(), both)

    return let(url_segments(c), signature)
