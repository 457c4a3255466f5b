"""License scans: rolling word grams met with templates, votes per diagonal, verified spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.common import ascii_lower
from citeloom.session import cut_lineage

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices that the method adds, by label: sentences of public license headers.
NOTICES = {
    "apache": ["licensed under the apache license version 2 0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "cc-by-sa": ["licensed under cc by sa 4 0", "creative commons attribution sharealike license"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related rights"],
    "gpl": ["this work is licensed under the gnu general public license version 3"],
    "lgpl": ["gnu lesser general public license"],
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl": ["this source code form is subject to the terms of the mozilla public license"],
    "reserved": ["all rights reserved"],
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What stands between words in any case, character by character: Java tests a class of ranges range by range,
# through calls that make the tasks of one process wait for each other.
BETWEEN = "[" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"
KELVIN = "\u212a"
K = 2
# Diagonals this close belong to one span: a word more or less in between.
NEAR = 2
# Part of a notice's grams that a span must hold.
LEAST = 0.75


def split_words(text: Column) -> Column:
    """An empty text, then the words, then one more empty text where the text ends between words.

    Words are so lower-cased that they equal a word of ASCII letters when they do with A-Z alone: other
    capitals stay outside of ASCII when they are lower-cased, but for the Kelvin sign.
    """
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.contains(text, F.lit(KELVIN)), ascii_lower(text)).otherwise(F.lower(text))
    return F.split(F.concat(F.lit(" "), low), BETWEEN)


def templates(notices: dict[str, list[str]] = NOTICES) -> list[tuple[str, str, bool]]:
    """Phrase, label, and whether it is a base phrase."""
    own = [(phrase, label, True) for phrase, label in BASE.items()]
    return own + [(phrase, label, False) for label, phrases in notices.items() for phrase in phrases]


def template_grams(spark: SparkSession, listed: list[tuple[str, str, bool]]) -> DataFrame:
    """One row per gram of every template: its words, place and the template's number of grams."""
    rows = []
    for number, (phrase, label, base) in enumerate(listed):
        words = phrase.split()
        rows += [
            (number, label, base, len(words) - K + 1, i, words[i], words[i + 1]) for i in range(len(words) - K + 1)
        ]
    made = spark.createDataFrame(
        rows, "template int, label string, base boolean, n_grams int, place int, t1 string, t2 string"
    )
    # written, so that its size is known and Spark can send it to all tasks
    return cut_lineage(made.withColumn("gram", F.xxhash64("t1", "t2")))


def scan_words(docs: DataFrame, listed: list[tuple[str, str, bool]], text_col: str, *ids: Column) -> DataFrame:
    """Written rows of one pass over the texts: ids, key, n_words, pos, w1, w2.

    A row per row of ``docs``, with a null ``pos``, and a row per place of two neighbouring words that
    are a pair of a template. ``key`` is the text's digest.
    """
    grams = sorted({" ".join(words[i : i + K]) for words in (phrase.split() for phrase, _, _ in listed) for i in range(len(words) - K + 1)})
    # most pairs begin with a word that begins no pair of a template
    begins = sorted({gram.split()[0] for gram in grams})
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(*ids, F.md5(text.cast("binary")).alias("key"), split_words(F.col(text_col)).alias("w"))
    n_words = F.size("w") - 1 - (F.element_at("w", -1) == "").cast("int")
    pairs = F.arrays_zip(F.col("w").alias("a"), F.slice("w", K, F.size("w")).alias("b"))
    # outer, though no list is empty: else Spark asks first whether it is, and splits every text twice
    rows = rows.withColumn("n_words", n_words.cast("long")).select("*", F.posexplode_outer(pairs).alias("at", "pair")).drop("w")
    first, second = F.col("pair.a"), F.col("pair.b")
    found = first.isin(begins) & F.concat_ws(" ", first, second).isin(grams)
    place = F.when(F.col("at") > 0, F.col("at") - 1).alias("pos")
    rows = rows.where((F.col("at") == 0) | found).select("*", place, first.alias("w1"), second.alias("w2"))
    return cut_lineage(rows.drop("at", "pair"))


def license_spans(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, text_col: str = "text") -> DataFrame:
    """Verified spans by text: key, template, label, base, first_word, last_word (of the span), score.

    Every pair of neighbouring words of every text meets the templates, by its hash where it is one of their
    pairs, and counts when the words are equal too. Hits of one template on one diagonal (word number less
    place in the template) vote together; diagonals at most ``NEAR`` apart are merged, and the merged span stays
    when it holds all grams of a base phrase, or ``LEAST`` of the grams of a notice. Base phrases
    must lie on one diagonal. ``key`` is the text's digest: copies share their spans.
    """
    listed = templates(notices)
    return spans_of(scan_words(docs, listed, text_col), listed)


def spans_of(scanned: DataFrame, listed: list[tuple[str, str, bool]]) -> DataFrame:
    """The spans of ``license_spans`` from the rows of ``scan_words``."""
    grams = template_grams(scanned.sparkSession, listed)
    pairs = scanned.where("pos IS NOT NULL").select("key", "pos", "w1", "w2")
    hits = pairs.withColumn("gram", F.xxhash64("w1", "w2")).join(grams, "gram").where("w1 = t1 and w2 = t2")
    # a hit of two copies of a text is one hit
    diagonals = (
        hits.groupBy("key", "template", (F.col("pos") - F.col("place")).alias("diagonal"))
        .agg(
            F.collect_set("place").alias("places"),
            F.first("label").alias("label"),
            F.first("base").alias("base"),
            F.first("n_grams").alias("n_grams"),
        )
    )
    along = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(along) > NEAR)
    groups = diagonals.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn(
        "group", F.sum("new").over(along)
    )
    merged = groups.groupBy("key", "template", "group").agg(
        F.first("label").alias("label"),
        F.first("base").alias("base"),
        F.first("n_grams").alias("n_grams"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.col("diagonal") + F.array_min("places")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("places") + K - 1).alias("last_word"),
    )
    score = F.size("places") / F.col("n_grams")
    enough = F.when(F.col("base"), F.size("places") == F.col("n_grams")).otherwise(score >= LEAST)
    return merged.where(enough).select(
        "key", "template", "label", "base", "first_word", "last_word", score.alias("score")
    )


def scan_licenses(
    docs: DataFrame, notices: dict[str, list[str]] = NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest
    and largest start of one (null without any). ``labels`` adds those of notices; both lists are
    distinct, sorted and comma-joined, empty without a hit. ``score`` is the best span's part of its
    template, 0 without any.

    Texts are read and split once; what later steps need of them is written. Null and empty texts have no
    words and no labels; very long texts are scanned whole, their words dealt out as rows. Copies and repeated rows share the spans of their text and get a row each;
    an empty table gives an empty result, other columns are not looked at.
    """
    listed = templates(notices)
    scanned = scan_words(docs, listed, text_col, F.col(id_col).alias("doc_id"))
    spans = spans_of(scanned, listed)
    base = F.col("base")
    by_text = spans.groupBy("key").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    rows = scanned.where("pos IS NULL")
    return rows.join(by_text, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
