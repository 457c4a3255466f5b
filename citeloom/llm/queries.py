"""Registered queries of this package: each dealt operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    licenses,
    mixing,
    native_sql,
    ngram_join,
    periodic_runs,
    quality,
    secrets,
    top_k,
    toxicity,
    url_filter,
    whitening,
)
from citeloom.llm.common import read, remainder

Query = Callable[[SparkSession, str], DataFrame]

# The rules of op7.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

# The mix of op8 and of the pipeline: whole-number weights per level; values not named weigh 1.
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 2, "d2": 2, "d3": 1}, "lang": {"en": 3, "de": 2, "fr": 2, "es": 2}}
MIX_PART, MIX_EPOCHS, MIX_SEED = 0.5, 2, 7


def mix_domain() -> Column:
    """A source's domain: documents name none, so the sources are dealt out to four by their number."""
    number = F.coalesce(F.regexp_extract("source", r"([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return F.concat(F.lit("d"), (number % 4).cast("string"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_copies(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), shortest=1)
    return found.select("doc_id", "item_id", "start", "equal", "stretch", "n_hits")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    learned = language_id.learn_profiles(docs.where(~held_out))
    return language_id.predict_languages(docs, learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.fit_severity(docs, read(spark, sf_dir, "labels")))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), MIX_PART, MIX_WEIGHTS, mix_domain(), MIX_EPOCHS, MIX_SEED)
    return mixed.select(F.col("row.doc_id").alias("doc_id"), *mixing.LEVELS, "tokens", "copies")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scores = quality.quality_scores(docs, quality.fit_quality(docs, read(spark, sf_dir, "labels")))
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return scores.select("doc_id", held_out, "score", quality.is_kept(F.col("score")).cast("int").alias("predicted"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digests(secrets.find_secrets(read(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    model = whitening.fit_whitening(vectors)
    return whitening.whitened_entries(whitening.whiten(vectors, model), model)


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_repeats(read(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_secret_scan": op10_secret_scan,
    "op11_whitening": op11_whitening,
    "op12_top_k": op12_top_k,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": native_sql.OP2,
    "op5_license_scan": native_sql.OP5,
    "op7_url_filter": native_sql.OP7,
    "op8_mixing": native_sql.op8(
        MIX_PART,
        MIX_WEIGHTS,
        MIX_EPOCHS,
        MIX_SEED,
        "'d' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT), 0) % 4)",
    ),
    "op10_secret_scan": native_sql.OP10,
    "op12_top_k": native_sql.OP12,
}
