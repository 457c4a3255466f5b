"""URL filter: host-suffix and path-prefix expressions met by short hash prefixes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citeloom.llm.common import ascii_lower
from citeloom.session import cut_lineage

RULE = T.StructType(
    [
        T.StructField("rule_host", T.StringType()),
        T.StructField("rule_path", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)

# Hexadecimal digits of the digest that expressions meet by: 32 bits.
SHORT = 8


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, "allow" or "block") as a table, written so that Spark knows its size."""
    return cut_lineage(spark.createDataFrame(list(rules), RULE))


def digest(host: Column, path: Column) -> Column:
    # a line feed occurs in no host of a rule
    return F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256)


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A rule fits its host and every subdomain of it when the path begins with the rule's path; the
    longest rule (host and path together) wins, then the one with the longer host, then "block".
    Without a rule the verdict is ``default``. Different (host, path) pairs are judged once, however
    many pages share them; each is expanded into the suffixes of its host and the prefixes of its
    path that have the length of some rule's path, and these meet the rules by the first 32 bits of
    their digest before whole digests are compared.

    A null url, or one without ``://``, has an empty host and path and gets the default. Empty
    tables of pages give an empty result, empty tables of rules the default everywhere. Repeated
    rules count once, repeated pages get a row each; other columns are not looked at.
    """
    rules = (
        rules.where("rule_host <> '' and rule_path is not null and verdict is not null")
        .select(ascii_lower(F.col("rule_host")).alias("rule_host"), "rule_path", "verdict")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("rule_digest", digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("rule_digest", 1, SHORT))
    )
    # one number per different length: bounded by the longest path of a rule
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    pages = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    different = pages.where("host <> ''").select("host", "path").distinct()
    parts = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )
    known = F.array(*[F.lit(n) for n in lengths]) if lengths else F.array().cast("array<int>")
    prefixes = F.transform(
        F.filter(known, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    expressions = (
        different.select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
        .withColumn("digest", digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    hits = expressions.join(rules, "short").where("digest = rule_digest and suffix = rule_host and prefix = rule_path")
    order = F.struct(F.length(F.concat("rule_host", "rule_path")), F.length("rule_host"), F.col("rule_verdict"))
    decided = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), order).alias("won")
    )
    # an empty host meets nothing: spread instead of sharing one key
    return pages.join(decided, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("won.rule").alias("rule"),
        F.coalesce("won.rule_verdict", F.lit(default)).alias("verdict"),
    )
