"""A corpus pipeline out of the operators in ``citeloom.llm``: filter, dedup, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return
the columns of ``docs``, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import decontaminate, exact_dedup, mixing, ngram_join, quality
from citeloom.llm.common import read
from citeloom.llm.queries import MIX_EPOCHS, MIX_PART, MIX_SEED, MIX_WEIGHTS, mix_domain
from citeloom.session import cut_lineage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents of the input, does not reject."""
    return quality.drop_poor(docs, quality.fit_quality(docs, read(spark, sf_dir, "labels")))


def exact_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    return ngram_join.drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_overlaps(docs, read(spark, sf_dir, "benchmark"), shortest=1)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with mix_domain, mix_tokens and the number of copies to train on.

    Columns of the input that have one of these names give way.
    """
    taken = mixing.mix(docs, MIX_PART, MIX_WEIGHTS, mix_domain(), MIX_EPOCHS, MIX_SEED).where("copies > 0")
    own = {"mix_domain": "domain", "mix_tokens": "tokens", "copies": "copies"}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in own]
    return taken.select(*kept, *[F.col(c).alias(name) for name, c in own.items()])


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_once),
    ("ngram_join", near_once),
    ("decontaminate", decontaminated),
    ("mixing", mixed),
]

# The first stage is a trained sequence model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read back."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
