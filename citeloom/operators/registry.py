"""Repository registry: find the repository behind a URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.constants import REGISTRY_ALIASES
from citeloom.functions.urls import url_signature

DETAILED_SCHEME = "DFG"


def registry_subjects(subjects: Column | str) -> Column:
    """Subjects with code, level and label taken apart for the coded scheme."""

    def split(s: Column) -> Column:
        coded = s["scheme"] == DETAILED_SCHEME
        code = F.split(s["subject"], " ")[0]
        label = F.array_join(F.slice(F.split(s["subject"], " "), 2, F.size(F.split(s["subject"], " "))), " ")
        return F.struct(
            F.when(coded, label).otherwise(s["subject"]).alias("subject"),
            s["scheme"].alias("scheme"),
            F.when(coded, code).alias("subject_code"),
            F.when(coded, F.char_length(code)).alias("level"),
        )

    return F.transform(subjects, split)


def signed_registry(registry: DataFrame, url: str = "url") -> DataFrame:
    """Registry rows with the signature of their URL; rows without a usable one go."""
    return registry.withColumn("signature", url_signature(url)["normalized"]).where(
        F.col("signature").isNotNull()
    )


def registry_index(
    registry: DataFrame, order: str = "row_order", aliases: dict[str, str] = REGISTRY_ALIASES
) -> DataFrame:
    """``(signature, entry)``: the last row of a signature wins; aliases point to a known one."""
    signed = signed_registry(registry)
    entry = F.struct(*[c for c in signed.columns if c not in ("signature", order)])
    index = signed.groupBy("signature").agg(F.max_by(entry, order).alias("entry"))
    if not aliases:
        return index
    # the alias table is a handful of fixed rows
    targets = F.create_map(
        *[
            x
            for target in sorted(set(aliases.values()))
            for x in (F.lit(target), F.array(*[F.lit(a) for a in aliases if aliases[a] == target]))
        ]
    )
    known = index.select(F.explode(targets[F.col("signature")]).alias("signature"), "entry")
    plain = index.where(~F.col("signature").isin(list(aliases)))
    overridden = index.where(F.col("signature").isin(list(aliases))).join(
        known.select("signature"), "signature", "left_anti"
    )
    return plain.unionByName(overridden).unionByName(known)


def duplicate_signatures(registry: DataFrame) -> DataFrame:
    """Signatures shared by several registry rows."""
    return signed_registry(registry).groupBy("signature").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def match_registry(urls: DataFrame, index: DataFrame, url: str = "url", row_id: str = "url_id") -> DataFrame:
    """``(row_id, signature, entry)``: the first signature of a URL that is registered wins.

    The probe side is narrow; the winner is taken by partial aggregation, so a host that
    occurs in a large share of the rows meets in no single task.
    """
    probes = urls.select(row_id, F.posexplode(url_signature(url)["signatures"]).alias("pos", "signature"))
    hits = probes.join(index, "signature")
    best = F.min_by(F.struct("signature", "entry"), "pos").alias("m")
    return hits.groupBy(row_id).agg(best).select(row_id, "m.*")
