"""Mixing sources to target weights: hierarchical token budgets, seeded epochs of documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.session import cut_lineage

LEVELS = ("domain", "lang", "source")
EXACT = "decimal(38,0)"

# An epoch's order is cut into slices by the first 16 bits of its key.
SLICE_DIGITS = 4


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def weight_of(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    """The weight of a node among its siblings; values that are not named weigh 1."""
    known = weights.get(level) or {}
    if any(w < 0 or w != int(w) for w in known.values()):
        raise ValueError("weights are whole numbers, 0 or more")
    found = F.lit(1)
    for value, weight in known.items():
        found = F.when(F.col(level) == value, F.lit(int(weight))).otherwise(found)
    return found.cast(EXACT)


def share_out(nodes: DataFrame, parents: list[str], order: list[str]) -> DataFrame:
    """Fills siblings to one common level: each gets its weight's part of the parent's budget, none
    more than its ``supply``, and what short ones leave goes to the others.

    Columns in: the parents' values, ``budget`` of the parent, ``supply`` and ``weight`` of the
    node. Adds ``given``. In order of supply per weight, the short nodes come first: node i is
    short when the rest of the budget at its weight reaches its supply.
    """
    siblings = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    ranked = siblings.orderBy(F.expr("double(supply) / double(weight)"), *order).rowsBetween(Window.unboundedPreceding, -1)
    nodes = (
        nodes.withColumn("before", F.coalesce(F.sum("supply").over(ranked), F.lit(0)).cast(EXACT))
        .withColumn("lighter", F.coalesce(F.sum("weight").over(ranked), F.lit(0)).cast(EXACT))
        .withColumn("heavier", (F.sum("weight").over(siblings) - F.col("lighter")).cast(EXACT))
        .withColumn("short", F.expr("(budget - before) * weight >= supply * heavier"))
    )
    short = F.coalesce(F.sum(F.when(F.col("short"), F.col("supply"))).over(siblings), F.lit(0))
    rest = F.sum(F.when(~F.col("short"), F.col("weight"))).over(siblings)
    nodes = nodes.withColumn("left", (F.col("budget") - short).cast(EXACT)).withColumn("rest", rest.cast(EXACT))
    given = F.when(F.col("short"), F.col("supply")).otherwise(F.expr("left * weight div rest"))
    return nodes.withColumn("given", given.cast(EXACT)).drop("before", "lighter", "heavier", "short", "left", "rest")


def leaf_budgets(leaves: DataFrame, budget: int, weights: Mapping[str, Mapping[str, int]], epochs: int) -> DataFrame:
    """Budgets of the leaves: domain, lang, source, tokens, given.

    A leaf can supply ``epochs`` times its tokens, a node what its children supply. Each node's
    budget is shared among its children by ``share_out``, from the root down: as no node is given
    more than it can supply, what a leaf is short of goes to its siblings first, and to its
    parent's siblings only when all of them are exhausted. The table has one row per leaf.
    """
    for level in LEVELS:
        leaves = leaves.withColumn(f"{level}_weight", weight_of(level, weights))
    usable = leaves.where(" and ".join(f"{level}_weight > 0" for level in LEVELS) + " and tokens > 0")
    nodes = usable.withColumn("supply", (F.col("tokens") * epochs).cast(EXACT))
    nodes = nodes.withColumn("budget", F.lit(int(budget)).cast(EXACT))
    for depth, level in enumerate(LEVELS):
        parents, own = list(LEVELS[:depth]), list(LEVELS[: depth + 1])
        children = nodes.groupBy(*own).agg(
            F.sum("supply").cast(EXACT).alias("supply"),
            F.max("budget").alias("budget"),
            F.max(f"{level}_weight").alias("weight"),
        )
        given = share_out(children, parents, [level]).select(*[F.col(c).alias(f"of_{c}") for c in [*own, "given"]])
        same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in own]
        nodes = nodes.join(given, same).withColumn("budget", F.col("of_given")).drop(*given.columns)
    return nodes.select(*LEVELS, "tokens", F.col("budget").cast("long").alias("given"))


def mix(
    docs: DataFrame,
    budget: int | float,
    weights: Mapping[str, Mapping[str, int]] | None = None,
    domain: Column | None = None,
    epochs: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """How often each document is taken: its columns as ``row``, with domain, lang, source, tokens, copies.

    ``budget`` is a number of tokens, or a part of all tokens when it is a float; tokens are words.
    ``weights`` names weights of the values of each level (whole numbers; 1 for values not named, 0
    takes nothing). A leaf's budget covers whole epochs of it and a prefix of one more: ``copies``
    is the number of epochs that hold the document. An epoch's order is that of md5(seed:epoch:id),
    and the prefix ends with the document that reaches the budget.

    A null domain, language or source is a value of its own. Documents with a null text or without
    words have no tokens and are never taken; rows that repeat an id share their place and come
    together, ties of the order are rows of the same id. Very long texts count whole. An empty
    table gives an empty result. The input's columns travel inside ``row``, whatever their names.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"),
        (domain if domain is not None else F.lit(None).cast("string")).alias("domain"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col(text_col)).alias("tokens"),
        key.alias("key"),
    )
    narrow = cut_lineage(rows.drop("row"))
    by_leaf = narrow.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    by_leaf = cut_lineage(by_leaf)
    if isinstance(budget, float):
        total = by_leaf.agg(F.sum("tokens")).first()[0] or 0
        budget = int(total * budget)
    given = leaf_budgets(by_leaf, budget, weights or {}, epochs).select(
        *[F.col(level).alias(f"of_{level}") for level in LEVELS],
        F.expr("given div tokens").alias("full"),
        F.expr("given % tokens").alias("need"),
    )
    same = [F.col(level).eqNullSafe(F.col(f"of_{level}")) for level in LEVELS]
    given = cut_lineage(given)

    def placed(table: DataFrame, how: str = "inner") -> DataFrame:
        """The order of each row within the last, partial epoch of its leaf."""
        order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("full").cast("string"), F.col("key")).cast("binary"))
        return (
            table.join(given, same, how)
            .withColumn("order", order)
            .withColumn("slice", F.conv(F.substring("order", 1, SLICE_DIGITS), 16, 10).cast("int"))
        )

    leaf = [f"of_{level}" for level in LEVELS]
    # running totals of slices, then of the documents of the one slice where the budget ends
    slices = placed(narrow).groupBy(*leaf, "need", "slice").agg(F.sum("tokens").alias("tokens"))
    so_far = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("tokens").over(so_far), F.lit(0)))
    ends = slices.where("before < need and before + tokens >= need").select(
        *[F.col(c).alias(f"end_{c}") for c in leaf], F.col("slice").alias("end_slice"), "before"
    )
    at_end = [F.col(c).eqNullSafe(F.col(f"end_{c}")) for c in leaf]
    last = placed(narrow).join(ends, [*at_end, F.col("slice") == F.col("end_slice")])
    last = last.groupBy(*leaf, "need", "before", "end_slice", "order").agg(F.sum("tokens").alias("tokens"))
    inside = Window.partitionBy(*leaf).orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn("sum", F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    # the prefix ends at the last document that begins before the budget is reached
    last_order = F.max(F.when(F.col("sum") < F.col("need"), F.col("order")))
    limits = last.groupBy(*leaf).agg(last_order.alias("last_order"))
    limits = cut_lineage(limits.select(*[F.col(c).alias(f"end_{c}") for c in leaf], "last_order"))
    chosen = placed(rows, "left").join(limits, at_end, "left")
    extra = F.coalesce((F.col("order") <= F.col("last_order")) & (F.col("need") > 0), F.lit(False))
    copies = F.when(F.col("tokens") > 0, F.coalesce("full", F.lit(0)) + extra.cast("long")).otherwise(F.lit(0))
    return chosen.select("row", *LEVELS, "tokens", copies.cast("long").alias("copies"))
