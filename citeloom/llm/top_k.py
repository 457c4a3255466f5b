"""Exact top-k search by inner product: sorted lists read in step, bounds on scores, no random access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.vectors import whole_vectors
from citeloom.session import cut_lineage

K = 10
SCALE = 1024
# Larger whole numbers take no part: sums of products of up to 8,192 of them stay within 63 bits.
LARGEST = 1 << 25
# Vectors in a block of candidates and of queries at most, and blocks of candidates at least.
CANDIDATES = 16_384
QUERIES = 1_024
BLOCKS = 16
# Entries read from each list in the first round, and how the depth grows from round to round.
DEPTH = 64
GROWTH = 2.0
# Reading stops when so many times k candidates are left.
LEFT = 4


class Lists:
    """The candidates of a block as one list per dimension, sorted by value."""

    def __init__(self, vectors: np.ndarray, ranks: np.ndarray):
        self.vectors, self.ranks = vectors, ranks
        turned = np.ascontiguousarray(vectors.T)
        places = np.argsort(turned, axis=1, kind="stable")
        values = np.take_along_axis(turned, places, axis=1).astype(np.float64)
        # a row for each list; each dimension twice: from its smallest value on, and from its greatest one on
        self.places = np.concatenate([places, places[:, ::-1]])
        self.values = np.concatenate([values, values[:, ::-1]])
        self.largest = float(np.abs(values[:, [0, -1]]).max(initial=0.0))

    def insiders(self, query: np.ndarray, k: int) -> np.ndarray:
        """Places of the candidates that may be among the k best; all others are ruled out.

        The list of a dimension is read from the end where its products are greatest. After each
        round a candidate's score lies between what was read of it plus the least product of each
        list it was not met in, and the same with the products the lists have come down to. Who
        cannot reach the k-th best lower bound is out, unless his bounds are equal. No upper bound is below that of
        a candidate not met at all, so nobody is looked at while that one could still win.
        """
        n, used = len(self.vectors), np.flatnonzero(query)
        if n <= LEFT * k or not len(used):
            return np.arange(n)
        lists = used + np.where(query[used] > 0, self.vectors.shape[1], 0)
        weight = query[used].astype(np.float64)[:, None]
        rows = np.arange(len(used))[:, None]
        # products above the least one of their list, so that all are 0 or more
        least = self.values[lists, -1:] * weight
        # rounding of sums of products, on the safe side
        slack = len(used) * 2.0**-48 * (np.abs(weight).sum() * self.largest + 1)
        read = np.zeros(n)
        met, noted = None, 0
        alive = np.arange(n)
        begin, end = 0, min(DEPTH, n)
        while True:
            gained = self.values[lists, begin:end] * weight - least
            read += np.bincount(self.places[lists, begin:end].ravel(), gained.ravel(), n)
            frontier = gained[:, -1]
            kth = np.partition(read[alive], len(alive) - k)[-k]
            if end == n:
                return alive[read[alive] + slack >= kth - slack]
            if frontier.sum() + slack < kth - slack:
                met = np.zeros((len(used), n), dtype=bool) if met is None else met
                met[rows, self.places[lists, noted:end]] = True
                noted = end
                reach = read[alive] + frontier.sum() - frontier @ met[:, alive]
                alive = alive[reach + slack >= kth - slack]
                if len(alive) <= LEFT * k:
                    return alive
            begin, end = end, min(n, int(end * GROWTH) + 1)

    def best(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best candidates: greatest score, then smallest rank."""
        places = self.insiders(query, k)
        scores = self.vectors[places] @ query
        order = np.lexsort((self.ranks[places], -scores))[:k]
        return places[order], scores[order]


def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def block_winners(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query within each block: query, candidate, score, first_id.

    ``queries`` has i, j, key, x and ``candidates`` i, j, key, x, first_id: a group is one block of
    candidates (i) with one block of queries (j), both of bounded size.
    """
    id_type = candidates.schema["first_id"].dataType.simpleString()

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if asked.num_rows and held.num_rows:
            order = pc.sort_indices(held, sort_keys=[("first_id", "ascending")], null_placement="at_end").to_numpy()
            ranks = np.empty(len(order), dtype=np.int64)
            ranks[order] = np.arange(len(order))
            lists = Lists(matrix(held.column("x"), held.num_rows), ranks)
            for number, query in enumerate(matrix(asked.column("x"), asked.num_rows)):
                found.append((number, *lists.best(query, k)))
        of_query = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
        places = np.concatenate([f[1] for f in found] or [np.zeros(0, dtype=np.int64)])
        scores = np.concatenate([f[2] for f in found] or [np.zeros(0, dtype=np.int64)])
        return pa.Table.from_arrays(
            [
                asked.column("key").take(pa.array(of_query)),
                held.column("key").take(pa.array(places)),
                pa.array(scores.astype(np.int64)),
                held.column("first_id").take(pa.array(places)),
            ],
            names=["query", "candidate", "score", "first_id"],
        )

    grouped = queries.groupBy("i", "j").cogroup(candidates.groupBy("i", "j"))
    return grouped.applyInArrow(search, f"query string, candidate string, score long, first_id {id_type}")


def scaled(vector: Column) -> Column:
    """Whole numbers floor(SCALE * component) of a vector of numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def search(
    vectors: DataFrame, wanted: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The k rows of greatest inner product with each row where ``wanted`` holds: query_id, rank, vec_id, score.

    Components become floor(1024 * c), scores are whole numbers; ties go to the smaller id. Every row
    but the query's own is a candidate.

    Rows with one vector are searched once, as query and as candidate, and are dealt back at the end, so a
    vector that many rows hold costs nothing more. Different candidates and queries are put in
    blocks of bounded size by a hash; each pair of blocks is one task's work, in which
    lists of the block, sorted by dimension, are read in step until no candidate outside the few
    that are left can be among the best; those few get their exact scores. The best k + 1 of each
    block meet in one ranking per query. As exact search asks for, every query meets every block: work
    grows with queries times candidates, and each block is sent once per block of queries.

    Vectors that are null, empty, or hold a null, a component that is not finite or one of 32,768 or
    more, take no part, nor do those of another length than most have. Rows that repeat an id are rows
    of their own: one of them is the query's own row, the others are candidates. A null id is no
    query unless ``wanted`` says so, and comes last among ties. With fewer candidates all are
    returned; an empty table gives an empty result, other columns are not looked at.
    """
    spark = vectors.sparkSession
    sized = whole_vectors(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), wanted.alias("asks")))
    rows = sized.select("id", "asks", scaled(F.col("vector")).alias("x"))
    rows = rows.where((F.array_min("x") > -LARGEST) & (F.array_max("x") < LARGEST))
    rows = rows.withColumn("key", F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")).cast("binary"), 256))
    held = cut_lineage(
        rows.groupBy("key", "x").agg(F.min("id").alias("first_id"), F.max(F.coalesce("asks", F.lit(False))).alias("asks"))
    )
    n = held.count()
    blocks = max(BLOCKS, -(-n // CANDIDATES))
    query_blocks = -(-held.where("asks").count() // QUERIES)
    if not query_blocks:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    own = F.xxhash64("key")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = held.select(F.pmod(own, F.lit(blocks)).cast("int").alias("i"), every(query_blocks).alias("j"), "key", "x", "first_id")
    queries = held.where("asks").select(every(blocks).alias("i"), F.pmod(own, F.lit(query_blocks)).cast("int").alias("j"), "key", "x")
    winners = block_winners(queries, candidates, k + 1)

    def first(table: DataFrame, group: str, *order: Column) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(group).orderBy(*order))
        return table.withColumn("number", number).where(F.col("number") <= k + 1).drop("number")

    by_score = [F.col("score").desc(), F.col("first_id").asc_nulls_last()]
    winners = first(winners, "query", *by_score).drop("first_id")
    # of rows with one vector the first k + 1 by id
    members = first(rows.select(F.col("key").alias("candidate"), "id"), "candidate", F.col("id").asc_nulls_last())
    ranked = first(winners.join(members, "candidate"), "query", F.col("score").desc(), F.col("id").asc_nulls_last())
    entry = F.struct((-F.col("score")).alias("low"), F.col("id").isNull().alias("last"), F.col("id"), F.col("candidate"))
    ranked = ranked.groupBy(F.col("query").alias("of_query")).agg(F.sort_array(F.collect_list(entry)).alias("best"))
    asked = rows.where("asks").select(F.col("id").alias("query_id"), "key").join(ranked, F.col("key") == F.col("of_query"))
    # the place of the query's own row, if it is among the best
    own_place = F.expr(
        "array_position(transform(best, b -> b.candidate = key and b.id <=> query_id), true)"
    )
    others = F.expr("filter(best, (b, i) -> own = 0 or i <> own - 1)")
    listed = asked.withColumn("own", own_place).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "b"))
    return listed.select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), (-F.col("b.low")).alias("score")
    )
