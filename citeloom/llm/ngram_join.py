"""N-gram Jaccard join: banded MinHash of a fixed depth finds candidates, exact shingle sets verify them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import in_arrow, small
from citeloom.llm.components import components
from citeloom.llm.hashing import hash_words, shingle_hashes, words_of
from citeloom.session import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
# The forest: so many tries, each over so many MinHash values at most; two documents are candidates
# when the prefixes of their labels agree in any trie.
TREES = 64
DEEPEST = 16
# Part of the pairs of exactly the threshold's similarity that must become candidates.
TARGET = 0.999
# Documents verified together at most, on each side, and their shingles (a longer text is a side of its own).
BLOCK = 512
BLOCK_SHINGLES = 1_000_000
# Shingles signed at once, and shingles multiplied at once.
SIGNED = 100_000
COLUMNS = 4096
# Digests of the texts to verify set two bits each in a filter of this size.
FILTER_BITS = 24


def expected_recall(similarity: float, depth: int, trees: int) -> float:
    """Part of the pairs of a similarity whose labels share a prefix of ``depth`` in one of the tries."""
    return 1 - (1 - similarity**depth) ** trees


def matched_depth(threshold: float, trees: int = TREES, deepest: int = DEEPEST, target: float = TARGET) -> int:
    """From whole labels on, the prefix that must match is shortened until the least similar pairs
    that count are found with the target recall; more similar ones are found more surely."""
    depth = deepest
    while depth > 1 and expected_recall(threshold, depth, trees) < target:
        depth -= 1
    return depth


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted different shingle hashes of a text."""
    return np.unique(shingle_hashes(hash_words(words_of(text)), size))


def label_prefixes(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """For each shingle set and trie, a hash of the first ``depth`` MinHash values of its label."""
    numbers = np.random.default_rng(1).integers(0, 2**32, size=(2, trees * depth), dtype=np.uint32)
    flips, factors = numbers[0], numbers[1] | np.uint32(1)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), trees), dtype=np.uint64)
    held = np.empty_like(flat)
    for tree in range(trees):
        label = np.full(len(sets), tree + 1, dtype=np.uint64)
        for i in range(tree * depth, (tree + 1) * depth):
            np.bitwise_xor(flat, flips[i], out=held)
            np.multiply(held, factors[i], out=held)
            label = (label ^ np.minimum.reduceat(held, starts)) * np.uint64(0x9E3779B97F4A7C15)
            label ^= label >> np.uint64(29)
        out[:, tree] = label
    return out


def signed(docs: DataFrame, shingle: int, trees: int, depth: int) -> DataFrame:
    """Per row: id, digest, key (digest of its shingle set, null without words), size (of the set), prefixes (one per trie)."""

    def rows(batch: pa.RecordBatch, first: int, sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        keys: list[bytes | None] = [None] * len(sets)
        prefixes: list[list[int] | None] = [None] * len(sets)
        if full:
            for i, row in zip(full, label_prefixes([sets[i] for i in full], trees, depth).view(np.int64)):
                keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                prefixes[i] = row
        return pa.RecordBatch.from_arrays(
            [
                batch.column("id").slice(first, len(sets)),
                batch.column("digest").slice(first, len(sets)),
                pa.array(keys, pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())),
            ],
            names=["id", "digest", "key", "size", "prefixes"],
        )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            first, sets, room = 0, [], SIGNED
            for i, text in enumerate(batch.column("text").to_pylist()):
                sets.append(shingle_set(text, shingle))
                room -= len(sets[-1])
                if room < 0:
                    yield rows(batch, first, sets)
                    first, sets, room = i + 1, [], SIGNED
            if sets:
                yield rows(batch, first, sets)

    kind = docs.schema["id"].dataType.simpleString()
    return in_arrow(docs, sign, f"id {kind}, digest binary, key binary, size long, prefixes array<long>")


def candidates(entries: DataFrame) -> DataFrame:
    """Links u, v of texts that share a prefix: each with the smallest of its trie node.

    ``entries`` has number and prefix (the trie is part of its hash), also more than once. As many links as
    entries at most, and connected as all pairs would be.
    """
    entries = entries.repartition("prefix")  # one exchange for both readers
    nodes = entries.groupBy("prefix").agg(F.min("number").alias("v"), F.max("number").alias("last")).where("v < last").drop("last")
    return entries.join(nodes, "prefix").where("number <> v").select(F.col("number").alias("u"), "v").distinct()


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of some shingle sets are similar: a symmetric matrix, false on its diagonal."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    found, column = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), sizes)
    often = np.bincount(column, minlength=len(found)) > 1  # others are in no intersection
    place = np.cumsum(often) - 1
    owner, column = owner[often[column]], place[column[often[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), dtype=np.float32)
    total = int(often.sum())
    for begin in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        part = np.zeros((n, min(COLUMNS, total - begin)), dtype=np.float32)
        part[owner[a:b], column[a:b] - begin] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    similar = common >= threshold * union - 1e-6
    np.fill_diagonal(similar, False)
    return similar


def local_labels(similar: np.ndarray) -> np.ndarray:
    """The first member of each member's component."""
    n = len(similar)
    near = similar | np.eye(n, dtype=bool)
    labels = np.arange(n)
    while True:
        lower = np.where(near, labels[None, :], n).min(axis=1)
        lower = lower[lower]
        if (lower == labels).all():
            return labels
        labels = lower


def verified(members: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Exact links among candidates: number, links (how many in this group), label (smallest one reached).

    ``members`` has number, comp, i, j, block, text, one row per number and group. A group is one block, or
    two blocks of a large component of which only pairs across count.
    """

    def compare(table: pa.Table) -> pa.Table:
        numbers, block = table.column("number").to_numpy(), table.column("block").to_numpy()
        order = np.argsort(numbers)
        numbers, block = numbers[order], block[order]
        texts = table.column("text").to_pylist()
        similar = linked([shingle_set(texts[i], shingle) for i in order], threshold)
        if table.column("i")[0] != table.column("j")[0]:
            similar &= block[:, None] != block[None, :]
        links, labels = similar.sum(axis=1), local_labels(similar)
        some = np.flatnonzero(links)
        columns = [pa.array(numbers[some]), pa.array(links[some].astype(np.int64)), pa.array(numbers[labels[some]])]
        return pa.Table.from_arrays(columns, names=["number", "links", "label"])

    return members.groupBy("comp", "i", "j").applyInArrow(compare, "number long, links long, label long")


def stand_filter(stands: DataFrame) -> np.ndarray:
    """Bits of the digests of texts: at most 2 ** FILTER_BITS numbers reach the driver, whatever their number."""
    places = stands.select(F.explode(F.array(*filter_places("of_digest"))).alias("place")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[places.column("place").to_numpy()] = True
    return np.packbits(bits, bitorder="little")


def filter_places(digest: str) -> list[Column]:
    """The two places of a digest in the filter."""
    number = F.xxhash64(digest)
    least = F.lit((1 << FILTER_BITS) - 1)
    return [number.bitwiseAND(least), F.shiftrightunsigned(number, 64 - FILTER_BITS)]


def maybe_among(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """The rows whose digest passes the filter: all that are among its texts, and few others."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    @F.arrow_udf("boolean")
    def passes(one: pa.Array, two: pa.Array) -> pa.Array:
        table, one, two = shared.value, one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
        return pa.array(((table[one >> 3] >> (one & 7)) & (table[two >> 3] >> (two & 7)) & 1).astype(bool))

    return rows.where(passes(*filter_places("digest")))


def near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    target: float = TARGET,
) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class), n_links, n_copies.

    Two texts are linked when the Jaccard similarity of their sets of ``shingle`` words (runs of
    letters and digits, lower case; fewer words are one shingle) is ``threshold`` or more; classes
    are the connected components. ``n_links`` counts the linked texts, those with another shingle
    set, and ``n_copies`` the documents with this very set.

    Documents with one shingle set are first made one text, known by the digest of the set. It has
    ``trees`` MinHash labels (bands) of ``matched_depth`` values, a depth fixed by threshold and target; texts
    that share a label are candidates and are held together by links to the smallest of a trie node, never
    by all pairs. Each connected group of candidates is then verified exactly: in one task when it is small,
    else in blocks of ``BLOCK`` texts and ``BLOCK_SHINGLES`` shingles or so, each pair of blocks on its own, so
    no task holds more than two of them and no pair leaves a task, only counts and one label per text.

    Texts without words (null and empty ones too) are in a class of their own, without links; very
    long texts count whole. Before texts are shuffled to be verified, a filter of fixed size leaves out
    those of other digests. A document without an id shares the class of equal texts, and has a
    null class, without links, when none of them has an id. Rows that repeat an id and a text are one
    document wherever links are counted, and each gets its row; of an id with several texts each row has
    the class and the links of its text. An empty table gives an empty result; other columns are not looked at.
    """
    depth = matched_depth(threshold, trees, DEEPEST, target)
    text = F.col(text_col)
    digest = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest")
    rows = docs.select(F.col(id_col).alias("id"), digest, text.alias("text"))
    signs = cut_lineage(signed(rows, shingle, trees, depth))
    # the smallest id of a set, with the text that stands for it
    ranked = F.when(F.col("id").isNotNull(), F.struct("id", "digest"))
    sets = signs.where("key is not null").groupBy("key").agg(
        F.min(ranked).alias("stand"), F.count(F.lit(1)).alias("n_copies"), F.first("size").alias("size")
    )
    # numbered, and written with the numbers
    sets = sets.select("key", F.col("stand.id").alias("first"), F.col("stand.digest").alias("digest"), "n_copies", "size")
    sets = cut_lineage(sets.withColumn("number", F.monotonically_increasing_id()))
    stands = sets.where("first is not null").select("number", "first", F.col("digest").alias("of_digest"), F.col("size").alias("of_size"))
    at_stand = (F.col("id") == F.col("first")) & (F.col("digest") == F.col("of_digest"))
    entries = signs.where("key is not null").join(stands, at_stand).select("number", F.explode("prefixes").alias("prefix"))
    comps = components(candidates(entries)).select(F.col("node").alias("member"), F.col("label").alias("comp"))
    comps = cut_lineage(comps.join(stands, F.col("member") == F.col("number")).drop("member"))
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("of_size") / BLOCK_SHINGLES)).cast("int")
    sizes = comps.groupBy("comp").agg(blocks.alias("blocks"))
    placed = comps.join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("number"), "blocks").cast("int"))
    placed = cut_lineage(placed)
    # rows that repeat an id and a text become one; they are dealt out by these already
    # few texts are members; the others are left out before the shuffle, by their digest
    near = maybe_among(rows, stand_filter(placed))
    texts = near.join(placed, at_stand).groupBy("id", "digest", "number", "comp", "block", "blocks").agg(F.first("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    members = texts.select("number", "comp", "block", "text", other).select(
        "number", "comp", "block", "text", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )
    found = cut_lineage(verified(members, shingle, threshold))
    classes = components(found.select(F.col("number").alias("u"), F.col("label").alias("v")))
    classes = classes.select(F.col("node").alias("number"), F.col("label").alias("class"))
    smallest = classes.join(sets, "number").groupBy("class").agg(F.min("first").alias("class_id"))
    classes = classes.join(smallest, "class").select("number", "class_id")
    links = found.groupBy("number").agg(F.sum("links").alias("n_links"))
    known = sets.join(classes, "number", "left").join(links, "number", "left")
    known = known.select("key", F.coalesce("class_id", "first").alias("class_id"), "n_links", "n_copies")
    joined = signs.select("id", "key").join(known, "key", "left")
    alone = F.col("key").isNull()
    return joined.select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class of ``near_copies`` the document with the smallest id, all columns kept.

    A document without an id stays, as does one without words; rows that repeat an id stay or go
    together.
    """
    gone = near_copies(docs, id_col, text_col).where("doc_id <> class_id").select(F.col("doc_id").alias("gone_id"))
    gone = cut_lineage(gone)
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
