"""Benchmark decontamination by spaced seeds: masks over word positions, verified overlaps."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import in_arrow, small
from citeloom.llm.hashing import hash_words, words_of
from citeloom.session import cut_lineage

# An overlap: a stretch of so many words along one alignment (or the whole item, if that is shorter),
# this part of them equal.
STRETCH = 13
EQUAL = 0.8
# Masks over the words of a stretch: 1 counts, 0 is ignored. Each slides along the stretch from its first
# to its last 1; whichever two words of a stretch differ, one of the masks ignores them at some place.
MASKS = ("1110111100000", "0011010010111", "0001101110011")
SPAN = len(MASKS[0])
# Test items with fewer words than this are looked for only when asked.
SHORTEST = 5
# What goes along with a hit: its window and a stretch less one word on both sides.
SIDE = STRETCH - 1
WIDTH = SPAN + 2 * SIDE
# Hashes of test items set two bits each in a filter of this size.
FILTER_BITS = 24
# Characters that are hashed at once.
CHUNK = 250_000

HIT = "seed long, words array<int>"


@lru_cache(maxsize=None)
def masks_of(length: int) -> tuple[str, ...]:
    """The masks for items of so many words; they begin and end with a word that counts.

    An item shorter than a stretch has masks of its own, of which one hits wherever as many of its
    words differ as ``EQUAL`` allows: the mask that meets most of the cases left is added till none is.
    """
    if length >= STRETCH:
        return tuple(mask.strip("0") for mask in MASKS)
    weight = min(length, max(4, length // 2 + 1))
    left = set(combinations(range(length), length - int(np.ceil(EQUAL * length))))
    met = {}
    for ones in combinations(range(length), weight):
        if ones[0] == 0:
            places = [{at + i for i in ones} for at in range(length - ones[-1])]
            mask = "".join("1" if i in ones else "0" for i in range(ones[-1] + 1))
            met[mask] = {case for case in left if any(place.isdisjoint(case) for place in places)}
    out = []
    while left:
        out.append(max(sorted(met), key=lambda mask: len(met[mask] & left)))
        left -= met[out[-1]]
    return tuple(out)


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the words a mask selects, for every window."""
    n = max(len(hashes) - len(mask) + 1, 0)
    out = np.full(n, len(mask), dtype=np.uint64)
    for j, counts in enumerate(mask):
        if counts == "1":
            out = (out ^ hashes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    # equal words under two masks are no hit
    return out * np.uint64(2 * int(mask, 2) + 1)


def bits_of(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a hash in the filter."""
    least = np.uint64((1 << FILTER_BITS) - 1)
    return (found & least).astype(np.int64), (found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def windows(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The words around each hit, 32 bits each; 0 stands for no word."""
    padded = np.concatenate([np.zeros(SIDE), hashes >> np.uint64(32), np.zeros(SPAN + SIDE)]).astype(np.uint32)
    return padded[at[:, None] + np.arange(WIDTH)].view(np.int32)


def as_lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(values).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * WIDTH), flat)


def item_seeds(benchmark: DataFrame, id_col: str, text_col: str, shortest: int = SHORTEST) -> tuple[DataFrame, DataFrame]:
    """Seeds of the test items, and the items they come from.

    The first table has window, seed, item_words and stretch: items alike around a seed share a window, so it
    is verified once. The second has window and item_id, a row for each of these items.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            for item, text in zip(batch.column("item_id"), batch.column("text").to_pylist()):
                hashes = hash_words(words_of(text))
                if len(hashes) < max(shortest, 1):
                    continue
                for mask in masks_of(len(hashes)):
                    found = seeds(hashes, mask)
                    n = len(found)
                    columns = [
                        pa.array(found.view(np.int64)),
                        as_lists(windows(hashes, np.arange(n))),
                        pa.array(np.full(n, len(hashes), dtype=np.int32)),
                        pa.array([item.as_py()] * n, item.type),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["seed", "words", "length", "item_id"])

    kind = benchmark.schema[id_col].dataType.simpleString()
    rows = benchmark.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    made_rows = in_arrow(rows, made, f"{HIT}, length int, item_id {kind}")
    length = F.least("length", F.lit(STRETCH)).alias("stretch")
    alike = ["seed", "item_words", "stretch"]
    own = cut_lineage(made_rows.select("seed", F.col("words").alias("item_words"), length, "item_id").distinct())
    # written with their numbers
    found = cut_lineage(own.select(*alike).distinct().withColumn("window", F.monotonically_increasing_id()))
    return found, own.join(found, alike).select("window", "item_id")


def seed_filter(items: DataFrame) -> np.ndarray:
    """Bits of all seeds: at most 2 ** FILTER_BITS numbers reach the driver, whatever the number of items."""
    low = F.expr(f"seed & {(1 << FILTER_BITS) - 1}")
    high = F.expr(f"shiftrightunsigned(seed, {64 - FILTER_BITS})")
    places = items.select(F.explode(F.array(low, high)).alias("place")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[places.column("place").to_numpy()] = True
    return np.packbits(bits, bitorder="little")


def document_hits(docs: DataFrame, masks: list[str], bits: np.ndarray) -> DataFrame:
    """Windows of documents whose seed passes the filter: doc_id, key, start, seed, words."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # of fixed size

    def found(batch: pa.RecordBatch, texts: list[str | None], first: int) -> Iterator[pa.RecordBatch]:
        words, owner, begin = [], [], []
        for i, text in enumerate(texts):
            own = words_of(text)
            begin.append(len(words))
            words += own + [""] * (SPAN + SIDE)  # no window reaches into the next document
            owner.append(len(own) + SPAN + SIDE)
        hashes = hash_words(words)
        owner, begin = np.repeat(np.arange(len(texts)), owner), np.array(begin)
        table = shared.value
        for mask in masks:
            seed = seeds(hashes, mask)
            one, two = bits_of(seed)
            one = np.flatnonzero(table[one >> 3] >> (one & 7).astype(np.uint8) & 1)
            two = two[one]
            at = one[(table[two >> 3] >> (two & 7).astype(np.uint8) & 1).astype(bool)]
            at = at[hashes[at] != 0]
            if len(at):
                rows = pa.array(owner[at] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows),
                        batch.column("key").take(rows),
                        pa.array((at - begin[owner[at]]).astype(np.int32)),
                        pa.array(seed[at].view(np.int64)),
                        as_lists(windows(hashes, at)),
                    ],
                    names=["doc_id", "key", "start", "seed", "words"],
                )

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts, first, room = [], 0, CHUNK
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append(text)
                room -= len(text or "")
                if room < 0:
                    yield from found(batch, texts, first)
                    texts, first, room = [], i + 1, CHUNK
            if texts:
                yield from found(batch, texts, first)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs, scanned, f"doc_id {kind}, key string, start int, {HIT}")


def verified(hits: DataFrame) -> DataFrame:
    """Hits whose words agree along the alignment: adds ``equal``, the most equal words of a stretch."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            ours, theirs = (batch.column(c).flatten().to_numpy().reshape(n, WIDTH) for c in ("words", "item_words"))
            sums = np.concatenate([np.zeros((n, 1), dtype=int), ((ours == theirs) & (ours != 0)).cumsum(axis=1)], axis=1)
            stretch, equal = batch.column("stretch").to_numpy(), np.zeros(n, dtype=np.int32)
            for size in np.unique(stretch):
                own = stretch == size
                equal[own] = (sums[own, size:] - sums[own, : WIDTH + 1 - size]).max(axis=1)
            keep = pa.array(equal >= np.ceil(EQUAL * stretch))
            names = ["doc_id", "key", "window", "start", "stretch"]
            columns = [batch.column(c).filter(keep) for c in names] + [pa.array(equal).filter(keep)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "equal"])

    kinds = {f.name: f.dataType.simpleString() for f in hits.schema}
    schema = f"doc_id {kinds['doc_id']}, key string, window long, start int, stretch int, equal int"
    return in_arrow(hits.select("doc_id", "key", "window", "start", "stretch", "words", "item_words"), compared, schema)


def held_windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Verified hits of documents (doc_id, key, text): doc_id, key, window, start, stretch, equal."""
    # at most STRETCH different ones
    lengths = [r[0] for r in items.select("stretch").distinct().collect()]
    masks = sorted({mask for n in lengths for mask in masks_of(n)})
    return verified(document_hits(rows, masks, seed_filter(items)).join(items, "seed"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    key = F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("key")
    return docs.select(F.col(id_col).alias("doc_id"), key, text.alias("text"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shortest: int = SHORTEST,
) -> DataFrame:
    """Documents that hold passages of test items: doc_id, key, item_id, start, equal, stretch, n_hits.

    Words are runs of letters and digits, lower case. A stretch of ``STRETCH`` words (the whole item,
    if shorter) counts when ``EQUAL`` of its words agree along one alignment, so substituted words
    do not hide a passage; the masks find every such stretch, items of under five words whole.
    Seeds of documents pass a filter of fixed size, then meet those of the items in an equi-join
    that Spark may broadcast or split; each hit carries the words around it, so it is verified where
    it is. ``start`` is the first word of the first hit, ``key`` the md5 of the text.

    Null and empty texts hold nothing; very long texts are hashed whole, in pieces. Items of fewer than
    ``shortest`` words are not looked for. Of items with the same words around a seed each is named: hits are
    counted by window first, and only those counts meet the items of the window. Repeated rows come out once, an
    empty table on either side gives an empty result, and other columns are not looked at.
    """
    items, owners = item_seeds(benchmark, item_col, item_text_col, shortest)
    found = held_windows(keyed(docs, id_col, text_col), items).groupBy("doc_id", "key", "window").agg(
        F.min("start").alias("start"),
        F.max("equal").alias("equal"),
        F.max("stretch").alias("stretch"),
        F.count(F.lit(1)).alias("n_hits"),
    )
    return (
        found.join(owners, "window")
        .groupBy("doc_id", "key", "item_id")
        .agg(
            F.min("start").alias("start"),
            F.max("equal").alias("equal"),
            F.max("stretch").alias("stretch"),
            F.sum("n_hits").alias("n_hits"),
        )
    )


def without_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST
) -> DataFrame:
    """The documents that hold no passage of a test item, all columns kept; cases as in ``overlaps``."""
    items, _ = item_seeds(benchmark, "item_id", "text", shortest)
    found = cut_lineage(held_windows(keyed(docs, id_col, text_col), items).select("key").distinct())
    rows = docs.select(F.struct("*").alias("row"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("key"))
    return rows.join(found, "key", "left_anti").select("row.*")
