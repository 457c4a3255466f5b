"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.common import in_arrow, small
from citeloom.session import cut_lineage

# N-grams of one to three characters, the most frequent of which make a profile.
LONGEST = 3
PROFILE = 300
UNKNOWN = "und"
# Memory of a task that counts: codes sorted at once, and different n-grams of a language held.
SORTED_AT_ONCE = 2_000_000
MOST_HELD = 2_000_000
# Codes of n-grams: 21 bits a character.
_BITS = np.uint64(21)
_SPACE = 0x20


def _letters(limit: int = 0x110000) -> np.ndarray:
    """Lower-case code of each letter, the space of everything else, over all planes."""
    out = np.full(limit, _SPACE, dtype=np.uint32)
    for code in range(limit):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


_LETTERS = _letters()


def gram_codes(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text: words of letters, lower case, one space around each word."""
    codes = np.frombuffer((" " + (text or "") + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = _LETTERS[codes]
    low = low[(low != _SPACE) | np.concatenate([[True], low[:-1] != _SPACE])].astype(np.uint64)
    if len(low) < 3:
        return np.zeros(0, dtype=np.uint64)
    if low[-1] != _SPACE:
        low = np.append(low, np.uint64(_SPACE))
    two = (low[:-1] << _BITS) | low[1:]
    three = (two[:-1] << _BITS) | low[2:]
    inner = low[1:-1] != _SPACE
    # a space stands at the edge of an n-gram only, and not alone
    return np.concatenate([low[low != _SPACE], two, three[inner]])


def ranked(codes: np.ndarray) -> np.ndarray:
    """The most frequent codes in order of rank; equally frequent ones by code."""
    found, counts = np.unique(codes, return_counts=True)
    if len(found) > PROFILE:
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.lexsort((found, -counts))][:PROFILE]


class Tally:
    """Counts of n-grams, in arrays; new ones wait until there are enough to sort at once."""

    def __init__(self) -> None:
        self.grams, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        self.waiting.append(codes)
        self.size += len(codes)
        if self.size > SORTED_AT_ONCE:
            self.settle()

    def settle(self) -> None:
        if self.size:
            new, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            both = np.concatenate([self.grams, new])
            self.grams, at = np.unique(both, return_inverse=True)
            self.counts = np.bincount(at, np.concatenate([self.counts, counts])).astype(np.int64)
        self.waiting, self.size = [], 0

    def rows(self, lang: str) -> pa.RecordBatch:
        self.settle()
        columns = [pa.array([lang] * len(self.grams), pa.string()), pa.array(self.grams.astype(np.int64))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(self.counts)], names=["lang", "gram", "n"])


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The profile of each language: lang, gram, rank (from 0), counted over all the documents given.

    Counts are summed per task before they are shuffled. Documents without a language or a text
    teach nothing.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for batch in small(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                tally = tallies.setdefault(lang, Tally())
                tally.add(gram_codes(text))
                if len(tally.grams) > MOST_HELD:
                    yield tallies.pop(lang).rows(lang)
        for lang, tally in tallies.items():
            yield tally.rows(lang)

    known = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = in_arrow(known, counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # the bare row number, which Spark takes as a limit per language before the shuffle
    first = counts.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= PROFILE)
    return first.withColumn("rank", F.col("rank") - 1).drop("n")


def out_of_place(grams: np.ndarray, known: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Distance of a document's ranking to each profile, as a part of the largest possible.

    ``known`` are the sorted codes of all profiles, ``ranks`` (codes x languages) their ranks, and
    ``PROFILE`` where a profile lacks the code.
    """
    at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
    found = np.where((known[at] == grams)[:, None], ranks[at], PROFILE)
    away = np.where(found < PROFILE, np.abs(found - np.arange(len(grams))[:, None]), PROFILE)
    return away.sum(axis=0) / (PROFILE * len(grams))


def predict_languages(
    docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (0 to 1), distance.

    ``learned`` is the result of ``profiles``: ``PROFILE`` rows a language, so it is as large as the
    number of languages allows, and each task gets a copy of it. The nearest profile wins, of equally
    near ones the first by name; ``score`` is the part of the runner-up's and the winner's distance
    that is the runner-up's, scaled to 0..1 (1 when there is no other language).

    A null text, or one without a letter, is ``und`` with score 0, as is every text when nothing was
    learned. Very long texts count whole. Repeated rows get a row each, an empty table gives an
    empty result; only the two named columns are read.
    """
    rows = sorted((r.lang, r.gram, r.rank) for r in learned.collect())
    langs = sorted({lang for lang, _, _ in rows})
    known = np.unique(np.array([gram for _, gram, _ in rows], dtype=np.uint64))
    ranks = np.full((len(known), len(langs)), PROFILE, dtype=np.int64)
    for lang, gram, rank in rows:
        ranks[np.searchsorted(known, np.uint64(gram)), langs.index(lang)] = rank

    def judged(text: str | None) -> tuple[str, float, float]:
        grams = ranked(gram_codes(text))
        if not len(grams) or not langs:
            return UNKNOWN, 0.0, 1.0
        away = out_of_place(grams, known, ranks)
        best = int(np.argmin(away))
        others = np.delete(away, best)
        if not len(others):
            return langs[best], 1.0, float(away[best])
        total = away[best] + others.min()
        return langs[best], float((others.min() - away[best]) / total) if total else 0.0, float(away[best])

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [judged(text) for text in batch.column("text").to_pylist()]
            columns = zip(*found) if found else ((), (), ())
            kinds = (pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(list(x), kind) for x, kind in zip(columns, kinds)]],
                names=["doc_id", "lang_pred", "score", "distance"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_arrow(only, predicted, f"doc_id {kind}, lang_pred string, score double, distance double")


def learn_profiles(docs: DataFrame) -> DataFrame:
    """``profiles``, written as a small table."""
    return cut_lineage(profiles(docs))
