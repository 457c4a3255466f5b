"""Periodic runs of words: seeds on the diagonals of a text against itself, extended to maximal runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import in_arrow, small
from citeloom.llm.hashing import MIX, shingle_hashes

BLANK = r"[\x20\x09-\x0D]+"
# A run has so many words at least, and its period so many times.
LEAST = 24
TIMES = 3
# Words of neighbouring documents that are indexed together; a longer document is indexed on its own.
TOGETHER = 200_000
# Words compared at first when a seed is extended; the steps double.
STEP = 64

Run = tuple[int, int, int]


def least_overlap(least: int, times: int) -> int:
    """The fewest words that a run shares with itself moved by its period: the length of the first seeds."""
    return min(max(least, times * q) - q for q in range(1, least + 1))


def matched(left: np.ndarray, right: np.ndarray) -> int:
    """How many words two slices share from their beginning on; the shorter one ends it."""
    n, at, step = min(len(left), len(right)), 0, STEP
    while at < n:
        same = left[at : min(at + step, n)] == right[at : min(at + step, n)]
        if not same.all():
            return at + int(same.argmin())
        at, step = at + step, step * 2
    return n


def seeds(words: np.ndarray, owner: np.ndarray, end: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places, lags and gram length of pairs of consecutive occurrences of a gram in one document.

    A gram is at least as long as the lags that are taken from it, so within a run the next
    occurrence is one period on: no other pair is needed, and there are no more pairs than words.
    The first grams have ``size`` words and serve lags up to that; each further index doubles the
    length and serves lags above half of it, of which every run overlaps itself by more than a gram.
    Only grams that occur again stay in the next index.
    """
    n = len(words) - size + 1
    if n < 1:
        return
    salted = (words.astype(np.uint64) + np.uint64(1)) * MIX ^ (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    salted = (salted ^ salted >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    grams = shingle_hashes(salted ^ salted >> np.uint64(32), size)
    places, shortest = np.flatnonzero(np.arange(n) + size <= end[:n]), 0
    while len(places):
        order = np.argsort(grams[places], kind="stable")
        sorted_places, sorted_grams = places[order], grams[places[order]]
        again = sorted_grams[1:] == sorted_grams[:-1]
        first, lag = sorted_places[:-1][again], (sorted_places[1:] - sorted_places[:-1])[again]
        wanted = (lag > shortest) & (lag <= size)
        yield first[wanted], lag[wanted], size
        repeated = np.zeros(len(grams), dtype=bool)
        repeated[sorted_places[:-1][again]] = True
        repeated[sorted_places[1:][again]] = True
        places = places[repeated[places]]
        places = places[places + 2 * size <= end[places]]
        places = places[repeated[places + size]]
        longer = np.zeros_like(grams)
        mixed = (grams[places] ^ MIX) * MIX ^ grams[places + size]
        longer[places] = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
        grams, size, shortest = longer, 2 * size, size


def find_runs(words: np.ndarray, lengths: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """Runs (start, length, period) of each document by start, then period.

    ``words`` numbers the words of all documents, one after the other, of ``lengths`` words each.
    """
    ends = np.cumsum(lengths)
    begins = ends - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    found: list[list[Run]] = [[] for _ in lengths]
    for place, lag, size in seeds(words, owner, ends[owner], least_overlap(least, times)):
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # a seed right behind another one on its diagonal lies in the extension of that one
        head = np.ones(len(place), dtype=bool)
        head[1:] = (lag[1:] != lag[:-1]) | (place[1:] != place[:-1] + 1)
        covered: dict[int, int] = {}  # by lag: the end of the furthest extension
        for at, q in zip(place[head].tolist(), lag[head].tolist()):
            if at < covered.get(q, 0):
                continue
            begin, end = int(begins[owner[at]]), int(ends[owner[at]])
            right = at + matched(words[at : end - q], words[at + q : end])
            left = at - matched(words[begin:at][::-1], words[begin + q : at + q][::-1])
            covered[q] = right
            if right - left >= size and right - left + q >= max(least, times * q):
                found[owner[at]].append((left - begin, right - left + q, q))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def strongest(runs: list[Run]) -> Run | None:
    """The run that repeats its period most often; of equal ones the first, then the one of shortest period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay when of each run only its first period stays."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return change[:n].cumsum() == 0


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """One row per document: doc_id, n_words, runs, strongest, collapsed.

    Words are runs of characters other than ASCII white space, numbered from 0. ``runs`` lists the
    stretches (start, length, period) that repeat with a smallest period, have ``least`` words and
    ``times`` periods at least, and that no neighbouring word extends; by start, then period.
    ``strongest`` is the one with the greatest length / period (ties: smallest start, then period;
    null without a run). ``collapsed`` is the text's words, joined by one space, without those that
    a run holds after its first period.

    Documents are worked on where they are, without a shuffle. Within one, grams of the shortest
    length by which a run must overlap itself are indexed, then grams of twice that length and so
    on for longer periods; consecutive occurrences seed a diagonal (place, lag), are extended to
    both sides, and what an extension covers is not extended again. Work grows as the words times
    the logarithm of the longest repeat, whatever the text.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``; a very long text
    is indexed whole. Repeated rows get a row each, a null id stays null, an empty table gives an
    empty result, and other columns are not looked at. ``times`` below 3 is a ``ValueError``: longer
    grams would not be sure to lie in a run.
    """
    if times < 3 or least < 1:
        raise ValueError("a run has one word at least, and its period three times")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def searched(batch: pa.RecordBatch, first: int, texts: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        words = np.array([numbers.setdefault(w, len(numbers)) for text in texts for w in text], dtype=np.int64)
        lengths = np.array([len(text) for text in texts], dtype=np.int64)
        found = find_runs(words, lengths, least, times)
        rest = []
        for text, runs in zip(texts, found):
            if runs:
                text = [text[i] for i in np.flatnonzero(kept_words(len(text), runs))]
            rest.append(b" ".join(text))
        named = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
        best = [None if (r := strongest(runs)) is None else dict(zip(("start", "length", "period"), r)) for runs in found]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").slice(first, len(texts)),
                pa.array(lengths),
                pa.array(named, pa.list_(run)),
                pa.array(best, run),
                pa.array(rest, pa.binary()),
            ],
            names=["doc_id", "n_words", "runs", "strongest", "collapsed"],
        )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts, first, room = [], 0, TOGETHER
            for i, text in enumerate(batch.column("text").to_pylist()):
                texts.append((text or b"").split())  # of bytes: ASCII white space only
                room -= len(texts[-1])
                if room < 0:
                    yield searched(batch, first, texts)
                    texts, first, room = [], i + 1, TOGETHER
            if texts:
                yield searched(batch, first, texts)

    kind = docs.schema[id_col].dataType.simpleString()
    struct = "struct<start:bigint,length:bigint,period:bigint>"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    found = in_arrow(
        rows, search, f"doc_id {kind}, n_words bigint, runs array<{struct}>, strongest {struct}, collapsed binary"
    )
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def run_digests(found: DataFrame) -> DataFrame:
    """Figures and digests of ``periodic_runs``: doc_id, n_runs, start, length, period, exponent_milli,
    runs_sha256 (``start,length,period`` and a line feed for every run), collapsed_sha256."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents as (doc_id, text), one in ten by a hash of its id ending in a stretch that repeats.

    With h the crc32 of the id, g = h div 10 and n words: where 10 divides h and n is above 0, each
    word i from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8), and the
    words are joined by one space. Other texts, and texts of a null id, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    some = (h % 10 == 0) & F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    # words of the documents that change only; a null elsewhere
    words = F.when(some, F.filter(F.split(F.col(text_col), BLANK, -1), lambda w: w != ""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.floor(h / 10).alias("g"), words.alias("w"))
    rows = rows.withColumn("n", F.size("w").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    return rows.select("doc_id", F.coalesce(repeated(), F.col("text")).alias("text"))


def repeated() -> Column:
    """Of columns w, n, a and p: words up to a, then the p words from a on again and again, n words in all."""
    period = "slice(w, int(a + 1), int(p))"
    rest = f"slice(flatten(array_repeat({period}, int((n - a) div p) + 1)), 1, int(n - a))"
    return F.expr(f"array_join(concat(slice(w, 1, int(a)), {rest}), ' ')")
