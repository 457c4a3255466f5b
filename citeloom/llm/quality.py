"""Quality: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from citeloom.llm.common import in_arrow, learnable, small

FEATURES = (
    "upper",
    "letters",
    "digits",
    "marks",
    "symbols",
    "unique_words",
    "repeats",
    "word_length",
    "words",
    "short_words",
    "ends_in_mark",
    "bare_symbols",
    "seen_before",
    "title_words",
)
BUCKETS = 8
# Bounds of the sample a model is fitted on: labelled documents, and the lines of them all.
MAX_DOCS = 8000
MAX_LINES = 400_000
# Characters that are measured at once.
CHUNK = 250_000
STEPS = 120
RIDGE = 2.0
LEAST_SCORE = 0.3

_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SYMBOL = range(6)


# Marks of other scripts; full-width ones are known by their plain form.
_MARKS, _STOPS = ".,;:!?\u3001\u3002\u061f\u060c\u061b\u0964", ".!?\u3002\u061f\u0964"


def _kind(code: int) -> int:
    char = chr(code)
    if unicodedata.normalize("NFKC", char) in _MARKS and not char.isspace():
        return _MARK
    if char.isspace():
        return _SPACE
    category = unicodedata.category(char)
    if category == "Lu":
        return _UPPER
    if category[0] in "LM":
        return _LOWER
    return _DIGIT if category[0] == "N" else _SYMBOL


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The kind of every code point, and the marks that end a sentence."""
    kinds = np.array([_kind(code) for code in range(0x110000)], dtype=np.uint8)
    ends = [code for code in np.flatnonzero(kinds == _MARK).tolist() if unicodedata.normalize("NFKC", chr(code)) in _STOPS]
    return kinds, np.array(ends, dtype=np.uint32)


def lines_of(text: str | None) -> list[str]:
    """The lines that are not blank; a text without any is one empty line."""
    return [line for line in (text or "").split("\n") if line.strip()] or [""]


def line_features(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text: features in [0, 1] of its lines (lines x features), and the lines' lengths."""
    found: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    part: list[str | None] = []
    room = CHUNK
    for text in texts:
        part.append(text)
        room -= len(text or "")
        if room < 0:
            for made, more in zip(found, _measured(part)):
                made.extend(more)
            part, room = [], CHUNK
    if part:
        for made, more in zip(found, _measured(part)):
            made.extend(more)
    return found


def _measured(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """All lines of some texts at once, as arrays over characters, words and lines."""
    by_text = [lines_of(text) for text in texts]
    lines = [line for group in by_text for line in group]
    codes = np.frombuffer("".join(line + "\n" for line in lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    of_code, stops = _tables()
    kinds = of_code[codes]
    starts = np.cumsum([0] + [len(line) + 1 for line in lines[:-1]])
    count = np.stack([np.add.reduceat((kinds == k).astype(np.int64), starts) for k in range(6)], axis=1)
    letters = count[:, _UPPER] + count[:, _LOWER]
    solid = letters + count[:, _DIGIT] + count[:, _MARK] + count[:, _SYMBOL]
    n = len(lines)
    out = np.zeros((n, len(FEATURES)), dtype=np.float32)
    out[:, 0] = count[:, _UPPER] / np.maximum(letters, 1)
    out[:, 1] = letters / np.maximum(solid, 1)
    out[:, 2] = count[:, _DIGIT] / np.maximum(solid, 1)
    out[:, 4] = count[:, _SYMBOL] / np.maximum(solid, 1)

    # words: runs of characters that are no white space, each with a hash of its characters
    inside = kinds != _SPACE
    begins = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    sizes = np.flatnonzero(inside & np.concatenate([~inside[1:], [True]])) - begins + 1
    if len(begins):
        place = np.arange(len(codes)) - np.repeat(np.append(0, begins), np.diff(np.concatenate([[0], begins, [len(codes)]])))
        place = place.astype(np.uint64)
        mixed = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ place * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed[~inside] = 0
        words = np.add.reduceat(mixed ^ mixed >> np.uint64(32), begins)
        line = np.searchsorted(starts, begins, side="right") - 1
        per_line = np.bincount(line, minlength=n)
        most = np.maximum(per_line, 1)

        def part(chosen: np.ndarray) -> np.ndarray:
            return np.bincount(line[chosen], minlength=n) / most

        again = np.concatenate([[False], (words[1:] == words[:-1]) & (line[1:] == line[:-1])])
        order = np.lexsort((words, line))
        new = np.concatenate([[True], (np.diff(words[order]) != 0) | (np.diff(line[order]) != 0)])
        ends = begins + sizes - 1
        last = np.concatenate([line[1:] != line[:-1], [True]])
        out[:, 3] = count[:, _MARK] / most / 4
        out[:, 5] = np.bincount(line[order][new], minlength=n) / most
        out[:, 6] = part(again)
        out[:, 7] = solid / most / 24
        out[:, 8] = np.log1p(per_line) / 10
        out[:, 9] = part(sizes <= 3)
        out[:, 10] = part(last & np.isin(codes[ends], stops)) * most
        out[:, 11] = part((sizes == 1) & (kinds[begins] >= _MARK))
        out[:, 13] = part(kinds[begins] == _UPPER)
    at = 0
    for group in by_text:
        seen: set[str] = set()
        for i, text in enumerate(group, at):
            out[i, 12] = text in seen
            seen.add(text)
        at += len(group)
    cuts = np.cumsum([len(group) for group in by_text])[:-1]
    return np.split(np.minimum(out, 1.0), cuts), np.split(solid, cuts)


@dataclass
class LineModel:
    """Weights of the field: bucket bounds, a weight per bucket of the line and its neighbours, moves."""

    edges: np.ndarray  # features x (BUCKETS - 1)
    weights: np.ndarray  # of "good" against "bad"
    moves: np.ndarray  # 2 x 2, from and to bad, good

    def scores(self, features: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of "good" of each line of each document."""
        batch = Batch(features, self.edges)
        return batch.by_document(batch.marginals(self.weights, self.moves)[0])


class Batch:
    """Lines of many documents, first lines first, so a step of the chain is one vector operation."""

    def __init__(self, features: list[np.ndarray], edges: np.ndarray):
        self.sizes = np.array([len(x) for x in features], dtype=np.int64)
        self.order = np.argsort(-self.sizes, kind="stable")
        longest = int(self.sizes.max(initial=0))
        # documents that still have a line at each step
        self.active = [int(n) for n in np.searchsorted(-self.sizes[self.order], -np.arange(longest), side="left")]
        self.starts = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        n, f = int(self.sizes.sum()), len(FEATURES)
        rows = np.concatenate(features) if n else np.zeros((0, f), dtype=np.float32)
        own = np.stack([np.searchsorted(edges[j], rows[:, j], side="right") for j in range(f)], axis=1)
        own = own + np.arange(f) * (BUCKETS + 1)
        # a missing neighbour has a bucket of its own for each feature
        missing = np.arange(f) * (BUCKETS + 1) + BUCKETS
        before, after = np.vstack([missing, own[:-1]]), np.vstack([own[1:], missing])
        before, after = before[:n], after[-n:] if n else after[:0]
        before[first[self.sizes > 0]] = missing
        after[(first + self.sizes - 1)[self.sizes > 0]] = missing
        block = f * (BUCKETS + 1)
        # the line at step t of the k-th longest document
        self.where = np.concatenate(
            [first[self.order[:k]] + t for t, k in enumerate(self.active)] or [np.zeros(0, dtype=np.int64)]
        )
        self.index = np.hstack([own, before + block, after + 2 * block])[self.where]

    def marginals(self, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward: probability of "good" per line, and expected moves summed over all."""
        n = len(self.index)
        own = np.zeros((n, 2))
        own[:, 1] = weights[self.index].sum(axis=1)
        forward, backward = own.copy(), np.zeros((n, 2))
        steps = len(self.active)
        for t in range(1, steps):
            k, here, last = self.active[t], self.starts[t], self.starts[t - 1]
            into = forward[last : last + k, :, None] + moves
            forward[here : here + k] += np.logaddexp(into[:, 0], into[:, 1])
        for t in range(steps - 2, -1, -1):
            k, here, following = self.active[t + 1], self.starts[t], self.starts[t + 1]
            out = moves + (own + backward)[following : following + k, None, :]
            backward[here : here + k] = np.logaddexp(out[:, :, 0], out[:, :, 1])
        both = forward + backward
        good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        expected = np.zeros((2, 2))
        for t in range(1, steps):
            k, here, last = self.active[t], self.starts[t], self.starts[t - 1]
            pair = forward[last : last + k, :, None] + moves + (own + backward)[here : here + k, None, :]
            total = np.logaddexp.reduce(both[here : here + k], axis=1)
            expected += np.exp(pair - total[:, None, None]).sum(axis=0)
        return good, expected

    def by_document(self, values: np.ndarray) -> list[np.ndarray]:
        placed = np.empty(len(values))
        placed[self.where] = values
        return np.split(placed, np.cumsum(self.sizes)[:-1]) if len(self.sizes) else []


def fit(features: list[np.ndarray], good: list[int], steps: int = STEPS, ridge: float = RIDGE) -> LineModel:
    """Maximum likelihood with a ridge: every line of a document carries the document's label.

    Adam over the whole sample; the sample is bounded, so this runs on the driver.
    """
    f = len(FEATURES)
    rows = np.concatenate(features) if features else np.zeros((1, f), dtype=np.float32)
    edges = np.quantile(rows, np.arange(1, BUCKETS) / BUCKETS, axis=0).T.copy()
    size = 3 * f * (BUCKETS + 1)
    params, moves = np.zeros(size), np.zeros((2, 2))
    if not features:
        return LineModel(edges, params, moves)
    batch = Batch(features, edges)
    labels = np.repeat(np.asarray(good), batch.sizes)[batch.where]
    observed = np.zeros((2, 2))
    for label, n in zip(good, batch.sizes):
        observed[label, label] += n - 1
    flat = np.concatenate([params, moves.ravel()])
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    docs = len(features)
    for step in range(1, steps + 1):
        marginal, expected = batch.marginals(flat[:size], flat[size:].reshape(2, 2))
        slope = np.bincount(batch.index.ravel(), np.repeat(marginal - labels, 3 * f), minlength=size)
        slope = np.concatenate([slope, (expected - observed).ravel()]) + ridge * flat
        slope /= docs
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        flat = flat - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return LineModel(edges, flat[:size], flat[size:].reshape(2, 2))


def fit_quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_DOCS, lines: int = MAX_LINES) -> LineModel:
    """A model of ``labels.quality``, fitted on at most ``limit`` labelled documents not held out.

    Documents are taken whole, in the order of a hash of their id, as long as they have ``lines`` lines
    together at most: both bounds hold for what reaches the driver. Labels that repeat an id count as
    often as they stand there, as do documents that repeat one.
    """
    rows = docs.select("doc_id", "text").join(
        F.broadcast(learnable(labels, limit, "quality")), F.col("doc_id") == F.col("labelled")  # at most ``limit`` rows
    )
    # one row for each labelled document: a window of at most ``limit`` rows, a few numbers each
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("\n")) + 1
    sizes = rows.groupBy("doc_id").agg(F.sum(size).alias("size"))
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    taken = sizes.withColumn("so_far", F.sum("size").over(so_far)).where(F.col("so_far") <= lines).select(F.col("doc_id").alias("taken"))
    rows = rows.join(F.broadcast(taken), F.col("doc_id") == F.col("taken"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = line_features(batch.column("text").to_pylist())[0]
            places = pa.array(np.cumsum([0] + [x.size for x in found]).astype(np.int32))
            flat = pa.array(np.concatenate([x.ravel() for x in found]) if found else np.zeros(0, dtype=np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.ListArray.from_arrays(places, flat)], names=["label", "features"]
            )

    made = in_arrow(rows.select("label", "text"), measured, "label int, features array<float>").toArrow()
    features: list[np.ndarray] = []
    for chunk in made.column("features").chunks:
        values, places = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        features += [values[a:b].reshape(-1, len(FEATURES)) for a, b in zip(places[:-1], places[1:])]
    return fit(features, made.column("label").to_pylist())


def quality_scores(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1, mean over its lines by length), n_lines, good_lines.

    Null, empty and blank texts are one empty line, which the model scores like any other; very long
    texts are scored whole, line by line. Repeated rows get a row each, an empty table gives an
    empty result, and only the two named columns are read.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, sizes = line_features(batch.column("text").to_pylist())
            marginals = model.scores(found)
            score = [float(np.average(p, weights=n + 1)) for p, n in zip(marginals, sizes)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(score, pa.float64()),
                    pa.array([len(p) for p in marginals], pa.int64()),
                    pa.array([int((p >= 0.5).sum()) for p in marginals], pa.int64()),
                ],
                names=["doc_id", "score", "n_lines", "good_lines"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_arrow(rows, scored, f"doc_id {kind}, score double, n_lines long, good_lines long")


def is_kept(score: Column) -> Column:
    return score >= LEAST_SCORE


def drop_poor(docs: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose score is ``LEAST_SCORE`` or more, all columns kept; cases as in ``quality_scores``.

    Each row is judged by its own text where it is: no join, so ids need not be there or differ.
    """
    names = docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found, sizes = line_features(batch.column(names.index(text_col)).to_pylist())
            score = [np.average(p, weights=n + 1) for p, n in zip(model.scores(found), sizes)]
            yield batch.filter(pa.array([bool(s >= LEAST_SCORE) for s in score], pa.bool_()))

    return in_arrow(docs, kept, docs.schema)
