"""Toxicity: cumulative-link regression on sparse word features, expected severity."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import in_arrow, learnable, small
from citeloom.session import cut_lineage

WORD = re.compile(r"\w+")
# Beginnings of words that are features beside the whole word.
STEMS = range(4, 8)
# Grades: 0 is not toxic, and toxic documents fall into three by the share of their words that are telling.
GRADES = 4
# Bound of the sample of labelled documents; features are what its labels bear out, for or against.
MAX_DOCS = 20_000
LEAST_Z = 2.5
STEPS = 300
RIDGE = 1.0
# From this probability of any grade above 0 a text counts as toxic: about 0.95 of those were on held-out labels.
TOXIC_FROM = 0.25


def word_counts(text: str | None) -> Counter[str]:
    return Counter(WORD.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in STEMS if n < len(word))]


class Sparse:
    """Rows of few numbers other than 0: their places and values, one row after the other."""

    def __init__(self, sizes: np.ndarray, places: np.ndarray, values: np.ndarray, width: int):
        self.row = np.repeat(np.arange(len(sizes)), sizes)
        self.places, self.values, self.shape = places, values, (len(sizes), width)

    @classmethod
    def of(cls, rows: np.ndarray) -> Sparse:
        full = rows != 0
        return cls(full.sum(axis=1), np.nonzero(full)[1], rows[full], rows.shape[1])

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Each row's sum of its values times the weights of their places."""
        return np.bincount(self.row, self.values * weights[self.places], self.shape[0])

    def summed(self, by_row: np.ndarray) -> np.ndarray:
        """Each place's sum of its values times their rows' numbers."""
        return np.bincount(self.places, self.values * by_row[self.row], self.shape[1])


@dataclass
class SeverityModel:
    """Features with one weight each, shared by all grades, and an ordered threshold between grades."""

    places: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def features(self, text: str | None) -> dict[int, float]:
        """Places and values of the features a text has."""
        counts: Counter[int] = Counter()
        for word, n in word_counts(text).items():
            for feature in features_of(word):
                if (place := self.places.get(feature)) is not None:
                    counts[place] += n
        return {place: float(np.log1p(n)) for place, n in counts.items()}

    def share(self, text: str | None) -> float:
        """The part of a text's words that have a feature."""
        counts = word_counts(text)
        telling = sum(n for word, n in counts.items() if any(f in self.places for f in features_of(word)))
        return telling / max(1, counts.total())

    def rows(self, texts: list[str | None]) -> Sparse:
        found = [self.features(text) for text in texts]
        places = np.array([p for row in found for p in row], dtype=np.int64)
        values = np.array([v for row in found for v in row.values()], dtype=np.float64)
        return Sparse(np.array([len(row) for row in found], dtype=np.int64), places, values, len(self.places))

    def grades(self, texts: list[str | None]) -> np.ndarray:
        """Probability of each grade for each text."""
        return grade_probabilities(self.rows(texts).times(self.weights), self.thresholds)


def grade_probabilities(pull: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade <= k) is the logistic function of threshold k less the pull of the features."""
    below = 1 / (1 + np.exp(np.clip(pull[:, None] - thresholds, -500, 500)))
    edges = np.hstack([np.zeros((len(pull), 1)), below, np.ones((len(pull), 1))])
    return np.maximum(np.diff(edges, axis=1), 1e-12)


def fit_ordinal(
    rows: Sparse, grades: np.ndarray, n_grades: int = GRADES, steps: int = STEPS, ridge: float = RIDGE
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of greatest likelihood with a ridge on the weights.

    The thresholds are the first one and the logarithms of the gaps between them, so they stay in
    order. Adam over the whole sample; the sample is bounded, so this runs on the driver.
    """
    n, width = rows.shape
    share = [np.clip((grades <= k).mean() if n else 0.5, 0.01, 0.99) for k in range(n_grades - 1)]
    start = np.log(np.array(share) / (1 - np.array(share)))
    gaps = np.log(np.maximum(np.diff(start), 0.05))
    flat = np.concatenate([np.zeros(width), start[:1], gaps])
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1 if n else 1):
        thresholds = flat[width] + np.concatenate([[0], np.cumsum(np.exp(flat[width + 1 :]))])
        padded = np.concatenate([[-np.inf], thresholds, [np.inf]])
        pull = rows.times(flat[:width])
        with np.errstate(over="ignore"):
            upper, lower = (1 / (1 + np.exp(pull - padded[grades + d])) for d in (1, 0))
        inside = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / inside, lower * (1 - lower) / inside
        by_threshold = np.zeros(n_grades + 1)
        np.add.at(by_threshold, grades + 1, -d_upper)
        np.add.at(by_threshold, grades, d_lower)
        by_threshold = by_threshold[1:-1]
        by_gap = np.exp(flat[width + 1 :]) * np.cumsum(by_threshold[::-1])[::-1][1:]
        slope = np.concatenate([rows.summed(d_upper - d_lower) + ridge * flat[:width], [by_threshold.sum()], by_gap]) / n
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (steps + 1))
        flat = flat - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return flat[:width], flat[width] + np.concatenate([[0], np.cumsum(np.exp(flat[width + 1 :]))])


def telling_features(docs: DataFrame) -> DataFrame:
    """Features by how much more documents with label 1 hold them: word, z, clean, toxic, held; columns in: label, text.

    ``z`` is the difference of the log odds over its standard error, from numbers of documents; ``held`` is a
    digest of the documents that hold the feature.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            numbers: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
            held: dict[str, int] = {}
            for label, text, digest in zip(*(batch.column(c).to_pylist() for c in ("label", "text", "digest"))):
                found = {feature for word in word_counts(text) for feature in features_of(word)}
                found.add("")  # documents
                numbers[label].update(found)
                for feature in found:
                    held[feature] = held.get(feature, 0) ^ digest
            columns = [pa.array(list(held), pa.string()), *[pa.array([n[w] for w in held], pa.int64()) for n in numbers]]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(list(held.values()), pa.int64())], names=["word", "clean", "toxic", "held"]
            )

    rows = docs.select("label", "text", F.xxhash64("text").alias("digest"))
    counts = in_arrow(rows, counted, "word string, clean long, toxic long, held long").groupBy("word")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.bit_xor("held").alias("held"))
    totals = counts.where("word = ''").first()
    if totals is None:
        return counts.withColumn("z", F.lit(0.0)).limit(0)
    without = [F.lit(totals[c]) - F.col(c) + 0.5 for c in ("clean", "toxic")]
    inside = [F.col(c) + 0.5 for c in ("clean", "toxic")]
    odds = F.log(inside[1] / without[1]) - F.log(inside[0] / without[0])
    error = F.sqrt(1 / inside[0] + 1 / inside[1] + 1 / without[0] + 1 / without[1])
    return counts.where("word <> ''").withColumn("z", odds / error)


def fit_severity(docs: DataFrame, labels: DataFrame, limit: int = MAX_DOCS) -> SeverityModel:
    """A model of severity, fitted on at most ``limit`` labelled documents that are not held out.

    Labels say toxic or not. The features are all words and beginnings of words that tell the two apart, for
    one side or the other; their number follows from the sample, and rows hold the few that a text has. Toxic documents
    are graded 1 to 3 by thirds of the share of their words that have a feature: labels know no grades, so
    severity means how much of a text is telling. Of equal texts one counts, as toxic if any of its labels is, and so
    do labels that repeat an id. Without labels every document is as likely toxic as not.
    """
    sample = docs.select("doc_id", "text").join(
        F.broadcast(learnable(labels, limit, "toxic")),  # at most ``limit`` rows
        F.col("doc_id") == F.col("labelled"),
    )
    sample = cut_lineage(sample.where("text is not null").groupBy("text").agg(F.max("label").alias("label")))
    told = telling_features(sample).where(F.abs("z") >= LEAST_Z)
    # of beginnings and words that the same documents hold, the longest
    told = told.withColumn("stem", F.substring("word", 1, min(STEMS))).groupBy("stem", "clean", "toxic", "held")
    told = told.agg(F.max_by("word", F.struct(F.length("word"), "word")).alias("word"))
    words = sorted(r.word for r in told.select("word").collect())
    model = SeverityModel({word: i for i, word in enumerate(words)}, np.zeros(0), np.zeros(GRADES - 1))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = batch.column("text").to_pylist()
            rows = model.rows(texts)
            places = pa.array(np.append(0, np.cumsum(np.bincount(rows.row, minlength=len(texts)))).astype(np.int32))
            columns = [
                batch.column("key"),
                batch.column("label"),
                pa.array([model.share(text) for text in texts], pa.float64()),
                pa.ListArray.from_arrays(places, pa.array(rows.places.astype(np.int32))),
                pa.ListArray.from_arrays(places, pa.array(rows.values)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "share", "places", "counts"])

    keyed = sample.select(F.md5("text").alias("key"), "label", "text")
    made = in_arrow(keyed, measured, "key string, label int, share double, places array<int>, counts array<double>").toArrow()
    made = made.sort_by("key")  # fits do not depend on the order of rows
    label, share = made.column("label").to_numpy(), made.column("share").to_numpy()
    sizes = np.array([len(x) for x in made.column("places")], dtype=np.int64)
    rows = Sparse(sizes, *(made.column(c).combine_chunks().flatten().to_numpy() for c in ("places", "counts")), len(words))
    toxic = label == 1
    cuts = np.quantile(share[toxic], np.arange(1, GRADES - 1) / (GRADES - 1)) if toxic.any() else []
    model.weights, model.thresholds = fit_ordinal(rows, np.where(toxic, 1 + np.searchsorted(cuts, share, side="left"), 0))
    return model


def severities(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, severity (expected grade, 0 to 3), grade, toxic_score (probability of
    any grade above 0), toxic.

    A text is toxic from a ``toxic_score`` of ``TOXIC_FROM`` on, and its grade is then the likeliest above 0,
    else 0.

    Null and empty texts have no words and the lowest severity the model knows; texts of any length
    are read whole. Repeated rows get a row each, an empty table gives an empty result; only the two
    named columns are read.
    """

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            parts = model.grades(batch.column("text").to_pylist())
            score = 1 - parts[:, 0]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(parts @ np.arange(GRADES), pa.float64()),
                    pa.array(np.where(score >= TOXIC_FROM, 1 + parts[:, 1:].argmax(axis=1), 0).astype(np.int32)),
                    pa.array(score, pa.float64()),
                    pa.array(score >= TOXIC_FROM),
                ],
                names=["doc_id", "severity", "grade", "toxic_score", "toxic"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return in_arrow(rows, judged, f"doc_id {kind}, severity double, grade int, toxic_score double, toxic boolean")
