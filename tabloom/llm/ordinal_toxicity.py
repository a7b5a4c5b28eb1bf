"""Toxicity grades by cumulative-link ordinal regression on sparse words.

P(grade <= k) is the logistic of threshold k minus a score that all thresholds share: the sum of the weights of the
distinct words of the text. The thresholds are kept in order by their steps, which are exponentials. A text's expected
severity is the sum of the probabilities of exceeding each threshold. Grades are made of the two judgments in the
labels: 0 not toxic, 1 toxic in a text of good quality, 2 toxic in a bad one.

The fit takes a bounded sample of labelled rows, ``SAMPLE_A_GRADE`` of each grade, chosen by a hash of the text and
weighted back to the grades' shares among all labelled rows; only the distinct words of these texts reach the driver. Words of fewer than ``LEAST_TEXTS`` sample texts have no
weight. The cut that calls a text toxic is the severity with the best F1 on the sample.

Defined cases: a very long text counts by its distinct words like any other; equal hashes are taken in the order of ids;
a null or empty text has the severity of a text without known words; without labelled rows the severity
is 0; a label row without a grade, or whose document is missing, teaches nothing; a null doc_id never meets a label;
repeated rows each return a row, and labelled ones that are alike teach once; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, drawn, slices, texts_of

SAMPLE_A_GRADE = 3000
LEAST_TEXTS = 4
ROUNDS, RATE, PENALTY = 400, 0.1, 0.05
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Word weights, ordered thresholds and the severity from which a text is called toxic."""

    weights: dict[str, float]
    thresholds: list[float]
    cut: float

    def severities(self, texts: list[str]) -> list[float]:
        known = self.weights.keys()
        scores = np.array([sum(self.weights[w] for w in sorted(known & words_of(t))) for t in texts], np.float64)
        total = np.zeros(len(texts))
        for threshold in self.thresholds:
            total += logistic(scores - threshold)
        return total.tolist()


def fit_ordinal(rows: list[tuple[str, int, float]]) -> Ordinal:
    """Fit to (text, grade, weight) rows; weights are relative."""
    if not rows or len({g for _, g, _ in rows}) < 2:
        return Ordinal({}, [], 0.5)
    rows = sorted(rows)
    found = [words_of(t) for t, _, _ in rows]
    counts = Counter(w for words in found for w in words)
    column = {w: i for i, w in enumerate(sorted(w for w, n in counts.items() if n >= LEAST_TEXTS))}
    lists = [sorted(column[w] for w in words if w in column) for words in found]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    place = np.array([c for x in lists for c in x], np.int64)
    grades = np.array([g for _, g, _ in rows])
    share = np.array([w for _, _, w in rows], np.float64)
    share /= share.sum()
    top = int(grades.max())
    # thresholds: the first, then logarithms of the steps to the next
    beyond = [np.clip((share * (grades > k)).sum(), 1e-4, 1 - 1e-4) for k in range(top)]
    levels = [-np.log(b / (1 - b)) for b in beyond]
    steps = np.array([levels[0], *[np.log(max(b - a, 0.1)) for a, b in zip(levels, levels[1:])]])
    size, count = len(column), len(rows)
    times = lambda w: np.bincount(owner, w[place], count) if len(place) else np.zeros(count)
    back = lambda r: np.bincount(place, r[owner], size) if len(place) else np.zeros(size)
    largest, curve = np.ones(size), 1.0
    for _ in range(15):  # the largest curvature of the mean loss, by power steps
        largest = back(share * times(largest))
        curve = float(np.linalg.norm(largest)) or 1.0
        largest /= curve
    rate = 1 / (0.3 * curve)
    penalty = PENALTY / np.sqrt(count)
    weights = ahead = np.zeros(size)
    pace, step_squares = 1.0, np.full_like(steps, 1e-10)
    for _ in range(ROUNDS):
        scores = times(ahead)
        thresholds = np.cumsum(np.concatenate((steps[:1], np.exp(steps[1:]))))
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
        up, low = logistic(edges[grades + 1] - scores), logistic(edges[grades] - scores)
        up, low = np.where(grades == top, 1.0, up), np.where(grades == 0, 0.0, low)
        chance = np.maximum(up - low, 1e-9)
        up_slope, low_slope = share * up * (1 - up) / chance, share * low * (1 - low) / chance
        moved = ahead + rate * back(low_slope - up_slope)
        moved = np.sign(moved) * np.maximum(np.abs(moved) - rate * penalty, 0)  # few words keep a weight
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / faster * (moved - weights)
        weights, pace = moved, faster
        by_threshold = np.array([(up_slope * (grades == k)).sum() - (low_slope * (grades == k + 1)).sum() for k in range(top)])
        by_step = by_threshold[::-1].cumsum()[::-1] * np.concatenate(([1.0], np.exp(steps[1:])))
        step_squares += by_step**2
        steps = steps + RATE * by_step / np.sqrt(step_squares)
    thresholds = np.cumsum(np.concatenate((steps[:1], np.exp(steps[1:])))).tolist()
    model = Ordinal({w: float(weights[i]) for w, i in column.items() if weights[i]}, thresholds, 0.5)
    severities = np.array(model.severities([t for t, _, _ in rows]))
    order = np.argsort(-severities, kind="stable")
    toxic = (grades > 0)[order]
    hits, flagged = np.cumsum(share[order] * toxic), np.cumsum(share[order])
    ends = np.append(severities[order][1:] != severities[order][:-1], True)
    f1 = np.where(ends, 2 * hits / (flagged + (share * (grades > 0)).sum()), -1)
    best = int(f1.argmax())
    below = severities[order][best + 1] if best + 1 < len(order) else 0.0
    model.cut = float((severities[order][best] + below) / 2)
    return model


def grade(toxic: Column, quality: Column) -> Column:
    return F.when(toxic == 0, 0).when((toxic == 1) & (quality == 1), 1).when(toxic == 1, 2)


def learn_toxicity(
    spark: SparkSession, documents: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text"
) -> Ordinal:
    graded = labels.select(
        F.col("doc_id").cast("long").alias("label_id"), grade(F.col("toxic"), F.col("quality")).alias("grade")
    ).where("grade IS NOT NULL")
    texts = texts_of(documents, id_column, text_column)
    graded = graded.where("label_id IS NOT NULL").withColumn("hash", F.xxhash64("label_id"))
    sampled = drawn(spark, graded.distinct(), "grade", "hash", SAMPLE_A_GRADE, 3)
    totals = {r["grade"]: r["count"] for r in graded.groupBy("grade").count().collect()}
    # at most SAMPLE_A_GRADE rows for each of three grades, so no text need be shuffled to meet them
    few = F.broadcast(sampled.select("label_id", "grade"))
    met = texts.join(few, F.col("doc_id") == F.col("label_id")).select("text", "grade")
    words = met.mapInArrow(_distinct_words, "words string, grade int").distinct()
    # an id may have any number of texts
    words = drawn(spark, words.withColumn("hash", F.xxhash64("words", "grade")), "grade", "hash", SAMPLE_A_GRADE, 3)
    rows = words.select("words", "grade").collect()
    counts = Counter(r["grade"] for r in rows)
    return fit_ordinal([(r["words"], r["grade"], totals[r["grade"]] / counts[r["grade"]]) for r in rows])


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 0):
        words = [" ".join(sorted(words_of(t))) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column(1)], names=["words", "grade"])


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())]
)


def score_toxicity(
    spark: SparkSession, documents: DataFrame, labels: DataFrame, id_column="doc_id", text_column="text"
) -> DataFrame:
    """One row per document: doc_id, expected severity, the nearest grade, whether the severity reaches the cut."""
    model = spark.sparkContext.broadcast(learn_toxicity(spark, documents, labels, id_column, text_column))  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = model.value
        for batch in slices(batches, 1):
            severities = fitted.severities(batch.column(1).to_pylist())
            grades = [int(round(s)) for s in severities]
            toxic = [bool(fitted.thresholds) and s >= fitted.cut for s in severities]
            yield batch_of(RESULT, batch.column(0), severities, grades, toxic)

    schema = "doc_id long, severity double, grade int, toxic boolean"
    return texts_of(documents, id_column, text_column).mapInArrow(run, schema)
