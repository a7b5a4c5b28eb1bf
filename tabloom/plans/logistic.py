"""Logistic regression to its optimum by Newton steps, and by stochastic steps in shards."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tabloom.functions import hash_bucket, nan_to_null, quoted
from tabloom.operators.folds import row_hash
from tabloom.plans.gram import doubles, gram
from tabloom.plans.linear import LinearModel, complete_rows

HALVINGS = 30


def _share(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fit_newton_logistic(
    frame: DataFrame, features: Sequence[str], label: str, *, l2: float = 1.0, intercept: bool = True,
    tolerance: float = 1e-8, most_steps: int = 100,
) -> LinearModel:
    """The minimum of the summed log loss plus ``l2`` / 2 times the squared weights; the intercept is free.

    Each step is one pass for X'WX, the gradient and the loss at the current weights, with a solve of the model's size
    on the driver; a step that raises the loss is halved. Ends when no weight moves by more than ``tolerance``, usually
    after five to ten passes. An inverse strength C is ``l2`` = 1 / C. Rows with a missing value or label take no part.
    """
    rows = doubles(nan_to_null(complete_rows(frame, features, label)).dropna(), [quoted(c) for c in (*features, label)]).persist()
    size = len(features) + 1
    weights = np.zeros(size)
    penalty = np.array([0.0 if intercept else 1.0, *[l2] * len(features)])

    def sums(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, float]:
        """The loss, its gradient and curvature, and the sum of the rows' weights."""
        def sides(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            y = z[:, -1] > 0
            x = np.column_stack([np.ones(len(z)), z[:, :-1]])
            margin = x @ at
            p = _share(margin)
            loss = np.logaddexp(0, margin) - y * margin
            return x, np.column_stack([x * (p * (1 - p))[:, None], p - y, loss])

        whole = gram(rows, sides, (size, size + 2))
        loss = whole[0, size + 1] + 0.5 * float((penalty * at * at).sum())
        return loss, whole[:, size] + penalty * at, whole[:, :size] + np.diag(penalty), float(whole[0, 0])

    try:
        loss, slope, curve, seen = sums(weights)
        if not seen:
            raise ValueError("no complete rows to fit")
        free = np.arange(size) if intercept else np.arange(1, size)
        for number in range(1, most_steps + 1):
            step = np.zeros(size)
            inner = curve[np.ix_(free, free)]
            step[free] = np.linalg.lstsq(inner, slope[free], rcond=None)[0]
            for _ in range(HALVINGS):
                found = sums(weights - step)
                if found[0] <= loss + 1e-12 * abs(loss):
                    break
                step = step / 2
            else:
                break  # no shorter step is better
            weights = weights - step
            loss, slope, curve, _ = found
            if np.abs(step).max() <= tolerance:
                break
        return LinearModel(
            tuple(features), float(weights[0]), tuple(map(float, weights[1:])), link="logit", iterations=number
        )
    finally:
        rows.unpersist()


def first_time(alpha: float) -> float:
    """Where the schedule of steps 1 / (alpha (first + t)) starts, so that first steps suit weights of a usual size."""
    usual = math.sqrt(1 / math.sqrt(alpha))
    return 1 / (alpha * usual / max(1.0, 1 / (1 + math.exp(-usual))))


SHARD = pa.schema([("shard", pa.int32()), ("rows", pa.int64()), ("weights", pa.list_(pa.float64()))])


def _epoch(start: np.ndarray, seen: dict[int, int], alpha: float, first: float, intercept: bool):
    """Rows (shard, label, features) in order of the shards; each shard starts from the same weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows, weights, bias = None, 0, None, 0.0
        done = lambda: pa.RecordBatch.from_pylist([{"shard": shard, "rows": rows, "weights": [bias, *weights]}], SHARD)
        for batch in batches:
            if not batch.num_rows:
                continue
            shards = batch.column(0).to_numpy()
            labels = batch.column(1).to_numpy() > 0
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]])
            for of, y, row in zip(shards.tolist(), labels.tolist(), x, strict=True):
                if of != shard:
                    if shard is not None:
                        yield done()
                    shard, rows, bias, weights = of, 0, float(start[0]), start[1:].copy()
                eta = 1 / (alpha * (first + seen.get(of, 0) + rows))
                slope = 1 / (1 + math.exp(-min(max(float(row @ weights) + bias, -700.0), 700.0))) - y
                weights = weights * (1 - eta * alpha) - eta * slope * row
                if intercept:
                    bias -= eta * slope
                rows += 1
        if shard is not None:
            yield done()

    return run


def fit_sgd_logistic(
    frame: DataFrame, features: Sequence[str], label: str, key: str, *, alpha: float = 1e-4, epochs: int = 5,
    shards: int = 32, intercept: bool = True,
) -> LinearModel:
    """Logistic regression by stochastic gradient steps with an L2 penalty ``alpha``.

    Rows are dealt to ``shards`` by a hash of their key and ordered by another, so neither the cluster nor a lost executor
    changes the result; more rows want more shards. In an epoch every shard goes through its rows from the same weights, and the mean of
    the shards' weights by their rows starts the next. Steps are 1 / (alpha (t0 + t)), where t counts a shard's own rows.
    """
    complete = nan_to_null(frame.select(*[quoted(c) for c in dict.fromkeys((key, *features, label))]))
    complete = complete.dropna(subset=[*features, label])
    named = F.coalesce(F.col(quoted(key)).cast("string"), row_hash(complete).cast("string"))
    table = complete.select(
        hash_bucket(named, shards, "shard:").cast("int").alias("shard"), F.col(quoted(label)).cast("double").alias("label"),
        *[F.col(quoted(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
        F.md5(F.concat(F.lit("order:"), named)).alias("turn"),
    )
    names = [f"x{i}" for i in range(len(features))]
    rows = table.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "label", *names)
    rows = rows.select("shard", "label", *names).persist(StorageLevel.MEMORY_AND_DISK)
    weights, seen, first = np.zeros(len(features) + 1), {}, first_time(alpha)
    try:
        for _ in range(epochs):
            found = rows.mapInArrow(_epoch(weights, seen, alpha, first, intercept), "shard int, rows long, weights array<double>")
            parts = sorted(found.collect())  # a row for each shard
            if not parts:
                raise ValueError("no complete rows to fit")
            total = sum(r["rows"] for r in parts)
            weights = sum(np.array(r["weights"]) * (r["rows"] / total) for r in parts)
            seen = {r["shard"]: seen.get(r["shard"], 0) + r["rows"] for r in parts}
    finally:
        rows.unpersist()
    return LinearModel(tuple(features), float(weights[0]), tuple(map(float, weights[1:])), link="logit", iterations=epochs)
