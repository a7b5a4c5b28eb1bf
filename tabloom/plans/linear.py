"""Linear and logistic fits, and the perceptron.

The linear fits need one job for X'X and X'y; the p x p rest is model-sized.  The
logistic fit needs one aggregation per iteration, the perceptron one per update that its head of rows does not decide.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions import double_sql, quoted, sigmoid, softplus, weighted_sum
from tabloom.plans.compact import class_rows
from tabloom.plans.gram import doubles, gram


@dataclass(frozen=True)
class Moments:
    """X'X and X'y with a leading intercept column, y'y and the row count."""

    features: tuple[str, ...]
    gram: np.ndarray
    cross: np.ndarray
    square: float
    rows: int


def complete_rows(frame: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return frame.select(*[quoted(f) for f in features], quoted(label)).dropna()


HEAD_ROWS = 10_000  # rows of a perceptron fit that the driver holds
def _with_ones(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    whole = np.column_stack([np.ones(len(z)), z])
    return whole, whole


def moments(frame: DataFrame, features: Sequence[str], label: str) -> Moments:
    """One Arrow pass with a matrix product for each batch, summed as cells or tiles."""
    rows = doubles(complete_rows(frame, features, label), [quoted(c) for c in (*features, label)])
    size = len(features) + 2
    sums = gram(rows, _with_ones, (size, size))
    if not sums[0, 0]:
        raise ValueError("no complete rows to fit")
    return Moments(tuple(features), sums[:-1, :-1], sums[:-1, -1], float(sums[-1, -1]), int(round(sums[0, 0])))


def moment_table(frame: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row with every distinct entry of X'X, X'y and y'y."""
    m = moments(frame, features, label)
    size = len(m.gram)
    cells = {f"g_{i}_{j}": float(m.gram[i, j]) for i in range(size) for j in range(i, size)}
    cells |= {f"b_{i}": float(m.cross[i]) for i in range(size)} | {"yy": m.square}
    schema = ", ".join(f"{name} double" for name in cells) + ", rows long"
    return frame.sparkSession.createDataFrame([(*cells.values(), m.rows)], schema)


@dataclass(frozen=True)
class LinearModel:
    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    link: str = "identity"
    diverged: bool = False
    iterations: int = 0

    def column(self) -> Column:
        z = weighted_sum(self.features, self.weights, self.intercept)
        return sigmoid(z) if self.link == "logit" else z

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        check_columns(self.features, frame.columns)
        return frame.withColumn(name, self.column())

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [("(intercept)", float(self.intercept))]
        rows += [(f, float(w)) for f, w in zip(self.features, self.weights)]
        return spark.createDataFrame(rows, "term string, weight double")


def check_columns(expected: Sequence[str], found: Sequence[str]) -> None:
    """A table to score must carry every training column."""
    missing = sorted(set(expected) - set(found))
    if missing:
        raise ValueError(f"new data lacks training columns {missing}")


def fit_normal_equation(frame: DataFrame, features: Sequence[str], label: str) -> LinearModel:
    """Least squares; the pseudo-inverse when X'X is rank deficient."""
    m = moments(frame, features, label)
    if np.linalg.matrix_rank(m.gram) == len(m.gram):
        theta = np.linalg.solve(m.gram, m.cross)
    else:
        theta = np.linalg.pinv(m.gram) @ m.cross
    return LinearModel(m.features, float(theta[0]), tuple(map(float, theta[1:])))


def fit_linear_descent(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    eta: float = 0.1,
    delta: float = 1e-6,
    max_iterations: int = 1_000_000,
) -> LinearModel:
    """Batch gradient descent from zero on the moments: one Spark job whatever the steps.

    Stops when the squared error falls by less than ``delta``.  A rising error stops it
    too; then the weights before the rise are kept and ``diverged`` is set.
    """
    m = moments(frame, features, label)

    theta, diverged, steps = np.zeros(len(m.gram)), False, 0
    while steps < max_iterations:
        gap = m.gram @ theta - m.cross
        move = -eta / m.rows * gap
        # the fall of the squared error, taken from the move and not from two large costs
        fell = -float(move @ m.gram @ move + 2 * move @ gap)
        steps += 1
        if not fell >= 0:
            diverged = True
            break
        theta = theta + move
        if fell < delta:
            break
    return LinearModel(
        m.features, float(theta[0]), tuple(map(float, theta[1:])), diverged=diverged, iterations=steps
    )


@dataclass(frozen=True)
class LogisticFit:
    model: LinearModel
    curve: tuple[tuple, ...]

    def curve_table(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(
            [
                T.StructField("iter", T.IntegerType(), False),
                T.StructField("cost", T.DoubleType(), False),
                T.StructField("cost_test", T.DoubleType()),
            ]
        )
        return spark.createDataFrame(list(self.curve), schema)


def logistic_aggregates(features: Sequence[str], z: Column, gradients: bool = True) -> list[Column]:
    """Row weight, log loss, and one gradient sum per feature, over (features, label, n) rows."""
    loss = F.sum(F.col("n") * (softplus(z) - F.col("label") * z)).alias("loss")
    columns = [F.sum("n").alias("n"), loss]
    if gradients:
        gap = F.col("n") * (sigmoid(z) - F.col("label"))
        columns += [F.sum(gap * F.col(quoted(f))).alias(f"g{i}") for i, f in enumerate(features)]
    return columns


def fit_logistic(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    eta: float = 0.1,
    rounds: int = 2000,
    l1: float = 0.0,
    l2: float = 0.0,
    test: DataFrame | None = None,
    intercept: bool = False,
    start: Sequence[float] | None = None,
) -> LogisticFit:
    """Logistic regression by batch gradient descent with L1 and L2 terms.

    The curve holds the cost at the weights of each round; the model holds the weights
    of the last round's start, so ``rounds - 1`` updates.  The cost adds the penalties.
    """
    rows, _ = class_rows(frame.dropna(subset=list(features)), features, label)
    tests = None if test is None else class_rows(test.dropna(subset=list(features)), features, label)[0]
    names = list(features)
    try:
        weights = np.zeros(len(names) + int(intercept)) if start is None else np.array(start, dtype=float)
        curve, current = [], weights
        for number in range(rounds):
            current = weights
            z = linear_part(names, current, intercept)
            columns = logistic_aggregates(names, z)
            if intercept:
                columns.append(F.sum(F.col("n") * (sigmoid(z) - F.col("label"))).alias("g_intercept"))
            row = rows.agg(*columns).first()
            n = row["n"]
            if not n:
                raise ValueError("no labelled rows to fit")
            penalty = l1 * np.abs(current).sum() + 0.5 * l2 * np.square(current).sum()
            cost_test = None
            if tests is not None:
                held = tests.agg(*logistic_aggregates(names, z, gradients=False)).first()
                cost_test = float((held["loss"] + penalty) / held["n"])
            curve.append((number, float((row["loss"] + penalty) / n), cost_test))
            gradient = [row[f"g{i}"] for i in range(len(names))]
            if intercept:
                gradient = [row["g_intercept"], *gradient]
            shrink = l1 * np.where(current >= 0, 1.0, -1.0) + l2 * current
            weights = current - eta * (np.array(gradient) + shrink) / n
        bias, slopes = (float(current[0]), current[1:]) if intercept else (0.0, current)
        model = LinearModel(tuple(names), bias, tuple(map(float, slopes)), link="logit", iterations=rounds)
        return LogisticFit(model, tuple(curve))
    finally:
        rows.unpersist()
        if tests is not None:
            tests.unpersist()


def linear_part(names: Sequence[str], weights: np.ndarray, intercept: bool) -> Column:
    if intercept:
        return weighted_sum(names, list(weights[1:]), float(weights[0]))
    return weighted_sum(names, list(weights))


def logistic_cost(frame: DataFrame, model: LinearModel, label: str, l1: float = 0.0, l2: float = 0.0) -> DataFrame:
    """Regularised cross entropy of a model on a table, as one row (rows, cost)."""
    z = weighted_sum(model.features, model.weights, model.intercept)
    penalty = l1 * sum(abs(w) for w in model.weights) + 0.5 * l2 * sum(w * w for w in model.weights)
    return frame.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(softplus(z) - F.col(quoted(label)) * z).alias("loss")
    ).select("rows", ((F.col("loss") + F.lit(float(penalty))) / F.col("rows")).alias("cost"))


@dataclass(frozen=True)
class Perceptron:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    updates: int
    separated: bool

    def column(self) -> Column:
        return F.when(weighted_sum(self.features, self.weights) > 0, 1).otherwise(-1)

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        return frame.withColumn(name, self.column())

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(f, w, self.updates, self.separated) for f, w in zip(self.features, self.weights)]
        return spark.createDataFrame(rows, "feature string, weight double, updates int, separated boolean")


def _first_wrong(points: np.ndarray, signs: np.ndarray, weights: Sequence[float]) -> int | None:
    """The first row on the wrong side, with products added in the order of the columns."""
    dot = np.zeros(len(points))
    for i, w in enumerate(weights):
        dot = dot + points[:, i] * w
    wrong = np.flatnonzero(signs * dot <= 0)
    return int(wrong[0]) if len(wrong) else None


def fit_perceptron(
    frame: DataFrame, features: Sequence[str], label: str, key: str, *, max_updates: int | None = None,
    head_rows: int = HEAD_ROWS,
) -> Perceptron:
    """Perceptron with labels -1/+1: take the first misclassified row by ``key``, add
    y x to the weights, look again from the first row.

    The first ``head_rows`` rows by key are kept on the driver.  As long as one of them is
    misclassified it is the first of the table, so updates are replayed there; the table is
    asked only when they are all right, for its first misclassified row, a minimum that
    sends one row per task.  The weights are those of the row by row loop, whatever the
    size of the head.  Ends when nothing is misclassified, or after ``max_updates``: on
    rows that no plane separates the loop has no other end.
    """
    number = [F.col(quoted(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    rows = frame.select(F.col(quoted(key)).alias("place"), F.col(quoted(label)).cast("double").alias("sign"), *number)
    rows = rows.persist()
    names = [f"x{i}" for i in range(len(features))]
    weights = [0.0] * len(features)
    try:
        updates = 0
        head = rows.orderBy("place", "sign", *names).limit(head_rows).collect()
        number_of = lambda v: float("nan") if v is None else v
        points = np.array([[number_of(r[n]) for n in names] for r in head]).reshape(len(head), len(names))
        signs = np.array([number_of(r["sign"]) for r in head])
        while True:
            while (max_updates is None or updates < max_updates) and (at := _first_wrong(points, signs, weights)) is not None:
                weights = [w + float(signs[at]) * float(x) for w, x in zip(weights, points[at])]
                updates += 1
            dot = " + ".join(["0D", *[f"{n} * {double_sql(w)}" for n, w in zip(names, weights)]])
            wrong = rows.filter(f"sign * ({dot}) <= 0")
            first = wrong.agg(
                F.min(F.struct("place", F.col("sign").alias("y"), *names)).alias("row")
            ).first()["row"]
            if first is None or max_updates is not None and updates >= max_updates:
                return Perceptron(tuple(features), tuple(weights), updates, first is None)
            weights = [w + first["y"] * first[n] for w, n in zip(weights, names)]
            updates += 1
    finally:
        rows.unpersist()
