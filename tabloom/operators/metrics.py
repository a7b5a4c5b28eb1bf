"""Evaluation: every metric is one small aggregate over (truth, prediction) rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import quoted
from tabloom.operators.criteria import melt_numeric
from tabloom.operators.ordered import add_slices, histogram, lay_out, running_totals


def auc(frame: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve, ties one half: one row (auc), or one per value of ``keys``.

    Rows are first counted per score.  The negatives below each score are a running
    total over slices of the score range, so continuous scores do not meet in one task.
    """
    rows = frame.select(
        *[quoted(k) for k in keys], F.col(quoted(label)).alias("y"), F.col(quoted(score)).cast("double").alias("s")
    ).dropna(subset=["y", "s"])
    layout = lay_out(rows, ["s"])
    melted = melt_numeric(add_slices(rows, layout), ["s"], [*keys, "y"], layout)
    sides = ("count_if(y > 0) AS pos", "count_if(y <= 0) AS neg")
    counted = histogram(melted, keys, layout, [F.expr(e) for e in sides])
    ranked = running_totals(
        counted.values,
        [*keys, "feature"],
        ["x"],
        ["neg"],
        slice_column=layout.slice_column,
        by_slice=counted.by_slice,
    )
    sums = ("sum(pos * (neg_upto - neg / 2D)) AS pairs", "CAST(sum(pos) AS DOUBLE) AS p", "CAST(sum(neg) AS DOUBLE) AS n")
    return ranked.groupBy(*keys).agg(*[F.expr(e) for e in sums]).selectExpr(*keys, "pairs / nullif(p * n, 0D) AS auc")


def accuracy(frame: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row (accuracy, error) per ``keys``; a missing prediction is an error."""
    right = F.coalesce((F.col(quoted(label)) == F.col(quoted(prediction))).cast("double"), F.lit(0.0))
    return frame.groupBy(*keys).agg(F.avg(right).alias("accuracy"), F.avg(1 - right).alias("error"))


def confusion(frame: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """TP, FP and FN per class, over the classes of truth and prediction together."""
    cells = frame.groupBy(
        *keys, F.col(quoted(label)).alias("truth"), F.col(quoted(prediction)).alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    truth = "struct(CAST(truth AS STRING) AS class, IF(truth <=> guess, n, 0) AS tp, 0L AS fp, IF(truth <=> guess, 0, n) AS fn)"
    guess = "struct(CAST(guess AS STRING) AS class, 0L AS tp, IF(truth <=> guess, 0, n) AS fp, 0L AS fn)"
    return (
        cells.selectExpr(*keys, f"inline(array({truth}, {guess}))")
        .filter("class IS NOT NULL")
        .groupBy(*keys, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )


PRECISION = "coalesce(tp / nullif(tp + fp, 0), 0D) AS precision"
RECALL = "coalesce(tp / nullif(tp + fn, 0), 0D) AS recall"
F1 = "coalesce(2D * tp / nullif(2 * tp + fp + fn, 0), 0D) AS f1"


def counted_classes(frame, label, prediction, classes, keys) -> DataFrame:
    table = confusion(frame, label, prediction, keys)
    return table if classes is None else table.filter(F.col("class").isin([str(c) for c in classes]))


def f1_per_class(
    frame: DataFrame, label: str, prediction: str, classes: Sequence | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall and F1 per class. ``classes`` limits which classes count."""
    table = counted_classes(frame, label, prediction, classes, keys)
    return table.selectExpr(*keys, "class", PRECISION, RECALL, F1)


def f1_micro(
    frame: DataFrame, label: str, prediction: str, classes: Sequence | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """F1 of the pooled counts: one row (precision, recall, f1) per ``keys``."""
    table = counted_classes(frame, label, prediction, classes, keys)
    pooled = table.groupBy(*keys).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    return pooled.selectExpr(*keys, PRECISION, RECALL, F1)


def f1_macro(
    frame: DataFrame, label: str, prediction: str, classes: Sequence | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Unweighted mean of the classes' F1: one row (f1) per ``keys``."""
    return f1_per_class(frame, label, prediction, classes, keys).groupBy(*keys).agg(F.avg("f1").alias("f1"))


def squared_error(frame: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row (mse, rmse) per ``keys``."""
    gap = F.col(quoted(label)) - F.col(quoted(prediction))
    return frame.groupBy(*keys).agg(F.avg(gap * gap).alias("mse")).selectExpr(*keys, "mse", "sqrt(mse) AS rmse")


Metric = Callable[..., DataFrame]

METRICS: dict[str, tuple[Metric, str, bool]] = {
    "auc": (auc, "auc", True),
    "accuracy": (accuracy, "accuracy", True),
    "error": (accuracy, "error", False),
    "f1_micro": (f1_micro, "f1", True),
    "f1_macro": (f1_macro, "f1", True),
    "mse": (squared_error, "mse", False),
    "rmse": (squared_error, "rmse", False),
}


def register_metric(name: str, metric: Metric, column: str, higher_is_better: bool) -> None:
    """Add a metric of your own: a function of (frame, label, prediction, keys=()) that
    gives one row with ``column`` per value of the key columns."""
    METRICS[name] = (metric, column, higher_is_better)


def evaluate(frame: DataFrame, label: str, prediction: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys.., name, value, higher_is_better): one, or one per value of ``keys``."""
    if name not in METRICS:
        raise ValueError(f"metric must be one of {sorted(METRICS)}")
    metric, column, higher = METRICS[name]
    return metric(frame, label, prediction, keys=keys).select(
        *[quoted(k) for k in keys],
        F.lit(name).alias("name"),
        F.col(column).alias("value"),
        F.lit(higher).alias("higher_is_better"),
    )
