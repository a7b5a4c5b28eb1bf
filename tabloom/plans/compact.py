"""Fold equal rows together before an iterative fit.

A fit only needs, per distinct feature vector, the class counts or the count, mean and
squared deviation of the target.  With binned or categorical features the number of
vectors is bounded by the domains whatever the number of rows, so one grouped pass over
the big table leaves a small table for every later level, round or iteration.  With
continuous features grouping would only add a shuffle; then rows stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tabloom.functions import nan_to_null, quoted
from tabloom.operators.ordered import Layout, add_slices, lay_out

# columns that the fits add to a table
OWN_NAMES = {"label", "n", "m", "m2", "r", "node", "score", "sign", "w", "fold"}
FOLD_RATIO = 0.5
# category combinations that make a small table whatever the number of rows
FOLDED_ROWS = 10_000_000


def features_and_label(
    frame: DataFrame, features: Sequence[str], label: str, carry: Sequence[str] = ()
) -> DataFrame:
    """The columns a fit reads, labelled rows only; nothing else leaves the scan."""
    clash = [f for f in features if f.lower() in OWN_NAMES]
    if clash or len({f.lower() for f in features}) != len(features):
        raise ValueError(f"rename or deduplicate features: {clash or list(features)}")
    columns = [F.col(quoted(f)) for f in (*features, *carry)]
    # NaN would sort above every number and take the right branch
    return nan_to_null(frame.select(*columns, F.col(quoted(label)).alias("label"))).filter("label IS NOT NULL")


def worth_folding(layout: Layout, per_vector: int = 1) -> bool:
    return layout.combinations * per_vector <= FOLD_RATIO * layout.rows


def class_rows(
    frame: DataFrame, features: Sequence[str], label: str, carry: Sequence[str] = (), max_bins: int | None = None
) -> tuple[DataFrame, Layout]:
    """(features, carry, label, n) rows, kept in memory and on disk for the fit.

    ``carry`` columns have few values, such as a fold number.
    """
    base = features_and_label(frame, features, label, carry)
    layout = lay_out(base, features, slices=max_bins, small_domain=max_bins)
    if worth_folding(layout, per_vector=4):
        rows = base.groupBy(*[quoted(f) for f in (*features, *carry)], "label").agg(
            F.count(F.lit(1)).cast("double").alias("n")
        )
    else:
        rows = base.withColumn("n", F.lit(1.0))
    return add_slices(rows, layout).persist(StorageLevel.MEMORY_AND_DISK), layout


def target_rows(
    frame: DataFrame, features: Sequence[str], label: str, carry: Sequence[str] = (), max_bins: int | None = None
) -> tuple[DataFrame, Layout]:
    """(features, carry, n, m, m2) rows: count, mean and squared deviation of the target."""
    base = features_and_label(frame, features, label, carry)
    layout = lay_out(base, features, slices=max_bins, small_domain=max_bins)
    target = F.col("label").cast("double")
    kept = [quoted(f) for f in (*features, *carry)]
    if worth_folding(layout, per_vector=4 if carry else 1):
        rows = base.groupBy(*kept).agg(
            F.count(F.lit(1)).cast("double").alias("n"),
            F.avg(target).alias("m"),
            (F.var_pop(target) * F.count(F.lit(1))).alias("m2"),
        )
    else:
        rows = base.select(*kept, F.lit(1.0).alias("n"), target.alias("m"), F.lit(0.0).alias("m2"))
    return add_slices(rows, layout).persist(StorageLevel.MEMORY_AND_DISK), layout


def category_rows(frame: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(features, label, n) rows of categorical columns, folded when few combinations exist."""
    base = features_and_label(frame, features, label)
    sizes = base.agg(*[F.approx_count_distinct(quoted(f)).alias(f"d{i}") for i, f in enumerate(features)]).first()
    if math.prod(max(size, 1) for size in sizes) > FOLDED_ROWS:
        return base.withColumn("n", F.lit(1.0))
    return base.groupBy(*[quoted(f) for f in features], "label").agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
