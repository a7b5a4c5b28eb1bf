"""Grouped statistics behind the split criteria, for all features and nodes at once.

Everything starts from one histogram, ``groupBy(node, feature, value)``, whose partial
aggregation runs before the shuffle: a value that fills a third of the table arrives
at the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions import entropy_term, half_even, quoted
from tabloom.operators.ordered import Histogram, Layout, running_totals, slice_melted


def melt_numeric(
    frame: DataFrame, features: Sequence[str], carry: Sequence[str | Column], layout: Layout | None = None
) -> DataFrame:
    """One row per (row, feature): the feature's position and its value; nulls left out.

    With a sliced layout (and a table that went through ``add_slices``) also the slice.
    """
    sliced = layout is not None and layout.sliced
    pairs = [
        f"struct({i} AS feature, CAST({quoted(name)} AS DOUBLE) AS x"
        + (f", {layout.slice_sql(i)} AS slice)" if sliced else ")")
        for i, name in enumerate(features)
    ]
    return frame.select(*carry, F.expr(f"inline(array({', '.join(pairs)}))")).filter("x IS NOT NULL")


def melt_text(frame: DataFrame, features: Sequence[str], carry: Sequence[str | Column]) -> DataFrame:
    """As ``melt_numeric`` for categorical features, the value as text."""
    pairs = [
        F.struct(F.lit(i).alias("feature"), F.col(quoted(name)).cast("string").alias("value"))
        for i, name in enumerate(features)
    ]
    return frame.select(*carry, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())


def class_measures(label: Column, classes: Sequence, weight: Column) -> list[Column]:
    """``c0, c1, ..``: the weight of each class."""
    none = F.lit(0.0)
    return [
        F.sum(F.when(label == value, weight).otherwise(none)).alias(f"c{k}") for k, value in enumerate(classes)
    ]


def threshold_totals(
    histogram: Histogram,
    keys: Sequence[str],
    measures: Sequence[str],
    *,
    digits: int,
    layout: Layout,
    strict: bool = False,
) -> DataFrame:
    """Totals on either side of every candidate threshold.

    Candidates are midpoints of adjacent distinct values, rounded half even.  The low
    side holds ``x <= t``, or ``x < t`` when ``strict``.  On coarse columns a rounded
    midpoint stays between its two values, so the running total at the lower one is the
    low side; otherwise ``mixed_totals`` looks up the threshold's own place.
    """
    if not layout.coarse:
        return mixed_totals(histogram, keys, measures, digits=digits, layout=layout, strict=strict)
    groups = [*keys, "feature"]
    running = running_totals(
        histogram.values,
        groups,
        ["x"],
        measures,
        slice_column=layout.slice_column,
        by_slice=histogram.by_slice,
        following="x_next",
    ).filter("x_next IS NOT NULL")
    return running.selectExpr(*groups, f"{cut_sql(layout, digits)} AS threshold", *side_totals(measures))


def cut_sql(layout: Layout, digits: int) -> str:
    """The rounded midpoint to the next value; a boundary of a snapped column is a cut as it is."""
    scale = f"{10.0**digits!r}D"
    middle = f"rint((x + x_next) / 2 * {scale}) / {scale}"
    if not layout.snapped:
        return middle
    snapped = ", ".join(map(str, layout.snapped))
    return f"CASE WHEN feature IN ({snapped}) AND x_next IS NOT NULL THEN x ELSE {middle} END"


def side_totals(measures: Sequence[str]) -> list[str]:
    return [f"{m}_upto AS {m}_low" for m in measures] + [f"{m}_all - {m}_upto AS {m}_high" for m in measures]


def mixed_totals(
    histogram: Histogram,
    keys: Sequence[str],
    measures: Sequence[str],
    *,
    digits: int,
    layout: Layout,
    strict: bool = False,
) -> DataFrame:
    """As ``threshold_totals`` where a rounded midpoint may leave its interval: values and
    thresholds are put in one order and the totals are taken at the threshold's place."""
    groups = [*keys, "feature"]
    paired = running_totals(
        histogram.values,
        groups,
        ["x"],
        measures[:1],
        slice_column=layout.slice_column,
        by_slice=histogram.by_slice,
        following="x_next",
    )
    value_rank, threshold_rank = (1, 0) if strict else (0, 1)
    kept, empty = ", ".join(measures), ", ".join(f"0D AS {m}" for m in measures)
    value = f"struct(x AS at, {value_rank} AS rank, {kept})"
    threshold = f"struct({cut_sql(layout, digits)} AS at, {threshold_rank} AS rank, {empty})"
    points = paired.selectExpr(*groups, f"inline(array({value}, {threshold}))").filter("at IS NOT NULL")
    if layout.sliced:
        points = slice_melted(points, layout, "at")
    return (
        running_totals(points, groups, ["at", "rank"], measures, slice_column=layout.slice_column)
        .filter(f"rank = {threshold_rank}")
        .selectExpr(*groups, "at AS threshold", *side_totals(measures))
    )


def added(names: Sequence[str]) -> Column:
    return F.expr(" + ".join(names))


def gini_sql(counts: Sequence[str]) -> str:
    """1 - sum p^2 over class weight columns."""
    total = f"({' + '.join(counts)})"
    return "1D - " + " - ".join(f"({c} / {total}) * ({c} / {total})" for c in counts)


def gini(counts: Sequence[str]) -> Column:
    return F.expr(gini_sql(counts))


def gini_candidates(
    histogram: Histogram, keys: Sequence[str], classes: int, *, layout: Layout, digits: int = 4
) -> DataFrame:
    """Per (keys, feature, threshold) with rows on both sides: class weights of the sides,
    and their gini weighted by size."""
    measures = [f"c{k}" for k in range(classes)]
    table = threshold_totals(histogram, keys, measures, digits=digits, layout=layout)
    low, high = [f"{m}_low" for m in measures], [f"{m}_high" for m in measures]
    n_low, n_high = " + ".join(low), " + ".join(high)
    weighted = f"(({n_low}) * ({gini_sql(low)}) + ({n_high}) * ({gini_sql(high)})) / ({n_low} + {n_high})"
    return table.filter(f"{n_low} > 0 AND {n_high} > 0").selectExpr("*", f"rint({weighted} * 1e12D) / 1e12D AS gini")


def loss_candidates(histogram: Histogram, keys: Sequence[str], *, layout: Layout, digits: int = 4) -> DataFrame:
    """Per (keys, feature, threshold) with rows on both sides: the sides' squared losses.

    The histogram carries ``n``, ``s`` (sum) and ``q`` (sum of squares); a loss is
    q - s^2 / n.  ``share`` is the loss as a part of the unsplit loss, rounded so that
    equal partitions tie.
    """
    table = threshold_totals(histogram, keys, ["n", "s", "q"], digits=digits, layout=layout)
    whole = (
        "greatest(q_low + q_high - (s_low + s_high) * (s_low + s_high) / (n_low + n_high), 0D)"
    )
    return (
        table.filter("n_low > 0 AND n_high > 0")
        .selectExpr(
            "*",
            "greatest(q_low - s_low * s_low / n_low, 0D) AS loss_low",
            "greatest(q_high - s_high * s_high / n_high, 0D) AS loss_high",
            f"{whole} AS whole",
        )
        .selectExpr(
            "*",
            "loss_low + loss_high AS loss",
            "CASE WHEN whole > 0 THEN rint((loss_low + loss_high) / whole * 1e10D) / 1e10D ELSE 1D END AS share",
        )
    )


def stump_candidates(histogram: Histogram, keys: Sequence[str], *, layout: Layout, digits: int = 8) -> DataFrame:
    """Weighted error of ``x >= t -> polarity`` for both polarities of every threshold.

    The histogram carries ``wp`` and ``wn``, the weights of the +1 and -1 rows.
    """
    table = threshold_totals(
        histogram, keys, ["wp", "wn"], digits=digits, layout=layout, strict=True
    )
    error = "(wn_high + wp_low) / (wp_low + wp_high + wn_low + wn_high)"
    above = f"struct(1 AS polarity, rint({error} * 1e12D) / 1e12D AS error)"
    below = f"struct(-1 AS polarity, rint((1D - {error}) * 1e12D) / 1e12D AS error)"
    return table.selectExpr(*keys, "feature", "threshold", f"inline(array({above}, {below}))")


def category_gains(counts: DataFrame, keys: Sequence[str], classes: int, *more: Column) -> DataFrame:
    """Gain, intrinsic value and gain ratio per (keys, feature) from class counts per value;
    ``more`` are further aggregates per feature.

    ``counts`` has one row per (keys, feature, value) with class counts ``c0, c1, ..``.
    Entropies are taken from sums of x log2 x, so one aggregation gives all three.
    """
    names = [f"c{k}" for k in range(classes)]
    size = added(names)

    def xlogx(value: Column) -> Column:
        return F.when(value > 0, value * F.log2(value)).otherwise(F.lit(0.0))

    inner = xlogx(F.col(names[0]))
    for name in names[1:]:
        inner = inner + xlogx(F.col(name))
    grouped = counts.groupBy(*keys, "feature").agg(
        *[F.sum(name).alias(name) for name in names],
        F.sum(xlogx(size)).alias("value_part"),
        F.sum(inner).alias("cell_part"),
        *more,
    )
    n = added(names)
    entropy = entropy_term(F.col(names[0]) / n)
    for name in names[1:]:
        entropy = entropy + entropy_term(F.col(name) / n)
    conditional = (F.col("value_part") - F.col("cell_part")) / n
    intrinsic = F.log2(n) - F.col("value_part") / n
    table = (
        grouped.withColumn("entropy", entropy)
        .withColumn("conditional_entropy", conditional)
        .withColumn("intrinsic_value", intrinsic)
        .withColumn("gain", F.col("entropy") - F.col("conditional_entropy"))
    )
    ratio = F.when(half_even(F.col("intrinsic_value"), 12) == 0, F.lit(0.0)).otherwise(
        F.col("gain") / F.col("intrinsic_value")
    )
    return table.withColumn("gain_ratio", ratio).drop("value_part", "cell_part")


def best_per_node(
    candidates: DataFrame, keys: Sequence[str], payload: Sequence[str], ranking: Sequence[str]
) -> DataFrame:
    """The smallest candidate of each key by the ``ranking`` expressions, with the number
    of usable features.

    The first grouping has the partitioning of the candidate windows, so only one row
    per feature is shuffled.
    """
    order = ", ".join(f"{expression} AS o{i}" for i, expression in enumerate(ranking))
    both = f"min(struct(struct({order}) AS rank, struct({', '.join(payload)}) AS chosen)) AS best"
    per_feature = candidates.groupBy(*keys, "feature").agg(F.expr(both))
    return (
        per_feature.groupBy(*keys)
        .agg(F.expr("min(best) AS best"), F.expr("count(1) AS usable_features"))
        .selectExpr(*keys, "usable_features", "best.chosen.*")
    )
