"""Running totals along an ordered column, without one task holding a whole group.

Split search, AUC and exact quantiles all need "the sum over every smaller value".
A window over (group) alone would send all distinct values of a column through one
task.  Columns with many distinct values are therefore cut into slices at fixed
boundaries: the window runs inside (group, slice), and the totals of earlier slices,
a table of at most groups x slices rows, are added.  The boundaries are plain numbers
fixed before the job starts, so a retried task always sees the same slices.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions import quoted

SMALL_DOMAIN = 20_000
# at least SLICES slices, and more so that a slice holds about VALUES_PER_SLICE values
SLICES, MAX_SLICES, VALUES_PER_SLICE = 128, 8192, 1_000_000
LARGEST_COARSE = 1e12  # from here on neighbouring doubles come near 0.001 apart
INFINITY = float("inf")


@dataclass(frozen=True)
class Layout:
    """How a set of columns is worked on: size, estimated distinct counts, slices.

    ``three_decimals`` says per column that every value is the double next to a number of
    three decimals, and below ``LARGEST_COARSE``.  Then neighbours are 0.001 apart or more,
    and a midpoint rounded to four decimals or finer stays strictly between them.  ``snapped`` columns hold slice boundaries instead of their own values.
    """

    columns: tuple[str, ...]
    rows: int
    distinct: tuple[int, ...]
    boundaries: tuple[tuple[float, ...], ...]
    three_decimals: tuple[bool, ...]
    snapped: tuple[int, ...] = ()

    @property
    def coarse(self) -> bool:
        """Every candidate threshold lies between the two values it comes from."""
        return all(fine or i in self.snapped for i, fine in enumerate(self.three_decimals))

    @property
    def sliced(self) -> bool:
        return any(self.boundaries)

    @property
    def slice_column(self) -> str | None:
        return "slice" if self.sliced else None

    @property
    def combinations(self) -> float:
        """Upper estimate of the distinct rows over the columns."""
        product = 1.0
        for count in self.distinct:
            product *= max(count, 1)
        return product

    def slice_of(self, position: int) -> Column:
        """The slice of a column's value in a table that went through ``add_slices``."""
        return F.expr(self.slice_sql(position))

    def slice_sql(self, position: int) -> str:
        # never null, so no null filter on one side of a join keeps two scans from being one
        return f"coalesce(slice_{position}, -1)" if self.boundaries[position] else "0"

    def slice_names(self) -> list[str]:
        return [f"slice_{i}" for i, points in enumerate(self.boundaries) if points]


def lay_out(
    frame: DataFrame, columns: Sequence[str], *, slices: int | None = None, small_domain: int | None = None
) -> Layout:
    """One pass for sizes; a second, over the wide columns alone, for their quantiles."""
    small_domain = small_domain or SMALL_DOMAIN
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        x = f"CAST({quoted(name)} AS DOUBLE)"
        fine = f"rint({x} * 1000D) / 1000D = {x} AND abs({x}) < {LARGEST_COARSE!r}D"
        aggregates.append(F.approx_count_distinct(quoted(name)).alias(f"d{i}"))
        aggregates.append(F.expr(f"bool_and({fine})").alias(f"g{i}"))
    row = frame.agg(*aggregates).first()
    distinct = tuple(int(row[f"d{i}"]) for i in range(len(columns)))
    boundaries: list[tuple[float, ...]] = [()] * len(columns)
    wide = [i for i, count in enumerate(distinct) if count > small_domain]
    if wide:
        needed = max(distinct[i] for i in wide) // VALUES_PER_SLICE
        slices = slices or max(SLICES, min(needed, MAX_SLICES))
        steps = [i / slices for i in range(1, slices)]
        # quantiles of the distinct values: a value that fills the table is one of them, so slices stay even
        pairs = ", ".join(f"struct({i} AS feature, CAST({quoted(columns[i])} AS DOUBLE) AS x)" for i in wide)
        values = frame.selectExpr(f"inline(array({pairs}))").filter("x IS NOT NULL").distinct()
        cuts = values.groupBy("feature").agg(F.percentile_approx("x", steps, max(10_000, 10 * slices)).alias("points"))
        for row_of in cuts.collect():
            boundaries[row_of["feature"]] = tuple(sorted({b for b in row_of["points"] if math.isfinite(b)}))
    three_decimals = tuple(row[f"g{i}"] is not False for i in range(len(columns)))
    return Layout(tuple(columns), int(row["rows"]), distinct, tuple(boundaries), three_decimals)


def add_slices(frame: DataFrame, layout: Layout) -> DataFrame:
    """Add ``slice_<i>`` for every wide column: how many boundaries are below the value.

    ``Bucketizer`` puts a boundary into the upper slice; its splits are the next larger
    doubles, so here the boundary closes the lower one.
    """
    names = layout.slice_names()
    if not names:
        return frame
    sliced = cutter(layout, [c for c, points in zip(layout.columns, layout.boundaries) if points], names)
    return sliced.transform(frame).withColumns({n: F.col(n).cast("int") for n in names})


def cutter(layout: Layout, inputs: Sequence[str], outputs: Sequence[str]) -> Bucketizer:
    splits = [[math.nextafter(b, INFINITY) for b in points] for points in layout.boundaries if points]
    return Bucketizer(
        inputCols=list(inputs),
        outputCols=list(outputs),
        splitsArray=[[-INFINITY, *points, INFINITY] for points in splits],
        handleInvalid="keep",
    )


def slice_melted(frame: DataFrame, layout: Layout, value: str) -> DataFrame:
    """Add ``slice`` to rows that carry a feature's position beside a number of its range."""
    names = layout.slice_names()
    cut = cutter(layout, [value] * len(names), names).transform(frame)
    positions = [i for i, points in enumerate(layout.boundaries) if points]
    choice = " ".join(f"WHEN {i} THEN CAST(slice_{i} AS INT)" for i in positions)
    return cut.selectExpr(*frame.columns, f"CASE feature {choice} ELSE 0 END AS slice")


def running_totals(
    frame: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    measures: Sequence[str],
    *,
    slice_column: str | None = None,
    by_slice: DataFrame | None = None,
    following: str | None = None,
) -> DataFrame:
    """Add ``<m>_upto`` (sum over the rows up to this one) and ``<m>_all`` per group.

    With ``following``, also the next row's first order column under that name.
    ``by_slice`` gives the measures and ``slice_head``, the smallest order value, per
    group and slice; without it they are summed from ``frame``.  Without
    ``slice_column`` the caller vouches that a group is small.
    """
    local = [*groups, slice_column] if slice_column else list(groups)
    part = f"PARTITION BY {', '.join(local)}" if local else ""
    whole = f"PARTITION BY {', '.join(groups)}" if groups else ""
    place = f"{part} ORDER BY {', '.join(order)}"
    upto = f"({place} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = [f"lead({order[0]}) OVER ({place}) AS {following}"] if following else []
    if slice_column is None:
        return frame.selectExpr(
            "*",
            *ahead,
            *[f"sum({m}) OVER {upto} AS {m}_upto" for m in measures],
            *[f"sum({m}) OVER ({whole}) AS {m}_all" for m in measures],
        )
    slices = f"{whole} ORDER BY {slice_column}"
    earlier = f"({slices} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    if by_slice is None:
        sums = [F.expr(f"sum({m}) AS {m}") for m in measures]
        by_slice = frame.groupBy(*local).agg(F.expr(f"min({order[0]}) AS slice_head"), *sums)
    offsets = by_slice.selectExpr(
        *local,
        f"lead(slice_head) OVER ({slices}) AS next_head",
        *[f"coalesce(sum({m}) OVER {earlier}, 0) AS {m}_before" for m in measures],
        *[f"sum({m}) OVER ({whole}) AS {m}_all" for m in measures],
    )
    inside = frame.selectExpr("*", *ahead, *[f"sum({m}) OVER {upto} AS {m}_inside" for m in measures])
    return inside.join(offsets, local).selectExpr(
        *frame.columns,
        *([f"coalesce({following}, next_head) AS {following}"] if following else []),
        *[f"{m}_before + {m}_inside AS {m}_upto" for m in measures],
        *[f"{m}_all" for m in measures],
    )


@dataclass(frozen=True)
class Histogram:
    """Measures per (keys, feature, value) and, for sliced layouts, per slice.

    The rows are melted and grouped once; the slice totals are rolled up from the values.
    """

    values: DataFrame
    by_slice: DataFrame | None


def histogram(melted: DataFrame, keys: Sequence[str], layout: Layout, measures: Sequence[Column]) -> Histogram:
    """Group melted rows (``feature``, ``x``, and ``slice`` where the layout has slices)."""
    if not layout.sliced:
        return Histogram(melted.groupBy(*keys, "feature", "x").agg(*measures), None)
    local = [*keys, "feature", "slice"]
    values = melted.groupBy(*local, "x").agg(*measures)
    names = [c for c in values.columns if c not in (*local, "x")]
    totals = [F.sum(n).alias(n) for n in names]
    return Histogram(values, values.groupBy(*local).agg(F.expr("min(x) AS slice_head"), *totals))
