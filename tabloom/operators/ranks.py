"""Exact values at given ranks, by brackets that are narrowed around them.

A sketch of every column, from one pass, gives values between which a rank must lie up to the sketch's error. A second
pass counts what is below, between and above the brackets, and the values inside them one by one; equal values are
combined before the shuffle, so what moves is a few thousandths of the distinct values. The counts tell whether a rank
is inside its bracket: a bracket that misses it is moved, one that holds more than ``MOST_INSIDE`` rows is narrowed by a
sketch of its own rows, and the pass is repeated. No column is ever sorted or shuffled whole.

Nulls take no part; NaN is larger than any number, as Spark sorts it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions import quoted

ACCURACY = 1_000
MOST_INSIDE = 1_000_000
NARROWINGS = 6  # each leaves some thousandths of a bracket; ties may leave more, and are few values then


def order(value: float) -> tuple[bool, float]:
    """Sorts like Spark: NaN last."""
    return math.isnan(value), 0.0 if math.isnan(value) else value


def probes(share: float) -> tuple[float, float]:
    """Shares between which a sketch's error can move a share."""
    return max(0.0, share - 2 / ACCURACY), min(1.0, share + 2 / ACCURACY)


def sketch(x: Column, shares: Sequence[float]) -> Column:
    """Approximate values at both probes of every share."""
    asked = [p for s in shares for p in probes(s)]
    return F.percentile_approx(x, F.array(*[F.lit(p) for p in asked]), F.lit(ACCURACY))


def merged(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, overlapping ones joined."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(brackets, key=lambda b: (order(b[0]), order(b[1]))):
        if out and order(low) <= order(out[-1][1]):
            out[-1] = out[-1][0], max(out[-1][1], high, key=order)
        else:
            out.append((low, high))
    return out


def _place(x: Column, brackets: Sequence[tuple[float, float]]) -> Column:
    """Odd inside a bracket, even between them."""
    found = F.when(F.lit(False), 0)
    for k, (low, high) in enumerate(brackets):
        found = found.when(x < F.lit(low), 2 * k).when(x <= F.lit(high), 2 * k + 1)
    return found.otherwise(2 * len(brackets))


def values_at(
    frame: DataFrame, columns: Sequence[str], ranks: Mapping[int, Sequence[int]],
    brackets: Mapping[tuple[int, int], tuple[float, float]], ends: Mapping[int, tuple[float, float]],
) -> dict[tuple[int, int], float]:
    """The values at 0-based ``ranks`` of each column (by position), from a first bracket for each (column, rank) and
    the columns' least and largest values."""
    current, found, passes = dict(brackets), {}, 0
    number = [F.col(quoted(c)).cast("double") for c in columns]
    spark = frame.sparkSession
    while missing := [(i, r) for i in ranks for r in ranks[i] if (i, r) not in found]:
        passes += 1
        inside = {i: merged([current[i, r] for j, r in missing if j == i]) for i in {i for i, _ in missing}}
        cells = [
            F.struct(F.lit(i).alias("feature"), (place := _place(number[i], some)).alias("place"),
                     F.when(place % 2 == 1, number[i]).alias("x"), number[i].isNotNull().alias("given"))
            for i, some in inside.items()
        ]
        rows = frame.select(F.inline(F.array(*cells))).where("given")
        counted = rows.groupBy("feature", "place", "x").agg(F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sizes = {(r["feature"], r["place"]): r["n"] for r in counted.groupBy("feature", "place").agg(F.sum("n").alias("n")).collect()}
            wanted = []
            for i, rank in missing:
                before, place = 0, 0
                while before + sizes.get((i, place), 0) <= rank:
                    before += sizes.get((i, place), 0)
                    place += 1
                some = inside[i]
                if place % 2 == 0:  # the bracket missed the rank: it is between two others
                    low = some[place // 2 - 1][1] if place else ends[i][0]
                    high = some[place // 2][0] if place // 2 < len(some) else ends[i][1]
                    current[i, rank] = low, high
                elif sizes[i, place] > MOST_INSIDE and passes <= NARROWINGS and some[place // 2][0] != some[place // 2][1]:
                    current[i, rank] = _narrowed(frame, number[i], some[place // 2], (rank - before) / sizes[i, place])
                else:
                    wanted.append((i, place, rank, rank - before))
            if wanted:
                asked = F.broadcast(spark.createDataFrame(wanted, "feature int, place int, rank long, inner long"))
                upto = F.sum("n").over(Window.partitionBy("feature", "place").orderBy("x"))
                kept = counted.join(F.broadcast(asked.select("feature", "place").distinct()), ["feature", "place"])
                running = kept.withColumn("upto", upto).join(asked, ["feature", "place"]).where("upto > inner")
                for r in running.groupBy("feature", "rank").agg(F.min("x").alias("x")).collect():
                    found[r["feature"], r["rank"]] = r["x"]
        finally:
            counted.unpersist()
    return found


def _narrowed(frame: DataFrame, x: Column, bracket: tuple[float, float], share: float) -> tuple[float, float]:
    rows = frame.select(x.alias("x")).where((F.col("x") >= F.lit(bracket[0])) & (F.col("x") <= F.lit(bracket[1])))
    return tuple(rows.agg(sketch(F.col("x"), [share]).alias("s")).first()["s"])
