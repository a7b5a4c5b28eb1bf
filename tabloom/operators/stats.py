"""Table statistics: counts, modes, profiles, constant columns, bindings and unions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions import quoted
from tabloom.operators.ranks import sketch, values_at


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """Value frequencies, most frequent first."""
    value = F.col(quoted(column))
    return (
        frame.filter(value.isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
    )


def null_profile(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: does it hold a null? All columns in one pass."""
    flags = frame.agg(*[F.bool_or(F.col(quoted(c)).isNull()).alias(f"f{i}") for i, c in enumerate(columns)])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"f{i}").alias("has_null")) for i, c in enumerate(columns)]
    return flags.select(F.inline(F.array(*pairs)))


def varying_columns(frame: DataFrame, label: str) -> list[str]:
    """Columns with more than one distinct value (null is a value); the label always stays.

    Minimum, maximum and the null count decide it, without a distinct count.
    """
    others = [c for c in frame.columns if c != label]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(others):
        value = F.col(quoted(c))
        aggregates += [
            (F.min(value) < F.max(value)).alias(f"v{i}"),
            F.count(value).alias(f"n{i}"),
        ]
    row = frame.agg(*aggregates).first()
    kept = {
        c for i, c in enumerate(others) if row[f"v{i}"] or 0 < row[f"n{i}"] < row["rows"]
    }
    return [c for c in frame.columns if c == label or c in kept]


def drop_constant(frame: DataFrame, label: str) -> DataFrame:
    return frame.select(*[quoted(c) for c in varying_columns(frame, label)])


QUARTILES = (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))


def describe(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, min, interpolated quartiles and max per column.

    Quartiles are exact: the values at their ranks are found in brackets around a sketch's
    guess, so a second pass moves a few thousandths of the distinct values and no column is
    sorted whole.
    """
    frame = frame.select(*[quoted(c) for c in columns])
    shares = [share for _, share in QUARTILES]
    sums = []
    for i, name in enumerate(columns):
        x = F.col(quoted(name)).cast("double")
        found = {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x), "min": F.min(x), "max": F.max(x)}
        found["guess"] = sketch(x, shares)
        sums.append(F.struct(*[v.alias(k) for k, v in found.items()]).alias(f"s{i}"))
    plain = [frame.agg(*sums).first()[f"s{i}"] for i in range(len(columns))] if columns else []
    ranks, brackets, ends = {}, {}, {}
    for i, row in enumerate(plain):
        if not row["count"]:
            continue
        ends[i] = row["min"], row["max"]
        for at, share in enumerate(shares):
            place = share * (row["count"] - 1)
            for rank in {math.floor(place), math.ceil(place)}:
                ranks.setdefault(i, []).append(rank)
                brackets[i, rank] = row["guess"][2 * at], row["guess"][2 * at + 1]
    ranks = {i: sorted(set(some)) for i, some in ranks.items()}
    values = values_at(frame, columns, ranks, brackets, ends)
    rows = []
    for i, (name, row) in enumerate(zip(columns, plain, strict=True)):
        quartiles = []
        for share in shares:
            place = share * (row["count"] - 1)
            if not row["count"]:
                quartiles.append(None)
                continue
            low, high = values[i, math.floor(place)], values[i, math.ceil(place)]
            quartiles.append(low + (high - low) * (place - math.floor(place)))
        rows.append((name, row["count"], row["mean"], row["std"], row["min"], *quartiles, row["max"]))
    names = ", ".join(f"{n} double" for n in ("mean", "std", "min", *(n for n, _ in QUARTILES), "max"))
    return frame.sparkSession.createDataFrame(rows, f"column string, count long, {names}")



def bind(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Put two tables side by side by key, every row of both kept: the column bind of tables without a row order."""
    return left.join(right, key, "full")


def union_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by column name, each row tagged with its part; absent columns are null."""
    whole = None
    for name, frame in parts.items():
        tagged = frame.withColumn(tag, F.lit(name))
        whole = tagged if whole is None else whole.unionByName(tagged, allowMissingColumns=True)
    return whole


def shape(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(frame.columns)).alias("columns"))


def mean_importance(table: DataFrame) -> DataFrame:
    """Mean importance per feature over folds."""
    return table.groupBy("feature").agg(F.avg("importance").alias("importance"))


def top_importance(table: DataFrame, top: int = 40) -> DataFrame:
    """The per-fold rows of the ``top`` features by mean importance."""
    best = mean_importance(table).orderBy(F.desc("importance"), "feature").limit(top).select("feature")
    return table.join(best, "feature", "left_semi")
