"""Fill, bin, recode, encode and scale. ``fit_*`` reads statistics once and returns a
small object whose ``apply`` is a projection, so train and test get the same columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.functions import quoted
from tabloom.session import shared_dir

MAX_DUMMIES = 10_000
SMALL_DOMAIN = 100_000


def bin_upper(value: Column, edges: Sequence[float]) -> Column:
    """1-based bin with inclusive upper edges; above the last edge is the last bin."""
    bins = F.when(value <= F.lit(edges[0]), 1)
    for number, edge in enumerate(edges[1:], start=2):
        bins = bins.when(value <= F.lit(edge), number)
    return bins.when(value.isNotNull(), len(edges) + 1)


def recode(value: Column, mapping: Mapping, default: object = None) -> Column:
    """Replace values by a dictionary; anything else, null too, becomes ``default``."""
    chosen = None
    for old, new in mapping.items():
        here = value == F.lit(old)
        chosen = F.when(here, F.lit(new)) if chosen is None else chosen.when(here, F.lit(new))
    return chosen.otherwise(F.lit(default))


@dataclass(frozen=True)
class Fill:
    values: Mapping[str, object]

    def apply(self, frame: DataFrame) -> DataFrame:
        types = dict(frame.dtypes)
        return frame.select(
            *[
                F.coalesce(F.col(quoted(c)), F.lit(self.values[c]).cast(wider(types[c]))).alias(c)
                if c in self.values and self.values[c] is not None
                else F.col(quoted(c))
                for c in frame.columns
            ]
        )


def wider(kind: str) -> str:
    """A mean may be fractional: integer columns take it as double."""
    return "double" if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") else kind


def fit_fill(frame: DataFrame, rules: Mapping[str, str | float]) -> Fill:
    """``rules`` maps a column to 'mean', 'mode' or a constant. Statistics come from
    ``frame``: pass the training rows, or the union when test rows should count."""
    values: dict[str, object] = {c: r for c, r in rules.items() if r not in ("mean", "mode")}
    means = [c for c, r in rules.items() if r == "mean"]
    modes = [c for c, r in rules.items() if r == "mode"]
    if means:
        row = frame.agg(*[F.avg(quoted(c)).alias(f"m{i}") for i, c in enumerate(means)]).first()
        values.update({c: row[f"m{i}"] for i, c in enumerate(means)})
    if modes:  # one pass over all of them; values travel as text beside themselves
        pairs = [
            F.struct(F.lit(i).alias("place"), *[(F.col(quoted(c)) if i == j else F.lit(None)).alias(f"v{j}")
                                                for j, c in enumerate(modes)])
            for i, c in enumerate(modes)
        ]
        names = [f"v{j}" for j in range(len(modes))]
        counts = frame.select(F.inline(F.array(*pairs))).groupBy("place", *names).agg(F.count(F.lit(1)).alias("n"))
        counts = counts.filter(F.coalesce(*[F.col(v).cast("string") for v in names]).isNotNull())
        best = F.min(F.struct((-F.col("n")).alias("below"), *names)).alias("best")
        found = {r["place"]: r["best"] for r in counts.groupBy("place").agg(best).collect()}
        values.update({c: found[i][f"v{i}"] if i in found else None for i, c in enumerate(modes)})
    return Fill(values)


def mode_row(frame: DataFrame, column: str) -> DataFrame:
    """The most frequent value and its count; the smallest value wins ties."""
    counts = frame.filter(F.col(quoted(column)).isNotNull()).groupBy(F.col(quoted(column)).alias("value")).count()
    return counts.agg(
        F.min(F.struct((-F.col("count")).alias("below"), F.col("value"))).alias("best")
    ).select("best.value", (-F.col("best.below")).alias("count"))


@dataclass(frozen=True)
class OneHot:
    """Dummy columns ``<column>_<value>`` in value order, and ``<column>_nan`` if asked."""

    domains: Mapping[str, Sequence]
    null_dummy: bool

    def new_columns(self) -> list[str]:
        return [name for column in self.domains for name, _ in self.dummies(column)]

    def dummies(self, column: str) -> list[tuple[str, Column]]:
        value = F.col(quoted(column))
        found = [
            (f"{column}_{v}", F.when(value == F.lit(v), 1).otherwise(0)) for v in self.domains[column]
        ]
        if self.null_dummy:
            found.append((f"{column}_nan", F.when(value.isNull(), 1).otherwise(0)))
        return found

    def apply(self, frame: DataFrame) -> DataFrame:
        plain = [F.col(quoted(c)) for c in frame.columns if c not in self.domains]
        dummies = [flag.alias(name) for column in self.domains for name, flag in self.dummies(column)]
        return frame.select(*plain, *dummies)


def fit_one_hot(frame: DataFrame, columns: Sequence[str], null_dummy: bool = True) -> OneHot:
    """Collect each column's values, one column of the result per value, so they are few.

    One job for all columns: distinct values are combined in every task and grouped by column and value, so a column of
    many values is refused by their count before any of them are sent.
    """
    if not columns:
        return OneHot({}, null_dummy)
    names = [f"v{i}" for i in range(len(columns))]
    none = [F.lit(None).cast(frame.schema[c].dataType) for c in columns]
    cells = [
        F.struct(F.lit(i).alias("place"), *[(F.col(quoted(c)) if k == i else none[k]).alias(names[k]) for k in range(len(columns))])
        for i, c in enumerate(columns)
    ]
    values = frame.select(F.inline(F.array(*cells))).where(" OR ".join(f"{n} IS NOT NULL" for n in names)).distinct()
    values = values.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = {r["place"]: r["count"] for r in values.groupBy("place").count().collect()}
        for i, column in enumerate(columns):
            if sizes.get(i, 0) > MAX_DUMMIES:
                raise ValueError(f"{column} has more than {MAX_DUMMIES} values: bin or label-encode it")
        found = values.orderBy("place", *names).collect()
    finally:
        values.unpersist()
    domains = {c: [r[f"v{i}"] for r in found if r["place"] == i] for i, c in enumerate(columns)}
    return OneHot(domains, null_dummy)


def one_hot_encoder(frame: DataFrame, columns: Sequence[str], null_dummy: bool = True) -> tuple[DataFrame, list[str]]:
    """The encoded table and the names of its new columns."""
    encoder = fit_one_hot(frame, columns, null_dummy)
    return encoder.apply(frame), encoder.new_columns()


@dataclass(frozen=True)
class Scaler:
    """Z-score with the population deviation; a constant column is only centred."""

    mean: Mapping[str, float]
    deviation: Mapping[str, float]

    def apply(self, frame: DataFrame) -> DataFrame:
        return frame.select(
            *[
                ((F.col(quoted(c)) - F.lit(self.mean[c])) / F.lit(self.deviation[c] or 1.0)).alias(c)
                if c in self.mean
                else F.col(quoted(c))
                for c in frame.columns
            ]
        )


def fit_scaler(frame: DataFrame, columns: Sequence[str]) -> Scaler:
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [F.avg(quoted(c)).alias(f"m{i}"), F.stddev_pop(quoted(c)).alias(f"s{i}")]
    row = frame.agg(*aggregates).first()
    return Scaler(
        {c: row[f"m{i}"] for i, c in enumerate(columns)}, {c: row[f"s{i}"] for i, c in enumerate(columns)}
    )


def label_codes(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """(value, code): codes 0..k-1 over the sorted union of the column's values.

    A small domain is ranked in one window.  A large one is range partitioned and
    written to the shared folder, then ranked within each part plus the sizes of the
    parts before it, so no task sees the whole domain.
    """
    values = None
    for frame in frames:
        part = frame.select(F.col(quoted(column)).alias("value")).dropna().distinct()
        values = part if values is None else values.unionByName(part)
    values = values.distinct()
    size = values.agg(F.approx_count_distinct("value").alias("n")).first()["n"]
    if size <= SMALL_DOMAIN:
        return values.select("value", (F.dense_rank().over(Window.orderBy("value")) - 1).alias("code"))
    return ranked_by_parts(values, "value", "code")


def ranked_by_parts(values: DataFrame, column: str, code: str) -> DataFrame:
    """0-based rank of distinct values through range partitions."""
    shared_dir(values.sparkSession)
    # the checkpoint fixes which part a value is in; a sampled range may move on a retry
    parts = values.repartitionByRange(column).withColumn("part", F.spark_partition_id()).checkpoint()
    sizes = parts.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(column)) - 1
    return (
        parts.withColumn("inside", inside)
        .join(F.broadcast(offsets), "part")
        .select(column, (F.col("inside") + F.col("offset")).cast("int").alias(code))
    )


def label_encode(frame: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Replace a column by its code. The codes join by value; Spark broadcasts them when
    they are small and splits a skewed value when they are not."""
    codes = codes.select(F.col("value").alias("__value_to_encode"), F.col("code").alias("__code_of_value"))
    encoded = frame.join(codes, F.col(quoted(column)) == F.col("__value_to_encode"), "left")
    return encoded.select(
        *[F.col("__code_of_value").alias(c) if c == column else F.col(quoted(c)) for c in frame.columns]
    )


def text_columns(frame: DataFrame) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]


def date_parts(frame: DataFrame, column: str) -> DataFrame:
    """Replace a date or date text by integer Year, Month and weekday (Monday is 0)."""
    day = F.to_date(F.col(quoted(column)))
    return frame.select(
        *[F.col(quoted(c)) for c in frame.columns if c != column],
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.weekday(day).alias("weekday"),
    )


RULE = r"^(.*?) *(<=|>=|!=|>|<|=) *(.*)$"


def build_rule(feature: Column, op: Column, value: Column) -> Column:
    return F.concat_ws(" ", feature, op, value.cast("string"))


def parse_rule(rule: Column) -> tuple[Column, Column, Column]:
    """Feature, operator and value text of ``feature op value``."""
    return tuple(F.trim(F.regexp_extract(rule, RULE, k)) for k in (1, 2, 3))


def first_argmax(values: Column) -> Column:
    """0-based place of the largest array entry; the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
