"""Reading and writing tables, and tables made from rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions import nan_to_null, quoted, weighted_sum


def read_parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A headed CSV file. Give the schema for large files: without it Spark reads twice.

    NaN becomes NULL, so a missing value never compares as a large number.
    """
    reader = spark.read.option("header", True)
    frame = reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return nan_to_null(frame)


def write_csv(frame: DataFrame, path: str) -> None:
    """A folder of headed CSV parts without an index column, written by all tasks."""
    frame.write.option("header", True).mode("overwrite").csv(path)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small table spelled out in the program."""
    return spark.createDataFrame(list(rows), schema)


def uniform(key: Column, stream: str, low: float, high: float) -> Column:
    """A uniform value that depends on the row's key only, so a retried task repeats it."""
    head = F.conv(F.substring(F.md5(F.concat(F.lit(stream), key.cast("string"))), 1, 8), 16, 10)
    return head.cast("double") / F.lit(4294967296.0) * F.lit(high - low) + F.lit(low)


def separable_points(keys: DataFrame, key: str, weights: Sequence[float], gap: float = 0.0) -> DataFrame:
    """One point per key: features uniform in [-10, 10), label -1 where w.x <= 0, else +1.

    With a ``gap`` every point is moved away from the plane by so many times the weights, to its own side."""
    names = [f"x{i + 1}" for i in range(len(weights))]
    points = keys.select(
        F.col(quoted(key)).alias("row_id"),
        *[uniform(F.col(quoted(key)), f"{name}:", -10.0, 10.0).alias(name) for name in names],
    )
    dot = weighted_sum(names, weights)
    points = points.withColumn("label", F.when(dot <= 0, -1).otherwise(1))
    if not gap:
        return points
    return points.withColumns(
        {name: F.col(name) + F.col("label") * F.lit(gap * w) for name, w in zip(names, weights)}
    )


def binary_subset(frame: DataFrame, features: Sequence[str], label: str, negative, positive) -> DataFrame:
    """The rows of two classes with the named features; the label becomes -1 and +1."""
    value = F.col(quoted(label))
    return frame.filter(value.isin(negative, positive)).select(
        *[F.col(quoted(f)) for f in features],
        F.when(value == F.lit(negative), -1).otherwise(1).alias("label"),
    )


def submission(scored: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Key and prediction; the key travels with the row and is never made up afterwards."""
    return scored.select(F.col(quoted(key)), value.alias(name))


def fill_submission(sample: DataFrame, key: str, target: str, scored: DataFrame, value: str) -> DataFrame:
    """Put predictions in a sample submission: its keys and columns, the new values."""
    predictions = scored.select(quoted(key), F.col(quoted(value)).alias("filled_value"))
    kept: Mapping[str, Column] = {c: F.col(quoted(c)) for c in sample.columns if c != target}
    return sample.join(predictions, key, "left").select(*kept.values(), F.col("filled_value").alias(target))
