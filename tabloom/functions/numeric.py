"""Scalar expressions shared by the fits and the scorers; all stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def half_even(value: Column, digits: int) -> Column:
    """Round half to even the way NumPy does: scale, nearest integer, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def softplus(z: Column) -> Column:
    """ln(1 + e^z) without overflow; the log loss of a row is softplus(z) - y z."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def entropy_term(share: Column) -> Column:
    """-p log2 p, with the limit value 0 at p = 0."""
    return F.when(share > 0, -share * F.log2(share)).otherwise(F.lit(0.0))


def weighted_sum(columns: Sequence[str], weights: Sequence[float], intercept: float = 0.0) -> Column:
    """Dot product of named columns with fixed weights, added left to right."""
    total = F.lit(float(intercept))
    for name, weight in zip(columns, weights, strict=True):
        total = total + F.col(name) * F.lit(float(weight))
    return total


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """A bucket 0..buckets-1 from the key's md5: same for any row order or engine."""
    text = F.concat(F.lit(salt), key.cast("string")) if salt else key.cast("string")
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return (head % F.lit(buckets)).cast("int")


def nan_to_null(frame: DataFrame) -> DataFrame:
    """Replace NaN by NULL: Spark sorts NaN above every number, a missing value must not."""
    floating = {f.name for f in frame.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return frame.select(
        *[
            F.when(~F.isnan(F.col(quoted(c))), F.col(quoted(c))).alias(c) if c in floating else F.col(quoted(c))
            for c in frame.columns
        ]
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def double_sql(value: float) -> str:
    """The value as a SQL double literal that reads back to the same bits."""
    return f"{float(value)!r}D"
