"""Every operator as a named query over the driver tables, beside the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions import half_even

MODULES = ("prep", "relations", "criteria", "trees", "boosting", "linear", "metrics", "selection", "newton", "logistic", "c45")


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``run(spark, folder)`` under a name, with its SQL equivalent if there is one."""

    def keep(run):
        if name in REGISTERED:
            raise ValueError(f"query {name} registered twice")
        REGISTERED[name] = Query(name, run, sql)
        return run

    return keep


def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"tabloom.catalog.{module}")
    return REGISTERED


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(value: Column, digits: int = 6) -> Column:
    """A double rounded for comparison between engines; never minus zero."""
    return half_even(value, digits) + F.lit(0.0)


# label and target planted in the tables, whose columns are otherwise unrelated noise
PLANTED_LABEL = (
    "CASE WHEN (l_quantity > 25 AND l_discount > 0.05) OR l_tax > 0.06 THEN 1 ELSE 0 END"
)
PLANTED_TARGET = "2 * l_quantity + 100 * l_discount - 50 * l_tax + l_extendedprice / 10000"
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem with the planted label ``y`` and target ``z``."""
    return table(spark, folder, "lineitem").withColumns(
        {"y": F.expr(PLANTED_LABEL), "z": F.expr(PLANTED_TARGET)}
    )


def events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """events where every tenth value and every seventh type is missing."""
    return table(spark, folder, "events").withColumns(
        {
            "value": F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END"),
            "event_type": F.expr("CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END"),
        }
    )


EVENTS_WITH_GAPS = """(SELECT event_id, ts, user_id,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS event_type FROM events)"""
