import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators import metrics, ordered, stats

# fixed values: worked F1 example
TRUTH = [1, 1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 4, 4]
GUESS = [1, 1, 1, 0, 0, 2, 2, 3, 3, 3, 4, 3, 4, 3]


@pytest.fixture(scope="module")
def example(spark):
    return spark.createDataFrame(list(zip(TRUTH, GUESS)), "y int, p int")


def test_worked_f1_example(example):
    counts = {r["class"]: (r["tp"], r["fp"], r["fn"]) for r in metrics.confusion(example, "y", "p").collect()}
    assert counts == {"0": (0, 2, 0), "1": (3, 0, 2), "2": (2, 0, 2), "3": (2, 3, 1), "4": (1, 1, 1)}
    only = [1, 2, 3, 4]
    pooled = metrics.f1_micro(example, "y", "p", classes=only).first()
    assert (pooled["precision"], pooled["recall"], pooled["f1"]) == pytest.approx((8 / 12, 8 / 14, 0.615385), abs=1e-5)
    assert metrics.f1_macro(example, "y", "p", classes=only).first()["f1"] == pytest.approx(0.6041667, abs=1e-6)
    assert metrics.f1_micro(example, "y", "p").first()["f1"] == pytest.approx(0.5714, abs=1e-4)
    assert metrics.f1_macro(example, "y", "p").first()["f1"] == pytest.approx(0.4833, abs=1e-4)


@pytest.mark.parametrize("wide", [False, True])
def test_auc_counts_ordered_pairs(spark, wide, monkeypatch):
    if wide:
        monkeypatch.setattr(ordered, "SMALL_DOMAIN", 5)
        monkeypatch.setattr(ordered, "SLICES", 7)
    generator = random.Random(3)
    rows = [(generator.randint(0, 1), generator.randint(0, 40) / 40) for _ in range(200)]
    pairs = [(p > n) + 0.5 * (p == n) for a, p in rows if a for b, n in rows if not b]
    frame = spark.createDataFrame(rows, "y int, s double")
    assert metrics.auc(frame, "y", "s").first()["auc"] == pytest.approx(sum(pairs) / len(pairs), abs=1e-12)


def test_auc_of_one_class_is_missing(spark):
    frame = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert metrics.auc(frame, "y", "s").first()["auc"] is None


@pytest.mark.parametrize("wide", [False, True])
def test_quartiles_are_exact(spark, wide, monkeypatch):
    import numpy as np

    if wide:
        monkeypatch.setattr(ordered, "SMALL_DOMAIN", 5)
        monkeypatch.setattr(ordered, "SLICES", 9)
    generator = random.Random(5)
    values = [round(generator.gauss(10, 4), 3) for _ in range(777)]
    row = stats.describe(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert [row["q25"], row["q50"], row["q75"]] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert (row["count"], row["min"], row["max"]) == (777, min(values), max(values))
    assert (row["mean"], row["std"]) == pytest.approx((np.mean(values), np.std(values, ddof=1)))


def test_own_metric_joins_the_registry(example):
    metrics.register_metric("misses", lambda f, y, p, keys=(): f.groupBy(*keys).agg(F.expr(f"count_if({y} <> {p}) AS misses")), "misses", False)
    try:
        row = metrics.evaluate(example, "y", "p", "misses").first()
        assert (row["name"], row["value"], row["higher_is_better"]) == ("misses", 6, False)
    finally:
        del metrics.METRICS["misses"]
    with pytest.raises(ValueError):
        metrics.evaluate(example, "y", "p", "misses")


def test_missing_prediction_counts_as_an_error(spark):
    frame = spark.createDataFrame([(1, 1), (0, None)], "y int, p int")
    assert tuple(metrics.accuracy(frame, "y", "p").first()) == (0.5, 0.5)


def test_metrics_by_key_equal_metrics_of_the_parts(spark):
    generator = random.Random(9)
    rows = [(i % 3, generator.randint(0, 1), generator.randint(0, 9) / 9) for i in range(150)]
    frame = spark.createDataFrame(rows, "part int, y int, s double").withColumn("p", (F.col("s") > 0.5).cast("int"))
    for name, column in (("auc", "s"), ("f1_macro", "p"), ("f1_micro", "p"), ("error", "p"), ("rmse", "s")):
        together = {r["part"]: r["value"] for r in metrics.evaluate(frame, "y", column, name, ["part"]).collect()}
        for part in range(3):
            alone = metrics.evaluate(frame.filter(F.col("part") == part), "y", column, name).first()["value"]
            assert together[part] == pytest.approx(alone, abs=1e-12)
