import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.functions import hash_bucket
from tabloom.operators.metrics import auc
from tabloom.plans.gram import doubles, gram, gram_tiles
from tabloom.plans.logistic import first_time, fit_newton_logistic, fit_sgd_logistic


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(6)
    rows = []
    for i in range(500):
        a, b = rng.gauss(0, 2), rng.gauss(1, 1)
        rows.append((i, a, b, int(rng.random() < 1 / (1 + math.exp(-(0.5 + a - 2 * b))))))
    rows += [(501, None, 1.0, 1), (502, 1.0, float("nan"), 1), (503, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int").cache()


def points(frame):
    rows = [r for r in frame.collect() if r["a"] is not None and not math.isnan(r["b"]) and r["y"] is not None]
    return rows, np.array([[1.0, r["a"], r["b"]] for r in rows]), np.array([r["y"] for r in rows])


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("l2", [0.0, 3.0])
def test_newton_ends_where_the_gradient_is_zero(frame, l2, intercept):
    model = fit_newton_logistic(frame, ["a", "b"], "y", l2=l2, intercept=intercept)
    _, x, y = points(frame)
    w = np.array([model.intercept, *model.weights])
    slope = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + l2 * np.array([0, *model.weights])
    assert np.abs(slope[0 if intercept else 1 :]).max() < 1e-6
    assert model.iterations <= 10 and (intercept or model.intercept == 0)


def test_newton_on_separable_rows_with_a_penalty(spark):
    frame = spark.createDataFrame([(float(i), int(i > 5)) for i in range(12)], "a double, y int")
    model = fit_newton_logistic(frame, ["a"], "y", l2=0.01)
    assert model.score(frame).where("(prediction > 0.5) <> (y = 1)").count() == 0
    with pytest.raises(ValueError, match="no complete rows"):
        fit_newton_logistic(frame.where("false"), ["a"], "y")


def test_sgd_equals_the_loop_over_shards(spark, frame):
    shards, alpha, epochs = 3, 0.01, 2
    model = fit_sgd_logistic(frame.repartition(7), ["a", "b"], "y", "id", alpha=alpha, epochs=epochs, shards=shards)
    placed = frame.select("*", hash_bucket(F.col("id"), shards, "shard:").alias("shard"), F.md5(F.concat(F.lit("order:"), "id")).alias("turn"))
    rows, x, y = points(placed)
    start, seen = np.zeros(3), dict.fromkeys(range(shards), 0)
    for _ in range(epochs):
        parts = []
        for s in range(shards):
            w, order = start.copy(), sorted((r["turn"], i) for i, r in enumerate(rows) if r["shard"] == s)
            for k, (_, i) in enumerate(order):
                eta = 1 / (alpha * (first_time(alpha) + seen[s] + k))
                slope = 1 / (1 + math.exp(-(x[i] @ w))) - y[i]
                w[1:] *= 1 - eta * alpha
                w -= eta * slope * x[i]
            parts.append((w, len(order)))
            seen[s] += len(order)
        start = sum(w * n for w, n in parts) / sum(n for _, n in parts)
    assert [model.intercept, *model.weights] == pytest.approx(start.tolist(), abs=1e-9)
    assert auc(model.score(frame), "y", "prediction").first()["auc"] > 0.85
    with pytest.raises(ValueError, match="no complete rows"):
        fit_sgd_logistic(frame.where("false"), ["a"], "y", "id")


def test_tiles_add_up(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 7))
    rows = doubles(spark.createDataFrame(x.tolist(), [f"v{i}" for i in range(7)]).repartition(4), [f"v{i}" for i in range(7)])
    sides = lambda z: (z, z[:, :5])
    assert np.allclose(gram(rows, sides, (7, 5)), x.T @ x[:, :5])
    assert np.allclose(gram(rows, sides, (7, 5), few_cells=0, tile=3), x.T @ x[:, :5])
    tiles = gram_tiles(rows, sides, (7, 5), tile=3).collect()
    assert len(tiles) == 6 and max(len(t["block"]) for t in tiles) == 72
    assert (gram(rows.where("false"), sides, (7, 5)) == 0).all()
