import math

import numpy as np
import pytest

from tabloom.plans import linear
from tabloom.sources.tables import separable_points


def test_collinear_columns_use_the_pseudo_inverse(spark):
    frame = spark.createDataFrame([(0.0, 0.0, 0.0), (3.0, 1.0, 1.0), (6.0, 2.0, 2.0)], "y double, x1 double, x2 double")
    model = linear.fit_normal_equation(frame, ["x1", "x2"], "y")
    assert [model.intercept, *model.weights] == pytest.approx([0.0, 1.5, 1.5], abs=1e-9)
    points = spark.createDataFrame([(float(i), float(2 * i - 1)) for i in range(1, 6)], "x1 double, x2 double")
    assert [r["prediction"] for r in model.score(points).collect()] == pytest.approx([3.0, 7.5, 12.0, 16.5, 21.0])


def line(spark):
    return spark.range(200).selectExpr("id", "(id % 20) / 20.0D AS a", "(id % 7) / 7.0D AS b").selectExpr(
        "id", "a", "b", "1 + 2 * a - 3 * b + (id % 3 - 1) / 10.0D AS y"
    )


def test_descent_reaches_the_normal_equation(spark):
    exact = linear.fit_normal_equation(line(spark), ["a", "b"], "y")
    walked = linear.fit_linear_descent(line(spark), ["a", "b"], "y", eta=0.5, delta=1e-14)
    assert not walked.diverged
    assert [walked.intercept, *walked.weights] == pytest.approx([exact.intercept, *exact.weights], abs=1e-4)


def test_diverging_descent_keeps_the_better_weights(spark):
    frame = spark.range(50).selectExpr("CAST(id AS DOUBLE) AS a", "id * 3.0D AS y")
    model = linear.fit_linear_descent(frame, ["a"], "y", eta=0.1)
    assert model.diverged and model.weights == (0.0,)


def naive_logistic(x, y, eta, rounds, l1, l2):
    w, costs = np.zeros(x.shape[1]), []
    for _ in range(rounds):
        used = w
        p = 1 / (1 + np.exp(-x @ used))
        penalty = l1 * np.abs(used).sum() + 0.5 * l2 * (used**2).sum()
        costs.append((-(y * np.log(p) + (1 - y) * np.log(1 - p)).sum() + penalty) / len(y))
        w = used - eta / len(y) * (x.T @ (p - y) + l1 * np.where(used >= 0, 1, -1) + l2 * used)
    return used, costs


def test_logistic_descent_equals_numpy(spark):
    frame = line(spark).selectExpr("a", "b", "CAST(y > 0.5 AS INT) AS y")
    rows = frame.collect()
    x, y = np.array([[r["a"], r["b"]] for r in rows]), np.array([r["y"] for r in rows])
    weights, costs = naive_logistic(x, y, 0.3, 6, 0.5, 0.7)
    fit = linear.fit_logistic(frame, ["a", "b"], "y", eta=0.3, rounds=6, l1=0.5, l2=0.7, test=frame)
    assert list(fit.model.weights) == pytest.approx(list(weights), abs=1e-10)
    assert [c for _, c, _ in fit.curve] == pytest.approx(costs, abs=1e-10)
    assert [c for _, _, c in fit.curve] == pytest.approx(costs, abs=1e-10)


def test_log_loss_stays_finite_for_sure_predictions(spark):
    frame = spark.createDataFrame([(1000.0, 0), (1000.0, 1)], "a double, y int")
    model = linear.LinearModel(("a",), 0.0, (1.0,), link="logit")
    assert linear.logistic_cost(frame, model, "y").first()["cost"] == pytest.approx(500.0)


def naive_perceptron(rows, limit):
    w, updates, i = [0.0, 0.0], 0, 0
    while i < len(rows) and updates < limit:
        x1, x2, s = rows[i]
        if s * (w[0] * x1 + w[1] * x2) <= 0:
            w, updates, i = [w[0] + s * x1, w[1] + s * x2], updates + 1, 0
        else:
            i += 1
    return w, updates


def test_perceptron_equals_the_restarting_loop(spark):
    points = separable_points(spark.range(100), "id", [2.0, 3.0])
    rows = [(r["x1"], r["x2"], r["label"]) for r in points.orderBy("row_id").collect()]
    assert all(-10 <= v < 10 for r in rows for v in r[:2])
    assert all(s == (-1 if 2 * a + 3 * b <= 0 else 1) for a, b, s in rows)
    weights, updates = naive_perceptron(rows, 500)
    model = linear.fit_perceptron(points, ["x1", "x2"], "label", "row_id", max_updates=500)
    assert model.separated and model.updates == updates
    assert list(model.weights) == pytest.approx(weights)
    assert model.score(points).filter("prediction <> label").count() == 0


@pytest.mark.parametrize("head", [1, 3, 1000])
def test_perceptron_does_not_depend_on_its_head(spark, head):
    points = separable_points(spark.range(300), "id", [2.0, 3.0], gap=0.01)
    rows = [(r["x1"], r["x2"], r["label"]) for r in points.orderBy("row_id").collect()]
    weights, updates = naive_perceptron(rows, 10_000)
    model = linear.fit_perceptron(points, ["x1", "x2"], "label", "row_id", head_rows=head)
    assert model.separated and model.updates == updates > 5
    assert model.weights == pytest.approx(weights, abs=1e-12)
    odd = points.unionByName(points.selectExpr("NULL AS row_id", "x1", "NULL AS x2", "label").limit(2))
    assert linear.fit_perceptron(odd, ["x1", "x2"], "label", "row_id", head_rows=head).weights == model.weights


def test_perceptron_gives_up_on_inseparable_rows(spark):
    frame = spark.createDataFrame([(1, 1.0, 1), (2, 1.0, -1)], "id int, a double, s int")
    model = linear.fit_perceptron(frame, ["a"], "s", "id", max_updates=7)
    assert not model.separated and model.updates == 7


def test_scoring_refuses_a_table_without_the_training_columns(spark):
    model = linear.LinearModel(("a", "b"), 0.0, (1.0, 1.0))
    with pytest.raises(ValueError, match="b"):
        model.score(spark.createDataFrame([(1.0,)], "a double"))
    assert math.isclose(model.score(line(spark)).first()["prediction"], 0.0)
