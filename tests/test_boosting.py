import math

import pytest
from pyspark.sql import functions as F

from tabloom.plans.boosting import (
    STEPS,
    best_step,
    error_curve,
    fit_stump_booster,
    fit_tree_booster,
    signed,
    step_losses,
)
from test_trees import noisy


def naive_stumps(rows, features, rounds):
    """Stump boosting by trying every cut with explicit weights."""
    weights = [1 / len(rows)] * len(rows)
    found = []
    for _ in range(rounds):
        best = None
        for i, f in enumerate(features):
            values = sorted({r[f] for r in rows})
            for a, b in zip(values, values[1:]):
                t = round(round((a + b) / 2 * 1e8) / 1e8, 8)
                for polarity in (1, -1):
                    e = sum(w for r, w in zip(rows, weights) if (polarity if r[f] >= t else -polarity) != r["s"])
                    key = (round(e, 12), i, t, -polarity)
                    best = key if best is None or key < best else best
        e, i, t, polarity = best[0], best[1], best[2], -best[3]
        alpha = 0.5 * math.log((1 - e) / e)
        votes = [polarity if r[features[i]] >= t else -polarity for r in rows]
        weights = [w * math.exp(-alpha * r["s"] * v) for r, w, v in zip(rows, weights, votes)]
        weights = [w / sum(weights) for w in weights]
        found.append((features[i], t, polarity, e, alpha))
    return found, weights


def test_stumps_equal_the_naive_loop(spark):
    frame = signed(noisy(spark), "y")
    rows = [r.asDict() | {"s": r["sign"]} for r in frame.collect()]
    expected, weights = naive_stumps(rows, ["a", "b", "c"], 5)
    booster = fit_stump_booster(frame, ["a", "b", "c"], "y", rounds=5)
    for stump, (feature, t, polarity, error, alpha) in zip(booster.stumps, expected, strict=True):
        assert (stump.feature, stump.polarity) == (feature, polarity)
        assert (stump.threshold, stump.error, stump.alpha) == pytest.approx((t, error, alpha), abs=1e-9)
    kept = frame.select("id", (booster.weight() / len(rows)).alias("w")).orderBy("id").collect()
    assert [r["w"] for r in kept] == pytest.approx([w for _, w in sorted(zip([r["id"] for r in rows], weights))], abs=1e-9)


def test_binned_stumps_say_what_they_do_to_the_rows(spark):
    frame = spark.range(3000).selectExpr("id", "CAST(id * 7919 % 3000 AS double) a", "CAST(id % 11 AS double) b")
    frame = frame.selectExpr("*", "IF((a > 1203 AND b > 4) OR a % 10 = 0, 1, 0) y")
    booster = fit_stump_booster(frame, ["a", "b"], "y", rounds=5, max_bins=16)
    assert {s.feature for s in booster.stumps} == {"a", "b"}
    first = booster.stumps[0]
    wrong = frame.filter(booster.vote(1) != F.col("y")).count() / 3000
    assert first.error == pytest.approx(wrong)
    rows = signed(frame, "y").select((booster.weight() / 3000).alias("w"))
    assert rows.agg(F.sum("w")).first()[0] == pytest.approx(1)
    exact = fit_stump_booster(frame, ["a", "b"], "y", rounds=5)
    assert exact.stumps[0].error <= first.error + 1e-9 <= exact.stumps[0].error + 0.03


def test_error_curve_is_the_error_of_each_prefix(spark):
    frame = noisy(spark)
    booster = fit_stump_booster(frame, ["a", "b"], "y", rounds=4)
    for row in error_curve(frame, "y", booster).collect():
        wrong = frame.filter(booster.vote(row["round"]) != F.col("y")).count()
        assert row["error"] == pytest.approx(wrong / 400)


def test_boosting_stops_after_a_perfect_stump(spark):
    frame = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "a double, y int")
    booster = fit_stump_booster(frame, ["a"], "y", rounds=10)
    assert len(booster.stumps) == 1 and booster.stumps[0].error == 0
    assert booster.score(frame).filter("prediction <> y").count() == 0


def test_step_grid_equals_direct_losses(spark):
    frame = spark.createDataFrame([(3.0, 1.0), (-2.0, -1.5), (4.0, 1.0)], "r double, f double")
    losses = step_losses(frame, F.col("r"), F.col("f"), F.lit(1.0), F.lit(0.0))
    direct = [sum((r - p * f) ** 2 for r, f in ((3, 1), (-2, -1.5), (4, 1))) for p in STEPS]
    assert losses == pytest.approx(direct)
    assert best_step(losses) == min(range(90), key=lambda i: direct[i])
    assert best_step([2.0, 1.0, 1.0, 3.0]) == 2


def test_tree_booster_lowers_the_loss_with_unit_steps(spark):
    frame = noisy(spark)
    booster = fit_tree_booster(frame, ["a", "b", "c"], "z", rounds=7, max_depth=2)
    assert set(round(s, 6) for s in booster.steps) == {1.0}
    assert list(booster.losses) == sorted(booster.losses, reverse=True)
    scored = booster.score(frame)
    loss = scored.agg(F.sum((F.col("z") - F.col("prediction")) ** 2)).first()[0]
    assert loss == pytest.approx(booster.losses[-1], rel=1e-6)
    assert booster.table(spark).select("round").distinct().count() == 7


def test_unknown_loss_is_refused(spark):
    with pytest.raises(ValueError):
        fit_tree_booster(noisy(spark), ["a"], "z", loss="hinge")
