import math
import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators.folds import fold_of
from tabloom.plans import newton
from tabloom.plans.newton import BoostParams, fit_fold_boosters, fit_newton_booster
from tabloom.plans.selection import search_boosters, stack_boosters

FEATURES = ["a", "b", "c"]


def table(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.choice([None, 0.0, 1.0, 2.0, 3.0, 7.0]), float(rng.randint(0, 30)), rng.choice([1.5, 2.5, None])
        y = int(((a or 0) > 1) != (b > 12)) if rng.random() < 0.85 else rng.randint(0, 1)
        kind = rng.choice("pqr") if rng.random() < 0.2 else "p" if b > 20 else "q" if (a or 0) > 2 else "r"
        rows.append((i, a, b, c, y, kind))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(table(), "id long, a double, b double, c double, y int, kind string").cache()


def naive(rows, params, classes=None):
    """The same boosting row by row: margins of every row, trees best leaf first."""
    low = lambda v: -math.inf if v is None else v
    xs = [[low(r[1]), low(r[2]), low(r[3])] for r in rows]
    targets = [[r[4] for r in rows]] if classes is None else [[int(r[5] == k) for r in rows] for k in classes]
    shares = [sum(t) / len(t) for t in targets]
    starts = [math.log(shares[0] / (1 - shares[0]))] if classes is None else [math.log(s) for s in shares]
    margins = [[s] * len(rows) for s in starts]

    def cut_of(here, g, h):
        best = None
        worth = lambda G, H: max(abs(G) - params.reg_alpha, 0) ** 2 / (H + params.reg_lambda)
        G, H = sum(g[i] for i in here), sum(h[i] for i in here)
        for f in range(3):
            for x in sorted({xs[i][f] for i in here})[:-1]:
                left = [i for i in here if xs[i][f] <= x]
                right = [i for i in here if xs[i][f] > x]
                gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                gain = worth(gl, hl) + worth(G - gl, H - hl) - worth(G, H)
                allowed = min(len(left), len(right)) >= params.min_child_samples and min(hl, H - hl) >= params.min_child_weight
                if allowed and gain > params.min_split_gain and (best is None or round(gain, 6) > round(best[0], 6)):
                    best = gain, left, right
        return best

    for _ in range(params.n_estimators):
        ps = []
        for i in range(len(rows)):
            if classes is None:
                ps.append([1 / (1 + math.exp(-margins[0][i]))])
            else:
                top = [math.exp(m[i]) for m in margins]
                ps.append([t / sum(top) for t in top])
        for k, target in enumerate(targets):
            g = [p[k] - t for p, t in zip(ps, target)]
            h = [p[k] * (1 - p[k]) for p in ps]
            leaves = [(1, 0, list(range(len(rows))))]
            while len(leaves) < params.num_leaves:
                able = [(c[0], -path, depth, here, c) for path, depth, here in leaves
                        if depth < params.deepest and (c := cut_of(here, g, h))]
                if not able:
                    break
                _, path, depth, here, (_, left, right) = max(able, key=lambda x: (round(x[0], 6), x[1]))
                leaves = [x for x in leaves if x[0] != -path]
                leaves += [(-2 * path, depth + 1, left), (-2 * path + 1, depth + 1, right)]
            for _, _, here in leaves:
                if len(leaves) > 1:
                    step = params.leaf(sum(g[i] for i in here), sum(h[i] for i in here))
                    for i in here:
                        margins[k][i] += step
    if classes is None:
        return {r[0]: 1 / (1 + math.exp(-m)) for r, m in zip(rows, margins[0])}
    return {r[0]: [math.exp(m[i]) / sum(math.exp(o[i]) for o in margins) for m in margins] for i, r in enumerate(rows)}


SETTINGS = [
    dict(n_estimators=4, num_leaves=5, learning_rate=0.3, min_child_samples=10),
    dict(n_estimators=3, num_leaves=6, max_depth=2, learning_rate=0.5, reg_lambda=2.0, reg_alpha=1.5, min_child_samples=5),
    dict(n_estimators=2, num_leaves=31, learning_rate=0.5, min_child_weight=6.0, min_split_gain=2.0, min_child_samples=1),
]


@pytest.mark.parametrize("settings", SETTINGS)
def test_equals_the_naive_booster(frame, settings):
    scored = fit_newton_booster(frame, FEATURES, "y", **settings).score(frame)
    expected = naive(table(), BoostParams(**settings))
    assert {r["id"]: r["prediction"] for r in scored.collect()} == pytest.approx(expected, abs=1e-9)


def test_classes_share_a_softmax(frame):
    settings = dict(n_estimators=3, num_leaves=4, learning_rate=0.4, reg_lambda=1.0, min_child_samples=8)
    model = fit_newton_booster(frame, FEATURES, "kind", "multiclass", **settings)
    assert model.labels == ("p", "q", "r")
    expected = naive(table(), BoostParams(**settings), "pqr")
    for r in model.score(frame).collect():
        assert r["prediction"] == pytest.approx(expected[r["id"]], abs=1e-9)


def dealt(frame, folds=3):
    return frame.withColumn("fold", fold_of(F.col("id"), folds))


def test_folds_and_settings_in_step_equal_single_fits(frame, monkeypatch):
    settings = [dict(n_estimators=5, num_leaves=4, learning_rate=0.6, early_stopping_rounds=2),
                dict(n_estimators=3, num_leaves=3, learning_rate=0.3)]
    rows = dealt(frame)
    alone = [
        [fit_newton_booster(rows, FEATURES, "y", held_out=F.col("fold") == k, **s) for k in range(3)] for s in settings
    ]
    monkeypatch.setattr(newton, "ROUNDS_PER_CHECKPOINT", 2)
    passes = []
    monkeypatch.setattr(newton, "_pass", lambda *a, run=newton._pass: passes.append(a[-1]) or run(*a))
    together = fit_fold_boosters(rows, FEATURES, "y", 3, settings, "binary")
    for some, others in zip(alone, together):
        for one, other in zip(some, others):
            assert [[(t.feature, t.cut, t.n) for t in r] for r in one.rounds] == [[(t.feature, t.cut, t.n) for t in r] for r in other.rounds]
            for r, s in zip(one.rounds, other.rounds):
                assert r[0].value == pytest.approx(s[0].value)
            assert one.history == pytest.approx(other.history)
    # a round takes about as many passes as its deepest tree has levels, whatever the number of models
    assert max(passes.count(k) for k in set(passes)) <= 4


def test_stops_at_the_best_round(frame):
    rows = dealt(frame)
    models = fit_fold_boosters(
        rows, FEATURES, "y", 3, [dict(n_estimators=30, num_leaves=8, learning_rate=1.0, early_stopping_rounds=3, min_child_samples=2)],
        "binary",
    )[0]
    for m in models:
        best = max(m.history)
        assert m.history[len(m.rounds) - 1] == pytest.approx(best) and len(m.history) <= len(m.rounds) + 3
    assert any(len(m.history) < 30 for m in models)


def test_samples_are_drawn_by_key_and_columns_by_round(frame):
    settings = dict(n_estimators=3, num_leaves=4, min_child_samples=5)
    fit = lambda **more: fit_newton_booster(frame, FEATURES, "y", key="id", **settings, **more)
    half, again, whole = fit(subsample=0.5), fit(subsample=0.5), fit()
    assert half == again and half != whole
    sizes = [r[0].n[0] for r in half.rounds]
    assert all(120 < n < 280 for n in sizes) and len(set(sizes)) > 1
    assert whole.rounds[0][0].n[0] == 400
    one = fit(colsample_bytree=0.34)
    used = [{f for f in r[0].feature if f >= 0} for r in one.rounds]
    assert all(len(u) <= 1 for u in used)
    assert len({tuple(BoostParams(colsample_bytree=0.34).features(3, k)) for k in range(20)}) == 3


def test_quantile_bins_for_wide_columns(frame):
    model = fit_newton_booster(frame, FEATURES, "y", max_bin=8, n_estimators=2, num_leaves=4)
    assert len(model.edges[1]) <= 8 and len(model.edges[0]) == 4
    assert model.importances().keys() <= set(FEATURES)


def test_missing_names_labels_and_values(spark, frame):
    odd = frame.withColumn("_x0", F.lit(1)).withColumn("_m0", F.lit(2)).withColumn("b", F.when(F.col("id") % 9 == 0, float("nan")).otherwise(F.col("b")))
    model = fit_newton_booster(odd, FEATURES, "y", n_estimators=2, num_leaves=3)
    scored = model.score(odd, "p")
    assert scored.columns == [*odd.columns, "p"] and scored.where("p IS NULL OR p <= 0 OR p >= 1").count() == 0
    nothing = frame.withColumn("y", F.lit(None).cast("int"))
    with pytest.raises(ValueError, match="no labelled rows"):
        fit_newton_booster(nothing, FEATURES, "y")
    with pytest.raises(ValueError):
        fit_newton_booster(frame, FEATURES, "y", "ranking")
    with pytest.raises(ValueError):
        BoostParams(num_leaves=1)
    flat = frame.withColumn("y", F.lit(1)).unionByName(frame.withColumn("y", F.lit(0)))
    assert fit_newton_booster(flat, ["b"], "y", n_estimators=2).rounds == ()


def test_stack_and_search(spark, frame):
    train, test = frame.where("id < 300"), frame.where("id >= 300").drop("y", "kind")
    options = dict(n_estimators=6, num_leaves=4, learning_rate=0.5, early_stopping_rounds=2, min_child_samples=5)
    stack = stack_boosters(train, test, FEATURES, "y", "id", folds=3, **options)
    assert stack.oof.count() == 300 and stack.oof.where("score IS NULL").count() == 0
    assert stack.test.count() == 100
    assert {r["fold"] for r in stack.metrics.collect()} == {0, 1, 2, 3}
    assert stack.rounds(spark).where("best").count() == 3
    assert stack.importances.count() == 9
    multi = stack_boosters(train, test, FEATURES, "kind", "id", objective="multiclass", folds=2, **options)
    row = multi.oof.first()
    assert sum(row["score"]) == pytest.approx(1) and row["predicted"] in "pqr"
    assert len(multi.test.first()["score"]) == 3
    found = {r["trial"]: r["value"] for r in search_boosters(
        frame, FEATURES, "y", "id", [dict(max_depth=1, n_estimators=2), dict(max_depth=3, n_estimators=2)], folds=2
    ).collect()}
    assert found[2] > found[1] + 0.1
