import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import MELON_FEATURES
from tabloom.operators import criteria, ordered
from tabloom.operators.ordered import add_slices, histogram, lay_out
from tabloom.plans.boosting import fit_stump_booster
from tabloom.plans.tree_model import Node, Tree
from tabloom.plans.trees import (
    fit_category_tree,
    fit_class_tree,
    fit_regression_tree,
    fit_tree,
    fit_tree_depths,
)

# fixed values: root gains and gain ratios of the melon table
GAIN = {"wenli": 0.380592, "qibu": 0.289159, "gendi": 0.142675, "qiaosheng": 0.140781, "seze": 0.108125, "chugan": 0.006046}
RATIO = {"wenli": 0.263085, "qibu": 0.186727, "qiaosheng": 0.105627, "gendi": 0.101759, "seze": 0.068440, "chugan": 0.006918}
DENSITY = [0.403, 0.556, 0.481, 0.666, 0.243, 0.437, 0.634, 0.556, 0.593, 0.774, 0.343, 0.639, 0.657, 0.666, 0.608, 0.719, 0.697]


def test_melon_gains(spark, melon):
    counts = criteria.melt_text(melon, MELON_FEATURES, ["haogua"]).groupBy("feature", "value").agg(
        *criteria.class_measures(F.col("haogua"), [0, 1], F.lit(1.0))
    )
    for row in criteria.category_gains(counts, [], 2).collect():
        name = MELON_FEATURES[row["feature"]]
        assert row["gain"] == pytest.approx(GAIN[name], abs=1e-6)
        assert row["gain_ratio"] == pytest.approx(RATIO[name], abs=1e-6)


@pytest.mark.parametrize("method", ["ID3", "C4.5"])
def test_melon_tree_fits_and_splits_over_all_categories(spark, melon, method):
    tree = fit_category_tree(melon, MELON_FEATURES, "haogua", method, 0.01)
    assert {n.feature for n in tree.children(tree.root)} == {"wenli"}
    wrong = tree.score(melon).filter("prediction <> haogua").count()
    assert wrong <= 1  # rows 8 and 15 differ only in one feature below the delta
    empty = [n for n in tree.nodes if n.n == 0]
    parents = {n.node_id: n for n in tree.nodes}
    assert empty and all(n.prediction == parents[n.parent_id].prediction for n in empty)
    assert sum(n.n for n in tree.leaves()) == 17


def test_unseen_category_scores_null_or_the_fallback(spark, melon):
    tree = fit_category_tree(melon, MELON_FEATURES, "haogua", "ID3", 0.01)
    strange = melon.limit(1).withColumn("wenli", F.lit(9))
    assert tree.score(strange).first()["prediction"] is None
    assert tree.score(strange, fallback=tree.leaf_majority()).first()["prediction"] in (0, 1)


def test_missing_category_is_refused(spark, melon):
    holes = melon.withColumn("seze", F.when(F.col("id") != 3, F.col("seze")))
    with pytest.raises(ValueError, match="sum to 1"):
        fit_category_tree(holes, MELON_FEATURES, "haogua")


def brute_gini(rows, features, digits=4):
    """(gini, feature, threshold) of the best split by trying every candidate."""
    best = None
    for i, f in enumerate(features):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            t = float(f"{round((a + b) / 2 * 10**digits)}") / 10**digits
            sides = [[r["y"] for r in rows if r[f] <= t], [r["y"] for r in rows if r[f] > t]]
            if not all(sides):
                continue
            g = sum(len(s) * (1 - sum((s.count(c) / len(s)) ** 2 for c in (0, 1))) for s in sides) / len(rows)
            key = (round(g, 12), i, t)
            best = key if best is None or key < best else best
    return best


@pytest.mark.parametrize("decimals", [0, 2, 6])
@pytest.mark.parametrize("wide", [False, True])
def test_best_gini_split_equals_brute_force(spark, decimals, wide, monkeypatch):
    if wide:
        monkeypatch.setattr(ordered, "SMALL_DOMAIN", 5)
        monkeypatch.setattr(ordered, "SLICES", 8)
    generator = random.Random(decimals)
    scale = 0.004 if decimals == 6 else 50  # six decimals: midpoints often leave their interval
    rows = [
        {"a": round(generator.random() * scale, decimals), "b": float(generator.randint(0, 9)), "y": generator.randint(0, 1)}
        for _ in range(120)
    ]
    frame = spark.createDataFrame(rows, "a double, b double, y int")
    layout = lay_out(frame, ["a", "b"])
    assert layout.sliced == wide and layout.coarse == (decimals < 6)
    melted = criteria.melt_numeric(add_slices(frame, layout), ["a", "b"], ["y"], layout)
    counted = histogram(melted, [], layout, criteria.class_measures(F.col("y"), [0, 1], F.lit(1.0)))
    table = criteria.gini_candidates(counted, [], 2, layout=layout)
    row = criteria.best_per_node(table, [], ["gini", "feature", "threshold"], ["gini", "feature", "threshold"]).first()
    assert (row["gini"], row["feature"], row["threshold"]) == pytest.approx(brute_gini(rows, ["a", "b"]), abs=1e-10)


def test_class_tree_on_density(spark, melon):
    density = spark.createDataFrame(list(enumerate(DENSITY, start=1)), "id int, density double")
    rows = melon.join(density, "id")
    tree = fit_class_tree(rows, ["density", "wenli", "chugan"], "haogua", max_depth=4)
    assert tree.root.n == 17
    for node in tree.nodes:
        below = tree.children(node)
        assert not below or sum(c.n for c in below) == node.n


@pytest.mark.parametrize("low, high", [(0.7999999999999999, 0.8), (0.8, 0.8000000000000002), (0.1 + 0.2, 0.3)])
def test_near_equal_doubles_are_counted_as_they_are_routed(spark, low, high):
    rows = [(low, 0, 0.0)] * 50 + [(high, 1, 10.0)] * 50 + [(3.0, 1, 20.0)] * 7
    frame = spark.createDataFrame(rows, "x double, y int, z double")
    tree = fit_class_tree(frame, ["x"], "y", max_depth=2)
    assert_routed(frame, tree)
    assert_routed(frame, fit_regression_tree(frame, ["x"], "z", max_depth=2))


def assert_routed(frame, tree):
    """Every node counts the rows that its rules, from the root on, send to it."""
    by_id = {n.node_id: n for n in tree.nodes}
    for node in tree.nodes:
        path, rules = node, []
        while path.parent_id is not None:
            rules.append(path.condition_sql())
            path = by_id[path.parent_id]
        assert frame.filter(" AND ".join(rules) or "true").count() == node.n


def test_near_equal_doubles_do_not_fool_a_stump(spark):
    for low, high in ((0.7999999999999999, 0.8), (0.8, 0.8000000000000002)):
        frame = spark.createDataFrame([(low, 0)] * 50 + [(high, 1)] * 50, "x double, y int")
        booster = fit_stump_booster(frame, ["x"], "y", rounds=1)
        stump = booster.table(spark).first()
        if stump is not None:  # else the rounded threshold tells them not apart, and no stump is taken
            wrong = booster.score(frame, "p").filter("p <> y").count() / 100
            assert stump["error"] == pytest.approx(wrong, abs=1e-9)


def test_slices_hold_even_shares_of_distinct_values(spark):
    frame = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 20 > 0, 0.0).otherwise(F.col("id").cast("double")).alias("x")
    )
    layout = lay_out(frame, ["x"], slices=16, small_domain=100)
    sizes = add_slices(frame, layout).groupBy("slice_0").agg(F.countDistinct("x").alias("n")).collect()
    assert len(sizes) >= 14 and max(r["n"] for r in sizes) <= 2 * 2001 / 16


def noisy(spark, rows=400, parts=4):
    return spark.range(0, rows, 1, parts).select(
        "id",
        (F.col("id") % 17).cast("double").alias("a"),
        ((F.col("id") * 7) % 23 / 10).alias("b"),
        ((F.col("id") * 13) % 101 / 7).alias("c"),
        F.when((F.col("id") % 17 > 8) & ((F.col("id") * 7) % 23 > 6), 1).otherwise(0).alias("y"),
        ((F.col("id") % 17) * 3 + ((F.col("id") * 7) % 23) / 5).alias("z"),
    )


def test_trees_do_not_depend_on_partitions_or_slices(spark, monkeypatch):
    features = ["a", "b", "c"]
    class_one = fit_class_tree(noisy(spark, parts=1), features, "y", max_depth=3).nodes
    target_one = fit_regression_tree(noisy(spark, parts=1), features, "z", max_depth=3).nodes
    assert fit_class_tree(noisy(spark, parts=7), features, "y", max_depth=3).nodes == class_one
    monkeypatch.setattr(ordered, "SMALL_DOMAIN", 5)
    monkeypatch.setattr(ordered, "SLICES", 6)
    assert fit_class_tree(noisy(spark), features, "y", max_depth=3).nodes == class_one
    assert fit_regression_tree(noisy(spark), features, "z", max_depth=3).nodes == target_one


def test_folding_equal_rows_changes_nothing(spark, monkeypatch):
    from tabloom.plans import compact

    features = ["a", "b"]
    monkeypatch.setattr(compact, "FOLD_RATIO", 0.0)
    plain = fit_regression_tree(noisy(spark), features, "z", max_depth=3).nodes
    plain_class = fit_class_tree(noisy(spark), features, "y", max_depth=3).nodes
    monkeypatch.setattr(compact, "FOLD_RATIO", 1e9)
    folded = fit_regression_tree(noisy(spark), features, "z", max_depth=3).nodes
    assert [(n.rule, n.n) for n in folded] == [(n.rule, n.n) for n in plain]
    assert [n.prediction for n in folded] == pytest.approx([n.prediction for n in plain], abs=1e-7)
    assert fit_class_tree(noisy(spark), features, "y", max_depth=3).nodes == plain_class


def test_binned_candidates_agree_with_their_own_routing(spark):
    rows = noisy(spark)
    tree = fit_class_tree(rows, ["a", "b", "c"], "y", max_depth=3, max_bins=8)
    placed = rows.withColumn("p", tree.column())
    counts = {n.node_id: n.n for n in tree.nodes}
    for node in tree.nodes[1:]:
        path, at = [], node
        while at.parent_id is not None:
            path.append(at.condition_sql())
            at = next(n for n in tree.nodes if n.node_id == at.parent_id)
        assert placed.filter(" AND ".join(path)).count() == counts[node.node_id]


def test_stop_rules(spark):
    rows = noisy(spark)
    assert len(fit_class_tree(rows, ["a", "b"], "y", max_depth=0).nodes) == 1
    assert max(n.depth for n in fit_class_tree(rows, ["a", "b"], "y", max_depth=1).nodes) == 1
    assert len(fit_class_tree(rows, ["a", "b"], "y", min_samples_split=401).nodes) == 1
    assert len(fit_class_tree(rows, ["a", "b"], "y", min_samples_leaf=399).nodes) == 1
    assert len(fit_class_tree(rows, ["a"], "y", max_depth=5, min_features_left=1).nodes) == 3
    sure = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)], "a double, y int")
    assert len(fit_class_tree(sure, ["a"], "y").nodes) == 3
    assert len(fit_class_tree(sure, ["a"], "y", impurity_of="split").nodes) == 1
    flat = spark.createDataFrame([(float(i), 2.5) for i in range(10)], "a double, z double")
    assert fit_regression_tree(flat, ["a"], "z").root.prediction == 2.5


def test_depth_family_is_one_tree(spark):
    rows = noisy(spark)
    family = fit_tree_depths(rows, ["a", "b"], "y", [1, 2])
    assert family[1].nodes == fit_class_tree(rows, ["a", "b"], "y", max_depth=1).nodes
    assert family[2].nodes == fit_class_tree(rows, ["a", "b"], "y", max_depth=2).nodes


def test_missing_values_match_no_rule(spark):
    tree = Tree([Node(1, None, 0, None, None, None, 0, 3), Node(2, 1, 1, "a", "<=", 1.0, 0, 1), Node(3, 1, 1, "a", ">", 1.0, 1, 2)])
    rows = spark.createDataFrame([(0.5,), (2.0,), (None,)], "a double")
    assert [r["prediction"] for r in tree.score(rows).collect()] == [0, 1, None]
    assert [r["prediction"] for r in tree.score(rows, fallback=0).collect()] == [0, 1, 0]


def test_nan_is_a_missing_value(spark):
    rows = [(float(i), int(i > 4)) for i in range(10)] + [(float("nan"), 0), (None, 0)]
    frame = spark.createDataFrame(rows, "a double, y int")
    tree = fit_class_tree(frame, ["a"], "y")
    assert [(n.rule, n.n) for n in tree.nodes] == [(None, 12), ("a <= 4.5", 5), ("a > 4.5", 5)]


def test_names_the_fits_use_are_refused(spark):
    frame = spark.createDataFrame([(1.0, 0), (2.0, 1)], "node double, y int")
    with pytest.raises(ValueError, match="rename"):
        fit_class_tree(frame, ["node"], "y")


def test_wrong_parameters_are_refused(spark, melon):
    with pytest.raises(ValueError):
        fit_tree(melon, MELON_FEATURES, "haogua", "ranking")
    with pytest.raises(ValueError):
        fit_category_tree(melon, MELON_FEATURES, "haogua", "CART")
    with pytest.raises(ValueError):
        fit_class_tree(melon, ["seze"], "haogua", max_bins=1)


def test_wide_category_tree_takes_few_jobs(spark):
    frame = spark.range(1500).selectExpr(
        "concat('a', id % 40) AS a", "concat('b', (id * 7) % 37) AS b", "concat('c', (id * 11) % 41) AS c",
        "CAST((id * 2654435761) % 97 > 48 AS INT) AS y",
    )
    started = time.time()
    tree = fit_category_tree(frame, ["a", "b", "c"], "y", "ID3", 0.0)
    assert len(tree.nodes) > 1000 and time.time() - started < 60
    for node in tree.nodes[:50]:
        below = tree.children(node)
        assert not below or sum(c.n for c in below) == node.n
