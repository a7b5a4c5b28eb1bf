"""Recorded predictions on the public Titanic and Boston housing tables.

The tables are not part of this repository. Point TABLOOM_GOLDEN_DIR at a folder that
holds them and the recorded prediction files; files are told apart by their columns.
"""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tabloom.functions.encode import fit_one_hot
from tabloom.operators import metrics
from tabloom.plans.boosting import fit_stump_booster, fit_tree_booster
from tabloom.plans.trees import fit_class_tree, fit_regression_tree

FOLDER = os.environ.get("TABLOOM_GOLDEN_DIR")
pytestmark = pytest.mark.skipif(not FOLDER, reason="TABLOOM_GOLDEN_DIR not set")

CATEGORIES = ["Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "Embarked"]


def files_with(columns):
    found = []
    for path in sorted(Path(FOLDER).rglob("*.csv")):
        with open(path) as handle:
            if handle.readline().strip().split(",") == columns:
                found.append(path)
    return found


def read(spark, path):
    return spark.read.csv(str(path), header=True, inferSchema=True)


@pytest.fixture(scope="module")
def titanic(spark):
    train = read(spark, files_with(["Survived", *CATEGORIES])[0]).coalesce(1)
    # row numbers in file order: the file is one split
    train = train.withColumn("row", F.monotonically_increasing_id()).cache()
    test = read(spark, files_with(CATEGORIES)[0]).coalesce(1)
    test = test.withColumn("PassengerId", F.monotonically_increasing_id() + 892)
    encoder = fit_one_hot(train, CATEGORIES, null_dummy=False)
    return encoder.apply(train).cache(), encoder.apply(test).cache(), encoder.new_columns()


def titanic_matches(spark, scored):
    """Rows equal to each recorded prediction file, best first."""
    equal = []
    for path in files_with(["PassengerId", "Survived"]):
        recorded = read(spark, path)
        equal.append(recorded.join(scored, "PassengerId").filter("Survived = prediction").count())
    return sorted(equal, reverse=True)


def test_first_stumps(titanic):
    train, _, features = titanic
    stumps = fit_stump_booster(train, features, "Survived", rounds=3).stumps
    assert [(s.feature, s.polarity) for s in stumps] == [("Sex_1", -1), ("Pclass_3", -1), ("Embarked_1", -1)]
    assert [s.error for s in stumps] == pytest.approx([0.213244, 0.318552, 0.428659], abs=1e-6)
    assert [s.alpha for s in stumps] == pytest.approx([0.652742, 0.380216, 0.143662], abs=1e-6)


def test_one_stump_predictions(spark, titanic):
    train, test, features = titanic
    booster = fit_stump_booster(train, features, "Survived", rounds=1)
    assert titanic_matches(spark, booster.score(test))[:2] == [418, 418]


def test_class_tree_predictions(spark, titanic):
    train, test, features = titanic
    for impurity_of in ("node", "split"):
        tree = fit_class_tree(
            train, features, "Survived", max_depth=5, min_samples_split=5, min_samples_leaf=2, impurity_of=impurity_of
        )
        assert titanic_matches(spark, tree.score(test))[0] == 418


def test_boosting_on_the_sixty_percent_split(spark, titanic):
    import numpy as np

    train, test, features = titanic
    held = np.random.RandomState(0).permutation(891)[:357].tolist()
    rows = train.withColumn("held", F.col("row").isin(held))
    booster = fit_stump_booster(rows.filter("NOT held"), features, "Survived", rounds=100)
    scored = booster.score(rows.filter("held"))
    assert metrics.auc(scored, "Survived", "prediction").first()["auc"] == pytest.approx(0.7678, abs=5e-5)
    assert metrics.accuracy(scored, "Survived", "prediction").first()["error"] == pytest.approx(77 / 357, abs=1e-9)
    assert titanic_matches(spark, booster.score(test))[0] >= 417


@pytest.fixture(scope="module")
def housing(spark):
    tables = {}
    for path in Path(FOLDER).rglob("*.csv"):
        frame = read(spark, path)
        if "lstat" in frame.columns:
            tables["medv" in frame.columns] = frame
    encoder = fit_one_hot(tables[True], ["rad"], null_dummy=False)
    train, test = encoder.apply(tables[True]).cache(), encoder.apply(tables[False]).cache()
    return train, test, [c for c in train.columns if c not in ("ID", "medv")]


def housing_gap(spark, scored):
    """Largest difference to the nearest recorded prediction file."""
    gaps = []
    for path in files_with(["ID", "medv"]):
        joined = read(spark, path).join(scored.select("ID", "prediction"), "ID")
        row = joined.agg(F.max(F.abs(F.col("medv") - F.col("prediction"))).alias("gap"), F.count("*").alias("n")).first()
        gaps.append(row["gap"] if row["n"] == 173 else float("inf"))
    return min(gaps)


def test_regression_tree_predictions(spark, housing):
    train, test, features = housing
    tree = fit_regression_tree(train, features, "medv", max_depth=5, min_samples_split=5, min_samples_leaf=2)
    assert tree.children(tree.root)[0].rule == "rm <= 6.945"
    assert housing_gap(spark, tree.score(test)) < 1e-8


def test_gradient_boosting_predictions(spark, housing):
    train, test, features = housing
    booster = fit_tree_booster(train, features, "medv", rounds=30, max_depth=5)
    losses = [booster.losses[i - 1] for i in (1, 5, 10, 20, 30)]
    assert losses == pytest.approx([2269.367653, 491.653115, 185.542143, 10.379124, 0.990628], abs=1e-5)
    assert housing_gap(spark, booster.score(test)) < 1e-9
