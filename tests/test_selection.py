import pytest
from pyspark.sql import functions as F

from tabloom.plans.learners import ForestLearner, GbtLearner, RegressionTreeLearner, fit_model, gbt_params
from tabloom.operators.folds import stratified_folds
from tabloom.plans.selection import cross_validated, draw, stack_binary, stack_multi
from test_trees import noisy


@pytest.mark.parametrize("stratified", [False, True])
def test_out_of_fold_scores_cover_each_row_once(spark, stratified):
    frame = noisy(spark)
    learner = RegressionTreeLearner({"max_depth": 2})
    result = stack_binary(
        frame.filter("id < 300"), frame.filter("id >= 300"), ["a", "b"], "y", "id", learner, folds=3, stratified=stratified
    )
    ids = [r["id"] for r in result.oof.collect()]
    assert sorted(ids) == list(range(300))
    assert result.test.count() == 100 and result.test.filter("score IS NULL").count() == 0
    assert sorted(r["fold"] for r in result.metrics.collect()) == [0, 1, 2, 3]
    assert result.importances.count() == 6


def test_a_fold_is_scored_by_the_model_of_the_others(spark):
    frame = noisy(spark)
    learner = RegressionTreeLearner({"max_depth": 2})
    result = stack_binary(frame, frame, ["a", "b"], "y", "id", learner, folds=2)
    folds = {r["id"]: r["fold"] for r in result.oof.collect()}
    other = learner.fit(frame.filter(F.col("id").isin([i for i, f in folds.items() if f == 1])), ["a", "b"], "y")
    expected = {r["id"]: r["s"] for r in frame.select("id", other.column().alias("s")).collect()}
    for row in result.oof.filter("fold = 0").collect():
        assert row["score"] == pytest.approx(expected[row["id"]], abs=1e-9)


def test_library_learners_stack_too(spark):
    frame = noisy(spark)
    binary = stack_binary(
        frame.filter("id < 300"), frame.filter("id >= 300"), ["a", "b"], "y", "id",
        GbtLearner({"n_estimators": 2, "max_depth": 2, "random_state": 1}), folds=2,
    )
    assert binary.oof.count() == 300 and binary.test.filter("score BETWEEN 0 AND 1").count() == 100
    kinds = frame.withColumn("kind", (F.col("id") % 17 / 6).cast("int"))
    multi = stack_multi(
        kinds.filter("id < 300"), kinds.filter("id >= 300"), ["a", "b"], "kind", "id",
        ForestLearner({"numTrees": 3, "maxDepth": 3, "seed": 1}), classes=3, folds=2,
    )
    shares = multi.test.select(F.aggregate("score", F.lit(0.0), lambda a, b: a + b).alias("sum")).collect()
    assert [r["sum"] for r in shares] == pytest.approx([1.0] * 100)
    assert multi.oof.filter("predicted = kind").count() > 200


def test_settings_stay_in_their_space():
    settings = draw({"max_depth": (5, 8), "gamma": (0.0, 2.0)}, 20, 666)
    assert settings == draw({"max_depth": (5, 8), "gamma": (0.0, 2.0)}, 20, 666)
    assert {s["max_depth"] for s in settings} <= {5, 6, 7, 8} and all(0 <= s["gamma"] <= 2 for s in settings)


def test_parameters_without_a_counterpart_are_refused():
    assert gbt_params({"n_estimators": 5, "gamma": 0.1}) == {"maxIter": 5, "minInfoGain": 0.1}
    with pytest.raises(ValueError, match="num_leaves"):
        gbt_params({"num_leaves": 31})


def test_learners_by_name(spark):
    frame = noisy(spark)
    for name, options in (("binary", {}), ("regression", {}), ("adaboost", {"rounds": 2}), ("linear", {}), ("logistic", {"rounds": 2})):
        assert "prediction" in fit_model(frame, ["a", "b"], "y", name, **options).score(frame).columns
    with pytest.raises(ValueError):
        fit_model(frame, ["a"], "y", "knn")


def test_stratified_folds_keep_every_row_and_column(spark):
    frame = spark.createDataFrame(
        [(i if i % 9 else None, "a" if i % 3 else None, i, i, i) for i in range(100)],
        "id int, y string, place int, prefix int, digest int",
    )
    dealt = stratified_folds(frame, "id", "y", 4)
    assert dealt.columns == [*frame.columns, "fold"]
    assert sorted(r["place"] for r in dealt.collect()) == list(range(100))
    assert dealt.filter("place <> prefix OR prefix <> digest").count() == 0
    sizes = {(r["y"], r["fold"]): r["count"] for r in dealt.groupBy("y", "fold").count().collect()}
    for y in ("a", None):
        own = [n for (label, _), n in sizes.items() if label == y]
        assert max(own) - min(own) <= 1 and len(own) == 4


def test_folds_without_a_metric_are_an_error(spark):
    frame = spark.range(60).select("id", F.col("id").cast("double").alias("x"), (F.col("id") == 7).cast("int").alias("y"))
    learner = GbtLearner({"n_estimators": 1, "max_depth": 1, "random_state": 1})
    with pytest.raises(ValueError, match="no value in folds"):
        cross_validated(frame, ["x"], "y", "id", learner, folds=3)
