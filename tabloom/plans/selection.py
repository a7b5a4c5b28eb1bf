"""Out-of-fold stacking, parameter sweeps and searches.

A model that is an expression scores its fold and the test table in one projection
each: no join and no shuffle, however many folds there are.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.functions import quoted
from tabloom.operators.folds import fold_of, row_hash, stratified_folds
from tabloom.operators.metrics import evaluate
from tabloom.functions.encode import first_argmax
from tabloom.plans.learners import TreeScore
from tabloom.plans.newton import METRICS as STOPPING_METRICS, NewtonBooster, fit_fold_boosters, probabilities
from tabloom.plans.trees import fit_fold_trees, fit_tree_depths
from tabloom.session import in_parallel

@dataclass(frozen=True)
class Stacked:
    """Out-of-fold scores of the training rows, mean test scores, metrics, importances."""

    oof: DataFrame
    test: DataFrame
    metrics: DataFrame
    importances: DataFrame


@dataclass(frozen=True)
class BoosterStack(Stacked):
    """A stack of boosters that their own folds have stopped."""

    models: Sequence[NewtonBooster]

    def rounds(self, spark: SparkSession) -> DataFrame:
        """(fold, round, value, best): the held-out metric after every round of every fold's model."""
        rows = [
            (fold + 1, i, float(v), i == len(m.rounds)) for fold, m in enumerate(self.models) for i, v in enumerate(m.history, 1)
        ]
        return spark.createDataFrame(rows, "fold int, round int, value double, best boolean")


def with_folds(train: DataFrame, key: str, label: str, folds: int, stratified: bool) -> DataFrame:
    if stratified:
        return stratified_folds(train, key, label, folds)
    return train.withColumn("fold", fold_of(F.col(quoted(key)), folds, otherwise=row_hash(train)))


def importance_table(spark: SparkSession, models: Sequence, features: Sequence[str]) -> DataFrame:
    rows = []
    for fold, model in enumerate(models):
        found = model.importances()
        rows += [(f, float(found.get(f, 0.0)), fold + 1) for f in features]
    return spark.createDataFrame(rows, "feature string, importance double, fold int")


def fold_scores(train: DataFrame, models: Sequence, keep: Sequence[str]) -> DataFrame:
    """Each training row scored by the model that did not see its fold."""
    if all(hasattr(m, "column") for m in models):
        score = None
        for fold, model in enumerate(models):
            here = F.col("fold") == fold
            score = F.when(here, model.column()) if score is None else score.when(here, model.column())
        return train.select(*[quoted(c) for c in keep], "fold", score.alias("score"))
    parts = None
    for fold, model in enumerate(models):
        part = model.score(train.filter(F.col("fold") == fold), "score").select(
            *[quoted(c) for c in keep], "fold", "score"
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def mean_scores(test: DataFrame, models: Sequence, key: str) -> DataFrame:
    """The test rows with the mean of the fold models' scores."""
    if all(hasattr(m, "column") for m in models):
        total: Column = models[0].column()
        for model in models[1:]:
            total = total + model.column()
        return test.select(quoted(key), (total / len(models)).alias("score"))
    names = [f"score_{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        test = model.score(test, name)
    return test.select(quoted(key), *names)


def average_columns(scored: DataFrame, key: str, arrays: bool) -> DataFrame:
    names = [c for c in scored.columns if c.startswith("score_")]
    if not names:
        return scored
    if not arrays:
        total = F.col(names[0])
        for name in names[1:]:
            total = total + F.col(name)
        return scored.select(quoted(key), (total / len(names)).alias("score"))
    total = F.col(names[0])
    for name in names[1:]:
        total = F.zip_with(total, F.col(name), lambda a, b: a + b)
    return scored.select(quoted(key), F.transform(total, lambda a: a / len(names)).alias("score"))


def fold_metrics(oof: DataFrame, label: str, prediction: str, metric: str) -> DataFrame:
    """The metric per fold (1..k), from one grouped evaluation, and over all rows (fold 0)."""
    whole = evaluate(oof, label, prediction, metric).select(F.lit(0).alias("fold"), "name", "value")
    parts = evaluate(oof, label, prediction, metric, ["fold"]).select((F.col("fold") + 1).alias("fold"), "name", "value")
    return whole.unionByName(parts)


def fold_models(train: DataFrame, features: Sequence[str], label: str, learner, folds: int) -> list:
    """One model per fold, fitted on the other folds."""
    if hasattr(learner, "fit_folds"):
        return learner.fit_folds(train, features, label, folds)
    return in_parallel(
        train.sparkSession,
        [
            lambda fold=fold: learner.fit(train.filter(F.col("fold") != fold), features, label)
            for fold in range(folds)
        ],
    )


def stack_binary(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    learner,
    *,
    folds: int = 5,
    stratified: bool = False,
    metric: str = "auc",
) -> Stacked:
    """Fit one model per fold on the other folds; score the fold and the test table."""
    train = with_folds(train, key, label, folds, stratified)
    models = fold_models(train, features, label, learner, folds)
    oof = fold_scores(train, models, [key, label])
    scored = average_columns(mean_scores(test, models, key), key, arrays=False)
    return Stacked(
        oof,
        scored,
        fold_metrics(oof, label, "score", metric),
        importance_table(train.sparkSession, models, features),
    )


@dataclass(frozen=True)
class OneTreePerClass:
    """One model per class on the class indicator; the score is an array in class order."""

    models: Sequence

    def column(self) -> Column:
        return F.array(*[m.column() for m in self.models])

    def importances(self) -> dict[str, float]:
        total: dict[str, float] = {}
        for model in self.models:
            for feature, value in model.importances().items():
                total[feature] = total.get(feature, 0.0) + value
        return total


@dataclass(frozen=True)
class PerClassTrees:
    """One regression tree per class indicator and fold; all share one prepared table."""

    options: Mapping
    classes: Sequence

    def fit_folds(self, train: DataFrame, features: Sequence[str], label: str, folds: int) -> list[OneTreePerClass]:
        grown = fit_fold_trees(train, features, label, folds, list(self.classes), **self.options)
        return [OneTreePerClass([TreeScore(tree) for tree in trees]) for trees in grown]


def stack_multi(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    learner,
    *,
    classes: int,
    folds: int = 5,
    stratified: bool = False,
    metric: str = "f1_macro",
) -> Stacked:
    """As ``stack_binary`` for labels 0..classes-1: scores are arrays over the classes, the
    test scores their mean over the folds."""
    train = with_folds(train, key, label, folds, stratified)
    models = fold_models(train, features, label, learner, folds)
    oof = fold_scores(train, models, [key, label]).withColumn("predicted", first_argmax(F.col("score")))
    if all(hasattr(m, "column") for m in models):
        means = []
        for k in range(classes):
            total = F.get(models[0].column(), F.lit(k))
            for model in models[1:]:
                total = total + F.get(model.column(), F.lit(k))
            means.append(total / folds)
        scored = test.select(quoted(key), F.array(*means).alias("score"))
    else:
        scored = average_columns(mean_scores(test, models, key), key, arrays=True)
    return Stacked(
        oof,
        scored,
        fold_metrics(oof, label, "predicted", metric),
        importance_table(train.sparkSession, models, features),
    )


def depth_sweep(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    depths: Sequence[int],
    *,
    metric: str = "auc",
    **options,
) -> DataFrame:
    """(max_depth, value): a classification tree per depth, judged on the test table."""
    trees = fit_tree_depths(train, features, label, depths, **options)
    scored = test.select(
        F.col(quoted(label)).alias("label"), *[trees[d].column().alias(f"depth_{d}") for d in depths]
    )
    pairs = ", ".join(f"struct({d} AS max_depth, depth_{d} AS guess)" for d in depths)
    melted = scored.selectExpr("label", f"inline(array({pairs}))")
    return evaluate(melted, "label", "guess", metric, ["max_depth"]).select("max_depth", "name", "value")


def draw(space: Mapping[str, tuple], trials: int, seed: int) -> list[dict]:
    """Random settings: whole numbers where both ends are whole, else real numbers."""
    generator = random.Random(seed)
    settings = []
    for _ in range(trials):
        setting = {}
        for name, (low, high) in sorted(space.items()):
            whole = isinstance(low, int) and isinstance(high, int)
            setting[name] = generator.randint(low, high) if whole else generator.uniform(low, high)
        settings.append(setting)
    return settings


def cross_validated(
    frame: DataFrame, features: Sequence[str], label: str, key: str, learner, *, folds: int, metric: str = "auc"
) -> float:
    """Mean metric over the folds; the folded rows are kept for all fits and one grouped evaluation.

    A fold whose metric has no value, such as an AUC without both classes, is an error.
    """
    train = with_folds(frame, key, label, folds, stratified=False).persist()
    try:
        models = fold_models(train, features, label, learner, folds)
        scored = fold_scores(train, models, [label])
        found = {r["fold"]: r["value"] for r in evaluate(scored, label, "score", metric, ["fold"]).collect()}
    finally:
        train.unpersist()
    values = [found.get(fold) for fold in range(folds)]
    if any(v is None for v in values):
        without = [fold for fold, v in enumerate(values) if v is None]
        raise ValueError(f"{metric} has no value in folds {without}; use fewer or stratified folds")
    return sum(values) / folds


def parameter_search(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    make_learner: Callable[[Mapping], object],
    space: Mapping[str, tuple],
    *,
    trials: int = 10,
    folds: int = 5,
    metric: str = "auc",
    seed: int = 666,
) -> DataFrame:
    """(trial, setting, value): random settings of the space by cross-validated metric."""
    settings = draw(space, trials, seed)
    values = in_parallel(
        frame.sparkSession,
        [
            lambda s=s: cross_validated(
                frame, features, label, key, make_learner(s), folds=folds, metric=metric
            )
            for s in settings
        ]
    )
    rows = [
        (i + 1, {k: float(v) for k, v in s.items()}, float(value))
        for i, (s, value) in enumerate(zip(settings, values))
    ]
    return frame.sparkSession.createDataFrame(rows, "trial int, setting map<string,double>, value double")


def stack_boosters(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    *,
    objective: str = "binary",
    folds: int = 5,
    stratified: bool = False,
    max_bin: int = 255,
    **options,
) -> BoosterStack:
    """Boosters of all folds, grown together; each is stopped by the metric of the fold it scores (AUC, or macro F1 for
    more classes) and cut back to its best round. Multiclass scores are arrays in the order of the sorted labels."""
    train = with_folds(train, key, label, folds, stratified)
    models = fit_fold_boosters(train, features, label, folds, [options], objective, key=key, max_bin=max_bin)[0]
    kept = [quoted(c) for c in dict.fromkeys([key, label])]
    oof = train.select(*kept, "fold", probabilities(train, models, "fold").alias("score"))
    scored = average_columns(mean_scores(test, models, key), key, arrays=objective != "binary")
    if objective == "binary":
        judged, metrics = oof, fold_metrics(oof, label, "score", STOPPING_METRICS[objective])
    else:
        named = F.array(*[F.lit(v) for v in models[0].labels])
        judged = oof.withColumn("predicted", F.get(named, first_argmax(F.col("score"))))
        metrics = fold_metrics(judged.where(F.col(quoted(label)).isNotNull()), label, "predicted", STOPPING_METRICS[objective])
    return BoosterStack(judged, scored, metrics, importance_table(train.sparkSession, models, features), models)


def search_boosters(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    settings: Sequence[Mapping],
    *,
    folds: int = 5,
    max_bin: int = 255,
    metric: str = "auc",
) -> DataFrame:
    """(trial, setting, value): the mean over the folds of every setting of binary boosters.

    The models of all settings and folds grow together, so a level of all of them reads the data once; all are scored
    and judged in one grouped evaluation.
    """
    train = with_folds(frame, key, label, folds, stratified=False)
    fitted = fit_fold_boosters(train, features, label, folds, settings, "binary", key=key, max_bin=max_bin)
    scores = {f"trial_{i}": probabilities(train, models, "fold") for i, models in enumerate(fitted, start=1)}
    scored = train.select(F.col(quoted(label)).alias("label"), "fold", *[s.alias(n) for n, s in scores.items()])
    pairs = ", ".join(f"struct({i} AS trial, trial_{i} AS score)" for i in range(1, len(fitted) + 1))
    melted = scored.selectExpr("label", "fold", f"inline(array({pairs}))")
    found = evaluate(melted, "label", "score", metric, ["trial", "fold"])
    means = found.groupBy("trial").agg(F.avg("value").alias("value"), F.count("value").alias("judged"))
    checked = F.when(F.col("judged") == folds, F.col("value"))  # null where a fold has no value
    table = [(i, {k: float(v) for k, v in s.items()}) for i, s in enumerate(settings, start=1)]
    names = frame.sparkSession.createDataFrame(table, "trial int, setting map<string,double>")
    return names.join(means.select("trial", checked.alias("value")), "trial", "left").select("trial", "setting", "value")
