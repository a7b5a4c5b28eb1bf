"""Learners with one face: ``fit(frame, features, label)`` gives a model with ``score``.

Own models are expressions; library learners are pipelines of ``pyspark.ml``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions import quoted
from tabloom.operators.folds import in_holdout
from tabloom.plans.boosting import fit_stump_booster, fit_tree_booster
from tabloom.plans.linear import fit_logistic, fit_normal_equation
from tabloom.plans.tree_model import Tree
from tabloom.plans.trees import fit_category_tree, fit_class_tree, fit_fold_trees, fit_regression_tree


@dataclass(frozen=True)
class TreeScore:
    """A tree with its split counts as importances."""

    tree: Tree

    def column(self) -> Column:
        return self.tree.column()

    def importances(self) -> dict[str, float]:
        inner = {n.node_id for n in self.tree.nodes if self.tree.children(n)}
        split_on = {n.parent_id: n.feature for n in self.tree.nodes if n.parent_id in inner}
        return {f: float(c) for f, c in Counter(split_on.values()).items()}


@dataclass(frozen=True)
class RegressionTreeLearner:
    """On a 0/1 label the leaves are label means, that is, probabilities."""

    options: Mapping

    def fit(self, frame: DataFrame, features: Sequence[str], label: str) -> TreeScore:
        return TreeScore(fit_regression_tree(frame, features, label, **self.options))

    def fit_folds(self, train: DataFrame, features: Sequence[str], label: str, folds: int) -> list[TreeScore]:
        return [TreeScore(t) for t in fit_fold_trees(train, features, label, folds, **self.options)]


PLAIN_FITS = {
    "ID3": lambda frame, features, label, **o: fit_category_tree(frame, features, label, "ID3", **o),
    "C4.5": lambda frame, features, label, **o: fit_category_tree(frame, features, label, "C4.5", **o),
    "binary": fit_class_tree,
    "regression": fit_regression_tree,
    "adaboost": fit_stump_booster,
    "gbdt": fit_tree_booster,
    "linear": fit_normal_equation,
    "logistic": lambda frame, features, label, **o: fit_logistic(frame, features, label, **o).model,
}


def fit_model(frame: DataFrame, features: Sequence[str], label: str, learner: str, **options):
    """Fit by name; the model has ``score(frame)``."""
    if learner not in PLAIN_FITS:
        raise ValueError(f"learner must be one of {sorted(PLAIN_FITS)}")
    return PLAIN_FITS[learner](frame, features, label, **options)


# names of gradient boosting packages' parameters, and what the Spark learner calls them
GBT_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "subsample": "subsamplingRate",
    "max_bin": "maxBins",
    "min_child_samples": "minInstancesPerNode",
    "min_split_gain": "minInfoGain",
    "gamma": "minInfoGain",
    "random_state": "seed",
}


def gbt_params(options: Mapping) -> dict:
    """Translate parameters; one without a Spark counterpart is an error, not ignored."""
    unknown = sorted(set(options) - set(GBT_NAMES))
    if unknown:
        raise ValueError(f"no Spark counterpart for {unknown}; known: {sorted(GBT_NAMES)}")
    return {GBT_NAMES[k]: v for k, v in options.items()}


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="ml_features", handleInvalid="error")


@dataclass(frozen=True)
class LibraryModel:
    """A fitted pipeline; ``score`` adds the probabilities (array) or the class-1 probability."""

    pipeline: PipelineModel
    features: tuple[str, ...]
    output: str

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        scored = self.pipeline.transform(frame)
        if self.output == "probability":
            value = vector_to_array("probability")
        elif self.output == "positive":
            value = F.get(vector_to_array("probability"), F.lit(1))
        else:
            value = F.col("prediction")
        return scored.select(*[quoted(c) for c in frame.columns], value.alias(name))

    def importances(self) -> dict[str, float]:
        weights = self.pipeline.stages[-1].featureImportances.toArray()
        return {f: float(w) for f, w in zip(self.features, weights)}


@dataclass(frozen=True)
class GbtLearner:
    """Binary boosted trees. With ``key`` set, a fifth of the keys are the validation
    rows that stop boosting early."""

    options: Mapping
    key: str | None = None

    def fit(self, frame: DataFrame, features: Sequence[str], label: str) -> LibraryModel:
        learner = GBTClassifier(featuresCol="ml_features", labelCol=label, **gbt_params(self.options))
        if self.key is not None:
            frame = frame.withColumn("held_out", in_holdout(F.col(quoted(self.key)), 0.2, "early:"))
            learner = learner.setValidationIndicatorCol("held_out")
        model = Pipeline(stages=[assemble(features), learner]).fit(frame)
        return LibraryModel(model, tuple(features), "positive")


@dataclass(frozen=True)
class ForestLearner:
    """Multiclass probabilities by a random forest of boosted-tree-like depth."""

    options: Mapping

    def fit(self, frame: DataFrame, features: Sequence[str], label: str) -> LibraryModel:
        learner = RandomForestClassifier(featuresCol="ml_features", labelCol=label, **self.options)
        model = Pipeline(stages=[assemble(features), learner]).fit(frame)
        return LibraryModel(model, tuple(features), "probability")


def fit_one_vs_rest(frame: DataFrame, features: Sequence[str], label: str, **options) -> LibraryModel:
    """Multiclass boosted trees, one binary booster per class; scores are class labels."""
    booster = GBTClassifier(featuresCol="ml_features", labelCol=label, **gbt_params(options))
    learner = OneVsRest(classifier=booster, featuresCol="ml_features", labelCol=label)
    model = Pipeline(stages=[assemble(features), learner]).fit(frame)
    return LibraryModel(model, tuple(features), "prediction")


def fit_library_linear(frame: DataFrame, features: Sequence[str], label: str) -> LibraryModel:
    """Ordinary least squares by the normal solver."""
    learner = LinearRegression(featuresCol="ml_features", labelCol=label, solver="normal")
    model = Pipeline(stages=[assemble(features), learner]).fit(frame)
    return LibraryModel(model, tuple(features), "prediction")


def fit_library_logistic(
    frame: DataFrame, features: Sequence[str], label: str, *, l2: float = 0.0, max_iterations: int = 100
) -> LibraryModel:
    """Logistic regression with an L2 penalty on the coefficients as they are, which features on different scales feel
    differently; ``score`` gives class probability rows. An SGD fit's ``alpha`` is ``l2``; with a sum of losses and an
    inverse strength ``C``, ``l2`` is 1 / (C x rows)."""
    learner = LogisticRegression(
        featuresCol="ml_features", labelCol=label, regParam=l2, elasticNetParam=0.0, maxIter=max_iterations,
        standardization=False,
    )
    model = Pipeline(stages=[assemble(features), learner]).fit(frame)
    return LibraryModel(model, tuple(features), "probability")
