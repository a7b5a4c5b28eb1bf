"""Boosted stumps and boosted regression trees.

Neither keeps per-row weights or residuals between rounds: both are expressions over
the model so far, so a lost executor costs a re-read and the plan does not grow with
the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions import double_sql, quoted
from tabloom.operators import criteria
from tabloom.operators.ordered import Layout, histogram
from tabloom.plans.compact import class_rows, target_rows
from tabloom.plans.tree_model import Tree
from tabloom.plans.trees import TreeParams, grow_regression_tree, snap
from tabloom.session import shared_dir

ALPHA_CAP = 20.0
# fixed values: the step search tries 0.5, 0.55, .., 4.95
STEPS = [0.5 + 0.05 * i for i in range(90)]
TREES_PER_CHECKPOINT = 5
LEAVES_PER_PROJECTION = 64
ROUNDS_PER_PASS = 20
LOSSES = ("square loss",)


@dataclass(frozen=True)
class Stump:
    """``feature >= threshold`` votes ``polarity``, anything else its opposite."""

    round: int
    feature: str
    threshold: float
    polarity: int
    error: float
    alpha: float
    normaliser: float


STUMP_SCHEMA = T.StructType(
    [
        T.StructField("round", T.IntegerType(), False),
        T.StructField("feature", T.StringType(), False),
        T.StructField("threshold", T.DoubleType(), False),
        T.StructField("polarity", T.IntegerType(), False),
        T.StructField("error", T.DoubleType(), False),
        T.StructField("alpha", T.DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class StumpBooster:
    stumps: tuple[Stump, ...]

    def margin_sql(self, rounds: int | None = None) -> str:
        """Sum of alpha x vote. Stumps that share a cut are added up first, so the
        expression is bounded by the number of distinct cuts, not of rounds."""
        cuts: dict[tuple[str, float], float] = {}
        for stump in self.stumps[:rounds]:
            cut = (stump.feature, stump.threshold)
            cuts[cut] = cuts.get(cut, 0.0) + stump.alpha * stump.polarity
        if not cuts:
            return "0D"
        return " + ".join(
            f"CASE WHEN {quoted(f)} >= {double_sql(t)} THEN {double_sql(a)} ELSE {double_sql(-a)} END"
            for (f, t), a in cuts.items()
        )

    def margin(self, rounds: int | None = None) -> Column:
        return F.expr(self.margin_sql(rounds))

    def vote(self, rounds: int | None = None) -> Column:
        """1 where the margin is not negative, else 0."""
        return F.when(self.margin(rounds) >= 0, 1).otherwise(0)

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        return frame.withColumn(name, self.vote())

    def weight(self) -> Column:
        """A training row's weight after all rounds, up to the common factor 1/N:
        exp(-y margin) over the product of the normalisers. Needs a -1/+1 ``sign`` column."""
        scale = sum(math.log(s.normaliser) for s in self.stumps)
        return F.exp(-F.col("sign") * self.margin() - F.lit(scale))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(s.round, s.feature, s.threshold, s.polarity, s.error, s.alpha) for s in self.stumps]
        return spark.createDataFrame(rows, STUMP_SCHEMA)


def signed(frame: DataFrame, label: str) -> DataFrame:
    """Labels 0/1 or -1/+1 become ``sign`` -1/+1."""
    return frame.withColumn("sign", F.when(F.col(quoted(label)) > 0, 1).otherwise(-1))


def fit_stump_booster(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    rounds: int = 20,
    learning_rate: float = 1.0,
    max_bins: int | None = None,
) -> StumpBooster:
    """AdaBoost with decision stumps: one aggregation per round.

    ``max_bins`` makes quantiles of the distinct values the only cuts of every column with more values, which bounds a
    round's shuffle by features x bins; without it every midpoint is a candidate.

    A round's alpha is half the log odds of its weighted error, times ``learning_rate``.
    Stops before a stump no better than chance and after one without error.
    """
    rows, layout = class_rows(frame, features, label, max_bins=max_bins)
    kept = rows
    try:
        rows = signed(rows, "label")
        if max_bins is not None:
            rows, layout = snap(rows, layout)
        booster = StumpBooster(())
        total = rows.agg(F.sum("n").alias("n")).first()["n"]
        if not total:
            raise ValueError("no labelled rows to fit")
        for number in range(1, rounds + 1):
            best = best_stump(rows, features, booster, layout)
            if best is None or best["error"] >= 0.5:
                break
            error = best["error"]
            log_odds = 0.5 * math.log((1 - error) / error) if error > 0 else ALPHA_CAP
            alpha = learning_rate * min(log_odds, ALPHA_CAP)
            normaliser = (1 - error) * math.exp(-alpha) + error * math.exp(alpha)
            threshold = best["threshold"]
            if best["feature"] in layout.snapped:  # a boundary closes the slice below it, a stump's threshold opens the one above
                threshold = math.nextafter(threshold, math.inf)
            stump = Stump(number, features[best["feature"]], threshold, best["polarity"], error, alpha, normaliser)
            booster = StumpBooster((*booster.stumps, stump))
            if error == 0:
                break
        return booster
    finally:
        kept.unpersist()


def best_stump(rows: DataFrame, features: Sequence[str], booster: StumpBooster, layout: Layout):
    """Smallest weighted error; ties go to the first feature, then threshold, then +1 above."""
    weighted = rows.withColumn("w", F.col("n") * booster.weight())
    melted = criteria.melt_numeric(weighted, features, ["sign", "w"], layout)
    sides = ("sum(IF(sign = 1, w, 0D)) AS wp", "sum(IF(sign = 1, 0D, w)) AS wn")
    counted = histogram(melted, [], layout, [F.expr(e) for e in sides])
    table = criteria.stump_candidates(counted, [], layout=layout)
    return table.agg(
        F.min(F.struct("error", "feature", "threshold", (-F.col("polarity")).alias("below"))).alias("best")
    ).select("best.error", "best.feature", "best.threshold", (-F.col("best.below")).alias("polarity")).first()


def error_curve(frame: DataFrame, label: str, booster: StumpBooster) -> DataFrame:
    """Error rate of the first 1, 2, .. stumps: one pass over the table per 20 rounds.

    A pass starts from the margin of all earlier rounds, so its expressions stay small.
    """
    truth = F.when(F.col(quoted(label)) > 0, 1).otherwise(0)
    labelled = frame.filter(F.col(quoted(label)).isNotNull())
    curve = None
    for low in range(0, len(booster.stumps), ROUNDS_PER_PASS):
        group = booster.stumps[low : low + ROUNDS_PER_PASS]
        votes = [StumpBooster((stump,)).margin().alias(f"v{stump.round}") for stump in group]
        rows = labelled.select(truth.alias("truth"), booster.margin(low).alias("margin"), *votes)
        sums = ["margin"]
        wrong = []
        for stump in group:
            sums.append(f"v{stump.round}")
            miss = f"IF({' + '.join(sums)} >= 0, 1, 0) <> truth"
            wrong.append(F.expr(f"avg(IF({miss}, 1D, 0D)) AS r{stump.round}"))
        pairs = ", ".join(f"struct({s.round} AS round, r{s.round} AS error)" for s in group)
        part = rows.agg(*wrong).selectExpr(f"inline(array({pairs}))")
        curve = part if curve is None else curve.unionByName(part)
    return curve


@dataclass(frozen=True)
class TreeBooster:
    """F0 plus the sum of step x tree."""

    start: float
    trees: tuple[Tree, ...]
    steps: tuple[float, ...]
    losses: tuple[float, ...] = field(default=())

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        running = frame.withColumn(name, F.lit(self.start))
        return add_trees(running, name, list(zip(self.steps, self.trees)))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = None
        for k, tree in enumerate(self.trees, start=1):
            nodes = tree.table(spark).select(
                F.lit(k).alias("round"), F.lit(self.steps[k - 1]).alias("step"), "*"
            )
            rows = nodes if rows is None else rows.unionByName(nodes)
        return rows


def add_trees(frame: DataFrame, name: str, terms: Sequence[tuple[float, Tree]]) -> DataFrame:
    """Add step x tree to a score column, a few leaves per projection.

    Each projection reads the score twice (null test and sum), so the optimizer keeps
    them apart and each compiles to its own small method; in one expression a few dozen
    trees pass the JVM's method size limit and leave code generation altogether.
    """
    others = [quoted(c) for c in frame.columns if c != name]
    group: list[str] = []
    leaves = 0
    for position, (step, tree) in enumerate(terms):
        group.append(f"{double_sql(step)} * ({tree.prediction_sql()})")
        leaves += sum(1 for _ in tree.leaves())
        following = terms[position + 1][1] if position + 1 < len(terms) else None
        if following is None or leaves + sum(1 for _ in following.leaves()) > LEAVES_PER_PROJECTION:
            total = f"CASE WHEN {name} IS NOT NULL THEN {name} + {' + '.join(group)} END"
            frame = frame.select(*others, F.expr(total).alias(name))
            group, leaves = [], 0
    return frame


def step_losses(frame: DataFrame, residual: Column, fitted: Column, n: Column, m2: Column) -> list[float]:
    """Squared loss of ``residual - p fitted`` for every step of the grid, from one aggregate."""
    r, f = residual.alias("r"), fitted.alias("f")
    row = (
        frame.select(n.alias("n"), m2.alias("m2"), r, f)
        .agg(
            F.sum(F.expr("m2 + n * r * r")).alias("rr"),
            F.sum(F.expr("n * r * f")).alias("rf"),
            F.sum(F.expr("n * f * f")).alias("ff"),
        )
        .first()
    )
    return [row["rr"] - 2 * p * row["rf"] + p * p * row["ff"] for p in STEPS]


def best_step(losses: Sequence[float]) -> int:
    """Index of the smallest loss; the last of equals."""
    return min(range(len(losses)), key=lambda i: (losses[i], -i))


def fit_tree_booster(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    rounds: int = 5,
    loss: str = "square loss",
    **options,
) -> TreeBooster:
    """Gradient boosting for squared loss with regression trees and a step search.

    The current score is kept as a column; every few trees it is written to the shared
    checkpoint folder, so neither the expression nor the lineage grows with the rounds.
    """
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    params = TreeParams(**options)
    shared_dir(frame.sparkSession)
    rows, layout = target_rows(frame, features, label, max_bins=params.max_bins)
    try:
        start = rows.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean")).first()["mean"]
        if start is None:
            raise ValueError("no labelled rows to fit")
        settled = rows.withColumn("score", F.lit(start))
        trees, steps, losses = [], [], []
        for number in range(1, rounds + 1):
            done = len(trees) - len(trees) % TREES_PER_CHECKPOINT
            state = add_trees(settled, "score", list(zip(steps[done:], trees[done:])))
            residual = F.col("m") - F.col("score")
            tree = grow_regression_tree(state, features, residual, 0.0, layout, params)
            if len(tree.nodes) == 1:
                break
            grid = step_losses(state, residual, tree.column(), F.col("n"), F.col("m2"))
            chosen = best_step(grid)
            trees.append(tree)
            steps.append(STEPS[chosen])
            losses.append(grid[chosen])
            if number % TREES_PER_CHECKPOINT == 0 and number < rounds:
                settled = add_trees(state, "score", [(steps[-1], tree)]).checkpoint()
        return TreeBooster(start, tuple(trees), tuple(steps), tuple(losses))
    finally:
        rows.unpersist()
