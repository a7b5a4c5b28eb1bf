"""Boosted stumps and boosted trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import LINE_FEATURES, PLANTED_LABEL, PLANTED_TARGET, lines, query, r6
from tabloom.catalog.tree_sql import boosted_trees, stump_rounds
from tabloom.plans.boosting import STEPS, best_step, error_curve, fit_stump_booster, fit_tree_booster, signed, step_losses

ROUNDS = 8
SIGNED_ROWS = f"(SELECT l_quantity, l_discount, l_tax, CASE WHEN {PLANTED_LABEL} = 1 THEN 1 ELSE -1 END AS y FROM lineitem)"
STUMPS = ", ".join(stump_rounds(SIGNED_ROWS, LINE_FEATURES, ROUNDS))
NAMES = "CASE feature WHEN 0 THEN 'l_quantity' WHEN 1 THEN 'l_discount' ELSE 'l_tax' END"


def stump_table(prefix: str, rounds: int) -> str:
    return f"WITH {prefix} " + " UNION ALL ".join(
        f"""SELECT {k} AS round, {NAMES} AS feature, t AS threshold, polarity, round_even(e, 8) AS error,
            round_even(alpha, 8) AS alpha FROM best{k}"""
        for k in range(1, rounds + 1)
    )


def stump_rows(booster, spark):
    return booster.table(spark).select(
        "round", "feature", "threshold", "polarity", r6(F.col("error"), 8).alias("error"), r6(F.col("alpha"), 8).alias("alpha")
    )


def fitted(spark, folder):
    return fit_stump_booster(lines(spark, folder), LINE_FEATURES, "y", rounds=ROUNDS)


@query("adaboost_fit", stump_table(STUMPS, ROUNDS))
def adaboost_fit(spark, folder):
    return stump_rows(fitted(spark, folder), spark)


@query(
    "adaboost_rate",
    stump_table(", ".join(stump_rounds(SIGNED_ROWS, LINE_FEATURES, 3, rate=0.5)), 3),
)
def adaboost_rate(spark, folder):
    booster = fit_stump_booster(lines(spark, folder), LINE_FEATURES, "y", rounds=3, learning_rate=0.5)
    return stump_rows(booster, spark)


@query(
    "adaboost_curve",
    f"WITH {STUMPS} "
    + " UNION ALL ".join(
        f"""SELECT {k} AS round, round_even(avg(CASE WHEN (CASE WHEN f >= 0 THEN 1 ELSE -1 END) <> y THEN 1.0::DOUBLE ELSE 0 END), 8)
            AS error FROM w{k}"""
        for k in range(1, ROUNDS + 1)
    ),
)
def adaboost_curve(spark, folder):
    curve = error_curve(lines(spark, folder), "y", fitted(spark, folder))
    return curve.select("round", r6(F.col("error"), 8).alias("error"))


@query(
    "adaboost_weights",
    f"""WITH {STUMPS} SELECT l_quantity, l_discount, l_tax, y AS sign, round_even(avg(w) * (SELECT count(*) FROM lineitem), 8) AS weight,
        count(*) AS n FROM w{ROUNDS} GROUP BY ALL""",
)
def adaboost_weights(spark, folder):
    booster = fitted(spark, folder)
    rows = signed(lines(spark, folder), "y").withColumn("w", booster.weight())
    return rows.groupBy(*LINE_FEATURES, "sign").agg(
        r6(F.avg("w"), 8).alias("weight"), F.count(F.lit(1)).alias("n")
    )


@query(
    "adaboost_score",
    f"""WITH {STUMPS} SELECT l_quantity, l_discount, l_tax, CASE WHEN f >= 0 THEN 1 ELSE 0 END AS prediction,
        round_even(any_value(f), 6) + 0.0 AS margin, count(*) AS n FROM w{ROUNDS} GROUP BY l_quantity, l_discount, l_tax, 4""",
)
def adaboost_score(spark, folder):
    booster = fitted(spark, folder)
    scored = booster.score(lines(spark, folder)).withColumn("margin", r6(booster.margin()))
    return scored.groupBy(*LINE_FEATURES, "prediction").agg(
        F.first("margin").alias("margin"), F.count(F.lit(1)).alias("n")
    )


TARGET_ROWS = f"(SELECT l_quantity, l_discount, l_tax, {PLANTED_TARGET} AS z FROM lineitem)"
TREES = 6  # beyond the first checkpoint of the scores
BOOSTED, SCORES = boosted_trees("target_rows", LINE_FEATURES, TREES, 2)
BOOSTED = f"WITH target_rows AS {TARGET_ROWS}, {', '.join(BOOSTED)} "


def fitted_trees(spark, folder):
    return fit_tree_booster(lines(spark, folder), LINE_FEATURES, "z", rounds=TREES, max_depth=2)


@query(
    "gbdt_fit",
    BOOSTED
    + " UNION ALL ".join(
        f"""SELECT {k} AS round, round_even((SELECT p FROM step{k}), 2)::DOUBLE AS step, node, round_even(leaf, 6) + 0.0 AS prediction,
            (SELECT count(*) FROM b{k}_rows2 x WHERE x.node = leaf{k}.node) AS n FROM leaf{k}"""
        for k in range(1, TREES + 1)
    ),
)
def gbdt_fit(spark, folder):
    nodes = fitted_trees(spark, folder).table(spark).filter("is_leaf")
    return nodes.select(
        "round",
        r6(F.col("step"), 2).alias("step"),
        F.col("node_id").alias("node"),
        r6(F.col("prediction").cast("double")).alias("prediction"),
        "n",
    )


@query(
    "gbdt_score",
    BOOSTED
    + f"""SELECT l_quantity, l_discount, l_tax, round_even(any_value(f), 5) + 0.0 AS prediction, count(*) AS n FROM {SCORES}
          GROUP BY l_quantity, l_discount, l_tax""",
)
def gbdt_score(spark, folder):
    scored = fitted_trees(spark, folder).score(lines(spark, folder).select(*LINE_FEATURES))
    return scored.groupBy(*LINE_FEATURES).agg(
        r6(F.first("prediction"), 5).alias("prediction"), F.count(F.lit(1)).alias("n")
    )


@query(
    "line_search",
    f"""WITH r AS (SELECT z - 59 AS r, CASE WHEN l_quantity > 25.5 THEN 30.0::DOUBLE ELSE -20.0::DOUBLE END AS f FROM {TARGET_ROWS}),
        s AS (SELECT sum(r * r) AS rr, sum(r * f) AS rf, sum(f * f) AS ff FROM r),
        g AS (SELECT i, 0.5 + 0.05 * i AS p, rr - 2 * p * rf + p * p * ff AS loss FROM (SELECT unnest(range(90)) AS i), s)
        SELECT round_even(p, 2)::DOUBLE AS step, round_even(loss, 1) AS loss,
        i = (SELECT i FROM g ORDER BY loss, i DESC LIMIT 1) AS chosen FROM g""",
)
def line_search(spark, folder):
    rows = lines(spark, folder).select("z", "l_quantity")
    fitted_value = F.expr("CASE WHEN l_quantity > 25.5 THEN 30D ELSE -20D END")
    losses = step_losses(rows, F.col("z") - 59, fitted_value, F.lit(1.0), F.lit(0.0))
    chosen = best_step(losses)
    grid = [(p, loss, i == chosen) for i, (p, loss) in enumerate(zip(STEPS, losses))]
    return spark.createDataFrame(grid, "step double, loss double, chosen boolean").select(
        r6(F.col("step"), 2).alias("step"), r6(F.col("loss"), 1).alias("loss"), "chosen"
    )
