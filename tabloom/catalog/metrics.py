"""Evaluation and row splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import EVENTS_WITH_GAPS, PLANTED_LABEL, PLANTED_TARGET, events_with_gaps, lines, query, r6, table
from tabloom.operators import folds, metrics

SCORE = "l_quantity / 50 + 2 * l_discount"


def auc_sql(score: str) -> str:
    """Mean rank of the positives: another formula than the running total."""
    return f"""WITH s AS (SELECT {PLANTED_LABEL} AS y, {score} AS s FROM lineitem),
        r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS place FROM s)
        SELECT round_even((sum(place) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
        / (count(*) FILTER (y = 1)::DOUBLE * count(*) FILTER (y = 0)), 8) AS auc FROM r"""


@query("auc", auc_sql(SCORE))
def auc(spark, folder):
    scored = lines(spark, folder).withColumn("s", F.expr(SCORE))
    return metrics.auc(scored, "y", "s").select(r6(F.col("auc"), 8).alias("auc"))


# nearly every score is distinct here, so the ranking goes through slices
@query("auc_continuous", auc_sql("l_extendedprice * (1 + l_tax)"))
def auc_continuous(spark, folder):
    scored = lines(spark, folder).withColumn("s", F.expr("l_extendedprice * (1 + l_tax)"))
    return metrics.auc(scored, "y", "s").select(r6(F.col("auc"), 8).alias("auc"))


JUDGED = "(SELECT substr(o_orderpriority, 1, 1)::INTEGER AS truth, (o_custkey % 6)::INTEGER AS guess FROM orders)"


def judged(spark, folder):
    return table(spark, folder, "orders").select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("truth"), (F.col("o_custkey") % 6).cast("int").alias("guess")
    )


@query(
    "accuracy",
    f"""SELECT round_even(avg(CASE WHEN truth = guess THEN 1.0::DOUBLE ELSE 0 END), 8) AS accuracy,
        round_even(avg(CASE WHEN truth = guess THEN 0.0::DOUBLE ELSE 1 END), 8) AS error FROM {JUDGED}""",
)
def accuracy(spark, folder):
    table_of = metrics.accuracy(judged(spark, folder), "truth", "guess")
    return table_of.select(r6(F.col("accuracy"), 8).alias("accuracy"), r6(F.col("error"), 8).alias("error"))


CELLS = f"""WITH c AS (SELECT DISTINCT unnest([truth, guess]) AS k FROM {JUDGED}),
    t AS (SELECT k, count(*) FILTER (truth = k AND guess = k) AS tp, count(*) FILTER (truth <> k AND guess = k) AS fp,
    count(*) FILTER (truth = k AND guess <> k) AS fn FROM c, {JUDGED} GROUP BY k),
    f AS (SELECT k, tp, fp, fn, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r, CASE WHEN tp = 0 THEN 0 ELSE tp / (tp + (fp + fn) / 2) END AS f1 FROM t)"""


@query("confusion", CELLS + ' SELECT k::VARCHAR AS "class", tp, fp, fn FROM f')
def confusion(spark, folder):
    return metrics.confusion(judged(spark, folder), "truth", "guess")


@query(
    "f1_per_class",
    CELLS
    + ' SELECT k::VARCHAR AS "class", round_even(p, 8) AS "precision", round_even(r, 8) AS recall, round_even(f1, 8) AS f1 FROM f',
)
def f1_per_class(spark, folder):
    scores = metrics.f1_per_class(judged(spark, folder), "truth", "guess")
    return scores.select("class", *[r6(F.col(c), 8).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "f1_micro",
    CELLS
    + """ SELECT round_even(sum(tp) / (sum(tp) + sum(fp)), 8) AS "precision", round_even(sum(tp) / (sum(tp) + sum(fn)), 8) AS recall,
          round_even(2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 8) AS f1 FROM f WHERE k > 0""",
)
def f1_micro(spark, folder):
    scores = metrics.f1_micro(judged(spark, folder), "truth", "guess", classes=[1, 2, 3, 4, 5])
    return scores.select(*[r6(F.col(c), 8).alias(c) for c in ("precision", "recall", "f1")])


@query("f1_macro", CELLS + " SELECT 'f1_macro' AS name, round_even(avg(f1), 8) AS value, true AS higher_is_better FROM f")
def f1_macro(spark, folder):
    scores = metrics.evaluate(judged(spark, folder), "truth", "guess", "f1_macro")
    return scores.select("name", r6(F.col("value"), 8).alias("value"), "higher_is_better")


@query(
    "mse_rmse",
    f"""SELECT round_even(avg(power(z - 2 * l_quantity, 2)), 6) AS mse, round_even(sqrt(avg(power(z - 2 * l_quantity, 2))), 6) AS rmse
        FROM (SELECT l_quantity, {PLANTED_TARGET} AS z FROM lineitem)""",
)
def mse_rmse(spark, folder):
    scored = lines(spark, folder).withColumn("p", 2 * F.col("l_quantity"))
    table_of = metrics.squared_error(scored, "z", "p")
    return table_of.select(r6(F.col("mse")).alias("mse"), r6(F.col("rmse")).alias("rmse"))


@query(
    "holdout_split",
    "SELECT o_orderkey, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 10000 < 4000 AS is_test FROM orders",
)
def holdout_split(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", folds.in_holdout(F.col("o_orderkey"), 0.4).alias("is_test")
    )


@query(
    "kfold",
    "SELECT o_orderkey, (('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 5)::INTEGER AS fold FROM orders",
)
def kfold(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", folds.fold_of(F.col("o_orderkey"), 5).alias("fold"))


@query(
    "kfold_stratified",
    """SELECT o_orderkey, o_orderstatus, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR)) - 1) % 5)::INTEGER
       AS fold FROM orders""",
)
def kfold_stratified(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return folds.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5)


@query(
    "kfold_stratified_nulls",
    f"""SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY md5(event_id::VARCHAR)) - 1) % 5)::INTEGER
        AS fold FROM {EVENTS_WITH_GAPS}""",
)
def kfold_stratified_nulls(spark, folder):
    events = events_with_gaps(spark, folder).select("event_id", "event_type")
    return folds.stratified_folds(events, "event_id", "event_type", 5)
