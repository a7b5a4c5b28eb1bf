"""Stacking, sweeps, searches and the choice of learner."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import LINE_FEATURES, lines, query, r6, table
from tabloom.catalog.boosting import SIGNED_ROWS
from tabloom.catalog.linear import DOCUMENT_FEATURES, labelled_documents
from tabloom.catalog.trees import LABEL_ROWS
from tabloom.catalog.tree_sql import cart_levels, route, stump_rounds
from tabloom.operators import metrics
from tabloom.operators.folds import in_holdout
from tabloom.plans.learners import GbtLearner, RegressionTreeLearner, fit_model
from tabloom.plans.selection import PerClassTrees, depth_sweep, draw, parameter_search, stack_binary, stack_multi

FEATURES = ["price", "month", "priority"]
FOLDS = 3

# two nested selects: the labels use the derived columns
ORDER_ROWS = """(SELECT *, CASE WHEN (price > 25 AND priority <= 2) OR month > 10 THEN 1 ELSE 0 END AS y,
    CASE WHEN price > 30 THEN 2 WHEN month > 6 THEN 1 ELSE 0 END AS kind,
    (('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % {folds})::INTEGER AS fold,
    ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT % 10000 < 4000 AS held FROM
    (SELECT o_orderkey, o_orderstatus, floor(o_totalprice / 10000)::DOUBLE AS price, month(o_orderdate)::INTEGER AS month,
     substr(o_orderpriority, 1, 1)::INTEGER AS priority FROM orders))"""


def orders(spark, folder):
    derived = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.floor(F.col("o_totalprice") / 10000).cast("double").alias("price"),
        F.month("o_orderdate").alias("month"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )
    return derived.withColumns(
        {
            "y": F.expr("CASE WHEN (price > 25 AND priority <= 2) OR month > 10 THEN 1 ELSE 0 END"),
            "kind": F.expr("CASE WHEN price > 30 THEN 2 WHEN month > 6 THEN 1 ELSE 0 END"),
        }
    )


def binary_ctes() -> str:
    ctes = [
        f"o AS {ORDER_ROWS.format(folds=FOLDS)}",
        "train AS (SELECT * FROM o WHERE o_orderstatus <> 'P')",
        "test AS (SELECT * FROM o WHERE o_orderstatus = 'P')",
    ]
    for k in range(FOLDS):
        ctes.append(f"fit_rows{k} AS (SELECT * FROM train WHERE fold <> {k})")
        ctes += cart_levels(f"m{k}", f"fit_rows{k}", FEATURES, "y", 2, "target")
        ctes.append(f"leaf{k} AS (SELECT node, round(avg(y), 8) AS p FROM m{k}_rows2 GROUP BY node)")
        ctes.append(f"valid{k} AS (SELECT * FROM train WHERE fold = {k})")
        ctes += route(f"m{k}", f"oof{k}", f"valid{k}", FEATURES, 2)
        ctes += route(f"m{k}", f"tst{k}", "test", FEATURES, 2)
    oof = " UNION ALL ".join(
        f"SELECT o_orderkey, y, fold, p AS score FROM oof{k}_2 JOIN leaf{k} USING (node)" for k in range(FOLDS)
    )
    tst = " UNION ALL ".join(f"SELECT o_orderkey, p FROM tst{k}_2 JOIN leaf{k} USING (node)" for k in range(FOLDS))
    ctes.append(f"oof AS ({oof})")
    ctes.append(f"tst AS (SELECT o_orderkey, avg(p) AS score FROM ({tst}) GROUP BY o_orderkey)")
    return "WITH " + ", ".join(ctes)


def stacked(spark, folder):
    rows = orders(spark, folder)
    return stack_binary(
        rows.filter("o_orderstatus <> 'P'"),
        rows.filter("o_orderstatus = 'P'"),
        FEATURES,
        "y",
        "o_orderkey",
        RegressionTreeLearner({"max_depth": 2}),
        folds=FOLDS,
    )


@query(
    "oof_stack_binary",
    binary_ctes()
    + """ SELECT o_orderkey, fold, round_even(score, 6) AS score FROM oof
          UNION ALL SELECT o_orderkey, -1, round_even(score, 6) FROM tst""",
)
def oof_stack_binary(spark, folder):
    result = stacked(spark, folder)
    train = result.oof.select("o_orderkey", "fold", r6(F.col("score")).alias("score"))
    test = result.test.select("o_orderkey", F.lit(-1).alias("fold"), r6(F.col("score")).alias("score"))
    return train.unionByName(test)


def pair_auc(where: str) -> str:
    """Share of ordered (positive, negative) pairs, over counts per score."""
    return f"""(SELECT sum(p.n * q.n * CASE WHEN p.score > q.score THEN 1.0::DOUBLE WHEN p.score = q.score THEN 0.5 ELSE 0 END)
        / sum(p.n * q.n) FROM (SELECT score, count(*) AS n FROM oof WHERE y = 1 {where} GROUP BY score) p,
        (SELECT score, count(*) AS n FROM oof WHERE y = 0 {where} GROUP BY score) q)"""


@query(
    "oof_metrics",
    binary_ctes()
    + f" SELECT 0 AS fold, 'auc' AS name, round_even({pair_auc('')}, 6) AS value UNION ALL "
    + " UNION ALL ".join(
        f"SELECT {k + 1}, 'auc', round_even({pair_auc(f'AND fold = {k}')}, 6)" for k in range(FOLDS)
    ),
)
def oof_metrics(spark, folder):
    return stacked(spark, folder).metrics.select("fold", "name", r6(F.col("value")).alias("value"))


@query(
    "oof_importances",
    binary_ctes()
    + " UNION ALL ".join(
        f""" SELECT n.name AS feature, count(b.feature)::DOUBLE AS importance, {k + 1} AS fold FROM
            (VALUES (0, 'price'), (1, 'month'), (2, 'priority')) n(i, name) LEFT JOIN
            (SELECT feature FROM m{k}_best0 UNION ALL SELECT feature FROM m{k}_best1) b ON b.feature = n.i GROUP BY n.name"""
        for k in range(FOLDS)
    ),
)
def oof_importances(spark, folder):
    return stacked(spark, folder).importances


CLASSES, MULTI_FOLDS = 3, 2


def multi_ctes() -> str:
    ctes = [
        f"o AS {ORDER_ROWS.format(folds=MULTI_FOLDS)}",
        "train AS (SELECT * FROM o WHERE o_orderstatus <> 'P')",
        "test AS (SELECT * FROM o WHERE o_orderstatus = 'P')",
    ]
    oof, tst = [], []
    for k in range(MULTI_FOLDS):
        ctes.append(f"valid{k} AS (SELECT * FROM train WHERE fold = {k})")
        for c in range(CLASSES):
            m = f"m{k}c{c}"
            ctes.append(f"{m}_in AS (SELECT *, (kind = {c})::INTEGER AS t FROM train WHERE fold <> {k})")
            ctes += cart_levels(m, f"{m}_in", FEATURES, "t", 1, "target")
            ctes.append(f"{m}_leaf AS (SELECT node, round(avg(t), 8) AS p FROM {m}_rows1 GROUP BY node)")
            ctes += route(m, f"{m}_v", f"valid{k}", FEATURES, 1)
            ctes += route(m, f"{m}_t", "test", FEATURES, 1)
            oof.append(f"SELECT o_orderkey, kind, fold, {c} AS c, p FROM {m}_v_1 JOIN {m}_leaf USING (node)")
            tst.append(f"SELECT o_orderkey, {c} AS c, p FROM {m}_t_1 JOIN {m}_leaf USING (node)")
    ctes.append(f"oof AS ({' UNION ALL '.join(oof)})")
    ctes.append(f"tst AS (SELECT o_orderkey, c, avg(p) AS p FROM ({' UNION ALL '.join(tst)}) GROUP BY ALL)")
    return "WITH " + ", ".join(ctes)


@query(
    "oof_stack_multi",
    multi_ctes()
    + f""", wide AS (SELECT o_orderkey, fold, kind, {', '.join(f'max(p) FILTER (c = {c}) AS p{c}' for c in range(CLASSES))} FROM oof GROUP BY ALL)
        SELECT o_orderkey, fold, {', '.join(f'round_even(p{c}, 6) + 0.0 AS p{c}' for c in range(CLASSES))},
        CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS predicted FROM wide
        UNION ALL SELECT o_orderkey, -1, {', '.join(f'round_even(max(p) FILTER (c = {c}), 6) + 0.0' for c in range(CLASSES))}, -1
        FROM tst GROUP BY o_orderkey""",
)
def oof_stack_multi(spark, folder):
    rows = orders(spark, folder)
    result = stack_multi(
        rows.filter("o_orderstatus <> 'P'"),
        rows.filter("o_orderstatus = 'P'"),
        FEATURES,
        "kind",
        "o_orderkey",
        PerClassTrees({"max_depth": 1}, range(CLASSES)),
        classes=CLASSES,
        folds=MULTI_FOLDS,
    )
    shares = [r6(F.get("score", F.lit(c))).alias(f"p{c}") for c in range(CLASSES)]
    train = result.oof.select("o_orderkey", "fold", *shares, "predicted")
    return train.unionByName(
        result.test.select("o_orderkey", F.lit(-1).alias("fold"), *shares, F.lit(-1).alias("predicted"))
    )


DEPTHS = (1, 2, 3)


def sweep_sql() -> str:
    ctes = [
        f"o AS {ORDER_ROWS.format(folds=2)}",
        "train AS (SELECT * FROM o WHERE NOT held)",
        "test AS (SELECT * FROM o WHERE held)",
        *cart_levels("m", "train", FEATURES, "y", max(DEPTHS), "class", min_leaf=2),
        *route("m", "r", "test", FEATURES, max(DEPTHS)),
    ]
    for d in DEPTHS:
        ctes.append(
            f"guess{d} AS (SELECT node, CASE WHEN 2 * sum(y) > count(*) THEN 1 ELSE 0 END AS g FROM m_rows{d} GROUP BY node)"
        )
        ctes.append(f"s{d} AS (SELECT y, g FROM r_{d} JOIN guess{d} USING (node))")
    hit = "avg(g) FILTER (y = 1)"
    false = "avg(g) FILTER (y = 0)"
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT {d} AS max_depth, 'auc' AS name, round_even((1 + {hit} - {false}) / 2, 6) AS value FROM s{d}" for d in DEPTHS
    )


@query("depth_sweep", sweep_sql())
def depth_sweep_query(spark, folder):
    rows = orders(spark, folder)
    held = in_holdout(F.col("o_orderkey"), 0.4)
    curve = depth_sweep(rows.filter(~held), rows.filter(held), FEATURES, "y", DEPTHS, min_samples_leaf=2)
    return curve.select("max_depth", "name", r6(F.col("value")).alias("value"))


# trees of depth 1 add up and cannot tell the planted label, deeper ones can: the trials' settings decide
SPACE, TRIALS, SEED = {"max_depth": (1, 3), "gamma": (0.0, 0.01)}, 4, 666
DRAWN = ", ".join(f"({i}, {s['max_depth']})" for i, s in enumerate(draw(SPACE, TRIALS, SEED), start=1))


@query("param_search", f"SELECT trial, depth::DOUBLE AS max_depth, depth > 1 AS told_apart FROM (VALUES {DRAWN}) t(trial, depth)")
def param_search(spark, folder):
    rows = labelled_documents(spark, folder)

    def learner(setting):
        return GbtLearner({"n_estimators": 3, "learning_rate": 0.3, "random_state": 7, **setting})

    found = parameter_search(
        rows, DOCUMENT_FEATURES, "planted", "doc_id", learner, SPACE, trials=TRIALS, folds=3, seed=SEED
    )
    return found.select("trial", F.col("setting")["max_depth"].alias("max_depth"), (F.col("value") > 0.9999).alias("told_apart"))


@query(
    "learner_choice",
    f"""WITH {', '.join(cart_levels('t', LABEL_ROWS, LINE_FEATURES, 'y', 2, 'class'))},
        guess AS (SELECT node, CASE WHEN 2 * sum(y) > count(*) THEN 1 ELSE 0 END AS g FROM t_rows2 GROUP BY node),
        {', '.join(stump_rounds(SIGNED_ROWS, LINE_FEATURES, 2))}
        SELECT 'binary' AS learner, round_even(avg((y <> g)::INTEGER), 8) AS error FROM t_rows2 JOIN guess USING (node)
        UNION ALL SELECT 'adaboost', round_even(avg(((f >= 0) <> (y = 1))::INTEGER), 8) FROM w2""",
)
def learner_choice(spark, folder):
    rows = lines(spark, folder)
    whole = None
    for name, options in (("binary", {"max_depth": 2}), ("adaboost", {"rounds": 2})):
        model = fit_model(rows, LINE_FEATURES, "y", name, **options)
        error = metrics.accuracy(model.score(rows, "guess"), "y", "guess").select(
            F.lit(name).alias("learner"), r6(F.col("error"), 8).alias("error")
        )
        whole = error if whole is None else whole.unionByName(error)
    return whole
