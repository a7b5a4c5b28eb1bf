"""Tree fits and tree scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.catalog import LINE_FEATURES, PLANTED_LABEL, PLANTED_TARGET, lines, query, r6, table
from tabloom.catalog.criteria import CATEGORIES, CATEGORY_ROWS, categories
from tabloom.catalog.tree_sql import cart_levels, cart_tree, category_tree
from tabloom.functions import quoted
from tabloom.plans.tree_model import Node, Tree
from tabloom.plans.trees import fit_category_tree, fit_class_tree, fit_regression_tree

LABEL_ROWS = f"(SELECT l_quantity, l_discount, l_tax, {PLANTED_LABEL} AS y FROM lineitem)"
TARGET_ROWS = f"(SELECT l_quantity, l_discount, l_tax, {PLANTED_TARGET} AS z FROM lineitem)"


def node_rows(tree: Tree, spark) -> DataFrame:
    nodes = tree.table(spark)
    return nodes.select(
        "node_id",
        F.coalesce("parent_id", F.lit(0)).alias("parent_id"),
        "depth",
        F.coalesce("feature", F.lit("")).alias("feature"),
        F.coalesce("op", F.lit("")).alias("op"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"),
        r6(F.col("prediction").cast("double")).alias("prediction"),
        "n",
        "is_leaf",
    )


@query("cart_class_tree", cart_tree(LABEL_ROWS, LINE_FEATURES, "y", 3, "class"))
def cart_class_tree(spark, folder):
    return node_rows(fit_class_tree(lines(spark, folder), LINE_FEATURES, "y", max_depth=3), spark)


@query("cart_reg_tree", cart_tree(TARGET_ROWS, LINE_FEATURES, "z", 3, "target", min_leaf=2))
def cart_reg_tree(spark, folder):
    tree = fit_regression_tree(lines(spark, folder), LINE_FEATURES, "z", max_depth=3, min_samples_leaf=2)
    return node_rows(tree, spark)


def path_rows(tree: Tree, spark) -> DataFrame:
    """Nodes of a multiway tree named by their path of rules."""
    paths: dict[int, str] = {}
    rows = []
    for node in tree.nodes:
        step = "" if node.feature is None else f"/{node.feature}={node.value}"
        paths[node.node_id] = paths.get(node.parent_id, "") + step
        rows.append((paths[node.node_id], node.depth, node.prediction, node.n, not tree.children(node)))
    return spark.createDataFrame(rows, "path string, depth int, prediction int, n long, is_leaf boolean")


@query("id3_tree", category_tree(CATEGORY_ROWS, CATEGORIES, 4, "ID3", 0.01))
def id3_tree(spark, folder):
    return path_rows(fit_category_tree(categories(spark, folder), CATEGORIES, "y", "ID3", 0.01), spark)


WIDE = ["brand", "kind", "size"]
WIDE_ROWS = """(SELECT p_brand AS brand, p_type AS kind, p_size::VARCHAR AS size,
    (CASE WHEN p_size % 7 < 3 AND p_brand < 'Brand#3' THEN 1 ELSE 0 END) AS y FROM part)"""


@query("id3_wide", category_tree(WIDE_ROWS, WIDE, 3, "ID3", 0.01))
def id3_wide(spark, folder):
    rows = table(spark, folder, "part").selectExpr(
        "p_brand AS brand", "p_type AS kind", "CAST(p_size AS STRING) AS size",
        "CASE WHEN p_size % 7 < 3 AND p_brand < 'Brand#3' THEN 1 ELSE 0 END AS y",
    )
    return path_rows(fit_category_tree(rows, WIDE, "y", "ID3", 0.01), spark)


@query("cart_binned", cart_tree(LABEL_ROWS, LINE_FEATURES, "y", 3, "class"))
def cart_binned(spark, folder):
    """With as many bins as a column has values, binning changes nothing."""
    return node_rows(fit_class_tree(lines(spark, folder), LINE_FEATURES, "y", max_depth=3, max_bins=64), spark)


@query("c45_tree", category_tree(CATEGORY_ROWS, CATEGORIES, 4, "C4.5", 0.01))
def c45_tree(spark, folder):
    return path_rows(fit_category_tree(categories(spark, folder), CATEGORIES, "y", "C4.5", 0.01), spark)


FIXED_TREE = Tree(
    [
        Node(1, None, 0, None, None, None, 0, 0),
        Node(2, 1, 1, "value", "<=", 20.0, 0, 0),
        Node(3, 1, 1, "value", ">", 20.0, 1, 0),
        Node(4, 2, 2, "user_id", "<=", 50.0, 0, 0),
        Node(5, 2, 2, "user_id", ">", 50.0, 1, 0),
    ]
)


@query(
    "cart_score",
    """SELECT event_id, CASE WHEN v <= 20 THEN CASE WHEN user_id <= 50 THEN 0 ELSE 1 END WHEN v > 20 THEN 1 END AS prediction
       FROM (SELECT event_id, user_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS v FROM events)""",
)
def cart_score(spark, folder):
    events = table(spark, folder, "events").withColumn(
        "value", F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END")
    )
    return FIXED_TREE.score(events).select("event_id", "prediction")


CATEGORY_FIXED = Tree(
    [
        Node(1, None, 0, None, None, None, 0, 0),
        Node(2, 1, 1, "event_type", "=", "click", 1, 0),
        Node(3, 1, 1, "event_type", "=", "view", 0, 0),
        Node(4, 1, 1, "event_type", "=", "error", 0, 0),
    ]
)


@query(
    "id3_score",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 WHEN 'error' THEN 0 END AS prediction,
       CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS filled FROM events""",
)
def id3_score(spark, folder):
    events = table(spark, folder, "events")
    majority = CATEGORY_FIXED.leaf_majority()
    scored = CATEGORY_FIXED.score(events).select("*", CATEGORY_FIXED.column(majority).alias("filled"))
    return scored.select("event_id", "prediction", "filled")


LEAVES = cart_tree(LABEL_ROWS, LINE_FEATURES, "y", 2, "class")


@query(
    "leaf_table",
    f"""WITH tree AS ({LEAVES}), leaf AS (SELECT * FROM tree WHERE is_leaf)
        SELECT node_id, prediction, n, (SELECT prediction FROM leaf GROUP BY prediction ORDER BY count(*) DESC, prediction LIMIT 1)
        AS majority FROM leaf""",
)
def leaf_table(spark, folder):
    tree = fit_class_tree(lines(spark, folder), LINE_FEATURES, "y", max_depth=2)
    return (
        node_rows(tree, spark)
        .filter("is_leaf")
        .select("node_id", "prediction", "n", F.lit(float(tree.leaf_majority())).alias("majority"))
    )


@query(
    "tree_scores",
    f"""WITH {', '.join(cart_levels('t', LABEL_ROWS, LINE_FEATURES, 'y', 3, 'class'))},
        leaf AS (SELECT node, CASE WHEN 2 * sum(y) > count(*) THEN 1 ELSE 0 END AS guess FROM t_rows3 GROUP BY node)
        SELECT l_quantity, l_discount, l_tax, guess AS prediction, count(*) AS n FROM t_rows3 JOIN leaf USING (node) GROUP BY ALL""",
)
def tree_scores(spark, folder):
    rows = lines(spark, folder)
    tree = fit_class_tree(rows, LINE_FEATURES, "y", max_depth=3)
    return (
        tree.score(rows)
        .groupBy(*[quoted(f) for f in LINE_FEATURES], "prediction")
        .agg(F.count(F.lit(1)).alias("n"))
    )
