"""C4.5 trees over categorical and numeric columns.

A categorical column splits a node into all of its values and is used once on a path; a numeric one is cut in two at its
best threshold and may be cut again below. A level is one pass for the class counts of categories, one for those of
thresholds; every node's columns are then compared by gain ratio, only those whose gain is at least the node's average
if asked. Rows carry their node and move to a child by a join with the new nodes, so the plan does not grow with the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from tabloom.functions import quoted
from tabloom.operators import criteria
from tabloom.operators.ordered import Layout, histogram
from tabloom.plans.compact import class_rows
from tabloom.plans.tree_model import Node, Tree
from tabloom.plans.trees import branch_counts, category_domains, gini_of, labels_of, majority, snap

LOW, HIGH = "<=", ">"


def _xlogx(value: str) -> str:
    return f"IF({value} > 0, ({value}) * log2({value}), 0D)"


def threshold_gains(totals: DataFrame, classes: int, least: int) -> DataFrame:
    """Per (node, feature) the threshold with the largest gain, the smallest of equals, and its gain ratio.

    ``totals`` has the class counts on either side of every threshold.
    """
    low, high = [f"c{k}_low" for k in range(classes)], [f"c{k}_high" for k in range(classes)]
    n_low, n_high = f"({' + '.join(low)})", f"({' + '.join(high)})"
    n = f"({n_low} + {n_high})"
    both = [f"({a} + {b})" for a, b in zip(low, high, strict=True)]
    parts = lambda cells: " + ".join(_xlogx(c) for c in cells)
    # n times an entropy is n log n less the sum of c log c
    before = f"({_xlogx(n)} - ({parts(both)}))"
    after = f"({_xlogx(n_low)} - ({parts(low)}) + {_xlogx(n_high)} - ({parts(high)}))"
    worth = f"({_xlogx(n)} - {_xlogx(n_low)} - {_xlogx(n_high)})"
    rows = totals.where(f"{n_low} >= {least} AND {n_high} >= {least}").selectExpr(
        "node", "feature", "threshold", f"({before} - {after}) / {n} AS gain", f"{worth} / {n} AS intrinsic",
        f"array({', '.join(low)}) AS low", f"array({', '.join(high)}) AS high",
    )
    order = F.struct(F.expr("rint(gain * 1e10D)").alias("most"), -F.col("threshold"))
    best = rows.groupBy("node", "feature").agg(
        F.max_by(F.struct("threshold", "gain", "intrinsic", "low", "high"), order).alias("best")
    )
    ratio = F.expr("IF(rint(intrinsic * 1e12D) = 0, 0D, gain / intrinsic)")
    return best.select("node", "feature", "best.*").withColumn("gain_ratio", ratio)


def best_columns(options: DataFrame, above_average_gain: bool) -> dict[int, dict]:
    """Per node the column with the best gain ratio, the first of equals."""
    if above_average_gain:
        means = options.groupBy("node").agg(F.avg("gain").alias("average"))
        options = options.join(means, "node").where("gain >= average - 1e-12")
    order = F.struct(F.expr("rint(gain_ratio * 1e10D)").alias("most"), -F.col("feature"))
    best = F.max_by(F.struct("feature", "gain_ratio", "threshold", "low", "high"), order).alias("best")
    return {r["node"]: r.asDict() for r in options.groupBy("node").agg(best).select("node", "best.*").collect()}


def fit_c45_tree(
    frame: DataFrame, categories: Sequence[str], numbers: Sequence[str], label: str, *, delta: float = 0.005,
    max_depth: int = 5, min_samples_split: int = 2, min_samples_leaf: int = 1, above_average_gain: bool = True,
    max_bins: int | None = None,
) -> Tree:
    """A tree by gain ratio. ``delta`` is the least ratio of a split, ``min_samples_leaf`` the fewest rows on either side
    of a threshold, ``max_bins`` as for the other trees. A missing value counts for no gain of its column, and rows that
    miss the value a node splits on end there."""
    rows, layout = class_rows(frame, list(numbers), label, list(categories), max_bins)
    try:
        classes, counts = labels_of(rows)
        if not classes:
            raise ValueError("no labelled rows to fit")
        domains = category_domains(rows, categories) if categories else {}
        if max_bins is not None:
            rows, layout = snap(rows, layout)
        return _grown(
            rows, layout, list(categories), list(numbers), classes, counts, domains, delta, max_depth, min_samples_split,
            min_samples_leaf, above_average_gain,
        )
    finally:
        rows.unpersist()


def _options(placed: DataFrame, layout: Layout, categories, numbers, classes, least: int) -> tuple[DataFrame, DataFrame | None]:
    """(node, feature, gain, gain_ratio, threshold, low, high) of all columns, and the counts of categories."""
    names = [f"c{k}" for k in range(len(classes))]
    measures = criteria.class_measures(F.col("label"), classes, F.col("n"))
    shown, table = None, None
    if categories:
        melted = criteria.melt_text(placed, categories, ["node", "label", "n", "used"])
        melted = melted.where("NOT array_contains(used, feature)")
        table = melted.groupBy("node", "feature", "value").agg(*measures).persist(StorageLevel.MEMORY_AND_DISK)
        none = F.lit(None).cast("array<double>")
        shown = criteria.category_gains(table, ["node"], len(names)).select(
            "node", "feature", "gain", "gain_ratio", F.lit(None).cast("double").alias("threshold"), none.alias("low"),
            none.alias("high"),
        )
    if numbers:
        melted = criteria.melt_numeric(placed, numbers, ["node", "label", "n"], layout)
        counted = histogram(melted, ["node"], layout, measures)
        totals = criteria.threshold_totals(counted, ["node"], names, digits=4, layout=layout)
        cuts = threshold_gains(totals, len(names), least).select(
            "node", (F.col("feature") + len(categories)).alias("feature"), "gain", "gain_ratio", "threshold", "low", "high"
        )
        shown = cuts if shown is None else shown.unionByName(cuts)
    return shown, table


def _grown(
    rows, layout, categories, numbers, classes, counts, domains, delta, max_depth, min_split, min_leaf, above_average_gain
) -> Tree:
    names = [f"c{k}" for k in range(len(classes))]
    features = [*categories, *numbers]
    root = Node(1, None, 0, None, None, None, majority(classes, counts), int(sum(counts)))
    nodes, last_id, used = [root], 1, {1: []}
    open_nodes = {1: root} if gini_of(counts) > 0 and root.n >= min_split else {}
    placed = rows.withColumns({"node": F.lit(1).cast("long"), "used": F.array().cast("array<int>")})
    held = []
    try:
        while open_nodes and next(iter(open_nodes.values())).depth < max_depth:
            options, table = _options(placed, layout, categories, numbers, classes, min_leaf)
            best = best_columns(options, above_average_gain)
            chosen = {i: best[i] for i in open_nodes if i in best and best[i]["gain_ratio"] >= delta}
            by_value = {i: b["feature"] for i, b in chosen.items() if b["threshold"] is None}
            seen = branch_counts(table, by_value, names) if table is not None else {}
            if table is not None:
                table.unpersist()
            following, moves = {}, []
            for node_id, row in chosen.items():
                node, feature = open_nodes[node_id], row["feature"]
                if row["threshold"] is None:
                    branches = [("=", v, v, seen.get((node_id, v))) for v in domains[features[feature]]]
                    path = [*used[node_id], feature]
                else:
                    branches = [(op, row["threshold"], op, row[side]) for op, side in ((LOW, "low"), (HIGH, "high"))]
                    path = used[node_id]
                for op, value, branch, side in branches:
                    last_id += 1
                    guess = node.prediction if side is None else majority(classes, side)
                    size = 0 if side is None else int(sum(side))
                    child = Node(last_id, node_id, node.depth + 1, features[feature], op, value, guess, size)
                    nodes.append(child)
                    if side is not None and gini_of(side) > 0 and size >= min_split:
                        following[last_id] = child
                        used[last_id] = path
                        moves.append((node_id, feature, row["threshold"], branch, last_id, path))
            open_nodes = following
            if moves:
                placed = _moved(placed, moves, categories, numbers).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(placed)
                for old in held[:-2]:
                    old.unpersist()
                del held[:-2]
    finally:
        for frame in held:
            frame.unpersist()
    return Tree(nodes)


def _moved(placed: DataFrame, moves: list[tuple], categories: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Rows of split nodes at their child; the new nodes are a part of the tree, which the driver holds."""
    schema = "of_node long, of_feature int, threshold double, branch string, child long, child_used array<int>"
    table = placed.sparkSession.createDataFrame(moves, schema)
    splits = table.select("of_node", "of_feature", "threshold").distinct()
    there = placed.join(F.broadcast(splits), F.col("node") == F.col("of_node"))
    branch = None
    for i, name in enumerate([*categories, *numbers]):
        x = F.col(quoted(name))
        value = x.cast("string") if i < len(categories) else F.when(x <= F.col("threshold"), LOW).when(x > F.col("threshold"), HIGH)
        here = F.col("of_feature") == i
        branch = F.when(here, value) if branch is None else branch.when(here, value)
    there = there.withColumn("taken", branch).drop("of_node", "of_feature", "threshold")
    targets = table.select(F.col("of_node"), "branch", "child", "child_used")
    met = (there["node"] == targets["of_node"]) & (there["taken"] == targets["branch"])
    kept = [quoted(c) for c in placed.columns if c not in ("node", "used")]
    return there.join(F.broadcast(targets), met).select(*kept, F.col("child").alias("node"), F.col("child_used").alias("used"))
