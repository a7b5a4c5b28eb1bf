"""Decision trees grown level by level: one Spark job per level for all open nodes.

A row's node is an expression over the tree so far, so the data is never copied or
split.  The driver sees one row per open node and level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions import quoted
from tabloom.operators import criteria
from tabloom.operators.ordered import Layout, histogram
from tabloom.session import in_parallel
from tabloom.plans.compact import category_rows, class_rows, target_rows
from tabloom.plans.tree_model import Node, Tree

MAX_CLASSES = 1_000
MAX_CATEGORIES = 10_000
OBJECTIVES = ("binary", "regression")
METHODS = ("ID3", "C4.5")


@dataclass(frozen=True)
class TreeParams:
    """Stop rules. ``min_features_left`` is the number of non-constant columns a child
    needs to go on; ``max_bins`` makes the cuts of every column with more distinct values
    their quantiles, which bounds a level's shuffle by nodes x features x bins and suits
    continuous columns of large tables; without it every midpoint is a candidate.
    ``impurity_of`` says whether ``min_impurity_split`` is compared with
    the node's own gini or with the weighted gini after its best split."""

    max_depth: int = 3
    min_samples_split: int = 5
    min_samples_leaf: int = 1
    min_impurity_split: float = 0.005
    min_features_left: int = 0
    impurity_of: str = "node"
    max_bins: int | None = None

    def __post_init__(self):
        if self.impurity_of not in ("node", "split"):
            raise ValueError("impurity_of must be 'node' or 'split'")
        if self.max_bins is not None and self.max_bins < 2:
            raise ValueError("max_bins must be at least 2")


def fit_tree(frame: DataFrame, features: Sequence[str], label: str, objective: str, **params) -> Tree:
    """A binary tree by Gini index or by squared loss."""
    if objective not in OBJECTIVES:
        raise ValueError(f"objective must be one of {OBJECTIVES}")
    fit = fit_class_tree if objective == "binary" else fit_regression_tree
    return fit(frame, features, label, **params)


def snap(rows: DataFrame, layout: Layout) -> tuple[DataFrame, Layout]:
    """Put the values of wide columns on the upper boundary of their slice.

    A level's histogram is then bounded by nodes x features x boundaries, and the cuts
    are the boundaries instead of the midpoints of all neighbours.
    """
    wide = [i for i, points in enumerate(layout.boundaries) if points]
    changed = {}
    for i in wide:
        name, points = layout.columns[i], layout.boundaries[i]
        edges = F.array(*[F.lit(p) for p in (*points, points[-1] + 1.0)])
        changed[name] = F.when(F.col(quoted(name)).isNotNull(), F.get(edges, F.col(f"slice_{i}")))
    if not wide:
        return rows, layout
    narrow = tuple(() for _ in layout.boundaries)
    return rows.withColumns(changed).drop(*layout.slice_names()), replace(
        layout, boundaries=narrow, snapped=tuple(wide)
    )


def labels_of(rows: DataFrame) -> tuple[list, list[float]]:
    """Class labels in order with their weights; the number of classes is bounded."""
    found = (
        rows.groupBy("label").agg(F.sum("n").alias("n")).orderBy("label").limit(MAX_CLASSES + 1).collect()
    )
    if len(found) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes: is the label continuous?")
    return [r["label"] for r in found], [r["n"] for r in found]


def majority(classes: Sequence, counts: Sequence[float]):
    """Most frequent class; the smallest of equals."""
    return classes[max(range(len(classes)), key=lambda k: (counts[k], -k))]


def gini_of(counts: Sequence[float]) -> float:
    total = sum(counts)
    return 1.0 - sum((c / total) ** 2 for c in counts)


def fit_class_tree(frame: DataFrame, features: Sequence[str], label: str, **options) -> Tree:
    """Binary classification tree by the Gini index."""
    params = TreeParams(**options)
    rows, layout = class_rows(frame, features, label, max_bins=params.max_bins)
    try:
        return grow_class_tree(rows, features, layout, params)
    finally:
        rows.unpersist()


def grow_class_tree(rows: DataFrame, features: Sequence[str], layout: Layout, params: TreeParams) -> Tree:
    classes, counts = labels_of(rows)
    if not classes:
        raise ValueError("no labelled rows to fit")
    names = [f"c{k}" for k in range(len(classes))]
    measures = criteria.class_measures(F.col("label"), classes, F.col("n"))
    if params.max_bins is not None:
        rows, layout = snap(rows, layout)
    root = Node(1, None, 0, None, None, None, majority(classes, counts), int(sum(counts)))
    nodes = [root]
    open_nodes = {1: (root, counts)} if gini_of(counts) > 0 else {}
    while open_nodes and next(iter(open_nodes.values()))[0].depth < params.max_depth:
        place = F.expr(Tree(nodes).place_sql(set(open_nodes))).alias("node")
        melted = criteria.melt_numeric(rows, features, [place, "label", "n"], layout)
        melted = melted.filter(F.col("node").isNotNull())
        counted = histogram(melted, ["node"], layout, measures)
        table = criteria.gini_candidates(counted, ["node"], len(classes), layout=layout)
        best = criteria.best_per_node(
            table,
            ["node"],
            ["feature", "threshold", "gini", *[f"{c}_low" for c in names], *[f"{c}_high" for c in names]],
            ["gini", "feature", "threshold"],
        )
        chosen = {row["node"]: row for row in best.collect()}
        following = {}
        for node_id, (node, totals) in open_nodes.items():
            row = chosen.get(node_id)
            if row is None or not class_split_allowed(node, totals, row, names, params):
                continue
            sides = (("<=", [row[f"{c}_low"] for c in names]), (">", [row[f"{c}_high"] for c in names]))
            for step, (op, side) in enumerate(sides):
                child = Node(
                    2 * node_id + step,
                    node_id,
                    node.depth + 1,
                    features[row["feature"]],
                    op,
                    row["threshold"],
                    majority(classes, side),
                    int(sum(side)),
                )
                nodes.append(child)
                if gini_of(side) > 0:
                    following[child.node_id] = (child, side)
        open_nodes = following
    return Tree(nodes)


def class_split_allowed(node: Node, totals, row, names, params: TreeParams) -> bool:
    low = sum(row[f"{c}_low"] for c in names)
    high = sum(row[f"{c}_high"] for c in names)
    impurity = gini_of(totals) if params.impurity_of == "node" else row["gini"]
    return (
        node.n >= params.min_samples_split
        and min(low, high) >= params.min_samples_leaf
        and impurity >= params.min_impurity_split
        and (node.depth == 0 or row["usable_features"] > params.min_features_left)
    )


def fit_regression_tree(frame: DataFrame, features: Sequence[str], label: str, **options) -> Tree:
    """Binary regression tree by squared loss; a leaf is the mean rounded to 8 decimals."""
    params = TreeParams(**options)
    rows, layout = target_rows(frame, features, label, max_bins=params.max_bins)
    try:
        return grow_mean_tree(rows, features, layout, params)
    finally:
        rows.unpersist()


def grow_mean_tree(rows: DataFrame, features: Sequence[str], layout: Layout, params: TreeParams) -> Tree:
    """A regression tree of the rows' own target, centred on its mean."""
    mean = rows.agg(F.expr("sum(n * m) / sum(n) AS mean")).first()["mean"]
    if mean is None:
        raise ValueError("no labelled rows to fit")
    return grow_regression_tree(rows, features, F.col("m") - F.lit(mean), mean, layout, params)


def fit_fold_trees(
    frame: DataFrame, features: Sequence[str], label: str, folds: int, classes: Sequence | None = None, **options
) -> list:
    """A regression tree per fold of the ``fold`` column, each without its own fold; with
    ``classes`` a list of trees per fold, one per class indicator.

    All fits read one kept table, so the rows are prepared and stored once, not per fold.
    """
    params = TreeParams(**options)
    if classes is None:
        rows, layout = target_rows(frame, features, label, ["fold"], params.max_bins)
    else:
        rows, layout = class_rows(frame, features, label, ["fold"], params.max_bins)
    try:
        jobs = []
        for fold in range(folds):
            others = rows.filter(F.col("fold") != fold)
            if classes is None:
                jobs.append(others)
                continue
            for value in classes:
                indicator = {"m": (F.col("label") == F.lit(value)).cast("double"), "m2": F.lit(0.0)}
                jobs.append(others.withColumns(indicator))
        trees = in_parallel(
            frame.sparkSession, [lambda r=r: grow_mean_tree(r, features, layout, params) for r in jobs]
        )
        if classes is None:
            return trees
        return [trees[k * len(classes) : (k + 1) * len(classes)] for k in range(folds)]
    finally:
        rows.unpersist()


def grow_regression_tree(
    rows: DataFrame,
    features: Sequence[str],
    residual: Column,
    centre: float,
    layout: Layout,
    params: TreeParams,
) -> Tree:
    """Fit ``residual`` of (n, m, m2) rows; leaves are ``centre`` plus the mean residual.

    The residual is taken off each row's mean before squaring, so a small residual of a
    large target keeps its digits.
    """
    if params.max_bins is not None:
        rows, layout = snap(rows, layout)
    n, r = F.col("n"), residual.alias("r")
    sums = [F.expr(e) for e in ("sum(n) AS n", "sum(n * r) AS s", "sum(m2 + n * r * r) AS q")]
    total = rows.select(n, "m2", r).agg(*sums).first()
    whole_loss = total["q"] - total["s"] ** 2 / total["n"]
    flat = max(whole_loss, 0.0) * 1e-14

    def leaf_value(size: float, added: float) -> float:
        return round(centre + added / size, 8)

    root = Node(1, None, 0, None, None, None, leaf_value(total["n"], total["s"]), int(total["n"]))
    nodes = [root]
    open_nodes = {1: root} if whole_loss > 0 else {}
    while open_nodes and next(iter(open_nodes.values())).depth < params.max_depth:
        place = F.expr(Tree(nodes).place_sql(set(open_nodes))).alias("node")
        melted = criteria.melt_numeric(rows, features, [place, n, "m2", r], layout)
        melted = melted.filter(F.col("node").isNotNull())
        counted = histogram(melted, ["node"], layout, sums)
        table = criteria.loss_candidates(counted, ["node"], layout=layout)
        payload = ["feature", "threshold", "n_low", "s_low", "loss_low", "n_high", "s_high", "loss_high"]
        best = criteria.best_per_node(
            table, ["node"], payload, ["share", "-feature", "threshold"]
        )
        chosen = {row["node"]: row for row in best.collect()}
        following = {}
        for node_id, node in open_nodes.items():
            row = chosen.get(node_id)
            if row is None or not (
                node.n >= params.min_samples_split
                and min(row["n_low"], row["n_high"]) >= params.min_samples_leaf
                and (node.depth == 0 or row["usable_features"] > params.min_features_left)
            ):
                continue
            for step, (op, side) in enumerate((("<=", "low"), (">", "high"))):
                size = row[f"n_{side}"]
                child = Node(
                    2 * node_id + step,
                    node_id,
                    node.depth + 1,
                    features[row["feature"]],
                    op,
                    row["threshold"],
                    leaf_value(size, row[f"s_{side}"]),
                    int(size),
                )
                nodes.append(child)
                if row[f"loss_{side}"] > flat:
                    following[child.node_id] = child
        open_nodes = following
    return Tree(nodes)


def category_domains(frame: DataFrame, features: Sequence[str]) -> dict[str, list[str]]:
    """All values of each categorical column, as text."""
    values = criteria.melt_text(frame, features, []).distinct()
    found = values.orderBy("feature", "value").limit(MAX_CATEGORIES + 1).collect()
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories in {list(features)}: bin the columns first")
    domains: dict[str, list[str]] = {f: [] for f in features}
    for row in found:
        domains[features[row["feature"]]].append(row["value"])
    return domains


def fit_category_tree(
    frame: DataFrame,
    features: Sequence[str],
    label: str,
    method: str = "ID3",
    delta: float = 0.005,
    above_average_gain: bool = False,
) -> Tree:
    """Multiway tree by information gain (``ID3``) or gain ratio (``C4.5``).

    A node splits over the categories of the whole training table; a category without
    rows becomes a leaf with its parent's majority.  ``above_average_gain`` limits C4.5
    to features whose gain is at least the node's average.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    rows = category_rows(frame, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        domains = category_domains(rows, features)
        return grow_category_tree(rows, features, domains, method, delta, above_average_gain)
    finally:
        rows.unpersist()


def grow_category_tree(rows, features, domains, method, delta, above_average_gain) -> Tree:
    """One round of jobs per level. Rows carry their node and move to a child by a join with the new nodes, so the
    plan does not grow with the tree; the driver gets each open node's best feature and the new nodes' counts."""
    classes, counts = labels_of(rows)
    names = [f"c{k}" for k in range(len(classes))]
    root = Node(1, None, 0, None, None, None, majority(classes, counts), int(sum(counts)))
    nodes = [root]
    last_id = 1
    used: dict[int, list[int]] = {1: []}
    open_nodes = {1: (root, counts)} if gini_of(counts) > 0 else {}
    texts = F.array(*[F.col(quoted(f)).cast("string") for f in features]).alias("texts")
    placed = rows.select(texts, "label", "n", F.lit(1).cast("long").alias("node"), F.array().cast("array<int>").alias("used"))
    held = []
    try:
        while open_nodes:
            melted = placed.select("node", "label", "n", "used", F.posexplode("texts").alias("feature", "value"))
            melted = melted.filter("value IS NOT NULL AND NOT array_contains(used, feature)")
            table = melted.groupBy("node", "feature", "value").agg(
                *criteria.class_measures(F.col("label"), classes, F.col("n"))
            )
            table = table.persist(StorageLevel.MEMORY_AND_DISK)
            best = best_categories(table, names, method, above_average_gain)
            chosen = {}
            for node_id, (node, _) in open_nodes.items():
                row = best.get(node_id)
                if row is None or node.depth > 0 and len(features) - len(used[node_id]) <= 1:
                    continue
                if max(abs(1 - row["fewest"] / node.n), abs(1 - row["most"] / node.n)) >= 1e-4:
                    raise ValueError("branch shares of a feature do not sum to 1: fill missing values first")
                if row["score"] >= delta:
                    chosen[node_id] = row["feature"]
            following, moves = {}, []
            seen = branch_counts(table, chosen, names)
            for node_id, feature in chosen.items():
                node = open_nodes[node_id][0]
                for value in domains[features[feature]]:
                    last_id += 1
                    side = seen.get((node_id, value))
                    guess = node.prediction if side is None else majority(classes, side)
                    size = 0 if side is None else int(sum(side))
                    child = Node(last_id, node_id, node.depth + 1, features[feature], "=", value, guess, size)
                    nodes.append(child)
                    if side is not None and gini_of(side) > 0:
                        following[last_id] = (child, side)
                        used[last_id] = [*used[node_id], feature]
                        moves.append((node_id, feature, value, last_id, used[last_id]))
            open_nodes = following
            table.unpersist()
            if moves:
                placed = moved(placed, moves).persist(StorageLevel.MEMORY_AND_DISK)
                held.append(placed)
                # a level is computed from the one before it, which goes when its successor has been
                for old in held[:-2]:
                    old.unpersist()
                del held[:-2]
    finally:
        for frame in held:
            frame.unpersist()
    return Tree(nodes)


def best_categories(table: DataFrame, names: Sequence[str], method: str, above_average_gain: bool) -> dict[int, dict]:
    """Per node the best feature, the first in table order of equals, its score, and the range of features' sizes."""
    gains = criteria.category_gains(table, ["node"], len(names)).withColumn("size", criteria.added(names))
    key = "gain" if method == "ID3" else "gain_ratio"
    whole = gains.groupBy("node").agg(
        F.avg("gain").alias("average"), F.min("size").alias("fewest"), F.max("size").alias("most")
    )
    options = gains.join(whole, "node")
    if above_average_gain and method == "C4.5":
        options = options.filter("gain >= average - 1e-12")
    rank = F.struct(F.expr(f"-rint({key} * 1e10D)").alias("below"), "feature", F.col(key).alias("score"))
    best = options.groupBy("node").agg(F.min(rank).alias("best"), F.min("fewest").alias("fewest"), F.max("most").alias("most"))
    rows = best.select("node", "best.feature", "best.score", "fewest", "most").collect()
    return {row["node"]: row.asDict() for row in rows}


def branch_counts(table: DataFrame, chosen: dict[int, int], names: Sequence[str]) -> dict[tuple, list[float]]:
    """Class counts of the new nodes, by (node, value)."""
    if not chosen:
        return {}
    split = table.sparkSession.createDataFrame(list(chosen.items()), "node long, feature int")
    rows = table.join(F.broadcast(split), ["node", "feature"]).select("node", "value", *names).collect()
    return {(row["node"], row["value"]): [row[c] for c in names] for row in rows}


def moved(placed: DataFrame, moves: list[tuple]) -> DataFrame:
    """Rows of split nodes at their child; rows in leaves are left behind. The table of moves is a part of the tree,
    which the driver holds, so it may be broadcast."""
    schema = "node long, feature int, value string, child long, child_used array<int>"
    table = placed.sparkSession.createDataFrame(moves, schema)
    split = table.select("node", "feature").distinct()
    valued = placed.join(F.broadcast(split), "node").withColumn("value", F.get("texts", F.col("feature")))
    there = valued.join(F.broadcast(table.drop("feature")), ["node", "value"])
    return there.select("texts", "label", "n", F.col("child").alias("node"), F.col("child_used").alias("used"))


def fit_tree_depths(frame, features, label, depths: Sequence[int], **options) -> dict[int, Tree]:
    """Classification trees for several depths from one fit: a shallower tree is the top
    of the deepest one, so the sweep costs one set of level jobs."""
    deepest = fit_class_tree(frame, features, label, max_depth=max(depths), **options)
    return {d: Tree([node for node in deepest.nodes if node.depth <= d]) for d in depths}
