"""A fitted tree: a few rows of plain data that compile to one CASE expression."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions import double_sql, quoted


@dataclass(frozen=True)
class Node:
    """A node with the rule that leads into it; the root has none."""

    node_id: int
    parent_id: int | None
    depth: int
    feature: str | None
    op: str | None
    value: float | str | None
    prediction: object
    n: int

    @property
    def rule(self) -> str | None:
        if self.feature is None:
            return None
        return f"{self.feature} {self.op} {self.value}"

    def condition_sql(self) -> str:
        if isinstance(self.value, str):
            return f"CAST({quoted(self.feature)} AS STRING) {self.op} {text_sql(self.value)}"
        return f"{quoted(self.feature)} {self.op} {double_sql(self.value)}"


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_sql(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return text_sql(value)
    if isinstance(value, bool) or isinstance(value, int):
        return str(value)
    return double_sql(value)


NODE_SCHEMA = T.StructType(
    [
        T.StructField("node_id", T.LongType(), False),
        T.StructField("parent_id", T.LongType()),
        T.StructField("depth", T.IntegerType(), False),
        T.StructField("feature", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("is_leaf", T.BooleanType(), False),
        T.StructField("prediction", T.StringType()),
        T.StructField("n", T.LongType(), False),
    ]
)


class Tree:
    """Nodes in level order. Rows that match no rule on their way score NULL."""

    def __init__(self, nodes: list[Node]):
        self.nodes = nodes
        self._children: dict[int, list[Node]] = {}
        for node in nodes:
            if node.parent_id is not None:
                self._children.setdefault(node.parent_id, []).append(node)

    @property
    def root(self) -> Node:
        return self.nodes[0]

    def children(self, node: Node) -> list[Node]:
        return self._children.get(node.node_id, [])

    def leaves(self) -> Iterator[Node]:
        return (node for node in self.nodes if not self.children(node))

    def features(self) -> set[str]:
        return {node.feature for node in self.nodes if node.feature is not None}

    def prediction_sql(self, node: Node | None = None) -> str:
        node = node or self.root
        below = self.children(node)
        if not below:
            return literal_sql(node.prediction)
        branches = " ".join(f"WHEN {c.condition_sql()} THEN {self.prediction_sql(c)}" for c in below)
        return f"CASE {branches} END"

    def place_sql(self, open_ids: set[int], node: Node | None = None) -> str | None:
        """The open node a row falls into, NULL for rows already in a leaf."""
        node = node or self.root
        if node.node_id in open_ids:
            return str(node.node_id)
        parts = []
        for child in self.children(node):
            inner = self.place_sql(open_ids, child)
            if inner is not None:
                parts.append(f"WHEN {child.condition_sql()} THEN {inner}")
        return f"CASE {' '.join(parts)} END" if parts else None

    def column(self, fallback: object = None) -> Column:
        score = F.expr(self.prediction_sql())
        return score if fallback is None else F.coalesce(score, F.lit(fallback))

    def score(self, frame: DataFrame, name: str = "prediction", fallback: object = None) -> DataFrame:
        missing = self.features() - set(frame.columns)
        if missing:
            raise ValueError(f"columns missing for scoring: {sorted(missing)}")
        return frame.withColumn(name, self.column(fallback))

    def leaf_majority(self) -> object:
        """The prediction most leaves give (smallest on ties): a fallback for null scores."""
        votes = Counter(leaf.prediction for leaf in self.leaves())
        return min(votes, key=lambda p: (-votes[p], p))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                n.node_id,
                n.parent_id,
                n.depth,
                n.feature,
                n.op,
                None if n.value is None else str(n.value),
                n.rule,
                not self.children(n),
                None if n.prediction is None else str(n.prediction),
                n.n,
            )
            for n in self.nodes
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)
