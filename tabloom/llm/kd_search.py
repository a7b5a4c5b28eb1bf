"""Exact top-k inner products by KD-trees, one per shard.

Every row gets a number of its own; vectors are dealt to shards by a hash of it. A shard's tree splits at the median of the widest side and keeps a
tight box, the least id and a run of rows for each node. A query goes through the nodes best first: the bound of a node
is the largest inner product that its box allows, and what is below the query's kth score (or at it, with larger ids
only) is cut. Each query searches one shard first; its kth score and id are then carried into all others. Queries travel
in blocks, and a task holds one shard and a bounded number of blocks, so all queries meet all rows without a row for
each pair.

Defined cases: components are floor(scale * x) with x as double; vectors that are null or hold null or non-finite
components, and rows with a null id, take no part; rows with one id are rows of their own: each is a candidate for the
others, and each that is a query returns its rows; vectors are compared with those of the same length only, empty ones with score 0; ties go to smaller ids; scores beyond 64 bits are
ranked as they are and given as the largest value; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabloom.llm.common import written

SCALE, TOP, QUERY_EVERY = 256, 5, 50
SHARD_ROWS, LEAF_ROWS = 8192, 256
BLOCK_QUERIES, BLOCKS_A_TASK = 256, 32
FOUND = "query_row long, query_id long, vec_id long, score long"
FOUND_ARROW = pa.schema([(n, pa.int64()) for n in ("query_row", "query_id", "vec_id", "score")])
LARGEST = 2**63 - 1


def whole_vectors(vectors: DataFrame, id_column="vec_id", vector_column="embedding", scale: int = SCALE) -> DataFrame:
    """(row, vec_id, length, whole): scaled vectors of the rows that take part; ``row`` is fixed once written."""
    x = F.col(vector_column).cast("array<double>")
    # floor() gives whole numbers beyond 64 bits wrongly; such doubles have no fraction
    big = float(2**52)
    floor = lambda v: F.when(F.abs(v * scale) < big, F.floor(v * scale).cast("double")).otherwise(v * scale)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), x.alias("x"))
    rows = rows.where("vec_id IS NOT NULL AND x IS NOT NULL")
    rows = rows.where(~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))
    return rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", F.size("x").alias("length"), F.transform("x", floor).alias("whole"))


class Tree:
    """Nodes as arrays, children after their parent; rows are in the order of the leaves."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, names: np.ndarray):
        self.order = np.arange(len(ids))
        self.low, self.high, self.children, self.spans, self.least = [], [], [], [], []
        self._grow(ids, rows)
        self.ids, self.rows, self.names = ids[self.order], rows[self.order], names[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, ids: np.ndarray, rows: np.ndarray) -> None:
        waiting = [(0, len(ids), None)]
        while waiting:
            first, last, parent = waiting.pop()
            here = self.order[first:last]
            low, high = rows[here].min(0), rows[here].max(0)
            node = len(self.spans)
            self.low.append(low)
            self.high.append(high)
            self.spans.append((first, last))
            self.least.append(int(ids[here].min()))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(node)
            side = high - low
            if last - first > LEAF_ROWS and side.size and side.max() > 0:
                middle = (last - first) // 2
                values = rows[here, side.argmax()]
                self.order[first:last] = here[np.argpartition(values, middle)]
                waiting += [(first, first + middle, node), (first + middle, last, node)]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query with a point of each node's box."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search(tree: Tree, own: int, query: np.ndarray, bounds: np.ndarray, kth: tuple, top: int) -> list[tuple]:
    """The query's best (score, -id), best first, without the row named ``own``; ``kth`` is a score and id that others
    have reached already."""
    best: list[tuple] = []  # a heap whose first entry is the worst of the kept ones
    worst = kth
    frontier = [(-bounds[0], 0)]
    while frontier:
        bound, node = heapq.heappop(frontier)
        if (-bound, -tree.least[node]) < worst:
            if -bound < worst[0]:
                break  # all that wait are lower still
            continue
        if tree.children[node]:
            for child in tree.children[node]:
                if bounds[child] >= worst[0]:
                    heapq.heappush(frontier, (-bounds[child], child))
            continue
        first, last = tree.spans[node]
        scores = tree.rows[first:last] @ query
        fits = np.flatnonzero((scores >= worst[0]) & (tree.names[first:last] != own))
        ids = tree.ids[first:last][fits]
        scores = scores[fits]
        if len(ids) > 4 * top:  # only the first few in order can stay
            keep = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[keep], scores[keep]
        for score, vec_id in zip(scores.tolist(), ids.tolist(), strict=True):
            entry = (score, -vec_id)
            if entry < worst:
                continue
            heapq.heappush(best, entry)
            if len(best) > top:
                heapq.heappop(best)
            if len(best) == top:
                worst = max(worst, best[0])
    return sorted(best, reverse=True)


def exact_matrix(rows: list, length: int, of_queries: list) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices as doubles if every inner product is exact so, else as Python integers."""
    a = np.array(rows, np.float64).reshape(len(rows), length)
    b = np.array(of_queries, np.float64).reshape(len(of_queries), length)
    largest = max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(length, 1)
    if largest < 2**53:
        return a, b
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(len(m), length)
    return whole(a), whole(b)


def _search_shard(top: int):
    def run(shard: pa.Table, blocks: pa.Table) -> pa.Table:
        none = FOUND_ARROW.empty_table()
        if not shard.num_rows or not blocks.num_rows:
            return none
        queries = [q for some in blocks.column("queries").to_pylist() for q in some]
        length = blocks.column("length")[0].as_py()
        rows, asked = exact_matrix(shard.column("whole").to_pylist(), length, [q["whole"] for q in queries])
        tree = Tree(shard.column("vec_id").to_numpy(), rows, shard.column("row").to_numpy())
        out = []
        for at in range(0, len(queries), BLOCK_QUERIES):
            bounds = tree.bounds(asked[at : at + BLOCK_QUERIES])
            for query, vector, bound in zip(queries[at:], asked[at : at + BLOCK_QUERIES], bounds):
                known = query["kth_score"] is not None
                kth = (query["kth_score"], -query["kth_id"]) if known else (-float("inf"), 0)
                found = search(tree, query["row"], vector, bound, kth, top)
                out += [(query["row"], query["vec_id"], -i, max(-LARGEST, min(LARGEST, int(s)))) for s, i in found]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], schema=FOUND_ARROW) if out else none

    return run


def _wave(queries: DataFrame, shards: DataFrame, here, top: int) -> DataFrame:
    """Search queries (row, vec_id, length, whole, kth_score, kth_id, home, n_shards) in the shards that ``here`` names."""
    asked = F.struct("row", "vec_id", "whole", "kth_score", "kth_id").alias("q")
    blocks = queries.groupBy("length", "home", "block", "n_shards").agg(F.collect_list(asked).alias("queries"))
    blocks = blocks.withColumn("task", F.floor(F.col("block") / BLOCKS_A_TASK))
    blocks = blocks.withColumn("shard", F.explode(here))
    tasks = blocks.select("length", "shard", "task").distinct()
    rows = shards.join(tasks, ["length", "shard"]).select(
        "row", "vec_id", "whole", *[F.col(k).alias(f"of_{k}") for k in ("length", "shard", "task")]
    )
    grouped = rows.groupBy("of_length", "of_shard", "of_task")
    return grouped.cogroup(blocks.groupBy("length", "shard", "task")).applyInArrow(_search_shard(top), FOUND)


def top_inner_products(
    spark: SparkSession, vectors: DataFrame, every: int = QUERY_EVERY, top: int = TOP,
    id_column="vec_id", vector_column="embedding", shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id is divisible by ``every`` against all other rows."""
    whole = written(spark, whole_vectors(vectors, id_column, vector_column), "vectors")
    sizes = whole.groupBy("length").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("n_shards"),
                                        F.ceil(F.count(F.when(F.col("vec_id") % every == 0, 1)) / BLOCK_QUERIES)
                                        .cast("int").alias("n_blocks"))
    placed = whole.join(sizes, "length").withColumn("shard", F.pmod(F.xxhash64("row"), F.col("n_shards")).cast("int"))
    shards = placed.select("row", "vec_id", "length", "whole", "shard")
    queries = placed.where(F.col("vec_id") % every == 0).withColumn(
        "block", F.pmod(F.hash("row"), F.col("n_blocks")).cast("int")
    ).withColumn("home", F.pmod("block", F.col("n_shards")).cast("int"))
    none = F.lit(None).cast("long")
    first = _wave(queries.withColumns({"kth_score": none, "kth_id": none}), shards, F.array("home"), top)
    first = written(spark, first, "first-wave")
    by_score = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == top)
    kth = kth.select(F.col("query_row").alias("row"), F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    others = F.filter(F.sequence(F.lit(0), F.col("n_shards") - 1), lambda s: s != F.col("home"))
    rest = _wave(queries.join(kth, "row", "left"), shards, others, top)
    ranked = first.union(rest).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
