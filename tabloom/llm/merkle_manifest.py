"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf; a tree for each value of a column (a language, say) orders its leaves, and the subroots of the
trees are the leaves of a last tree, whose root stands for the dataset. A level is a table (tree, size, at, digest).
Nodes meet their siblings by an equijoin of the level with itself on computed places: at XOR 1 in a binary tree, the
places at the other slot offsets of the run otherwise. Rows of slot zero then emit the parents, so every level is as many
times smaller as the tree is wide, and all levels together move about twice the digests of the leaves.

Proofs go the other way: a node's path is its own siblings and then its parent's path, so one equijoin on the
parent's place for each level carries paths down from the root, those of the last tree first. No row ever meets all its
ancestors, and no table has a row for a leaf and a level. Paths are written every ``LEVELS_A_PLAN`` levels, so no plan
has more joins than that and the driver's memory does not grow with the levels.

Places come from one range sort of (tree, order, digest): a row's place is its number in its partition plus the rows of its tree in
partitions before, so no tree is ever in one task. Texts are read once and never moved. Levels of up to ``SMALL`` nodes
are joined in one task, without a shuffle or a broadcast that the driver would hold; the bound is on counted rows, and
the way does not change a digest.

Defined cases: a null field is a dash; a null tree is one of its own and comes first; in a tree null orders come
first, and rows with one order are in the order of their digests, so repeated rows are leaves beside each other; a
long at its limit is tampered beyond 64 bits; rows without an order are never tampered with; an empty table gives an empty result; other columns are
ignored; texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabloom.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TREE, ORDER, COUNTER = "lang", "doc_id", "n_chars"
ARITY = 2
TAMPER_EVERY = 7
SMALL = 4_096
LEVELS_A_PLAN = 3
STEPS = "array<struct<before:binary,after:binary>>"


def hashed(data: Column) -> Column:
    """SHA-256 of a string, as bytes."""
    return F.unhex(F.sha2(data, 256))


def digits(digest: Column) -> Column:
    """Digests as hex text; those of several, one after another, are the text of their concatenation."""
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value with its length in bytes before it, a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Sequence[Column]) -> Column:
    return hashed(F.concat(*[field(f) for f in fields]))


def placed(spark: SparkSession, rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with ``at``, their place in their tree by ``order``, and ``size``, the rows of the tree."""
    keys = [F.asc_nulls_first(c) for c in ("tree", *order)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # the number holds the partition above its 33rd bit; once written it stays, whatever is computed again
    numbered = written(spark, sorted_rows.withColumn("number", F.monotonically_increasing_id()), "numbered")
    runs = numbered.groupBy("tree", F.shiftright("number", 33).alias("part")).agg(
        F.min("number").alias("first"), F.count("*").alias("rows")
    )  # a row for each tree of a partition
    before = Window.partitionBy("tree").orderBy("part")
    runs = runs.withColumn("offset", F.sum("rows").over(before) - F.col("rows"))
    runs = runs.withColumn("size", F.sum("rows").over(Window.partitionBy("tree")))
    runs = runs.select(F.col("tree").alias("of_tree"), "part", "first", "offset", "size")
    here = numbered.withColumn("part", F.shiftright("number", 33))
    met = here.join(runs, (here["part"] == runs["part"]) & here["tree"].eqNullSafe(runs["of_tree"]))
    at = F.col("number") - F.col("first") + F.col("offset")
    return written(spark, met.select(*rows.columns, at.alias("at"), "size"), "placed")


def rows_of_levels(leaves: DataFrame, arity: int) -> list[int]:
    """The numbers of nodes from the leaves up: a tree of ``size`` leaves has size / arity^k nodes, rounded up, in level k."""
    powers = F.array(*[F.lit(arity**k).cast("long") for k in range(62) if arity**k < 1 << 62])
    wide = F.filter(powers, lambda power: F.col("size") > power / arity)
    levels = leaves.where("at = 0").select("size", F.posexplode(wide).alias("level", "power"))
    found = levels.groupBy("level").agg(F.sum(F.expr("(size + power - 1) div power")).alias("rows"))
    return [r["rows"] for r in found.orderBy("level").collect()]  # as many as a tree is high


def in_one_task(frame: DataFrame) -> DataFrame:
    """A frame of few rows, to be joined with others of that kind without a shuffle or a broadcast."""
    return frame.coalesce(1).hint("merge")


def with_siblings(level: DataFrame, rows: int, arity: int) -> DataFrame:
    """The nodes with ``step``: the digests of their run before and after their own, each concatenated; a tree's root has none."""
    others = level.select(
        F.col("tree").alias("of_tree"), F.col("at").alias("of_at"), F.col("digest").alias("of_digest")
    )
    few = in_one_task if rows <= SMALL else lambda frame: frame
    slot = F.col("at") % arity
    found = few(level)
    for shift in range(1, arity):
        if arity == 2:
            place = F.col("at").bitwiseXOR(F.lit(1).cast("long"))
        else:
            place = F.col("at") - slot + (slot + shift) % arity
        right = few(others.select("of_tree", "of_at", F.col("of_digest").alias(f"sibling_{shift}")))
        found = found.withColumn("place", place)
        met = found["tree"].eqNullSafe(right["of_tree"]) & (found["place"] == right["of_at"])
        found = found.join(right, met, "left").drop("of_tree", "of_at", "place")
    none = F.lit(b"")
    sibling = lambda shift: F.coalesce(F.col(f"sibling_{shift}"), none)
    after = F.concat(none, *[F.when(slot + s < arity, sibling(s)).otherwise(none) for s in range(1, arity)])
    before = F.concat(none, *[F.when(slot + s >= arity, sibling(s)).otherwise(none) for s in range(1, arity)])
    step = F.when(F.col("size") > 1, F.struct(before.alias("before"), after.alias("after")))
    return found.select(*level.columns, step.alias("step"))


def folded(digest: Column, step: Column) -> Column:
    """The parent's digest."""
    return hashed(digits(F.concat(step["before"], digest, step["after"])))


def levels_of(spark: SparkSession, leaves: DataFrame, arity: int) -> list[tuple[DataFrame, int]]:
    """The written levels from the leaves (tree, size, at, digest, ...) up, with their numbers of rows.

    Nodes of trees that go on have their ``step``, the root of a tree has none.
    """
    levels, nodes = [], leaves
    for rows in rows_of_levels(leaves, arity):
        level = written(spark, with_siblings(nodes, rows, arity), "level")
        levels.append((level, rows))
        nodes = level.where(F.col("step").isNotNull() & (F.col("at") % arity == 0)).select(
            "tree", F.expr(f"(size + {arity - 1}) div {arity}").alias("size"),
            F.expr(f"at div {arity}").alias("at"), folded(F.col("digest"), F.col("step")).alias("digest"),
        )
    return levels


def roots_of(levels: list[tuple[DataFrame, int]]) -> DataFrame:
    """(tree, subroot, height) of every tree, the height being the level of its root."""
    found = None
    for height, (level, _) in enumerate(levels):
        here = level.where(F.col("step").isNull()).select("tree", F.col("digest").alias("subroot"), F.lit(height).alias("height"))
        found = here if found is None else found.unionByName(here)
    return found


def paths(spark: SparkSession, levels: list[tuple[DataFrame, int]], roots: DataFrame, arity: int) -> DataFrame:
    """The leaves with ``subroot``, the digest of their tree's root, and ``path``, the steps up to the last root.

    ``roots`` (tree, height, subroot, path) has the steps that follow the root of each tree; a root meets its own row as
    if that were its parent's. Every few levels the paths are written, so that a plan has few joins.
    """
    known = None
    for height, (level, rows) in reversed(list(enumerate(levels))):
        few = in_one_task if rows <= SMALL else lambda frame: frame
        parents = roots.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("at"), "subroot", "path")
        parents = parents if known is None else parents.unionByName(known)
        parents = parents.select(F.col("tree").alias("of_tree"), F.col("at").alias("of_at"), F.col("path").alias("of_path"), "subroot")
        parents, nodes = few(parents), few(level.withColumn("parent", F.expr(f"at div {arity}")))
        met = nodes["tree"].eqNullSafe(parents["of_tree"]) & (nodes["parent"] == parents["of_at"])
        path = F.when(F.col("step").isNull(), F.col("of_path")).otherwise(F.concat(F.array("step"), "of_path"))
        nodes = nodes.join(parents, met).withColumn("path", path)
        if not height:
            return nodes.select(*level.columns, "subroot", "path")
        known = nodes.select("tree", "at", "subroot", "path")
        if height % LEVELS_A_PLAN == 0:
            known = written(spark, known, "paths")


def manifest(
    spark: SparkSession, documents: DataFrame, fields: Sequence[str] = FIELDS, tree: str = TREE, order: str = ORDER,
    counter: str = COUNTER, arity: int = ARITY, tamper_every: int = TAMPER_EVERY,
) -> DataFrame:
    """doc_id, leaf, subroot, root, path, proof_sha256, folded_root and verified of every row.

    ``path`` has the sibling digests of each level, the first next to the leaf. ``folded_root`` is what a verifier gets
    from the row as it stands: where ``tamper_every`` divides the checksum of its order, one has been added to its
    counter.
    """
    if not 2 <= arity <= 16:
        raise ValueError("a run has 2 to 16 nodes")
    column = lambda name: F.col(f"`{name}`")
    raised = (column(counter).cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = F.crc32(column(order).cast("string").cast("binary")) % tamper_every == 0
    leaves = documents.select(
        column(tree).cast("string").alias("tree"),
        column(order).cast("long").alias("doc_id"),
        leaf_of([column(f) for f in fields]).alias("digest"),
        F.when(changed, leaf_of([raised if f == counter else column(f) for f in fields])).alias("tampered"),
    )
    levels = levels_of(spark, placed(spark, leaves, ["doc_id", "digest"]), arity)
    no_steps = F.array().cast(STEPS)
    if not levels:
        return shown_rows(leaves.limit(0).selectExpr("*", "digest AS subroot", "digest AS root").withColumn("path", no_steps))
    roots = written(spark, roots_of(levels), "roots")
    top = roots.select(F.lit(0).alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("digest"))
    top_levels = levels_of(spark, placed(spark, top, ["name"]), arity)
    last = written(spark, roots_of(top_levels).withColumn("path", no_steps), "last-root")
    above = paths(spark, top_levels, last, arity).select(F.col("name").alias("of_tree"), "path")
    root = bytes(last.select("subroot").head()[0])  # one row
    above = roots.join(above, roots["tree"].eqNullSafe(above["of_tree"])).drop("of_tree")
    return shown_rows(paths(spark, levels, written(spark, above, "paths"), arity).withColumn("root", F.lit(root)))


def shown_rows(rows: DataFrame) -> DataFrame:
    """Digests as text, and what a verifier gets, of the leaves with their ``subroot``, ``root`` and ``path``."""
    hashes = F.transform("path", lambda s: digits(F.concat(s["before"], s["after"])))
    shown = F.coalesce("tampered", "digest")
    result = rows.select(
        "doc_id", digits(F.col("digest")).alias("leaf"), digits(F.col("subroot")).alias("subroot"),
        digits(F.col("root")).alias("root"), "path", F.sha2(F.array_join(hashes, ""), 256).alias("proof_sha256"),
        digits(F.aggregate("path", shown, folded)).alias("folded_root"),
    )
    return result.withColumn("verified", F.col("folded_root") == F.col("root"))
