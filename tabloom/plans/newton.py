"""Gradient boosting with Newton leaves: logistic loss for two classes, softmax for more, many models in step.

A model is a group: the rows that it leaves out (its fold) and its settings. All groups grow together. A level is one
job over one table of rows (bins, class, fold, margins), whatever the number of folds, settings and classes: a task
routes its rows through all unfinished trees and adds up gradients and curvatures by (tree node, feature, bin) in
arrays; Spark sums the arrays' cells, ranks the cuts of every node, and the driver gets one row for each node asked
about. The first job of a round also has the held-out rows' metric of the trees so far, from the same pass.

Rows are binned once and packed, a byte or two a feature. Their margins are carried in the table; trees that are not
in them yet travel with the job, and every few rounds a checkpoint in the shared folder takes them in. Equal rows are
one row with a weight where the bins are few. What a job moves is bounded by nodes x features x bins for each task.

Missing values count as smaller than any other, in fits and scores. Rows without a label take no part.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabloom.functions import nan_to_null, quoted
from tabloom.operators.ordered import lay_out
from tabloom.plans.compact import FOLD_RATIO
from tabloom.plans.tree_model import NODE_SCHEMA, Node, Tree
from tabloom.session import shared_dir

MAX_CLASSES = 1_000
ROUNDS_PER_CHECKPOINT = 10
SCORE_STEPS = 10_000  # the stopping AUC tells probabilities apart that are further apart than one in so many
GAIN_DIGITS = 6  # gains that agree to so many decimals are ties: the first feature and its lowest cut win
BETTER = 1e-9
NO_FOLD, NONE_LEFT_OUT = -1, -2
MISSING = -sys.float_info.max  # what a missing value scores as
LARGEST_MARGIN = 700.0
METRICS = {"binary": "auc", "multiclass": "f1_macro"}


@dataclass(frozen=True)
class BoostParams:
    """Names and defaults follow gradient boosting packages. A tree grows best leaf first up to ``num_leaves``;
    ``max_depth`` below one sets no limit. ``early_stopping_rounds`` cuts a model with held-out rows back to its
    best round once so many rounds have not been better. ``max_bin`` holds for a whole fit and not for one setting."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = -1
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    min_child_weight: float = 1e-3
    min_child_samples: int = 20
    min_split_gain: float = 0.0
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    early_stopping_rounds: int | None = None
    random_state: int = 666

    def __post_init__(self):
        if self.num_leaves < 2 or self.n_estimators < 1:
            raise ValueError("num_leaves must be at least 2 and n_estimators at least 1")
        if not 0 < self.subsample <= 1 or not 0 < self.colsample_bytree <= 1:
            raise ValueError("subsample and colsample_bytree must be above 0 and at most 1")

    @property
    def deepest(self) -> float:
        return self.max_depth if self.max_depth > 0 else math.inf

    def leaf(self, g: float, h: float) -> float:
        shrunk = math.copysign(max(abs(g) - self.reg_alpha, 0.0), g)
        return -self.learning_rate * shrunk / (h + self.reg_lambda) if h + self.reg_lambda > 0 else 0.0

    def features(self, count: int, number: int) -> list[int]:
        """The columns a round may split on, those with the smallest hashes."""
        if self.colsample_bytree >= 1:
            return list(range(count))
        draws = mixed(np.arange(count, dtype=np.uint64) + np.uint64(self.random_state * 1_000_003 + number * 7919))
        return sorted(np.argsort(draws, kind="stable")[: max(1, round(count * self.colsample_bytree))].tolist())


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Cell:
    """A node of a tree that grows: its sums, and its best cut once that is known."""

    depth: int
    path: int  # 1 at the root, then twice the parent's and one more on the high side
    g: float = 0.0
    h: float = 0.0
    n: float = 0.0
    known: bool = False
    cut: tuple[int, int] | None = None
    gain: float = 0.0
    sides: tuple = ()
    low: int = -1
    high: int = -1


class Growing:
    """One tree, best leaf first. Children of leaves that may be next are asked about ahead, so that a tree takes about
    as many jobs as it is deep; the result does not depend on what was asked ahead."""

    def __init__(self, params: BoostParams):
        self.params = params
        self.cells = [Cell(0, 1)]
        self.chosen: list[int] = []
        self.done = False

    def _opened(self, at: int) -> tuple[int, int]:
        cell = self.cells[at]
        if cell.low < 0:
            for step, (name, side) in enumerate(zip(("low", "high"), cell.sides, strict=True)):
                child = Cell(cell.depth + 1, 2 * cell.path + step, *side)
                child.known = child.depth >= self.params.deepest or child.n < 2 * self.params.min_child_samples
                setattr(cell, name, len(self.cells))
                self.cells.append(child)
        return cell.low, cell.high

    def asked(self) -> list[int]:
        """Nodes whose best cut is wanted next; none when the tree is finished."""
        if self.done:
            return []
        leaves, self.chosen = [0], []
        while True:
            if any(not self.cells[x].known for x in leaves):
                break
            able = [x for x in leaves if self.cells[x].cut is not None]
            if not able or len(leaves) >= self.params.num_leaves:
                self.done = True
                return []
            best = max(able, key=lambda x: (round(self.cells[x].gain, GAIN_DIGITS), -self.cells[x].path))
            self.chosen.append(best)
            leaves.remove(best)
            leaves += self._opened(best)
        room = self.params.num_leaves - len(leaves)
        able = sorted((x for x in leaves if self.cells[x].cut is not None), key=lambda x: -self.cells[x].gain)
        for x in able[:room]:
            leaves += self._opened(x)
        return [x for x in leaves if not self.cells[x].known]

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Feature (-1 at a leaf), bin and children of every node so far."""
        rows = [(c.cut[0], c.cut[1], c.low, c.high) if c.low >= 0 else (-1, 0, 0, 0) for c in self.cells]
        return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True))

    def finished(self) -> Grown:
        rows, order = [], {0: 0}
        for at in self.chosen:
            for child in (self.cells[at].low, self.cells[at].high):
                order[child] = len(order)
        split = set(self.chosen)
        for at in order:
            cell = self.cells[at]
            value = self.params.leaf(cell.g, cell.h)
            if at in split:
                rows.append((*cell.cut, order[cell.low], order[cell.high], value, cell.n, cell.gain))
            else:
                rows.append((-1, 0, 0, 0, value, cell.n, 0.0))
        return Grown(*(tuple(x) for x in zip(*rows, strict=True)))


@dataclass(frozen=True)
class Grown:
    """A finished tree over bins; a row goes low where its bin is at most the cut."""

    feature: tuple[int, ...]
    cut: tuple[int, ...]
    low: tuple[int, ...]
    high: tuple[int, ...]
    value: tuple[float, ...]
    n: tuple[float, ...]
    gain: tuple[float, ...]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x, np.int64) for x in (self.feature, self.cut, self.low, self.high))

    def tree(self, names: Sequence[str], edges: Sequence[Sequence[float]]) -> Tree:
        nodes = [Node(1, None, 0, None, None, None, self.value[0], int(self.n[0]))]
        waiting = [(0, nodes[0])]
        while waiting:
            at, node = waiting.pop(0)
            if self.feature[at] < 0:
                continue
            name, cut = names[self.feature[at]], self.cut[at]
            threshold = edges[self.feature[at]][cut - 1] if cut else MISSING  # bin 0 holds missing values
            for step, (op, below) in enumerate((("<=", self.low[at]), (">", self.high[at]))):
                child = Node(
                    2 * node.node_id + step, node.node_id, node.depth + 1, name, op, threshold,
                    self.value[below], int(self.n[below]),
                )
                nodes.append(child)
                waiting.append((below, child))
        return Tree(nodes)


def routed(bins: np.ndarray, arrays: tuple[np.ndarray, ...]) -> np.ndarray:
    """The node that each row ends in."""
    feature, cut, low, high = arrays
    at = np.zeros(len(bins), np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return at
        node = at[inner]
        at[inner] = np.where(bins[inner, feature[node]] <= cut[node], low[node], high[node])


@dataclass
class Group:
    """A model in the making: the fold it leaves out, its settings, its start and its rounds of trees by class."""

    fold: int
    params: BoostParams
    start: np.ndarray
    rounds: list[tuple[Grown, ...]] = field(default_factory=list)
    history: list[float] = field(default_factory=list)
    stopped: bool = False
    taken: int = 0  # rounds that the margins in the table have taken in

    def best_round(self) -> int:
        """The first of the best rounds; without held-out rows or stopping, all of them."""
        if not self.history:
            return len(self.rounds)
        best = 0
        for i, value in enumerate(self.history):
            if value > self.history[best] + BETTER:
                best = i
        return best + 1

    def saw(self, value: float | None) -> None:
        if value is None:
            raise ValueError(f"the stopping metric has no value in fold {self.fold}: use fewer or stratified folds")
        self.history.append(value)
        self.stopped |= len(self.history) - self.best_round() >= self.params.early_stopping_rounds


def shares(margins: np.ndarray) -> np.ndarray:
    """Class probabilities of rows of margins: of class 1 from one column, of all from several."""
    if margins.shape[1] == 1:
        return 1 / (1 + np.exp(-np.clip(margins, -LARGEST_MARGIN, LARGEST_MARGIN)))
    top = np.exp(margins - margins.max(1, keepdims=True))
    return top / top.sum(1, keepdims=True)


STATE = "fold int, y int, n double, u long, bins binary, margins binary"
STATE_ARROW = pa.schema(
    [("fold", pa.int32()), ("y", pa.int32()), ("n", pa.float64()), ("u", pa.int64()), ("bins", pa.binary()),
     ("margins", pa.binary())]
)
SUMS = "slot int, feature int, bin int, g double, h double, n double"
SUMS_ARROW = pa.schema([(c, pa.int32()) for c in ("slot", "feature", "bin")] + [(c, pa.float64()) for c in ("g", "h", "n")])


@dataclass(frozen=True)
class Job:
    """What a task needs: the trees to add to the margins, and those that grow with the nodes asked about."""

    width: int  # margins of a group
    columns: int
    bin_type: str
    most_bins: int
    folds: tuple[int, ...]
    starts: tuple[np.ndarray, ...]
    added: tuple[tuple[tuple[int, tuple, np.ndarray], ...], ...]  # by group: (class, arrays, values)
    growing: tuple[tuple[tuple[int, tuple, np.ndarray, tuple[int, ...]], ...], ...]  # by group: (class, arrays, slots, features)
    sampled: tuple[tuple[float, int], ...]  # by group: share of rows, key of the draw
    judged: tuple[int, ...]
    slots: int


def _unpacked(batch: pa.RecordBatch, job: Job) -> tuple[np.ndarray, ...]:
    rows = batch.num_rows
    fold, y, n, u = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
    bins = np.frombuffer(b"".join(batch.column(4).to_pylist()), job.bin_type).reshape(rows, job.columns)
    margins = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.float64).reshape(rows, -1, job.width).copy()
    for group, trees in enumerate(job.added):
        for cls, arrays, values in trees:
            margins[:, group, cls] += values[routed(bins, arrays)]
    return fold, y, n, u, bins, margins


def _taken_in(job: Job):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margins = _unpacked(batch, job)[5]
                packed = pa.array([row.tobytes() for row in margins], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], packed], schema=STATE_ARROW)

    return run


def _summed(job: Job):
    """Cells (slot, feature, bin) of the nodes asked about; slots below zero hold the held-out rows of a group:
    feature is the class, bin the rounded probability or the likeliest class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = job.slots * job.columns * job.most_bins
        sums = np.zeros((3, size))
        truth = max(job.width, 2)
        verdict_bins = SCORE_STEPS + 1 if job.width == 1 else truth
        verdicts = {group: np.zeros(truth * verdict_bins) for group in job.judged}
        for batch in batches:
            if not batch.num_rows:
                continue
            fold, y, n, u, bins, margins = _unpacked(batch, job)
            for group, held in enumerate(job.folds):
                if group in verdicts and (here := np.flatnonzero(fold == held)).size:
                    p = shares(margins[here, group] + job.starts[group])
                    guess = np.rint(p[:, 0] * SCORE_STEPS).astype(np.int64) if job.width == 1 else p.argmax(1)
                    verdicts[group] += np.bincount(y[here] * verdict_bins + guess, n[here], truth * verdict_bins)
                if not job.growing[group]:
                    continue
                share, key = job.sampled[group]
                train = fold != held
                if share < 1:
                    train &= (mixed(u.view(np.uint64) + np.uint64(key)) >> np.uint64(11)) < share * 2**53
                train = np.flatnonzero(train)
                p = shares(margins[train, group] + job.starts[group])
                for cls, arrays, slots, features in job.growing[group]:
                    slot = slots[routed(bins[train], arrays)]
                    asked = np.flatnonzero(slot >= 0)
                    rows, share_of = train[asked], p[asked, cls]
                    is_class = y[rows] == (1 if job.width == 1 else cls)
                    weights = n[rows] * (share_of - is_class), n[rows] * share_of * (1 - share_of), n[rows]
                    for f in features:
                        cell = (slot[asked] * job.columns + f) * job.most_bins + bins[rows, f]
                        low, high = (int(cell.min()), int(cell.max()) + 1) if len(cell) else (0, 0)
                        for k, w in enumerate(weights):
                            sums[k, low:high] += np.bincount(cell - low, w, high - low)
        full = np.flatnonzero(sums[2])
        rest, bin_of = np.divmod(full, job.most_bins)
        slot, feature = np.divmod(rest, job.columns)
        columns = [[slot], [feature], [bin_of], [sums[0, full]], [sums[1, full]], [sums[2, full]]]
        for group, counts in verdicts.items():
            seen = np.flatnonzero(counts)
            cls, guess = np.divmod(seen, verdict_bins)
            none = np.zeros(len(seen))
            for column, more in zip(columns, (none - 1 - group, cls, guess, none, none, counts[seen]), strict=True):
                column.append(more)
        arrays = [pa.array(np.concatenate(c), f.type, safe=False) for c, f in zip(columns, SUMS_ARROW, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=SUMS_ARROW)

    return run


def best_cuts(sums: DataFrame, settings: DataFrame) -> DataFrame:
    """One row per slot: its totals, and its best cut if one is allowed by ``settings`` (slot, alpha, ..)."""
    place = "PARTITION BY slot, feature"
    upto = f"OVER ({place} ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    rows = sums.where("slot >= 0").selectExpr(
        "slot", "feature", "bin", *[f"sum({m}) {upto} AS {m}_low" for m in "ghn"],
        *[f"sum({m}) OVER ({place}) AS {m}" for m in "ghn"],
    )
    rows = rows.join(settings, "slot").selectExpr("*", *[f"{m} - {m}_low AS {m}_high" for m in "ghn"])
    worth = lambda s: f"power(greatest(abs(g{s}) - alpha, 0D), 2) / nullif(h{s} + lambda, 0D)"
    rows = rows.selectExpr("*", f"{worth('_low')} + {worth('_high')} - {worth('')} AS gain")
    fits = f"""n_high > 0 AND least(n_low, n_high) >= fewest AND least(h_low, h_high) >= lightest
        AND gain > least_gain AND round(gain, {GAIN_DIGITS}) > 0"""
    rows = rows.withColumn("fits", F.coalesce(F.expr(fits), F.lit(False)))
    order = F.struct("fits", F.when(F.col("fits"), F.round("gain", GAIN_DIGITS)), -F.col("feature"), -F.col("bin"))
    payload = "fits", "feature", "bin", "gain", *[f"{m}{s}" for s in ("", "_low", "_high") for m in "ghn"]
    return rows.groupBy("slot").agg(F.max_by(F.struct(*payload), order).alias("best")).select("slot", "best.*")


def verdicts(sums: DataFrame, objective: str) -> DataFrame:
    """(slot, value) of the held-out rows' metric."""
    held = sums.where("slot < 0")
    if objective == "binary":
        cells = held.groupBy("slot", "bin").agg(
            F.sum(F.when(F.col("feature") == 1, F.col("n")).otherwise(0.0)).alias("pos"),
            F.sum(F.when(F.col("feature") == 1, 0.0).otherwise(F.col("n"))).alias("neg"),
        )
        # at most SCORE_STEPS + 1 rows a group
        below = F.sum("neg").over(Window.partitionBy("slot").orderBy("bin")) - F.col("neg") / 2
        pairs = F.sum(F.col("pos") * F.col("below")) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))
        return cells.withColumn("below", below).groupBy("slot").agg(pairs.alias("value"))
    sides = held.selectExpr(
        "slot",
        """inline(array(struct(feature AS class, IF(feature = bin, n, 0D) AS tp, 0D AS fp, IF(feature = bin, 0D, n) AS fn),
                        struct(bin AS class, 0D AS tp, IF(feature = bin, 0D, n) AS fp, 0D AS fn)))""",
    )
    by_class = sides.groupBy("slot", "class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return by_class.groupBy("slot").agg(F.avg(F.expr("2 * tp / (2 * tp + fp + fn)")).alias("value"))


@dataclass(frozen=True)
class Prepared:
    """Binned rows of a fit; ``edges`` are the upper ends of all bins of a column but the last."""

    rows: DataFrame
    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    labels: tuple
    objective: str
    counts: dict[tuple[int, int], float]  # by (fold, class)
    kept: DataFrame | None = None  # what is persisted until the fit's first checkpoint

    @property
    def width(self) -> int:
        return 1 if self.objective == "binary" else len(self.labels)

    @property
    def most_bins(self) -> int:
        return max(len(e) for e in self.edges) + 2  # a bin for missing values

    @property
    def bin_type(self) -> str:
        return "u1" if self.most_bins <= 256 else "<u2"


def bin_edges(frame: DataFrame, features: Sequence[str], max_bin: int) -> tuple[tuple[float, ...], ...]:
    """Midpoints of neighbouring values, or quantiles of the distinct values of columns with more than ``max_bin``."""
    layout = lay_out(frame, features, slices=max_bin, small_domain=max_bin)
    narrow = [i for i, points in enumerate(layout.boundaries) if not points]
    edges = [tuple(sorted(points)) for points in layout.boundaries]
    if narrow:
        pairs = ", ".join(f"struct({i} AS feature, CAST({quoted(features[i])} AS DOUBLE) AS x)" for i in narrow)
        values = frame.selectExpr(f"inline(array({pairs}))").filter("x IS NOT NULL")
        # the number of values was an estimate, but it is near ``max_bin`` at most
        for row in values.groupBy("feature").agg(F.sort_array(F.collect_set("x")).alias("xs")).collect():
            xs = [x for x in row["xs"] if math.isfinite(x)]
            edges[row["feature"]] = tuple((a + b) / 2 for a, b in zip(xs, xs[1:]))
    return tuple(edges)


def prepared(
    frame: DataFrame, features: Sequence[str], label: str, objective: str, *, key: str | None = None,
    fold: Column | None = None, max_bin: int = 255, whole_rows: bool = False,
) -> Prepared:
    """Bin and pack the labelled rows. ``fold`` numbers the rows' folds, ``key`` is what samples draw by;
    ``whole_rows`` keeps equal rows apart, for sampling."""
    if objective not in METRICS:
        raise ValueError(f"objective must be one of {sorted(METRICS)}")
    if not features or not 2 <= max_bin <= 65_000:
        raise ValueError("there must be features, and max_bin must be between 2 and 65000")
    spark = frame.sparkSession
    shared_dir(spark)
    names = [f"x{i}" for i in range(len(features))]
    columns = [F.col(quoted(f)).cast("double").alias(n) for f, n in zip(features, names, strict=True)]
    drawn = F.xxhash64(F.col(quoted(key)).cast("string")) if key else F.xxhash64(*[quoted(f) for f in features])
    held = F.lit(NO_FOLD) if fold is None else F.coalesce(fold.cast("int"), F.lit(NO_FOLD))
    rows = nan_to_null(frame.select(*columns, F.col(quoted(label)).alias("label"), held.alias("fold"), drawn.alias("u")))
    rows = rows.where("label IS NOT NULL")
    if objective == "binary":
        rows, labels = rows.withColumn("y", (F.col("label") > 0).cast("int")), (0, 1)
    else:
        found = rows.groupBy("label").count().orderBy("label").limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes: is the label continuous?")
        labels = tuple(r["label"] for r in found)
        place = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col("label")) if labels else F.lit(0)
        rows = rows.withColumn("y", (place - 1).cast("int"))
    edges = bin_edges(rows, names, max_bin)
    ends = [np.array(e) for e in edges]
    bin_type = Prepared(rows, (), edges, labels, objective, {}).bin_type

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.zeros((batch.num_rows, len(ends)), bin_type)
            for i, points in enumerate(ends):
                bins[:, i] = binned(batch.column(i).to_numpy(zero_copy_only=False), points)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[len(ends) :], packed], names=["fold", "y", "u", "bins"])

    rows = rows.select(*names, "fold", "y", "u").mapInArrow(pack, "fold int, y int, u long, bins binary")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    counts = {(r["fold"], r["y"]): float(r["n"]) for r in rows.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    vectors = math.prod(len(e) + 1.0 for e in edges) * max(len(counts), 1)
    if not whole_rows and vectors <= FOLD_RATIO * sum(counts.values()):
        table = rows.groupBy("fold", "y", "bins").agg(F.count("*").cast("double").alias("n")).withColumn("u", F.lit(0).cast("long"))
    else:
        table = rows.withColumn("n", F.lit(1.0))
    return Prepared(table, tuple(features), edges, labels, objective, counts, rows)


def start_of(data: Prepared, fold: int) -> np.ndarray:
    """Log odds of class 1, or the logs of all classes' shares, over the rows that a group is fitted on."""
    sizes = np.array([sum(n for (f, y), n in data.counts.items() if y == c and f != fold) for c in range(len(data.labels))])
    if (sizes == 0).any():
        if sizes.sum() == 0:
            raise ValueError("no labelled rows to fit")
        sizes = sizes + 1e-6 * sizes.sum()  # a class without rows keeps a margin
    return np.array([math.log(sizes[1] / sizes[0])]) if data.width == 1 else np.log(sizes / sizes.sum())


def grow(data: Prepared, settings: Sequence[tuple[int, BoostParams]]) -> list[Group]:
    """Fit one model for each (fold left out, settings), all in step."""
    spark = data.rows.sparkSession
    groups = [Group(fold, params, start_of(data, fold)) for fold, params in settings]
    zero = bytes(8 * data.width * len(groups))
    state = data.rows.select("fold", "y", "n", "u", "bins", F.lit(zero).alias("margins")).checkpoint()
    data.kept.unpersist()
    rounds = max(g.params.n_estimators for g in groups)
    for number in range(1, rounds + 2):
        judged = [
            i for i, g in enumerate(groups)
            if g.fold >= 0 and g.params.early_stopping_rounds and not g.stopped and len(g.rounds) == number - 1 > 0
        ]
        for g in groups:
            g.stopped |= number > g.params.n_estimators and not any(groups[i] is g for i in judged)
        trees = {
            (i, c): Growing(g.params) for i, g in enumerate(groups) for c in range(data.width)
            if not g.stopped and number <= g.params.n_estimators
        }
        if not trees and not judged:
            break
        while True:
            asked = {of: tree.asked() for of, tree in trees.items() if not groups[of[0]].stopped}
            asked = {of: nodes for of, nodes in asked.items() if nodes}
            if not asked and not judged:
                break
            cuts, values = _pass(spark, state, data, groups, trees, asked, judged, number)
            for i in judged:
                groups[i].saw(values.get(i))
            judged = []
            for (of, node), row in cuts.items():
                cell = trees[of].cells[node]
                cell.known, cell.g, cell.h, cell.n = True, row["g"], row["h"], row["n"]
                if row["fits"]:
                    cell.cut, cell.gain = (row["feature"], row["bin"]), row["gain"]
                    cell.sides = tuple((row[f"g_{s}"], row[f"h_{s}"], row[f"n_{s}"]) for s in ("low", "high"))
            for of, nodes in asked.items():
                for node in nodes:
                    trees[of].cells[node].known = True  # nodes without rows have no cut
        for i, g in enumerate(groups):
            grown = tuple(trees[i, c].finished() for c in range(data.width) if (i, c) in trees)
            if g.stopped or not grown or all(len(t.feature) == 1 for t in grown):
                g.stopped = True
            else:
                g.rounds.append(grown)
        if number % ROUNDS_PER_CHECKPOINT == 0 and not all(g.stopped for g in groups):
            job = _job(data, groups, {}, {}, (), number)
            state = state.mapInArrow(_taken_in(job), STATE).checkpoint()
            for g in groups:
                g.taken = len(g.rounds)
    return groups


def _job(data: Prepared, groups, trees, slots, judged, number: int) -> Job:
    added, growing = [], []
    for i, g in enumerate(groups):
        added.append(tuple(
            (c, t.arrays(), np.array(t.value)) for grown in g.rounds[g.taken :] for c, t in enumerate(grown) if len(t.feature) > 1
        ))
        here = []
        for c in range(data.width):
            if (i, c) in slots:
                of_node = np.full(len(trees[i, c].cells), -1)
                for node, slot in slots[i, c].items():
                    of_node[node] = slot
                here.append((c, trees[i, c].arrays(), of_node, tuple(g.params.features(len(data.features), number))))
        growing.append(tuple(here))
    sampled = tuple((g.params.subsample, g.params.random_state * 1_000_003 + number) for g in groups)
    return Job(
        data.width, len(data.features), data.bin_type, data.most_bins, tuple(g.fold for g in groups),
        tuple(g.start for g in groups), tuple(added), tuple(growing), sampled, tuple(judged),
        sum(len(s) for s in slots.values()),
    )


def _pass(spark: SparkSession, state: DataFrame, data: Prepared, groups, trees, asked, judged, number: int):
    """One job over the rows: best cuts by (tree, node), metrics by group."""
    slots, settings = {}, []
    for of, nodes in asked.items():
        slots[of] = {node: len(settings) + k for k, node in enumerate(nodes)}
        p = groups[of[0]].params
        settings += [
            (s, p.reg_alpha, p.reg_lambda, float(p.min_child_samples), p.min_child_weight, p.min_split_gain)
            for s in slots[of].values()
        ]
    job = _job(data, groups, trees, slots, judged, number)
    sums = state.mapInArrow(_summed(job), SUMS).groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"])
    sums = sums.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        schema = "slot int, alpha double, lambda double, fewest double, lightest double, least_gain double"
        cuts, values = {}, {}
        if settings:
            found = {r["slot"]: r for r in best_cuts(sums, spark.createDataFrame(settings, schema)).collect()}
            cuts = {(of, node): found[s] for of, some in slots.items() for node, s in some.items() if s in found}
        if judged:
            values = {-1 - r["slot"]: r["value"] for r in verdicts(sums, data.objective).collect()}
        return cuts, values
    finally:
        sums.unpersist()


@dataclass(frozen=True)
class NewtonBooster:
    """A model: the start of each class's margin and its rounds of trees."""

    features: tuple[str, ...]
    edges: tuple[tuple[float, ...], ...]
    labels: tuple
    start: tuple[float, ...]
    rounds: tuple[tuple[Grown, ...], ...]
    history: tuple[float, ...] = ()

    def score(self, frame: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the probability of class 1, or the array of all classes' probabilities."""
        return frame.withColumn(name, probabilities(frame, [self]))

    def importances(self) -> dict[str, float]:
        """How often each feature is split on."""
        found: dict[str, float] = {}
        for grown in self.rounds:
            for f in (f for tree in grown for f in tree.feature if f >= 0):
                found[self.features[f]] = found.get(self.features[f], 0.0) + 1.0
        return found

    def table(self, spark: SparkSession) -> DataFrame:
        """(round, class, nodes): the trees, whose leaves hold shrunken steps of the margin."""
        rows = []
        for k, grown in enumerate(self.rounds, start=1):
            for c, tree in enumerate(grown):
                whole = tree.tree(self.features, self.edges)
                rows += [
                    (k, c, n.node_id, n.parent_id, n.depth, n.feature, n.op, None if n.value is None else str(n.value), n.rule,
                     not whole.children(n), str(n.prediction), n.n) for n in whole.nodes
                ]
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in NODE_SCHEMA.fields)
        return spark.createDataFrame(rows, f"round int, class int, {names}")


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The bins of a column; missing values are in bin 0."""
    return np.where(np.isnan(x) | (x == -np.inf), 0, np.searchsorted(edges, x) + 1)


def probabilities(frame: DataFrame, models: Sequence[NewtonBooster], fold: str | None = None) -> Column:
    """Probabilities by the only model, or by the one of the row's ``fold``; null where no model has that number.

    Ensembles have too many leaves for one expression, so batches of rows are routed through all trees in arrays.
    The function is declared as not deterministic so that no filter copies it.
    """
    first = models[0]
    edges = [np.array(e) for e in first.edges]
    width = len(first.start)
    trees = [[(c, t.arrays(), np.array(t.value)) for r in m.rounds for c, t in enumerate(r)] for m in models]
    starts = [np.array(m.start) for m in models]
    kind, arrow = ("double", pa.float64()) if width == 1 else ("array<double>", pa.list_(pa.float64()))

    def run(*columns: pa.Array) -> pa.Array:
        values = [c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns[: len(edges)]]
        bins = np.stack([binned(x, e) for x, e in zip(values, edges, strict=True)], 1)
        of = np.zeros(len(bins)) if fold is None else columns[-1].to_numpy(zero_copy_only=False).astype(np.float64)
        found = np.full((len(bins), width), np.nan)
        for k, (start, own) in enumerate(zip(starts, trees, strict=True)):
            here = np.flatnonzero(of == k)
            margins = np.tile(start, (len(here), 1))
            for c, arrays, leaf in own:
                margins[:, c] += leaf[routed(bins[here], arrays)]
            found[here] = shares(margins) if len(here) else margins
        missing = np.isnan(found[:, 0])
        if width == 1:
            return pa.array(found[:, 0], arrow, mask=missing)
        return pa.array([None if gone else row for gone, row in zip(missing, found.tolist(), strict=True)], arrow)

    inputs = [F.col(quoted(f)).cast("double") for f in first.features]
    inputs += [] if fold is None else [F.col(quoted(fold)).cast("double")]
    return F.arrow_udf(run, kind).asNondeterministic()(*inputs)


def models_of(data: Prepared, groups: Sequence[Group]) -> list[NewtonBooster]:
    """The groups' models, cut back to their best rounds."""
    return [
        NewtonBooster(
            data.features, data.edges, data.labels, tuple(g.start.tolist()), tuple(g.rounds[: g.best_round()]), tuple(g.history)
        )
        for g in groups
    ]


def fit_newton_booster(
    frame: DataFrame, features: Sequence[str], label: str, objective: str = "binary", *, key: str | None = None,
    held_out: Column | None = None, max_bin: int = 255, **options,
) -> NewtonBooster:
    """One model. Rows where ``held_out`` is true are not fitted but judge the rounds, if ``early_stopping_rounds`` is set."""
    params = BoostParams(**options)
    fold = None if held_out is None else F.when(held_out, 0)
    data = prepared(
        frame, features, label, objective, key=key, fold=fold, max_bin=max_bin, whole_rows=params.subsample < 1
    )
    return models_of(data, grow(data, [(NONE_LEFT_OUT if held_out is None else 0, params)]))[0]


def fit_fold_boosters(
    frame: DataFrame, features: Sequence[str], label: str, folds: int, settings: Sequence[Mapping], objective: str,
    *, key: str | None = None, max_bin: int = 255,
) -> list[list[NewtonBooster]]:
    """For every setting a model for every fold of the ``fold`` column, fitted on the others and stopped by its own;
    all of them grow in the same jobs."""
    params = [BoostParams(**s) for s in settings]
    data = prepared(
        frame, features, label, objective, key=key, fold=F.col("fold"), max_bin=max_bin,
        whole_rows=any(p.subsample < 1 for p in params),
    )
    models = models_of(data, grow(data, [(fold, p) for p in params for fold in range(folds)]))
    return [models[i * folds : (i + 1) * folds] for i in range(len(params))]
