"""Exact near-duplicate groups by a Jaccard join in metric space.

A document is its set of word 5-grams. Texts are mostly at distance one from each other, where no pivot tells them
apart, so the regions of pivots are found by shingles first: all shingles have one fixed order, the rarest first by a
sketch of counts over all documents, and two sets within the threshold share a shingle among the first quarter of
either. For every such shingle the least of its documents is the pivot; a document is replicated to the region of each
pivot that it meets so, which are the only pivots at a distance below one. Regions are then worked off:

1. a sketch of every set, its shingles counted by hash range, bounds distances from below (the counts of two sets differ
   by no more than the sets). The exact distance of every set to one pivot that its sketch leaves in reach is taken;
   within the threshold it is a link. Distances to its other pivots are taken where links have not connected them yet;
2. a region whose members are connected is done. In the others, members that by their sketches have no partner outside
   their own component leave;
3. regions that still fill more than a block get a new pivot from among the members that are not connected with the old
   one, and are laid out by distance to it in rings as wide as the threshold. By the triangle inequality a partner is in
   the same ring or the next, to which boundary documents are replicated. This goes on as long as rings fill more than a
   block and a pivot makes them smaller;
4. what is left is joined exactly, block by block, by products of incidence matrices.

Equal sets are one class from the start. Blocks bound the memory of a task, and pairs already connected are not tested,
so a large group of copies costs a pass over its members. Links are exact: sets are compared by 64-bit hashes of whole
shingles.

Defined cases: a null or blank text has the empty set and is a group of its own; null doc_ids take part, and a group
gets its smallest doc_id that isn't null (null if there is none); repeated rows each return a row; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType

from tabloom.llm.common import batch_of, slices, texts_of, written
from tabloom.llm.components import components, extended

WORDS = 5
PERCENT = 75  # two sets link when 100 * intersection >= PERCENT * union
SKETCH_BITS, SKETCH_PARTS = 20, 64
BLOCK = 512  # sets on either side of a block
SKETCH_BLOCK = 4096  # as many sketches take less room
MOST_BROADCAST = 1_000_000  # document ids that are sent to all executors; beyond it they are joined by a shuffle
SHRINK = 0.75  # a ring with a larger share of its region is not laid out again but joined block by block

_random = np.random.default_rng(45)
BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
PLACE = _random.integers(0, 2**64, WORDS, dtype=np.uint64) | np.uint64(1)
SHORT = _random.integers(0, 2**64, WORDS, dtype=np.uint64)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n_words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``n_words`` (up to 5) words of a text; of all its words if there are fewer."""
    data = np.frombuffer(text.encode().lower(), np.uint8)  # bytes.lower() changes A-Z only
    blank = BLANK[data]
    inside = ~blank
    starts = np.flatnonzero(inside & np.concatenate(([True], blank[:-1]))) if len(data) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    longest = int(place.max()) + 1
    power = np.multiply.accumulate(np.full(longest, STEP)) if longest else np.zeros(0, np.uint64)
    values = BYTE[data] * power[place]
    values[blank] = 0
    words = mix(np.add.reduceat(values, starts))
    if len(words) < n_words:
        return mix((words * PLACE[: len(words)]).sum(keepdims=True) + SHORT[len(words)])
    size = len(words) - n_words + 1
    total = words[:size] * PLACE[0]
    for i in range(1, n_words):
        total += words[i : i + size] * PLACE[i]
    return np.unique(mix(total))


def signature(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def as_class(sig: bytes) -> int:
    """A short name for a set in large tables; tables that decide carry the signature."""
    return int.from_bytes(sig[:8], "little", signed=True)


def sketch_of(hashes: np.ndarray) -> bytes:
    """Counts of a set's shingles by hash range, 2 to 4 shingles to a range on average, at most 255."""
    ranges = min(max(16, 1 << max(0, len(hashes).bit_length() - 2)), 1 << 16)
    counts = np.bincount((hashes >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64), minlength=ranges)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def folded(counts: np.ndarray, ranges: int) -> np.ndarray:
    """Rows of counts with fewer, wider ranges."""
    if counts.shape[1] == ranges:
        return counts
    return np.minimum(counts.reshape(len(counts), ranges, -1).sum(2, dtype=np.int64), 255).astype(np.uint8)


def may_link(sketches: list[bytes], sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of the left can, by their sketches, be within the threshold of which of the right."""
    widths = np.array([len(x) for x in sketches])
    out = np.zeros((len(left), len(right)), bool)
    for ranges in np.unique(widths).tolist():
        # sizes of partners are within the threshold, so the numbers of ranges are equal or neighbours
        for a_width, b_width in ((ranges, ranges), (ranges, 2 * ranges), (2 * ranges, ranges)):
            a, b = np.flatnonzero(widths[left] == a_width), np.flatnonzero(widths[right] == b_width)
            if not len(a) or not len(b):
                continue
            of = lambda rows, width: folded(
                np.frombuffer(b"".join([sketches[r] for r in rows]), np.uint8).reshape(-1, width), ranges
            ).astype(np.int16)
            one, two = of(left[a], a_width), of(right[b], b_width)
            total = sizes[left[a]][:, None] + sizes[right[b]][None, :]
            step = max(1, 4_000_000 // max(two.size, 1))
            for at in range(0, len(a), step):
                apart = np.abs(one[at : at + step, None, :] - two[None]).sum(2, dtype=np.int64)
                some = total[at : at + step]
                near = (some - apart) * (100 + percent) >= 2 * percent * some
                out[a[at : at + step][:, None], b] = near
    return out


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """So many of the first shingles meet those of any set within the threshold."""
    return size - -(-percent * size // 100) + 1


SUMMARY = pa.schema(
    [("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("sig", pa.binary()), ("cls", pa.int64()),
     ("sketch", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())]
)
SUMMARY_SQL = "doc_id long, digest binary, n long, sig binary, cls long, sketch binary, part int, counts binary"


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and the task's shingle counts in parts at its end."""
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    shift = np.uint64(64 - SKETCH_BITS)
    for batch in slices(batches, 1):
        sizes, sigs, sketches = [], [], []
        for text in batch.column(1).to_pylist():
            hashes = shingles(text)
            np.add.at(counts, hashes >> shift, 1)
            sizes.append(len(hashes))
            sketches.append(sketch_of(hashes))
            sigs.append(signature(hashes) if len(hashes) else None)
        rows, classes = len(sizes), [s and as_class(s) for s in sigs]
        none = pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())
        digests = batch.column(2) if batch.num_columns > 2 else pa.nulls(rows, pa.binary())
        yield batch_of(SUMMARY, batch.column(0), digests, sizes, sigs, classes, sketches, *none)
    if counts.any():
        parts = [x.tobytes() for x in np.split(counts, SKETCH_PARTS)]
        empty = pa.nulls(SKETCH_PARTS, pa.int64())
        none = pa.nulls(SKETCH_PARTS, pa.binary())
        yield batch_of(SUMMARY, empty, none, empty, none, empty, none, list(range(SKETCH_PARTS)), parts)


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            more = np.frombuffer(data, np.uint32).astype(np.uint64)
            sums[part] = sums[part] + more if part in sums else more
    for part, total in sums.items():
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "total": [total.tobytes()]})


def shingle_counts(summaries: DataFrame) -> np.ndarray:
    """The sketch: one count for each of a fixed number of hash ranges, over all documents."""
    parts = summaries.where("part IS NOT NULL").select("part", "counts").repartition(SKETCH_PARTS, "part")
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint64)
    for row in parts.mapInArrow(_sum_parts, "part int, total binary").collect():
        counts[row["part"]] = np.frombuffer(row["total"], np.uint64)
    return counts.ravel()


ENTRY = pa.schema([("shingle", pa.int64()), ("cls", pa.int64())])


def prefixes(rows: DataFrame, counts, percent: int) -> DataFrame:
    """(shingle, cls): the rarest shingles of every set, once for each set of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count_of, shift, seen = counts.value, np.uint64(64 - SKETCH_BITS), set()
        for batch in slices(batches, 1, 4_000_000):
            found, sizes, classes = [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingles(text)
                if not len(hashes) or (sig := signature(hashes)) in seen:
                    continue
                seen.add(sig)
                most = prefix_length(len(hashes), percent)
                order = np.argsort(count_of[hashes >> shift], kind="stable")[:most]
                found.append(hashes[order])
                sizes.append(most)
                classes.append(as_class(sig))
            if found:
                yield batch_of(
                    ENTRY, pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.repeat(np.array(classes, np.int64), sizes)),
                )

    return rows.mapInArrow(run, "shingle long, cls long")


MEMBER = pa.schema([("cls", pa.int64()), ("pivot", pa.int64())])


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in order (shingle, cls): each set with the least set of the shingle, where they differ."""
    last, least = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        shingle, cls = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        first = np.concatenate(([shingle[0] != last], shingle[1:] != shingle[:-1]))
        begin = np.maximum.accumulate(np.where(first, np.arange(len(first)), -1))
        pivot = np.where(begin < 0, least if least is not None else 0, cls[begin])
        differ = pivot != cls
        last, least = shingle[-1], pivot[-1]
        if differ.any():
            pairs = np.unique(np.stack([cls[differ], pivot[differ]]), axis=1)
            yield batch_of(MEMBER, pa.array(pairs[0]), pa.array(pairs[1]))


SET = pa.schema([("sig", pa.binary()), ("n", pa.int64()), ("hashes", pa.binary())])


def _set_rows(n_words: int):
    """The sets of texts, once for each of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in slices(batches, 0):
            rows = []
            for text in batch.column(0).to_pylist():
                hashes = shingles(text, n_words)
                if len(hashes) and (sig := signature(hashes)) not in seen:
                    seen.add(sig)
                    rows.append((sig, len(hashes), hashes.tobytes()))
            if rows:
                yield batch_of(SET, *zip(*rows, strict=True))

    return run


def sets_of(spark: SparkSession, rows: DataFrame, holders: DataFrame, n_words: int = WORDS) -> DataFrame:
    """(sig, n, hashes) of the texts whose doc_id is among ``holders`` (holder)."""
    holders = written(spark, holders.distinct(), "holders")
    if holders.count() <= MOST_BROADCAST:
        holders = F.broadcast(holders)
    held = rows.join(holders, F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi").select("text")
    return written(spark, held.mapInArrow(_set_rows(n_words), "sig binary, n long, hashes binary"), "sets")


def overlap(a: bytes, b: bytes) -> int:
    both = np.concatenate((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


@F.arrow_udf(LongType())
def common(a: pa.Array, b: pa.Array) -> pa.Array:
    """Shingles in both of two sets."""
    return pa.array([overlap(x.as_py(), y.as_py()) for x, y in zip(a, b, strict=True)], pa.int64())


def _linked(percent: int):
    return F.col("common") * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b"))


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(of, a, b, n_a, n_b, common) for pairs (x, pivot) of a region ``of``."""
    side = lambda name, sig, n, hashes: sets.select(
        F.col("sig").alias(name), F.col("sig").alias(sig), F.col("n").alias(n), F.col("hashes").alias(hashes)
    )
    rows = pairs.join(side("x", "a", "n_a", "of_a"), "x").join(side("pivot", "b", "n_b", "of_b"), "pivot")
    return rows.select("of", "a", "b", "n_a", "n_b", common("of_a", "of_b").alias("common"))


def may_link_by_row(n_a: np.ndarray, a: list[bytes], n_b: np.ndarray, b: list[bytes], percent: int) -> np.ndarray:
    """``may_link`` of the first sketch with the first, the second with the second, and so on."""
    out = np.zeros(len(a), bool)
    widths = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    for one, two in np.unique(widths, axis=0).tolist():
        if max(one, two) > 2 * min(one, two):
            continue  # the sizes are too different
        here = np.flatnonzero((widths == (one, two)).all(1))
        for some in np.split(here, range(4096, len(here), 4096)):
            of = lambda side, width: folded(
                np.frombuffer(b"".join([side[r] for r in some]), np.uint8).reshape(-1, width), min(one, two)
            ).astype(np.int16)
            total = n_a[some] + n_b[some]
            distance = np.abs(of(a, one) - of(b, two)).sum(1, dtype=np.int64)
            out[some] = (total - distance) * (100 + percent) >= 2 * percent * total
    return out


def _plausible(percent: int):
    @F.arrow_udf(BooleanType())
    def plausible(n_a: pa.Array, a: pa.Array, n_b: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(may_link_by_row(n_a.to_numpy(), a.to_pylist(), n_b.to_numpy(), b.to_pylist(), percent))

    return plausible


def by_region(rows: pa.Table):
    """For each region of a task its rows, and places of the left and the right ones among them."""
    region = rows.column("region").to_numpy()
    order = np.argsort(region, kind="stable")
    for here in np.split(order, np.flatnonzero(np.diff(region[order])) + 1):
        some = rows.take(pa.array(here))
        of_left = np.array(some.column("of_left").to_pylist(), bool)
        left = np.flatnonzero(of_left)
        yield some, left, left if of_left.all() else np.flatnonzero(~of_left)


def near_members(may):
    """Of a block's members those that may link, by ``may`` of their rows, with another one outside their component."""

    def run(rows: pa.Table) -> pa.Table:
        found = []
        for some, left, right in by_region(rows):
            if len(left) and len(right):
                names = np.unique(np.array(some.column("root").to_pylist(), object), return_inverse=True)[1]
                near = may(some, left, right) & (names[left][:, None] != names[right][None, :])
                kept = np.union1d(left[near.any(1)], right[near.any(0)])
                found.append(some.select(["region", "sig"]).take(pa.array(kept, pa.int64())))
        return pa.concat_tables(found) if found else rows.select(["region", "sig"]).slice(0, 0)

    return run


def _by_sketch(percent: int):
    def may(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return may_link(rows.column("sketch").to_pylist(), rows.column("n").to_numpy(), left, right, percent)

    return may


def join_block(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of the left rows link with which of the right: products of 0/1 matrices of shared shingles."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1  # others are in one set only
    column = np.cumsum(shared) - 1
    held = shared[places]
    owner, place = owner[held], column[places[held]]
    sizes = np.array([len(s) for s in sets])
    both = np.zeros((len(left), len(right)), np.float32)
    position = {}
    for side, rows in (("l", left), ("r", right)):
        position[side] = np.full(len(sets), -1)
        position[side][rows] = np.arange(len(rows))
    width = 4096
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(place, [low, low + width])
        o, p = owner[a:b], place[a:b] - low
        l = np.zeros((len(left), width), np.float32)
        r = np.zeros((len(right), width), np.float32)
        at = position["l"][o]
        l[at[at >= 0], p[at >= 0]] = 1
        at = position["r"][o]
        r[at[at >= 0], p[at >= 0]] = 1
        both += l @ r.T
    total = sizes[left][:, None] + sizes[right][None, :]
    return np.rint(both).astype(np.int64) * (100 + percent) >= percent * total


def _joined_blocks(percent: int):
    none = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})

    def run(rows: pa.Table) -> pa.Table:
        pairs = {}  # one link between any two components is enough
        for some, left, right in by_region(rows):
            if not len(left) or not len(right):
                continue
            names, roots = some.column("sig").to_pylist(), some.column("root").to_pylist()
            group = np.unique(np.array(roots, object), return_inverse=True)[1]
            sets = [np.frombuffer(h, np.uint64) for h in some.column("hashes").to_pylist()]
            links = join_block(sets, left, right, percent) & (group[left][:, None] != group[right][None, :])
            for i, j in zip(*(x.tolist() for x in np.nonzero(links)), strict=True):
                a, b = left[i], right[j]
                pairs[roots[a], roots[b]] = names[a], names[b]
        if not pairs:
            return none
        a, b = zip(*pairs.values(), strict=True)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _with_roots(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (pivot, sig) with ``root`` and ``main``, the root of their pivot."""
    of = lambda name, out: roots.select(F.col("node").alias(name), F.col("root").alias(out))
    found = members.join(of("sig", "root"), "sig", "left").join(of("pivot", "main"), "pivot", "left")
    return found.withColumn("root", F.coalesce("root", "sig")).withColumn("main", F.coalesce("main", "pivot"))


def _rooted(members: DataFrame, roots: DataFrame, *columns: str) -> DataFrame:
    """Members (region, pivot, sig) of regions with more than one root, each with its root and its side.

    ``side`` is 0 for members that the pivot is connected with; pairs of these need no test. Pivots are no members:
    all their pairs have been tested.
    """
    found = _with_roots(members.select("region", "pivot", "sig", *columns), roots)
    found = written(members.sparkSession, found, "rooted")
    apart = (F.col("root") != F.col("main")).cast("int")
    open_regions = (
        found.groupBy("region")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n_all"),
             F.sum(apart).alias("n_apart"))
        .where("low <> high")
        .select("region", "n_all", "n_apart")
    )
    return found.join(open_regions, "region").withColumn("side", apart).drop("main")


def _ringed(near: DataFrame, percent: int) -> DataFrame:
    """Members of the rings around each pivot: (region, of, pivot, sig), boundary documents in two rings.

    ``near`` has the members' distances to the pivot of their region ``of``. Rings are as wide as the threshold, so
    partners are in one ring or in neighbouring ones; a ring also holds the members of the next.
    """
    ring = F.expr(f"(100 * (n_a + n_b - 2 * common)) div ({100 - percent} * (n_a + n_b - common))")
    rows = near.withColumn("ring", ring)
    rows = rows.withColumn("ring", F.explode(F.expr("CASE WHEN ring > 0 THEN array(ring, ring - 1) ELSE array(ring) END")))
    return rows.select(F.xxhash64("of", "b", "ring").alias("region"), "of", F.col("b").alias("pivot"), F.col("a").alias("sig"))


def _blocked(members: DataFrame, block: int, *columns: str) -> DataFrame:
    """(task, kind, of_left, region, sig, columns): blocks of the written members that are joined with each other.

    Small regions share blocks. In others the members apart from the pivot's group meet those of the group and each
    other, block by block.
    """
    blocks = lambda n: F.greatest(F.ceil(n / block), F.lit(1)).cast("int")
    n_main, n_apart = F.col("n_all") - F.col("n_apart"), F.col("n_apart")
    place = lambda n: F.pmod(F.xxhash64("sig"), blocks(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    spot = lambda kind, i, j, side: F.struct(
        F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("of_left")
    )
    zero = F.lit(0)
    mine = place(n_apart)
    spots = (
        F.when(F.col("n_all") <= block, F.array(spot("all", zero, zero, True)))
        .when(F.col("side") == 0, F.transform(upto(blocks(n_apart)), lambda j: spot("main", place(n_main), j, True)))
        .otherwise(
            F.concat(
                F.when(n_main > 0, F.transform(upto(blocks(n_main)), lambda i: spot("main", i, mine, False)))
                .otherwise(F.array().cast("array<struct<kind:string,i:int,j:int,of_left:boolean>>")),
                F.transform(F.sequence(mine, blocks(n_apart) - 1), lambda j: spot("apart", mine, j, True)),
                F.transform(F.filter(upto(blocks(n_apart)), lambda i: i < mine), lambda i: spot("apart", i, mine, False)),
            )
        )
    )
    rows = members.withColumn("spot", F.explode(spots))
    shared = F.pmod(F.col("region"), F.lit(-(-members.count() // block) or 1))
    task = F.when(F.col("spot.kind") == "all", shared).otherwise(F.xxhash64("region", "spot.kind", "spot.i", "spot.j"))
    return rows.select(task.alias("task"), F.col("spot.kind").alias("kind"), F.col("spot.of_left").alias("of_left"),
                       "region", "sig", *columns)


def linked_regions(
    spark: SparkSession, met: DataFrame, find_sets, may, columns: tuple[str, ...], percent: int, block: int
) -> DataFrame:
    """(node, root) of the sets that are linked with others within a region.

    ``met`` (pivot, sig, near, columns) has the members of each region, ``near`` where a link with the pivot is
    possible; ``may`` tells from the columns of a block's rows which may link with which; ``find_sets`` gives
    (sig, n, hashes) of wanted ones (sig).
    """
    reach = met.where("near").select("pivot", "sig")
    pivots = written(spark, reach.groupBy("sig").agg(F.array_sort(F.collect_set("pivot")).alias("pivots")), "pivots")
    sets = find_sets(pivots.select("sig").union(pivots.select(F.explode("pivots").alias("sig"))))
    no_region = F.lit(0).cast("long").alias("of")
    stars = pivots.select("sig", F.get("pivots", F.lit(0)).alias("pivot"))
    near = distances(stars.select(F.col("sig").alias("x"), "pivot", no_region), sets)
    roots = components(spark, near.where(_linked(percent)).select("a", "b"))
    others = pivots.select("sig", F.explode(F.slice("pivots", 2, F.greatest(F.size("pivots") - 1, F.lit(0)))).alias("pivot"))
    others = _with_roots(others, roots).where("root <> main")
    near = distances(others.select(F.col("sig").alias("x"), "pivot", no_region), sets)
    roots = extended(spark, roots, near.where(_linked(percent)).select("a", "b"))

    apart = written(spark, _rooted(met.withColumn("region", F.xxhash64("pivot")), roots, *columns), "apart")
    if apart.isEmpty():
        return roots
    blocks = _blocked(apart, block * SKETCH_BLOCK // BLOCK, "root", *columns)
    stay = blocks.groupBy("kind", "task").applyInArrow(near_members(may), "region long, sig binary").distinct()
    regions = written(spark, apart.join(stay, ["region", "sig"], "left_semi").select("region", "pivot", "sig"), "members")
    if regions.isEmpty():
        return roots
    sets = find_sets(regions.select("sig"))
    whole = None  # members by region before the last pivot
    while True:
        apart = _rooted(regions, roots)
        apart = apart.withColumn("was", F.lit(None).cast("long")) if whole is None else apart.join(whole, "region", "left")
        wide = (F.col("n_apart") > block) & F.coalesce(F.col("n_all") <= SHRINK * F.col("was"), F.lit(True))
        apart = written(spark, apart.withColumn("wide", wide), "apart")
        open_regions = apart.where("wide")
        if open_regions.isEmpty():
            break
        # a new pivot for every region that is still wide, out of the members apart
        pivots = open_regions.where("side = 1").groupBy("region").agg(F.min("sig").alias("next"), F.first("n_all").alias("was"))
        pairs = open_regions.drop("was").join(pivots, "region").where("sig <> next")
        near = distances(pairs.select(F.col("sig").alias("x"), F.col("next").alias("pivot"), F.col("region").alias("of")), sets)
        near = written(spark, near, "distances")
        roots = extended(spark, roots, near.where(_linked(percent)).select("a", "b"))
        ringed = written(spark, _ringed(near, percent).distinct(), "rings")
        sizes = pivots.select(F.col("region").alias("of"), "was")
        whole = ringed.join(sizes, "of").groupBy("region").agg(F.max("was").alias("was"))
        rest = apart.where("NOT wide").select("region", "pivot", "sig")
        kept = rest.select("region").distinct().withColumn("was", F.lit(0).cast("long"))  # these stay as they are
        whole = written(spark, whole.unionByName(kept).groupBy("region").agg(F.min("was").alias("was")), "sizes")
        regions = written(spark, ringed.select("region", "pivot", "sig").union(rest).distinct(), "regions")
    blocks = _blocked(apart, block, "root").join(sets.select("sig", "hashes"), "sig")
    found = blocks.groupBy("kind", "task").applyInArrow(_joined_blocks(percent), "a binary, b binary")
    return extended(spark, roots, found)


def _grouped(spark: SparkSession, rows: DataFrame, percent: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, n, root) of the rows (doc_id, text, and digest or none) with shingles; all without any."""
    summaries = written(spark, rows.mapInArrow(_summaries, SUMMARY_SQL), "summaries")
    rows = rows.select("doc_id", "text")
    counts = spark.sparkContext.broadcast(shingle_counts(summaries))  # of fixed size
    docs = summaries.where("part IS NULL").select("doc_id", "digest", "n", "sig", "cls", "sketch")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = prefixes(rows, counts, percent).repartition(parts, "shingle").sortWithinPartitions("shingle", "cls")
    members = written(spark, in_order.mapInArrow(_regions, "cls long, pivot long").distinct(), "regions")

    classes = docs.where("n > 0").groupBy("sig", "cls", "n").agg(
        F.min("doc_id").alias("holder"), F.first("sketch").alias("sketch")
    )
    named = members.select("cls").union(members.select(F.col("pivot").alias("cls"))).distinct()
    classes = written(spark, classes.join(named, "cls", "left_semi"), "classes")
    side = lambda name, sig, n, sketch: classes.select(
        F.col("cls").alias(name), F.col("sig").alias(sig), F.col("n").alias(n), F.col("sketch").alias(sketch)
    )
    met = members.join(side("cls", "sig", "n", "sketch"), "cls")
    met = met.join(side("pivot", "pivot_sig", "n_b", "sketch_b"), "pivot")
    near = _plausible(percent)("n", "sketch", "n_b", "sketch_b")
    met = met.select(F.col("pivot_sig").alias("pivot"), "sig", "n", "sketch", near.alias("near"))
    met = written(spark, met, "met")
    held = lambda sigs: classes.join(sigs.distinct(), "sig", "left_semi").select("holder")
    roots = linked_regions(
        spark, met, lambda sigs: sets_of(spark, rows, held(sigs)), _by_sketch(percent), ("n", "sketch"), percent, block
    )
    roots = roots.select(F.col("node").alias("sig"), "root")

    grouped = docs.where("n > 0").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    return grouped.select("doc_id", "digest", "n", "root"), docs.where("n = 0").select("doc_id", "n")


def near_duplicate_groups(
    spark: SparkSession, documents: DataFrame, percent: int = PERCENT, block: int = BLOCK,
    id_column="doc_id", text_column="text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    grouped, blank = _grouped(spark, texts_of(documents, id_column, text_column), percent, block)
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = grouped.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = blank.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return grouped.union(alone)


def drop_near_duplicates(
    spark: SparkSession, documents: DataFrame, percent: int = PERCENT, id_column="doc_id", text_column="text"
) -> DataFrame:
    """The documents with one row of each group, with all their columns.

    The row with the smallest doc_id that isn't null stays, of several with that doc_id (or none) the one with the least
    digest of its text. Null and blank texts are groups of their own, so all of their rows stay.
    """
    row_key = lambda doc_id, digest: F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("null")), F.hex(digest))
    digest_of = lambda text: F.unhex(F.sha2(text, 256))
    texts = texts_of(documents, id_column, text_column)
    grouped, _ = _grouped(spark, texts.withColumn("digest", digest_of(F.col("text"))), percent, BLOCK)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    kept = grouped.groupBy("root").agg(first).select(row_key(F.col("first.doc_id"), F.col("first.digest")).alias("_key"))
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    inked = text.rlike(r"[^\x09-\x0D\x20]")
    rows = documents.where(inked).select(
        F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("_row"),
        row_key(F.col(id_column).cast("long"), digest_of(text)).alias("_key"),
    )
    # combined before the shuffle, which also serves the join
    rows = rows.groupBy("_key").agg(F.first("_row").alias("_row")).join(kept, "_key", "left_semi")
    return rows.select("_row.*").union(documents.where(~inked))
