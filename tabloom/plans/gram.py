"""Products of tall matrices, L'R summed over all rows, as tiles.

A task multiplies its batches with numpy. Small products leave it as cells, which Spark sums without a second Python
step; large ones leave it as tiles (i, j) of at most ``TILE`` x ``TILE`` cells, which are summed by key, so that no row,
and no task of the sum, holds a whole product. A task keeps its own sums up to ``MOST_HELD`` bytes; beyond them it
sends the tiles of every batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TILE = 256
FEW_CELLS = 16_384
MOST_HELD = 256_000_000
Sides = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
TILES = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("block", pa.binary())])


def _products(batches: Iterator[pa.RecordBatch], sides: Sides, held: bool) -> Iterator[np.ndarray]:
    """L'R of the task, or of each batch if it is not ``held``."""
    total = None
    for batch in batches:
        if batch.num_rows:
            z = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            left, right = sides(z)
            more = left.T @ right
            if not held:
                yield more
            elif total is None:
                total = more
            else:
                total += more
    if total is not None:
        yield total


def _cells(sides: Sides):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for total in _products(batches, sides, True):
            flat = total.ravel()
            yield pa.RecordBatch.from_pydict({"cell": np.arange(len(flat), dtype=np.int64), "value": flat})

    return run


def _tiles(sides: Sides, held: bool, tile: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for total in _products(batches, sides, held):
            for i in range(0, total.shape[0], tile):
                for j in range(0, total.shape[1], tile):
                    block = np.ascontiguousarray(total[i : i + tile, j : j + tile]).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([i // tile], pa.int32()), pa.array([j // tile], pa.int32()), pa.array([block], pa.binary())], schema=TILES)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles in order of their places, one at a time in memory."""
    place = total = None
    row = lambda: pa.RecordBatch.from_arrays(
        [pa.array([place[0]], pa.int32()), pa.array([place[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())], schema=TILES
    )
    for batch in batches:
        for i, j, data in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if place != (i, j):
                if place is not None:
                    yield row()
                place, total = (i, j), np.zeros(len(data) // 8)
            total = total + np.frombuffer(data)
    if place is not None:
        yield row()


def gram_tiles(rows: DataFrame, sides: Sides, shape: tuple[int, int], tile: int = TILE) -> DataFrame:
    """(i, j, block): the summed tiles; ``rows`` has only double columns, ``sides`` makes L and R of a batch of them."""
    held = shape[0] * shape[1] * 8 <= MOST_HELD
    parts = rows.mapInArrow(_tiles(sides, held, tile), "i int, j int, block binary")
    return parts.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(_added, "i int, j int, block binary")


def gram(rows: DataFrame, sides: Sides, shape: tuple[int, int], few_cells: int = FEW_CELLS, tile: int = TILE) -> np.ndarray:
    """L'R on the driver, which gets cells or tiles; zeros if there are no rows."""
    whole = np.zeros(shape)
    if shape[0] * shape[1] <= few_cells:
        sums = rows.mapInArrow(_cells(sides), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value"))
        for row in sums.collect():
            whole.flat[row["cell"]] = row["value"]
        return whole
    for row in gram_tiles(rows, sides, shape, tile).toLocalIterator():
        i, j = row["i"] * tile, row["j"] * tile
        part = whole[i : i + tile, j : j + tile]
        part[:] = np.frombuffer(row["block"]).reshape(part.shape)
    return whole


def doubles(frame: DataFrame, columns: list[str]) -> DataFrame:
    """The columns by position, as doubles."""
    return frame.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
