"""Packing along a space-filling curve.

A document's token ids are counted in hashed buckets; the damped, normalised vector is projected to a few dimensions,
which are scaled by their mean and deviation over all documents and cut to a grid. The place on the grid's Hilbert curve
is the sort key: documents are range-partitioned and sorted by it, and each partition is cut into sequences of
``SEQUENCE`` tokens along the curve, so neighbours share sequences. Only the last sequence of a partition can be short;
it is cut at powers of two, which need no padding.

The ids are those of the vocabulary file of the tokenizers library, followed by the id 0. They are found with the same
merges by the tiktoken library, which is faster.

Defined cases: a null text is empty and has the one id 0; documents with a null doc_id are packed like others; equal
keys, ties and repeated rows are ordered by a stored row number, so no key fills a task; an empty table gives an empty
result; other columns are ignored; special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, slices, texts_of, written

SEQUENCE = 1024
DIMENSIONS, GRID_BITS, BUCKETS = 4, 8, 256
# a partition of the range sort grows with the total from the first size to the second, so that their number stays moderate
PARTITION_BYTES, LARGEST_PARTITION, USUAL_PARTITIONS = 16_000_000, 256_000_000, 20_000


@lru_cache(2)
def merge_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level BPE in the JSON format, checked to be in merge order."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][token] for token in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError(f"the ids of {path} are not in the order of its merges")
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}


class Runs:
    """Ids of whole texts as bytes. Nothing is remembered from text to text: the merges of a short run of text cost less
    than to look it up among some hundred thousand others, and a worker's memory stays that of the vocabulary."""

    def __init__(self, path: str, pattern: str):
        ranks = merge_ranks(path)
        self.encoding = tiktoken.Encoding("runs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return [np.array(self.encoding.encode_ordinary(t), self.kind).tobytes() for t in texts]


@lru_cache(2)
def runs_of(path: str, pattern: str) -> Runs:
    return Runs(path, pattern)


@lru_cache(1)
def projection() -> np.ndarray:
    return np.random.default_rng(7).standard_normal((BUCKETS, DIMENSIONS)) / np.sqrt(BUCKETS)


def hilbert(points: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Place on the Hilbert curve of rows of grid coordinates: Gray-code each bit plane, turning the cell by swaps."""
    axes = points.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(len(axes)):
            high = (axes[i] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] ^= np.where(high, low, swap)
            axes[i] ^= swap
    for i in range(1, len(axes)):
        axes[i] ^= axes[i - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    axes ^= turn
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | ((axis >> level) & 1)
    return key


TOKENS = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int64()), ("vector", pa.list_(pa.float32()))]
)
PIECES = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def tokenised(documents: DataFrame, path: str, pattern: str, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, ids, n, vector) of every document; the closing id 0 is part of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, plane = runs_of(path, pattern), projection()
        close = np.zeros(1, runs.kind).tobytes()
        for batch in slices(batches, 1, 2_000_000):
            ids = [i + close for i in runs.encode_batch(batch.column(1).to_pylist())]
            lengths = [len(i) // runs.kind.itemsize for i in ids]
            counts = np.empty((len(ids), BUCKETS))
            for row, some in enumerate(ids):
                buckets = (np.frombuffer(some, runs.kind).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
                counts[row] = np.bincount(buckets, minlength=BUCKETS)
            counts = np.log1p(counts)
            counts /= np.linalg.norm(counts, axis=1, keepdims=True)
            yield batch_of(TOKENS, batch.column(0), ids, lengths, list((counts @ plane).astype(np.float32)))

    rows = texts_of(documents, id_column, text_column)
    return rows.mapInArrow(run, "doc_id long, ids binary, n long, vector array<float>")


def curve_key(vector: Column, means: list[float], deviations: list[float]) -> Column:
    """Hilbert key of a projected vector on a grid over the mean plus and minus three deviations."""
    low = np.array(means) - 3 * np.array(deviations)
    step = np.maximum(6 * np.array(deviations), 1e-9) / (1 << GRID_BITS)

    @F.arrow_udf("long")
    def key(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
        cells = np.clip(np.floor((flat - low) / step), 0, (1 << GRID_BITS) - 1)
        return pa.array(hilbert(cells), pa.int64())

    return key(vector)


class Packer:
    """Cuts a run of documents into sequences; holds the open sequence only."""

    def __init__(self, part: int):
        self.next_id = part << 36
        self.open: list[tuple] = []  # doc_id, start, ids as bytes of 32 bits, doc_tokens
        self.filled = 0
        self.rows: list[tuple] = []

    def _emit(self) -> None:
        offset = 0
        for doc_id, start, data, total in self.open:
            self.rows.append((doc_id, start, len(data) // 4, crc32(data), total, self.next_id, offset))
            offset += len(data) // 4
        self.next_id += 1
        self.open, self.filled = [], 0

    def _add(self, doc_id, start: int, data: bytes, total: int, room: int) -> tuple[int, bytes]:
        """Put what fits into the open sequence; returns what is left."""
        take = min(len(data), 4 * (room - self.filled))
        self.open.append((doc_id, start, data[:take], total))
        self.filled += take // 4
        if self.filled == room:
            self._emit()
        return start + take // 4, data[take:]

    def add(self, doc_id, ids: np.ndarray) -> None:
        start, data, total = 0, ids.astype("<u4").tobytes(), len(ids)
        if self.filled:
            start, data = self._add(doc_id, start, data, total, SEQUENCE)
        view = memoryview(data)
        at = 0
        while at < len(data):
            take = min(len(data) - at, 4 * SEQUENCE)
            self._add(doc_id, start + at // 4, bytes(view[at : at + take]), total, SEQUENCE)
            at += take

    def close(self) -> None:
        """The last sequence, cut at powers of two."""
        tail, left = self.open, self.filled
        self.open, self.filled = [], 0
        for doc_id, start, data, total in tail:
            while data:
                room = 1 << (left.bit_length() - 1)
                before = self.next_id
                start, data = self._add(doc_id, start, data, total, room)
                if self.next_id != before:
                    left -= room

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return batch_of(PIECES, *(zip(*rows, strict=True) if rows else [[]] * 7))


def range_partitions(total_bytes: int) -> int:
    """Partitions for so many bytes of ids."""
    size = min(max(int(total_bytes) // USUAL_PARTITIONS, PARTITION_BYTES), LARGEST_PARTITION)
    return max(1, -(-int(total_bytes) // size))


def pack_documents(
    spark: SparkSession, documents: DataFrame, vocabulary: str | None = None, pattern: str | None = None,
    id_column="doc_id", text_column="text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    tokens = tokenised(documents, path, pattern or public_tokenizers.PATTERN, id_column, text_column)
    tokens = written(spark, tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    at = [F.element_at("vector", i + 1).cast("double") for i in range(DIMENSIONS)]
    totals = tokens.agg(F.sum("n"), *[F.avg(a) for a in at], *[F.stddev_pop(a) for a in at]).first()
    means = [x or 0.0 for x in totals[1 : 1 + DIMENSIONS]]
    deviations = [x or 0.0 for x in totals[1 + DIMENSIONS :]]
    wide = merge_ranks(path)
    kind = np.dtype("<u2" if max(wide.values()) < 1 << 16 else "<u4")
    parts = range_partitions((totals[0] or 0) * kind.itemsize)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId())
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.frombuffer(ids.as_buffer(), kind))
            yield packer.taken()
        packer.close()
        yield packer.taken()

    keyed = tokens.select("doc_id", "ids", "row", curve_key(F.col("vector"), means, deviations).alias("key"))
    ordered = keyed.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")
    return ordered.select("doc_id", "ids").mapInArrow(pack, ", ".join(f"{f.name} long" for f in PIECES))
