"""Exact dedup by content-defined chunk recipes.

A text, A-Z lower-cased, is cut where a rolling hash of its bytes says so; equal texts have equal cuts. Chunks are
deduplicated to identifiers, each verified by a second, independent digest; two documents are equal when their
ordered identifier lists are. Only digests are shuffled, so a long document is read once and never moved.

Defined cases: a null text is empty, and all empty texts are one group; a null doc_id is smaller than any other;
repeated rows count each for itself and one of them stays; an empty table gives an empty result; columns other than
the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, slices, texts_of, written

WINDOW_BITS = 4  # the rolling hash sees 2 ** 4 bytes
MEAN_BITS = 12  # a cut every 4096 bytes on average
SMALLEST, LARGEST = 1024, 32768
GEAR = np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)
BEFORE = "doc_id long, text_sha256 string, chunk_keys array<binary>, chunk_checks array<binary>"
BEFORE_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_sha256", pa.string()),
        ("chunk_keys", pa.list_(pa.binary())),
        ("chunk_checks", pa.list_(pa.binary())),
    ]
)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of one text; an empty text is one empty chunk."""
    size = len(data)
    if size <= SMALLEST:
        return [size]
    rolling = GEAR[np.frombuffer(data, np.uint8)]
    for bit in range(WINDOW_BITS):  # each step doubles the window
        reach = 1 << bit
        rolling[reach:] = rolling[reach:] + (rolling[:-reach] << np.uint32(reach))
    marks = np.flatnonzero((rolling >> np.uint32(32 - MEAN_BITS)) == 0) + 1
    ends, last = [], 0
    for mark in [*marks.tolist(), size]:
        while mark - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if mark - last >= SMALLEST or mark == size and mark > last:
            last = mark
            ends.append(last)
    return ends


def _recipes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        digests, keys, checks = [], [], []
        for text in batch.column(1).to_pylist():
            data = text.encode().lower()  # bytes.lower() changes A-Z only
            digests.append(sha256(data).hexdigest())
            view, start, row_keys, row_checks = memoryview(data), 0, [], []
            for end in cuts(data):
                chunk = view[start:end]
                row_keys.append(xxhash.xxh3_128_digest(chunk))
                row_checks.append(blake2b(chunk, digest_size=16).digest())
                start = end
            keys.append(row_keys)
            checks.append(row_checks)
        yield batch_of(BEFORE_ARROW, batch.column(0), digests, keys, checks)


def chunk_identifiers(recipes: DataFrame) -> DataFrame:
    """One row per chunk key; ``sole`` is false where two different contents share the key."""
    chunk = recipes.select(F.explode(F.arrays_zip("chunk_keys", "chunk_checks")).alias("c"))
    return (
        chunk.groupBy(F.col("c.chunk_keys").alias("chunk_key"))
        .agg(F.min("c.chunk_checks").alias("lo"), F.max("c.chunk_checks").alias("hi"))
        .select("chunk_key", (F.col("lo") == F.col("hi")).alias("sole"))
    )


def verified_recipes(spark: SparkSession, documents: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """(doc_id, text_sha256, copies, recipe): ordered verified identifiers; ``copies`` counts repeated rows."""
    before = texts_of(documents, id_column, text_column).mapInArrow(_recipes, BEFORE)
    before = written(spark, before.groupBy(*before.columns).agg(F.count("*").alias("copies")), "recipes")
    placed = before.select(
        "doc_id", "text_sha256", "copies", F.posexplode(F.arrays_zip("chunk_keys", "chunk_checks")).alias("at", "c")
    ).select("doc_id", "text_sha256", "copies", "at", F.col("c.chunk_keys").alias("chunk_key"), "c.chunk_checks")
    named = placed.join(chunk_identifiers(before), "chunk_key").select(
        "doc_id", "text_sha256", "copies", "at",
        F.when(F.col("sole"), F.col("chunk_key")).otherwise(F.concat("chunk_key", "chunk_checks")).alias("identifier"),
    )
    # without a key in common the lists of different texts with one doc_id would mix, hence the text's digest
    ordered = named.groupBy("doc_id", "text_sha256", "copies").agg(
        F.array_sort(F.collect_list(F.struct("at", "identifier"))).alias("recipe")
    )
    return ordered.withColumn("recipe", F.col("recipe.identifier"))


def exact_groups(spark: SparkSession, documents: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks."""
    recipes = written(spark, verified_recipes(spark, documents, id_column, text_column), "verified")
    groups = recipes.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    rows = recipes.join(groups, "recipe").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    # rows with one doc_id and one text are alike: the first copy stays
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256", F.size("recipe").cast("long").alias("n_chunks"),
    )


def drop_copies(spark: SparkSession, documents: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """The documents without exact copies, with all their columns.

    Of rows with the same doc_id and equal text the one whose text is smallest in order stays.
    """
    row_key = lambda doc_id, digest: F.concat_ws("/", F.coalesce(doc_id.cast("string"), F.lit("null")), digest)
    kept = exact_groups(spark, documents, id_column, text_column).where("kept")
    kept = kept.select(row_key(F.col("doc_id"), F.col("text_sha256")).alias("_key"))
    lowered = F.translate(
        F.coalesce(F.col(text_column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    rows = documents.select(
        F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("_row"),
        row_key(F.col(id_column).cast("long"), F.sha2(lowered, 256)).alias("_key"),
    )
    # combined before the shuffle, which also serves the join
    rows = rows.groupBy("_key").agg(
        F.min_by("_row", F.col(f"_row.`{text_column}`")).alias("_row"), F.first("_row").alias("_any")
    )
    rows = rows.join(kept, "_key", "left_semi")
    return rows.select(F.coalesce("_row", "_any").alias("_row")).select("_row.*")
