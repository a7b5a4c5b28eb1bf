"""What the operators share: reading texts, Arrow batches, written tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabloom.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts_of(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text counts as empty, other columns are left out."""
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def written(spark: SparkSession, frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, safe when executors are lost."""
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose texts have about ``most`` bytes; one row at least.

    At the end Arrow gives back what it keeps for later: the worker lives on beside those of other stages."""
    try:
        for batch in batches:
            sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
            first = held = 0
            for row, size in enumerate(sizes):
                if held and held + size > most:
                    yield batch.slice(first, row - first)
                    first, held = row, 0
                held += size
            if first < batch.num_rows:
                yield batch.slice(first)
    finally:
        pa.default_memory_pool().release_unused()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def drawn(spark: SparkSession, rows: DataFrame, group: str, order: str, most: int, most_groups: int) -> DataFrame:
    """Of each group the ``most`` rows with the smallest ``order``, a 64-bit hash, which no two rows should share.

    The sizes of the groups tell below which hash enough rows must be, so what meets in a group's window is bounded by
    ``most`` and not by the group. More groups than ``most_groups`` are refused.
    """
    sizes = rows.groupBy(F.col(group).alias("of_group")).agg(F.count("*").alias("of_size")).limit(most_groups + 1).collect()
    if len(sizes) > most_groups:
        raise ValueError(f"more than {most_groups} values of {group}")
    table = F.broadcast(spark.createDataFrame([tuple(r) for r in sizes], sizes_schema(rows, group)))
    share = F.col(order) / 2.0**64 + 0.5
    few = rows.join(table, F.col(group) == F.col("of_group")).where(share * F.col("of_size") < 2 * most + 50)
    place = F.row_number().over(Window.partitionBy(group).orderBy(order))
    return few.withColumn("place", place).where(F.col("place") <= most).select(*rows.columns)


def sizes_schema(rows: DataFrame, group: str) -> str:
    return f"of_group {dict(rows.dtypes)[group]}, of_size long"
