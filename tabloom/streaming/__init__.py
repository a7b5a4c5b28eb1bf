"""Scoring a stream. Fitted models are stateless expressions, so the batch scorer is the
stream scorer; nothing else of the library streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(stream: DataFrame, model, path: str, checkpoint: str, name: str = "prediction") -> StreamingQuery:
    """Score a streaming table and append the rows to Parquet, until the input is used up."""
    if not stream.isStreaming:
        raise ValueError("not a stream: call model.score(frame) instead")
    return (
        model.score(stream, name)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
