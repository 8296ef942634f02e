"""Streams run to completion, a repeatable step per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_available(
    stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, str], None]
) -> StreamingQuery:
    """Start a stream that takes everything available and stops.

    ``step`` gets each batch and its id, ``<query>-<number>``, the same whenever the batch
    is repeated. The checkpoint remembers which input was taken.
    """

    def on_batch(batch: DataFrame, number: int) -> None:
        # A query keeps its id with its checkpoint; a fresh checkpoint is a new query.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        step(batch, f"{query or checkpoint}-{number}")

    writer = stream.writeStream.foreachBatch(on_batch).trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start()
