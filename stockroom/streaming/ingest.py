"""Run-to-completion streams. The checkpoint remembers which files were taken.

Every micro-batch is written idempotently under its query and batch id, so a
batch replayed after a failure leaves no duplicates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stockroom.operators.bounds import bound_literal
from stockroom.operators.flatten import split_keyed, to_payload
from stockroom.operators.keyed import KeyedTable
from stockroom.operators.scd2 import version_change
from stockroom.plans.facts import split_payments
from stockroom.sources.registry import EntitySpec
from stockroom.streaming.micro import run_available


def stream_table(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A Parquet table, one file or a folder of them, as a stream of its files."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    # A pattern, unlike a plain path, may also name a single file.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def start_ingest(
    pages: DataFrame, spec: EntitySpec, lake: KeyedTable, rejected: str, checkpoint: str, as_of
) -> StreamingQuery:
    """Streamed records (see ``stream_pages``) into the lake; keyless ones to ``rejected``."""

    def step(batch: DataFrame, batch_id: str) -> None:
        keyed, bad = split_keyed(to_payload(batch, spec))
        bad.write.mode("overwrite").parquet(f"{rejected}/batch={batch_id}")
        lake.merge(keyed.withColumn("loaded_at", bound_literal(as_of)), batch_id)

    return run_available(pages, checkpoint, step)


def start_upsert(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Streamed rows merged into a keyed table."""

    def step(batch: DataFrame, batch_id: str) -> None:
        table.merge(batch, batch_id)

    return run_available(stream, checkpoint, step)


def start_scd2(
    stream: DataFrame,
    table: KeyedTable,
    key: str,
    updated_at: str,
    checkpoint: str,
    tie_break: Sequence[str] = (),
) -> StreamingQuery:
    """Streamed versions woven into a history table.

    A batch may hold several versions of a key and late ones; nothing is deleted.
    """
    change = version_change(key, updated_at, tie_break)

    def step(batch: DataFrame, batch_id: str) -> None:
        table.rewrite(batch, batch_id, change)

    return run_available(stream, checkpoint, step)


def start_quarantine(
    payments: DataFrame, clean: str, flagged: str, checkpoint: str
) -> StreamingQuery:
    """Staged payments split over two tables; read them back with :func:`read_split`."""

    def step(batch: DataFrame, batch_id: str) -> None:
        for rows, path in zip(split_payments(batch), (clean, flagged), strict=True):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return run_available(payments, checkpoint, step)


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches of one side of a quarantine split."""
    return spark.read.parquet(path).drop("batch")
