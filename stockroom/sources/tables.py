"""Warehouse tables: views for staging, Parquet for marts."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.sources.files import folders, get_text, put_text, remove


def write_mart(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace a mart by ``df`` and return the written table.

    The rows go to a folder of their own beside the present ones; then one small file,
    ``_current``, is switched to it. A write that fails leaves the mart as it was, and
    readers see the old rows or the new ones. The version before stays for readers that
    have begun; older ones and those of broken writes are removed.

    Unpartitioned marts are written as they come, without a shuffle. A partitioned
    one is first gathered by partition value: few files each, and a value that
    holds much of the data is split over several tasks.
    """
    spark = df.sparkSession
    version = f"version-{uuid.uuid4().hex}"
    before = _current(spark, path)
    if partition_by:
        df = df.hint("rebalance", *(F.col(c) for c in partition_by))
    df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    put_text(spark, f"{path}/_current", json.dumps({"version": version, "schema": json.loads(df.schema.json())}))
    for name in folders(spark, path):
        if name.startswith("version-") and name not in (version, before and before["version"]):
            remove(spark, f"{path}/{name}")
    return read_mart(spark, path)


def _current(spark: SparkSession, path: str) -> dict | None:
    text = get_text(spark, f"{path}/_current")
    return json.loads(text) if text else None


def mart_folder(spark: SparkSession, path: str) -> str | None:
    """Where a mart's present rows lie, None when it was never written."""
    current = _current(spark, path)
    return current and f"{path}/{current['version']}"


def read_mart(spark: SparkSession, path: str) -> DataFrame | None:
    """A mart, or None when it was never written."""
    current = _current(spark, path)
    if current is None:
        return None
    return spark.read.schema(T.StructType.fromJson(current["schema"])).parquet(f"{path}/{current['version']}")


def register_views(models: Mapping[str, DataFrame]) -> None:
    """Publish lazy models under their names, for SQL users of the session."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
