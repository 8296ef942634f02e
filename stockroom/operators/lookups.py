"""Dimension lookups: left joins that add a surrogate key to a fact."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup row is an id and a 32-character key, so this bounds a broadcast to some 20 MB.
BROADCAST_ROWS = 200_000


def fits_broadcast(
    sides: Mapping[str, DataFrame], max_rows: int = BROADCAST_ROWS
) -> dict[str, bool]:
    """Measure, in one job of plain counts, which frames have at most ``max_rows`` rows."""
    if not sides:
        return {}
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in sides.items()
    ]
    counted = reduce(DataFrame.unionByName, counts).collect()
    return {row["name"]: row["n"] <= max_rows for row in counted}


def lookup(
    fact: DataFrame, side: DataFrame, on: Column, natural: str, key: str, alias: str | None = None
) -> DataFrame:
    """Add ``key`` of the row of ``side`` whose ``natural`` equals ``on``; NULL when none does.

    ``side`` must hold each natural value once, so the fact keeps its row count.
    """
    found = side.select(F.col(natural).alias("_natural"), F.col(key).alias(alias or key))
    return fact.join(found, on == F.col("_natural"), "left").drop("_natural")
