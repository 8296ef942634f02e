"""High-water marks that make every load incremental."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.coerce import coerce_ts

def bound_literal(ts: dt.datetime) -> Column:
    """A Python timestamp (UTC when it carries no zone) as a Spark literal."""
    if ts.tzinfo is not None:
        ts = ts.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp")


def instant_text(c: Column) -> Column:
    """An instant as UTC text, whose order is that of time: a collected timestamp would take the driver's zone."""
    return F.when(F.year(c).between(1, 9999), F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def text_instant(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text) if text else None


def _scalar(df: DataFrame, value: Column) -> dt.datetime | None:
    row = df.select(instant_text(value).alias("v")).first()
    return text_instant(row["v"]) if row else None


def next_bound(ts_cols: Sequence[str]) -> Column:
    """Aggregate: the latest instant, taking the first non-empty of ``ts_cols`` per row.

    Values are compared as instants, so mixed zone offsets order correctly.
    """
    texts = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in ts_cols]
    return F.max(coerce_ts(F.coalesce(*texts)))


def table_bound(table: DataFrame | None, column: str = "updated_at") -> dt.datetime | None:
    """Latest instant of a loaded table; None (load everything) if absent, empty or all NULL."""
    return None if table is None else _scalar(table, F.max(column))


def newer_than(
    df: DataFrame,
    column: str,
    since: dt.datetime | None,
    lookback: dt.timedelta = dt.timedelta(0),
    keep_timeless: bool = False,
) -> DataFrame:
    """Rows strictly after ``since - lookback``; everything when there is no bound.

    A NULL time passes a bound only with ``keep_timeless``. ``lookback`` re-reads
    late rows, which a keyed merge absorbs.
    """
    if since is None:
        return df
    newer = F.col(column) > bound_literal(since - lookback)
    return df.filter(newer | F.col(column).isNull() if keep_timeless else newer)


def get_bound(state: DataFrame | None, entity: str) -> dt.datetime | None:
    """Stored bound of an entity, None before its first load."""
    if state is None:
        return None
    return _scalar(state.filter(F.col("entity") == entity), F.col("last_updated_at"))
