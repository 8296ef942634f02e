"""Keyed upsert, pure and as a Parquet table that can be merged into.

Parquet tables take no ``MERGE INTO``. A table here is partitioned by a calendar
period of a time column, and a merge replaces, by dynamic partition overwrite, the
periods that hold a row it alters or get one: a day's batch of new rows rewrites
that day. Rows of other periods are neither read whole nor written.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.operators.latest import latest_by_key
from stockroom.sources.files import get_text, put_text, remove

PERIOD = "_period"  # the partition column; no table column may have this name


def _union(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column may be new or missing but may not change its type."""
    old, new = dict(target.dtypes), dict(batch.dtypes)
    changed = [c for c in old.keys() & new.keys() if old[c] != new[c]]
    if changed:
        raise ValueError(f"columns change type: {[(c, old[c], new[c]) for c in sorted(changed)]}")
    return target.unionByName(batch, allowMissingColumns=True)


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_newest: bool = False,
) -> DataFrame:
    """``target`` with the batch's rows in place of those of equal key.

    Rows are replaced whole: a column the batch lacks becomes NULL. Inside the
    batch the greatest ``order`` wins. Across batches the later batch wins,
    unless ``keep_newest`` refuses rows older than the stored ones.
    """
    if target is None:
        return latest_by_key(batch, keys, order)
    if keep_newest:
        return latest_by_key(_union(target, batch), keys, order)
    # distinct() thins repeated keys before the shuffle; AQE broadcasts a small key list.
    replaced = batch.select(*keys).distinct()
    kept = target.join(replaced, list(keys), "left_anti")
    return _union(kept, latest_by_key(batch, keys, order))


@dataclass(frozen=True)
class Period:
    """A calendar unit (day, week, month, quarter, year) of a time column; NULL times share a period."""

    column: str
    unit: str = "day"

    def of(self, time: Column) -> Column:
        # Years that a calendar of four digits lacks count as no time.
        return F.when(F.year(time).between(1, 9999), F.date_trunc(self.unit, time).cast("date"))


@dataclass(frozen=True)
class Change:
    """How a batch alters a stored table.

    ``marks(new rows)`` has one row per key and says what the batch reaches;
    ``hits(stored rows, marks)`` are the stored rows it alters, found by reading
    ``columns`` alone. ``combine(stored rows, new rows, marks)`` gives the content
    that takes the place of the periods holding hits, and ``first(new rows)``
    that of an empty table. ``since`` names a column of the marks: periods that end
    before its least value hold no hits. ``within`` is a condition on the period that
    all hits meet.
    """

    columns: Sequence[str]
    marks: Callable[[DataFrame], DataFrame]
    hits: Callable[[DataFrame, DataFrame], DataFrame]
    combine: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
    first: Callable[[DataFrame], DataFrame]
    since: str | None = None
    within: Column | None = None


class KeyedTable:
    """A Parquet table with one row per key, changed by repeatable merges.

    ``period`` clusters the rows; without one the table is a single period, which every
    merge rewrites. ``sort_by`` orders the rows of a file, so that a filter on those
    columns skips row groups. Among rows of a key the later batch wins; with
    ``keep_newest`` the greatest ``order`` does, and with ``newer`` a stored row stays
    where its ``newer`` column is greater than the batch's. One writer at a time.

    A merge writes the new content of its periods beside the table first. From then on
    it can be finished by anyone: a merge that broke off while periods were replaced is
    completed by the next call, so none is lost; until then readers may see some
    periods replaced and others not. The last batch is not applied a second time.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str] = ("updated_at",),
        period: Period | None = None,
        sort_by: Sequence[str] = (),
        keep_newest: bool = False,
        newer: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.order = list(order)
        self.period = period
        self.sort_by = list(sort_by)
        self.keep_newest = keep_newest
        self.newer = newer

    # -- what is stored ----------------------------------------------------

    def _staged(self, part: str) -> str:
        return f"{self.path}/_staging/{part}"

    def _state(self) -> dict | None:
        """Schema and last batch, None before the first merge."""
        text = get_text(self.spark, f"{self.path}/_state")
        return json.loads(text) if text else None

    def _scan(self, path: str, schema: T.StructType) -> DataFrame:
        clustered = T.StructType([*schema.fields, T.StructField(PERIOD, T.DateType())])
        return self.spark.read.schema(clustered).parquet(path)

    def _rows(self, state: dict) -> DataFrame:
        return self._scan(self.path, T.StructType.fromJson(state["schema"]))

    def exists(self) -> bool:
        return self._state() is not None

    def read(self, where: Column | None = None) -> DataFrame | None:
        """The current rows, or None before the first merge; ``where`` chooses periods by :data:`PERIOD`."""
        state = self._state()
        if state is None:
            return None
        rows = self._rows(state)
        return (rows if where is None else rows.filter(where)).drop(PERIOD)

    def since(self, time: Column) -> Column:
        """Condition on the period: those that may hold rows of ``time`` or later, or of no time."""
        if self.period is None:
            return F.lit(True)
        return (F.col(PERIOD) >= self.period.of(time)) | F.col(PERIOD).isNull()

    # -- merging -----------------------------------------------------------

    def merge(self, batch: DataFrame, batch_id: str, within: Column | None = None) -> bool:
        """Upsert a batch; False when it is empty or was the last one applied.

        ``within`` tells which periods may hold its keys, where the caller knows.
        """

        def combine(current: DataFrame, fresh: DataFrame, keys: DataFrame) -> DataFrame:
            if self.keep_newest:
                return latest_by_key(_union(current, fresh), self.keys, self.order)
            if self.newer:
                held = current.select(*self.keys, F.col(self.newer).alias("_held"))
                behind = fresh.join(held, self.keys).filter(F.col("_held") > F.col(self.newer)).select(*self.keys)
                fresh = fresh.join(behind, self.keys, "left_anti")
                keys = fresh.select(*self.keys)
            return _union(current.join(keys, self.keys, "left_anti"), fresh)

        replace = Change(
            columns=self.keys,
            marks=lambda fresh: fresh.select(*self.keys).distinct(),
            hits=lambda stored, keys: stored.join(keys, self.keys, "left_semi"),
            combine=combine,
            first=lambda fresh: fresh,
            within=within,
        )
        return self.rewrite(latest_by_key(batch, self.keys, self.order), batch_id, replace)

    def rewrite(self, rows: DataFrame, batch_id: str, change: Change) -> bool:
        """Apply a change; False when ``rows`` is empty or the batch was the last one applied."""
        self.finish()
        state = self._state()
        if state and state["batch_id"] == batch_id:
            return False
        # Written once, then read for marks, periods and the new content.
        rows.write.mode("overwrite").parquet(self._staged("rows"))
        fresh = self.spark.read.schema(rows.schema).parquet(self._staged("rows"))
        if fresh.isEmpty():
            return False
        if state is None:
            touched: list[dt.date | None] = []
            merged = change.first(fresh)
        else:
            marks, stored = change.marks(fresh), self._rows(state)
            touched = self._hit(stored, marks, change)
            merged = change.combine(stored.filter(_is_one_of(touched)).drop(PERIOD), fresh, marks)
        schema = merged.schema
        self._write(merged, "overwrite")
        written = self._periods(self._scan(self._staged("content"), schema))
        if state is not None:
            # A period that gets rows without having lost any keeps those it has.
            others = [p for p in written if p not in touched]
            if others:
                self._write(stored.filter(_is_one_of(others)).drop(PERIOD), "append")
        emptied = [str(p) if p else None for p in touched if p not in written]
        new_state = {"batch_id": batch_id, "schema": json.loads(schema.json())}
        put_text(self.spark, self._staged("ready"), json.dumps({"emptied": emptied, "state": new_state}))
        self.finish()
        return True

    def _periods(self, rows: DataFrame) -> list[dt.date | None]:
        """Periods of some rows: as many as the calendar has, whatever the rows."""
        return [r[PERIOD] for r in rows.select(PERIOD).distinct().collect()]

    def _hit(self, stored: DataFrame, marks: DataFrame, change: Change) -> list[dt.date | None]:
        """Periods that hold a row the change alters; key columns alone are read."""
        located = stored.select(*change.columns, PERIOD)
        if change.within is not None:
            located = located.filter(change.within)
        if change.since and self.period:
            least = marks.agg(self.period.of(F.min(change.since)).alias("d")).first()["d"]
            if least is not None:
                located = located.filter((F.col(PERIOD) >= F.lit(least)) | F.col(PERIOD).isNull())
        return self._periods(change.hits(located, marks))

    def _write(self, rows: DataFrame, mode: str) -> None:
        period = self.period.of(F.col(self.period.column)) if self.period else F.lit(None).cast("date")
        # Rebalancing splits a large period over several tasks and packs small ones together.
        (
            rows.withColumn(PERIOD, period)
            .hint("rebalance", F.col(PERIOD))
            .sortWithinPartitions(PERIOD, *self.sort_by)
            .write.mode(mode)
            .partitionBy(PERIOD)
            .parquet(self._staged("content"))
        )

    def finish(self) -> None:
        """Replace the periods a merge has made ready; repeatable at any point, and nothing without one."""
        text = get_text(self.spark, self._staged("ready"))
        if text is None:
            return
        ready = json.loads(text)
        content = self._scan(self._staged("content"), T.StructType.fromJson(ready["state"]["schema"]))
        (
            content.sortWithinPartitions(PERIOD, *self.sort_by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PERIOD)
            .parquet(self.path)
        )
        for period in ready["emptied"]:
            remove(self.spark, f"{self.path}/{PERIOD}={period or '__HIVE_DEFAULT_PARTITION__'}")
        put_text(self.spark, f"{self.path}/_state", json.dumps(ready["state"]))
        remove(self.spark, self._staged("ready"))
        remove(self.spark, f"{self.path}/_staging")


def _is_one_of(periods: Iterable[dt.date | None]) -> Column:
    dates = [F.lit(p) for p in periods if p is not None]
    known = F.col(PERIOD).isin(*dates) if dates else F.lit(False)
    return F.coalesce(known, F.lit(False)) | (F.col(PERIOD).isNull() if None in periods else F.lit(False))
