"""Incremental movement of one entity: landed pages → lake → typed warehouse table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.bounds import (
    bound_literal,
    get_bound,
    instant_text,
    newer_than,
    text_instant,
)
from stockroom.operators.flatten import flatten, split_keyed, to_payload, typed
from stockroom.operators.keyed import KeyedTable, Period
from stockroom.sources.files import folders
from stockroom.sources.pages import stream_pages
from stockroom.sources.registry import EntitySpec
from stockroom.sources.tables import read_mart, write_mart
from stockroom.streaming.micro import run_available


@dataclass(frozen=True)
class Context:
    """One run: where data lives, the run's name and the time it stands for.

    ``period`` is the calendar unit lake and warehouse tables are clustered by: choose
    it so that a period of the largest entity holds a few GB. Landed files whose time is
    ``max_file_age`` behind the newest one's are taken for seen; ``max_files`` bounds
    the files of one micro-batch. Repeating a run under the same ``run_id`` changes
    nothing.
    """

    spark: SparkSession
    landing: str
    root: str
    run_id: str
    as_of: dt.datetime
    lookback: dt.timedelta = dt.timedelta(0)
    multi_line: bool = False
    evolve: bool = True
    period: str = "day"
    parallel: int = 4
    partition_facts: bool = False
    calendar: tuple[dt.date, dt.date] | None = None
    max_files: int = 100_000
    max_file_age: str = "90d"

    def lake(self, spec: EntitySpec) -> KeyedTable:
        """Latest record per key; a record gives way to one that is not older."""
        return KeyedTable(
            self.spark,
            f"{self.root}/lake/{spec.name}",
            keys=["id"],
            order=["updated_at", "raw_data"],
            period=Period("updated_at", self.period),
            sort_by=["updated_at"],
            newer="updated_at",
        )

    def warehouse(self, spec: EntitySpec) -> KeyedTable:
        return KeyedTable(
            self.spark,
            f"{self.root}/warehouse/raw/{spec.name}",
            keys=["_lake_id"],
            order=["_lake_updated_at"],
            period=Period(spec.cursor, self.period),
            sort_by=[spec.cursor],
        )

    def intake(self, spec: EntitySpec) -> str:
        """What the intake remembers: Spark's log of files taken, and the records of its last batch."""
        return f"{self.root}/lake/_intake/{spec.name}"

    def rejected(self, spec: EntitySpec) -> str:
        """Records without a usable key, a folder per batch of the intake."""
        return f"{self.root}/lake/_rejected/{spec.name}"

    def bounds(self, stage: str = "lake") -> DataFrame | None:
        """How far each entity has come in the lake or the warehouse: a row per entity; None before the first."""
        place = f"{self.root}/{stage}/_bounds"
        found = [read_mart(self.spark, f"{place}/{name}") for name in folders(self.spark, place)]
        return reduce(DataFrame.unionByName, found) if found else None


def read_lake(
    ctx: Context,
    spec: EntitySpec,
    since: dt.datetime | None = None,
    lookback: dt.timedelta = dt.timedelta(0),
) -> DataFrame | None:
    """Lake rows, all or those updated after a bound or at no known time; None before the first sync.

    Periods that end before the bound are not opened.
    """
    lake = ctx.lake(spec)
    rows = lake.read(None if since is None else lake.since(bound_literal(since - lookback)))
    return None if rows is None else newer_than(rows, "updated_at", since, lookback, keep_timeless=True)


def sync_entity(ctx: Context, spec: EntitySpec) -> bool:
    """Move newly landed records into the lake. False when there were none.

    The pages are a file stream run to completion: its checkpoint knows the files that
    earlier runs have taken, so no path passes through this code, and a batch that broke
    off is repeated. Each page is parsed once, into a written batch. Every record of a
    new page counts, late or tied ones too: the merge keeps a stored record only
    where it is newer than the batch's.
    """
    merged = []
    place = ctx.intake(spec)

    def step(batch: DataFrame, batch_id: str) -> None:
        seen = Observation()
        records = to_payload(batch, spec).observe(seen, F.max(instant_text(F.col("updated_at"))).alias("reached"))
        keyed, rejected = split_keyed(write_mart(records, f"{place}/records"))
        bad = rejected.withColumn("run_id", F.lit(ctx.run_id))
        bad.write.mode("overwrite").parquet(f"{ctx.rejected(spec)}/batch={batch_id.rsplit('-', 1)[1]}")
        landed = keyed.withColumn("loaded_at", bound_literal(ctx.as_of))
        merged.append(ctx.lake(spec).merge(landed, batch_id))
        _advance(ctx, "lake", spec, seen.get["reached"])

    pages = stream_pages(ctx.spark, ctx.landing, spec, ctx.multi_line, ctx.max_files, ctx.max_file_age)
    ctx.lake(spec).finish()
    run_available(pages, f"{place}/checkpoint", step).awaitTermination()
    return any(merged)


def load_entity(ctx: Context, spec: EntitySpec) -> bool:
    """Move lake rows newer than the warehouse into it, flattened and typed."""
    target = ctx.warehouse(spec)
    target.finish()
    since = get_bound(_bound(ctx, "warehouse", spec), spec.name) if target.exists() else None
    rows = read_lake(ctx, spec, since, ctx.lookback)
    if rows is None:
        return False
    flat = typed(flatten(rows, spec.schema, evolve=ctx.evolve), spec.schema)
    seen = Observation()
    batch = flat.observe(seen, F.max(instant_text(F.col(spec.cursor))).alias("reached"))
    merged = target.merge(batch, ctx.run_id)
    if merged:
        _advance(ctx, "warehouse", spec, seen.get["reached"])
    return merged


def _bound(ctx: Context, stage: str, spec: EntitySpec) -> DataFrame | None:
    return read_mart(ctx.spark, f"{ctx.root}/{stage}/_bounds/{spec.name}")


def _advance(ctx: Context, stage: str, spec: EntitySpec, reached: str | None) -> None:
    """Record how far an entity now reaches, taken from the batch just merged.

    Runs after the data is published: a crash in between replays the batch, which the
    merge absorbs. An entity has a file of its own, so entities advance side by side.
    """
    stored = get_bound(_bound(ctx, stage, spec), spec.name)
    newest = max((t for t in (stored, text_instant(reached)) if t is not None), default=None)
    if newest is not None:
        row = ctx.spark.range(1).select(
            F.lit(spec.name).alias("entity"),
            bound_literal(newest).alias("last_updated_at"),
            bound_literal(ctx.as_of).alias("last_run_at"),
        )
        write_mart(row, f"{ctx.root}/{stage}/_bounds/{spec.name}")
