"""Slowly changing history: one row per key and version, open versions end at NULL.

A history frame holds the tracked columns and ``valid_from, valid_to, scd_id,
scd_updated_at``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockroom.functions.scalars import timestamp_text
from stockroom.operators.bounds import bound_literal
from stockroom.operators.keyed import Change
from stockroom.operators.latest import latest_by_key

# Columns a history adds to the tracked ones.
HISTORY_COLUMNS = ("valid_from", "valid_to", "scd_id", "scd_updated_at")

# Above this many versions of one key, timelines are cut into pieces before they are ordered.
MAX_TIMELINE = 1_000_000

# Calendar units a timeline may be cut at, coarsest first.
TIME_UNITS = ("year", "month", "day", "hour", "minute", "second")


def scd_id(key: Column, valid_from: Column) -> Column:
    """Row id of a version: key and start of validity."""
    parts = (key.cast("string"), timestamp_text(valid_from))
    return F.md5(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)))


def _version(key: str, updated_at: str, valid_to: Column) -> list[Column]:
    return [
        F.col(updated_at).alias("valid_from"),
        valid_to.cast("timestamp").alias("valid_to"),
        scd_id(F.col(key), F.col(updated_at)).alias("scd_id"),
        F.col(updated_at).alias("scd_updated_at"),
    ]


def open_history(source: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """History of a first run: every source row is an open version. No join, no shuffle."""
    return source.select("*", *_version(key, updated_at, F.lit(None)))


def open_rows(history: DataFrame) -> DataFrame:
    return history.filter("valid_to IS NULL")


def last_closes(closed: DataFrame, key: str, members: DataFrame | None = None) -> DataFrame:
    """When the latest closed version of each member ended; two columns are read.

    ``members``, a column of keys, narrows the closed rows before these are grouped: a run
    then groups the versions of returning members, not the whole history.
    """
    mine = closed.select(F.col(key).alias("_closed_key"), "valid_to")
    if members is not None:
        wanted = members.select(F.col(members.columns[0]).alias("_member"))
        mine = mine.join(wanted, F.col("_closed_key") == F.col("_member"), "left_semi")
    return mine.groupBy("_closed_key").agg(F.max("valid_to").alias("_closed"))


def snapshot_changes(
    history: DataFrame,
    source: DataFrame,
    key: str,
    updated_at: str,
    as_of: dt.datetime,
    invalidate_deletes: bool = True,
    keep_unchanged: bool = False,
    closed: DataFrame | None = None,
    unopened: DataFrame | None = None,
) -> DataFrame:
    """History rows a run opens or closes.

    ``history`` may hold the open versions alone where ``closed`` gives the others;
    ``unopened`` may give the keys of the source that have no open version, so that the
    closes of those alone are sought. Only open versions meet the source, each side
    holding a key once:

    * new key: open a version from its update time, or, when the key has been closed
      before, from its last close if that is later, so that versions never overlap;
    * later update time: close the version there and open the next;
    * equal or earlier time: unchanged, whatever the attributes say;
    * key gone: close at ``as_of`` (when ``invalidate_deletes``).
    """
    closed = history.filter("valid_to IS NOT NULL") if closed is None else closed
    stored = open_rows(history).select(F.struct(*source.columns, *HISTORY_COLUMNS).alias("old"))
    incoming = open_history(source, key, updated_at)
    incoming = incoming.select(F.struct(*source.columns, *HISTORY_COLUMNS).alias("new"))

    def closing(at: Column) -> Column:
        return F.col("old").withField("valid_to", at)

    is_new = F.col("old").isNull()
    is_gone = F.col("new").isNull()
    is_later = F.col(f"new.{updated_at}") > F.col("old.valid_from")
    same = F.array("old") if keep_unchanged else F.lit(None)
    gone = F.array(closing(bound_literal(as_of))) if invalidate_deletes else same
    rows = (
        F.when(is_new, F.array("new"))
        .when(is_gone, gone)
        .when(is_later, F.array(closing(F.col(f"new.{updated_at}")), F.col("new")))
        .otherwise(same)
    )
    joined = stored.join(incoming, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    closes = last_closes(closed, key, unopened)
    joined = joined.join(closes, F.col(f"new.{key}") == F.col("_closed_key"), "left")
    start = F.greatest(F.col(f"new.{updated_at}"), F.col("_closed"))
    begun = F.col("new").withField("valid_from", start)
    begun = begun.withField("scd_id", scd_id(F.col(f"new.{key}"), start))
    joined = joined.withColumn("new", F.when(is_new & F.col("_closed").isNotNull(), begun).otherwise(F.col("new")))
    return joined.select(F.explode(rows).alias("row")).select("row.*")


def snapshot(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    updated_at: str,
    as_of: dt.datetime,
    invalidate_deletes: bool = True,
) -> DataFrame:
    """The whole history after a run; closed versions pass through untouched."""
    if history is None:
        return open_history(source, key, updated_at)
    current = snapshot_changes(
        history, source, key, updated_at, as_of, invalidate_deletes, keep_unchanged=True
    )
    return current.unionByName(history.filter("valid_to IS NOT NULL").select(*current.columns))


def _longest_timeline(versions: DataFrame, *by: str | Column) -> int:
    """Rows of the largest group: a count over slim columns, combined map-side."""
    return versions.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def _whole_timelines(versions: DataFrame, key: str, time: str, alias: str) -> DataFrame:
    timeline = Window.partitionBy(key).orderBy(time)
    return versions.withColumn(alias, F.lead(time).over(timeline))


def next_time(
    versions: DataFrame,
    key: str,
    time: str,
    alias: str,
    max_timeline: int = MAX_TIMELINE,
    units: Sequence[str] = TIME_UNITS,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Add the next later ``time`` of the same key; (key, time) must be unique.

    A key's timeline is ordered in one task while it is short. Once any key
    exceeds ``max_timeline`` rows, timelines are cut at the coarsest calendar
    unit whose pieces fit: a piece finds its successors alone, and only its last
    row looks up the start of the key's next piece, found the same way among the
    far fewer starts. A second holds at most a million distinct microseconds, so
    a piece always fits the default. ``measured`` may give the (key, time) pairs
    more cheaply than ``versions`` does.
    """
    pairs = versions.select(key, time) if measured is None else measured
    if not units or _longest_timeline(pairs, key) <= max_timeline:
        return _whole_timelines(versions, key, time, alias)

    def piece(unit: str) -> Column:
        return F.date_trunc(unit, F.col(time))

    fitting = (u for u in units if _longest_timeline(pairs, key, piece(u)) <= max_timeline)
    unit = next(fitting, units[-1])
    # Column names carry the unit: the starts are cut again at a coarser one.
    part, start, following, inside = (f"_{n}_{unit}" for n in ("piece", "start", "next", "inside"))
    cut = versions.withColumn(part, piece(unit))
    starts = cut.groupBy(key, part).agg(F.min(time).alias(start))
    coarser = units[: units.index(unit)]
    linked = next_time(starts, key, start, following, max_timeline, coarser)
    its_key, its_part = f"_key_{unit}", f"_of_{unit}"
    linked = linked.select(F.col(key).alias(its_key), F.col(part).alias(its_part), following)
    # NULL keys and times have pieces of their own.
    same = F.col(key).eqNullSafe(F.col(its_key)) & F.col(part).eqNullSafe(F.col(its_part))
    within = Window.partitionBy(key, part).orderBy(time)
    return (
        cut.withColumn(inside, F.lead(time).over(within))
        .join(linked, same, "left")
        .withColumn(alias, F.coalesce(inside, following))
        .drop(part, inside, following, its_key, its_part)
    )


def history_from_versions(
    versions: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    tie_break: Sequence[str] = (),
    max_timeline: int = MAX_TIMELINE,
) -> DataFrame:
    """History of a change feed with many versions per key, built in one pass.

    Equals one snapshot run per version. Repeats of a (key, time) collapse to
    one, the greatest ``tie_break`` columns winning.
    """
    columns = versions.columns
    order = list(tie_break) or [c for c in columns if c not in (key, updated_at)]

    def single(rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, [key, updated_at], order or [updated_at])

    # Sizes are taken from the slim pairs: first as they come, then without repeats.
    pairs = versions.select(key, updated_at)
    if _longest_timeline(pairs, key) <= max_timeline:
        # One shuffle on the key, and one sort, serve both windows.
        timed = _whole_timelines(single(versions.repartition(key)), key, updated_at, "_valid_to")
    else:
        pairs = pairs.distinct()
        timed = next_time(
            single(versions), key, updated_at, "_valid_to", max_timeline, measured=pairs
        )
    return timed.select(*columns, *_version(key, updated_at, F.col("_valid_to")))


def first_times(versions: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """Earliest version of each member in a batch."""
    return versions.groupBy(key).agg(F.min(updated_at).alias("_first"))


def _is_reached() -> Column:
    still_valid = F.col("valid_to").isNull() | (F.col("valid_to") > F.col("_first"))
    return F.coalesce(still_valid & F.col("_first").isNotNull(), F.lit(False))


def reached(history: DataFrame, firsts: DataFrame, key: str) -> DataFrame:
    """History rows still valid after their member's first new version.

    For a feed in order these are the open rows alone.
    """
    return history.join(firsts, key).filter(_is_reached()).drop("_first")


def add_versions(
    history: DataFrame,
    versions: DataFrame,
    key: str,
    updated_at: str = "updated_at",
    tie_break: Sequence[str] = (),
    max_timeline: int = MAX_TIMELINE,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """History extended by a batch of versions, which may hold several per key, in any order.

    A late version takes its place inside the timeline, so any split of a feed
    into batches leads to the same history. Only rows the batch reaches are
    linked anew. No deletes: a batch is a delta. ``firsts`` may give the batch's
    :func:`first_times`.
    """
    firsts = first_times(versions, key, updated_at) if firsts is None else firsts
    marked = history.join(firsts, key, "left").withColumn("_reached", _is_reached())
    known = marked.filter("_reached").select(*versions.columns)
    woven = history_from_versions(
        known.unionByName(versions), key, updated_at, tie_break, max_timeline
    )
    return woven.unionByName(marked.filter("NOT _reached").select(*woven.columns))


def version_change(key: str, updated_at: str, tie_break: Sequence[str] = ()) -> Change:
    """:func:`add_versions` as a change of a stored history clustered by ``valid_to``.

    Periods that ended before the batch's first version hold nothing it reaches.
    """
    return Change(
        columns=[key, "valid_to"],
        since="_first",
        marks=lambda fresh: first_times(fresh, key, updated_at),
        hits=lambda stored, firsts: reached(stored, firsts, key),
        combine=lambda stored, fresh, firsts: add_versions(
            stored, fresh, key, updated_at, tie_break, firsts=firsts
        ),
        first=lambda fresh: history_from_versions(fresh, key, updated_at, tie_break),
    )
