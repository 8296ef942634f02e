"""Versioned history: runs, bulk builds, late versions, hot keys."""

import datetime as dt
import random
from pathlib import Path

import pytest

from stockroom.operators import scd2
from stockroom.operators.keyed import PERIOD
from stockroom.plans.pipeline import run_snapshot, snap_table

from .conftest import at, rows

DDL = "k string, v string, updated_at timestamp"
SHOWN = ("k", "v", "valid_from", "valid_to")


def run(history, source, day):
    return scd2.snapshot(history, source, "k", "updated_at", at(day))


def test_five_runs(frame):
    h = run(None, frame([("k", "a", at(1))], DDL), 1)
    assert rows(h, *SHOWN) == [("k", "a", at(1), None)]
    h = run(h, frame([("k", "b", at(2))], DDL), 2)
    assert rows(h, *SHOWN) == [("k", "a", at(1), at(2)), ("k", "b", at(2), None)]
    h = run(h, frame([("k", "changed", at(2))], DDL), 3)  # equal time: ignored
    assert rows(h, *SHOWN) == [("k", "a", at(1), at(2)), ("k", "b", at(2), None)]
    h = run(h, frame([], DDL), 4)
    assert rows(h, *SHOWN) == [("k", "a", at(1), at(2)), ("k", "b", at(2), at(4))]
    h = run(h, frame([("k", "c", at(6))], DDL), 6)
    assert rows(h, *SHOWN) == [
        ("k", "a", at(1), at(2)), ("k", "b", at(2), at(4)), ("k", "c", at(6), None),
    ]
    assert h.select("scd_id").distinct().count() == 3


def test_older_source_time_is_ignored(frame):
    h = run(None, frame([("k", "a", at(5))], DDL), 5)
    h = run(h, frame([("k", "old", at(4))], DDL), 6)
    assert rows(h, *SHOWN) == [("k", "a", at(5), None)]


def test_deletes_can_be_left_open(frame):
    h = run(None, frame([("k", "a", at(1))], DDL), 1)
    h = scd2.snapshot(h, frame([], DDL), "k", "updated_at", at(2), invalidate_deletes=False)
    assert rows(h, *SHOWN) == [("k", "a", at(1), None)]


def test_stored_history_equals_the_pure_one(spark, frame, tmp_path):
    sources = [
        [("x", "1", at(1)), ("y", "1", at(1))],
        [("x", "2", at(2)), ("z", "1", at(2))],
        [("x", "2", at(2)), ("y", "5", at(3)), ("z", "2", at(3))],
        [("y", "5", at(3)), ("z", "3", at(4))],
    ]
    table = snap_table(spark, str(tmp_path / "h"))
    pure = None
    for day, source in enumerate(sources, start=1):
        df = frame(source, DDL)
        pure = run(pure, df, day)
        stored = run_snapshot(table, df, "k", at(day), f"run-{day}")
        assert rows(stored, *SHOWN) == rows(pure, *SHOWN)
        run_snapshot(table, df, "k", at(day), f"run-{day}")  # a repeated run changes nothing
        assert rows(table.read(), *SHOWN) == rows(pure, *SHOWN)


def feed(seed, keys="abc", n=60, hours=24 * 40):
    rng = random.Random(seed)
    moments = rng.sample(range(hours), n)
    start = dt.datetime(2023, 12, 20)
    return [(rng.choice(keys), str(i), start + dt.timedelta(hours=h)) for i, h in enumerate(moments)]


def test_bulk_equals_repeated_runs(frame):
    versions = feed(1, keys="ab", n=8)
    h = None
    state = {}
    for k, v, t in sorted(versions, key=lambda r: r[2]):
        state[k] = (k, v, t)
        h = run(h, frame(list(state.values()), DDL), 30)
        h = frame(h.collect(), h.schema)  # eight runs in one plan take minutes to optimize
    bulk = scd2.history_from_versions(frame(versions, DDL), "k")
    assert rows(bulk, *SHOWN) == rows(h, *SHOWN)


@pytest.mark.parametrize("limit", [1, 3, 20])
def test_cut_timelines_give_the_same_history(frame, limit):
    versions = feed(2) + [("hot", str(i), at(3) + dt.timedelta(seconds=7 * i)) for i in range(80)]
    df = frame(versions, DDL)
    whole = scd2.history_from_versions(df, "k")
    cut = scd2.history_from_versions(df, "k", max_timeline=limit)
    assert rows(cut, *SHOWN) == rows(whole, *SHOWN)


def test_hot_timelines_are_partitioned_by_piece(frame):
    versions = [("hot", str(i), at(1 + i // 8, i % 8)) for i in range(80)]
    plan = scd2.history_from_versions(frame(versions, DDL), "k", max_timeline=10)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in text


def test_repeats_of_a_version_collapse(frame):
    df = frame([("k", "a", at(1)), ("k", "a", at(1)), ("k", "b", at(1)), ("k", "c", at(2))], DDL)
    got = scd2.history_from_versions(df, "k")
    assert rows(got, *SHOWN) == [("k", "b", at(1), at(2)), ("k", "c", at(2), None)]


def test_intervals_tile_each_timeline(frame):
    got = rows(scd2.history_from_versions(frame(feed(3), DDL), "k"), "k", "valid_from", "valid_to")
    for key in "abc":
        spans = sorted((f, t) for k, f, t in got if k == key)
        assert [t for _, t in spans[:-1]] == [f for f, _ in spans[1:]]
        assert spans[-1][1] is None


def test_any_split_and_order_of_batches_gives_the_same_history(spark, frame, tmp_path):
    versions = feed(4)
    want = rows(scd2.history_from_versions(frame(versions, DDL), "k"), *SHOWN)
    rng = random.Random(9)
    rng.shuffle(versions)
    table = snap_table(spark, str(tmp_path / "h"), "day")
    for i in range(0, len(versions), 12):
        batch = frame(versions[i : i + 12], DDL)
        table.rewrite(batch, str(i), scd2.version_change("k", "updated_at"))
    assert rows(table.read(), *SHOWN) == want


def test_a_feed_in_order_reaches_open_rows_alone(frame):
    history = scd2.history_from_versions(frame(feed(6, keys="a"), DDL), "k")
    after = frame([("a", "new", dt.datetime(2025, 1, 1)), ("b", "x", at(1))], DDL)
    hit = scd2.reached(history, scd2.first_times(after, "k"), "k")
    assert rows(hit, "valid_to") == [(None,)]


def periods(table):
    """Data files of a history by period."""
    found = {}
    for f in Path(table.path).glob(f"{PERIOD}=*/*.parquet"):
        found.setdefault(f.parent.name.split("=")[1], set()).add(f.name)
    return found


def test_stored_history_keeps_periods_a_batch_does_not_reach(spark, frame, tmp_path):
    table = snap_table(spark, str(tmp_path / "h"), "day")
    change = scd2.version_change("k", "updated_at")
    for day in (1, 2, 3):
        table.rewrite(frame([("k", str(day), at(day))], DDL), f"b{day}", change)
    before = periods(table)
    assert sorted(before) == ["2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"]
    table.rewrite(frame([("other", "x", at(9))], DDL), "other", change)
    after = periods(table)
    assert {d for d in before if before[d] != after[d]} == {"__HIVE_DEFAULT_PARTITION__"}
    assert rows(table.read().filter("k = 'k'"), *SHOWN) == [
        ("k", "1", at(1), at(2)), ("k", "2", at(2), at(3)), ("k", "3", at(3), None),
    ]
    # A late version opens the periods from its own time on, and no earlier one.
    table.rewrite(frame([("k", "late", at(2, 12))], DDL), "late", change)
    assert periods(table)["2024-01-03"] != before["2024-01-03"]
    assert rows(table.read().filter("k = 'k'"), "v", "valid_to") == [
        ("1", at(2)), ("2", at(2, 12)), ("3", None), ("late", at(3)),
    ]


def test_a_run_rewrites_open_versions_and_the_periods_it_closes_in(spark, frame, tmp_path):
    table = snap_table(spark, str(tmp_path / "h"), "day")
    run_snapshot(table, frame([("a", "1", at(1)), ("b", "1", at(1))], DDL), "k", at(1), "r1")
    run_snapshot(table, frame([("a", "2", at(2)), ("b", "1", at(1))], DDL), "k", at(2), "r2")
    before = periods(table)
    run_snapshot(table, frame([("a", "2", at(2)), ("b", "2", at(3))], DDL), "k", at(3), "r3")
    after = periods(table)
    assert after["2024-01-02"] == before["2024-01-02"] and set(after) - set(before) == {"2024-01-03"}
    assert table.read().count() == 4


def test_closes_are_sought_for_unopened_members_alone(frame):
    """Closed versions are narrowed to the members a run has to open before they are grouped."""
    history = scd2.history_from_versions(frame(feed(6), DDL), "k")
    source = frame([("a", "new", dt.datetime(2025, 1, 1)), ("back", "x", at(1))], DDL)
    unopened = source.select("k").join(scd2.open_rows(history).select("k"), "k", "left_anti")
    changes = scd2.snapshot_changes(history, source, "k", "updated_at", at(9), unopened=unopened)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    grouped = next(i for i, line in enumerate(lines) if "Aggregate" in line and "_closed_key" in line)
    assert any("LeftSemi" in line for line in lines[grouped + 1 : grouped + 4])
    closed = frame([("a", at(2)), ("a", at(5)), ("b", at(3)), ("c", None)], "k string, valid_to timestamp")
    got = scd2.last_closes(closed.filter("valid_to IS NOT NULL"), "k", frame([("a",), ("c",), ("d",)], "m string"))
    assert rows(got) == [("a", at(5))]


def test_long_timelines_keep_null_keys_and_times(frame):
    rows_in = [(k, at(d)) for k in ("a", None) for d in range(1, 9)] + [("a", None), (None, None), ("b", None)]
    feed = frame(rows_in, "k string, updated_at timestamp")
    whole = scd2.history_from_versions(feed, "k")
    for limit in (1, 2, 5):
        cut = scd2.history_from_versions(feed, "k", max_timeline=limit)
        assert rows(cut, "k", "valid_from", "valid_to") == rows(whole, "k", "valid_from", "valid_to")


def test_a_member_back_at_its_old_time_opens_after_its_close(spark, frame, tmp_path):
    table = snap_table(spark, str(tmp_path / "h"))
    full, without = [("a", "x", at(1)), ("b", "y", at(1))], [("b", "y", at(1))]
    pure = None
    for day, source in ((2, full), (3, without), (5, full), (6, without), (7, full)):
        df = frame(source, "k string, v string, updated_at timestamp")
        pure = scd2.snapshot(pure, df, "k", "updated_at", at(day))
        run_snapshot(table, df, "k", at(day), f"r{day}")
    want = [(at(1), at(3)), (at(3), at(6)), (at(6), None)]
    for history in (pure, table.read()):
        assert rows(history.filter("k = 'a'"), "valid_from", "valid_to") == want
        assert history.select("scd_id").distinct().count() == history.count() == 4
