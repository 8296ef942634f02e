"""Latest rows, upserts, keyed tables, bounds."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from stockroom.operators import keyed
from stockroom.operators.bounds import (
    bound_literal,
    get_bound,
    newer_than,
    next_bound,
    table_bound,
)
from stockroom.operators.keyed import PERIOD, KeyedTable, Period, upsert
from stockroom.operators.latest import latest_by_key
from stockroom.operators.lookups import fits_broadcast

from .conftest import at, rows

DDL = "k string, v int, updated_at timestamp"


def test_latest_wins_in_any_order(frame):
    for order in ([1, 2], [2, 1]):
        df = frame([("a", i, at(i)) for i in order], DDL)
        assert rows(latest_by_key(df, ["k"], ["updated_at"]), "k", "v") == [("a", 2)]


def test_latest_ties_fall_to_the_next_column_and_null_is_lowest(frame):
    df = frame([("a", 1, at(1)), ("a", 9, at(1)), ("b", 1, None), ("b", 0, at(1))], DDL)
    assert rows(latest_by_key(df, ["k"], ["updated_at", "v"]), "k", "v") == [("a", 9), ("b", 0)]


def test_latest_reduces_before_the_shuffle(frame):
    plan = latest_by_key(frame([("a", 1, at(1))], DDL), ["k"], ["updated_at"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in text and text.index("Exchange") < text.index("Partial")


def test_upsert_is_idempotent(frame):
    one = frame([("a", 1, at(1)), ("b", 1, at(1))], DDL)
    two = frame([("b", 2, at(2)), ("c", 2, at(2))], DDL)
    first = upsert(None, one, ["k"], ["updated_at"])
    second = upsert(first, two, ["k"], ["updated_at"])
    third = upsert(second, two, ["k"], ["updated_at"])
    want = [("a", 1), ("b", 2), ("c", 2)]
    assert rows(second, "k", "v") == want
    assert rows(third, "k", "v") == want


def test_later_batch_wins_unless_newest_is_kept(frame):
    stored = frame([("a", 1, at(5))], DDL)
    stale = frame([("a", 2, at(1))], DDL)
    assert rows(upsert(stored, stale, ["k"], ["updated_at"]), "v") == [(2,)]
    assert rows(upsert(stored, stale, ["k"], ["updated_at"], keep_newest=True), "v") == [(1,)]


def test_rows_are_replaced_whole_and_columns_evolve(frame):
    stored = frame([("a", 1, 2), ("b", 1, 2)], "k string, x int, y int")
    fresh = frame([("a", 3, 9)], "k string, x int, z int")
    got = upsert(stored, fresh, ["k"], ["x"])
    assert rows(got, "k", "x", "y", "z") == [("a", 3, None, 9), ("b", 1, 2, None)]


def test_type_change_is_refused(frame):
    with pytest.raises(ValueError, match="change type"):
        upsert(frame([("a", 1)], "k string, x int"), frame([("a", "1")], "k string, x string"), ["k"], ["x"])


def table(spark, tmp_path, **options):
    return KeyedTable(spark, str(tmp_path / "t"), ["k"], ["updated_at"], Period("updated_at"), **options)


def files(tmp_path):
    """Data files of a table by period."""
    found = {}
    for f in (tmp_path / "t").glob(f"{PERIOD}=*/*.parquet"):
        found.setdefault(f.parent.name.split("=")[1], set()).add(f.name)
    return found


def test_table_before_and_after_merges(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    assert t.read() is None and not t.exists()
    assert t.merge(frame([], DDL), "empty") is False
    assert t.read() is None
    assert t.merge(frame([("a", 1, at(1)), ("b", 1, at(1))], DDL), "one") is True
    assert t.merge(frame([("b", 2, at(2)), ("c", 2, at(2))], DDL), "two") is True
    assert rows(t.read(), "k", "v") == [("a", 1), ("b", 2), ("c", 2)]
    assert t.read().columns == ["k", "v", "updated_at"]
    assert not (tmp_path / "t" / "_staging").exists()


def test_last_batch_is_not_applied_again(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([("a", 1, at(1))], DDL), "one")
    t.merge(frame([("a", 2, at(2))], DDL), "two")
    assert t.merge(frame([("a", 3, at(3))], DDL), "two") is False
    assert rows(t.read(), "v") == [(2,)]


def test_a_batch_of_one_day_rewrites_that_day(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([(f"{d}-{i}", 0, at(d)) for d in range(1, 6) for i in range(20)], DDL), "one")
    before = files(tmp_path)
    assert sorted(before) == [f"2024-01-0{d}" for d in range(1, 6)]
    t.merge(frame([("new", 1, at(5)), ("5-3", 7, at(5, 9))], DDL), "day five")
    after = files(tmp_path)
    assert {d for d in before if before[d] != after[d]} == {"2024-01-05"}
    t.merge(frame([("next", 1, at(6))], DDL), "day six")  # a new day adds one period
    assert {d: f for d, f in files(tmp_path).items() if d != "2024-01-06"} == after
    t.merge(frame([("2-0", 9, at(6))], DDL), "moved")  # leaves day two for day six
    last = files(tmp_path)
    assert {d for d in last if last[d] != after.get(d)} == {"2024-01-02", "2024-01-06"}
    assert t.read().count() == 102 and rows(t.read().filter("k in ('2-0', '5-3')"), "v") == [(7,), (9,)]


def test_an_emptied_period_goes(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([("a", 1, at(1)), ("n", 1, None)], DDL), "one")
    t.merge(frame([("a", 2, at(9)), ("n", 2, at(9))], DDL), "two")
    assert list(files(tmp_path)) == ["2024-01-09"]
    assert rows(t.read(), "k", "v") == [("a", 2), ("n", 2)]


@pytest.mark.parametrize("broken", ["before", "between", "after"])
def test_a_merge_that_broke_off_is_completed(spark, frame, tmp_path, monkeypatch, broken):
    """The driver is lost before, while or after the periods are replaced."""
    t = table(spark, tmp_path)
    t.merge(frame([("a", 1, at(1)), ("b", 1, at(2)), ("c", 1, at(3))], DDL), "one")

    class Lost(Exception):
        pass

    def lost(*_):
        raise Lost

    whole, calls = KeyedTable.finish, []

    def finish(self):
        calls.append(1)
        if len(calls) == 1 or broken != "before":
            return whole(self)
        raise Lost

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, "finish", finish)
        if broken != "before":
            patch.setattr(keyed, "remove", lost)
        with pytest.raises(Lost):
            # One period is emptied, one replaced, one added.
            t.merge(frame([("a", 2, at(2)), ("d", 2, at(4))], DDL), "two")
    if broken == "between":  # some periods were taken away, but not replaced yet
        shutil.rmtree(tmp_path / "t" / f"{PERIOD}=2024-01-02")
    again = table(spark, tmp_path)
    want = [("a", 2), ("b", 1), ("c", 1), ("d", 2)]
    assert again.merge(frame([("e", 3, at(4))], DDL), "three") is True
    assert rows(again.read(), "k", "v") == [*want, ("e", 3)]
    again.finish()  # nothing is left to do
    assert again.read().count() == 5


def test_staged_files_are_invisible(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([("a", 1, at(1))], DDL), "one")
    t._write(frame([("a", 99, at(9)), ("z", 99, at(9))], DDL), "overwrite")  # a crash before anything is ready
    assert rows(t.read(), "k", "v") == [("a", 1)]
    t.merge(frame([("a", 2, at(2))], DDL), "two")
    assert rows(t.read(), "k", "v") == [("a", 2)]


def test_a_stored_row_stays_only_where_it_is_newer(spark, frame, tmp_path):
    t = table(spark, tmp_path, newer="updated_at")
    t.merge(frame([("late", 1, at(5)), ("tie", 1, at(5)), ("old", 1, at(5)), ("timeless", 1, None), ("timed", 1, at(5))], DDL), "one")
    t.merge(frame([("late", 2, at(4)), ("tie", 2, at(5)), ("old", 2, at(6)), ("timeless", 2, at(1)), ("timed", 2, None), ("new", 2, at(1))], DDL), "two")
    assert rows(t.read(), "k", "v") == [("late", 1), ("new", 2), ("old", 2), ("tie", 2), ("timed", 2), ("timeless", 2)]


def test_times_beyond_the_calendar(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    far = frame([("far", 1), ("none", 1)], "k string, v int").withColumn(
        "updated_at", F.expr("CASE WHEN k = 'far' THEN timestamp_micros(400000000000000000) END")
    )
    t.merge(far, "one")
    t.merge(frame([("a", 1, at(1))], DDL), "two")
    assert t.read().count() == 3
    assert t.read(t.since(bound_literal(at(1)))).count() == 3  # kept in the period without a time


def test_merge_reads_key_columns_to_find_its_periods(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([("a", 1, at(1))], DDL), "one")
    stored = t._rows(t._state())
    plan = stored.select("k", PERIOD).join(frame([("a",)], "k string"), "k", "left_semi")
    assert "ReadSchema: struct<k:string>" in plan._jdf.queryExecution().executedPlan().treeString()


def test_a_bound_opens_no_earlier_period(spark, frame, tmp_path):
    t = table(spark, tmp_path)
    t.merge(frame([(str(d), d, at(d)) for d in range(1, 9)] + [("none", 0, None)], DDL), "one")
    late = t.read(t.since(bound_literal(at(7, 5))))
    assert {f.split(f"{PERIOD}=")[1].split("/")[0] for f in late.inputFiles()} >= {"2024-01-07"}
    assert rows(late, "k") == [("7",), ("8",), ("none",)]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and PERIOD in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_table_schema_evolves_over_untouched_periods(spark, frame, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["k"], Period("t"))
    first = [(str(i), i, at(1 + i % 5)) for i in range(50)]
    t.merge(frame(first, "k string, x int, t timestamp"), "one")
    t.merge(frame([("7", 1, at(3)), ("new", 2, at(3))], "k string, z int, t timestamp"), "two")
    got = t.read()
    assert got.columns == ["k", "x", "t", "z"] and got.count() == 51
    assert rows(got.filter("k in ('7', '8', 'new')"), "k", "x", "z") == [
        ("7", None, 1), ("8", 8, None), ("new", None, 2),
    ]


def test_any_split_of_a_feed_gives_the_same_table(spark, frame, tmp_path):
    rng = random.Random(5)
    feed = [(rng.choice("abcdefgh"), i, at(1) + dt.timedelta(minutes=i)) for i in range(40)]
    want = rows(latest_by_key(frame(feed, DDL), ["k"], ["updated_at"]))
    for n in range(2):
        rng.shuffle(feed)
        cut = sorted(rng.sample(range(1, 40), 2))
        t = KeyedTable(
            spark, str(tmp_path / str(n)), ["k"], ["updated_at"], Period("updated_at"), keep_newest=True
        )
        for i, (lo, hi) in enumerate(zip([0, *cut], [*cut, 40], strict=True)):
            t.merge(frame(feed[lo:hi], DDL), f"b{i}")
        assert rows(t.read()) == want


def test_next_bound_compares_instants(frame):
    df = frame(
        [("2024-01-01T10:00:00+01:00", None), ("", "2024-01-01T09:30:00+00:00"), (None, "")],
        "updatedAt string, updated_at string",
    )
    bound = df.agg(F.date_format(next_bound(["updatedAt", "updated_at"]), "HH:mm").alias("b"))
    assert bound.first()["b"] == "09:30"


def test_bound_of_absent_empty_and_timeless_tables(frame):
    assert table_bound(None) is None
    assert table_bound(frame([], DDL)) is None
    assert table_bound(frame([("a", 1, None)], DDL)) is None
    assert table_bound(frame([("a", 1, at(3)), ("b", 1, None)], DDL)) == at(3)


def test_bound_is_strict_and_lookback_widens_it(frame):
    df = frame([("9", 0, at(9)), ("10", 0, at(10)), ("11", 0, at(11)), ("null", 0, None)], DDL)
    day = dt.timedelta(days=1)
    assert rows(newer_than(df, "updated_at", at(10)), "k") == [("11",)]
    assert rows(newer_than(df, "updated_at", at(10), day), "k") == [("10",), ("11",)]
    assert rows(newer_than(df, "updated_at", at(10), 2 * day), "k") == [("10",), ("11",), ("9",)]
    assert newer_than(df, "updated_at", None).count() == 4


def test_bound_reaches_the_parquet_scan(spark, frame, tmp_path):
    t = table(spark, tmp_path, sort_by=["updated_at"])
    t.merge(frame([("a", 1, at(1))], DDL), "one")
    plan = newer_than(t.read(), "updated_at", at(1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan


def test_stored_bound_by_entity(frame):
    state = frame([("orders", at(4), at(5))], "entity string, last_updated_at timestamp, last_run_at timestamp")
    assert get_bound(state, "orders") == at(4)
    assert get_bound(state, "stores") is None
    assert get_bound(None, "orders") is None


def test_bound_literal_normalises_zones(spark):
    zone = dt.timezone(dt.timedelta(hours=2))
    value = bound_literal(dt.datetime(2024, 1, 1, 2, tzinfo=zone))
    text = spark.range(1).select(F.date_format(value, "yyyy-MM-dd HH:mm")).first()[0]
    assert text == "2024-01-01 00:00"


def test_broadcast_needs_a_measured_size(spark):
    sides = {"small": spark.range(10), "large": spark.range(11)}
    assert fits_broadcast(sides, max_rows=10) == {"small": True, "large": False}
    assert fits_broadcast({}) == {}
