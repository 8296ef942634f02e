"""Coercion, naming, keys, day differences."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.functions.coerce import (
    coerce,
    coerce_bool,
    coerce_decimal,
    coerce_int,
    coerce_quantity,
    coerce_ts,
)
from stockroom.functions.naming import snake_case, snake_case_columns
from stockroom.functions.scalars import (
    full_name,
    pack_id,
    pack_key,
    surrogate_key,
    timestamp_text,
    unpack_id,
    unpack_key,
    whole_days,
)


def column(frame, values, kind, rule):
    df = frame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()]


def test_text_booleans(frame):
    values = ["True", "false", "yes", "1", "TRUE", "", None]
    assert column(frame, values, "string", coerce_bool) == [True, False, False, False, True, False, None]
    assert column(frame, [True, False, None], "boolean", coerce_bool) == [True, False, None]


def test_decimals(frame):
    values = ["3.7", " 3.7 ", "abc", "", "3d", None, "1_000", "1__0", "_1", "+.5", "5.", "-2e3", "0x1"]
    want = [3.7, 3.7, None, None, None, None, 1000.0, None, None, 0.5, 5.0, -2000.0, None]
    assert column(frame, values, "string", coerce_decimal) == want
    assert column(frame, ["inf", "-Infinity"], "string", coerce_decimal) == [float("inf"), -float("inf")]
    assert str(column(frame, ["NaN"], "string", coerce_decimal)[0]) == "nan"
    assert column(frame, [2, None], "int", coerce_decimal) == [2.0, None]


def test_quantity_goes_through_a_decimal(frame):
    values = ["3.7", "x", "inf", "-3.7", "12", None, "nan"]
    assert column(frame, values, "string", coerce_quantity) == [3, None, None, -3, 12, None, None]
    assert column(frame, [3.7, float("inf")], "double", coerce_quantity) == [3, None]


def test_integers(frame):
    assert column(frame, ["3.7", "3", " +4 ", "x", "1_0"], "string", coerce_int) == [None, 3, 4, None, 10]
    assert column(frame, [3.7, -3.7, float("nan")], "double", coerce_int) == [3, -3, None]
    assert column(frame, [2**40], "bigint", coerce_int) == [2**40]


def test_timestamps_are_lenient_and_zoned(frame):
    values = ["2024-01-01T10:00:00+01:00", "2024-01-01 09:30:00", "soon", None]
    got = column(frame, values, "string", lambda c: timestamp_text(coerce_ts(c)))
    assert got == ["2024-01-01 09:00:00.000000", "2024-01-01 09:30:00.000000", None, None]


def test_coerce_touches_known_columns_only(frame):
    df = coerce(frame([("true", "1.5", "7.9", "x")], "is_deleted string, unit_price string, quantity string, other string"))
    assert tuple(df.first()) == (True, 1.5, 7, "x")


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("updatedAt", "updated_at"),
        ("updated_at", "updated_at"),
        ("_lake_id", "_lake_id"),
        ("APIKey", "api_key"),
        ("Full Name", "full_name"),
        ("address1Line", "address1_line"),
        ("2ndItem", "_2_nd_item"),
    ],
)
def test_snake_case(name, want):
    assert snake_case(name) == want


def test_both_spellings_merge_camel_first(frame):
    df = frame([("a", "b"), ("", "b"), (None, "b"), ("a", None)], "updated_at string, updatedAt string")
    # updatedAt wins when it holds something.
    assert [r[0] for r in snake_case_columns(df).collect()] == ["b", "b", "b", "a"]
    df = frame([("", "b")], "updatedAt string, updated_at string")
    assert snake_case_columns(df).columns == ["updated_at"]
    assert snake_case_columns(df).first()[0] == "b"


def test_full_name_is_null_when_a_part_is(frame):
    df = frame([("a", "b"), ("a", None), (None, "b")], "f string, l string")
    assert [r[0] for r in df.select(full_name(F.col("f"), F.col("l"))).collect()] == ["a b", None, None]


def test_whole_days_cut_toward_zero(frame):
    start = dt.datetime(2024, 1, 10)
    ends = [start + dt.timedelta(hours=h) for h in (37, -37, 23, 24, -24)] + [None]
    df = frame([(start, e) for e in ends], "s timestamp, e timestamp")
    got = [r[0] for r in df.select(whole_days(F.col("s"), F.col("e"))).collect()]
    assert got == [1, -1, 0, 1, -1, None]


def test_surrogate_keys_tell_null_from_empty(frame):
    df = frame([("a", None), ("a", ""), (None, "a"), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert keys[0] == keys[3] and len(set(keys)) == 3
    assert all(len(k) == 32 for k in keys)


def test_surrogate_key_text_is_stable(frame):
    import hashlib

    df = frame([(7, dt.datetime(2024, 1, 2, 3, 4, 5))], "x bigint, t timestamp")
    key = df.select(surrogate_key(F.col("x"), timestamp_text(F.col("t")))).first()[0]
    assert key == hashlib.md5(b"7-2024-01-02 03:04:05.000000").hexdigest()


def test_packed_keys_come_back(frame):
    texts = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "0123456789abcdef" * 2 + "\n", "", "k", "\u00e9" * 8, "a" * 16, "\0" * 40, None]
    df = frame([(t,) for t in texts], "k string")
    packed = df.select("k", pack_key(F.col("k")).alias("p"))
    got = packed.select("k", unpack_key(F.col("p")).alias("back"), F.octet_length("p").alias("n")).collect()
    assert [r["back"] for r in got] == texts and got[0]["n"] == 16


def test_packed_ids_come_back(frame):
    """Ids of digits and hyphens take half a byte a character, and any other text comes back as it was."""
    ids = ["1234567-3-123456-12345-1996-09-13", "0", "-", "00", "-1", "7-7"]
    others = ["", "A", "F", "FF1", "ab-1", "1 2", "12\n", "1\x002", "\x00", "\u0661\u0662", "é-1", "1_2", None]
    packed = frame([(t,) for t in ids + others], "t string").select("t", pack_id(F.col("t")).alias("p"))
    got = packed.select("t", unpack_id(F.col("p")).alias("back"), F.octet_length("p").alias("n")).collect()
    assert [r["back"] for r in got] == ids + others
    assert [r["n"] for r in got[: len(ids)]] == [len(t) // 2 + 1 for t in ids]
    assert packed.select("p").distinct().count() == len(ids + others)
