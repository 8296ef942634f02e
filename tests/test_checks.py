"""Data checks."""

import time

import pytest
from pyspark.sql import functions as F

from stockroom import catalog
from stockroom.operators import checks
from stockroom.operators.checks import Check, ChecksFailed
from stockroom.plans.suite import CHECKS
from stockroom.session import SHUFFLE_CLEANUP

from .conftest import rows


def failures(df):
    return {(r["column"], r["test"]): r["failures"] for r in df.collect()}


def test_suite_has_the_expected_tests():
    kinds = [c.test for c in CHECKS]
    assert len(CHECKS) == 61 and len(set(CHECKS)) == 61
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 40, "unique": 19, "relationships": 1, "accepted_values": 1,
    }


def test_not_null_counts_rows(frame):
    df = frame([(None, 1), (None, None), ("a", 2)], "x string, y int")
    assert failures(checks.not_null(df, ["x", "y"])) == {("x", "not_null"): 2, ("y", "not_null"): 1}
    assert failures(checks.not_null(frame([], "x string"), ["x"])) == {("x", "not_null"): 0}


def test_unique_counts_values_and_ignores_null(frame):
    df = frame([("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,)], "x string")
    assert failures(checks.unique(df, "x")) == {("x", "unique"): 2}


def test_accepted_values_pass_null(frame):
    df = frame([("paid",), ("returned",), ("returned",), (None,)], "status string")
    got = checks.accepted_values(df, "status", ["paid"])
    assert failures(got) == {("status", "accepted_values"): 1}


def test_relationships_count_child_rows(frame):
    child = frame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = frame([("a",), ("a",), ("b",)], "id string")
    assert failures(checks.relationships(child, "k", parent, "id")) == {("k", "relationships"): 2}
    assert failures(checks.relationships(parent, "id", parent, "id")) == {("id", "relationships"): 0}


def test_report_and_gate(spark, frame):
    tables = {
        "child": frame([("a", "s1"), ("a", None), ("b", "s9")], "k string, s string"),
        "parent": frame([("s1",)], "s string"),
    }
    suite = [
        Check("child", "k", "not_null"),
        Check("child", "k", "unique"),
        Check("child", "s", "not_null"),
        Check("child", "s", "relationships", parent="parent", parent_column="s"),
        Check("child", "k", "accepted_values", values=("a", "b")),
    ]
    report = checks.collect_report(spark, checks.run_checks(tables, suite))
    assert rows(report) == [
        ("child", "k", "accepted_values", 0, "pass"),
        ("child", "k", "not_null", 0, "pass"),
        ("child", "k", "unique", 1, "fail"),
        ("child", "s", "not_null", 1, "fail"),
        ("child", "s", "relationships", 1, "fail"),
    ]
    with pytest.raises(ChecksFailed, match="child.k unique: 1"):
        checks.raise_on_failure(report)
    checks.raise_on_failure(report.filter("status = 'pass'"))
    failing = {c.test: rows(checks.failing_rows(tables, c)) for c in suite[1:4]}
    assert failing == {"unique": [("a", 2)], "not_null": [("a", None)], "relationships": [("s9", 1)]}


def test_unknown_test_is_an_error(frame):
    with pytest.raises(ValueError, match="unknown test"):
        checks.run_checks({"t": frame([(1,)], "x int")}, [Check("t", "x", "positive")])


def test_empty_tables_fail_the_gate(frame):
    full, empty = frame([(1,)], "x int"), frame([], "x int")
    assert checks.require_rows({"a": full}) == {"a": 1}
    with pytest.raises(ChecksFailed, match="no rows in: b, c"):
        checks.require_rows({"a": full, "b": empty, "c": empty})


def test_texts_without_repeats_are_settled_by_hash(spark, frame, capfd):
    """Distinct texts are not grouped by their values; repeated ones and NULLs are counted exactly."""
    ids = [(f"{i:032x}" if i else None, f"{i % 7:032x}", i) for i in range(20)]
    tables = {"t": frame(ids, "a string, b string, n int")}
    suite = [Check("t", c, test) for c in ("a", "b", "n") for test in ("not_null", "unique")]
    report = checks.run_checks(tables, suite)
    assert failures(report) == {
        ("a", "not_null"): 1, ("a", "unique"): 0, ("b", "not_null"): 0, ("b", "unique"): 7,
        ("n", "not_null"): 0, ("n", "unique"): 0,
    }
    one = checks.run_checks(tables, suite[:2])
    one.explain()
    assert "Aggregate" not in capfd.readouterr().out and failures(one)["a", "not_null"] == 1
    assert failures(checks.run_checks({"t": frame([], "a string")}, suite[:2])) == {
        ("a", "not_null"): 0, ("a", "unique"): 0,
    }


def test_repeated_texts_are_counted_among_their_hash_group(frame, monkeypatch):
    """A repeated text, or two texts of one hash, send their groups alone to the count of values."""
    ids = [(f"k{i}",) for i in range(3000)] + [("k7",), ("k7",), ("k9",), (None,), (None,)]
    tables = {"t": frame(ids, "a string")}
    suite = [Check("t", "a", test) for test in ("not_null", "unique")]
    want = {("a", "not_null"): 2, ("a", "unique"): 2}
    nulls, groups = checks._hashed(tables, [("t", "a")])["t", "a"]
    assert nulls == 2 and len(set(groups)) == 2
    assert 2 <= checks._of_groups(tables["t"], "a", groups).distinct().count() < 30
    assert failures(checks.run_checks(tables, suite)) == want
    # Hashes that always meet prove nothing, so the values decide.
    monkeypatch.setattr(checks, "_hash_parts", lambda value: (F.when(value.isNotNull(), 1), F.when(value.isNotNull(), 2)))
    assert failures(checks.run_checks(tables, suite)) == want


def test_a_unique_text_moves_few_bytes(spark):
    """Texts cross the shuffle in half the bytes that a row for each hash took."""
    n = 800_000
    df = spark.range(0, n, 1, 2).selectExpr("sha2(string(id), 512) a")
    suite = [Check("t", "a", test) for test in ("not_null", "unique")]
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        files = (found.apply(i) for i in range(found.size()))
        return {f.getName(): f.length() for f in files if f.getName().endswith(".data")}

    before = shuffled()
    assert failures(checks.run_checks({"t": df}, suite)) == {("a", "not_null"): 0, ("a", "unique"): 0}
    assert 0 < sum(size for name, size in shuffled().items() if name not in before) < 7 * n


ORDER_TABLES = {
    "region": "SELECT 0 r_regionkey, 'EUROPE' r_name",
    "nation": "SELECT 0 n_nationkey, 'FRANCE' n_name, 0 n_regionkey",
    "customer": "SELECT id c_custkey, concat('Customer#', id) c_name, 0 c_nationkey, 1.5D c_acctbal, 'B' c_mktsegment "
    "FROM range(40)",
    "supplier": "SELECT id s_suppkey, concat('Supplier#', id) s_name, 0 s_nationkey, 1.5D s_acctbal FROM range(5)",
    "part": "SELECT id p_partkey, 'bolt' p_name, 'Brand#1' p_brand, 'LARGE' p_type, 1 p_size, 9.5D p_retailprice "
    "FROM range(30)",
    "orders": "SELECT id o_orderkey, id % 40 o_custkey, 'F' o_orderstatus, 20.5D o_totalprice, "
    "timestamp_ntz '1998-02-06 00:00:00' o_orderdate, '5-LOW' o_orderpriority FROM range(200)",
    "lineitem": "SELECT id % 200 l_orderkey, id % 30 l_partkey, id % 5 l_suppkey, int(id / 200) l_linenumber, "
    "2.0D l_quantity, 19.0D l_extendedprice, 0.05D l_discount, timestamp_ntz '1998-03-01 00:00:00' l_shipdate "
    "FROM range(800)",
    "events": "SELECT id event_id, timestamp_ntz '2024-01-01 00:00:11' ts, id % 30 user_id, 'signup' event_type, "
    "3.5D value, '{}' props FROM range(60)",
}


def test_a_report_leaves_no_shuffle_files(spark, tmp_path):
    """The shuffles of each step leave the disk when it ends, not when the driver collects garbage."""
    for name, sql in ORDER_TABLES.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = disk.getAllBlocks()
        names = (blocks.apply(i).name() for i in range(blocks.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    report = catalog.queries()["dq_report"](spark, str(tmp_path))
    assert len(report.collect()) == 61
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"  # as it was
    until = time.monotonic() + 20
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
