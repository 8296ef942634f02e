"""Declarative data checks. Each one is a DataFrame of failures; a suite is one report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: layout of a suite report.
REPORT_SCHEMA = "model string, column string, test string, failures bigint, status string"

# Texts are counted in so many groups of their hashes.
HASH_GROUPS = 1 << 14


@dataclass(frozen=True)
class Check:
    """One test of one column. ``values`` and ``parent`` belong to the kinds that need them."""

    model: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""


class ChecksFailed(Exception):
    """At least one check of a suite found failures."""


def _value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _duplicated(df: DataFrame, column: str) -> DataFrame:
    return _value_counts(df.filter(F.col(column).isNotNull()), column).filter("n > 1")


def _unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return _value_counts(df.filter(~F.col(column).isin(list(values))), column)


def _orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with their row counts.

    Counting first leaves one row per value to join, however often a value occurs.
    """
    counted = _value_counts(child.filter(F.col(column).isNotNull()), column)
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return counted.join(known, F.col(column) == F.col("_parent"), "left_anti")


def failing_rows(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    """What a check objects to: NULL rows, or offending values with their counts ``n``."""
    df = tables[check.model]
    if check.test == "not_null":
        return df.filter(F.col(check.column).isNull())
    if check.test == "unique":
        return _duplicated(df, check.column)
    if check.test == "accepted_values":
        return _unaccepted(df, check.column, check.values)
    if check.test == "relationships":
        return _orphans(df, check.column, tables[check.parent], check.parent_column)
    raise ValueError(f"unknown test: {check.test}")


def _result(model: str, column: str, test: str, failures: Column) -> list[Column]:
    return [
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        F.lit(test).alias("test"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    ]


def not_null(df: DataFrame, columns: Sequence[str], model: str = "") -> DataFrame:
    """NULL rows per column, all columns in a single pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)))
    results = F.array(
        *(F.struct(*_result(model, c, "not_null", F.col(f"_{i}"))) for i, c in enumerate(columns))
    )
    return counts.select(F.inline(results))


def unique(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """Number of values that occur more than once; NULLs do not count."""
    failures = _duplicated(df, column).agg(F.count(F.lit(1)).alias("n"))
    return failures.select(*_result(model, column, "unique", F.col("n")))


def accepted_values(
    df: DataFrame, column: str, values: Sequence[str], model: str = ""
) -> DataFrame:
    """Number of distinct values outside the list; NULL passes."""
    failures = _unaccepted(df, column, values).agg(F.count(F.lit(1)).alias("n"))
    return failures.select(*_result(model, column, "accepted_values", F.col("n")))


def relationships(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, model: str = ""
) -> DataFrame:
    """Number of child rows whose value no parent has; NULL passes."""
    failures = _orphans(child, column, parent, parent_column).agg(F.sum("n").alias("n"))
    return failures.select(*_result(model, column, "relationships", F.col("n")))


def identity(df: DataFrame, column: str, model: str = "") -> DataFrame:
    """:func:`not_null` and :func:`unique` of one column from a single count of its values."""
    seen = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    found = seen.agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("value").isNotNull() & (F.col("n") > 1)).alias("repeated"),
    )
    tests = F.array(
        F.struct(F.lit("not_null").alias("test"), F.col("nulls").alias("n")),
        F.struct(F.lit("unique").alias("test"), F.col("repeated").alias("n")),
    )
    rows = found.select(F.explode(tests).alias("t"))
    return rows.select(*_result(model, column, F.col("t.test"), F.col("t.n")))


def _hash_parts(value: Column) -> tuple[Column, Column]:
    """Group and 32 further bits of a text's hash; NULL for NULL."""
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    group = F.pmod(F.shiftright(hashed, 32), F.lit(HASH_GROUPS)).cast("int")
    return group, (hashed.bitwiseAND(0xFFFFFFFF) - (1 << 31)).cast("int")


def _hashed(
    tables: Mapping[str, DataFrame], columns: Iterable[tuple[str, str]]
) -> dict[tuple[str, str], tuple[int, list[int]]]:
    """NULL rows of each text column, and the groups of texts in which a hash repeats, in one job.

    A text moves 4 bytes of hash, however long it is, in a set for each group and map task.
    Equal values have equal hashes, so a group without a repeated hash has no repeated value.
    """
    parts = []
    for model, column in columns:
        df = tables[model]
        if dict(df.dtypes)[column] != "string":
            continue
        group, rest = _hash_parts(F.col(column))
        seen = df.groupBy(group.alias("group")).agg(
            F.collect_set(rest).alias("hashes"), F.count(F.lit(1)).alias("n")
        )
        repeats = F.col("group").isNotNull() & (F.col("n") > F.size("hashes"))
        found = seen.agg(
            F.coalesce(F.sum(F.when(F.col("group").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.collect_list(F.when(repeats, F.col("group"))).alias("groups"),
        )
        names = (F.lit(model).alias("model"), F.lit(column).alias("column"))
        parts.append(found.select(*names, "nulls", "groups"))
    if not parts:
        return {}
    counted = reduce(DataFrame.unionByName, parts).collect()
    return {(r["model"], r["column"]): (r["nulls"], r["groups"]) for r in counted}


def _of_groups(df: DataFrame, column: str, groups: Sequence[int]) -> DataFrame:
    """The texts of some groups of hashes."""
    wanted = df.sparkSession.createDataFrame([(g,) for g in groups], "_group int")
    group, _ = _hash_parts(F.col(column))
    return df.select(column).join(F.broadcast(wanted), group == F.col("_group"), "left_semi")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(entity, row_count)`` of every table, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("entity"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def require_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Gate: fail when any table is empty."""
    counts = {r["entity"]: r["row_count"] for r in row_counts(tables).collect()}
    empty = sorted(name for name, n in counts.items() if n == 0)
    if empty:
        raise ChecksFailed(f"no rows in: {', '.join(empty)}")
    return counts


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One report row per check.

    A column that must be filled and unique is counted once for both: a text by its
    hash, at once, and by its values only in groups where a hash repeats. All other not-null
    checks of a model share a pass; every other check reads its own column alone.
    """
    checks = list(checks)
    tested = {(c.model, c.column, c.test) for c in checks}
    both = {(m, c) for m, c, test in tested if test == "unique" and (m, c, "not_null") in tested}
    nullable: dict[str, list[str]] = {}
    for c in checks:
        if c.test == "not_null" and (c.model, c.column) not in both:
            nullable.setdefault(c.model, []).append(c.column)
    parts = [not_null(tables[m], columns, m) for m, columns in nullable.items()]
    hashed = _hashed(tables, sorted(both))
    if hashed:
        rows = [(m, c, "not_null", nulls) for (m, c), (nulls, _) in hashed.items()]
        rows += [(m, c, "unique", 0) for (m, c), (_, groups) in hashed.items() if not groups]
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(rows, REPORT_SCHEMA.removesuffix(", status string")))
    for c in checks:
        df = tables[c.model]
        if c.test == "unique" and (c.model, c.column) in hashed:
            _, groups = hashed[c.model, c.column]
            if groups:
                parts.append(unique(_of_groups(df, c.column, groups), c.column, c.model))
        elif c.test == "unique" and (c.model, c.column) in both:
            parts.append(identity(df, c.column, c.model))
        elif c.test == "unique":
            parts.append(unique(df, c.column, c.model))
        elif c.test == "accepted_values":
            parts.append(accepted_values(df, c.column, c.values, c.model))
        elif c.test == "relationships":
            parent = tables[c.parent]
            parts.append(relationships(df, c.column, parent, c.parent_column, c.model))
        elif c.test != "not_null":
            raise ValueError(f"unknown test: {c.test}")
    report = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("failures") == 0, "pass").otherwise("fail")
    return report.withColumn("status", status)


def collect_report(spark: SparkSession, report: DataFrame) -> DataFrame:
    """Run the suite once and hold its few rows as a local frame."""
    return spark.createDataFrame(report.collect(), REPORT_SCHEMA)


def raise_on_failure(report: DataFrame) -> None:
    failed = report.filter("status = 'fail'").collect()
    if failed:
        names = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed]
        raise ChecksFailed("; ".join(names))
