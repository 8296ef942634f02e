"""Dimensions. Soft-deleted members stay, flagged; nothing filters them out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions.scalars import surrogate_key, timestamp_text
from stockroom.operators.lookups import lookup

# The staged times that facts take their date keys from.
FACT_TIMES = {
    "orders": ("ordered_at", "paid_at", "shipped_at", "delivered_at"),
    "payments": ("paid_at",),
    "inventory_movements": ("moved_at",),
}


def _keyed(stg: DataFrame, key: str, natural: str, *columns) -> DataFrame:
    return stg.select(surrogate_key(F.col(natural)).alias(key), natural, *columns)


def dim_store(stg_stores: DataFrame) -> DataFrame:
    place = ("city", "state", "address", "phone", "manager_name", "opened_date")
    return _keyed(
        stg_stores, "store_key", "store_id", "store_name", *place, "created_at", "updated_at"
    )


def dim_employee(stg_employees: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Carries the key of the employee's store; NULL when the store is unknown."""
    with_store = lookup(stg_employees, dim_store, F.col("store_id"), "store_id", "store_key")
    person = ("first_name", "last_name", "full_name", "email", "role", "hired_date", "is_deleted")
    return _keyed(
        with_store.drop("store_id"), "employee_key", "employee_id", "store_key", *person,
        "created_at", "updated_at",
    )


def dim_payment_method(stg_payment_methods: DataFrame) -> DataFrame:
    columns = ("method_name", "provider", "is_digital", "created_at", "updated_at")
    return _keyed(stg_payment_methods, "payment_method_key", "payment_method_id", *columns)


def _versioned(history: DataFrame, key: str, natural: str, *columns) -> DataFrame:
    """One member per version: its key covers the natural key and the start of validity."""
    return history.select(
        surrogate_key(F.col(natural), timestamp_text(F.col("valid_from"))).alias(key),
        natural,
        *columns,
        "effective_from",
        "created_at",
        "updated_at",
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        "is_deleted",
    )


def dim_customer(history: DataFrame) -> DataFrame:
    person = ("first_name", "last_name", "full_name", "email", "phone", "address", "city", "state")
    return _versioned(
        history, "customer_key", "customer_id", *person, "segment", "tier", "registered_at"
    )


def dim_product(history: DataFrame) -> DataFrame:
    margin = (F.col("unit_price") - F.col("cost_price")).alias("gross_margin")
    traits = ("product_name", "sku", "category", "sub_category", "brand", "supplier")
    return _versioned(
        history, "product_key", "product_id", *traits, "unit_price", "cost_price", margin
    )


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per day. Built on ``range``, whose exact size lets Spark broadcast it unasked."""
    days = spark.range((hi - lo).days + 1)
    return _calendar(days.select(F.date_add(F.lit(lo), F.col("id").cast("int")).alias("full_date")))


def _span(rows: DataFrame, times: Sequence[str]) -> DataFrame:
    days = F.array(*(F.to_date(t) for t in times))
    return rows.agg(F.min(F.array_min(days)).alias("lo"), F.max(F.array_max(days)).alias("hi"))


def dim_date_covering(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """The calendar from the first to the last day seen in the given columns of the sources."""
    spans = reduce(DataFrame.unionByName, (_span(rows, times) for rows, times in sources))
    span = spans.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    day = F.expr("interval 1 day")
    return _calendar(span.select(F.explode(F.sequence("lo", "hi", day)).alias("full_date")))


def date_month(date_key: Column) -> Column:
    """The month of a date key, as facts stored by month are partitioned."""
    return F.floor(date_key / 100).cast("int")


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")
