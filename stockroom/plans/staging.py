"""Staging: one lazy projection per entity, from raw columns to model names and types.

Casts are strict here: what lenient coercion let through must now fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.scalars import full_name, money


def _stage(raw: DataFrame, key: str, *columns: str | Column) -> DataFrame:
    """Renamed key first, then the model's columns, then the columns every entity carries."""
    return raw.select(
        F.col("id").alias(key),
        *columns,
        "created_at",
        "updated_at",
        F.col("_lake_loaded_at").alias("loaded_at"),
    )


def _person() -> Column:
    return full_name(F.col("first_name"), F.col("last_name")).alias("full_name")


def _money(column: str, alias: str | None = None) -> Column:
    return money(F.col(column)).alias(alias or column)


def stg_stores(raw: DataFrame) -> DataFrame:
    opened = F.col("opened_date").cast("date").alias("opened_date")
    name = F.col("name").alias("store_name")
    return _stage(raw, "store_id", name, "city", "state", "address", "phone", "manager_name", opened)


def stg_employees(raw: DataFrame) -> DataFrame:
    hired = F.col("hired_date").cast("date").alias("hired_date")
    names = ("first_name", "last_name", _person())
    return _stage(raw, "employee_id", "store_id", *names, "email", "role", hired, "is_deleted")


def stg_payment_methods(raw: DataFrame) -> DataFrame:
    name = F.col("name").alias("method_name")
    return _stage(raw, "payment_method_id", name, "provider", "is_digital")


def stg_customers(raw: DataFrame) -> DataFrame:
    contact = ("email", "phone", "address", "city", "state")
    times = ("effective_from", "registered_at")
    return _stage(
        raw, "customer_id", "first_name", "last_name", _person(), *contact, "segment", "tier",
        *times, "is_deleted",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    name = F.col("name").alias("product_name")
    traits = ("sku", "category", "sub_category", "brand", "supplier")
    prices = (_money("selling_price", "unit_price"), _money("cost_price"))
    return _stage(raw, "product_id", name, *traits, *prices, "effective_from", "is_deleted")


def stg_orders(raw: DataFrame) -> DataFrame:
    """Cancelled orders are dropped, and so are orders without a status: NULL is not unequal."""
    kept = raw.filter(F.col("status") != "cancelled")
    amounts = (_money("total_amount"), _money("discount_amount"))
    times = ("ordered_at", "paid_at", "shipped_at", "delivered_at", "cancelled_at")
    keys = ("customer_id", "store_id", "employee_id")
    return _stage(kept, "order_id", *keys, "status", "discount_code", *amounts, *times)


def stg_order_items(raw: DataFrame) -> DataFrame:
    numbers = (
        F.col("quantity").cast("int").alias("quantity"),
        _money("unit_price"),
        F.col("discount_pct").cast("decimal(5,2)").alias("discount_pct"),
        _money("line_total"),
    )
    return _stage(raw, "order_item_id", "order_id", "product_id", *numbers)


def is_refund(amount: Column, status: Column) -> Column:
    """Negative and marked refunded; never NULL."""
    return F.coalesce((amount < 0) & (status == "refunded"), F.lit(False))


def is_anomalous(amount: Column, status: Column) -> Column:
    """Zero, or negative without being a refund; never NULL, an unknown status is no evidence."""
    unexplained = (amount < 0) & (status != "refunded")
    return F.coalesce(amount == 0, F.lit(False)) | F.coalesce(unexplained, F.lit(False))


def stg_payments(raw: DataFrame) -> DataFrame:
    amount, status = money(F.col("amount_paid")), F.col("status")
    flags = (
        is_refund(amount, status).alias("is_refund"),
        is_anomalous(amount, status).alias("is_anomalous"),
    )
    keys = ("order_id", "customer_id", "payment_method_id")
    traits = ("status", "payment_type", "currency", "reference")
    return _stage(raw, "payment_id", *keys, *traits, _money("amount_paid"), *flags, "paid_at")


def stg_inventory_movements(raw: DataFrame) -> DataFrame:
    traits = ("movement_type", "reference_type", "reference_id", "notes")
    quantity = F.col("quantity").cast("int").alias("quantity")
    return _stage(raw, "movement_id", "product_id", "store_id", *traits, quantity, "moved_at")


STAGING = {
    "stores": stg_stores,
    "employees": stg_employees,
    "payment_methods": stg_payment_methods,
    "customers": stg_customers,
    "products": stg_products,
    "orders": stg_orders,
    "order_items": stg_order_items,
    "payments": stg_payments,
    "inventory_movements": stg_inventory_movements,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every staging model whose raw table is present, named ``stg_<entity>``."""
    return {f"stg_{name}": STAGING[name](df) for name, df in raw.items()}
