"""The data checks every build must answer, model by model."""

from __future__ import annotations

from stockroom.operators.checks import Check

# Order states a lifecycle row may be in.
LIFECYCLE_STATUSES = ("pending", "paid", "shipped", "delivered")

# Columns that identify a row (not null and unique).
IDENTITIES = {
    "stg_stores": "store_id",
    "stg_employees": "employee_id",
    "stg_payment_methods": "payment_method_id",
    "stg_customers": "customer_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "stg_payments": "payment_id",
    "stg_inventory_movements": "movement_id",
    "dim_store": "store_key",
    "dim_employee": "employee_key",
    "dim_payment_method": "payment_method_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "fct_sales": "sales_key",
    "fct_payments": "payment_key",
    "fct_inventory_daily": "inventory_key",
    "fct_order_lifecycle": "lifecycle_key",
    "flagged_payments": "flagged_payment_key",
}

# Further columns that must be filled.
REQUIRED = {
    "dim_store": ("store_id",),
    "dim_employee": ("store_key",),
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "fct_sales": ("date_key", "customer_key", "product_key", "store_key", "gross_amount"),
    "fct_payments": ("date_key", "customer_key", "store_key", "amount_paid"),
    "fct_inventory_daily": ("date_key", "product_key", "store_key"),
    "fct_order_lifecycle": ("ordered_date_key", "customer_key", "store_key", "current_status"),
    "flagged_payments": ("flag_reason",),
}

CHECKS: tuple[Check, ...] = (
    *(Check(m, c, "not_null") for m, c in IDENTITIES.items()),
    *(Check(m, c, "unique") for m, c in IDENTITIES.items()),
    *(Check(m, c, "not_null") for m, columns in REQUIRED.items() for c in columns),
    Check("dim_employee", "store_key", "relationships", parent="dim_store", parent_column="store_key"),
    Check("fct_order_lifecycle", "current_status", "accepted_values", values=LIFECYCLE_STATUSES),
)
