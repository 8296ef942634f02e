"""Facts. Every dimension is reached by a left join, so no event is lost to a missing member.

Facts bind to the current version of a versioned dimension.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.functions.scalars import (
    pack_id,
    pack_key,
    surrogate_key,
    unpack_id,
    unpack_key,
    whole_days,
)
from stockroom.operators.bounds import bound_literal
from stockroom.operators.lookups import fits_broadcast, lookup
from stockroom.plans.dims import current_only

# Why a payment was flagged.
ZERO_AMOUNT = "Zero amount payment"
UNEXPLAINED_NEGATIVE = "Unexplained negative amount"
UNKNOWN_ANOMALY = "Unknown anomaly"

# Natural id and surrogate key of each dimension a fact may point to.
_ROLES = {
    "customer": ("customer_id", "customer_key"),
    "product": ("product_id", "product_key"),
    "store": ("store_id", "store_key"),
    "employee": ("employee_id", "employee_key"),
    "payment_method": ("payment_method_id", "payment_method_key"),
}


@dataclass
class Dims:
    """The dimensions facts are keyed by, narrowed to id and key.

    Which of them fit a broadcast is measured once per instance. The calendar has a
    row per day; AQE broadcasts it when it is as small as it usually is.
    """

    members: Mapping[str, DataFrame]
    date: DataFrame | None
    _sides: dict[str, DataFrame] = field(init=False)
    _small: dict[str, bool] = field(init=False, default_factory=dict)

    def __post_init__(self) -> None:
        self._sides = {}
        for role, dim in self.members.items():
            rows = current_only(dim) if "is_current" in dim.columns else dim
            self._sides[role] = rows.select(*_ROLES[role])

    def measure(self, roles: Collection[str]) -> None:
        unknown = {r: self._sides[r] for r in roles if r not in self._small}
        self._small.update(fits_broadcast(unknown))

    def is_small(self, role: str) -> bool:
        self.measure([role])
        return self._small[role]

    def attach(self, fact: DataFrame, *roles: str, packed: bool = False) -> DataFrame:
        """Add the surrogate key of each role, by the natural id the fact carries.

        ``packed`` keys take half the bytes in a later shuffle; see :func:`pack_key`.
        """
        self.measure(roles)
        for role in roles:
            natural, key = _ROLES[role]
            side = self._sides[role]
            if packed:
                side = side.withColumn(key, pack_key(F.col(key)))
            side = F.broadcast(side) if self._small[role] else side
            fact = lookup(fact, side, F.col(natural), natural, key)
        return fact

    def attach_date(self, fact: DataFrame, time: Column, alias: str = "date_key") -> DataFrame:
        """Add the calendar key of a timestamp's day; NULL outside the calendar."""
        return lookup(fact, self.date, F.to_date(time), "full_date", "date_key", alias)


def _wanted(all_roles: tuple[str, ...], roles: Collection[str] | None) -> list[str]:
    return [r for r in all_roles if roles is None or r in roles]


def fct_sales(
    items: DataFrame, orders: DataFrame, dims: Dims, roles: Collection[str] | None = None
) -> DataFrame:
    """One row per order line; lines of cancelled or unknown orders fall out.

    ``roles`` limits the lookups to the keys a caller needs. Members that fit a
    broadcast are resolved on the joined lines, which adds no shuffle. Larger
    ones are resolved before: those of orders on the orders, fewer rows than lines
    to move, and products on the bare lines. Their keys are moved packed, and so are
    the ids of lines that are moved twice.
    """
    wanted = _wanted(("customer", "product", "store", "employee", "date"), roles)
    by_order = [r for r in wanted if r in ("customer", "store", "employee")]
    dims.measure([r for r in wanted if r != "date"])
    early = [r for r in by_order if not dims.is_small(r)]
    late = [r for r in by_order if dims.is_small(r)]

    headers = orders.select("order_id", "customer_id", "store_id", "employee_id", "ordered_at")
    headers = dims.attach(headers, *early, packed=True)
    lines, item_id = items.drop("created_at", "updated_at", "loaded_at"), F.col("order_item_id")
    if "product" in wanted and not dims.is_small("product"):
        if dict(lines.dtypes)["order_item_id"] == "string":
            lines, item_id = lines.withColumn("order_item_id", pack_id(item_id)), unpack_id(item_id)
        lines = dims.attach(lines, "product", packed=True)
        early.append("product")
    lines = lines.join(headers, "order_id")
    lines = dims.attach(lines, *late, *(r for r in wanted if r == "product" and r not in early))
    if "date" in wanted:
        lines = dims.attach_date(lines, F.col("ordered_at"))

    line_total = F.col("line_total")
    # Same value as 1 - pct / 100, without a decimal division per row.
    share = (100 - F.coalesce("discount_pct", F.lit(0).cast("decimal(5,2)"))).cast("decimal(6,2)")
    hundredth = F.lit(Decimal("0.01"))
    list_price = F.col("unit_price") * F.col("quantity")
    roles = [r for r in ("date", "customer", "product", "store", "employee") if r in wanted]
    return lines.select(
        surrogate_key(item_id).alias("sales_key"),
        item_id.alias("order_item_id"),
        "order_id",
        *(unpack_key(F.col(f"{r}_key")).alias(f"{r}_key") if r in early else f"{r}_key" for r in roles),
        "quantity",
        "unit_price",
        "discount_pct",
        line_total.alias("gross_amount"),
        # The percentage is taken off the line total as it stands, which may be net already.
        (line_total * share * hundredth).cast("decimal(18,6)").alias("net_amount"),
        # Negative where a discount brought the line below its list price.
        (line_total - list_price).cast("decimal(18,2)").alias("discount_amount"),
    )


def split_payments(payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean and anomalous payments. The flag is never NULL, so every row is in exactly one."""
    return payments.filter("NOT is_anomalous"), payments.filter("is_anomalous")


def fct_payments(
    payments: DataFrame, orders: DataFrame, dims: Dims, roles: Collection[str] | None = None
) -> DataFrame:
    """One row per clean payment. The store comes from the order, so it is NULL for a cancelled one."""
    wanted = _wanted(("customer", "store", "payment_method", "date"), roles)
    clean, _ = split_payments(payments)
    rows = clean
    if "store" in wanted:
        rows = clean.join(orders.select("order_id", "store_id"), "order_id", "left")
    rows = dims.attach(rows, *(r for r in wanted if r != "date"))
    if "date" in wanted:
        rows = dims.attach_date(rows, F.col("paid_at"))
    keys = ("date_key", "customer_key", "store_key", "payment_method_key")
    return rows.select(
        surrogate_key(F.col("payment_id")).alias("payment_key"),
        "payment_id",
        "order_id",
        *(k for k in keys if k.removesuffix("_key") in wanted),
        "amount_paid",
        "is_refund",
        "status",
        "payment_type",
        "currency",
        "reference",
    )


def flag_reason(amount: Column, status: Column) -> Column:
    return (
        F.when(amount == 0, ZERO_AMOUNT)
        .when((amount < 0) & (status != "refunded"), UNEXPLAINED_NEGATIVE)
        .otherwise(UNKNOWN_ANOMALY)
    )


def flagged_payments(payments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Quarantine: the anomalous payments and why each one is there."""
    _, anomalous = split_payments(payments)
    return anomalous.select(
        surrogate_key(F.col("payment_id")).alias("flagged_payment_key"),
        "payment_id",
        "order_id",
        "customer_id",
        "payment_method_id",
        "amount_paid",
        flag_reason(F.col("amount_paid"), F.col("status")).alias("flag_reason"),
        "status",
        "payment_type",
        "currency",
        "paid_at",
        "created_at",
        "updated_at",
        bound_literal(as_of).alias("flagged_at"),
    )


def daily_movements(movements: DataFrame) -> DataFrame:
    """Stock in and out per product, store and day with movement, whatever its type."""

    def moved(kind: str) -> Column:
        return F.sum(F.when(F.col("movement_type") == kind, F.col("quantity")).otherwise(0))

    day = F.to_date("moved_at").alias("movement_date")
    return movements.groupBy("product_id", "store_id", day).agg(
        moved("in").alias("stock_in"), moved("out").alias("stock_out")
    )


def fct_inventory_daily(
    movements: DataFrame, dims: Dims, roles: Collection[str] | None = None
) -> DataFrame:
    """One row per product, store and day with movement; aggregated before any lookup."""
    wanted = _wanted(("product", "store", "date"), roles)
    rows = dims.attach(daily_movements(movements), *(r for r in wanted if r != "date"))
    if "date" in wanted:
        rows = dims.attach_date(rows, F.col("movement_date"))
    parts = (F.col("product_id"), F.col("store_id"), F.col("movement_date"))
    return rows.select(
        surrogate_key(*parts).alias("inventory_key"),
        *(k for k in ("date_key", "product_key", "store_key") if k.removesuffix("_key") in wanted),
        "stock_in",
        "stock_out",
        (F.col("stock_in") - F.col("stock_out")).alias("net_movement"),
    )


def fct_order_lifecycle(
    orders: DataFrame, dims: Dims, roles: Collection[str] | None = None
) -> DataFrame:
    """One row per order with its milestones; the calendar plays four roles."""
    wanted = _wanted(("customer", "store", "employee", "date"), roles)
    rows = dims.attach(orders, *(r for r in wanted if r != "date"))
    milestones = ("ordered", "paid", "shipped", "delivered")
    if "date" in wanted:
        for m in milestones:
            rows = dims.attach_date(rows, F.col(f"{m}_at"), f"{m}_date_key")
    keys = ("customer_key", "store_key", "employee_key")

    def days(start: str, end: str, alias: str) -> Column:
        return whole_days(F.col(f"{start}_at"), F.col(f"{end}_at")).alias(alias)

    return rows.select(
        surrogate_key(F.col("order_id")).alias("lifecycle_key"),
        "order_id",
        *(k for k in keys if k.removesuffix("_key") in wanted),
        *(f"{m}_date_key" for m in milestones if "date" in wanted),
        F.col("status").alias("current_status"),
        "total_amount",
        "discount_amount",
        days("ordered", "paid", "days_to_pay"),
        days("paid", "shipped", "days_to_ship"),
        days("shipped", "delivered", "days_to_deliver"),
        *(f"{m}_at" for m in milestones),
    )
