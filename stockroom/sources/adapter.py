"""The nine entities derived from order-processing tables (``orders``, ``lineitem``, ...).

Plain projections and joins, so the same derivation can be stated in any SQL
engine. Natural keys keep the type the tables give them. Joins that only fetch a
price or a store go to a side grouped by its key: Catalyst then drops the join
from plans that do not use the fetched column.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stamps the tables do not carry.
LOADED_AT = "2024-02-01 00:00:00"
NO_STORE = 25  # nations are numbered from 0 to 24
EPOCH = "1994-01-01 00:00:00"
CUSTOMER_EPOCH = "2023-01-01 00:00:00"
RUN_AT = dt.datetime(2024, 2, 1)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _stamps(created: Column, updated: Column) -> list[Column]:
    return [
        created.alias("created_at"),
        updated.alias("updated_at"),
        _ts(LOADED_AT).alias("_lake_loaded_at"),
    ]


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _mail(name: str) -> Column:
    return F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))


class Tables:
    """Reads the tables of one scale folder and derives entities from them, lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        """A table with its zone-less timestamps cast once to instants (UTC)."""
        if name not in self._read:
            df = self.spark.read.parquet(self.path(name))
            local = [c for c, t in df.dtypes if t == "timestamp_ntz"]
            self._read[name] = df.withColumns({c: F.col(c).cast("timestamp") for c in local})
        return self._read[name]

    # -- small entities ----------------------------------------------------

    @cached_property
    def stores(self) -> DataFrame:
        nation = self.read("nation")
        region = self.read("region")
        opened = F.date_add(F.lit(dt.date(1994, 1, 1)), F.col("n_nationkey"))
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.concat("n_name", F.lit(", "), "r_name").alias("address"),
            F.concat(F.lit("+"), F.col("n_nationkey").cast("string")).alias("phone"),
            F.concat(F.lit("Manager "), "n_name").alias("manager_name"),
            opened.alias("opened_date"),
            *_stamps(_ts(EPOCH), _ts(EPOCH)),
        )

    @cached_property
    def employees(self) -> DataFrame:
        name = F.split("s_name", "#")
        return self.read("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_nationkey").alias("store_id"),
            name[0].alias("first_name"),
            name[1].alias("last_name"),
            _mail("s_name").alias("email"),
            F.when(F.col("s_acctbal") >= 5000, "manager").otherwise("clerk").alias("role"),
            F.date_add(F.lit(dt.date(1994, 1, 1)), F.col("s_nationkey")).alias("hired_date"),
            (F.col("s_acctbal") < 0).alias("is_deleted"),
            *_stamps(_ts(EPOCH), _ts(EPOCH)),
        )

    @cached_property
    def payment_methods(self) -> DataFrame:
        methods = self.read("orders").select("o_orderpriority").distinct()
        return methods.select(
            F.substring("o_orderpriority", 1, 1).alias("id"),
            F.expr("substring(o_orderpriority, 3)").alias("name"),
            _text("house").alias("provider"),
            (F.substring("o_orderpriority", 1, 1) != "5").alias("is_digital"),
            *_stamps(_ts(EPOCH), _ts(EPOCH)),
        )

    # -- versioned entities ------------------------------------------------

    def _customer_rows(
        self, rows: DataFrame, tier: Column, deleted: Column, updated: Column
    ) -> DataFrame:
        places = self.read("nation").join(
            self.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        placed = rows.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        name = F.split("c_name", "#")
        return placed.select(
            F.col("c_custkey").alias("id"),
            name[0].alias("first_name"),
            name[1].alias("last_name"),
            _mail("c_name").alias("email"),
            F.concat(F.lit("+"), F.col("c_nationkey").cast("string")).alias("phone"),
            F.concat("n_name", F.lit(", "), "r_name").alias("address"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("c_mktsegment").alias("segment"),
            tier.alias("tier"),
            updated.alias("effective_from"),
            _ts(EPOCH).alias("registered_at"),
            deleted.alias("is_deleted"),
            *_stamps(_ts(EPOCH), updated),
        )

    @cached_property
    def customers(self) -> DataFrame:
        tier = F.when(F.col("c_acctbal") >= 5000, "gold").otherwise("silver")
        updated = _ts(CUSTOMER_EPOCH) + _days(F.col("c_nationkey"))
        return self._customer_rows(self.read("customer"), tier, F.col("c_acctbal") < 0, updated)

    @cached_property
    def customer_versions(self) -> DataFrame:
        """Every customer as first known, then one version per event of that customer."""
        feed = self.read("events").select("user_id", "ts", "event_type")
        changed = feed.join(self.read("customer"), F.col("user_id") == F.col("c_custkey"))
        deleted = F.col("event_type") == "error"
        later = self._customer_rows(changed, F.col("event_type"), deleted, F.col("ts"))
        return self.customers.unionByName(later)

    def _product_rows(self, rows: DataFrame, price: Column, updated: Column) -> DataFrame:
        share = F.lit(Decimal("0.60")).cast("decimal(3,2)")
        cost = (price.cast("decimal(12,2)") * share).cast("decimal(10,2)")
        return rows.select(
            F.col("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
            F.col("p_type").alias("category"),
            F.col("p_size").cast("string").alias("sub_category"),
            F.col("p_brand").alias("brand"),
            F.col("p_brand").alias("supplier"),
            price.alias("selling_price"),
            cost.alias("cost_price"),
            updated.alias("effective_from"),
            F.lit(False).alias("is_deleted"),
            *_stamps(_ts(EPOCH), updated),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._product_rows(self.read("part"), F.col("p_retailprice"), _ts(EPOCH))

    @cached_property
    def product_versions(self) -> DataFrame:
        """Every product as first known, then one version per day it was shipped on."""
        observed = (
            self.read("lineitem")
            .groupBy("l_partkey", "l_shipdate")
            .agg(F.max("l_extendedprice").alias("price"))
        )
        changed = observed.join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
        return self.products.unionByName(
            self._product_rows(changed, F.col("price"), F.col("l_shipdate"))
        )

    # -- events ------------------------------------------------------------

    @cached_property
    def orders(self) -> DataFrame:
        lines = (
            self.read("lineitem")
            .groupBy("l_orderkey")
            .agg(F.min("l_suppkey").alias("employee"), F.min("l_shipdate").alias("first_shipped"))
        )
        homes = self.read("customer").groupBy("c_custkey").agg(F.max("c_nationkey").alias("home"))
        rows = (
            self.read("orders")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        )
        key, kind = F.col("o_orderkey"), F.col("o_orderstatus")
        ordered = F.col("o_orderdate")
        cancelled = key % 10 == 0
        shipped = F.when((kind == "F") | ((kind == "P") & (key % 2 == 1)), F.col("first_shipped"))
        travel = _days(F.col("o_custkey") % 7) + _hours(F.lit(36))
        delivered = F.when(kind == "F", F.col("first_shipped") + travel)
        status = (
            F.when(cancelled, "cancelled")
            .when(kind == "O", "pending")
            .when(kind == "F", "delivered")
            .when(key % 2 == 0, "paid")
            .otherwise("shipped")
        )
        return rows.select(
            key.alias("id"),
            F.col("o_custkey").alias("customer_id"),
            # Some orders name a store past the last one, to show unmatched keys.
            F.when(key % 26 == 0, NO_STORE).otherwise(F.col("home")).alias("store_id"),
            F.col("employee").alias("employee_id"),
            status.alias("status"),
            F.col("o_orderpriority").alias("discount_code"),
            F.col("o_totalprice").alias("total_amount"),
            (key % 100).cast("double").alias("discount_amount"),
            ordered.alias("ordered_at"),
            F.when(kind != "O", ordered + _days(key % 5) + _hours(key % 24)).alias("paid_at"),
            shipped.alias("shipped_at"),
            delivered.alias("delivered_at"),
            F.when(cancelled, ordered).alias("cancelled_at"),
            *_stamps(ordered, ordered),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        prices = self.read("part").groupBy("p_partkey").agg(F.max("p_retailprice").alias("price"))
        lines = self.read("lineitem")
        priced = lines.join(prices, F.col("l_partkey") == F.col("p_partkey"), "left")
        parts = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
        day = F.date_format("l_shipdate", "yyyy-MM-dd")
        return priced.select(
            F.concat_ws("-", *(F.col(p).cast("string") for p in parts), day).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("price").alias("unit_price"),
            F.round(F.col("l_discount") * 100).alias("discount_pct"),
            F.col("l_extendedprice").alias("line_total"),
            *_stamps(F.col("l_shipdate"), F.col("l_shipdate")),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.payments_of(self.read("orders"))

    @staticmethod
    def payments_of(orders: DataFrame) -> DataFrame:
        """One payment per order; ``orders`` may be a stream."""
        key, total, ordered = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderdate")
        amount = F.when(key % 25 == 0, 0.0).when(key % 17 == 0, -total).otherwise(total)
        return orders.select(
            key.alias("id"),
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).alias("payment_method_id"),
            F.when(key % 34 == 0, "refunded").otherwise("completed").alias("status"),
            _text("order").alias("payment_type"),
            _text("USD").alias("currency"),
            F.concat(F.lit("PAY-"), key.cast("string")).alias("reference"),
            amount.alias("amount_paid"),
            ordered.alias("paid_at"),
            *_stamps(ordered, ordered),
        )

    @cached_property
    def inventory_movements(self) -> DataFrame:
        kind = F.col("event_type")
        movement = F.when(kind == "signup", "in").when(kind == "purchase", "out").otherwise(kind)
        return self.read("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("product_id"),
            (F.col("event_id") % (NO_STORE + 1)).alias("store_id"),
            movement.alias("movement_type"),
            _text("event").alias("reference_type"),
            F.col("event_id").cast("string").alias("reference_id"),
            F.col("props").alias("notes"),
            F.floor("value").alias("quantity"),
            F.col("ts").alias("moved_at"),
            *_stamps(F.col("ts"), F.col("ts")),
        )

    def entity(self, name: str) -> DataFrame:
        return getattr(self, name)
