"""Reports over the star schema.

Each takes only the tables it reads, so a caller need not build the rest. Sorted
reports break ties by their grouping columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockroom.plans.dims import current_only, date_month


def _total(column: str, alias: str) -> Column:
    return F.sum(column).cast("decimal(20,2)").alias(alias)


def _rows(alias: str) -> Column:
    return F.count(F.lit(1)).alias(alias)


def _mean(column: str, alias: str) -> Column:
    """Mean of the non-NULL values, to six digits."""
    known = F.nullif(F.count(column), F.lit(0))
    return F.round(F.sum(column).cast("double") / known, 6).alias(alias)


def _per_key(fact: DataFrame, key: str, *columns: Column) -> DataFrame:
    """Sums per dimension key: combined before the dimension joins, so the join moves few rows."""
    return fact.groupBy(key).agg(*columns)


def revenue_by_store(fct_sales: DataFrame, dim_store: DataFrame) -> DataFrame:
    per_key = _per_key(fct_sales, "store_key", F.sum("gross_amount").alias("revenue"))
    return (
        per_key.join(dim_store, "store_key")
        .groupBy("store_name")
        .agg(_total("revenue", "total_revenue"))
        .orderBy(F.desc("total_revenue"), "store_name")
    )


def top_products(fct_sales: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    revenue, units = F.sum("gross_amount").alias("revenue"), F.sum("quantity").alias("units")
    per_key = _per_key(fct_sales, "product_key", revenue, units)
    return (
        per_key.join(current_only(dim_product), "product_key")
        .groupBy("product_name", "category")
        .agg(_total("revenue", "total_revenue"), F.sum("units").alias("units_sold"))
        .orderBy(F.desc("total_revenue"), "product_name", "category")
        .limit(k)
    )


def _monthly(fct_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per month of the calendar given.

    A fact stored by month (``date_month``) joins on the month too: a calendar cut to
    some time then prunes the fact's partitions while the query runs.
    """
    keys = ["date_key"]
    if "date_month" in fct_sales.columns:
        keys.append("date_month")
        dim_date = dim_date.withColumn("date_month", date_month(F.col("date_key")))
    per_key = fct_sales.groupBy(*keys).agg(F.sum("gross_amount").alias("revenue"))
    return (
        per_key.join(dim_date, keys)
        .groupBy("year", "month", "month_name")
        .agg(_total("revenue", "total_revenue"))
    )


def revenue_by_month(fct_sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    ordered = _monthly(fct_sales, dim_date).orderBy("year", "month")
    return ordered.select("year", "month_name", "total_revenue")


def best_months(fct_sales: DataFrame, dim_date: DataFrame, k: int = 3) -> DataFrame:
    best = _monthly(fct_sales, dim_date).orderBy(F.desc("total_revenue"), "year", "month").limit(k)
    return best.select("year", "month_name", "total_revenue")


def customer_segments(fct_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Customers and revenue per segment. ``avg_order_value`` is the mean of a sales line.

    Sums per customer first: a row per customer then serves count, total and mean.
    """
    revenue, lines = F.sum("gross_amount").alias("revenue"), F.count("gross_amount").alias("lines")
    per_customer = _per_key(fct_sales, "customer_key", revenue, lines)
    mean = F.round(F.sum("revenue").cast("double") / F.nullif(F.sum("lines"), F.lit(0)), 6)
    return (
        per_customer.join(current_only(dim_customer), "customer_key")
        .groupBy("segment")
        .agg(
            F.count_distinct("customer_key").alias("customer_count"),
            _total("revenue", "total_revenue"),
            mean.alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def payment_methods(fct_payments: DataFrame, dim_payment_method: DataFrame) -> DataFrame:
    """Transactions per method; refunds count as negative amounts."""
    paid = F.sum("amount_paid").alias("paid")
    per_key = _per_key(fct_payments, "payment_method_key", _rows("transactions"), paid)
    return (
        per_key.join(dim_payment_method, "payment_method_key")
        .groupBy("method_name")
        .agg(F.sum("transactions").alias("transaction_count"), _total("paid", "total_amount"))
        .orderBy(F.desc("total_amount"), "method_name")
    )


def flagged_by_reason(flagged_payments: DataFrame) -> DataFrame:
    return (
        flagged_payments.groupBy("flag_reason")
        .agg(_rows("count"), _total("amount_paid", "total_amount"))
        .orderBy(F.desc("count"), "flag_reason")
    )


def lifecycle_metrics(fct_order_lifecycle: DataFrame) -> DataFrame:
    return (
        fct_order_lifecycle.groupBy("current_status")
        .agg(
            _rows("order_count"),
            _mean("days_to_pay", "avg_days_to_pay"),
            _mean("days_to_ship", "avg_days_to_ship"),
            _mean("days_to_deliver", "avg_days_to_deliver"),
        )
        .orderBy(F.desc("order_count"), "current_status")
    )


def revenue_by_category(fct_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_key = _per_key(fct_sales, "product_key", F.sum("gross_amount").alias("revenue"))
    return (
        per_key.join(dim_product, "product_key")
        .groupBy("category")
        .agg(_total("revenue", "total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def lines_per_order(fct_sales: DataFrame) -> DataFrame:
    per_order = fct_sales.groupBy("order_id").agg(_rows("lines"))
    return per_order.agg(
        F.sum("lines").alias("line_count"),
        F.count(F.lit(1)).alias("order_count"),
        F.round(F.sum("lines").cast("double") / F.count(F.lit(1)), 6).alias("lines_per_order"),
    )


def anomaly_share(stg_payments: DataFrame) -> DataFrame:
    """Flagged against all payments: clean and flagged partition them, so one pass counts both."""
    flagged, total = F.count_if("is_anomalous"), F.count(F.lit(1))
    share = F.round(flagged.cast("double") / F.nullif(total, F.lit(0)), 6)
    return stg_payments.agg(
        flagged.alias("flagged_count"),
        total.alias("payment_count"),
        share.alias("anomaly_share"),
    )


def discount_by_product(fct_sales: DataFrame, dim_product: DataFrame) -> DataFrame:
    discount, net = F.sum("discount_amount").alias("discount"), F.sum("net_amount").alias("net")
    per_key = _per_key(fct_sales, "product_key", discount, net)
    return (
        per_key.join(current_only(dim_product), "product_key")
        .groupBy("product_name")
        .agg(
            _total("discount", "total_discount"),
            F.sum("net").cast("decimal(28,6)").alias("net_revenue"),
        )
        .orderBy("total_discount", "product_name")
    )


def quality_summary(
    flagged_payments: DataFrame, dim_customer: DataFrame, dim_product: DataFrame
) -> DataFrame:
    """One row per known data issue with its count."""

    def issue(label: str, column: str) -> Column:
        return F.struct(F.lit(label).alias("issue"), F.col(column).alias("count"))

    issues = F.array(
        issue("Zero amount payment", "zero"), issue("Unexplained negative payment", "negative")
    )
    payments = flagged_payments.agg(
        F.count_if(F.col("amount_paid") == 0).alias("zero"),
        F.count_if(F.col("amount_paid") < 0).alias("negative"),
    ).select(F.inline(issues))

    def versions(dim: DataFrame, natural: str, label: str) -> DataFrame:
        per_member = dim.groupBy(natural).agg(
            _rows("versions"),
            F.bool_or(F.col("is_current") & F.col("is_deleted")).alias("deleted"),
        )
        found = F.array(
            issue(f"Soft-deleted {label}", "deleted"), issue(f"Versioned {label}", "versioned")
        )
        return per_member.agg(
            F.count_if("deleted").alias("deleted"),
            F.count_if(F.col("versions") > 1).alias("versioned"),
        ).select(F.inline(found))

    customers = versions(dim_customer, "customer_id", "customer")
    products = versions(dim_product, "product_id", "product")
    return payments.unionByName(customers).unionByName(products)
