"""One key holds a third of all rows: work is split, results stay whole."""

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stockroom.operators import checks, scd2
from stockroom.operators.keyed import KeyedTable
from stockroom.operators.latest import latest_by_key
from stockroom.plans import dims, facts
from stockroom.plans.staging import STAGING
from stockroom.sources.registry import ENTITIES

N = 60_000


@contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in conf:
            spark.conf.unset(key)


def skewed_joins(spark):
    """Small thresholds, so that AQE treats test data as it would large data."""
    return settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="1000",
        adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="1000",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="8",
    )


def hot(column, key):
    """A third of the rows get ``key``."""
    return F.when(F.col("id") % 3 == 0, key).otherwise(column)


def entity(spark, name, df):
    have = set(df.columns)
    typed = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in ENTITIES[name].schema
    ]
    return STAGING[name](df.select(*typed, F.current_timestamp().alias("_lake_loaded_at")))


@pytest.fixture
def sales_inputs(spark):
    ids = spark.range(N).repartition(8)
    items = entity(
        spark,
        "order_items",
        ids.select(
            F.col("id"),
            hot(F.col("id") % 2000, 7).alias("order_id"),
            hot(F.col("id") % 50, 1).alias("product_id"),
            F.lit(1).alias("quantity"),
            F.lit(2.0).alias("unit_price"),
            F.lit(2.0).alias("line_total"),
        ),
    )
    orders = entity(
        spark,
        "orders",
        spark.range(2000).select(
            "id",
            hot(F.col("id") % 500, 3).alias("customer_id"),
            F.lit("s").alias("store_id"),
            F.lit("paid").alias("status"),
        ),
    )
    return items, orders


def members(spark):
    when = F.lit("2024-01-01").cast("timestamp").alias("updated_at")
    customers = entity(spark, "customers", spark.range(500).select("id", when))
    products = entity(spark, "products", spark.range(50).select("id", when))
    return {
        "customer": dims.dim_customer(scd2.open_history(customers, "customer_id")),
        "product": dims.dim_product(scd2.open_history(products, "product_id")),
    }


def test_fact_joins_split_a_hot_order_and_product(spark, sales_inputs):
    items, orders = sales_inputs
    keyed = facts.Dims(members(spark), None)
    keyed._small = {"customer": False, "product": False}
    with skewed_joins(spark):
        got = facts.fct_sales(items, orders, keyed, ["customer", "product"])
        collected = got.agg(
            F.count("*"),
            F.count("customer_key"),
            F.count("product_key"),
            F.sum("gross_amount"),
            F.max("sales_key"),  # rows must carry their own data, or the hot part compresses away
        )
        row = collected.collect()[0]
        plan = collected._jdf.queryExecution().executedPlan().toString()
    assert tuple(row)[:3] == (N, N, N) and float(row[3]) == 2.0 * N
    final = plan.split("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true)") == 3  # order, customer, product
    assert "CartesianProduct" not in plan


def test_hot_null_keys_stay_whole(spark, sales_inputs):
    items, _ = sales_inputs
    loose = items.withColumn("product_id", F.nullif(F.col("product_id"), F.lit("1")))
    keyed = facts.Dims(members(spark), None)
    keyed._small = {"product": False}
    with skewed_joins(spark):
        got = keyed.attach(loose, "product")
        assert got.count() == N
        assert got.filter("product_key IS NULL").count() == loose.filter("product_id IS NULL").count()


def test_latest_of_a_hot_key(spark, tmp_path):
    feed = spark.range(N).repartition(8).select(
        hot(F.col("id") % 500, -1).alias("k"), F.col("id").alias("updated_at"), "id"
    )
    want = feed.groupBy("k").agg(F.max("id").alias("id"))
    got = latest_by_key(feed, ["k"], ["updated_at"]).select("k", "id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # One row per key and map task crosses the shuffle.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["updated_at"])
    table.merge(feed, "one")
    assert table.read().count() == want.count()


def test_history_of_a_hot_key(spark):
    start = dt.datetime(2024, 1, 1)
    feed = spark.range(N // 10).select(
        hot(F.col("id") % 50, -1).alias("k"),
        (F.lit(start).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("updated_at"),
    )
    whole = scd2.history_from_versions(feed, "k")
    split = scd2.history_from_versions(feed, "k", max_timeline=200)
    assert split.count() == feed.count()
    assert whole.exceptAll(split).isEmpty()
    assert split.filter("valid_to IS NULL").count() == feed.select("k").distinct().count()


def test_copies_of_one_version_collapse_before_the_timeline(spark):
    copies = spark.range(5000).select(
        F.lit("k").alias("k"), F.lit("2024-01-01").cast("timestamp").alias("updated_at")
    )
    got = scd2.history_from_versions(copies, "k", max_timeline=100)
    assert got.count() == 1


def test_checks_count_hot_values(spark):
    child = spark.range(N).select(hot(F.col("id") % 100, -1).alias("k"))
    parent = spark.range(100).select(F.col("id").alias("k"))
    orphans = checks.relationships(child, "k", parent, "k").first()["failures"]
    assert orphans == N // 3
    plan = checks.relationships(child, "k", parent, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("LeftAnti") :]  # values are counted below the join
