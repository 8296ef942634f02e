"""Staging, dimensions, facts and reports on hand-written edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockroom.operators import lookups, scd2
from stockroom.plans import analytics, dims, facts, pipeline
from stockroom.plans.staging import stg_orders, stg_payments, stg_products
from stockroom.sources.registry import ENTITIES

from .conftest import at, rows

NOW = at(31)


def raw(spark, entity, records):
    """A raw table from dicts; missing columns are NULL."""
    schema = ENTITIES[entity].schema
    data = [tuple(r.get(f.name) for f in schema) for r in records]
    return spark.createDataFrame(data, schema).withColumn("_lake_loaded_at", F.lit(NOW))


def stage(spark, entity, records):
    from stockroom.plans.staging import STAGING

    return STAGING[entity](raw(spark, entity, records))


@pytest.fixture
def star(spark):
    """Two stores, one employee, one customer, one product, one method."""
    store = dims.dim_store(stage(spark, "stores", [{"id": "s1", "name": "S1"}, {"id": "s2", "name": "S2"}]))
    employee = dims.dim_employee(stage(spark, "employees", [{"id": "e1", "store_id": "s1"}]), store)
    method = dims.dim_payment_method(stage(spark, "payment_methods", [{"id": "m1", "name": "Card"}]))
    customers = stage(spark, "customers", [{"id": "c1", "updated_at": at(1), "segment": "vip", "is_deleted": False}])
    products = stage(spark, "products", [{"id": "p1", "updated_at": at(1), "selling_price": 5.0, "cost_price": 3.0}])
    members = {
        "store": store,
        "employee": employee,
        "payment_method": method,
        "customer": dims.dim_customer(scd2.open_history(customers, "customer_id")),
        "product": dims.dim_product(scd2.open_history(products, "product_id")),
    }
    return facts.Dims(members, dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)))


def test_order_status_filter(spark):
    orders = raw(spark, "orders", [{"id": s or "null", "status": s} for s in ("cancelled", None, "paid", "returned")])
    assert rows(stg_orders(orders), "order_id") == [("paid",), ("returned",)]


PAYMENTS = [
    (0.0, "refunded"), (0.0, "completed"), (-5.0, "refunded"), (-5.0, "completed"),
    (-5.0, None), (5.0, "completed"), (None, "completed"),
]


def payments(spark):
    records = [
        {"id": str(i), "order_id": "o1", "amount_paid": a, "status": s, "paid_at": at(2)}
        for i, (a, s) in enumerate(PAYMENTS)
    ]
    return stage(spark, "payments", records)


def test_payment_flags(spark):
    got = payments(spark).orderBy("payment_id").collect()
    assert [r["is_anomalous"] for r in got] == [True, True, False, True, False, False, False]
    assert [r["is_refund"] for r in got] == [False, False, True, False, False, False, False]


def test_quarantine_partitions_payments(spark):
    stg = payments(spark)
    clean, flagged = facts.split_payments(stg)
    assert sorted(rows(clean, "payment_id") + rows(flagged, "payment_id")) == rows(stg, "payment_id")


def test_flag_reasons(spark):
    got = facts.flagged_payments(payments(spark), NOW)
    assert rows(got, "payment_id", "flag_reason") == [
        ("0", facts.ZERO_AMOUNT), ("1", facts.ZERO_AMOUNT), ("3", facts.UNEXPLAINED_NEGATIVE),
    ]
    assert got.select(F.date_format("flagged_at", "yyyy-MM-dd")).first()[0] == "2024-01-31"


def test_staging_casts_are_strict(spark):
    bad = raw(spark, "products", [{"id": "p", "selling_price": 1e12}])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        stg_products(bad).collect()
    wrong = raw(spark, "payments", [{"id": "p"}]).withColumn("amount_paid", F.lit("abc"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stg_payments(wrong).collect()


def test_product_margin_and_current_version(spark):
    versions = stage(
        spark,
        "products",
        [
            {"id": "p", "updated_at": at(1), "selling_price": 5.0, "cost_price": 3.0},
            {"id": "p", "updated_at": at(2), "selling_price": 6.0, "cost_price": 3.0},
        ],
    )
    dim = dims.dim_product(scd2.history_from_versions(versions, "product_id"))
    assert rows(dim, "gross_margin", "is_current") == [(Decimal("2.00"), False), (Decimal("3.00"), True)]
    assert dim.select("product_key").distinct().count() == 2
    assert rows(dims.current_only(dim), "unit_price") == [(Decimal("6.00"),)]


def test_employee_of_unknown_store_keeps_a_null_key(spark, star):
    store = star.members["store"]
    staff = [{"id": "a", "store_id": "s1"}, {"id": "b", "store_id": "nowhere"}, {"id": "c"}]
    got = dims.dim_employee(stage(spark, "employees", staff), store)
    assert rows(got.select("employee_id", F.col("store_key").isNull())) == [("a", False), ("b", True), ("c", True)]


ORDERS = [
    {"id": "o1", "status": "paid", "customer_id": "c1", "store_id": "s1", "employee_id": "e1", "ordered_at": at(2), "paid_at": at(3, 13)},
    {"id": "o2", "status": "cancelled", "customer_id": "c1", "store_id": "s1", "ordered_at": at(2)},
    {"id": "o3", "status": "pending", "customer_id": "x", "store_id": "x", "employee_id": "x", "ordered_at": dt.datetime(2030, 1, 1)},
]
ITEMS = [
    {"id": "i1", "order_id": "o1", "product_id": "p1", "quantity": 2, "unit_price": 6.0, "line_total": 10.0},
    {"id": "i2", "order_id": "o1", "product_id": "p1", "quantity": 2, "unit_price": 5.0, "line_total": 10.0, "discount_pct": 5.0},
    {"id": "i3", "order_id": "o1", "product_id": "p1", "quantity": 1, "unit_price": 5.0, "line_total": 10.0, "discount_pct": 100.0},
    {"id": "i4", "order_id": "o2", "product_id": "p1", "quantity": 1, "unit_price": 5.0, "line_total": 5.0},
    {"id": "i5", "order_id": "o3", "product_id": "x", "quantity": 1, "unit_price": 5.0, "line_total": 5.0},
    {"id": "i6", "order_id": "gone", "product_id": "p1", "quantity": 1, "unit_price": 5.0, "line_total": 5.0},
]
KEYS = ("date_key", "customer_key", "product_key", "store_key", "employee_key")


def sales(spark, star, roles=None):
    return facts.fct_sales(stage(spark, "order_items", ITEMS), stage(spark, "orders", ORDERS), star, roles)


def test_sales_measures_and_dropped_lines(spark, star):
    got = sales(spark, star)
    d = Decimal
    assert rows(got, "order_item_id", "gross_amount", "net_amount", "discount_amount") == [
        ("i1", d("10.00"), d("10.000000"), d("-2.00")),
        ("i2", d("10.00"), d("9.500000"), d("0.00")),
        ("i3", d("10.00"), d("0.000000"), d("5.00")),
        ("i5", d("5.00"), d("5.000000"), d("0.00")),
    ]


def test_dangling_keys_are_null_and_rows_stay(spark, star):
    got = sales(spark, star)
    missing = got.filter("order_item_id = 'i5'").select(*KEYS).first()
    assert tuple(missing) == (None,) * 5
    found = got.filter("order_item_id = 'i1'").select(*KEYS).first()
    assert None not in tuple(found) and found["date_key"] == 20240102


def test_roles_limit_the_lookups(spark, star):
    got = sales(spark, star, ["store"])
    assert [c for c in got.columns if c in KEYS] == ["store_key"]
    assert got.count() == 4


def test_large_members_are_resolved_without_broadcast(spark, star):
    want = rows(sales(spark, star), "order_item_id", *KEYS)
    star._small.update(dict.fromkeys(star.members, False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sales(spark, star)
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in text and "CartesianProduct" not in text
        assert rows(got, "order_item_id", *KEYS) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_meet_large_products_with_packed_ids(spark, star):
    """An id of digits crosses both shuffles in half its length; ids of any kind come out as they were."""
    ids = ["1-20240101-7", "", "A-1", None, "i5"]
    items = stage(spark, "order_items", [ITEMS[0] | {"id": i} for i in ids])
    orders = stage(spark, "orders", ORDERS)
    want = rows(facts.fct_sales(items, orders, star), "sales_key", "order_item_id", *KEYS)
    assert sorted(r[1] for r in want if r[1] is not None) == ["", "1-20240101-7", "A-1", "i5"]
    star._small.update(dict.fromkeys(star.members, False))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = facts.fct_sales(items, orders, star)
        assert rows(got, "sales_key", "order_item_id", *KEYS) == want
        assert "unhex(" in got._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookups_measure_before_broadcasting(spark, star, monkeypatch):
    monkeypatch.setattr(facts, "fits_broadcast", lambda sides: lookups.fits_broadcast(sides, 1))
    assert star.is_small("customer") and not star.is_small("store")


def test_payment_of_cancelled_order_has_no_store(spark, star):
    paid = [
        {"id": "a", "order_id": "o1", "customer_id": "c1", "payment_method_id": "m1", "amount_paid": 5.0, "status": "completed", "paid_at": at(2)},
        {"id": "b", "order_id": "o2", "customer_id": "c1", "payment_method_id": "m1", "amount_paid": 5.0, "status": "completed", "paid_at": at(2)},
        {"id": "c", "order_id": "o1", "amount_paid": 0.0, "status": "completed"},
    ]
    got = facts.fct_payments(stage(spark, "payments", paid), stage(spark, "orders", ORDERS), star)
    assert rows(got.select("payment_id", F.col("store_key").isNull())) == [("a", False), ("b", True)]
    report = analytics.payment_methods(got, star.members["payment_method"])
    assert rows(report) == [("Card", 2, Decimal("10.00"))]


def test_inventory_days(spark, star):
    def move(i, kind, quantity, product="p1", day=2):
        return {"id": str(i), "product_id": product, "store_id": "s1", "movement_type": kind, "quantity": quantity, "moved_at": at(day, i % 20)}

    moves = [
        move(1, "in", 5), move(2, "out", 2), move(3, "adjust", 9), move(4, "in", None),
        move(5, "adjust", 7, day=3),
        move(6, "in", None, day=4),
    ]
    got = facts.fct_inventory_daily(stage(spark, "inventory_movements", moves), star)
    assert rows(got, "date_key", "stock_in", "stock_out", "net_movement") == [
        (20240102, 5, 2, 3), (20240103, 0, 0, 0), (20240104, None, 0, None),
    ]


def test_lifecycle_days_and_roles(spark, star):
    got = facts.fct_order_lifecycle(stage(spark, "orders", ORDERS), star)
    first = got.filter("order_id = 'o1'").first()
    assert (first["ordered_date_key"], first["paid_date_key"], first["shipped_date_key"]) == (20240102, 20240103, None)
    assert (first["days_to_pay"], first["days_to_ship"]) == (1, None)
    assert got.count() == 2


def test_calendar_roles_share_one_broadcast(spark, star):
    got = facts.fct_order_lifecycle(stage(spark, "orders", ORDERS), star, ["date"])
    got.collect()
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReusedExchange") >= 3


def test_calendar(spark):
    got = dims.dim_date(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 2))
    assert rows(got, "date_key", "month_name", "quarter", "day_of_week", "is_weekend") == [
        (20240228, "February", 1, 4, False),
        (20240229, "February", 1, 5, False),
        (20240301, "March", 1, 6, False),
        (20240302, "March", 1, 7, True),
    ]


def test_reports_are_sorted(spark, star):
    got = sales(spark, star)
    dim_store = star.members["store"]
    assert [tuple(r) for r in analytics.revenue_by_store(got, dim_store).collect()] == [("S1", Decimal("30.00"))]
    months = analytics.revenue_by_month(got, star.date).collect()
    assert [tuple(r) for r in months] == [(2024, "January", Decimal("30.00"))]
    per_order = analytics.lines_per_order(got).first()
    assert tuple(per_order) == (4, 2, 2.0)
    flagged = analytics.flagged_by_reason(facts.flagged_payments(payments(spark), NOW)).collect()
    assert [r["count"] for r in flagged] == [2, 1]
    assert tuple(analytics.anomaly_share(payments(spark)).first()) == (3, 7, round(3 / 7, 6))


def test_top_products_uses_a_bounded_sort(spark, star):
    plan = analytics.top_products(sales(spark, star), star.members["product"], k=2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text


def test_segments_count_customers_once(spark, star):
    got = analytics.customer_segments(sales(spark, star), star.members["customer"])
    assert rows(got) == [("vip", 1, Decimal("30.00"), 10.0)]


def test_calendar_follows_the_facts(spark, frame):
    times = [(at(1), None), (dt.datetime(1985, 3, 1), at(2)), (None, dt.datetime(2041, 7, 9))]
    df = frame(times, "a timestamp, b timestamp")
    days = dims.dim_date_covering([(df, ["a", "b"]), (df.limit(0), ["a"])])
    first, last = days.agg(F.min("date_key"), F.max("date_key")).first()
    assert (first, last) == (19850301, 20410709)
    assert dims.dim_date_covering([(df.limit(0), ["a"])]).isEmpty()


def test_a_cut_calendar_prunes_the_months_of_a_stored_fact(spark, tmp_path):
    """Only partitions of the calendar's months are read, found while the query runs."""
    days = [dt.date(2024, m, d) for m in range(1, 7) for d in (1, 15)]
    calendar = dims.dim_date(spark, dt.date(2024, 1, 1), dt.date(2024, 6, 30))
    fact = spark.createDataFrame(
        [(d.year * 10000 + d.month * 100 + d.day, Decimal(10)) for d in days], "date_key int, gross_amount decimal(18,2)"
    )
    stored = pipeline.write_marts(spark, {"fct_sales": fact, "dim_date": calendar}, str(tmp_path), by_month=True)
    assert "date_month" not in stored["dim_date"].columns
    got = analytics.revenue_by_month(stored["fct_sales"], stored["dim_date"].filter("month IN (2, 5)"))
    assert [(r["month_name"], int(r["total_revenue"])) for r in got.collect()] == [("February", 20), ("May", 20)]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    scanned = got._jdf.queryExecution().executedPlan().toString()
    assert "date_month" in scanned.split("PartitionFilters: [")[1].split("]")[0]
