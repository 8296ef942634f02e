"""Landed pages, lake, warehouse, whole runs and streams."""

import datetime as dt
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stockroom.operators.bounds import get_bound
from stockroom.operators.checks import ChecksFailed
from stockroom.operators.flatten import discover_schema, flatten, split_keyed, to_payload, typed
from stockroom.operators.keyed import KeyedTable, Period
from stockroom.plans import pipeline, sync
from stockroom.plans.sync import Context, load_entity, read_lake, sync_entity
from stockroom.session import work_dir
from stockroom.sources import files
from stockroom.sources.jdbc import JdbcConfig, Ranges
from stockroom.sources.pages import read_pages, stream_pages
from stockroom.sources.registry import ENTITIES
from stockroom.sources.tables import mart_folder, read_mart, write_mart
from stockroom.streaming import ingest

from .conftest import at, rows

ORDERS = ENTITIES["orders"]


def land(root, entity, name, records=None, text=None, **meta):
    folder = root / entity
    folder.mkdir(parents=True, exist_ok=True)
    page = {"meta": meta} if records is None else {"data": records, "meta": meta}
    (folder / name).write_text(text or json.dumps(page))


def order(i, day, **more):
    return {"id": i, "updatedAt": f"2024-01-{day:02d}T00:00:00Z", "status": "paid", **more}


def test_pages_are_concatenated(spark, tmp_path):
    land(tmp_path, "orders", "1.json", [order("a", 1), order("b", 1)], has_more=True, cursor="x")
    land(tmp_path, "orders", "2.json", [order("c", 1)], has_more=True, cursor="y")
    land(tmp_path, "orders", "3.json", [order("d", 1)], has_more=False)
    land(tmp_path, "orders", "4.json", has_more=False)  # a page without data adds nothing
    land(tmp_path, "orders", "5.json", text="{not json")
    got = to_payload(read_pages(spark, str(tmp_path), ORDERS), ORDERS)
    keyed, rejected = split_keyed(got)
    assert rows(keyed, "id") == [("a",), ("b",), ("c",), ("d",)]
    assert rows(rejected, "raw_data") == [("{not json",)]


def test_pretty_printed_pages(spark, tmp_path):
    text = json.dumps({"data": [order("a", 1), order("b", 2)], "meta": {}}, indent=2)
    land(tmp_path, "orders", "1.json", text=text)
    got = read_pages(spark, str(tmp_path), ORDERS, multi_line=True)
    assert rows(to_payload(got, ORDERS), "id") == [("a",), ("b",)]


def records(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "record string")


def test_payload_key_and_time(spark):
    got = to_payload(
        records(
            spark,
            '{"id": 7, "updatedAt": "", "updated_at": "2024-01-02T00:00:00Z"}',
            '{"id": "b", "updatedAt": "2024-01-03T01:00:00+01:00", "updated_at": "2024-01-09"}',
            '{"id": null}',
            '{"name": "no key"}',
            '{"id": ""}',
        ),
        ORDERS,
    )
    keyed, rejected = split_keyed(got)
    assert rows(keyed, "id", "updated_at") == [("7", at(2)), ("b", at(3))]
    assert rejected.count() == 3


def lake(spark, *texts):
    df = records(spark, *texts).withColumnRenamed("record", "raw_data")
    return df.select(F.lit("k").alias("id"), "raw_data", F.lit(at(1)).alias("loaded_at"), F.lit(at(2)).alias("updated_at"))


def test_flatten_and_type(spark):
    text = '{"id": 1, "orderId": "o", "quantity": "3.7", "unitPrice": "2.5", "discount_pct": 5, "lineTotal": 9, "updatedAt": "x"}'
    spec = ENTITIES["order_items"]
    got = typed(flatten(lake(spark, text), spec.schema), spec.schema)
    row = got.first()
    assert (row["id"], row["order_id"], row["quantity"], row["unit_price"]) == ("1", "o", 3, 2.5)
    assert (row["discount_pct"], row["line_total"], row["updated_at"]) == (5.0, 9.0, None)
    assert row["_lake_id"] == "k"


def test_empty_payload_keeps_lineage_only(spark):
    got = typed(flatten(lake(spark, None, "{}"), ORDERS.schema), ORDERS.schema)
    assert rows(got, "_lake_id", "id", "status") == [("k", None, None)] * 2


def test_undeclared_fields(spark):
    rows_in = lake(spark, '{"id": "a", "giftWrap": true}', '{"id": "b", "note": "x", "status": "paid"}')
    evolved = flatten(rows_in, ORDERS.schema, evolve=True)
    assert {"gift_wrap", "note"} <= set(evolved.columns)
    assert rows(evolved, "gift_wrap", "note") == [(None, "x"), ("true", None)]
    found = discover_schema(rows_in)
    assert {f.name: f.dataType.simpleString() for f in found} == {
        "giftWrap": "boolean", "id": "string", "note": "string", "status": "string",
    }
    assert "gift_wrap" in flatten(rows_in).columns
    assert flatten(lake(spark, None)).columns == ["_lake_id", "_lake_loaded_at", "_lake_updated_at"]


def context(spark, tmp_path, run, **more):
    return Context(spark, str(tmp_path / "landing"), str(tmp_path / "root"), run, at(20), **more)


def test_entity_runs(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "orders", "1.json", [order("a", 1, totalAmount="5.5"), order("b", 2), {"id": None}])
    one = context(spark, tmp_path, "r1")
    assert sync_entity(one, ORDERS) is True
    assert load_entity(one, ORDERS) is True
    assert get_bound(one.bounds(), "orders") == get_bound(one.bounds("warehouse"), "orders") == at(2)
    assert rows(one.warehouse(ORDERS).read(), "id", "total_amount") == [("a", 5.5), ("b", None)]
    assert rows(spark.read.parquet(one.rejected(ORDERS)), "raw_data", "run_id") == [('{"id": null}', "r1")]

    # Repeating the run, and running again without news, changes nothing.
    for ctx in (one, context(spark, tmp_path, "r2")):
        assert sync_entity(ctx, ORDERS) is False
        assert load_entity(ctx, ORDERS) is False

    # An update, a new row, a late row; the late one needs a lookback.
    land(landing, "orders", "2.json", [order("a", 5, note="hi"), order("c", 6), order("late", 1)])
    three = context(spark, tmp_path, "r3")
    assert sync_entity(three, ORDERS) and load_entity(three, ORDERS)
    assert get_bound(three.bounds(), "orders") == at(6)
    assert rows(three.warehouse(ORDERS).read(), "id", "total_amount", "note") == [
        ("a", None, "hi"), ("b", None, None), ("c", None, None),
    ]
    four = context(spark, tmp_path, "r4", lookback=dt.timedelta(days=6))
    assert sync_entity(four, ORDERS) is False and load_entity(four, ORDERS) is True
    assert rows(four.warehouse(ORDERS).read(), "id") == [("a",), ("b",), ("c",), ("late",)]


def test_late_and_tied_records_of_new_pages_reach_the_lake(spark, tmp_path):
    """On the second run, lake and rejected records together are what has landed."""
    landing = tmp_path / "landing"
    land(landing, "orders", "1.json", [order("a", 1), order("b", 5), {"id": None}])
    sync_entity(context(spark, tmp_path, "r1"), ORDERS)
    # Late, tied with the bound, an outdated version of a known key, one that ties with it, and one without a key.
    land(landing, "orders", "2.json", [order("late", 1), order("tie", 5), order("b", 2, note="old"), order("a", 1, note="new"), {"id": None}])
    two = context(spark, tmp_path, "r2")
    assert sync_entity(two, ORDERS) is True
    lake = flatten(read_lake(two, ORDERS))
    assert rows(lake, "id", "note") == [("a", "new"), ("b", None), ("late", None), ("tie", None)]
    assert lake.count() + spark.read.parquet(two.rejected(ORDERS)).count() == 6  # keys and records without one
    land(landing, "orders", "3.json", [order("later", 1)])
    assert sync_entity(context(spark, tmp_path, "r3"), ORDERS) is True
    assert read_lake(two, ORDERS).count() == 5


def test_pages_taken_in_several_batches(spark, tmp_path):
    for k in range(5):
        land(tmp_path / "landing", "orders", f"{k}.json", [order(f"o{k}", 1 + k), order("same", 5 - k), {"id": None}])
    ctx = context(spark, tmp_path, "r1", max_files=2)
    assert sync_entity(ctx, ORDERS) is True
    assert read_lake(ctx, ORDERS).count() == 6
    assert rows(read_lake(ctx, ORDERS).filter("id = 'same'"), "updated_at") == [(at(5),)]
    assert spark.read.parquet(ctx.rejected(ORDERS)).count() == 5
    assert get_bound(ctx.bounds(), "orders") == at(5)
    assert sync_entity(ctx, ORDERS) is False


@pytest.mark.parametrize("place", ["split_keyed", "_advance"])
def test_a_batch_that_broke_off_is_taken_again(spark, tmp_path, monkeypatch, place):
    """Before the merge or after it: nothing is lost and nothing counts twice."""
    land(tmp_path / "landing", "orders", "1.json", [order("a", 1), order("b", 2), {"id": None}])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(Exception, match="lost"):
        patch.setattr(sync, place, lost)
        sync_entity(context(spark, tmp_path, "r1"), ORDERS)
    land(tmp_path / "landing", "orders", "2.json", [order("c", 3), {"id": None}])
    ctx = context(spark, tmp_path, "r2")
    assert sync_entity(ctx, ORDERS) is True
    assert rows(read_lake(ctx, ORDERS), "id") == [("a",), ("b",), ("c",)]
    assert spark.read.parquet(ctx.rejected(ORDERS)).count() == 2
    assert get_bound(ctx.bounds(), "orders") == at(3)


def test_intake_keeps_no_list_of_paths(spark, tmp_path, monkeypatch):
    """Files taken are known to the stream's own log; no path is collected."""
    land(tmp_path / "landing", "orders", "1.json", [order("a", 1)])
    ctx = context(spark, tmp_path, "r1")
    sync_entity(ctx, ORDERS)
    log = list((tmp_path / "root/lake/_intake/orders/checkpoint/sources/0").glob("[0-9]*"))
    assert len(log) == 1 and "1.json" in log[0].read_text()
    assert not (tmp_path / "root/lake/_taken").exists()
    late = read_lake(ctx, ORDERS, at(1), dt.timedelta(0))
    assert "PartitionFilters: [" in late._jdf.queryExecution().executedPlan().toString()


def test_full_and_incremental_lake_reads(spark, tmp_path):
    land(tmp_path / "landing", "orders", "1.json", [order("a", 1), order("b", 3), {"id": "timeless"}])
    ctx = context(spark, tmp_path, "r1")
    assert read_lake(ctx, ORDERS) is None and load_entity(ctx, ORDERS) is False
    sync_entity(ctx, ORDERS)
    assert read_lake(ctx, ORDERS).count() == 3
    # A record without a time is never taken for an old one.
    assert rows(read_lake(ctx, ORDERS, at(1)), "id") == [("b",), ("timeless",)]


def land_everything(root):
    t = {"createdAt": "2024-01-01", "updatedAt": "2024-01-02"}
    land(root, "stores", "1.json", [{"id": "s1", "name": "Main", "openedDate": "2020-01-01", **t}])
    land(root, "employees", "1.json", [{"id": "e1", "storeId": "s1", "firstName": "A", "lastName": "B", "isDeleted": "False", **t}])
    land(root, "payment_methods", "1.json", [{"id": "m1", "name": "Card", "isDigital": True, **t}])
    land(root, "customers", "1.json", [{"id": "c1", "segment": "vip", "isDeleted": "true", **t}])
    land(root, "products", "1.json", [{"id": "p1", "name": "P", "sellingPrice": 5, "costPrice": "3", **t}])
    sale = {"customerId": "c1", "storeId": "s1", "employeeId": "e1", "orderedAt": "2024-01-02"}
    land(root, "orders", "1.json", [{"id": "o1", "status": "paid", **sale, **t}, {"id": "o2", "status": "cancelled", **sale, **t}])
    line = {"productId": "p1", "quantity": "2", "unitPrice": "5", "lineTotal": 10}
    land(root, "order_items", "1.json", [{"id": "i1", "orderId": "o1", **line, **t}, {"id": "i2", "orderId": "o2", **line, **t}])
    pay = {"customerId": "c1", "paymentMethodId": "m1", "status": "completed", "paidAt": "2024-01-02"}
    land(root, "payments", "1.json", [
        {"id": "x1", "orderId": "o1", "amountPaid": "10", **pay, **t},
        {"id": "x2", "orderId": "o2", "amountPaid": "10", **pay, **t},
        {"id": "x3", "orderId": "o1", "amountPaid": 0, **pay, **t},
    ])
    land(root, "inventory_movements", "1.json", [{"id": "v1", "productId": "p1", "storeId": "s1", "movementType": "in", "quantity": 4, "movedAt": "2024-01-02", **t}])


def test_whole_run_twice(spark, tmp_path):
    land_everything(tmp_path / "landing")
    done = pipeline.run(context(spark, tmp_path, "r1", partition_facts=True))
    report = done.checks
    assert report.count() == 61
    assert done.row_counts["fct_sales"] == 1 and done.row_counts["dim_customer"] == 1
    sales = mart_folder(spark, str(tmp_path / "root/warehouse/marts/fct_sales"))
    assert Path(sales, "date_month=202401").is_dir()
    # The store key of a payment for a cancelled order is the one known finding.
    assert rows(report.filter("failures > 0"), "model", "column", "failures") == [("fct_payments", "store_key", 1)]
    root = tmp_path / "root" / "warehouse"
    assert read_mart(spark, f"{root}/marts/fct_sales").count() == 1
    assert read_mart(spark, f"{root}/marts/flagged_payments").count() == 1
    assert read_mart(spark, f"{root}/check_failures/fct_payments.store_key.not_null").count() == 1
    assert spark.table("stg_orders").count() == 1

    changed = {"id": "c1", "segment": "retail", "updatedAt": "2024-01-09"}
    land(tmp_path / "landing", "customers", "2.json", [changed])
    with pytest.raises(ChecksFailed, match="fct_payments.store_key not_null: 1"):
        pipeline.run(context(spark, tmp_path, "r2"), fail_on_checks=True)
    customers = read_mart(spark, f"{root}/marts/dim_customer")
    assert rows(customers, "segment", "valid_to", "is_current") == [("retail", None, True), ("vip", at(9), False)]
    joined = read_mart(spark, f"{root}/marts/fct_sales").join(customers, "customer_key")
    assert rows(joined, "segment") == [("retail",)]


def test_empty_entity_stops_a_run(spark, tmp_path):
    land_everything(tmp_path / "landing")
    land(tmp_path / "landing", "stores", "1.json", has_more=False)
    with pytest.raises(ChecksFailed, match="no rows in: stores"):
        pipeline.run(context(spark, tmp_path, "r1"))


def test_partitioned_mart(spark, tmp_path):
    df = spark.range(10).withColumn("month", F.col("id") % 2)
    path = str(tmp_path / "m")
    assert write_mart(df, path, ["month"]).count() == 10
    assert write_mart(df.filter("id < 4"), path, ["month"]).count() == 4
    assert read_mart(spark, str(tmp_path / "absent")) is None


def test_a_failed_write_leaves_the_mart_as_it_was(spark, tmp_path):
    path = str(tmp_path / "m")
    first = write_mart(spark.range(5), path)
    # Some tasks have written their files when one fails.
    broken = spark.range(0, 100, 1, 4).select(F.expr("IF(id = 99, raise_error('lost'), id)").cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_mart(broken, path)
    assert read_mart(spark, path).count() == first.count() == 5
    second = write_mart(spark.range(7), path)
    assert (first.count(), second.count()) == (5, 7)  # a reader that has begun keeps its version
    third = write_mart(read_mart(spark, path).filter("id < 3"), path)  # a mart may be made from itself
    assert (second.count(), third.count()) == (7, 3)
    assert sum(f.name.startswith("version-") for f in (tmp_path / "m").iterdir()) == 2


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "deep" / "note")
    assert files.get_text(spark, path) is None and files.folders(spark, path) == []
    for text in ("one", "", "zwei ü"):
        files.put_text(spark, path, text)
        assert files.get_text(spark, path) == text
    assert [f.name for f in (tmp_path / "deep").iterdir() if not f.name.endswith(".crc")] == ["note"]
    assert files.qualified(spark, path) == files.qualified(spark, f"file:{path}") == f"file:{path}"
    files.remove(spark, path)
    files.remove(spark, path)
    assert not files.exists(spark, path)


def test_streamed_pages(spark, tmp_path):
    landing = tmp_path / "landing"
    table = KeyedTable(spark, str(tmp_path / "lake"), ["id"], ["updated_at", "raw_data"], Period("updated_at"))

    def run():
        pages = stream_pages(spark, str(landing), ORDERS, max_files=1)
        ingest.start_ingest(
            pages, ORDERS, table, str(tmp_path / "bad"), str(tmp_path / "ck"), at(20)
        ).awaitTermination()

    land(landing, "orders", "1.json", [order("a", 1), order("b", 1), {"id": None}])
    land(landing, "orders", "2.json", [order("c", 1)])
    run()
    assert rows(table.read(), "id") == [("a",), ("b",), ("c",)]
    land(landing, "orders", "3.json", [order("a", 4)])
    run()
    run()  # nothing new
    assert rows(table.read(), "id", "updated_at") == [("a", at(4)), ("b", at(1)), ("c", at(1))]
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1


def feed_folder(spark, path, days):
    for i, day in enumerate(days):
        rows_in = [("k", f"v{day}", at(day)), (f"only{day}", "x", at(day))]
        df = spark.createDataFrame(rows_in, "k string, v string, updated_at timestamp")
        df.coalesce(1).write.mode("append").parquet(path) if i else df.coalesce(1).write.parquet(path)


def test_streamed_upsert_and_history_do_not_depend_on_order(spark, tmp_path):
    path = str(tmp_path / "feed")
    feed_folder(spark, path, [3, 1, 5, 2])
    stream = ingest.stream_table(spark, path, max_files=1)
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], ["updated_at"], Period("updated_at"), keep_newest=True)
    ingest.start_upsert(stream, table, str(tmp_path / "ck1")).awaitTermination()
    assert rows(table.read().filter("k = 'k'"), "v") == [("v5",)]
    assert table.read().count() == 5

    history = pipeline.snap_table(spark, str(tmp_path / "h"), "day")
    ingest.start_scd2(stream, history, "k", "updated_at", str(tmp_path / "ck2")).awaitTermination()
    got = history.read().filter("k = 'k'")
    assert rows(got, "v", "valid_from", "valid_to") == [
        ("v1", at(1), at(2)), ("v2", at(2), at(3)), ("v3", at(3), at(5)), ("v5", at(5), None),
    ]


def test_streamed_quarantine(spark, tmp_path):
    path = str(tmp_path / "payments")
    rows_in = [("a", 1.0, False), ("b", 0.0, True), ("c", 2.0, False)]
    spark.createDataFrame(rows_in, "payment_id string, amount double, is_anomalous boolean").write.parquet(path)
    clean, flagged = str(tmp_path / "clean"), str(tmp_path / "flagged")
    stream = ingest.stream_table(spark, path, max_files=1)
    for _ in range(2):
        ingest.start_quarantine(stream, clean, flagged, str(tmp_path / "ck")).awaitTermination()
    assert rows(ingest.read_split(spark, clean), "payment_id") == [("a",), ("c",)]
    assert rows(ingest.read_split(spark, flagged), "payment_id") == [("b",)]


def test_work_dir_follows_the_session():
    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert work_dir(session("yarn", "/shared/scratch/"), "x").startswith("/shared/scratch/stockroom/x-")
    assert "x-" in work_dir(session("local[4]", None), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session("yarn", None), "x")


def test_jdbc_options():
    cfg = JdbcConfig("db", 5432, "lake", "me", "secret")
    assert cfg.url == "jdbc:postgresql://db:5432/lake"
    assert "secret" not in repr(cfg)
    assert Ranges("id", "0", "100", 8).options()["numPartitions"] == "8"
