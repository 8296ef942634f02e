"""Every operator and model as a named query over a folder of tables.

Results leave in engine-neutral types (see :func:`portable`), so that any SQL
engine can be compared column by column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.functions.coerce import coerce_bool, coerce_decimal, coerce_int
from stockroom.functions.naming import snake_case_columns
from stockroom.functions.scalars import full_name, surrogate_key, timestamp_text, whole_days
from stockroom.operators import checks, scd2
from stockroom.operators.bounds import newer_than, next_bound, table_bound
from stockroom.operators.flatten import flatten, rows_to_records, to_payload, typed
from stockroom.operators.keyed import KeyedTable, Period, upsert
from stockroom.operators.latest import latest_by_key
from stockroom.plans import analytics, dims, facts, pipeline
from stockroom.plans.staging import STAGING
from stockroom.plans.suite import CHECKS, LIFECYCLE_STATUSES
from stockroom.plans.sync import Context, load_entity, sync_entity
from stockroom.session import configure, shuffles_removed, work_dir
from stockroom.sources.adapter import LOADED_AT, RUN_AT, Tables
from stockroom.sources.pages import land_pages, read_pages, stream_pages
from stockroom.sources.registry import ENTITIES
from stockroom.sources.tables import register_views, write_mart
from stockroom.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

HALF_TIME = dt.datetime(2024, 1, 16)
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]
LINE_COLUMNS = [*LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
FEED_COLUMNS = ["user_id", "event_type", "value", "ts"]
PAGE_SIZE = 50


def portable(df: DataFrame) -> DataFrame:
    """Decimals as double, dates and timestamps as text; one final projection."""

    def column(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            c = timestamp_text(c)
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select(*(column(f) for f in df.schema))


class Models:
    """The models over one folder, built only as far as a query asks."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.tables = Tables(spark, folder)

    def stg(self, entity: str) -> DataFrame:
        return STAGING[entity](self.tables.entity(entity))

    # Dimensions after a first run: every member has one open version.

    @cached_property
    def store(self) -> DataFrame:
        return dims.dim_store(self.stg("stores"))

    @cached_property
    def employee(self) -> DataFrame:
        return dims.dim_employee(self.stg("employees"), self.store)

    @cached_property
    def payment_method(self) -> DataFrame:
        return dims.dim_payment_method(self.stg("payment_methods"))

    @cached_property
    def customer(self) -> DataFrame:
        return dims.dim_customer(scd2.open_history(self.stg("customers"), "customer_id"))

    @cached_property
    def product(self) -> DataFrame:
        return dims.dim_product(scd2.open_history(self.stg("products"), "product_id"))

    def calendar(self, times: dict[str, Sequence[str]]) -> DataFrame:
        return dims.dim_date_covering([(self.stg(e), columns) for e, columns in times.items()])

    @cached_property
    def date(self) -> DataFrame:
        return self.calendar(dims.FACT_TIMES)

    @cached_property
    def order_date(self) -> DataFrame:
        """As much of the calendar as the sales reach."""
        return self.calendar({"orders": ["ordered_at"]})

    def keyed(self, roles, times: dict[str, Sequence[str]]) -> facts.Dims:
        members = {r: getattr(self, r) for r in roles if r != "date"}
        return facts.Dims(members, self.calendar(times) if "date" in roles else None)

    # Facts, with all their keys or only those a report reads.

    def sales(self, roles=("customer", "product", "store", "employee", "date")) -> DataFrame:
        items, orders = self.stg("order_items"), self.stg("orders")
        return facts.fct_sales(items, orders, self.keyed(roles, {"orders": ["ordered_at"]}), roles)

    def payments(self, roles=("customer", "store", "payment_method", "date")) -> DataFrame:
        payments, orders = self.stg("payments"), self.stg("orders")
        return facts.fct_payments(payments, orders, self.keyed(roles, {"payments": ["paid_at"]}), roles)

    def inventory(self, roles=("product", "store", "date")) -> DataFrame:
        movements = self.stg("inventory_movements")
        times = {"inventory_movements": ["moved_at"]}
        return facts.fct_inventory_daily(movements, self.keyed(roles, times), roles)

    def lifecycle(self, roles=("customer", "store", "employee", "date")) -> DataFrame:
        times = {"orders": dims.FACT_TIMES["orders"]}
        return facts.fct_order_lifecycle(self.stg("orders"), self.keyed(roles, times), roles)

    @property
    def flagged(self) -> DataFrame:
        return facts.flagged_payments(self.stg("payments"), RUN_AT)

    def _history(self, entity: str, versions: DataFrame, key: str) -> DataFrame:
        staged = STAGING[entity](versions).drop("loaded_at")
        return scd2.history_from_versions(staged, key)

    @cached_property
    def customer_dim(self) -> DataFrame:
        versions = self.tables.customer_versions
        return dims.dim_customer(self._history("customers", versions, "customer_id"))

    @cached_property
    def product_dim(self) -> DataFrame:
        versions = self.tables.product_versions
        return dims.dim_product(self._history("products", versions, "product_id"))


# -- scalars --------------------------------------------------------------------


def _full_name(m: Models) -> DataFrame:
    second = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    first = F.split("c_name", "#")[0]
    return m.tables.read("customer").select(
        F.col("c_custkey").alias("id"), full_name(first, second).alias("full_name")
    )


def _surrogate_key(m: Models) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("O"))
    parts = (F.col("o_orderkey"), status, timestamp_text(F.col("o_orderdate")))
    return m.tables.read("orders").select("o_orderkey", surrogate_key(*parts).alias("order_key"))


def _day_diff(m: Models) -> DataFrame:
    return m.tables.orders.select(
        F.col("id").alias("order_id"),
        whole_days(F.col("ordered_at"), F.col("shipped_at")).alias("forward"),
        whole_days(F.col("delivered_at"), F.col("ordered_at")).alias("backward"),
    )


def _event_text(cases: dict[str, Column]) -> Column:
    """A text that depends on the event type; NULL for types not named."""
    text = F.lit(None).cast("string")
    for kind, value in cases.items():
        text = F.when(F.col("event_type") == kind, value).otherwise(text)
    return text


def _coerce_bool(m: Models) -> DataFrame:
    forms = {"signup": "True", "click": "false", "view": "yes", "purchase": "TRUE"}
    text = _event_text({k: F.lit(v) for k, v in forms.items()})
    return m.tables.read("events").select("event_id", coerce_bool(text).alias("flag"))


def _coerce_decimal(m: Models) -> DataFrame:
    value = F.col("value").cast("string")
    grouped = F.concat(F.lit("1_"), F.lpad(F.col("user_id").cast("string"), 3, "0"))
    text = _event_text(
        {
            "signup": value,
            "click": F.concat(F.lit("  "), value, F.lit(" ")),
            "view": F.concat(value, F.lit("d")),
            "error": F.lit(""),
            "purchase": F.when(F.col("user_id") < 1000, grouped).otherwise(
                (F.col("user_id") + 1000).cast("string")
            ),
        }
    )
    return m.tables.read("events").select("event_id", coerce_decimal(text).alias("number"))


def _coerce_int(m: Models) -> DataFrame:
    user = F.col("user_id").cast("string")
    text = _event_text(
        {
            "signup": user,
            "click": F.concat(user, F.lit(".7")),
            "view": F.concat(user, F.lit("x")),
            "purchase": F.concat(F.lit(" +"), user),
        }
    )
    return m.tables.read("events").select(
        "event_id", coerce_int(text).alias("whole"), coerce_int(F.col("value")).alias("cut")
    )


def _event_payloads(m: Models) -> DataFrame:
    """Events as lake rows whose payload is the event's own JSON text."""
    return m.tables.read("events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("props").alias("raw_data"),
        F.col("ts").alias("loaded_at"),
        F.col("ts").alias("updated_at"),
    )


def _json_flatten(m: Models) -> DataFrame:
    schema = T.StructType.fromDDL("k bigint")
    return typed(flatten(_event_payloads(m), schema), schema).select("_lake_id", "k")


def _json_odd_fields(m: Models) -> DataFrame:
    """Payloads with a field in two letter cases, one named like a type, and fields named by values."""
    event, user = F.col("event_id").cast("string"), F.col("user_id")
    parts = (
        F.concat(F.lit('"id":"'), event, F.lit('"')),
        F.when(F.col("event_type") == "click", F.concat(F.lit('"ID":"X'), event, F.lit('"'))),
        F.when(F.col("event_type") == "error", F.concat(F.lit('"VOIDED_BY":"'), user, F.lit('"'))),
        F.concat(F.lit('"k'), user % 3, F.lit('":"'), F.col("event_type"), F.lit('"')),
    )
    payload = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    rows = m.tables.read("events").select(
        event.alias("id"), payload.alias("raw_data"), F.col("ts").alias("loaded_at"), F.col("ts").alias("updated_at")
    )
    flat = flatten(rows, T.StructType.fromDDL("id string"), evolve=True)
    return flat.select("_lake_id", "id", "voided_by", "k0", "k1", "k2")


def _payload_roundtrip(m: Models) -> DataFrame:
    """Orders serialised to JSON records, taken in as lake rows, flattened and typed again."""
    spec = ENTITIES["orders"]
    landed = to_payload(rows_to_records(m.tables.orders.drop("_lake_loaded_at")), spec)
    loaded = landed.withColumn("loaded_at", F.lit(LOADED_AT).cast("timestamp"))
    back = typed(flatten(loaded, spec.schema), spec.schema)
    columns = ("id", "status", "total_amount", "ordered_at", "shipped_at", "_lake_updated_at")
    return back.select(*columns)


def _snake_case_cols(m: Models) -> DataFrame:
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("")
    return snake_case_columns(
        m.tables.read("customer").select(
            F.col("c_custkey").alias("custKey"),
            F.col("c_name").alias("FullName"),
            F.col("c_acctbal").alias("acctBal"),
            segment.alias("mktSegment"),
            F.col("c_name").alias("mkt_segment"),
        )
    )


# -- incremental state ----------------------------------------------------------


def _lines(m: Models, status: str | None = None) -> DataFrame:
    lines = m.tables.read("lineitem")
    return lines if status is None else lines.filter(F.col("l_linestatus") == status)


def _latest_by_key(m: Models) -> DataFrame:
    return latest_by_key(_lines(m), LINE_KEYS, LINE_ORDER).select(*LINE_COLUMNS)


def _upsert_two_batches(m: Models) -> DataFrame:
    first = upsert(None, _lines(m, "O").select(*LINE_COLUMNS), LINE_KEYS, LINE_ORDER)
    return upsert(first, _lines(m, "F").select(*LINE_COLUMNS), LINE_KEYS, LINE_ORDER)


def _merge_load_evolved(m: Models) -> DataFrame:
    """A stored table merged twice; the second batch lacks one column and brings another."""
    columns = [*LINE_KEYS, *LINE_ORDER]
    path = work_dir(m.spark, "merge")
    table = KeyedTable(m.spark, path, LINE_KEYS, LINE_ORDER, Period("l_shipdate", "year"))
    table.merge(_lines(m, "O").select(*columns, "l_tax"), "first")
    table.merge(_lines(m, "F").select(*columns, "l_discount"), "second")
    return table.read()


def _since_half_time(m: Models, lookback: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    events = m.tables.read("events")
    loaded = events.filter(F.col("ts") < F.lit(str(HALF_TIME)).cast("timestamp"))
    bound = table_bound(loaded, "ts")
    return newer_than(events, "ts", bound, lookback).select("event_id", "user_id", "ts")


def _watermarks(m: Models) -> DataFrame:
    bounds = [
        m.tables.entity(name)
        .agg(next_bound(["updated_at"]).alias("last_updated_at"))
        .select(F.lit(name).alias("entity"), "last_updated_at")
        for name in ENTITIES
    ]
    union = bounds[0]
    for b in bounds[1:]:
        union = union.unionByName(b)
    return union


# -- history --------------------------------------------------------------------


def _state(m: Models, until: dt.datetime | None = None) -> DataFrame:
    """Latest event per user: the feed as a source table at one moment."""
    events = m.tables.read("events")
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(str(until)).cast("timestamp"))
    return latest_by_key(events, ["user_id"], ["ts", "event_id"]).select(*FEED_COLUMNS)


def _history(rows: DataFrame) -> DataFrame:
    return rows.select(*FEED_COLUMNS, "valid_from", "valid_to")


def _run(history: DataFrame | None, source: DataFrame) -> DataFrame:
    return scd2.snapshot(history, source, "user_id", "ts", RUN_AT)


def _scd2_bulk(m: Models) -> DataFrame:
    feed = m.tables.read("events").select(*FEED_COLUMNS)
    return _history(scd2.history_from_versions(feed, "user_id", "ts"))


def _scd2_bulk_cut(m: Models) -> DataFrame:
    """Long timelines cut into pieces, that of the NULL key among them."""
    feed = m.tables.read("events").select(
        F.nullif(F.col("user_id") % 97, F.lit(0)).alias("user_id"),
        "event_type",
        "value",
        (F.col("ts") + F.make_dt_interval(secs=F.col("event_id"))).alias("ts"),
    )
    return _history(scd2.history_from_versions(feed, "user_id", "ts", max_timeline=20))


def _snapshot_runs_stored(m: Models) -> DataFrame:
    """A stored history over four runs: first, changed, some users gone, all back at their old times."""
    table = pipeline.snap_table(m.spark, work_dir(m.spark, "snapshot"))
    later = _state(m)
    sources = (_state(m, HALF_TIME), later, later.filter("event_type <> 'error'"), later)
    for run, source in enumerate(sources):
        pipeline.run_snapshot(table, source, "user_id", RUN_AT, f"run-{run}", updated_at="ts")
    return table.read().select(*FEED_COLUMNS, "valid_from", "valid_to", "scd_id")


def _scd2_two_runs(m: Models) -> DataFrame:
    return _history(_run(_run(None, _state(m, HALF_TIME)), _state(m)))


def _after_delete(m: Models) -> DataFrame:
    """Two runs, then one whose source has lost the users that ended in an error."""
    second = _run(_run(None, _state(m, HALF_TIME)), _state(m))
    return _run(second, _state(m).filter("event_type <> 'error'"))


def _scd2_hard_delete(m: Models) -> DataFrame:
    return _history(_after_delete(m))


def _scd2_reopen(m: Models) -> DataFrame:
    return _history(_run(_after_delete(m), _state(m)))


# -- checks ---------------------------------------------------------------------


def _dq_unique(m: Models) -> DataFrame:
    items = m.stg("order_items")
    name = "stg_order_items"
    rows = checks.unique(items, "order_item_id", name)
    return rows.unionByName(checks.unique(items, "order_id", name))


def _dq_report(m: Models) -> DataFrame:
    """All checks over stored marts, as a run leaves them."""
    root = work_dir(m.spark, "warehouse")
    with shuffles_removed(m.spark):
        # Raw tables are stored ones in a run; here they are written once, not derived for each check.
        raw = {name: write_mart(m.tables.entity(name), f"{root}/raw/{name}") for name in ENTITIES}
        models = pipeline.transform(m.spark, raw, root, RUN_AT, "run-1")
        return checks.collect_report(m.spark, checks.run_checks(models, CHECKS))


def _dq_failing_rows(m: Models) -> DataFrame:
    """The rows behind a finding: payments without a store, as a run writes them beside its marts."""
    tables = {"fct_payments": m.payments(["store", "customer"])}
    check = next(c for c in CHECKS if (c.model, c.column) == ("fct_payments", "store_key"))
    return checks.failing_rows(tables, check).select("payment_key", "payment_id", "order_id")


def _revenue_first_half(m: Models) -> DataFrame:
    """Revenue of the first six months of each year, from a sales fact stored by month."""
    models = {"fct_sales": m.sales(["date"]), "dim_date": m.order_date}
    stored = pipeline.write_marts(m.spark, models, work_dir(m.spark, "marts"), by_month=True)
    return analytics.revenue_by_month(stored["fct_sales"], stored["dim_date"].filter("month <= 6"))


# -- pages and streams ----------------------------------------------------------


def _land_movements(m: Models, part: str = "true", root: str | None = None) -> str:
    """Inventory movements as landed pages, camelCase as an operational system sends them."""
    spec = ENTITIES["inventory_movements"]
    rows = m.tables.inventory_movements.filter(part).select(
        F.col("id").cast("string").alias("id"),
        F.col("product_id").alias("productId"),
        F.col("store_id").alias("storeId"),
        F.col("movement_type").alias("movementType"),
        F.col("notes").alias("notes"),
        F.col("quantity").cast("string").alias("quantity"),
        timestamp_text(F.col("moved_at")).alias("movedAt"),
        timestamp_text(F.col("updated_at")).alias("updatedAt"),
    )
    root = root or work_dir(m.spark, "landing")
    land_pages(rows, root, spec, pages=rows.count() // PAGE_SIZE + 1)
    return root


def _movements_out(lake_rows: DataFrame) -> DataFrame:
    spec = ENTITIES["inventory_movements"]
    rows = typed(flatten(lake_rows, spec.schema), spec.schema)
    return rows.select("id", "notes", "quantity", "moved_at")


def _ingest_pages(m: Models) -> DataFrame:
    spec = ENTITIES["inventory_movements"]
    records = read_pages(m.spark, _land_movements(m), spec)
    loaded = F.lit(LOADED_AT).cast("timestamp")
    return _movements_out(to_payload(records, spec).withColumn("loaded_at", loaded))


def _sync_and_load(m: Models) -> DataFrame:
    spec = ENTITIES["inventory_movements"]
    root = work_dir(m.spark, "run")
    ctx = Context(m.spark, _land_movements(m), root, "run-1", RUN_AT)
    sync_entity(ctx, spec)
    load_entity(ctx, spec)
    return ctx.warehouse(spec).read().select("id", "notes", "quantity", "moved_at")


def _two_runs(m: Models, repeat: bool = False) -> Context:
    """Two daily runs: the second reads only the pages landed since the first.

    ``repeat`` goes through each run twice under the same name.
    """
    spec = ENTITIES["inventory_movements"]
    root, landing = work_dir(m.spark, "run"), None
    for run, part in enumerate((f"moved_at < '{HALF_TIME}'", f"moved_at >= '{HALF_TIME}'")):
        landing = _land_movements(m, part, landing)
        as_of = RUN_AT - dt.timedelta(days=1 - run)
        ctx = Context(m.spark, landing, root, f"run-{run}", as_of)
        for _ in range(1 + repeat):
            sync_entity(ctx, spec)
            load_entity(ctx, spec)
    return ctx


def _sync_twice(m: Models, repeat: bool = False) -> DataFrame:
    stored = _two_runs(m, repeat).warehouse(ENTITIES["inventory_movements"]).read()
    return stored.select("id", "notes", "quantity", "moved_at")


def _bounds_two_runs(m: Models) -> DataFrame:
    return _two_runs(m).bounds().select("entity", "last_updated_at", "last_run_at")


def _staging_view(m: Models) -> DataFrame:
    """A staging model as SQL users of the session find it."""
    register_views({"stg_orders": m.stg("orders")})
    return m.spark.table("stg_orders")


def _stream_ingest(m: Models) -> DataFrame:
    spec = ENTITIES["inventory_movements"]
    root = work_dir(m.spark, "ingest")
    lake = KeyedTable(
        m.spark, f"{root}/lake", ["id"], ["updated_at", "raw_data"], Period("updated_at"), newer="updated_at"
    )
    pages = stream_pages(m.spark, _land_movements(m), spec)
    ingest.start_ingest(
        pages, spec, lake, f"{root}/rejected", f"{root}/checkpoint", RUN_AT
    ).awaitTermination()
    return _movements_out(lake.read())


def _instants(stream: DataFrame) -> DataFrame:
    local = [c for c, t in stream.dtypes if t == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in local})


def _stream_upsert(m: Models) -> DataFrame:
    root = work_dir(m.spark, "upsert")
    table = KeyedTable(
        m.spark, f"{root}/table", LINE_KEYS, LINE_ORDER, Period("l_shipdate", "year"), keep_newest=True
    )
    stream = _instants(ingest.stream_table(m.spark, m.tables.path("lineitem")))
    stream = stream.select(*LINE_COLUMNS)
    ingest.start_upsert(stream, table, f"{root}/checkpoint").awaitTermination()
    return table.read()


def _stream_scd2(m: Models) -> DataFrame:
    root = work_dir(m.spark, "scd2")
    table = pipeline.snap_table(m.spark, f"{root}/history")
    stream = _instants(ingest.stream_table(m.spark, m.tables.path("events")))
    ingest.start_scd2(
        stream.select(*FEED_COLUMNS), table, "user_id", "ts", f"{root}/checkpoint"
    ).awaitTermination()
    return _history(table.read())


def _stream_quarantine(m: Models) -> DataFrame:
    root = work_dir(m.spark, "quarantine")
    orders = _instants(ingest.stream_table(m.spark, m.tables.path("orders")))
    staged = STAGING["payments"](m.tables.payments_of(orders))
    clean, flagged = f"{root}/clean", f"{root}/flagged"
    ingest.start_quarantine(staged, clean, flagged, f"{root}/checkpoint").awaitTermination()
    sides = [
        ingest.read_split(m.spark, path).withColumn("quarantined", F.lit(value))
        for path, value in ((clean, False), (flagged, True))
    ]
    columns = ("payment_id", "amount_paid", "status", "quarantined")
    return sides[0].unionByName(sides[1]).select(*columns)


# -- registry -------------------------------------------------------------------

_PAYMENT_KEYS = ["payment_key", "date_key", "customer_key", "store_key"]

_CATALOG: dict[str, Callable[[Models], DataFrame]] = {
    **{f"stg_{name}": partial(lambda m, n: m.stg(n), n=name) for name in ENTITIES},
    "full_name": _full_name,
    "surrogate_key": _surrogate_key,
    "day_diff": _day_diff,
    "coerce_bool": _coerce_bool,
    "coerce_decimal": _coerce_decimal,
    "coerce_int": _coerce_int,
    "json_flatten": _json_flatten,
    "json_odd_fields": _json_odd_fields,
    "payload_roundtrip": _payload_roundtrip,
    "snake_case_cols": _snake_case_cols,
    "latest_by_key": _latest_by_key,
    "upsert_two_batches": _upsert_two_batches,
    "merge_load_evolved": _merge_load_evolved,
    "incremental_scan": _since_half_time,
    "late_lookback": lambda m: _since_half_time(m, dt.timedelta(days=3)),
    "watermark_per_entity": _watermarks,
    "scd2_bulk": _scd2_bulk,
    "scd2_two_runs": _scd2_two_runs,
    "scd2_hard_delete": _scd2_hard_delete,
    "scd2_reopen": _scd2_reopen,
    "scd2_bulk_cut": _scd2_bulk_cut,
    "snapshot_runs_stored": _snapshot_runs_stored,
    "dim_customer": lambda m: m.customer_dim,
    "dim_product": lambda m: m.product_dim,
    "dim_store": lambda m: m.store,
    "dim_employee": lambda m: m.employee,
    "dim_payment_method": lambda m: m.payment_method,
    "dim_date": lambda m: m.date,
    "fct_sales": lambda m: m.sales(),
    "fct_payments": lambda m: m.payments(),
    "fct_inventory_daily": lambda m: m.inventory(),
    "fct_order_lifecycle": lambda m: m.lifecycle(),
    "flagged_payments": lambda m: m.flagged,
    "dq_not_null": lambda m: checks.not_null(
        m.payments(["customer", "store", "date"]), _PAYMENT_KEYS, "fct_payments"
    ),
    "dq_unique": _dq_unique,
    "dq_relationships": lambda m: checks.relationships(
        m.stg("orders"), "store_id", m.stg("stores"), "store_id", "stg_orders"
    ),
    "dq_accepted_values": lambda m: checks.accepted_values(
        m.tables.orders, "status", LIFECYCLE_STATUSES, "orders"
    ),
    "dq_row_counts": lambda m: checks.row_counts({n: m.tables.entity(n) for n in ENTITIES}),
    "dq_report": _dq_report,
    "dq_failing_rows": _dq_failing_rows,
    "revenue_by_store": lambda m: analytics.revenue_by_store(m.sales(["store"]), m.store),
    "top_products": lambda m: analytics.top_products(m.sales(["product"]), m.product),
    "revenue_by_month": lambda m: analytics.revenue_by_month(m.sales(["date"]), m.order_date),
    "revenue_first_half": _revenue_first_half,
    "customer_segments": lambda m: analytics.customer_segments(
        m.sales(["customer"]), m.customer
    ),
    "payment_methods": lambda m: analytics.payment_methods(
        m.payments(["payment_method"]), m.payment_method
    ),
    "flagged_by_reason": lambda m: analytics.flagged_by_reason(m.flagged),
    "lifecycle_metrics": lambda m: analytics.lifecycle_metrics(m.lifecycle([])),
    "revenue_by_category": lambda m: analytics.revenue_by_category(
        m.sales(["product"]), m.product
    ),
    "best_months": lambda m: analytics.best_months(m.sales(["date"]), m.order_date),
    "lines_per_order": lambda m: analytics.lines_per_order(m.sales([])),
    "anomaly_share": lambda m: analytics.anomaly_share(m.stg("payments")),
    "discount_by_product": lambda m: analytics.discount_by_product(
        m.sales(["product"]), m.product
    ),
    "quality_summary": lambda m: analytics.quality_summary(m.flagged, m.customer_dim, m.product_dim),
    "ingest_pages": _ingest_pages,
    "sync_and_load": _sync_and_load,
    "sync_twice": _sync_twice,
    "sync_repeated": partial(_sync_twice, repeat=True),
    "bounds_two_runs": _bounds_two_runs,
    "staging_view": _staging_view,
    "stream_ingest": _stream_ingest,
    "stream_upsert": _stream_upsert,
    "stream_scd2": _stream_scd2,
    "stream_quarantine": _stream_quarantine,
}


def _query(build: Callable[[Models], DataFrame], spark: SparkSession, folder: str) -> DataFrame:
    return portable(build(Models(configure(spark), folder)))


def queries() -> dict[str, Query]:
    return {name: partial(_query, build) for name, build in _CATALOG.items()}
