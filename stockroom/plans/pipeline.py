"""The whole run: sync → load → staging → history → dimensions → facts → checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.operators.checks import (
    collect_report,
    failing_rows,
    raise_on_failure,
    require_rows,
    row_counts,
    run_checks,
)
from stockroom.operators.keyed import PERIOD, KeyedTable, Period
from stockroom.operators.scd2 import open_history, open_rows, snapshot_changes
from stockroom.plans import dims as D
from stockroom.plans import facts
from stockroom.plans.staging import stage_all
from stockroom.plans.suite import CHECKS
from stockroom.plans.sync import Context, load_entity, sync_entity
from stockroom.session import shuffles_removed
from stockroom.sources.registry import ENTITIES, EntitySpec
from stockroom.sources.tables import register_views, write_mart

# Columns a history tracks.
TRACKED_CUSTOMER = (
    "customer_id",
    "first_name",
    "last_name",
    "full_name",
    "email",
    "phone",
    "address",
    "city",
    "state",
    "segment",
    "tier",
    "effective_from",
    "registered_at",
    "created_at",
    "updated_at",
    "is_deleted",
)
TRACKED_PRODUCT = (
    "product_id",
    "product_name",
    "sku",
    "category",
    "sub_category",
    "brand",
    "supplier",
    "unit_price",
    "cost_price",
    "effective_from",
    "created_at",
    "updated_at",
    "is_deleted",
)


def snap_table(spark: SparkSession, path: str, unit: str = "month") -> KeyedTable:
    """A history table clustered by the end of validity: open versions share a period of their own.

    A run rewrites the open versions and the periods in which it closes some; versions
    closed earlier stay as they lie.
    """
    return KeyedTable(
        spark,
        path,
        keys=["scd_id"],
        order=["scd_updated_at"],
        period=Period("valid_to", unit),
        sort_by=["valid_from"],
    )


def run_snapshot(
    table: KeyedTable,
    source: DataFrame,
    key: str,
    as_of: dt.datetime,
    run_id: str,
    updated_at: str = "updated_at",
) -> DataFrame:
    """Bring a history table up to date with its source and return it.

    Only opened and closed versions are written; a quiet run touches nothing.
    """
    table.finish()
    is_open = F.col(PERIOD).isNull()
    history = table.read(is_open)
    if history is None:
        changes = open_history(source, key, updated_at)
    else:
        # Rows closed at a time no calendar has lie among the open ones, too.
        closed = table.read().filter("valid_to IS NOT NULL")
        # New members, and the few that were closed and are back.
        unopened = source.select(key).join(open_rows(history).select(key), key, "left_anti")
        changes = snapshot_changes(
            open_rows(history), source, key, updated_at, as_of, closed=closed, unopened=unopened
        )
    # A version that a run closes is an open one: its id is sought among those alone.
    table.merge(changes, run_id, within=is_open)
    return table.read()


def build_dims(
    spark: SparkSession,
    stg: Mapping[str, DataFrame],
    customers: DataFrame,
    products: DataFrame,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """All dimensions from staging and the two histories, lazily.

    Without a given ``calendar`` it covers every day a fact has.
    """
    store = D.dim_store(stg["stg_stores"])
    covered = [(stg[f"stg_{name}"], times) for name, times in D.FACT_TIMES.items()]
    date = D.dim_date(spark, *calendar) if calendar else D.dim_date_covering(covered)
    return {
        "dim_store": store,
        "dim_employee": D.dim_employee(stg["stg_employees"], store),
        "dim_payment_method": D.dim_payment_method(stg["stg_payment_methods"]),
        "dim_customer": D.dim_customer(customers),
        "dim_product": D.dim_product(products),
        "dim_date": date,
    }


def fact_dims(dims: Mapping[str, DataFrame]) -> facts.Dims:
    roles = ("customer", "product", "store", "employee", "payment_method")
    return facts.Dims({r: dims[f"dim_{r}"] for r in roles}, dims["dim_date"])


def build_facts(
    stg: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], as_of: dt.datetime
) -> dict[str, DataFrame]:
    """All facts and the quarantine table, lazily."""
    keyed = fact_dims(dims)
    return {
        "fct_sales": facts.fct_sales(stg["stg_order_items"], stg["stg_orders"], keyed),
        "fct_payments": facts.fct_payments(stg["stg_payments"], stg["stg_orders"], keyed),
        "fct_inventory_daily": facts.fct_inventory_daily(stg["stg_inventory_movements"], keyed),
        "fct_order_lifecycle": facts.fct_order_lifecycle(stg["stg_orders"], keyed),
        "flagged_payments": facts.flagged_payments(stg["stg_payments"], as_of),
    }


def concurrently(spark: SparkSession, calls: Mapping[str, Callable], parallel: int = 4) -> dict:
    """Run independent driver-side steps, a few Spark jobs at a time; results by name."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        call = inheritable_thread_target(spark)(lambda step: step())
        return dict(zip(calls, pool.map(call, calls.values()), strict=True))


def write_marts(
    spark: SparkSession, models: Mapping[str, DataFrame], root: str, by_month: bool = False
) -> dict[str, DataFrame]:
    """Write models side by side; ``by_month`` partitions those that have a date key."""

    def write(name: str, df: DataFrame) -> DataFrame:
        if by_month and name.startswith("fct_") and "date_key" in df.columns:
            month = D.date_month(F.col("date_key"))
            return write_mart(df.withColumn("date_month", month), f"{root}/{name}", ["date_month"])
        return write_mart(df, f"{root}/{name}")

    return concurrently(spark, {n: partial(write, n, df) for n, df in models.items()})


def transform(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    as_of: dt.datetime,
    run_id: str,
    partition_facts: bool = False,
    calendar: tuple[dt.date, dt.date] | None = None,
) -> dict[str, DataFrame]:
    """Staging views, histories and marts from the raw tables. Returns every model."""
    stg = stage_all(raw)
    register_views(stg)

    def history(name: str, source: str, key: str, tracked: Sequence[str]) -> DataFrame:
        table = snap_table(spark, f"{root}/snapshots/{name}")
        return run_snapshot(table, stg[source].select(*tracked), key, as_of, run_id)

    histories = concurrently(
        spark,
        {
            "customers": partial(
                history, "snap_customers", "stg_customers", "customer_id", TRACKED_CUSTOMER
            ),
            "products": partial(
                history, "snap_products", "stg_products", "product_id", TRACKED_PRODUCT
            ),
        },
    )
    lazy = build_dims(spark, stg, histories["customers"], histories["products"], calendar)
    dims = write_marts(spark, lazy, f"{root}/marts")
    built = write_marts(spark, build_facts(stg, dims, as_of), f"{root}/marts", partition_facts)
    return {**stg, **dims, **built}


@dataclass(frozen=True)
class RunReport:
    """What a run found: check results, and the rows of every dimension and fact."""

    checks: DataFrame
    row_counts: dict[str, int]


def run(ctx: Context, fail_on_checks: bool = False) -> RunReport:
    """One full run. The failing rows of each check are written beside the marts.

    ``fail_on_checks`` raises when any check fails. Empty entities always do.
    """
    specs = list(ENTITIES.values())

    def for_each(step: Callable[[Context, EntitySpec], bool]) -> None:
        concurrently(ctx.spark, {s.name: partial(step, ctx, s) for s in specs}, ctx.parallel)

    for_each(sync_entity)
    require_rows({s.name: _present(ctx.lake(s)) for s in specs})
    for_each(load_entity)
    raw = {s.name: _present(ctx.warehouse(s)) for s in specs}
    require_rows(raw)

    root = f"{ctx.root}/warehouse"
    with shuffles_removed(ctx.spark):
        models = transform(
            ctx.spark, raw, root, ctx.as_of, ctx.run_id, ctx.partition_facts, ctx.calendar
        )
        checks = collect_report(ctx.spark, run_checks(models, CHECKS))
        failed = {(r["model"], r["column"], r["test"]) for r in checks.filter("failures > 0").collect()}
        for check in CHECKS:
            if (check.model, check.column, check.test) in failed:
                name = f"{check.model}.{check.column}.{check.test}"
                write_mart(failing_rows(models, check), f"{root}/check_failures/{name}")
        write_mart(checks, f"{root}/check_report")
        if fail_on_checks:
            raise_on_failure(checks)
        marts = {n: df for n, df in models.items() if not n.startswith("stg_")}
        counts = {r["entity"]: r["row_count"] for r in row_counts(marts).collect()}
        return RunReport(checks, counts)


def _present(table: KeyedTable) -> DataFrame:
    rows = table.read()
    return table.spark.createDataFrame([], "empty int") if rows is None else rows
