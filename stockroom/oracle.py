"""The same results stated in SQL, for comparison by an independent engine.

Texts are assembled from named common table expressions. Nothing here is used
by the library itself. Columns leave in engine-neutral types: money as double,
dates and timestamps as text.
"""

from __future__ import annotations

import re

# -- text helpers -------------------------------------------------------------

_NULL_PART = "'_dbt_utils_surrogate_key_null_'"


def _key(*parts: str) -> str:
    texts = [f"COALESCE(CAST({p} AS VARCHAR), {_NULL_PART})" for p in parts]
    return "md5(" + " || '-' || ".join(texts) + ")"


def _stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def _out(source: str, columns: str) -> str:
    """``name`` as is, ``name:d`` as double, ``name:s`` as text, ``name:t`` as timestamp text."""
    forms = {
        "": "{0}",
        "d": "CAST({0} AS DOUBLE) AS {0}",
        "s": "CAST({0} AS VARCHAR) AS {0}",
        "t": _stamp("{0}") + " AS {0}",
    }
    items = [c.partition(":") for c in columns.split()]
    return "SELECT " + ", ".join(forms[f].format(n) for n, _, f in items) + f" FROM {source}"


def _with(body: str) -> str:
    """Prefix a query by the expressions it names, and those they name in turn."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[esdfx]_\w+\b", text)):
            if word in CTES and word not in needed:
                visit(CTES[word])
                needed.append(word)

    visit(body)
    ctes = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in needed)
    return f"WITH {ctes}\n{body}" if ctes else body


# -- entities -------------------------------------------------------------------

_LOADED = "TIMESTAMP '2024-02-01 00:00:00'"
_EPOCH = "TIMESTAMP '1994-01-01 00:00:00'"
_MAIL = "lower(replace({0}, '#', '.')) || '@example.com'"


def _stamps(created: str, updated: str) -> str:
    return f"{created} AS created_at, {updated} AS updated_at, {_LOADED} AS loaded_at"


def _customer(tier: str, deleted: str, updated: str) -> str:
    return f"""
    c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
    {_MAIL.format("c_name")} AS email, '+' || CAST(c_nationkey AS VARCHAR) AS phone,
    n_name || ', ' || r_name AS address, n_name AS city, r_name AS state,
    c_mktsegment AS segment, {tier} AS tier, {updated} AS effective_from,
    {_EPOCH} AS registered_at, {deleted} AS is_deleted, {_stamps(_EPOCH, updated)}"""


def _product(price: str, updated: str) -> str:
    return f"""
    p_partkey AS product_id, p_name AS product_name, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
    p_type AS category, CAST(p_size AS VARCHAR) AS sub_category, p_brand AS brand,
    p_brand AS supplier, CAST({price} AS DECIMAL(10,2)) AS unit_price,
    CAST(CAST({price} AS DECIMAL(12,2)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS cost_price,
    {updated} AS effective_from, false AS is_deleted, {_stamps(_EPOCH, updated)}"""


_PLACES = "LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"

CTES: dict[str, str] = {
    # staging
    "s_stores": f"""
    SELECT n_nationkey AS store_id, n_name AS store_name, n_name AS city, r_name AS state,
      n_name || ', ' || r_name AS address, '+' || CAST(n_nationkey AS VARCHAR) AS phone,
      'Manager ' || n_name AS manager_name, DATE '1994-01-01' + n_nationkey AS opened_date,
      {_stamps(_EPOCH, _EPOCH)}
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "s_employees": f"""
    SELECT s_suppkey AS employee_id, s_nationkey AS store_id,
      split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
      split_part(s_name, '#', 1) || ' ' || split_part(s_name, '#', 2) AS full_name,
      {_MAIL.format("s_name")} AS email,
      CASE WHEN s_acctbal >= 5000 THEN 'manager' ELSE 'clerk' END AS role,
      DATE '1994-01-01' + s_nationkey AS hired_date, s_acctbal < 0 AS is_deleted,
      {_stamps(_EPOCH, _EPOCH)}
    FROM supplier""",
    "s_payment_methods": f"""
    SELECT DISTINCT substr(o_orderpriority, 1, 1) AS payment_method_id,
      substr(o_orderpriority, 3) AS method_name, 'house' AS provider,
      substr(o_orderpriority, 1, 1) <> '5' AS is_digital, {_stamps(_EPOCH, _EPOCH)}
    FROM orders""",
    "e_customer": "SELECT *, TIMESTAMP '2023-01-01 00:00:00' + to_days(c_nationkey) AS first_known FROM customer",
    "s_customers": f"""
    SELECT {_customer("CASE WHEN c_acctbal >= 5000 THEN 'gold' ELSE 'silver' END", "c_acctbal < 0", "first_known")}
    FROM e_customer {_PLACES}""",
    "x_customer_versions": f"""
    SELECT * FROM s_customers UNION ALL
    SELECT {_customer("event_type", "event_type = 'error'", "ts")}
    FROM events JOIN customer ON user_id = c_custkey {_PLACES}""",
    "s_products": f"SELECT {_product('p_retailprice', _EPOCH)} FROM part",
    "x_product_prices": """
    SELECT l_partkey, l_shipdate, MAX(l_extendedprice) AS price FROM lineitem
    GROUP BY l_partkey, l_shipdate""",
    "x_product_versions": f"""
    SELECT * FROM s_products UNION ALL
    SELECT {_product('price', 'l_shipdate')} FROM x_product_prices JOIN part ON l_partkey = p_partkey""",
    "e_lines": """
    SELECT l_orderkey, MIN(l_suppkey) AS employee, MIN(l_shipdate) AS first_shipped
    FROM lineitem GROUP BY l_orderkey""",
    "e_orders": f"""
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
      CASE WHEN o_orderkey % 26 = 0 THEN 25 ELSE c_nationkey END AS store_id,
      employee AS employee_id,
      CASE WHEN o_orderkey % 10 = 0 THEN 'cancelled' WHEN o_orderstatus = 'O' THEN 'pending'
        WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderkey % 2 = 0 THEN 'paid'
        ELSE 'shipped' END AS status,
      o_orderpriority AS discount_code, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
      CAST(o_orderkey % 100 AS DECIMAL(10,2)) AS discount_amount, o_orderdate AS ordered_at,
      CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER))
        + to_hours(o_orderkey % 24) END AS paid_at,
      CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 1)
        THEN first_shipped END AS shipped_at,
      CASE WHEN o_orderstatus = 'F' THEN first_shipped
        + to_days(CAST(o_custkey % 7 AS INTEGER)) + to_hours(36) END AS delivered_at,
      CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate END AS cancelled_at,
      {_stamps("o_orderdate", "o_orderdate")}
    FROM orders LEFT JOIN e_lines ON o_orderkey = l_orderkey
      LEFT JOIN customer ON o_custkey = c_custkey""",
    "s_orders": "SELECT * FROM e_orders WHERE status <> 'cancelled'",
    "s_order_items": f"""
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
        || strftime(l_shipdate, '%Y-%m-%d') AS order_item_id,
      l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
      CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
      CAST(round(l_discount * 100) AS DECIMAL(5,2)) AS discount_pct,
      CAST(l_extendedprice AS DECIMAL(10,2)) AS line_total, {_stamps("l_shipdate", "l_shipdate")}
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
    "e_payments": f"""
    SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS customer_id,
      substr(o_orderpriority, 1, 1) AS payment_method_id,
      CASE WHEN o_orderkey % 34 = 0 THEN 'refunded' ELSE 'completed' END AS status,
      'order' AS payment_type, 'USD' AS currency,
      'PAY-' || CAST(o_orderkey AS VARCHAR) AS reference,
      CAST(CASE WHEN o_orderkey % 25 = 0 THEN 0 WHEN o_orderkey % 17 = 0 THEN -o_totalprice
        ELSE o_totalprice END AS DECIMAL(10,2)) AS amount_paid,
      o_orderdate AS paid_at, {_stamps("o_orderdate", "o_orderdate")}
    FROM orders""",
    "s_payments": """
    SELECT *, amount_paid < 0 AND status = 'refunded' AS is_refund,
      amount_paid = 0 OR (amount_paid < 0 AND status <> 'refunded') AS is_anomalous
    FROM e_payments""",
    "s_inventory_movements": f"""
    SELECT event_id AS movement_id, user_id AS product_id, event_id % 26 AS store_id,
      CASE event_type WHEN 'signup' THEN 'in' WHEN 'purchase' THEN 'out' ELSE event_type END
        AS movement_type,
      'event' AS reference_type, CAST(event_id AS VARCHAR) AS reference_id, props AS notes,
      CAST(floor(value) AS INTEGER) AS quantity, ts AS moved_at, {_stamps("ts", "ts")}
    FROM events""",
    # dimensions
    "d_store": f"SELECT {_key('store_id')} AS store_key, * FROM s_stores",
    "d_employee": f"""
    SELECT {_key('employee_id')} AS employee_key, s_employees.*, store_key
    FROM s_employees LEFT JOIN d_store USING (store_id)""",
    "d_payment_method": f"SELECT {_key('payment_method_id')} AS payment_method_key, * FROM s_payment_methods",
    "d_customer": f"SELECT {_key('customer_id', _stamp('updated_at'))} AS customer_key, * FROM s_customers",
    "d_product": f"SELECT {_key('product_id', _stamp('updated_at'))} AS product_key, * FROM s_products",
    "x_customer_history": """
    SELECT *, updated_at AS valid_from,
      LEAD(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to
    FROM x_customer_versions""",
    "x_product_history": """
    SELECT *, updated_at AS valid_from,
      LEAD(updated_at) OVER (PARTITION BY product_id ORDER BY updated_at) AS valid_to
    FROM x_product_versions""",
    "d_date": """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
      CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
      CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
      dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(date_trunc('day', MIN(t)), date_trunc('day', MAX(t)), INTERVAL 1 DAY)) AS d
      FROM (SELECT unnest([ordered_at, paid_at, shipped_at, delivered_at]) AS t FROM s_orders
        UNION ALL SELECT paid_at FROM s_payments UNION ALL SELECT moved_at FROM s_inventory_movements))""",
    # facts
    "f_sales": f"""
    SELECT {_key('i.order_item_id')} AS sales_key, i.order_item_id, i.order_id, dd.date_key,
      c.customer_key, p.product_key, s.store_key, e.employee_key, i.quantity, i.unit_price,
      i.discount_pct, i.line_total AS gross_amount,
      CAST(i.line_total * (100 - i.discount_pct) / 100 AS DECIMAL(18,6)) AS net_amount,
      CAST(i.line_total - i.unit_price * i.quantity AS DECIMAL(18,2)) AS discount_amount
    FROM s_order_items i JOIN s_orders o ON i.order_id = o.order_id
      LEFT JOIN d_customer c ON o.customer_id = c.customer_id
      LEFT JOIN d_product p ON i.product_id = p.product_id
      LEFT JOIN d_store s ON o.store_id = s.store_id
      LEFT JOIN d_employee e ON o.employee_id = e.employee_id
      LEFT JOIN d_date dd ON CAST(o.ordered_at AS DATE) = dd.full_date""",
    "f_payments": f"""
    SELECT {_key('p.payment_id')} AS payment_key, p.payment_id, p.order_id, dd.date_key,
      c.customer_key, s.store_key, m.payment_method_key, p.amount_paid, p.is_refund, p.status,
      p.payment_type, p.currency, p.reference
    FROM s_payments p LEFT JOIN s_orders o ON p.order_id = o.order_id
      LEFT JOIN d_customer c ON p.customer_id = c.customer_id
      LEFT JOIN d_store s ON o.store_id = s.store_id
      LEFT JOIN d_payment_method m ON p.payment_method_id = m.payment_method_id
      LEFT JOIN d_date dd ON CAST(p.paid_at AS DATE) = dd.full_date
    WHERE NOT p.is_anomalous""",
    "f_flagged": f"""
    SELECT {_key('payment_id')} AS flagged_payment_key, *,
      CASE WHEN amount_paid = 0 THEN 'Zero amount payment'
        WHEN amount_paid < 0 AND status <> 'refunded' THEN 'Unexplained negative amount'
        ELSE 'Unknown anomaly' END AS flag_reason,
      TIMESTAMP '2024-02-01 00:00:00' AS flagged_at
    FROM s_payments WHERE is_anomalous""",
    "x_daily": """
    SELECT product_id, store_id, CAST(moved_at AS DATE) AS movement_date,
      CAST(SUM(CASE WHEN movement_type = 'in' THEN quantity ELSE 0 END) AS BIGINT) AS stock_in,
      CAST(SUM(CASE WHEN movement_type = 'out' THEN quantity ELSE 0 END) AS BIGINT) AS stock_out
    FROM s_inventory_movements GROUP BY ALL""",
    "f_inventory": f"""
    SELECT {_key('m.product_id', 'm.store_id', 'm.movement_date')} AS inventory_key, dd.date_key,
      p.product_key, s.store_key, stock_in, stock_out, stock_in - stock_out AS net_movement
    FROM x_daily m LEFT JOIN d_product p ON m.product_id = p.product_id
      LEFT JOIN d_store s ON m.store_id = s.store_id
      LEFT JOIN d_date dd ON m.movement_date = dd.full_date""",
    "f_lifecycle": f"""
    SELECT {_key('o.order_id')} AS lifecycle_key, o.order_id, c.customer_key, s.store_key,
      e.employee_key, d1.date_key AS ordered_date_key, d2.date_key AS paid_date_key,
      d3.date_key AS shipped_date_key, d4.date_key AS delivered_date_key,
      o.status AS current_status, o.total_amount, o.discount_amount,
      CAST(extract(day FROM (paid_at - ordered_at)) AS INTEGER) AS days_to_pay,
      CAST(extract(day FROM (shipped_at - paid_at)) AS INTEGER) AS days_to_ship,
      CAST(extract(day FROM (delivered_at - shipped_at)) AS INTEGER) AS days_to_deliver,
      ordered_at, paid_at, shipped_at, delivered_at
    FROM s_orders o LEFT JOIN d_customer c ON o.customer_id = c.customer_id
      LEFT JOIN d_store s ON o.store_id = s.store_id
      LEFT JOIN d_employee e ON o.employee_id = e.employee_id
      LEFT JOIN d_date d1 ON CAST(o.ordered_at AS DATE) = d1.full_date
      LEFT JOIN d_date d2 ON CAST(o.paid_at AS DATE) = d2.full_date
      LEFT JOIN d_date d3 ON CAST(o.shipped_at AS DATE) = d3.full_date
      LEFT JOIN d_date d4 ON CAST(o.delivered_at AS DATE) = d4.full_date""",
    # state of the event feed at two points in time
    "x_state1": """
    SELECT user_id, event_type, value, ts FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00') WHERE r = 1""",
    "x_state2": """
    SELECT user_id, event_type, value, ts FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
      FROM events) WHERE r = 1""",
    "x_history2": """
    SELECT a.user_id, a.event_type, a.value, a.ts, a.ts AS valid_from,
      CASE WHEN b.ts > a.ts THEN b.ts END AS valid_to
    FROM x_state1 a LEFT JOIN x_state2 b ON a.user_id = b.user_id
    UNION ALL
    SELECT b.user_id, b.event_type, b.value, b.ts, b.ts, NULL
    FROM x_state2 b LEFT JOIN x_state1 a ON a.user_id = b.user_id
    WHERE a.user_id IS NULL OR b.ts > a.ts""",
    "x_bulk": """
    SELECT user_id, event_type, value, ts, ts AS valid_from,
      LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events""",
    "x_latest": """
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS r FROM lineitem) WHERE r = 1""",
    "x_latest_by_status": """
    SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_linestatus, l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS r
      FROM lineitem) WHERE r = 1""",
    "x_half": "SELECT MAX(ts) AS bound FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'",
}


# -- column lists ---------------------------------------------------------------

_TAIL = "created_at:t updated_at:t loaded_at:t"
_HISTORY = "user_id event_type value ts:t valid_from:t valid_to:t"
_LINE = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_shipdate:t"
_STAGED = {
    "stg_stores": f"store_id store_name city state address phone manager_name opened_date:s {_TAIL}",
    "stg_employees": "employee_id store_id first_name last_name full_name email role hired_date:s "
    f"is_deleted {_TAIL}",
    "stg_payment_methods": f"payment_method_id method_name provider is_digital {_TAIL}",
    "stg_customers": "customer_id first_name last_name full_name email phone address city state "
    f"segment tier effective_from:t registered_at:t is_deleted {_TAIL}",
    "stg_products": "product_id product_name sku category sub_category brand supplier unit_price:d "
    f"cost_price:d effective_from:t is_deleted {_TAIL}",
    "stg_orders": "order_id customer_id store_id employee_id status discount_code total_amount:d "
    f"discount_amount:d ordered_at:t paid_at:t shipped_at:t delivered_at:t cancelled_at:t {_TAIL}",
    "stg_order_items": "order_item_id order_id product_id quantity unit_price:d discount_pct:d "
    f"line_total:d {_TAIL}",
    "stg_payments": "payment_id order_id customer_id payment_method_id status payment_type currency "
    f"reference amount_paid:d is_refund is_anomalous paid_at:t {_TAIL}",
    "stg_inventory_movements": "movement_id product_id store_id movement_type reference_type "
    f"reference_id notes quantity moved_at:t {_TAIL}",
}


def _history_dim(history: str, key: str, natural: str, columns: str, extra: str = "") -> str:
    inner = f"""(SELECT {_key(natural, _stamp("valid_from"))} AS {key}, *{extra},
      valid_to IS NULL AS is_current FROM {history})"""
    return _with(_out(inner, f"{key} {natural} {columns}"))


def _not_null(model: str, table: str, *columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS \"column\", 'not_null' AS test, "
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}"
        for c in columns
    )


def _unique(model: str, table: str, column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'unique' AS test, "
        f"COUNT(*) AS failures FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING COUNT(*) > 1)"
    )


def _orphans(model: str, child: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'relationships' AS test, "
        f"COUNT(*) AS failures FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} p WHERE p.{parent_column} = c.{column})"
    )


def _unaccepted(model: str, table: str, column: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", 'accepted_values' AS test, "
        f"COUNT(DISTINCT {column}) AS failures FROM {table} "
        f"WHERE {column} NOT IN ('pending', 'paid', 'shipped', 'delivered')"
    )


# Model, its table here, the column that identifies a row, further columns that must be filled:
# stated apart from the library's own list, so that a check missing there shows.
_EXPECTED = (
    ("stg_stores", "s_stores", "store_id", ""),
    ("stg_employees", "s_employees", "employee_id", ""),
    ("stg_payment_methods", "s_payment_methods", "payment_method_id", ""),
    ("stg_customers", "s_customers", "customer_id", ""),
    ("stg_products", "s_products", "product_id", ""),
    ("stg_orders", "s_orders", "order_id", ""),
    ("stg_order_items", "s_order_items", "order_item_id", ""),
    ("stg_payments", "s_payments", "payment_id", ""),
    ("stg_inventory_movements", "s_inventory_movements", "movement_id", ""),
    ("dim_store", "d_store", "store_key", "store_id"),
    ("dim_employee", "d_employee", "employee_key", "store_key"),
    ("dim_payment_method", "d_payment_method", "payment_method_key", ""),
    ("dim_customer", "d_customer", "customer_key", "customer_id"),
    ("dim_product", "d_product", "product_key", "product_id"),
    ("fct_sales", "f_sales", "sales_key", "date_key customer_key product_key store_key gross_amount"),
    ("fct_payments", "f_payments", "payment_key", "date_key customer_key store_key amount_paid"),
    ("fct_inventory_daily", "f_inventory", "inventory_key", "date_key product_key store_key"),
    ("fct_order_lifecycle", "f_lifecycle", "lifecycle_key", "ordered_date_key customer_key store_key current_status"),
    ("flagged_payments", "f_flagged", "flagged_payment_key", "flag_reason"),
)


def _suite() -> str:
    parts = [_not_null(model, table, key, *filled.split()) for model, table, key, filled in _EXPECTED]
    parts += [_unique(model, table, key) for model, table, key, _ in _EXPECTED]
    parts.append(_orphans("dim_employee", "d_employee", "store_key", "d_store", "store_key"))
    parts.append(_unaccepted("fct_order_lifecycle", "f_lifecycle", "current_status"))
    union = " UNION ALL ".join(parts)
    status = "CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status"
    return _with(f"SELECT *, {status} FROM ({union})")


_FIELD = "CASE event_type {0} END"
_BOOL_TEXT = _FIELD.format(
    "WHEN 'signup' THEN 'True' WHEN 'click' THEN 'false' WHEN 'view' THEN 'yes' "
    "WHEN 'purchase' THEN 'TRUE'"
)


def oracle_sql() -> dict[str, str]:
    """SQL text per registered query."""
    total = "CAST(CAST(SUM({0}) AS DECIMAL(20,2)) AS DOUBLE) AS {1}"
    mean = "round(CAST(SUM({0}) AS DOUBLE) / COUNT({0}), 6) AS {1}"
    sales_store = "f_sales JOIN d_store USING (store_key)"
    sales_product = "f_sales JOIN d_product USING (product_key)"
    sales_date = "f_sales JOIN d_date USING (date_key)"
    bodies = {
        **{k: _out(k.replace("stg_", "s_"), c) for k, c in _STAGED.items()},
        # scalars
        "full_name": "SELECT c_custkey AS id, split_part(c_name, '#', 1) || ' ' || "
        "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS full_name FROM customer",
        "surrogate_key": "SELECT o_orderkey, "
        + _key("o_orderkey", "nullif(o_orderstatus, 'O')", _stamp("o_orderdate"))
        + " AS order_key FROM orders",
        "day_diff": "SELECT order_id, CAST(extract(day FROM (shipped_at - ordered_at)) AS INTEGER) "
        "AS forward, CAST(extract(day FROM (ordered_at - delivered_at)) AS INTEGER) AS backward "
        "FROM e_orders",
        "coerce_bool": f"SELECT event_id, lower({_BOOL_TEXT}) = 'true' AS flag FROM events",
        "coerce_decimal": "SELECT event_id, CASE event_type WHEN 'signup' THEN value "
        "WHEN 'click' THEN value WHEN 'purchase' THEN 1000.0 + user_id END AS number FROM events",
        "coerce_int": "SELECT event_id, CASE WHEN event_type IN ('signup', 'purchase') THEN "
        "CAST(user_id AS BIGINT) END AS whole, CAST(trunc(value) AS BIGINT) AS cut FROM events",
        "json_flatten": "SELECT CAST(event_id AS VARCHAR) AS _lake_id, "
        "CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
        "payload_roundtrip": "SELECT CAST(order_id AS VARCHAR) AS id, status, "
        "CAST(total_amount AS DOUBLE) AS total_amount, "
        + ", ".join(
            f"{_stamp(c)} AS {a}"
            for c, a in (
                ("ordered_at", "ordered_at"),
                ("shipped_at", "shipped_at"),
                ("updated_at", "_lake_updated_at"),
            )
        )
        + " FROM e_orders",
        "snake_case_cols": "SELECT c_custkey AS cust_key, c_name AS full_name, c_acctbal AS acct_bal, "
        "COALESCE(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, c_name) AS mkt_segment FROM customer",
        # state
        "latest_by_key": _out("x_latest", _LINE),
        "upsert_two_batches": _out("x_latest_by_status", _LINE),
        "merge_load_evolved": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        f"{_stamp('l_shipdate')} AS l_shipdate, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax, "
        "CASE WHEN l_linestatus = 'F' THEN l_discount END AS l_discount FROM x_latest_by_status",
        "incremental_scan": _out(
            "(SELECT event_id, user_id, ts FROM events, x_half WHERE ts > bound)",
            "event_id user_id ts:t",
        ),
        "late_lookback": _out(
            "(SELECT event_id, user_id, ts FROM events, x_half WHERE ts > bound - INTERVAL 3 DAY)",
            "event_id user_id ts:t",
        ),
        "watermark_per_entity": " UNION ALL ".join(
            f"SELECT '{n}' AS entity, {_stamp('MAX(updated_at)')} AS last_updated_at FROM {t}"
            for n, t in (
                ("stores", "s_stores"),
                ("employees", "s_employees"),
                ("payment_methods", "s_payment_methods"),
                ("customers", "s_customers"),
                ("products", "s_products"),
                ("orders", "e_orders"),
                ("order_items", "s_order_items"),
                ("payments", "e_payments"),
                ("inventory_movements", "s_inventory_movements"),
            )
        ),
        # snapshots
        "scd2_bulk": _out("x_bulk", _HISTORY),
        "scd2_two_runs": _out("x_history2", _HISTORY),
        "scd2_hard_delete": _out(
            "(SELECT a.* REPLACE (CASE WHEN b.user_id IS NOT NULL AND b.event_type = 'error' AND a.valid_to "
            "IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE a.valid_to END AS valid_to) "
            "FROM x_history2 a LEFT JOIN x_state2 b ON a.user_id = b.user_id)",
            _HISTORY,
        ),
        "scd2_reopen": _out(
            "(SELECT a.* REPLACE (CASE WHEN b.event_type = 'error' AND a.valid_to "
            "IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE a.valid_to END AS valid_to) "
            "FROM x_history2 a LEFT JOIN x_state2 b ON a.user_id = b.user_id "
            "UNION ALL SELECT user_id, event_type, value, ts, "
            "greatest(ts, TIMESTAMP '2024-02-01 00:00:00'), NULL FROM x_state2 "
            "WHERE event_type = 'error')",
            _HISTORY,
        ),
        "scd2_bulk_cut": _out(
            "(SELECT *, ts AS valid_from, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to "
            "FROM (SELECT nullif(user_id % 97, 0) AS user_id, event_type, value, ts + to_seconds(event_id) AS ts "
            "FROM events))",
            _HISTORY,
        ),
        "snapshot_runs_stored": _out(
            f"""(SELECT *, md5(CAST(user_id AS VARCHAR) || '|' || {_stamp("valid_from")}) AS scd_id FROM
            (SELECT a.* REPLACE (CASE WHEN b.event_type = 'error' AND a.valid_to
            IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE a.valid_to END AS valid_to)
            FROM x_history2 a LEFT JOIN x_state2 b ON a.user_id = b.user_id
            UNION ALL SELECT user_id, event_type, value, ts,
            greatest(ts, TIMESTAMP '2024-02-01 00:00:00'), NULL FROM x_state2
            WHERE event_type = 'error'))""",
            _HISTORY + " scd_id",
        ),
        # dimensions
        "dim_store": _out("d_store", "store_key " + _STAGED["stg_stores"].replace(" loaded_at:t", "")),
        "dim_employee": _out(
            "d_employee",
            "employee_key store_key "
            + _STAGED["stg_employees"].replace(" loaded_at:t", "").replace(" store_id", ""),
        ),
        "dim_payment_method": _out(
            "d_payment_method",
            "payment_method_key " + _STAGED["stg_payment_methods"].replace(" loaded_at:t", ""),
        ),
        "dim_date": _out(
            "d_date",
            "date_key full_date:s year quarter month month_name day day_of_week is_weekend",
        ),
        # facts
        "fct_sales": _out(
            "f_sales",
            "sales_key order_item_id order_id date_key customer_key product_key store_key "
            "employee_key quantity unit_price:d discount_pct:d gross_amount:d net_amount:d "
            "discount_amount:d",
        ),
        "fct_payments": _out(
            "f_payments",
            "payment_key payment_id order_id date_key customer_key store_key payment_method_key "
            "amount_paid:d is_refund status payment_type currency reference",
        ),
        "fct_inventory_daily": _out(
            "f_inventory",
            "inventory_key date_key product_key store_key stock_in stock_out net_movement",
        ),
        "fct_order_lifecycle": _out(
            "f_lifecycle",
            "lifecycle_key order_id customer_key store_key employee_key ordered_date_key "
            "paid_date_key shipped_date_key delivered_date_key current_status total_amount:d "
            "discount_amount:d days_to_pay days_to_ship days_to_deliver ordered_at:t paid_at:t "
            "shipped_at:t delivered_at:t",
        ),
        "flagged_payments": _out(
            "f_flagged",
            "flagged_payment_key payment_id order_id customer_id payment_method_id amount_paid:d "
            "flag_reason status payment_type currency paid_at:t created_at:t updated_at:t flagged_at:t",
        ),
        # checks
        "dq_not_null": _not_null(
            "fct_payments", "f_payments", "payment_key", "date_key", "customer_key", "store_key"
        ),
        "dq_unique": _unique("stg_order_items", "s_order_items", "order_item_id")
        + " UNION ALL "
        + _unique("stg_order_items", "s_order_items", "order_id"),
        "dq_relationships": _orphans("stg_orders", "s_orders", "store_id", "s_stores", "store_id"),
        "dq_accepted_values": _unaccepted("orders", "e_orders", "status"),
        "dq_row_counts": " UNION ALL ".join(
            f"SELECT '{n}' AS entity, COUNT(*) AS row_count FROM {t}"
            for n, t in (
                ("stores", "s_stores"),
                ("employees", "s_employees"),
                ("payment_methods", "s_payment_methods"),
                ("customers", "s_customers"),
                ("products", "s_products"),
                ("orders", "e_orders"),
                ("order_items", "s_order_items"),
                ("payments", "e_payments"),
                ("inventory_movements", "s_inventory_movements"),
            )
        ),
        # reports
        "revenue_by_store": f"SELECT store_name, {total.format('gross_amount', 'total_revenue')} "
        f"FROM {sales_store} GROUP BY store_name",
        "top_products": "SELECT product_name, category, "
        f"{total.format('gross_amount', 'total_revenue')}, CAST(SUM(quantity) AS BIGINT) AS units_sold "
        f"FROM {sales_product} GROUP BY product_name, category "
        "ORDER BY total_revenue DESC, product_name, category LIMIT 10",
        "revenue_by_month": f"SELECT year, month_name, {total.format('gross_amount', 'total_revenue')} "
        f"FROM {sales_date} GROUP BY year, month, month_name",
        "revenue_first_half": f"SELECT year, month_name, {total.format('gross_amount', 'total_revenue')} "
        f"FROM {sales_date} WHERE month <= 6 GROUP BY year, month, month_name",
        "dq_failing_rows": "SELECT payment_key, payment_id, order_id FROM f_payments WHERE store_key IS NULL",
        "best_months": f"SELECT year, month_name, {total.format('gross_amount', 'total_revenue')} "
        f"FROM {sales_date} GROUP BY year, month, month_name "
        "ORDER BY total_revenue DESC, year, month LIMIT 3",
        "customer_segments": "SELECT segment, COUNT(DISTINCT customer_key) AS customer_count, "
        f"{total.format('gross_amount', 'total_revenue')}, "
        f"{mean.format('gross_amount', 'avg_order_value')} "
        "FROM f_sales JOIN d_customer USING (customer_key) GROUP BY segment",
        "payment_methods": "SELECT method_name, COUNT(*) AS transaction_count, "
        f"{total.format('amount_paid', 'total_amount')} "
        "FROM f_payments JOIN d_payment_method USING (payment_method_key) GROUP BY method_name",
        "flagged_by_reason": 'SELECT flag_reason, COUNT(*) AS "count", '
        f"{total.format('amount_paid', 'total_amount')} FROM f_flagged GROUP BY flag_reason",
        "lifecycle_metrics": "SELECT current_status, COUNT(*) AS order_count, "
        + ", ".join(mean.format(f"days_to_{m}", f"avg_days_to_{m}") for m in ("pay", "ship", "deliver"))
        + " FROM f_lifecycle GROUP BY current_status",
        "revenue_by_category": f"SELECT category, {total.format('gross_amount', 'total_revenue')} "
        f"FROM {sales_product} GROUP BY category",
        "lines_per_order": "SELECT COUNT(*) AS line_count, COUNT(DISTINCT order_id) AS order_count, "
        "round(CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT order_id), 6) AS lines_per_order FROM f_sales",
        "anomaly_share": "SELECT COUNT(*) FILTER (WHERE is_anomalous) AS flagged_count, "
        "COUNT(*) AS payment_count, round(CAST(COUNT(*) FILTER (WHERE is_anomalous) AS DOUBLE) "
        "/ COUNT(*), 6) AS anomaly_share FROM s_payments",
        "discount_by_product": f"SELECT product_name, {total.format('discount_amount', 'total_discount')}, "
        "CAST(CAST(SUM(net_amount) AS DECIMAL(28,6)) AS DOUBLE) AS net_revenue "
        f"FROM {sales_product} GROUP BY product_name",
        "quality_summary": "SELECT 'Zero amount payment' AS issue, "
        'COUNT(*) FILTER (WHERE amount_paid = 0) AS "count" FROM f_flagged '
        "UNION ALL SELECT 'Unexplained negative payment', COUNT(*) FILTER (WHERE amount_paid < 0) "
        "FROM f_flagged "
        "UNION ALL SELECT 'Soft-deleted customer', COUNT(*) FROM x_customer_history "
        "WHERE valid_to IS NULL AND is_deleted "
        "UNION ALL SELECT 'Versioned customer', COUNT(*) FROM (SELECT customer_id FROM "
        "x_customer_history GROUP BY 1 HAVING COUNT(*) > 1) "
        "UNION ALL SELECT 'Soft-deleted product', COUNT(*) FROM x_product_history "
        "WHERE valid_to IS NULL AND is_deleted "
        "UNION ALL SELECT 'Versioned product', COUNT(*) FROM (SELECT product_id FROM "
        "x_product_history GROUP BY 1 HAVING COUNT(*) > 1)",
        # streams
        "stream_ingest": "SELECT CAST(event_id AS VARCHAR) AS id, props AS notes, "
        "CAST(floor(value) AS BIGINT) AS quantity, "
        f"{_stamp('ts')} AS moved_at FROM events",
        "stream_upsert": _out("x_latest", _LINE),
        "stream_scd2": _out("x_bulk", _HISTORY),
        "stream_quarantine": "SELECT payment_id, CAST(amount_paid AS DOUBLE) AS amount_paid, status, "
        "is_anomalous AS quarantined FROM s_payments",
    }
    texts = {name: _with(body) for name, body in bodies.items()}
    customer = _STAGED["stg_customers"].replace(" loaded_at:t", "").replace("customer_id ", "", 1)
    product = _STAGED["stg_products"].replace(" loaded_at:t", "").replace("product_id ", "", 1)
    versions = " valid_from:t valid_to:t is_current"
    texts["dim_customer"] = _history_dim(
        "x_customer_history", "customer_key", "customer_id", customer + versions
    )
    texts["dim_product"] = _history_dim(
        "x_product_history", "product_key", "product_id", product + " gross_margin:d" + versions,
        ", unit_price - cost_price AS gross_margin",
    )
    texts["dq_report"] = _suite()
    texts["ingest_pages"] = texts["stream_ingest"]
    texts["sync_and_load"] = texts["stream_ingest"]
    texts["sync_twice"] = texts["stream_ingest"]
    texts["sync_repeated"] = texts["stream_ingest"]
    texts["staging_view"] = texts["stg_orders"]
    texts["bounds_two_runs"] = (
        f"SELECT 'inventory_movements' AS entity, {_stamp('MAX(ts)')} AS last_updated_at, "
        "'2024-02-01 00:00:00.000000' AS last_run_at FROM events"
    )
    texts["json_odd_fields"] = (
        "SELECT CAST(event_id AS VARCHAR) AS _lake_id, CASE WHEN event_type = 'click' THEN 'X' ELSE '' END "
        "|| CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END "
        "AS voided_by, "
        + ", ".join(f"CASE WHEN user_id % 3 = {k} THEN event_type END AS k{k}" for k in range(3))
        + " FROM events"
    )
    return texts
