"""ANSI-style SQL, run by DuckDB over the same tables, for each registered query.

Written from the meaning of the query, not from the Spark code. Tables build on
one another as common table expressions; a query lists only those it needs.
"""

from __future__ import annotations

import re

_CTE: dict[str, str] = {}

_CTE["raw_customers"] = """
SELECT c_custkey AS customer_id,
       (CASE WHEN version = 0 THEN c_name ELSE replace(c_name, '#', '.') END) || '@Mail.Example' AS email,
       lower(split_part(c_name, '#', 1)) AS first_name,
       concat_ws('-', lower(c_mktsegment), lower(n_name)) AS last_name,
       lower(c_mktsegment) AS customer_segment,
       lower(n_name) AS country,
       DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS TIMESTAMP) AS created_at,
       CASE WHEN version = 0 AND c_custkey % 10 = 3 THEN NULL
            ELSE CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) + version * 30 AS TIMESTAMP) END AS modified_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey, (VALUES (0), (1)) v(version)
"""

_CTE["raw_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN version = 0 THEN 'placed' WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'shipped' WHEN o_orderstatus = 'P' THEN 'cancelled' END AS status,
       lower(n_name) AS shipping_country,
       CASE o_custkey % 6 WHEN 0 THEN 'usd' WHEN 1 THEN 'eur' WHEN 2 THEN 'gbp' WHEN 3 THEN 'inr'
                          WHEN 4 THEN 'jpy' ELSE 'chf' END AS currency_code,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       CAST(o_orderdate AS TIMESTAMP) AS created_at,
       CAST(CAST(o_orderdate AS DATE) + version AS TIMESTAMP) AS modified_at
FROM orders LEFT JOIN nation ON o_custkey % 25 = n_nationkey, (VALUES (0), (1)) v(version)
"""

_CTE["raw_order_items"] = """
SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS quantity,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
       CAST(l_shipdate AS TIMESTAMP) AS created_at, CAST(l_shipdate AS TIMESTAMP) AS load_ts
FROM lineitem
"""

_CTE["raw_products"] = """
SELECT version AS load,
       to_json(struct_pack(
           id := p_partkey, title := p_name, price := CAST(p_retailprice AS DECIMAL(12,2)) + version,
           category := lower(p_type), description := p_brand || ' ' || p_name,
           image := 'https://img.example/' || p_partkey || '.png',
           rating := CASE WHEN p_size % 7 <> 0
                          THEN struct_pack(rate := p_size / 10, count := p_size * (version + 1)) END)) AS raw_data
FROM part, (VALUES (0), (1)) v(version)
"""

_CTE["fx_quotes"] = """
SELECT event_id, 'USD' AS base, DATE '1995-01-01' + CAST(event_id % 2404 AS INTEGER) AS rate_date,
       CASE WHEN event_type IN ('error', 'click') THEN lower(code) ELSE code END AS currency,
       (low + (event_id * 37 + user_id) % width) / 10000 AS rate, ts AS load_ts
FROM events, (VALUES ('EUR', 8000, 2000), ('GBP', 7000, 1500), ('INR', 300000, 50000), ('JPY', 1000000, 200000))
             c(code, low, width)
"""

_DELIMITER = r"""\s!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def _initcap(text: str) -> str:
    pieces = f"regexp_extract_all(lower({text}), '[^{_DELIMITER}]*[{_DELIMITER}]|[^{_DELIMITER}]+')"
    return f"array_to_string(list_transform({pieces}, lambda p: upper(p[1]) || p[2:]), '')"


_CTE["stg_customers"] = f"""
SELECT customer_id, lower(email) AS email, {_initcap('first_name')} AS first_name, {_initcap('last_name')} AS last_name,
       upper(customer_segment) AS customer_segment, upper(country) AS country, signup_date, created_at, modified_at
FROM raw_customers
WHERE customer_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY modified_at DESC NULLS FIRST, email DESC NULLS FIRST) = 1
"""

_CTE["stg_orders"] = """
SELECT * FROM (
    SELECT order_id, customer_id, order_date, upper(status) AS status, upper(shipping_country) AS shipping_country,
           upper(currency_code) AS currency_code, total_amount, created_at, modified_at
    FROM raw_orders
    WHERE order_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY modified_at DESC NULLS FIRST, status DESC NULLS FIRST) = 1)
WHERE status <> 'CANCELLED'
"""

_CTE["clean_items"] = """
SELECT order_item_id, order_id, product_id, quantity, unit_price,
       CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_total, created_at
FROM raw_order_items
WHERE order_item_id IS NOT NULL AND quantity > 0 AND unit_price >= 0
QUALIFY row_number() OVER (
    PARTITION BY order_item_id
    ORDER BY load_ts DESC NULLS FIRST, created_at DESC NULLS FIRST, order_id DESC NULLS FIRST,
             product_id DESC NULLS FIRST, quantity DESC NULLS FIRST, unit_price DESC NULLS FIRST) = 1
"""

_CTE["stg_order_items"] = "SELECT * FROM clean_items WHERE order_id IN (SELECT order_id FROM stg_orders)"

_CTE["stg_products"] = """
SELECT CAST(raw_data ->> '$.id' AS BIGINT) AS product_id, raw_data ->> '$.title' AS product_name,
       upper(raw_data ->> '$.category') AS category, CAST(raw_data ->> '$.price' AS DECIMAL(12,2)) AS list_price_usd,
       raw_data ->> '$.description' AS description, raw_data ->> '$.image' AS image_url,
       CAST(raw_data ->> '$.rating.rate' AS DOUBLE) AS rating_avg,
       CAST(raw_data ->> '$.rating.count' AS BIGINT) AS rating_count
FROM raw_products
WHERE json_exists(raw_data, '$.id')
QUALIFY row_number() OVER (PARTITION BY raw_data ->> '$.id' ORDER BY load DESC) = 1
"""

_CTE["fx_deduped"] = """
SELECT base AS base_currency, rate_date, upper(currency) AS target_currency, rate, 1.0::DOUBLE / rate AS usd_per_unit
FROM fx_quotes
WHERE currency IS NOT NULL
QUALIFY row_number() OVER (
    PARTITION BY upper(currency), rate_date ORDER BY load_ts DESC NULLS FIRST, rate DESC NULLS FIRST) = 1
"""

_CTE["stg_fx_rates"] = """
SELECT * FROM fx_deduped
UNION ALL
SELECT 'USD', (SELECT max(rate_date) FROM fx_deduped), 'USD', 1.0::DOUBLE, 1.0::DOUBLE
"""

_CTE["latest_fx"] = """
SELECT target_currency, usd_per_unit FROM stg_fx_rates
QUALIFY row_number() OVER (
    PARTITION BY target_currency ORDER BY rate_date DESC NULLS FIRST, usd_per_unit DESC NULLS FIRST) = 1
"""

_CTE["dim_date"] = """
SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS date, year(d) AS year, quarter(d) AS quarter,
       month(d) AS month, strftime(d, '%b') AS month_name, day(d) AS day_of_month, dayofweek(d) AS day_of_week,
       strftime(d, '%a') AS day_name, weekofyear(d) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end,
       CAST(date_trunc('quarter', d) AS DATE) AS quarter_start, CAST(date_trunc('year', d) AS DATE) AS year_start
FROM (SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM orders)
"""

_CTE["dim_customer"] = """
SELECT customer_id AS customer_nk, email, first_name, last_name, first_name || ' ' || last_name AS full_name,
       customer_segment, country, signup_date, DATE '2002-01-02' - signup_date AS tenure_days
FROM stg_customers
"""

_CTE["dim_product"] = """
SELECT product_id AS product_nk, product_name, category, list_price_usd, rating_avg, rating_count,
       CASE WHEN rating_avg >= 4.5 THEN 'EXCELLENT' WHEN rating_avg >= 4.0 THEN 'GOOD'
            WHEN rating_avg >= 3.0 THEN 'AVERAGE' ELSE 'POOR' END AS rating_bucket
FROM stg_products
"""


def _usd(amount: str) -> str:
    """Decimal product rounded to cents; the rate goes through text to keep its decimal digits."""
    rate = "CAST(CAST(usd_per_unit AS VARCHAR) AS DECIMAL(18,12))"
    return f"CAST(round(CAST({amount} AS DECIMAL(20,2)) * {rate}, 2) AS DECIMAL(18,2))"


def _total(amount: str) -> str:
    return f"CAST(sum({amount}) AS DECIMAL(28,2))"


def _ratio(cents: str, n: str) -> str:
    """Non-negative cents over a count, rounded half up in whole numbers."""
    rounded = f"(2 * {cents} + {n}) // nullif(2 * {n}, 0)"
    return f"CAST(CAST({rounded} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def _mean(amount: str) -> str:
    return _ratio(f"CAST(sum({amount}) * 100 AS HUGEINT)", f"CAST(count({amount}) AS HUGEINT)")


def _orders_with(fx_join: str) -> str:
    return f"""
SELECT order_id AS order_nk, customer_id, year(order_date) * 10000 + month(order_date) * 100 + day(order_date)
       AS order_date_key, total_amount AS total_amount_native, currency_code AS native_currency,
       usd_per_unit AS fx_rate_to_usd, {_usd('total_amount')} AS total_amount_usd, order_date, status, shipping_country
FROM stg_orders {fx_join}
"""


_CTE["fct_orders"] = _orders_with("LEFT JOIN latest_fx ON currency_code = target_currency")

_CTE["fct_order_items"] = f"""
SELECT order_item_id AS order_item_nk, i.order_id, customer_id, product_id,
       year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS order_date_key, quantity,
       unit_price AS unit_price_native, line_total AS line_total_native, currency_code AS native_currency,
       usd_per_unit AS fx_rate_to_usd, {_usd('unit_price')} AS unit_price_usd, {_usd('line_total')} AS line_total_usd,
       order_date, shipping_country
FROM stg_order_items i JOIN stg_orders o ON i.order_id = o.order_id
     LEFT JOIN latest_fx ON currency_code = target_currency
"""

_CTE["revenue_by_category"] = f"""
SELECT year, month, week_of_year, category, count(DISTINCT order_id) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS units_sold, {_total('line_total_usd')} AS revenue_usd,
       {_mean('line_total_usd')} AS avg_line_usd
FROM fct_order_items JOIN dim_product ON product_id = product_nk JOIN dim_date ON order_date_key = date_key
GROUP BY year, month, week_of_year, category
"""

_CTE["revenue_by_country"] = f"""
SELECT year, month, month_name, shipping_country, count(*) AS order_count,
       count(DISTINCT customer_id) AS unique_customers, {_total('total_amount_usd')} AS revenue_usd,
       {_mean('total_amount_usd')} AS avg_order_value_usd
FROM fct_orders JOIN dim_date ON order_date_key = date_key
GROUP BY year, month, month_name, shipping_country
"""

_CTE["customer_segment_kpis"] = f"""
SELECT customer_segment, count(*) AS customer_count,
       count(*) FILTER (lifetime_orders > 0) AS active_customers,
       {_ratio('CAST(sum(lifetime_orders) * 100 AS HUGEINT)', 'CAST(count(*) AS HUGEINT)')} AS avg_orders_per_customer,
       {_mean('lifetime_revenue')} AS avg_lifetime_revenue_usd, {_total('lifetime_revenue')} AS total_revenue_usd
FROM (SELECT customer_segment, customer_nk, count(order_nk) AS lifetime_orders,
             sum(total_amount_usd) AS lifetime_revenue
      FROM dim_customer LEFT JOIN fct_orders ON customer_nk = customer_id
      GROUP BY customer_segment, customer_nk)
GROUP BY customer_segment
"""

_CTE["customer_spells"] = """
SELECT customer_id AS customer_nk, email, first_name, last_name, customer_segment, country, modified_at AS valid_from,
  lead(modified_at) OVER w AS valid_to, lead(1) OVER w IS NULL AS is_current
FROM (SELECT *, lag(ROW(email, first_name, last_name, customer_segment, country)) OVER w AS previous FROM raw_customers
  WINDOW w AS (PARTITION BY customer_id ORDER BY modified_at NULLS LAST, email, first_name, last_name, customer_segment, country))
WHERE previous IS DISTINCT FROM ROW(email, first_name, last_name, customer_segment, country)
WINDOW w AS (PARTITION BY customer_id ORDER BY modified_at NULLS LAST, email, first_name, last_name, customer_segment, country)"""

_LAYER_TABLES = {
    "raw": ("customers", "orders", "order_items", "products", "fx_rates"),
    "staging": ("stg_orders", "stg_customers", "stg_products", "stg_fx_rates", "stg_order_items"),
    "curated": ("fct_order_items", "fct_orders", "dim_customer", "dim_product", "dim_date"),
    "marts": ("revenue_by_category", "revenue_by_country", "customer_segment_kpis"),
}
# The CTE behind each stored raw table.
_RAW_SOURCE = {
    "customers": "raw_customers",
    "orders": "raw_orders",
    "order_items": "raw_order_items",
    "products": "raw_products",
    "fx_rates": "fx_quotes",
}


def _counted() -> list[tuple[str, str, str]]:
    """``(layer, table, relation to count)`` in the order of the report."""
    return [
        (layer, table, _RAW_SOURCE[table] if layer == "raw" else table)
        for layer, tables in _LAYER_TABLES.items()
        for table in tables
    ]


def _row_counts() -> str:
    parts, position, previous = [], 0, "raw"
    for layer, table, relation in _counted():
        if layer != previous:
            parts.append(f"SELECT {position} AS position, '--- {layer.upper()} ---' AS table_name, CAST(NULL AS BIGINT) AS row_count")
            position, previous = position + 1, layer
        parts.append(f"SELECT {position} AS position, '{layer.upper()}.{table.upper()}' AS table_name, count(*) AS row_count FROM {relation} t")
        position += 1
    return "\nUNION ALL\n".join(parts)


def _build_log() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS row_count FROM {relation} t"
        for layer, table, relation in _counted()
    )


def _build_checks() -> str:
    rules = [
        "SELECT 'orders have an exchange rate' AS rule, count(*) AS failures FROM fct_orders WHERE fx_rate_to_usd IS NULL",
        "SELECT 'items have an order', count(*) FROM fct_order_items WHERE order_id NOT IN (SELECT order_nk FROM fct_orders)",
        "SELECT 'revenue is not negative', count(*) FROM fct_orders WHERE total_amount_usd < 0",
    ]
    rules += [
        f"SELECT '{layer}.{table} is not empty', CAST(count(*) = 0 AS BIGINT) FROM {relation} t"
        for layer, table, relation in _counted()
        if layer != "raw"
    ]
    return "\nUNION ALL\n".join(rules)


_FINAL: dict[str, str] = {
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT * FROM stg_order_items",
    "stg_products": "SELECT * FROM stg_products",
    "stg_fx_rates": "SELECT * FROM stg_fx_rates",
    "fx_payload_flatten": "SELECT event_id, base, rate_date, currency, rate FROM fx_quotes",
    "event_props_variant": """
SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k FROM events WHERE json_exists(props, '$.k')""",
    "json_array_scan": """
SELECT CAST(raw_data ->> '$.id' AS BIGINT) AS product_id, CAST(raw_data ->> '$.price' AS DECIMAL(12,2)) AS price,
       CAST(raw_data ->> '$.rating.rate' AS DOUBLE) AS rating, TRUE AS has_source
FROM raw_products""",
    "epoch_micros_roundtrip": "SELECT event_id, epoch_us(ts) AS micros, ts FROM events",
    "zoned_timestamps_to_utc": "SELECT event_id, ts - INTERVAL 2 HOUR AS ts_utc FROM events",
    "landed_orders_by_name": """
SELECT order_id, customer_id, order_date, status, CAST(NULL AS VARCHAR) AS shipping_country, currency_code,
       total_amount, created_at, modified_at, TRUE AS has_source
FROM raw_orders""",
    "latest_run_orders": """
SELECT * FROM raw_orders
WHERE strftime(order_date, '%Y%m') = (SELECT max(strftime(order_date, '%Y%m')) FROM raw_orders)""",
    "initcap_names": f"""
SELECT 'part' AS source, p_partkey AS id, {_initcap("p_name || '/' || p_brand")} AS name FROM part
UNION ALL
SELECT 'customer', customer_id, {_initcap("last_name || ', ' || email")} FROM raw_customers""",
    "latest_fx": "SELECT * FROM latest_fx",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_date": "SELECT * FROM dim_date",
    "dim_product": "SELECT * FROM dim_product",
    "fct_orders": "SELECT * EXCLUDE (customer_id) FROM fct_orders",
    "fct_order_items": "SELECT * EXCLUDE (order_id, customer_id, product_id) FROM fct_order_items",
    "asof_fx_orders": f"""
SELECT * EXCLUDE (customer_id) FROM ({_orders_with(
    "ASOF LEFT JOIN stg_fx_rates ON currency_code = target_currency AND order_date >= rate_date")})""",
    "surrogate_key_join": """
SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment""",
    "revenue_by_category": "SELECT * FROM revenue_by_category",
    "revenue_by_country": "SELECT * FROM revenue_by_country",
    "customer_segment_kpis": "SELECT * FROM customer_segment_kpis",
    "top20_category_revenue": """
SELECT * FROM revenue_by_category
ORDER BY revenue_usd DESC NULLS FIRST, year, month, week_of_year, category LIMIT 20""",
    "top20_country_revenue": """
SELECT * FROM revenue_by_country
ORDER BY revenue_usd DESC NULLS FIRST, year, month, shipping_country LIMIT 20""",
    "top_category_last_month": f"""
SELECT category, count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
       {_total('line_total_usd')} AS revenue_usd
FROM fct_order_items JOIN dim_product ON product_id = product_nk JOIN dim_date ON order_date_key = date_key
WHERE date >= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) - INTERVAL 1 MONTH
GROUP BY category""",
    "dq_missing_fx": "SELECT count(*) AS orders_missing_fx FROM fct_orders WHERE fx_rate_to_usd IS NULL",
    "dq_orphan_items": """
SELECT count(*) AS orphan_items FROM fct_order_items i LEFT JOIN fct_orders o ON i.order_id = o.order_nk
WHERE o.order_nk IS NULL""",
    "dq_unstaged_items": """
SELECT count(*) AS unstaged_items FROM clean_items i LEFT JOIN stg_orders o ON i.order_id = o.order_id
WHERE o.order_id IS NULL""",
    "dq_revenue_range": f"""
SELECT min(total_amount_usd) AS min_revenue, max(total_amount_usd) AS max_revenue,
       {_mean('total_amount_usd')} AS avg_revenue
FROM fct_orders""",
    "dq_feed_shape": """
SELECT 'is_object' AS rule, CAST(0 AS BIGINT) AS failures
UNION ALL SELECT 'non_empty', CAST(0 AS BIGINT)
UNION ALL SELECT 'has_required_quote', count(*) FROM events WHERE event_type IN ('error', 'click')""",
    "dq_non_empty": """
SELECT 'raw.customers is not empty' AS rule, CAST(count(*) = 0 AS BIGINT) AS failures FROM raw_customers
UNION ALL SELECT 'raw.orders is not empty', CAST(count(*) = 0 AS BIGINT) FROM raw_orders
UNION ALL SELECT 'raw.order_items is not empty', CAST(count(*) = 0 AS BIGINT) FROM raw_order_items
UNION ALL SELECT 'raw.products is not empty', CAST(count(*) = 0 AS BIGINT) FROM raw_products
UNION ALL SELECT 'raw.fx_rates is not empty', CAST(count(*) = 0 AS BIGINT) FROM fx_quotes""",
    "dq_days_without_orders": "SELECT date FROM dim_date EXCEPT SELECT order_date FROM stg_orders",
    "quarantine_items": """
WITH j AS (SELECT order_item_id % 11 = 0 AS price, order_item_id % 13 = 0 AS moment, coalesce(quantity <= 0, FALSE) AS amount FROM raw_order_items)
SELECT 'unit_price is no decimal(12,2)' AS reason, count(*) AS row_count FROM j WHERE price
UNION ALL SELECT 'created_at is no timestamp_ntz', count(*) FROM j WHERE moment
UNION ALL SELECT 'quantity is not positive', count(*) FROM j WHERE amount
UNION ALL SELECT 'bad', count(*) FROM j WHERE price OR moment OR amount
UNION ALL SELECT 'good', count(*) FROM j WHERE NOT (price OR moment OR amount)""",
    "reconcile_orders": """
SELECT order_id, CASE order_id % 500 WHEN 1 THEN 'missing' WHEN 2 THEN 'changed' WHEN 3 THEN 'repeated' ELSE 'missing' END AS problem,
       CAST(1 AS BIGINT) AS left_rows, CAST(CASE order_id % 500 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS BIGINT) AS right_rows
FROM stg_orders WHERE order_id % 500 BETWEEN 1 AND 4
UNION ALL SELECT -order_id, 'unexpected', 0, 1 FROM stg_orders WHERE order_id % 500 = 4""",
    "lineage_trace": """
SELECT 'RAW' AS layer, customer_id, email, modified_at FROM raw_customers
WHERE customer_id = (SELECT min(customer_id) FROM raw_customers)
UNION ALL
SELECT 'STG', customer_id, email, modified_at FROM stg_customers
WHERE customer_id = (SELECT min(customer_id) FROM raw_customers)
UNION ALL
SELECT 'DIM', customer_nk, email, TIMESTAMP '2002-01-02 00:00:00' FROM dim_customer
WHERE customer_nk = (SELECT min(customer_id) FROM raw_customers)""",
    "layer_row_counts": _row_counts(),
    "layered_build_log": _build_log(),
    "layered_build_checks": _build_checks(),
    "scd2_user_state": """
SELECT user_id, event_id, event_type, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
WHERE previous IS DISTINCT FROM event_type""",
    "scd2_dim_customer": "SELECT * FROM customer_spells",
    "scd2_customer_merged": "SELECT * FROM customer_spells",
    "fct_orders_customer_in_force": """
SELECT order_nk, order_date, total_amount_usd, c.email AS customer_email, c.customer_segment, c.country AS customer_country
FROM fct_orders o LEFT JOIN customer_spells c ON o.customer_id = c.customer_nk AND o.order_date >= c.valid_from
  AND (c.valid_to IS NULL OR o.order_date < c.valid_to)""",
    "asof_event_rates": """
SELECT e.event_id, e.ts, e.currency, r.rate
FROM (SELECT event_id, ts, CASE user_id % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'INR' WHEN 3 THEN 'JPY' ELSE 'CHF' END AS currency FROM events) e
ASOF LEFT JOIN (SELECT upper(currency) AS code, load_ts, rate FROM fx_quotes WHERE event_id % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY upper(currency), load_ts ORDER BY event_id DESC) = 1) r
ON e.currency = r.code AND e.ts >= r.load_ts""",
    "incremental_extract": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""",
    "clustered_orders": """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31' AND o_custkey <= 1000""",
    "merge_upsert": """
SELECT order_id, customer_id, status, total_amount, modified_at FROM raw_orders
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY modified_at DESC NULLS FIRST, status DESC NULLS FIRST) = 1""",
    "stream_landing_upsert": """
SELECT user_id, event_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1""",
    "stream_dedupe_late": "SELECT * FROM events",
    "raw_history_snapshots": """
SELECT state, coalesce(strftime(order_date, '%Y'), '0000') AS run, count(*) AS orders,
       CAST(sum(total_amount) AS DECIMAL(38, 2)) AS total, max(order_id) AS last_order
FROM raw_orders CROSS JOIN (VALUES ('whole'), ('kept')) AS states(state)
WHERE state = 'whole' OR coalesce(strftime(order_date, '%Y'), '0000') >= '1997'
GROUP BY ALL""",
    "stream_append_log": """
SELECT event_type, count(DISTINCT event_id) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""",
}


def _needed(sql: str) -> list[str]:
    """The common table expressions a statement uses, directly or not, in definition order."""
    used: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in (words & _CTE.keys()) - used:
            used.add(name)
            open_texts.append(_CTE[name])
    return [name for name in _CTE if name in used]


def _statement(name: str) -> str:
    tables = _needed(_FINAL[name])
    if not tables:
        return _FINAL[name]
    named = "WITH " + ",\n".join(f"{t} AS ({_CTE[t]})" for t in tables)
    final = _FINAL[name].strip()
    return f"{named},\n{final.removeprefix('WITH ')}" if final.startswith("WITH ") else f"{named}\n{final}"


ORACLE: dict[str, str] = {name: _statement(name) for name in _FINAL}
# Queries that reach the same result by a branch for large inputs.
ORACLE |= {
    "merge_upsert_many_keys": ORACLE["merge_upsert"],
    "merge_upsert_cells": ORACLE["merge_upsert"],
    "revenue_by_country_by_changes": ORACLE["revenue_by_country"],
    "revenue_by_category_by_changes": ORACLE["revenue_by_category"],
    "customer_segment_kpis_by_changes": ORACLE["customer_segment_kpis"],
    "fct_orders_salted": ORACLE["fct_orders"],
    "scd2_user_state_cut": ORACLE["scd2_user_state"],
    "stream_append_log_files": ORACLE["stream_append_log"],
    "stream_upsert_cells": ORACLE["stream_landing_upsert"],
}
