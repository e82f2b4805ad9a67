"""Marts: revenue by category and country, and KPIs per customer segment.

The order of a stored table is no contract, so marts are not sorted here;
``by_revenue`` and ``segments_by_revenue`` give the presentation order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.calendar import months_before
from stratamart.functions.money import mean, ratio, total
from stratamart.functions.timestamps import run_timestamp
from stratamart.operators.lookups import lookup_join


def _on_calendar(facts: DataFrame, dim_date: DataFrame, *columns: str) -> DataFrame:
    """Facts with calendar columns; facts on days outside the calendar are left out."""
    days = dim_date.select(F.col("date_key").alias("order_date_key"), *columns)
    return lookup_join(facts, days, ["order_date_key"], "inner")


def _item_measures(grouped) -> DataFrame:
    return grouped.agg(
        F.count_distinct("order_sk").alias("order_count"),
        F.sum("quantity").alias("units_sold"),
        total("line_total_usd").alias("revenue_usd"),
        mean("line_total_usd").alias("avg_line_usd"),
    )


def _by_category(fct_order_items: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Items with the category of their product.

    The product dimension grows with the catalogue, so the join is left to Spark,
    which broadcasts by measured size and splits a hot product otherwise.
    """
    return fct_order_items.join(dim_product.select("product_sk", "category"), "product_sk")


def revenue_by_category(
    fct_order_items: DataFrame, dim_product: DataFrame, dim_date: DataFrame, run_ts=None
) -> DataFrame:
    """Per year, month, ISO week and category: orders, units, revenue and mean line."""
    dated = _on_calendar(fct_order_items, dim_date, "year", "month", "week_of_year")
    grouped = _by_category(dated, dim_product).groupBy("year", "month", "week_of_year", "category")
    return _item_measures(grouped).withColumn("_last_built_at", run_timestamp(run_ts))


def revenue_by_country(fct_orders: DataFrame, dim_date: DataFrame, run_ts=None) -> DataFrame:
    """Per year, month and shipping country: orders, customers, revenue and mean order."""
    return (
        _on_calendar(fct_orders, dim_date, "year", "month", "month_name")
        .groupBy("year", "month", "month_name", "shipping_country")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            total("total_amount_usd").alias("revenue_usd"),
            mean("total_amount_usd").alias("avg_order_value_usd"),
        )
        .withColumn("_last_built_at", run_timestamp(run_ts))
    )


def customer_segment_kpis(dim_customer: DataFrame, fct_orders: DataFrame, run_ts=None) -> DataFrame:
    """Per segment: customers, active ones, mean orders and revenue, total revenue.

    Orders are summed per customer before the join, so what is shuffled is one
    row per customer and map task, and a customer with very many orders is no hot
    join key. Customers without orders count as zero orders and no revenue.
    """
    lifetime = fct_orders.groupBy("customer_sk").agg(
        F.count("order_sk").alias("orders"), F.sum("total_amount_usd").alias("revenue")
    )
    per_customer = dim_customer.select("customer_segment", "customer_sk").join(lifetime, "customer_sk", "left")
    orders = F.coalesce("orders", F.lit(0))
    return (
        per_customer.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.count_if(orders > 0).alias("active_customers"),
            ratio(F.sum(orders), F.count(F.lit(1))).alias("avg_orders_per_customer"),
            mean("revenue").alias("avg_lifetime_revenue_usd"),
            total("revenue").alias("total_revenue_usd"),
        )
        .withColumn("_last_built_at", run_timestamp(run_ts))
    )


def by_revenue(mart: DataFrame, *period: str) -> DataFrame:
    """Presentation order: period, then revenue from high to low."""
    return mart.orderBy(*period, F.desc_nulls_first("revenue_usd"))


def segments_by_revenue(kpis: DataFrame) -> DataFrame:
    return kpis.orderBy(F.desc_nulls_last("total_revenue_usd"))


def top_revenue(mart: DataFrame, rows: int = 20, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The rows with the most revenue."""
    return mart.orderBy(F.desc_nulls_first("revenue_usd"), *tiebreak).limit(rows)


def top_categories_since(
    fct_order_items: DataFrame, dim_product: DataFrame, dim_date: DataFrame, as_of: date | None = None, months: int = 1
) -> DataFrame:
    """Categories by revenue over the last months before a day (today when left out).

    The calendar decides which days count. The same bound on the facts changes
    nothing, but lets the scan of stored facts skip older row groups.
    """
    today = F.current_date() if as_of is None else F.lit(as_of)
    since = months_before(today, months)
    recent = dim_date.where(F.col("date") >= since)
    dated = _on_calendar(fct_order_items.where(F.col("order_date") >= since), recent)
    return (
        _by_category(dated, dim_product)
        .groupBy("category")
        .agg(
            F.count_distinct("order_sk").alias("orders"),
            F.sum("quantity").alias("units"),
            total("line_total_usd").alias("revenue_usd"),
        )
        .orderBy(F.desc_nulls_first("revenue_usd"))
    )
