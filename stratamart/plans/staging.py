"""Staging layer: typed, cleaned, one row per key.

Each function takes raw frames and returns the staging frame; ``run_ts`` stamps
the audit column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.constants import BASE_CURRENCY, EXCLUDED_ORDER_STATUS, PRICE
from stratamart.functions.money import line_total, usd_per_unit
from stratamart.functions.text import initcap_delimited
from stratamart.functions.timestamps import run_timestamp
from stratamart.functions.variants import has_path, variant_fields
from stratamart.operators.latest import latest_by_key

_PRODUCT_FIELDS = {
    "product_id": ("$.id", "integer"),
    "product_name": ("$.title", "string"),
    "category": ("$.category", "string"),
    "list_price_usd": ("$.price", PRICE),
    "description": ("$.description", "string"),
    "image_url": ("$.image", "string"),
    "rating_avg": ("$.rating.rate", "double"),
    "rating_count": ("$.rating.count", "integer"),
}

_FX_FIELDS = {
    "base_currency": ("$.base", "string"),
    "rate_date": ("$.rate_date", "date"),
    "target_currency": ("$.currency", "string"),
    "rate": ("$.rate", "double"),
}


def _audited(df: DataFrame, run_ts) -> DataFrame:
    """Rename the raw lineage columns and stamp the build time."""
    return df.withColumnsRenamed({"_load_ts": "_raw_load_ts", "_source_file": "_raw_source_file"}).withColumn(
        "_stg_load_ts", run_timestamp(run_ts)
    )


def stg_customers(raw: DataFrame, run_ts=None) -> DataFrame:
    """Newest version of each customer, with email, names and codes normalised."""
    newest = latest_by_key(
        raw.where(F.col("customer_id").isNotNull()),
        ["customer_id"],
        ["modified_at", "_load_ts"],
        ["email", "first_name", "last_name", "customer_segment", "country", "signup_date", "created_at"],
    )
    # Cleaned after the dedupe: the same result, on fewer rows.
    cleaned = newest.withColumns(
        {
            "email": F.lower("email"),
            "first_name": initcap_delimited("first_name"),
            "last_name": initcap_delimited("last_name"),
            "customer_segment": F.upper("customer_segment"),
            "country": F.upper("country"),
        }
    )
    return _audited(cleaned, run_ts)


ORDER_TIEBREAK = ("status", "customer_id", "order_date", "shipping_country", "currency_code", "total_amount", "created_at")
ITEM_TIEBREAK = ("created_at", "order_id", "product_id", "quantity", "unit_price")


def newest_orders(raw: DataFrame) -> DataFrame:
    """Newest version of each order, whatever its status."""
    return latest_by_key(
        raw.where(F.col("order_id").isNotNull()),
        ["order_id"],
        ["modified_at", "_load_ts"],
        ORDER_TIEBREAK,
    )


def stg_orders(raw: DataFrame, run_ts=None, one_each: bool = False) -> DataFrame:
    """Newest version of each order, unless that version is cancelled or has no status.

    With ``one_each`` the rows are the newest versions already.
    """
    newest = raw if one_each else newest_orders(raw)
    kept = newest.withColumn("status", F.upper("status")).where(F.col("status") != EXCLUDED_ORDER_STATUS)
    return _audited(
        kept.withColumns({c: F.upper(c) for c in ("shipping_country", "currency_code")}), run_ts
    )


def newest_items(raw: DataFrame) -> DataFrame:
    """Newest valid version of each item. Invalid versions go first, so an older valid one may win."""
    valid = raw.where(F.col("order_item_id").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") >= 0))
    return latest_by_key(
        valid,
        ["order_item_id"],
        ["_load_ts"],
        ITEM_TIEBREAK,
    )


def clean_order_items(raw: DataFrame, one_each: bool = False) -> DataFrame:
    """Newest valid version of each item, with its line total; with ``one_each`` the rows are those already."""
    newest = raw if one_each else newest_items(raw)
    return newest.withColumn("line_total", line_total("quantity", "unit_price"))


def stg_order_items(raw: DataFrame, stg_orders: DataFrame, run_ts=None) -> DataFrame:
    """Clean items of staged orders.

    Pass the orders as a stored table. Straight from their dedupe they would come
    without a shuffle of their own, and AQE splits a hot order only between two.
    """
    items = clean_order_items(raw).join(stg_orders.select("order_id"), "order_id", "left_semi")
    return _audited(
        items.select("order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total",
                     "created_at", "_load_ts", "_source_file"),
        run_ts,
    )


def stg_products(raw: DataFrame, run_ts=None) -> DataFrame:
    """Typed catalogue from variant rows, newest load of each product."""
    typed = raw.where(has_path("raw_data", "$.id")).select(
        *variant_fields("raw_data", _PRODUCT_FIELDS), "_load_ts", "_source_file"
    )
    newest = latest_by_key(
        typed, ["product_id"], ["_load_ts"],
        ["_source_file", "product_name", "list_price_usd", "rating_avg", "rating_count", "category", "description",
         "image_url"],
    )
    return _audited(newest.withColumn("category", F.upper("category")), run_ts)


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    """Rates per currency and day with their reciprocal, and a row that maps USD to itself.

    Currencies are matched in upper case, so ``eur`` and ``EUR`` of a day are one.
    """
    typed = (
        raw.where(has_path("raw_data", "$.currency"))
        .select(*variant_fields("raw_data", _FX_FIELDS), "_load_ts")
        .withColumn("target_currency", F.upper("target_currency"))
    )
    columns = ["base_currency", "rate_date", "target_currency", "rate", "usd_per_unit"]
    quoted = (
        latest_by_key(typed, ["rate_date", "target_currency"], ["_load_ts"], ["rate", "base_currency"])
        .withColumn("usd_per_unit", usd_per_unit("rate"))
        .select(*columns)
    )
    # Reads the same columns as the dedupe, so Spark runs that shuffle once for both.
    own = quoted.agg(F.max("rate_date").alias("rate_date")).select(
        F.lit(BASE_CURRENCY).alias("base_currency"),
        "rate_date",
        F.lit(BASE_CURRENCY).alias("target_currency"),
        F.lit(1.0).alias("rate"),
        F.lit(1.0).alias("usd_per_unit"),
    )
    return quoted.unionByName(own)
