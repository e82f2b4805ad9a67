"""Curated layer: star schema with hashed keys and amounts in USD."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratamart import schemas
from stratamart.constants import CALENDAR_END, CALENDAR_START, RATING_BUCKETS, RATING_REST
from stratamart.functions.calendar import calendar_columns
from stratamart.functions.keys import date_key, surrogate_key
from stratamart.functions.money import to_usd
from stratamart.functions.text import full_name
from stratamart.operators.currency import with_fx_as_of, with_latest_fx
from stratamart.operators.history import ROWS_PER_TASK, merge_history, scd2
from stratamart.operators.in_force import join_in_force
from stratamart.operators.lookups import BROADCAST_ROWS, pin
from stratamart.sources.cells import CellTable


def dim_customer(stg_customers: DataFrame, as_of=None) -> DataFrame:
    """Current state of each customer, with full name and days since sign-up."""
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_sk"),
        F.col("customer_id").alias("customer_nk"),
        "email",
        "first_name",
        "last_name",
        full_name("first_name", "last_name").alias("full_name"),
        "customer_segment",
        "country",
        "signup_date",
        F.date_diff(today, "signup_date").alias("tenure_days"),
        F.col("_stg_load_ts").alias("_last_updated_at"),
    )


def rating_bucket(rating: str) -> Column:
    """Label of a rating; a missing one falls into the rest."""
    labels = [F.when(F.col(rating) >= lower, label) for lower, label in RATING_BUCKETS]
    return F.coalesce(*labels, F.lit(RATING_REST))


def dim_product(stg_products: DataFrame) -> DataFrame:
    """Product attributes with a rating bucket."""
    return stg_products.select(
        surrogate_key("product_id").alias("product_sk"),
        F.col("product_id").alias("product_nk"),
        "product_name",
        "category",
        "list_price_usd",
        "rating_avg",
        "rating_count",
        rating_bucket("rating_avg").alias("rating_bucket"),
        F.col("_stg_load_ts").alias("_last_updated_at"),
    )


def dim_date(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """Calendar of every day from ``start`` to ``end``."""
    days = spark.range((end - start).days + 1)
    return days.select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("_day")).select(*calendar_columns("_day"))


def dim_date_of(df: DataFrame, day: str) -> DataFrame:
    """Calendar that spans the dates found in a column."""
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(F.explode(F.sequence("first", "last")).alias("_day")).select(*calendar_columns("_day"))


def _priced_orders(
    rows: DataFrame, stg_fx: DataFrame, key: str, as_of_order_date: bool, lookup_rows: int = BROADCAST_ROWS
) -> DataFrame:
    if as_of_order_date:
        return with_fx_as_of(rows, stg_fx, "currency_code", "order_date", salt_by=[key])
    return with_latest_fx(rows, stg_fx, "currency_code", lookup_rows, salt_by=[key])


CUSTOMER_STATE = ("email", "first_name", "last_name", "customer_segment", "country")


def dim_customer_history(raw_customers: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Type 2 customer dimension: each spell of unchanged attributes, the current one marked.

    Versions without a modification time are the newest, as in the staging table.
    """
    tiebreak = ["_load_ts", *CUSTOMER_STATE]
    return _customer_dimension(scd2(raw_customers, ["customer_id"], "modified_at", CUSTOMER_STATE, tiebreak, rows_per_task))


_VERSION = ["customer_id", "modified_at", "_load_ts", *CUSTOMER_STATE]


def customer_versions(spark: SparkSession, root: str, width: int = 1_000_000) -> CellTable:
    """Where every customer version is kept with the spell it opens, in cells of ``width`` customers."""
    kinds = schemas.raw_table("customers")
    fields = [kinds[c] for c in ("customer_id", "modified_at", *CUSTOMER_STATE, "_load_ts")]
    moment = T.TimestampNTZType()
    bounds = [T.StructField("valid_from", moment), T.StructField("valid_to", moment)]
    flags = [T.StructField(c, T.BooleanType()) for c in ("is_current", "opens")]
    return CellTable(spark, root, T.StructType([*fields, *bounds, *flags]), "customer_id", width)


def merge_customer_versions(table: CellTable, raw_customers: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> None:
    """Merge raw versions into the kept ones; only cells that hold one of their customers are rewritten."""
    changes, rows = pin(raw_customers.select(*_VERSION).dropna(subset=["customer_id"]), "customer-changes")
    if not rows:
        return
    cells = table.touched(changes)
    tiebreak = ["_load_ts", *CUSTOMER_STATE]
    stored = table.read(cells=cells)
    merged = merge_history(stored, changes, ["customer_id"], "modified_at", CUSTOMER_STATE, tiebreak, rows_per_task)
    table.replace(cells, merged)


def customer_spells(table: CellTable) -> DataFrame:
    """The type 2 dimension that the kept versions give: the same as ``dim_customer_history`` of all of them."""
    return _customer_dimension(table.read().where("opens"))


def _customer_dimension(spells: DataFrame) -> DataFrame:
    return spells.select(
        F.col("customer_id").alias("customer_nk"),
        surrogate_key("customer_id").alias("customer_sk"),
        *CUSTOMER_STATE,
        "valid_from",
        "valid_to",
        "is_current",
    )


def with_customer_in_force(facts: DataFrame, spells: DataFrame, at: str = "order_date", slot_days: float = 90) -> DataFrame:
    """Facts with the customer's attributes as they were on the fact's day, prefixed ``customer_``."""
    named = {c: c if c.startswith("customer_") else f"customer_{c}" for c in CUSTOMER_STATE}
    state = spells.withColumnsRenamed(named)
    return join_in_force(facts, state, ["customer_sk"], at, list(named.values()), slot_days=slot_days)


def fct_orders(
    stg_orders: DataFrame,
    stg_fx: DataFrame,
    exact: bool = True,
    as_of_order_date: bool = False,
    lookup_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per order, in its own currency and in USD.

    USD uses the newest rate of the currency, or with ``as_of_order_date`` the
    rate in force that day. Without a rate the USD amount is NULL. The rates are counted
    when this is called; up to ``lookup_rows`` newest rates are broadcast.
    """
    rate = F.col("usd_per_unit")
    return _priced_orders(stg_orders, stg_fx, "order_id", as_of_order_date, lookup_rows).select(
        F.col("order_id").alias("order_nk"),
        surrogate_key("order_id").alias("order_sk"),
        surrogate_key("customer_id").alias("customer_sk"),
        date_key("order_date").alias("order_date_key"),
        F.col("total_amount").alias("total_amount_native"),
        F.col("currency_code").alias("native_currency"),
        rate.alias("fx_rate_to_usd"),
        to_usd(F.col("total_amount"), rate, exact).alias("total_amount_usd"),
        "order_date",
        "status",
        "shipping_country",
        F.col("_stg_load_ts").alias("_last_updated_at"),
    )


def fct_order_items(
    stg_order_items: DataFrame,
    stg_orders: DataFrame,
    stg_fx: DataFrame,
    exact: bool = True,
    as_of_order_date: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per order item, priced in USD with the currency of its order.

    As for the staged items, pass the orders as a stored table. Columns of the items named
    in ``keep`` are passed on.
    """
    header = stg_orders.select("order_id", "customer_id", "order_date", "currency_code", "shipping_country")
    rate = F.col("usd_per_unit")
    return _priced_orders(stg_order_items.join(header, "order_id"), stg_fx, "order_item_id", as_of_order_date).select(
        F.col("order_item_id").alias("order_item_nk"),
        surrogate_key("order_item_id").alias("order_item_sk"),
        surrogate_key("order_id").alias("order_sk"),
        surrogate_key("customer_id").alias("customer_sk"),
        surrogate_key("product_id").alias("product_sk"),
        date_key("order_date").alias("order_date_key"),
        "quantity",
        F.col("unit_price").alias("unit_price_native"),
        F.col("line_total").alias("line_total_native"),
        F.col("currency_code").alias("native_currency"),
        rate.alias("fx_rate_to_usd"),
        to_usd(F.col("unit_price"), rate, exact).alias("unit_price_usd"),
        to_usd(F.col("line_total"), rate, exact).alias("line_total_usd"),
        "order_date",
        "shipping_country",
        F.col("_stg_load_ts").alias("_last_updated_at"),
        *keep,
    )
