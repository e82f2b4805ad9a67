"""Declared schemas of the relational sources and the raw layer."""

from __future__ import annotations

from pyspark.sql import types as T

_PRICE = T.DecimalType(12, 2)  # the type ``constants.PRICE`` names


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CUSTOMERS = _struct(
    customer_id=T.LongType(),
    email=T.StringType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    customer_segment=T.StringType(),
    country=T.StringType(),
    signup_date=T.DateType(),
    created_at=T.TimestampNTZType(),
    modified_at=T.TimestampNTZType(),
)

ORDERS = _struct(
    order_id=T.LongType(),
    customer_id=T.LongType(),
    order_date=T.DateType(),
    status=T.StringType(),
    shipping_country=T.StringType(),
    currency_code=T.StringType(),
    total_amount=_PRICE,
    created_at=T.TimestampNTZType(),
    modified_at=T.TimestampNTZType(),
)

ORDER_ITEMS = _struct(
    order_item_id=T.LongType(),
    order_id=T.LongType(),
    product_id=T.LongType(),
    quantity=T.LongType(),
    unit_price=_PRICE,
    created_at=T.TimestampNTZType(),
)

VARIANT_ROW = _struct(raw_data=T.VariantType())

LINEAGE = _struct(_load_ts=T.TimestampNTZType(), _source_file=T.StringType())

# dataset -> business columns of its raw table
RELATIONAL = {"customers": CUSTOMERS, "orders": ORDERS, "order_items": ORDER_ITEMS}
FEEDS = {"products": VARIANT_ROW, "fx_rates": VARIANT_ROW}


def raw_table(dataset: str) -> T.StructType:
    """Business and lineage columns of a raw table."""
    return T.StructType([*(RELATIONAL | FEEDS)[dataset].fields, *LINEAGE.fields])
