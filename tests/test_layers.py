from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, plan, rows
from stratamart import schemas
from stratamart.operators.lookups import pin
from stratamart.plans import curated, marts, staging

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
DAY = date(2024, 1, 1)
D = Decimal


def raw_orders(spark, *records):
    """(id, customer, status, currency, amount, modified) -> raw order rows."""
    full = [(i, c, DAY, s, "de", cur, D(a), T0, m, T0, "f") for i, c, s, cur, a, m in records]
    return spark.createDataFrame(full, schemas.raw_table("orders"))


def raw_items(spark, *records):
    """(id, order, product, quantity, price, load) -> raw item rows."""
    full = [(i, o, p, q, None if a is None else D(a), T0, load, "f") for i, o, p, q, a, load in records]
    return spark.createDataFrame(full, schemas.raw_table("order_items"))


def variants(spark, *records):
    """(json, load) -> variant rows."""
    return spark.createDataFrame(list(records), "j string, _load_ts timestamp_ntz").select(
        F.parse_json("j").alias("raw_data"), "_load_ts", F.lit("f").alias("_source_file")
    )


def fx(spark, **rates):
    return spark.createDataFrame(
        [("USD", DAY, c, 1 / r, r) for c, r in rates.items()],
        "base_currency string, rate_date date, target_currency string, rate double, usd_per_unit double",
    )


# --- staging


def test_orders_are_deduped_before_the_status_rule(spark):
    raw = raw_orders(
        spark,
        (1, 1, "placed", "usd", "1.00", T0), (1, 1, "cancelled", "usd", "1.00", T1),  # latest is cancelled
        (2, 1, "cancelled", "usd", "1.00", T0), (2, 1, "shipped", "usd", "2.00", T1),
        (3, 1, "placed", "eur", "3.00", None), (3, 1, "shipped", "eur", "4.00", T2),  # untimed counts as newest
        (4, 1, None, "usd", "1.00", T0),  # no status
        (None, 1, "placed", "usd", "1.00", T0),
        (5, None, "Placed", "usd", "5.00", T0),
    )
    found = staging.stg_orders(raw).select("order_id", "customer_id", "status", "currency_code", "total_amount", "shipping_country")
    assert rows(found, "order_id") == [
        (2, 1, "SHIPPED", "USD", D("2.00"), "DE"), (3, 1, "PLACED", "EUR", D("3.00"), "DE"), (5, None, "PLACED", "USD", D("5.00"), "DE"),
    ]


def test_items_are_filtered_before_the_dedupe(spark):
    raw = raw_items(
        spark,
        (1, 1, 1, 2, "1.50", T0), (1, 1, 1, 0, "1.50", T1),  # newest is invalid, the older one is kept
        (2, 1, 1, -1, "1.00", T0), (3, 1, 1, None, "1.00", T0), (4, 1, 1, 1, "-0.01", T0), (5, 1, 1, 1, None, T0),
        (6, 1, 1, 1, "0.00", T0),
        (7, 9, 1, 1, "1.00", T0),  # order not staged
        (8, 1, 1, 1, "1.00", T0), (8, 1, 2, 1, "1.00", T0),  # same load: the tiebreak decides
        (None, 1, 1, 1, "1.00", T0),
    )
    orders = staging.stg_orders(raw_orders(spark, (1, 1, "placed", "usd", "1.00", T0)))
    found = staging.stg_order_items(raw, orders).select("order_item_id", "product_id", "quantity", "line_total")
    assert rows(found, "order_item_id") == [(1, 1, 2, D("3.00")), (6, 1, 1, D("0.00")), (8, 2, 1, D("1.00"))]
    assert "LeftSemi" in plan(found)


def test_customers_are_cleaned(spark):
    base = (DAY, T0)
    raw = spark.createDataFrame(
        [
            (1, "Old@X.COM", "mary-jane", "o'neil", "smb", "de", *base, T0, T0, "f"),
            (1, "New@X.COM", "MARY-JANE", None, "smb", "de", *base, T1, T0, "f"),
            (2, None, None, "x.y", "consumer", "us", *base, T0, T0, "f"),
            (None, "a", "b", "c", "d", "e", *base, T0, T0, "f"),
        ],
        schemas.raw_table("customers"),
    )
    stg = staging.stg_customers(raw, "2024-05-01 00:00:00")
    assert rows(stg.select("customer_id", "email", "first_name", "last_name", "customer_segment", "country"), "customer_id") == [
        (1, "new@x.com", "Mary-Jane", None, "SMB", "DE"), (2, None, None, "X.Y", "CONSUMER", "US"),
    ]
    assert stg.first()["_stg_load_ts"] == datetime(2024, 5, 1)
    dim = curated.dim_customer(stg, date(2024, 1, 11))
    assert rows(dim.select("customer_nk", "full_name", "tenure_days"), "customer_nk") == [(1, None, 10), (2, None, 10)]


def test_products_from_variants(spark):
    raw = variants(
        spark,
        ('{"id": 1, "title": "old", "price": 1, "category": "toys", "rating": {"rate": 4.5, "count": 2}}', T0),
        ('{"id": 1, "title": "new", "price": 55.995, "category": "toys", "rating": {"rate": 4.5, "count": 2}, "extra": 1}', T1),
        ('{"id": 1.5, "title": "half", "price": 2, "category": null}', T0),
        ('{"id": null, "title": "null id"}', T0),
        ('{"title": "no id"}', T0),
    )
    stg = staging.stg_products(raw)
    found = stg.select("product_id", "product_name", "category", "list_price_usd", "rating_avg", "rating_count")
    assert rows(found, "product_id") == [
        (None, "null id", None, None, None, None),
        (1, "new", "TOYS", D("56.00"), 4.5, 2),
        (2, "half", None, D("2.00"), None, None),
    ]
    buckets = curated.dim_product(stg).select("product_nk", "rating_bucket")
    assert rows(buckets, "product_nk") == [(None, "POOR"), (1, "EXCELLENT"), (2, "POOR")]


def test_bad_product_id_fails(spark):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        staging.stg_products(variants(spark, ('{"id": "abc"}', T0))).collect()


@pytest.mark.parametrize("rating, label", [(4.5, "EXCELLENT"), (4.49, "GOOD"), (4.0, "GOOD"), (3.0, "AVERAGE"), (2.99, "POOR"), (None, "POOR")])
def test_rating_bucket_bounds(spark, rating, label):
    df = spark.createDataFrame([(rating,)], "r double")
    assert df.select(curated.rating_bucket("r")).first()[0] == label


def test_fx_rates(spark):
    raw = variants(
        spark,
        ('{"base": "USD", "rate_date": "2024-01-01", "currency": "EUR", "rate": 0.5}', T0),
        ('{"base": "USD", "rate_date": "2024-01-01", "currency": "eur", "rate": 0.8}', T1),  # same currency, newer load
        ('{"base": "USD", "rate_date": "2024-01-03", "currency": "GBP", "rate": 2}', T0),
        ('{"base": "USD", "rate_date": "2024-01-03", "rate": 2}', T0),
    )
    assert rows(staging.stg_fx_rates(raw), "target_currency") == [
        ("USD", date(2024, 1, 1), "EUR", 0.8, 1.25), ("USD", date(2024, 1, 3), "GBP", 2.0, 0.5),
        ("USD", date(2024, 1, 3), "USD", 1.0, 1.0),
    ]


def test_fx_without_rows_still_maps_usd(spark):
    assert rows(staging.stg_fx_rates(variants(spark, ('{"x": 1}', T0)))) == [("USD", None, "USD", 1.0, 1.0)]


def test_fx_zero_rate_fails(spark):
    raw = variants(spark, ('{"base": "USD", "rate_date": "2024-01-01", "currency": "EUR", "rate": 0}', T0))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        staging.stg_fx_rates(raw).collect()


def test_fx_dedupe_and_last_day_share_one_shuffle(spark):
    raw = variants(spark, ('{"base": "USD", "rate_date": "2024-01-01", "currency": "EUR", "rate": 0.5}', T0))
    assert "ReusedExchange" in executed_plan(staging.stg_fx_rates(raw))


# --- curated and marts


@pytest.fixture
def world(spark):
    orders = staging.stg_orders(
        raw_orders(
            spark,
            (1, 1, "placed", "eur", "10.00", T0), (2, 1, "placed", "usd", "20.00", T0), (3, 2, "placed", "chf", "30.00", T0),
        )
    )
    items = staging.stg_order_items(
        raw_items(spark, (1, 1, 1, 2, "3.33", T0), (2, 1, 2, 1, "5.00", T0), (3, 2, 1, 1, "7.00", T0), (4, 3, 1, 1, "9.00", T0)),
        orders,
    )
    return orders, items, fx(spark, EUR=1.5, USD=1.0)


def test_order_facts_keep_unpriced_orders(spark, world):
    orders, _, rates = world
    facts = curated.fct_orders(orders, rates)
    assert rows(facts.select("order_nk", "order_date_key", "fx_rate_to_usd", "total_amount_usd"), "order_nk") == [
        (1, 20240101, 1.5, D("15.00")), (2, 20240101, 1.0, D("20.00")), (3, 20240101, None, None),
    ]
    doubles = curated.fct_orders(orders, rates, exact=False).select("order_nk", "total_amount_usd")
    assert rows(doubles, "order_nk") == [(1, 15.0), (2, 20.0), (3, None)]


def test_item_facts(spark, world):
    orders, items, rates = world
    facts = curated.fct_order_items(items, orders, rates)
    found = facts.select("order_item_nk", "native_currency", "unit_price_usd", "line_total_usd")
    assert rows(found, "order_item_nk") == [
        (1, "EUR", D("5.00"), D("9.99")), (2, "EUR", D("7.50"), D("7.50")), (3, "USD", D("7.00"), D("7.00")), (4, "CHF", None, None),
    ]
    assert facts.count() == items.count()
    assert facts.join(curated.fct_orders(orders, rates), "order_sk").count() == 4


def test_category_revenue(spark, world):
    orders, items, rates = world
    products = curated.dim_product(
        staging.stg_products(variants(spark, ('{"id": 1, "category": "a"}', T0), ('{"id": 2, "category": "b"}', T0)))
    )
    facts = curated.fct_order_items(items, orders, rates)
    days = curated.dim_date(spark)
    mart = marts.revenue_by_category(facts, products, days, "2024-05-01 00:00:00")
    assert rows(mart.drop("_last_built_at"), "category") == [
        (2024, 1, 1, "A", 3, 4, D("16.99"), D("8.50")), (2024, 1, 1, "B", 1, 1, D("7.50"), D("7.50")),
    ]
    outside = curated.dim_date(spark, date(2030, 1, 1), date(2030, 1, 2))
    assert marts.revenue_by_category(facts, products, outside).count() == 0
    recent = marts.top_categories_since(facts, products, days, date(2024, 2, 1))
    assert [tuple(r) for r in recent.collect()] == [("A", 3, 4, D("16.99")), ("B", 1, 1, D("7.50"))]
    assert marts.top_categories_since(facts, products, days).count() == 0  # nothing in the last month before today


def test_country_revenue(spark, world):
    orders, _, rates = world
    mart = marts.revenue_by_country(curated.fct_orders(orders, rates), curated.dim_date(spark))
    assert rows(mart.drop("_last_built_at")) == [(2024, 1, "Jan", "DE", 3, 2, D("35.00"), D("17.50"))]
    assert [r[0] for r in marts.top_revenue(mart, 1).select("shipping_country").collect()] == ["DE"]


def test_segment_kpis_count_inactive_customers(spark, world):
    orders, _, rates = world
    people = [(1, "SMB"), (2, "SMB"), (3, "SMB"), (4, "IDLE")]
    dim = spark.createDataFrame(people, "customer_id bigint, customer_segment string").select(
        F.xxhash64("customer_id").alias("customer_sk"), "customer_segment"
    )
    kpis = marts.segments_by_revenue(marts.customer_segment_kpis(dim, curated.fct_orders(orders, rates)))
    assert rows(kpis.drop("_last_built_at")) == [
        ("SMB", 3, 2, D("1.00"), D("35.00"), D("35.00")),  # mean orders counts 0, mean revenue skips NULL
        ("IDLE", 1, 0, D("0.00"), None, None),
    ]


# --- plans


def test_recent_categories_skip_old_facts(spark, world, tmp_path):
    orders, items, rates = world
    curated.fct_order_items(items, orders, rates).write.parquet(str(tmp_path / "facts"))
    products = spark.createDataFrame([(1, "A")], "product_sk bigint, category string")
    facts = spark.read.parquet(str(tmp_path / "facts"))
    text = plan(marts.top_categories_since(facts, products, curated.dim_date(spark), date(2024, 2, 1)))
    assert "GreaterThanOrEqual(order_date,2024-01-01)" in text


def test_facts_are_not_shuffled_by_currency(spark, world, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders, _, rates = world
    text = plan(curated.fct_orders(orders, rates))
    assert "BroadcastHashJoin" in text and "hashpartitioning(currency_code" not in text


def test_no_plan_needs_python(spark, world):
    orders, items, rates = world
    for df in (orders, items, curated.fct_orders(orders, rates), curated.fct_order_items(items, orders, rates)):
        assert "Python" not in plan(df)


@pytest.fixture
def small_skew(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )


def hot_items(spark):
    """Raw items, two thirds of which belong to one order and to one product."""
    n = F.col("id")
    hot = n % 3 > 0
    return spark.range(0, 60_000, 1, 8).select(
        n.alias("order_item_id"), F.when(hot, 7).otherwise(n % 200).alias("order_id"),
        F.when(hot, 3).otherwise(n % 50).alias("product_id"), F.lit(1).cast("bigint").alias("quantity"),
        F.lit(D("1.00")).alias("unit_price"), F.lit(T0).cast("timestamp_ntz").alias("created_at"),
        F.lit(T0).cast("timestamp_ntz").alias("_load_ts"), F.lit("f").alias("_source_file"),
    )


def stored_orders(spark):
    n = F.col("id")
    raw = spark.range(200).select(
        n.alias("order_id"), n.alias("customer_id"), F.lit(DAY).alias("order_date"), F.lit("placed").alias("status"),
        F.lit("de").alias("shipping_country"), F.lit("usd").alias("currency_code"), F.lit(D("1.00")).alias("total_amount"),
        *[F.lit(T0).cast("timestamp_ntz").alias(c) for c in ("created_at", "modified_at", "_load_ts")],
        F.lit("f").alias("_source_file"),
    )
    return pin(staging.stg_orders(raw), "orders")[0]


def test_hot_order_is_split(spark, small_skew):
    """With most items in one order, the joins with orders are split by AQE and stay whole."""
    items = staging.stg_order_items(hot_items(spark), stored_orders(spark))
    assert "skew=true" in executed_plan(items)
    assert items.count() == 60_000
    facts = curated.fct_order_items(pin(items, "items")[0], stored_orders(spark), fx(spark, USD=1.0))
    assert "skew=true" in executed_plan(facts)
    assert facts.count() == 60_000


def test_hot_product_is_split(spark, small_skew):
    items = pin(staging.stg_order_items(hot_items(spark), stored_orders(spark)), "items")[0]
    facts = pin(curated.fct_order_items(items, stored_orders(spark), fx(spark, USD=1.0)), "facts")[0].repartition(8)
    products = spark.range(50).select(F.xxhash64("id").alias("product_sk"), F.lit("A").alias("category"))
    mart = marts.revenue_by_category(facts, products, curated.dim_date(spark))
    assert "skew=true" in executed_plan(mart)
    assert rows(mart.select("order_count", "units_sold", "revenue_usd")) == [(200, 60_000, D("60000.00"))]
