from datetime import date, datetime
from decimal import Decimal as D

import pytest

from conftest import rows
from pyspark.sql import functions as F
from stratamart.operators.lookups import pin
from stratamart.plans import curated, mart_deltas, marts, staging
from stratamart.plans.mart_deltas import OrderMarts
from test_layers import fx, raw_items, raw_orders, variants

T0, T1, T2, T3 = (datetime(2024, 1, d) for d in (1, 2, 3, 4))
BATCHES = [  # (orders, items)
    ([(1, 1, "placed", "eur", "10.00", T0), (2, 1, "placed", "usd", "20.00", T0), (3, 2, "placed", "chf", "30.00", T0)],
     [(1, 1, 1, 2, "3.33", T0), (2, 1, 2, 1, "5.00", T0), (3, 2, 1, 1, "7.00", T0), (9, 4, 2, 3, "1.00", T0)]),
    # one is cancelled, one changes its customer, an older record comes late, and the order of an early item arrives
    ([(2, 1, "cancelled", "usd", "20.00", T2), (3, 1, "shipped", "usd", "30.00", T1), (1, 5, "placed", "eur", "99.00", None), (4, 7, "placed", "usd", "3.00", T0)],
     [(3, 2, 1, 4, "7.00", T1), (1, 1, 2, 1, "3.33", T1), (5, 1, 1, 0, "1.00", T2)]),
    ([(2, 1, "shipped", "usd", "21.00", T3), (3, 1, "placed", "usd", "1.00", T0)], []),
    ([], []),
    ([], [(2, 1, 2, 2, "5.00", T3)]),
]


@pytest.fixture
def world(spark):
    products = variants(spark, ('{"id": 1, "category": "a"}', T0), ('{"id": 2, "category": "b"}', T0))
    dim_product, _ = pin(curated.dim_product(staging.stg_products(products)), "products")
    people = spark.createDataFrame([(1, "SMB"), (2, "SMB"), (5, "BIG"), (7, "BIG"), (8, "IDLE")], "customer_id bigint, customer_segment string")
    dim_customer = people.select(F.xxhash64("customer_id").alias("customer_sk"), "customer_segment")
    return curated.dim_date(spark, date(2024, 1, 1), date(2024, 1, 31)), dim_product, fx(spark, EUR=1.5, USD=1.0), dim_customer


def plain(df):
    return sorted(rows(df.drop("_last_built_at")), key=str)


def full(spark, upto, days, products, rates, customers):
    orders = staging.stg_orders(raw_orders(spark, *[o for batch in BATCHES[:upto] for o in batch[0]]))
    orders, _ = pin(orders, "orders")
    items = staging.stg_order_items(raw_items(spark, *[i for batch in BATCHES[:upto] for i in batch[1]]), orders)
    facts, lines = curated.fct_orders(orders, rates), curated.fct_order_items(items, orders, rates)
    return [plain(marts.revenue_by_country(facts, days)), plain(marts.revenue_by_category(lines, products, days)),
            plain(marts.customer_segment_kpis(customers, facts))]


def test_marts_after_each_change_equal_a_full_build(spark, world, tmp_path):
    days, products, rates, customers = world
    kept = OrderMarts(spark, str(tmp_path), days, products, rates, orders_per_cell=2)
    for k, (orders, items) in enumerate(BATCHES):
        kept.apply(raw_orders(spark, *orders), raw_items(spark, *items), f"{k:03d}")
        if k in (1, 2, 4):
            found = [plain(kept.revenue_by_country()), plain(kept.revenue_by_category()), plain(kept.customer_segment_kpis(customers))]
            assert found == full(spark, k + 1, *world)


def test_large_changes_give_the_same_marts(spark, world, tmp_path, monkeypatch):
    """Without broadcasts, as beyond a bound; and orders, which are members of their own, are in no table of members."""
    monkeypatch.setattr(mart_deltas, "BROADCAST_ROWS", -1)
    days, products, rates, customers = world
    kept = OrderMarts(spark, str(tmp_path), days, products, rates, orders_per_cell=2)
    for k, (orders, items) in enumerate(BATCHES[:3]):
        kept.apply(raw_orders(spark, *orders), raw_items(spark, *items), f"{k:03d}")
    found = [plain(kept.revenue_by_country()), plain(kept.revenue_by_category()), plain(kept.customer_segment_kpis(customers))]
    assert found == full(spark, 3, *world)
    assert not (tmp_path / "category" / "members").exists()


def test_a_change_touches_the_cells_of_its_orders(spark, world, tmp_path):
    days, products, rates, _ = world
    kept = OrderMarts(spark, str(tmp_path), days, products, rates, orders_per_cell=1, kept=("country",))
    kept.apply(raw_orders(spark, *BATCHES[0][0]), raw_items(spark, *BATCHES[0][1]), "0")
    names = lambda table: {r["cell"]: r["folder"] for r in table.manifest().collect()}
    tables = (kept.orders, kept.kept["country"].counted)
    before = [names(t) for t in tables]
    kept.apply(raw_orders(spark, (2, 1, "shipped", "usd", "25.00", T3)), raw_items(spark), "1")
    for table, old in zip(tables, before):
        assert {c for c, folder in names(table).items() if old.get(c) != folder} == {2}


def test_a_repeated_or_half_written_change_counts_once(spark, world, tmp_path):
    days, products, rates, _ = world
    kept = OrderMarts(spark, str(tmp_path), days, products, rates, kept=("country",))
    kept.apply(raw_orders(spark, *BATCHES[0][0]), raw_items(spark), "0")
    change = raw_orders(spark, *BATCHES[1][0])
    mart, write = kept.kept["country"], kept.kept["country"].totals.replace
    mart.totals.replace = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        kept.apply(change, raw_items(spark), "1")
    mart.totals.replace = write
    kept.apply(change, raw_items(spark), "1")
    want = plain(kept.revenue_by_country())
    kept.apply(change, raw_items(spark), "1")
    assert plain(kept.revenue_by_country()) == want
    assert [r[4:7] for r in want] == [(3, 3, D("181.50"))]


def test_rates_that_change_are_taken_back_as_they_were(spark, world, tmp_path):
    days, products, rates, _ = world
    kept = OrderMarts(spark, str(tmp_path), days, products, rates, kept=("country",))
    kept.apply(raw_orders(spark, (1, 1, "placed", "eur", "10.00", T0), (2, 1, "placed", "eur", "10.00", T0)), raw_items(spark), "0")
    later = OrderMarts(spark, str(tmp_path), days, products, fx(spark, EUR=2.0, USD=1.0), kept=("country",))
    later.apply(raw_orders(spark, (1, 1, "shipped", "eur", "10.00", T1)), raw_items(spark), "1")
    assert [r["revenue_usd"] for r in later.revenue_by_country().collect()] == [D("35.00")]
