"""Full build: land the sources, load raw, then staging, curated and marts."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratamart import schemas
from stratamart.constants import CALENDAR_END, CALENDAR_START
from stratamart.functions.timestamps import run_timestamp
from stratamart.operators import quality, watermarks
from stratamart.plans import curated, marts, staging
from stratamart.plans.mart_deltas import OrderMarts
from stratamart.session import side_by_side
from stratamart.sources.cells import CellTable
from stratamart.sources.landing import land_all, latest_common_run, read_landed_feed, read_landed_parquet
from stratamart.sources.store import LayerStore

_RUN_LOG = "run_id string, layer string, table_name string, row_count bigint, seconds double, finished_at timestamp_ntz"


@dataclass(frozen=True)
class Run:
    """What a run is stamped with and parametrised by."""

    run_id: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S"))
    run_ts: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    as_of: date | None = None
    calendar_start: date = CALENDAR_START
    calendar_end: date = CALENDAR_END
    fx_as_of_order_date: bool = False
    keep_raw_history: bool = False


@dataclass(frozen=True)
class Table:
    """A layer table and how it is made from others."""

    layer: str
    name: str
    inputs: tuple[str, ...]
    make: Callable[..., DataFrame]


def _layer(layer: str, **tables: tuple) -> tuple[Table, ...]:
    return tuple(Table(layer, name, inputs, make) for name, (*inputs, make) in tables.items())


# Steps in order; the tables of one step do not depend on each other.
STEPS: tuple[tuple[Table, ...], ...] = (
    _layer(
        "staging",
        stg_orders=("raw.orders", lambda run, raw: staging.stg_orders(raw, run.run_ts)),
        stg_customers=("raw.customers", lambda run, raw: staging.stg_customers(raw, run.run_ts)),
        stg_products=("raw.products", lambda run, raw: staging.stg_products(raw, run.run_ts)),
        stg_fx_rates=("raw.fx_rates", lambda run, raw: staging.stg_fx_rates(raw)),
    ),
    _layer(
        "staging",
        stg_order_items=(
            "raw.order_items",
            "staging.stg_orders",
            lambda run, raw, orders: staging.stg_order_items(raw, orders, run.run_ts),
        ),
    ),
    _layer(
        "curated",
        fct_order_items=(
            "staging.stg_order_items",
            "staging.stg_orders",
            "staging.stg_fx_rates",
            lambda run, items, orders, fx: curated.fct_order_items(
                items, orders, fx, as_of_order_date=run.fx_as_of_order_date
            ).sortWithinPartitions("order_date"),
        ),
        fct_orders=(
            "staging.stg_orders",
            "staging.stg_fx_rates",
            lambda run, orders, fx: curated.fct_orders(
                orders, fx, as_of_order_date=run.fx_as_of_order_date
            ).sortWithinPartitions("order_date"),
        ),
        dim_customer=("staging.stg_customers", lambda run, customers: curated.dim_customer(customers, run.as_of)),
        dim_product=("staging.stg_products", lambda run, products: curated.dim_product(products)),
        dim_date=(lambda run: curated.dim_date(SparkSession.active(), run.calendar_start, run.calendar_end),),
    ),
    _layer(
        "marts",
        revenue_by_category=(
            "curated.fct_order_items",
            "curated.dim_product",
            "curated.dim_date",
            lambda run, items, products, days: marts.revenue_by_category(items, products, days, run.run_ts),
        ),
        revenue_by_country=(
            "curated.fct_orders",
            "curated.dim_date",
            lambda run, orders, days: marts.revenue_by_country(orders, days, run.run_ts),
        ),
        customer_segment_kpis=(
            "curated.dim_customer",
            "curated.fct_orders",
            lambda run, customers, orders: marts.customer_segment_kpis(customers, orders, run.run_ts),
        ),
    ),
)

# Column by which a relational source tells what changed; items are never modified.
CHANGED_AT = {"customers": "modified_at", "orders": "modified_at", "order_items": "created_at"}

RAW_TABLES = tuple(schemas.RELATIONAL | schemas.FEEDS)


def layer_tables(store: LayerStore) -> dict[str, dict[str, DataFrame]]:
    """Every layer table, for the row-count report."""
    found: dict[str, dict[str, DataFrame]] = {"raw": {name: store.read("raw", name) for name in RAW_TABLES}}
    for step in STEPS:
        for table in step:
            found.setdefault(table.layer, {})[table.name] = store.read(table.layer, table.name)
    return found


def _timed(run: Run, layer: str, name: str, write: Callable[[], int]) -> tuple:
    start = time.monotonic()
    rows = write()
    return run.run_id, layer, name, rows, time.monotonic() - start, datetime.now(timezone.utc).replace(tzinfo=None)


def create_raw_tables(store: LayerStore) -> None:
    """Declare the layers and their raw tables, typed or variant, before the first load."""
    store.create_layers()
    for name in RAW_TABLES:
        store.create_empty("raw", name, schemas.raw_table(name))


def load_raw(store: LayerStore, landing: str, run: Run, run_id: str | None = None) -> list[tuple]:
    """Load a landed run (by default the latest that every dataset has finished) into every raw table.

    A raw table is replaced, or with ``keep_raw_history`` the run is added to it.
    """
    write = store.append_run if run.keep_raw_history else store.write

    chosen = run_id or latest_common_run(store.spark, landing, RAW_TABLES)

    def load(dataset: str) -> tuple:
        if dataset in schemas.FEEDS:
            df = read_landed_feed(store.spark, landing, dataset, chosen, run.run_ts)
        else:
            df = read_landed_parquet(
                store.spark, landing, dataset, schemas.RELATIONAL[dataset], chosen, run.run_ts
            )
        return _timed(run, "raw", dataset, lambda: write(df, "raw", dataset, run.run_id))

    return side_by_side([lambda d=dataset: load(d) for dataset in RAW_TABLES])


def build_layers(
    store: LayerStore, run: Run, layers: tuple[str, ...] = ("staging", "curated", "marts"), tables: tuple[str, ...] | None = None
) -> list[tuple]:
    """Rebuild the tables of the given layers, or those named, in dependency order."""

    def build(table: Table) -> tuple:
        inputs = [store.read(*name.split(".")).drop("_run") for name in table.inputs]
        return _timed(
            run, table.layer, table.name,
            lambda: store.write(table.make(run, *inputs), table.layer, table.name, run.run_id),
        )

    log = []
    for step in STEPS:
        due = [table for table in step if table.layer in layers and (tables is None or table.name in tables)]
        if due:
            log += side_by_side([lambda t=table: build(t) for table in due])
    return log


def record(store: LayerStore, log: list[tuple]) -> DataFrame:
    """Append a run's table log to ``metadata.run_log`` and return it."""
    frame = store.spark.createDataFrame(log, _RUN_LOG)
    store.append(frame, "metadata", "run_log")
    return frame


def check(store: LayerStore, run: Run) -> DataFrame:
    """Run the standing checks, append them to ``metadata.dq_results``, and return them."""
    orders, items = store.read("curated", "fct_orders"), store.read("curated", "fct_order_items")
    results = (
        quality.missing_fx(orders).select(F.lit("orders have an exchange rate").alias("rule"),
                                          F.col("orders_missing_fx").alias("failures"))
        .unionByName(
            quality.orphan_count(items, orders, ["order_sk"]).select(
                F.lit("items have an order").alias("rule"), F.col("orphan_items").alias("failures")
            )
        )
        .unionByName(
            quality.count_where(orders, F.col("total_amount_usd") < 0, "failures").select(
                F.lit("revenue is not negative").alias("rule"), "failures"
            )
        )
    )
    for step in STEPS:
        for table in step:
            results = results.unionByName(
                quality.expect_non_empty(store.read(table.layer, table.name), f"{table.layer}.{table.name}")
            )
    stamped = results.withColumn("run_id", F.lit(run.run_id)).withColumn("checked_at", run_timestamp(run.run_ts))
    store.append(stamped, "metadata", "dq_results")
    return store.read("metadata", "dq_results").where(F.col("run_id") == run.run_id)


def run_all(
    store: LayerStore,
    sources: Mapping[str, DataFrame],
    landing: str,
    run: Run | None = None,
) -> DataFrame:
    """Land, load and build everything; returns the run log of all tables."""
    run = run or Run()
    store.create_layers()
    land_all(sources, schemas.FEEDS, landing, run.run_id)
    return record(store, load_raw(store, landing, run, run.run_id) + build_layers(store, run))


def _load_changes(store: LayerStore, sources: Mapping[str, DataFrame], landing: str, run: Run) -> list[tuple]:
    """Extract what changed since the last run, land it and add it to the raw history."""
    store.create_layers()
    due = {
        dataset: watermarks.extract_changes(store, df, dataset, CHANGED_AT[dataset]) if dataset in CHANGED_AT else df
        for dataset, df in sources.items()
    }
    land_all(due, schemas.FEEDS, landing, run.run_id)
    log = load_raw(store, landing, run, run.run_id)
    for dataset, column in CHANGED_AT.items():
        loaded = store.read("raw", dataset).where(F.col("_run") == run.run_id)
        watermarks.record_mark(store, dataset, loaded, column, run.run_ts)
    return log


def run_changes(
    store: LayerStore,
    sources: Mapping[str, DataFrame],
    landing: str,
    run: Run | None = None,
) -> DataFrame:
    """Like ``run_all``, but extracts only rows changed since the last run and keeps raw history.

    The mark of a dataset moves after its rows are in the raw layer, so a run that
    fails is extracted again; staging keeps the newest version of each key. The layers are
    rebuilt from all raw history; ``run_deltas`` does not do that.
    """
    run = replace(run or Run(), keep_raw_history=True)
    log = _load_changes(store, sources, landing, run)
    return record(store, log + build_layers(store, run))


# What a run of changes rebuilds: tables of customers, products, rates and days, none of facts.
_DIMENSIONS = ("stg_customers", "stg_products", "stg_fx_rates", "dim_customer", "dim_product", "dim_date")


def order_marts(store: LayerStore, run: Run) -> OrderMarts:
    """The marts that ``run_deltas`` keeps up to date."""
    frames = [store.read(layer, name) for layer, name in (("curated", "dim_date"), ("curated", "dim_product"), ("staging", "stg_fx_rates"))]
    return OrderMarts(store.spark, f"{store.root}/kept", *frames, as_of_order_date=run.fx_as_of_order_date)


def customer_versions(store: LayerStore) -> CellTable:
    """The customer history that ``run_deltas`` merges into; ``curated.customer_spells`` gives the dimension."""
    return curated.customer_versions(store.spark, f"{store.root}/kept/customers")


def run_deltas(
    store: LayerStore,
    sources: Mapping[str, DataFrame],
    landing: str,
    run: Run | None = None,
) -> DataFrame:
    """Like ``run_changes``, but neither facts nor marts are rebuilt: they take in the changed orders and items.

    The first run takes in everything. Run ids must sort by time. Changed customers are
    merged into the type 2 history. Dimensions, which are small beside the facts, are
    rebuilt. A run that failed can be repeated under its id: what it had counted is not
    counted again. An order is priced by the rates of the run in which it last changed.
    """
    run = replace(run or Run(), keep_raw_history=True)
    log = _load_changes(store, sources, landing, run)
    log += build_layers(store, run, tables=_DIMENSIONS)
    new = {name: store.read("raw", name).where(F.col("_run") == run.run_id).drop("_run") for name in schemas.RELATIONAL}
    kept, versions = order_marts(store, run), customer_versions(store)

    def customers() -> int:
        curated.merge_customer_versions(versions, new["customers"])
        return versions.manifest().agg(F.sum("row_count")).first()[0] or 0

    def orders() -> int:
        kept.apply(new["orders"], new["order_items"], run.run_id)
        return kept.orders.manifest().agg(F.sum("row_count")).first()[0] or 0

    log.append(_timed(run, "curated", "customer_versions", customers))
    log.append(_timed(run, "curated", "order_versions", orders))
    marts_now = {
        "revenue_by_category": kept.revenue_by_category(run.run_ts),
        "revenue_by_country": kept.revenue_by_country(run.run_ts),
        "customer_segment_kpis": kept.customer_segment_kpis(store.read("curated", "dim_customer"), run.run_ts),
    }
    for name, mart in marts_now.items():
        log.append(_timed(run, "marts", name, lambda m=mart, n=name: store.write(m, "marts", n, run.run_id)))
    return record(store, log)
