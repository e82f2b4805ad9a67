"""Queries over whole test tables. Each takes ``(spark, sf_dir)`` and returns a frame.

Audit columns that only hold the run time are left out of the results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart import schemas
from stratamart.functions.keys import surrogate_key
from stratamart.functions.money import mean
from stratamart.functions.text import initcap_delimited
from stratamart.functions.timestamps import from_epoch_micros, to_epoch_micros, utc_naive
from stratamart.functions.variants import has_path, integer_field
from stratamart.operators import currency, quality
from stratamart.operators.history import scd2
from stratamart.operators.in_force import join_as_of
from stratamart.operators.lookups import pin
from stratamart.operators.merge import changed_since, upsert
from stratamart.operators.reconcile import reconcile
from stratamart.plans import build, curated, marts, staging
from stratamart.plans.mart_deltas import OrderMarts
from stratamart.session import configure, shared_dir, side_by_side
from stratamart.sources import retail_feeds as feeds
from stratamart.sources.cells import CellTable
from stratamart.sources.checked import load_checked, reason_counts
from stratamart.sources.clustered import clustered
from stratamart.sources.landing import land_parquet, read_json_rows, read_landed_parquet
from stratamart.sources.snapshots import SnapshotLog
from stratamart.sources.store import LayerStore
from stratamart.streaming import ingest
from stratamart.streaming.dedupe import Deduplicated

RUN_TS = "2002-01-02 00:00:00"
AS_OF = date(2002, 1, 2)
HIGH_WATER_MARK = datetime(2000, 1, 1)
REQUIRED_QUOTE = "USDEUR"
CUSTOMERS_PER_CELL = 100_000
ORDERS_PER_CELL = 250_000
USERS_PER_CELL = 100_000
CLUSTERED_FILES = 16
KEPT_SINCE = "1997"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


# --- layers as lazy frames ----------------------------------------------------


def _orders(spark, d) -> DataFrame:
    return staging.stg_orders(feeds.raw_orders(spark, d), RUN_TS)


def _stored(spark, d, *tables: Query) -> list[DataFrame]:
    """Staging frames as written tables, made side by side.

    Facts are built from stored staging tables: each is computed once, and joins
    between two of them have a shuffle on both sides, which AQE needs to split a key.
    """
    return side_by_side([lambda t=table: pin(t(spark, d), t.__name__.strip("_"))[0] for table in tables])


def _items(spark, d) -> DataFrame:
    (orders,) = _stored(spark, d, _orders)
    return staging.stg_order_items(feeds.raw_order_items(spark, d), orders, RUN_TS)


def _customers(spark, d) -> DataFrame:
    return staging.stg_customers(feeds.raw_customers(spark, d), RUN_TS)


def _products(spark, d) -> DataFrame:
    return staging.stg_products(feeds.raw_products(spark, d), RUN_TS)


def _fx(spark, d) -> DataFrame:
    return staging.stg_fx_rates(feeds.raw_fx_rates(spark, d))


def _fct_orders(spark, d) -> DataFrame:
    return curated.fct_orders(_orders(spark, d), _fx(spark, d))


def _fct_items(spark, d, orders: DataFrame | None = None) -> DataFrame:
    """Item facts straight from raw items.

    Joining the orders for their attributes already leaves out items of excluded
    orders, so the existence join of the staging table is not repeated here.
    """
    items = staging.clean_order_items(feeds.raw_order_items(spark, d)).withColumn(
        "_stg_load_ts", F.lit(RUN_TS).cast("timestamp_ntz")
    )
    orders, fx = (orders, *_stored(spark, d, _fx)) if orders is not None else _stored(spark, d, _orders, _fx)
    return curated.fct_order_items(items, orders, fx)


def _dim_product(spark, d) -> DataFrame:
    return curated.dim_product(_products(spark, d))


def _dim_customer(spark, d) -> DataFrame:
    return curated.dim_customer(_customers(spark, d), AS_OF)


def _order_days(spark, d) -> DataFrame:
    return feeds.table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))


def _dim_date(spark, d) -> DataFrame:
    return curated.dim_date_of(_order_days(spark, d), "day")


# --- staging ------------------------------------------------------------------


@query
def stg_customers(spark, d):
    return _without_audit(_customers(spark, d))


@query
def stg_orders(spark, d):
    return _without_audit(_orders(spark, d))


@query
def stg_order_items(spark, d):
    return _without_audit(_items(spark, d))


@query
def stg_products(spark, d):
    return _without_audit(_products(spark, d))


@query
def stg_fx_rates(spark, d):
    return _fx(spark, d)


# --- sources, types and functions ----------------------------------------------


@query
def fx_payload_flatten(spark, d):
    return currency.flatten_fx_payload(feeds.fx_payloads(spark, d), "payload", keep=("event_id",))


@query
def event_props_variant(spark, d):
    events = feeds.table(spark, d, "events").select("event_id", F.parse_json("props").alias("props"))
    return events.where(has_path("props", "$.k")).select("event_id", integer_field("props", "$.k").alias("k"))


@query
def json_array_scan(spark, d):
    """Catalogue pages, each a JSON array of at most 500 products of a load, landed and read back."""
    pages = feeds.product_objects(spark, d).groupBy("load", F.floor(F.col("p_partkey") / 500).alias("page"))
    lines = pages.agg(F.concat(F.lit("["), F.array_join(F.collect_list("json"), ","), F.lit("]")).alias("json"))
    path = shared_dir(spark, "catalogue")
    lines.select("json").write.option("compression", "gzip").text(path)
    rows = read_json_rows(spark, path, require_array=True, run_ts=RUN_TS)
    return rows.select(
        integer_field("raw_data", "$.id").alias("product_id"),
        F.variant_get("raw_data", "$.price", "decimal(12,2)").alias("price"),
        F.variant_get("raw_data", "$.rating.rate", "double").alias("rating"),
        F.col("_source_file").contains(path.rsplit("/", 1)[1]).alias("has_source"),
    )


@query
def epoch_micros_roundtrip(spark, d):
    micros = feeds.table(spark, d, "events").select("event_id", to_epoch_micros("ts").alias("micros"))
    return micros.select("event_id", "micros", from_epoch_micros("micros").alias("ts"))


@query
def zoned_timestamps_to_utc(spark, d):
    """Timestamps two hours east of UTC, given with their zone, as naive UTC."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02:00"))
    return feeds.table(spark, d, "events").select("event_id", utc_naive(text.cast("timestamp")).alias("ts_utc"))


@query
def landed_orders_by_name(spark, d):
    """Orders landed with other column order, epoch times, one column too few and one too many."""
    landing = shared_dir(spark, "landing")
    landed = feeds.raw_orders(spark, d).select(
        F.lit("x").alias("unknown"),
        to_epoch_micros("modified_at").alias("modified_at"),
        to_epoch_micros("created_at").alias("created_at"),
        "total_amount", "currency_code", "status", "order_date", "customer_id", "order_id",
    )
    land_parquet(landed, landing, "orders", "20020101T000000")
    rows = read_landed_parquet(spark, landing, "orders", schemas.ORDERS, run_ts=RUN_TS)
    return rows.withColumn("has_source", F.col("_source_file").contains("run_id=")).drop("_source_file", "_load_ts")


@query
def latest_run_orders(spark, d):
    """Orders landed with one run per month, and the last run read back."""
    landing = shared_dir(spark, "landing")
    orders = feeds.raw_orders(spark, d).withColumn("run_id", F.date_format("order_date", "yyyyMM"))
    # Rows of a run are brought together, and a large run is still split into several files.
    orders.hint("rebalance", "run_id").write.partitionBy("run_id").parquet(f"{landing}/orders")
    rows = read_landed_parquet(spark, landing, "orders", schemas.ORDERS, run_ts=RUN_TS)
    return rows.drop("_source_file", "_load_ts")


@query
def initcap_names(spark, d):
    parts = feeds.table(spark, d, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
        F.concat_ws("/", "p_name", "p_brand").alias("name"),
    )
    customers = feeds.raw_customers(spark, d).select(
        F.lit("customer").alias("source"), F.col("customer_id").alias("id"),
        F.concat_ws(", ", "last_name", "email").alias("name"),
    )
    return parts.unionByName(customers).select("source", "id", initcap_delimited("name").alias("name"))


# --- curated -------------------------------------------------------------------


@query
def latest_fx(spark, d):
    return currency.latest_fx(_fx(spark, d))


@query
def dim_customer(spark, d):
    return _without_audit(_dim_customer(spark, d)).drop("customer_sk")


@query
def dim_date(spark, d):
    return _dim_date(spark, d)


@query
def dim_product(spark, d):
    return _without_audit(_dim_product(spark, d)).drop("product_sk")


@query
def fct_orders(spark, d):
    return _without_audit(_fct_orders(spark, d)).drop("order_sk", "customer_sk")


@query
def fct_order_items(spark, d):
    keys = ("order_item_sk", "order_sk", "customer_sk", "product_sk")
    return _without_audit(_fct_items(spark, d)).drop(*keys)


@query
def asof_fx_orders(spark, d):
    orders, fx = _stored(spark, d, _orders, _fx)  # the facts are used twice
    facts = curated.fct_orders(orders, fx, as_of_order_date=True)
    return _without_audit(facts).drop("order_sk", "customer_sk")


@query
def surrogate_key_join(spark, d):
    """Orders met with customers by hashed key, counted per segment, and the distinct keys."""
    orders = feeds.table(spark, d, "orders").select(surrogate_key("o_custkey").alias("sk"))
    customers = feeds.table(spark, d, "customer").select(surrogate_key("c_custkey").alias("sk"), "c_mktsegment")
    per_customer = orders.groupBy("sk").agg(F.count(F.lit(1)).alias("orders"))
    return (
        customers.join(per_customer, "sk", "left")
        .groupBy("c_mktsegment")
        .agg(F.count_distinct("sk").alias("customers"), F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))
    )


# --- marts ---------------------------------------------------------------------


@query
def revenue_by_category(spark, d):
    mart = marts.revenue_by_category(_fct_items(spark, d), _dim_product(spark, d), _dim_date(spark, d), RUN_TS)
    return marts.by_revenue(_without_audit(mart), "year", "month", "week_of_year")


@query
def revenue_by_country(spark, d):
    mart = marts.revenue_by_country(_fct_orders(spark, d), _dim_date(spark, d), RUN_TS)
    return marts.by_revenue(_without_audit(mart), "year", "month")


@query
def customer_segment_kpis(spark, d):
    mart = marts.customer_segment_kpis(_dim_customer(spark, d), _fct_orders(spark, d), RUN_TS)
    return marts.segments_by_revenue(_without_audit(mart))


@query
def top20_category_revenue(spark, d):
    mart = marts.revenue_by_category(_fct_items(spark, d), _dim_product(spark, d), _dim_date(spark, d), RUN_TS)
    return marts.top_revenue(_without_audit(mart), tiebreak=("year", "month", "week_of_year", "category"))


@query
def top20_country_revenue(spark, d):
    mart = marts.revenue_by_country(_fct_orders(spark, d), _dim_date(spark, d), RUN_TS)
    return marts.top_revenue(_without_audit(mart), tiebreak=("year", "month", "shipping_country"))


@query
def top_category_last_month(spark, d):
    """Categories of the month before the last order day."""
    as_of = _order_days(spark, d).agg(F.max("day")).first()[0]
    return marts.top_categories_since(_fct_items(spark, d), _dim_product(spark, d), _dim_date(spark, d), as_of)


# --- quality -------------------------------------------------------------------


@query
def dq_missing_fx(spark, d):
    return quality.missing_fx(_fct_orders(spark, d))


@query
def dq_orphan_items(spark, d):
    """Item facts without an order fact: none, since excluded orders lose their items."""
    (orders,) = _stored(spark, d, _orders)
    facts = _fct_items(spark, d, orders).select("order_sk")
    return quality.orphan_count(facts, orders.select(surrogate_key("order_id").alias("order_sk")), ["order_sk"])


@query
def dq_unstaged_items(spark, d):
    """Clean items whose order was not staged."""
    (orders,) = _stored(spark, d, _orders)
    items = staging.clean_order_items(feeds.raw_order_items(spark, d))
    return quality.orphan_count(items, orders, ["order_id"], "unstaged_items")


@query
def dq_revenue_range(spark, d):
    return quality.value_range(_fct_orders(spark, d), "total_amount_usd", mean("total_amount_usd"))


@query
def dq_feed_shape(spark, d):
    return quality.feed_shape(feeds.fx_payloads(spark, d), "payload", REQUIRED_QUOTE)


@query
def dq_non_empty(spark, d):
    results = [quality.expect_non_empty(make(spark, d), f"raw.{name}") for name, make in feeds.RAW.items()]
    for result in results[1:]:
        results[0] = results[0].unionByName(result)
    return results[0]


@query
def dq_days_without_orders(spark, d):
    """Calendar days on which no kept order was placed: expected days less present ones."""
    placed = _orders(spark, d).select(F.col("order_date").alias("date")).distinct()
    return quality.missing_members(_dim_date(spark, d), placed, "date")


@query
def lineage_trace(spark, d):
    """The first customer through the layers."""
    raw = feeds.raw_customers(spark, d)
    names = ("customer_id", "email", "modified_at")
    steps = [
        ("RAW", raw, "customer_id", names),
        ("STG", _customers(spark, d), "customer_id", names),
        ("DIM", _dim_customer(spark, d), "customer_nk", ("customer_nk", "email", "_last_updated_at")),
    ]
    return quality.trace_key(steps, raw.agg(F.min("customer_id")), names)


def feed_sources(spark, d) -> dict[str, DataFrame]:
    """The five sources as an extract delivers them: three tables and two JSON feeds."""
    lineage = ("_load_ts", "_source_file")
    sources = {name: feeds.RAW[name](spark, d).drop(*lineage) for name in schemas.RELATIONAL}
    sources["products"] = feeds.product_objects(spark, d).select("json")
    sources["fx_rates"] = currency.flatten_fx_payload(feeds.fx_payloads(spark, d), "payload")
    return sources


def built_store(spark, d) -> tuple[LayerStore, DataFrame]:
    """Everything landed, loaded and built in a folder of its own; the store and its run log."""
    store = LayerStore(spark, shared_dir(spark, "layers"), f"s{uuid.uuid4().hex[:8]}_")
    days = _order_days(spark, d).agg(F.min("day"), F.max("day")).first()
    run = build.Run(run_id="20020102T000000", run_ts=RUN_TS, as_of=AS_OF, calendar_start=days[0], calendar_end=days[1])
    return store, build.run_all(store, feed_sources(spark, d), f"{store.root}/landing", run)


def _report(spark, d, make: Callable[[LayerStore, DataFrame], DataFrame]) -> DataFrame:
    """A small report over a full build. It is written before the build's tables are dropped."""
    store, log = built_store(spark, d)
    report, _ = pin(make(store, log), "report")
    store.reset()
    return report


@query
def layer_row_counts(spark, d):
    """Rows of every layer table after a full build."""
    return _report(spark, d, lambda store, log: quality.row_counts(build.layer_tables(store)))


@query
def layered_build_log(spark, d):
    """Rows written per table, as the run log of a full build records them."""
    return _report(
        spark, d, lambda store, log: store.read("metadata", "run_log").select("layer", "table_name", "row_count")
    )


@query
def layered_build_checks(spark, d):
    """Outcome of the standing checks after a full build."""

    def checks(store: LayerStore, log: DataFrame) -> DataFrame:
        run = build.Run(run_id="20020102T000000", run_ts=RUN_TS)
        return build.check(store, run).select("rule", "failures")

    return _report(spark, d, checks)


# --- history, increments, streams -------------------------------------------------


@query
def scd2_user_state(spark, d):
    return _user_spells(spark, d)


def _user_spells(spark, d, **bounds) -> DataFrame:
    events = feeds.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    spells = scd2(events, ["user_id"], "ts", ["event_type"], ["event_id"], **bounds)
    return spells.select("user_id", "event_id", "event_type", "valid_from", "valid_to", "is_current")


@query
def incremental_extract(spark, d):
    changed = changed_since(feeds.table(spark, d, "orders"), "o_orderdate", HIGH_WATER_MARK)
    return changed.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query
def merge_upsert(spark, d):
    """Placement records up to the mark, with all later placements and all final states merged in."""
    return _merged_orders(spark, d)


def _merged_orders(spark, d, **bounds) -> DataFrame:
    raw = feeds.raw_orders(spark, d).select("order_id", "customer_id", "status", "total_amount", "modified_at")
    placed = F.col("status") == "placed"
    mark = F.lit(HIGH_WATER_MARK).cast("timestamp_ntz")
    target = raw.where(placed & (F.col("modified_at") <= mark))
    changes = raw.where(~placed | (F.col("modified_at") > mark))
    return upsert(target, changes, ["order_id"], ["modified_at"], ["status", "customer_id", "total_amount"], **bounds)


@query
def stream_landing_upsert(spark, d):
    """Events streamed from their file into a table of each user's latest event."""
    schema = feeds.table(spark, d, "events").schema
    store = LayerStore(spark, shared_dir(spark, "stream"), f"s{uuid.uuid4().hex[:8]}_")
    store.create_layers()
    stream = ingest.landed_stream(spark, f"{d}/events.parquet*", schema)
    ingest.upsert_available(
        stream, store, "staging", "user_state", ["user_id"], ["ts"], f"{store.root}/progress", ["event_id"]
    ).awaitTermination()
    state = store.read("staging", "user_state")
    result = spark.read.schema(state.schema).parquet(store.location("staging", "user_state"))
    store.reset()
    return result.select("user_id", "event_id", "ts", "event_type")


@query
def stream_append_log(spark, d):
    """Events streamed into an append-only log, summed per type without repeats."""
    return _event_sums(spark, d, f"{d}/events.parquet*")


def _event_sums(spark, d, path: str, files_per_batch: int | None = None) -> DataFrame:
    schema = feeds.table(spark, d, "events").schema
    root = shared_dir(spark, "stream")
    stream = ingest.landed_stream(spark, path, schema, files_per_batch=files_per_batch)
    ingest.append_log(stream, f"{root}/log", f"{root}/progress").awaitTermination()
    log = ingest.without_repeats(spark.read.schema(schema).parquet(f"{root}/log"), ["event_id"], ["ts"])
    return log.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))


@query
def stream_append_log_files(spark, d):
    """The same sums over events that arrive in several files, one a batch, each with all times."""
    files = shared_dir(spark, "events")
    feeds.table(spark, d, "events").repartition(4, "event_id").write.parquet(files)
    return _event_sums(spark, d, files, files_per_batch=1)


@query
def merge_upsert_many_keys(spark, d):
    """``merge_upsert`` with the changed keys shuffled instead of broadcast."""
    return _merged_orders(spark, d, max_keys=0)


@query
def fct_orders_salted(spark, d):
    """``fct_orders`` through the salted lookup join."""
    orders, fx = _stored(spark, d, _orders, _fx)
    facts = curated.fct_orders(orders, fx, lookup_rows=0)
    return _without_audit(facts).drop("order_sk", "customer_sk")


@query
def scd2_user_state_cut(spark, d):
    """``scd2_user_state`` with every key's time line cut into stretches."""
    return _user_spells(spark, d, rows_per_task=2)


@query
def scd2_dim_customer(spark, d):
    """History of every customer over all raw versions."""
    return curated.dim_customer_history(feeds.raw_customers(spark, d)).drop("customer_sk")


@query
def scd2_customer_merged(spark, d):
    """The same history, merged from batches: all changes first, then the sign-up records that came late."""
    raw = feeds.raw_customers(spark, d)
    late = F.col("modified_at").isNull() | (F.col("modified_at") <= F.col("created_at"))
    odd = F.col("customer_id") % 2 == 1
    versions = curated.customer_versions(spark, shared_dir(spark, "customers"), CUSTOMERS_PER_CELL)
    for batch in (raw.where(~late), raw.where(late & odd), raw.where(late & ~odd)):
        curated.merge_customer_versions(versions, batch)
    return curated.customer_spells(versions).drop("customer_sk")


@query
def fct_orders_customer_in_force(spark, d):
    """Order facts with the customer's attributes of the order's day."""
    spells, _ = pin(curated.dim_customer_history(feeds.raw_customers(spark, d)), "spells")
    facts, _ = pin(_fct_orders(spark, d), "facts")
    joined = curated.with_customer_in_force(facts, spells)
    return joined.select("order_nk", "order_date", "total_amount_usd", "customer_email", "customer_segment", "customer_country")


@query
def asof_event_rates(spark, d):
    """Every event with the last rate of its currency published by then, to the microsecond."""
    published = currency.flatten_fx_payload(
        feeds.fx_payloads(spark, d).where(F.col("event_id") % 3 == 0), "payload", keep=("event_id", "_load_ts")
    ).withColumn("currency", F.upper("currency"))
    codes = F.array(*map(F.lit, ("EUR", "GBP", "INR", "JPY", "CHF")))
    events = feeds.table(spark, d, "events").select("event_id", "ts", F.get(codes, (F.col("user_id") % 5).cast("int")).alias("currency"))
    return join_as_of(events, published, ["currency"], "ts", "_load_ts", ["rate"], ["event_id"])


@query
def merge_upsert_cells(spark, d):
    """``merge_upsert`` into a table in cells, in two batches of changes that overlap."""
    raw = feeds.raw_orders(spark, d).select("order_id", "customer_id", "status", "total_amount", "modified_at")
    placed = F.col("status") == "placed"
    mark = F.lit(HIGH_WATER_MARK).cast("timestamp_ntz")
    table = CellTable(spark, shared_dir(spark, "orders"), raw.schema, "order_id", ORDERS_PER_CELL)
    table.write(raw.where(placed & (F.col("modified_at") <= mark)))
    for batch in (raw.where(~placed), raw.where(F.col("modified_at") > mark)):
        changes, _ = pin(batch, "changes")
        table.upsert(changes, ["order_id"], ["modified_at"], ["status", "customer_id", "total_amount"])
    return table.read()


def _kept_marts(spark, d, *kept: str) -> OrderMarts:
    """Marts after three batches of changed orders and items; late orders meet items that came before them."""
    products, fx, days = _stored(spark, d, _dim_product, _fx, _dim_date)
    kept_marts = OrderMarts(spark, shared_dir(spark, "marts"), days, products, fx, kept=kept)
    orders, items = feeds.raw_orders(spark, d), feeds.raw_order_items(spark, d)
    since, later = (F.lit(f"{year}-01-01").cast("timestamp_ntz") for year in (1998, 2000))
    for version, (low, high) in enumerate(((None, since), (since, later), (later, None))):
        def batch(moment: str) -> Column:
            old = F.col(moment) < high if high is not None else F.lit(True)
            return F.coalesce(old & (F.col(moment) >= low) if low is not None else old, F.lit(low is None))

        kept_marts.apply(orders.where(batch("modified_at")), items.where(batch("created_at")), f"{version:010d}")
    return kept_marts


@query
def revenue_by_country_by_changes(spark, d):
    """``revenue_by_country`` kept up to date by three batches of changes."""
    return _without_audit(_kept_marts(spark, d, "country").revenue_by_country(RUN_TS))


@query
def revenue_by_category_by_changes(spark, d):
    """``revenue_by_category`` kept up to date by three batches of changes."""
    return _without_audit(_kept_marts(spark, d, "category").revenue_by_category(RUN_TS))


@query
def customer_segment_kpis_by_changes(spark, d):
    """``customer_segment_kpis`` from customer totals kept up to date by three batches of changes."""
    return _without_audit(_kept_marts(spark, d, "customer").customer_segment_kpis(_dim_customer(spark, d), RUN_TS))


@query
def stream_dedupe_late(spark, d):
    """Events that arrive in several files, each with all times and repeats of the others: the log and the late rows."""
    events = feeds.table(spark, d, "events")
    files = shared_dir(spark, "events")
    part = F.col("event_id") % 3
    # Every file has a third of the events, and a fifth of the events of the file before.
    copies = F.when(F.col("event_id") % 5 == 0, F.array(part, (part + 1) % 3)).otherwise(F.array(part))
    parted = events.withColumn("file", F.explode(copies))
    for k in range(3):
        parted.where(F.col("file") == k).drop("file").write.mode("append").parquet(files)
    a_third = max(1, len(spark.read.schema(events.schema).parquet(files).inputFiles()) // 3)
    root = shared_dir(spark, "stream")
    table = Deduplicated(spark, f"{root}/out", events.schema, ("event_id",), "ts", "2 hours")
    table.run(ingest.landed_stream(spark, files, events.schema, files_per_batch=a_third), f"{root}/progress").awaitTermination()
    return table.rows().drop("late")


@query
def quarantine_items(spark, d):
    """Item records as text, some of them unfit, loaded apart in one pass: rows of each side and of each reason."""
    raw = feeds.raw_order_items(spark, d).select(*[F.col(c).cast("string").alias(c) for c in schemas.ORDER_ITEMS.names])
    item = F.col("order_item_id").cast("bigint")
    text = raw.withColumns(
        {
            "unit_price": F.when(item % 11 == 0, F.concat("unit_price", F.lit(" EUR"))).otherwise(F.col("unit_price")),
            "created_at": F.when(item % 13 == 0, "soon").otherwise(F.col("created_at")),
        }
    )
    load = load_checked(text, schemas.ORDER_ITEMS, {"quantity is not positive": F.col("quantity") <= 0}, max_bad_share=0.9)
    sides = load.good.select(F.lit("good").alias("reason")).unionByName(load.bad.select(F.lit("bad").alias("reason")))
    counted = sides.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
    return reason_counts(load).unionByName(counted).withColumnRenamed("rows", "row_count")


@query
def reconcile_orders(spark, d):
    """A copy of the staged orders that lost, changed, doubled and renumbered some, held against the original."""
    (orders,) = _stored(spark, d, _orders)
    left = orders.select("order_id", "status", "total_amount")
    part = F.col("order_id") % 500
    copied = left.where(part != 1).withColumns(
        {
            "total_amount": (F.col("total_amount") + F.when(part == 2, 1).otherwise(0)).cast(left.schema["total_amount"].dataType),
            "order_id": F.when(part == 4, -F.col("order_id")).otherwise(F.col("order_id")),
        }
    )
    right, _ = pin(copied.unionByName(left.where(part == 3)), "copy")
    return reconcile(left, right, ["order_id"], ["status", "total_amount"])


@query
def clustered_orders(spark, d):
    """One month's orders of one part of the customers, from files clustered by customer and day."""
    path = shared_dir(spark, "clustered")
    clustered(feeds.table(spark, d, "orders"), ["o_custkey", "o_orderdate"], CLUSTERED_FILES).write.parquet(path)
    month = F.col("o_orderdate").between(F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-03-31").cast("timestamp_ntz"))
    return spark.read.parquet(path).where(month & (F.col("o_custkey") <= 1000)).select("o_orderkey", "o_custkey", "o_orderdate")


@query
def stream_upsert_cells(spark, d):
    """``stream_landing_upsert`` over events in several files, one a batch, into a table in cells."""
    events = feeds.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    root = shared_dir(spark, "stream")
    events.repartition(4, "event_id").write.parquet(f"{root}/arrived")
    table = CellTable(spark, f"{root}/table", events.schema, "user_id", USERS_PER_CELL)
    stream = ingest.landed_stream(spark, f"{root}/arrived", events.schema, files_per_batch=1)
    ingest.upsert_cells_available(stream, table, ["user_id"], ["ts"], f"{root}/progress", ["event_id"]).awaitTermination()
    return table.read()


@query
def raw_history_snapshots(spark, d):
    """Raw orders kept as a run per year, their files joined, early years forgotten: every year before and after that."""
    raw = feeds.raw_orders(spark, d)
    year = F.coalesce(F.date_format("order_date", "yyyy"), F.lit("0000"))
    log = SnapshotLog(spark, shared_dir(spark, "history"), raw.schema)
    for row in raw.select(year.alias("year")).distinct().orderBy("year").collect():
        log.append(raw.where(year == row["year"]), row["year"])
    log.compact()
    whole = log.snapshots()[-1]
    log.forget(KEPT_SINCE)
    log.expire(keep=2)  # the snapshots before and after forgetting
    sides = log.read(whole).withColumn("state", F.lit("whole")).unionByName(log.read().withColumn("state", F.lit("kept")))
    return sides.groupBy("state", F.col("_run").alias("run")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").cast("decimal(38,2)").alias("total"),
        F.max("order_id").alias("last_order"),
    )
