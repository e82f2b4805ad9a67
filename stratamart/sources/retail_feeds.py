"""The raw retail inputs, derived by Spark from the star-schema test tables.

Customers, orders and order items become change logs with several versions per
key, parts become catalogue loads in JSON, and events become exchange-rate
payloads in both known shapes. Every input row is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.constants import PRICE

# Fixed values of the mapping.
_FIRST_DAY = "1995-01-01"
_RATE_DAYS = 2404
_LOAD_TS = "2002-01-01 00:00:00"
_CATALOGUE_LOADS = ("2001-01-01 00:00:00", "2001-02-01 00:00:00")
_CURRENCIES = ("usd", "eur", "gbp", "inr", "jpy", "chf")  # no rate is published for the last
_STATUS = {"F": "delivered", "O": "shipped", "P": "cancelled"}
# currency -> lowest rate and its spread, in ten-thousandths
_RATES = {"EUR": (8_000, 2_000), "GBP": (7_000, 1_500), "INR": (300_000, 50_000), "JPY": (1_000_000, 200_000)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _first_day() -> Column:
    return F.lit(_FIRST_DAY).cast("date")


def _lineage(load_ts: Column, source: str) -> list[Column]:
    return [load_ts.alias("_load_ts"), F.lit(source).alias("_source_file")]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-up record and one later change of each customer; some changes carry no time."""
    version = F.col("version")
    signup = F.date_add(_first_day(), (F.col("c_custkey") % 365).cast("int"))
    modified = F.date_add(signup, version * 30).cast("timestamp_ntz")
    untimed = (version == 0) & (F.col("c_custkey") % 10 == 3)
    email = F.when(version == 0, F.col("c_name")).otherwise(F.replace("c_name", F.lit("#"), F.lit(".")))
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(email, F.lit("@Mail.Example")).alias("email"),
            F.lower(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
            F.concat_ws("-", F.lower("c_mktsegment"), F.lower("n_name")).alias("last_name"),
            F.lower("c_mktsegment").alias("customer_segment"),
            F.lower("n_name").alias("country"),
            signup.alias("signup_date"),
            signup.cast("timestamp_ntz").alias("created_at"),
            F.when(~untimed, modified).alias("modified_at"),
            *_lineage(_ntz(_LOAD_TS), "customers"),
        )
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement record and final status of each order."""
    version = F.col("version")
    final = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])[F.col("o_orderstatus")]
    currency = F.array(*map(F.lit, _CURRENCIES))[(F.col("o_custkey") % len(_CURRENCIES)).cast("int")]
    placed = F.col("o_orderdate").cast("timestamp_ntz")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "orders")
        .join(nation, (F.col("o_custkey") % 25).cast("int") == F.col("n_nationkey"), "left")
        .withColumn("version", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(version == 0, "placed").otherwise(final).alias("status"),
            F.lower("n_name").alias("shipping_country"),
            currency.alias("currency_code"),
            F.col("o_totalprice").cast(PRICE).alias("total_amount"),
            placed.alias("created_at"),
            F.date_add(F.col("o_orderdate").cast("date"), version).cast("timestamp_ntz").alias("modified_at"),
            *_lineage(_ntz(_LOAD_TS), "orders"),
        )
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item records; the input repeats keys, and returned items have negative quantities."""
    quantity = F.col("l_quantity").cast("bigint")
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("quantity"),
        F.col("l_extendedprice").cast(PRICE).alias("unit_price"),
        shipped.alias("created_at"),
        *_lineage(shipped, "order_items"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue objects ``(load, _load_ts, p_partkey, product)``, two loads of each; some are unrated."""
    load = F.col("load")
    rating = F.struct(
        (F.col("p_size") / 10).alias("rate"),
        (F.col("p_size") * (load + 1)).alias("count"),
    )
    product = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        (F.col("p_retailprice").cast(PRICE) + load).alias("price"),
        F.lower("p_type").alias("category"),
        F.concat_ws(" ", "p_brand", "p_name").alias("description"),
        F.concat(F.lit("https://img.example/"), F.col("p_partkey"), F.lit(".png")).alias("image"),
        F.when(F.col("p_size") % 7 != 0, rating).alias("rating"),
    )
    loads = F.array(*map(_ntz, _CATALOGUE_LOADS))
    return table(spark, sf_dir, "part").select("*", F.posexplode(loads).alias("load", "_load_ts")).select(
        "load", "_load_ts", "p_partkey", product.alias("product")
    )


def product_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as JSON text ``(load, p_partkey, json)``."""
    return _products(spark, sf_dir).select("load", "p_partkey", F.to_json("product").alias("json"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _products(spark, sf_dir).select(
        F.to_variant_object("product").alias("raw_data"), *_lineage(F.col("_load_ts"), "products")
    )


def _quotes() -> dict[str, Column]:
    """Rate of each currency as an event publishes it."""
    spread = F.col("event_id") * 37 + F.col("user_id")
    return {code: (F.lit(low) + spread % width) / 10_000 for code, (low, width) in _RATES.items()}


def _rate_day() -> Column:
    return F.date_add(_first_day(), (F.col("event_id") % _RATE_DAYS).cast("int"))


def fx_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(payload json, _load_ts)``: one rate publication per event, in one of four forms."""
    day, kind = _rate_day(), F.col("event_type")
    quotes = F.create_map(*[x for code, rate in _quotes().items() for x in (F.lit("USD" + code), rate)])
    plain = F.create_map(*[x for code, rate in _quotes().items() for x in (F.lit(code.lower()), rate)])
    no_quotes = kind.isin("error", "click")
    payload = F.struct(
        F.when(kind == "view", "USD").when(kind == "click", "").alias("source"),
        F.when(no_quotes, "USD").alias("base"),
        F.when(kind != "view", day.cast("string")).alias("date"),
        F.when(kind == "view", F.unix_date(day).cast("bigint") * 86_400 + 3_600).alias("timestamp"),
        F.when(~no_quotes, quotes).when(kind == "click", F.create_map().cast("map<string,double>")).alias("quotes"),
        F.when(no_quotes, plain).alias("rates"),
    )
    # Built inside an explode, so that it is compiled, which Spark does not do within the parsing of its text.
    return table(spark, sf_dir, "events").select(
        F.explode(F.array(F.to_json(payload))).alias("payload"), F.col("ts").cast("timestamp_ntz").alias("_load_ts"), "event_id"
    )


def raw_fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published rates as variant rows, the same ones the payloads hold."""
    lower = F.col("event_type").isin("error", "click")
    # Built inside the explode, so that filters on a row do not build it a second time.
    rows = F.array(
        *[
            F.to_variant_object(
                F.struct(
                    F.lit("USD").alias("base"),
                    _rate_day().alias("rate_date"),
                    F.when(lower, code.lower()).otherwise(code).alias("currency"),
                    rate.alias("rate"),
                )
            )
            for code, rate in _quotes().items()
        ]
    )
    published = F.col("ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(F.explode(rows).alias("raw_data"), *_lineage(published, "fx_rates"))


RAW = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "products": raw_products,
    "fx_rates": raw_fx_rates,
}
