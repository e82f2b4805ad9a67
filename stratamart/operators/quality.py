"""Checks and reports over layers. Each is a frame; ``enforce`` turns it into a failure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratamart.constants import LAYERS


class CheckFailed(Exception):
    """A rule found offending rows."""


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``(position, table_name, row_count)`` over all layers, a NULL-count separator between."""
    parts = []
    for number, (layer, tables) in enumerate(layers.items()):
        if number:
            parts.append((f"--- {layer.upper()} ---", None))
        parts += [(f"{layer}.{name}".upper(), df) for name, df in tables.items()]
    spark = next(df for _, df in parts if df is not None).sparkSession
    frames = []
    for position, (label, df) in enumerate(parts):
        source = spark.range(1) if df is None else df
        count = F.max(F.lit(None).cast("bigint")) if df is None else F.count(F.lit(1))
        frames.append(
            source.agg(count.alias("row_count")).select(
                F.lit(position).alias("position"), F.lit(label).alias("table_name"), "row_count"
            )
        )
    return reduce(DataFrame.unionByName, frames)


def count_where(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """Number of rows meeting ``condition``, as one row."""
    return df.agg(F.count_if(condition).alias(name))


def missing_fx(fct_orders: DataFrame) -> DataFrame:
    """Orders without an exchange rate; none are expected."""
    return count_where(fct_orders, F.col("fx_rate_to_usd").isNull(), "orders_missing_fx")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Child rows without a parent row."""
    return child.join(parent.select(*on), list(on), "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, on: Sequence[str], name: str = "orphan_items") -> DataFrame:
    return orphans(child, parent, on).agg(F.count(F.lit(1)).alias(name))


def value_range(df: DataFrame, column: str, mean: Column, label: str = "revenue") -> DataFrame:
    """Smallest, largest and mean value in one pass."""
    return df.agg(F.min(column).alias(f"min_{label}"), F.max(column).alias(f"max_{label}"), mean.alias(f"avg_{label}"))


def trace_key(
    steps: Sequence[tuple[str, DataFrame, str, Sequence[str]]],
    key: DataFrame,
    names: Sequence[str],
) -> DataFrame:
    """All rows of one key through the layers.

    ``steps`` are ``(layer label, table, key column, columns)`` and ``key`` is a
    one-row, one-column frame; the columns of each step are renamed to ``names``. The
    key is a scalar subquery in a filter, which goes below the deduplication of a table
    whose rows it identifies.
    """
    wanted = key.toDF("_wanted")
    frames = []
    for layer, table, key_column, columns in steps:
        found = table.where(F.col(key_column) == wanted.scalar())
        frames.append(
            found.select(F.lit(layer).alias("layer"), *[F.col(c).alias(n) for c, n in zip(columns, names)])
        )
    return reduce(DataFrame.unionByName, frames)


def missing_members(expected: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Expected values that do not occur."""
    return expected.select(on).distinct().join(present.select(on), on, "left_anti")


def present_layers(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The layer namespaces found in the catalog, by name."""
    wanted = [prefix + layer for layer in LAYERS]
    return (
        spark.sql("SHOW NAMESPACES").select("namespace").where(F.col("namespace").isin(wanted)).orderBy("namespace")
    )


def missing_layers(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Layer namespaces that do not exist yet."""
    expected = spark.createDataFrame([(prefix + layer,) for layer in LAYERS], "namespace string")
    return missing_members(expected, present_layers(spark, prefix), "namespace")


def feed_shape(payloads: DataFrame, json_col: str, required_quote: str) -> DataFrame:
    """``(rule, failures)``: payloads that are not objects, hold no quotes, or miss a quote."""
    body = F.from_json(json_col, "quotes map<string,double>, rates map<string,double>")
    quotes = F.coalesce(body["quotes"], F.create_map().cast("map<string,double>"))
    counts = payloads.agg(
        F.count_if(~F.coalesce(F.ltrim(json_col).startswith("{"), F.lit(False))).alias("is_object"),
        F.count_if((F.size(quotes) == 0) & (F.coalesce(F.size(body["rates"]), F.lit(0)) == 0)).alias("non_empty"),
        F.count_if(~F.map_contains_key(quotes, required_quote)).alias("has_required_quote"),
    )
    return counts.unpivot([], ["is_object", "non_empty", "has_required_quote"], "rule", "failures")


def expect_non_empty(df: DataFrame, name: str) -> DataFrame:
    """``(rule, failures)``: one failure when the table has no row.

    Counting a stored table reads file footers only.
    """
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(f"{name} is not empty").alias("rule"), (F.col("rows") == 0).cast("bigint").alias("failures")
    )


def enforce(results: DataFrame) -> None:
    """Raise when any ``(rule, failures)`` row counts failures."""
    failed = results.where("failures > 0").agg(F.collect_list("rule").alias("rules")).first()["rules"]
    if failed:
        raise CheckFailed(", ".join(sorted(failed)))
