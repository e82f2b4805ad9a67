"""Marts kept up to date by changes: signed facts instead of a rebuild.

A changed order gives what it has counted for so far with sign -1 and its new facts with
sign +1. Sums add up with their signs. A distinct count cannot be added, so each member
of a group (a customer in a country's month, say) has a count of its facts: it is counted
when that leaves zero and taken back when it returns there. What an order has counted
for is stored as it was, so a rate or category that has changed since is taken back as
it was added. Neither unchanged facts nor raw history are read.

Where each order is a member of its own, what it has counted for tells that already: it
gives and takes back its place in a group like a sum. A large change is not looked up row
by row: the touched cells are written anew, and the change of a sum is what they hold
after less what they held before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stratamart import schemas
from stratamart.constants import TOTAL
from stratamart.functions.keys import surrogate_key
from stratamart.functions.money import ratio
from stratamart.functions.timestamps import run_timestamp
from stratamart.operators.merge import upsert
from stratamart.operators.lookups import BROADCAST_BYTES, BROADCAST_ROWS, pin, stored_bytes
from stratamart.plans import curated, staging
from stratamart.plans.marts import _by_category, _on_calendar
from stratamart.session import side_by_side
from stratamart.sources.cells import CellTable

_SPREAD = 1 << 20  # values of the hash within a period
_KIND = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), TOTAL: T.DecimalType(28, 2)}


@dataclass(frozen=True)
class Shape:
    """What a mart groups by, whose distinct number it counts, and what it adds up.

    ``counts`` are added up too, and for each the members that have any are counted. With
    the member ``order_id`` no table of members is needed. Tables are laid out by ``period`` (a SQL expression of the groups), so that changes of a few
    periods touch few cells.
    """

    groups: dict[str, str]
    member: str | None
    counts: tuple[str, ...]
    sums: dict[str, str]
    period: str

    def stored_member(self) -> list[str]:
        return [self.member] if self.member and self.member != "order_id" else []

    def ids(self) -> list[str]:
        return [*self.groups, *self.stored_member()]

    def fields(self, *more: str) -> T.StructType:
        kinds = self.groups | {c: "bigint" for c in more} | {c: "bigint" for c in self.counts} | self.sums | {"_key": "bigint"}
        return T.StructType([T.StructField(name, _KIND[kind]) for name, kind in kinds.items()])


class DeltaMart:
    """Totals per group, and per group and member, kept by signed changes.

    ``cells`` is the number of cells of a period in the table of members: choose it so that a
    cell is some hundred megabytes. Each change is a named version of all tables, the totals last. A change that is repeated after a failure finds what it has
    written, and works out the rest from the version before it.
    """

    def __init__(self, spark: SparkSession, root: str, shape: Shape, orders_per_cell: int, cells: int = 1):
        self.shape = shape
        own = shape.stored_member()
        counted = T.StructType([T.StructField("order_id", T.LongType()), *shape.fields(*own).fields[:-1]])
        self.counted = CellTable(spark, f"{root}/counted", counted, "order_id", orders_per_cell)
        self.members = CellTable(spark, f"{root}/members", shape.fields(*own), "_key", _SPREAD // cells)
        self.totals = CellTable(spark, f"{root}/totals", shape.fields(*[f"members_{c}" for c in shape.counts]), "_key", _SPREAD // (1 if shape.member else cells))

    def _key(self, columns: Sequence[str]) -> Column:
        return (F.expr(self.shape.period).cast("bigint") * _SPREAD + F.pmod(F.xxhash64(*columns), F.lit(_SPREAD))).alias("_key")

    def apply(self, rows: DataFrame, changed: DataFrame, cells: DataFrame, version: str, few: bool) -> None:
        """Count ``rows`` (order, groups, member, counts and sums) for the orders in ``changed``, and no longer what they
        counted for before. ``cells`` are those of the changed orders. ``few`` orders are looked up by broadcast."""
        if version in self.totals.versions():
            return
        shape = self.shape
        measures = [*shape.counts, *shape.sums]
        new = _typed(rows, self.counted.schema)
        before = self.counted.read_before(version, cells)
        if few:
            new, _ = pin(new, "mart-rows")
            ids = F.broadcast(changed)
            old, other = before.join(ids, "order_id", "left_semi"), before.join(ids, "order_id", "left_anti")
            self.counted.replace(cells, other.unionByName(new), version)
        else:
            other = before.join(changed, "order_id", "left_anti") if self.counted.before(version) else before
            new, staged = self.counted.stage(other.unionByName(new))
            self.counted.publish(cells, staged, version)
            old = before  # what the cells still hold is taken back and given again
        delta = new.unionByName(old.withColumns({m: -F.col(m) for m in measures}))
        gained = [f"members_{c}" for c in shape.counts]
        all_sums = [F.sum(m).alias(m) for m in [*gained, *measures]]
        if shape.stored_member():
            grouped = _moved(delta.groupBy(*shape.ids()).agg(*[F.sum(m).alias(m) for m in measures]), measures)
            change, _ = pin(grouped.withColumn("_key", self._key(shape.ids())), "mart-change")
            per_group = self._members(change, version).groupBy(*shape.groups).agg(*all_sums)
        else:
            own = [F.signum(c).cast("bigint") if shape.member else F.lit(0).cast("bigint") for c in shape.counts]
            per_group = _moved(delta.withColumns(dict(zip(gained, own))).groupBy(*shape.groups).agg(*all_sums), [*gained, *measures])
        per_group, _ = pin(per_group.withColumn("_key", self._key(list(shape.groups))).select(*self.totals.schema.names), "mart-totals")
        touched = self.totals.named(self.totals.touched(per_group))
        both = self.totals.read_before(version, touched).unionByName(per_group)
        merged = both.groupBy("_key", *shape.groups).agg(*all_sums)
        self.totals.replace(touched, _typed(merged.where(F.col(shape.counts[0]) != 0), self.totals.schema), version)

    def _members(self, change: DataFrame, version: str) -> DataFrame:
        """Update the members; the change with how many members each row adds or takes back."""
        shape = self.shape
        cells = self.members.named(self.members.touched(change))
        measures = [*shape.counts, *shape.sums]
        before = self.members.read_before(version, cells)
        own = ["_key", *shape.ids()]
        lines = before.select(*own, *measures, *[F.lit(0).cast("bigint").alias(f"new_{m}") for m in measures]).unionByName(
            change.select(*own, *[F.lit(0).cast("bigint").alias(m) for m in measures], *[F.col(m).alias(f"new_{m}") for m in measures])
        )
        met, _ = pin(lines.groupBy(*own).agg(*[F.sum(m).alias(m) for m in [*measures, *[f"new_{m}" for m in measures]]]), "mart-members")
        after = met.select(*own, *[(F.col(m) + F.col(f"new_{m}")).alias(m) for m in measures])
        self.members.replace(cells, _typed(after.where(F.col(shape.counts[0]) != 0), self.members.schema), version)

        def gained(c: str) -> Column:
            return ((F.col(c) + F.col(f"new_{c}") > 0).cast("bigint") - (F.col(c) > 0).cast("bigint")).alias(f"members_{c}")

        changed = _moved(met, [f"new_{m}" for m in measures])
        return changed.select(*shape.groups, *[gained(c) for c in shape.counts], *[F.col(f"new_{m}").alias(m) for m in measures])


def _moved(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rows in which some measure is not zero."""
    return df.where(reduce(lambda a, b: a | b, [F.col(m) != 0 for m in measures]))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


_COUNTRY = Shape(
    {"year": "int", "month": "int", "month_name": "string", "shipping_country": "string"},
    "customer_sk", ("orders", "priced"), {"revenue": TOTAL}, "year",
)
_CATEGORY = Shape(
    {"year": "int", "month": "int", "week_of_year": "int", "category": "string"},
    "order_id", ("lines", "priced"), {"units": "bigint", "revenue": TOTAL}, "year",
)
_CUSTOMER = Shape({"customer_sk": "bigint"}, None, ("orders", "priced"), {"revenue": TOTAL}, "0")

MARTS = {"country": _COUNTRY, "category": _CATEGORY, "customer": _CUSTOMER}


def _revenue() -> Column:
    """A sum of which nothing was priced is NULL, as a sum of NULLs is."""
    return F.when(F.col("priced") > 0, F.col("revenue"))


class OrderMarts:
    """The three marts over orders and items, kept up to date by changed records.

    The newest version of every order, whatever its status, and of every valid item are kept
    in cells by order. An order is priced by the rates, and a line takes the category, of
    the run in which the order or one of its items last changed.
    """

    def __init__(
        self, spark: SparkSession, root: str, dim_date: DataFrame, dim_product: DataFrame, stg_fx: DataFrame,
        as_of_order_date: bool = False, orders_per_cell: int = 250_000, kept: Sequence[str] = tuple(MARTS), cells: int = 1,
    ):
        self.spark, self.dim_date, self.dim_product, self.stg_fx = spark, dim_date, dim_product, stg_fx
        self.as_of_order_date = as_of_order_date
        self.orders = CellTable(spark, f"{root}/orders", schemas.raw_table("orders"), "order_id", orders_per_cell)
        self.items = CellTable(spark, f"{root}/items", schemas.raw_table("order_items"), "order_id", orders_per_cell)
        self.kept = {name: DeltaMart(spark, f"{root}/{name}", MARTS[name], orders_per_cell, cells) for name in kept}

    def apply(self, raw_orders: DataFrame, raw_items: DataFrame, version: str) -> None:
        """Take in changed order and item records, in any order. ``version`` sorts after those before it."""
        valid = raw_items.where("order_item_id IS NOT NULL AND quantity > 0 AND unit_price >= 0")
        (orders, _), (items, arrived) = side_by_side(
            [
                lambda: pin(raw_orders.select(*self.orders.schema.names).where("order_id IS NOT NULL"), "changed-orders"),
                lambda: pin(valid.select(*self.items.schema.names).where("order_id IS NOT NULL"), "changed-items"),
            ]
        )
        changed, count = pin(orders.select("order_id").unionByName(items.select("order_id")).distinct(), "changed-ids")
        few = max(count, arrived) <= BROADCAST_ROWS and stored_bytes(changed) <= BROADCAST_BYTES
        cells = self.orders.named(self.orders.touched(changed))
        old_orders, old_items = self.orders.read_before(version, cells), self.items.read_before(version, cells)
        if few:
            newest_orders = upsert(old_orders, orders, ["order_id"], ["modified_at", "_load_ts"], staging.ORDER_TIEBREAK)
            newest_items = upsert(old_items, items, ["order_item_id"], ["_load_ts"], staging.ITEM_TIEBREAK)
        else:  # most kept rows meet a change, so all of them go through one shuffle
            newest_orders = staging.newest_orders(old_orders.unionByName(orders))
            newest_items = staging.newest_items(old_items.unionByName(items))
        (new_orders, staged_orders), (new_items, staged_items) = side_by_side(
            [lambda: self.orders.stage(newest_orders), lambda: self.items.stage(newest_items)]
        )
        self._count(new_orders, new_items, changed, cells, version, few)
        self.items.publish(cells, staged_items, version)
        self.orders.publish(cells, staged_orders, version)

    def _count(self, orders: DataFrame, items: DataFrame, changed: DataFrame, cells: DataFrame, version: str, few: bool) -> None:
        """The facts of changed orders into the marts. Orders and, unless ``few`` have changed, items come once each."""
        ids = F.broadcast(changed) if few else changed
        staged = staging.stg_orders(orders.join(ids, "order_id", "left_semi"), one_each=True)
        if len(self.kept) > 1 or "category" in self.kept:
            staged, _ = pin(staged, "changed-staged")

        def priced(column: str) -> list[Column]:
            return [F.col(column).isNotNull().cast("bigint").alias("priced"), F.coalesce(F.col(column).cast(TOTAL), F.lit(0).cast(TOTAL)).alias("revenue")]

        one = F.lit(1).cast("bigint")
        if "country" in self.kept or "customer" in self.kept:
            made = curated.fct_orders(staged, self.stg_fx, as_of_order_date=self.as_of_order_date)
            facts = made.withColumn("order_id", F.col("order_nk"))
            if "country" in self.kept and "customer" in self.kept:
                facts, _ = pin(facts, "changed-facts")
            measures = [one.alias("orders"), *priced("total_amount_usd")]
            if "country" in self.kept:
                dated = _on_calendar(facts, self.dim_date, "year", "month", "month_name")
                self.kept["country"].apply(dated.select("order_id", *_COUNTRY.ids(), *measures), changed, cells, version, few)
            if "customer" in self.kept:
                self.kept["customer"].apply(facts.select("order_id", "customer_sk", *measures), changed, cells, version, few)
        if "category" in self.kept:
            lines = staging.clean_order_items(items.join(ids, "order_id", "left_semi")) if few else staging.clean_order_items(items, one_each=True)
            # By product first, while lines are narrow; then the join with their orders leaves those of an order together.
            sorted_out = _by_category(lines.withColumns({"product_sk": surrogate_key("product_id"), "_stg_load_ts": run_timestamp(None)}), self.dim_product)
            facts = curated.fct_order_items(sorted_out, staged, self.stg_fx, as_of_order_date=self.as_of_order_date, keep=("order_id", "category"))
            dated = _on_calendar(facts, self.dim_date, "year", "month", "week_of_year")
            each = dated.select("order_id", *_CATEGORY.ids(), one.alias("lines"), F.col("quantity").cast("bigint").alias("units"), *priced("line_total_usd"))
            per_order = each.groupBy("order_id", *_CATEGORY.ids()).agg(*[F.sum(m).alias(m) for m in (*_CATEGORY.counts, *_CATEGORY.sums)])
            self.kept["category"].apply(per_order, changed, cells, version, few)

    def revenue_by_country(self, run_ts=None) -> DataFrame:
        return self.kept["country"].totals.read().select(
            "year", "month", "month_name", "shipping_country", F.col("orders").alias("order_count"),
            F.col("members_orders").alias("unique_customers"), _revenue().alias("revenue_usd"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_order_value_usd"), run_timestamp(run_ts).alias("_last_built_at"),
        )

    def revenue_by_category(self, run_ts=None) -> DataFrame:
        return self.kept["category"].totals.read().select(
            "year", "month", "week_of_year", "category", F.col("members_lines").alias("order_count"),
            F.col("units").alias("units_sold"), _revenue().alias("revenue_usd"),
            ratio(F.col("revenue"), F.col("priced")).alias("avg_line_usd"), run_timestamp(run_ts).alias("_last_built_at"),
        )

    def customer_segment_kpis(self, dim_customer: DataFrame, run_ts=None) -> DataFrame:
        """KPIs from the totals of each customer; facts are not read."""
        lifetime = self.kept["customer"].totals.read().select("customer_sk", "orders", "priced", "revenue")
        each = dim_customer.select("customer_segment", "customer_sk").join(lifetime, "customer_sk", "left")
        orders, revenue = F.coalesce("orders", F.lit(0)), F.sum(_revenue())
        return each.groupBy("customer_segment").agg(
            F.count(F.lit(1)).alias("customer_count"), F.count_if(orders > 0).alias("active_customers"),
            ratio(F.sum(orders), F.count(F.lit(1))).alias("avg_orders_per_customer"),
            ratio(revenue, F.count(_revenue())).alias("avg_lifetime_revenue_usd"), revenue.cast(TOTAL).alias("total_revenue_usd"),
        ).withColumn("_last_built_at", run_timestamp(run_ts))
