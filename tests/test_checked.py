from decimal import Decimal as D

import pytest

from conftest import executed_plan, rows
from pyspark.sql import functions as F, types as T
from stratamart.operators.reconcile import checksums, reconcile
from stratamart.sources.checked import LoadRejected, load_checked, reason_counts

SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("price", T.DecimalType(12, 2)), T.StructField("day", T.DateType()),
    T.StructField("note", T.StringType()),
])


def feed(spark):
    return spark.createDataFrame(
        [("1", "2.50", "2024-01-01", "x"), ("2", "abc", "2024-01-01", "y"), (None, "1", "2024-02-30", "z"), ("4", "-3", None, "w"), ("5", None, None, "v")],
        "id string, price string, day string, extra string",
    )


def test_good_and_bad_rows_come_apart_with_reasons(spark):
    load = load_checked(feed(spark), SCHEMA, {"price is negative": F.col("price") < 0})
    assert (load.good_rows, load.bad_rows) == (2, 3)
    assert [tuple(r) for r in load.good.orderBy("id").collect()] == [(1, D("2.50"), __import__("datetime").date(2024, 1, 1), None), (5, None, None, None)]
    assert load.good.schema.simpleString() == T.StructType(SCHEMA.fields).simpleString()
    bad = {r["row"]["extra"]: sorted(r["reasons"]) for r in load.bad.collect()}
    assert bad == {"y": ["price is no decimal(12,2)"], "z": ["day is no date", "id is missing"], "w": ["price is negative"]}
    assert rows(reason_counts(load).where("reason = 'id is missing'")) == [("id is missing", 1)]


def test_a_load_with_too_many_bad_rows_is_rejected(spark, tmp_path):
    with pytest.raises(LoadRejected, match="2 of 5"):
        load_checked(feed(spark), SCHEMA, max_bad_share=0.3, path=str(tmp_path / "load"))
    assert spark.read.parquet(str(tmp_path / "load")).count() == 5
    assert load_checked(feed(spark), SCHEMA, max_bad_share=0.4).bad_rows == 2
    empty = load_checked(feed(spark).limit(0), SCHEMA, max_bad_share=0)
    assert (empty.good_rows, empty.bad_rows, empty.good.count(), empty.bad.count()) == (0, 0, 0, 0)


def test_the_input_is_read_once(spark, tmp_path):
    """A counter in the input tells how often its rows were made."""
    seen = spark.sparkContext.accumulator(0)
    spark.range(100).selectExpr("CAST(id AS STRING) AS id").write.parquet(str(tmp_path / "in"))

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    load = load_checked(spark.read.parquet(str(tmp_path / "in")).mapInArrow(counted, "id string"), SCHEMA)
    assert load.good.count() == 100 and load.bad.count() == 0 and seen.value == 100


def table(spark, *records):
    return spark.createDataFrame(list(records), "k bigint, v string, n decimal(10,2)")


def test_each_kind_of_difference_is_found(spark):
    base = spark.range(2000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.lit(D("1.00")).cast("decimal(10,2)").alias("n"))
    hit = F.when(F.col("k") == 7, "other").otherwise(F.col("v"))
    right = base.where("k NOT IN (3, 4)").withColumn("v", hit).unionByName(base.where("k = 9")).unionByName(table(spark, (5000, "new", D("1"))))
    left = base.unionByName(table(spark, (None, None, None)))
    right = right.unionByName(table(spark, (None, None, None)))
    found = reconcile(left, right.repartition(7), ["k"], ["v", "n"], buckets=64)
    assert rows(found, "k") == [(3, "missing", 1, 0), (4, "missing", 1, 0), (7, "changed", 1, 1), (9, "repeated", 1, 2), (5000, "unexpected", 0, 1)]
    assert reconcile(left, left.repartition(5), ["k"], ["v", "n"]).count() == 0
    assert rows(checksums(left, ["k"], ["v"], 8), "bucket") == rows(checksums(left.repartition(3), ["k"], ["v"], 8), "bucket")


def test_only_rows_of_differing_buckets_are_shuffled(spark, conf):
    conf(spark__sql__adaptive__enabled="false")
    base = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    found = reconcile(base, base.where("k != 5"), ["k"], ["v"], buckets=256)
    assert rows(found) == [(5, "missing", 1, 0)]
    text = executed_plan(found)
    # The rows meet the list of buckets before the first exchange of rows.
    assert text.index("Exchange hashpartitioning(k") < text.index("BroadcastHashJoin")
