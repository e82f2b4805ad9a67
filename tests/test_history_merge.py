import random
from datetime import date, datetime, timedelta

import pytest

from conftest import executed_plan, rows
from pyspark.sql import functions as F
from stratamart.operators.history import merge_history, observed, scd2
from stratamart.operators.in_force import join_as_of, join_in_force
from stratamart.operators.lookups import pin

T0 = datetime(2024, 1, 1)
VERSIONS = "k bigint, at timestamp_ntz, s string, n bigint"
OUT = ("k", "at", "s", "n", "valid_from", "valid_to", "is_current")


def versions(seed, keys=6, most=9):
    rng = random.Random(seed)
    out = []
    for k in range(keys):
        for n in range(rng.randint(1, most)):
            out.append((k, rng.choice((None, *[T0 + timedelta(hours=h) for h in range(6)])), rng.choice("ab"), n))
    return out


def history(df):
    return sorted(map(str, rows(df.select(*OUT))))


@pytest.mark.parametrize("seed, rows_per_task", [(1, 5_000_000), (2, 3), (3, 5_000_000)])
def test_any_split_into_batches_gives_the_history_of_one_pass(spark, seed, rows_per_task):
    every = versions(seed)
    shape = (["k"], "at", ["s"], ["n"])
    want = history(scd2(spark.createDataFrame(every, VERSIONS), *shape))
    rng = random.Random(seed)
    rng.shuffle(every)
    cuts = sorted(rng.sample(range(1, len(every)), 2))
    stored = observed(spark.createDataFrame(every[: cuts[0]], VERSIONS), *shape, rows_per_task)
    for batch in (every[cuts[0] : cuts[1]], every[cuts[1] :] + every[:3]):  # some arrive a second time
        stored, _ = pin(merge_history(stored, spark.createDataFrame(batch, VERSIONS), *shape, rows_per_task), "merged")
    assert history(stored.where("opens")) == want
    assert stored.count() == len(every)


def test_a_late_version_splits_and_shortens(spark):
    h = [T0 + timedelta(hours=x) for x in range(5)]
    shape = (["k"], "at", ["s"], ["n"])
    start = [(1, h[0], "a", 0), (1, h[2], "a", 1), (1, h[4], "b", 2), (2, h[0], "x", 0)]
    stored, _ = pin(observed(spark.createDataFrame(start, VERSIONS), *shape), "stored")
    spells = stored.where("opens").select("k", "s", "valid_from", "valid_to", "is_current")
    assert rows(spells, "k", "valid_from") == [(1, "a", h[0], h[4], False), (1, "b", h[4], None, True), (2, "x", h[0], None, True)]
    late = spark.createDataFrame([(1, h[1], "b", 0), (1, h[3], "b", 0), (None, h[0], "z", 0)], VERSIONS)
    merged = merge_history(stored, late, *shape).where("opens").select("k", "s", "valid_from", "valid_to", "is_current")
    assert rows(merged, "k", "valid_from") == [
        (1, "a", h[0], h[1], False), (1, "b", h[1], h[2], False), (1, "a", h[2], h[3], False), (1, "b", h[3], None, True), (2, "x", h[0], None, True),
    ]


FACTS = "id bigint, k bigint, day date"
SPELLS = "k bigint, v string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def test_the_spell_that_holds_the_day(spark):
    d = lambda n: date(2024, 1, 1) + timedelta(days=n)
    t = lambda n: T0 + timedelta(days=n)
    facts = spark.createDataFrame(
        [(1, 1, d(0)), (2, 1, d(9)), (3, 1, d(10)), (4, 1, d(400)), (5, 2, d(3)), (6, 3, d(3)), (7, None, d(3)), (8, 1, None), (9, 2, d(2))], FACTS
    )
    spells = spark.createDataFrame(
        [(1, "a", t(0), t(10)), (1, "b", t(10), None), (2, "c", t(3), t(4)), (2, "e", t(4), t(4)), (3, "u", None, None), (None, "n", t(0), None)], SPELLS
    )
    for slot in (90, 1, 0.5):
        found = join_in_force(facts, spells, ["k"], "day", ["v", "valid_from"], slot_days=slot).select("id", "v")
        assert rows(found, "id") == [(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c"), (6, None), (7, None), (8, None), (9, None)]
    assert join_in_force(facts.where("false"), spells, ["k"], "day", ["v"]).count() == 0


def test_a_hot_key_is_spread_over_time(spark, conf):
    """Two thirds of the facts have one key; no task of the join gets them all."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="16")
    facts = spark.range(6000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.date_add(F.lit(T0.date()), (F.col("id") % 900).cast("int")).alias("day"))
    spells = spark.createDataFrame([(7, "a", T0, None)], SPELLS)
    joined = join_in_force(facts, spells, ["k"], "day", ["v"], slot_days=30)
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 6000 and max(sizes) < 3000
    assert "Cartesian" not in executed_plan(joined) and "NestedLoop" not in executed_plan(joined)


def test_the_last_value_at_or_before_a_moment(spark):
    t = lambda **d: T0 + timedelta(**d)
    values = spark.createDataFrame(
        [("e", t(hours=1), 1.0, 0), ("e", t(hours=1), 2.0, 1), ("e", t(days=3, microseconds=5), 3.0, 0), ("g", T0, None, 0), ("e", None, 9.0, 0), (None, T0, 8.0, 0)],
        "c string, at timestamp_ntz, rate double, n bigint",
    )
    asked = [
        (1, "e", T0), (2, "e", t(hours=1)), (3, "e", t(days=2)), (4, "e", t(days=3, microseconds=4)), (5, "e", t(days=3, microseconds=5)),
        (6, "e", t(days=40)), (7, "g", t(days=1)), (8, "x", T0), (9, None, T0), (10, "e", None),
    ]
    facts = spark.createDataFrame([(*a, 0) for a in asked], "id bigint, c string, at timestamp_ntz, n bigint")
    for slot in (1, 0.01, 365):
        found = join_as_of(facts, values, ["c"], "at", "at", ["rate"], ["n"], slot_days=slot)
        assert found.columns == ["id", "c", "at", "n", "rate"]
        assert rows(found.select("id", "rate"), "id") == [
            (1, None), (2, 2.0), (3, 2.0), (4, 2.0), (5, 3.0), (6, 3.0), (7, None), (8, None), (9, None), (10, None),
        ]


def test_one_key_is_many_tasks(spark, conf):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    moments = spark.range(5000).select("id", F.lit("e").alias("c"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(T0).cast("timestamp_ntz")).alias("at"))
    values = moments.where("id % 50 = 0").select("c", "at", F.col("id").alias("rate"))
    found = join_as_of(moments, values, ["c"], "at", "at", ["rate"], slot_days=3)
    assert found.where("rate != id - id % 50").count() == 0 and found.count() == 5000
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 2500
