import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import executed_plan, plan, rows
from stratamart.constants import LAYERS
from stratamart.operators import quality
from stratamart.operators.currency import flatten_fx_payload, latest_fx, with_fx_as_of, with_latest_fx
from stratamart.operators.history import _stretches, scd2
from stratamart.operators.latest import latest_by_key
from stratamart.operators.lookups import lookup_join, pin, salted_join
from stratamart.operators.merge import changed_since, high_water_mark, upsert


# --- latest row per key


def test_latest_prefers_a_null_time_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, "a"), (1, None, "b"), (2, 1, "x"), (2, 2, "y"), (3, 1, "p"), (3, 1, "q")], "k int, t int, v string"
    )
    assert rows(latest_by_key(df, ["k"], ["t"], ["v"]), "k") == [(1, None, "b"), (2, 2, "y"), (3, 1, "q")]


def test_latest_limits_each_key_before_the_shuffle(spark):
    text = plan(latest_by_key(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")  # printed top down: the last one is below it


def test_hot_key_sends_one_row_per_map_task(spark):
    """A key with most rows crosses the shuffle once per task."""
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = latest_by_key(df, ["k"], ["t"])
    execution = latest._jdf.queryExecution()
    assert latest.where("k = 0").first()["t"] == 39_996
    execution.toRdd().count()
    text = execution.executedPlan().toString()
    assert "WindowGroupLimit" in text and latest.count() == 12_001


# --- lookups


def facts(spark, n=3_000):
    """Half of the rows have one key."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "A").otherwise(F.concat(F.lit("K"), F.col("id") % 50)).alias("c")
    )


def lookup(spark):
    return spark.createDataFrame([("A", 1.0)] + [(f"K{i}", float(i)) for i in range(0, 40)], "c string, v double")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_a_plain_join_on_both_ways(spark, how):
    expected = rows(facts(spark).join(lookup(spark), "c", how).select("id", "c", "v"), "id")
    for bound in (10_000, 5):
        joined = lookup_join(facts(spark), lookup(spark), ["c"], how, max_rows=bound)
        assert rows(joined.select("id", "c", "v"), "id") == expected


def test_lookup_is_broadcast_only_within_the_bound(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert "BroadcastHashJoin" in plan(lookup_join(facts(spark), lookup(spark), ["c"]))
    beyond = plan(lookup_join(facts(spark), lookup(spark), ["c"], max_rows=5))
    assert "BroadcastHashJoin" not in beyond and "_salt" in beyond


def test_salt_spreads_a_hot_key(spark):
    spread = facts(spark).withColumn("_salt", F.pmod(F.xxhash64("id", "c"), F.lit(16)))
    biggest = spread.where("c = 'A'").groupBy("_salt").count().agg(F.max("count")).first()[0]
    assert biggest < 2 * 1_500 / 16
    assert salted_join(facts(spark), lookup(spark), ["c"], "left", salts=16).count() == 3_000


def test_pin_counts_while_writing(spark):
    written, count = pin(spark.range(7), "t")
    assert count == 7 and written.count() == 7


# --- currency


def flatten(spark, *payloads, **options):
    df = spark.createDataFrame([(p,) for p in payloads], "j string")
    return rows(flatten_fx_payload(df, "j", **options), "base", "rate_date", "currency")


def test_fx_payload_shapes_and_fallbacks(spark):
    day = date(2024, 5, 1)
    assert flatten(spark, '{"source":"USD","date":"2024-05-01","quotes":{"USDEUR":0.9,"USDGBP":0.8}}') == [
        ("USD", day, "EUR", 0.9), ("USD", day, "GBP", 0.8)
    ]
    assert flatten(spark, '{"base":"EUR","date":"2024-05-01","rates":{"GBP":0.85}}') == [("EUR", day, "GBP", 0.85)]
    assert flatten(spark, '{"source":"","timestamp":1714521600,"quotes":{},"rates":{"EUR":0.9}}') == [
        ("USD", day, "EUR", 0.9)
    ]
    assert flatten(spark, '{"source":"GBP","base":"USD","date":"","timestamp":1714607999,"quotes":{"GBPEUR":1.1}}') == [
        ("GBP", day, "EUR", 1.1)
    ]


def test_fx_payload_without_rates_fails_or_is_left_out(spark):
    empty = '{"source":"USD","date":"2024-05-01","quotes":{}}'
    with pytest.raises(Exception, match="no rates"):
        flatten(spark, empty)
    assert flatten(spark, empty, '{"date":"2024-05-01","rates":{"EUR":1.0}}', on_empty="drop") == [
        ("USD", date(2024, 5, 1), "EUR", 1.0)
    ]


def test_malformed_fx_payload_fails(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        flatten(spark, '{"source": ')


def test_only_what_quotes_share_is_copied_to_them(spark):
    """A payload holds all its quotes, so a copy of it for each grows by their square; it is parsed once."""
    df = spark.createDataFrame([('{"source":"USD","date":"2024-05-01","quotes":{"USDEUR":0.9,"USDGBP":0.8}}',)], "j string")
    steps = plan(flatten_fx_payload(df, "j"))
    (exploded,) = [line for line in steps.splitlines() if "Generate explode" in line]
    assert "_body" not in exploded and steps.count("from_json") == 1


def test_date_of_a_payload_without_quotes_is_not_read(spark):
    odd = '{"date":"soon","quotes":{},"rates":{}}'
    assert flatten(spark, odd, '{"date":"2024-05-01","rates":{"EUR":1.0}}', on_empty="drop") == [("USD", date(2024, 5, 1), "EUR", 1.0)]
    with pytest.raises(Exception, match="fx payload has no rates"):
        flatten(spark, odd)


RATES = [
    ("EUR", date(2024, 1, 1), 1.1), ("EUR", date(2024, 1, 10), 1.2), ("GBP", date(2024, 1, 5), 1.3), ("USD", None, 1.0),
]


def rates(spark):
    return spark.createDataFrame(RATES, "target_currency string, rate_date date, usd_per_unit double")


def test_latest_fx(spark):
    assert rows(latest_fx(rates(spark)), "target_currency") == [("EUR", 1.2), ("GBP", 1.3), ("USD", 1.0)]


def test_latest_fx_keeps_unpriced_facts(spark):
    df = spark.createDataFrame([(1, "EUR"), (2, "CHF"), (3, None)], "id int, cur string")
    assert rows(with_latest_fx(df, rates(spark), "cur").select("id", "usd_per_unit"), "id") == [(1, 1.2), (2, None), (3, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_fx_as_of_equals_a_search_per_row(spark, seed):
    dice = random.Random(seed)
    start = date(2024, 1, 1)
    known = {(c, start + timedelta(dice.randrange(60))): dice.random() for c in "AB" for _ in range(12)}
    orders = [(i, dice.choice(["A", "A", "A", "B", "C", None]), start + timedelta(dice.randrange(-5, 70))) for i in range(400)]
    orders.append((400, "A", None))
    rate_df = spark.createDataFrame([(c, d, v) for (c, d), v in known.items()], "target_currency string, rate_date date, usd_per_unit double")
    order_df = spark.createDataFrame(orders, "id int, cur string, day date")

    def search(cur, day):
        past = [(d, v) for (c, d), v in known.items() if c == cur and day is not None and d <= day]
        return max(past)[1] if past else None

    found = with_fx_as_of(order_df, rate_df, "cur", "day").select("id", "usd_per_unit")
    assert rows(found, "id") == [(i, search(c, d)) for i, c, d in orders]


# --- history


def spells_by_hand(events):
    """(user, id) -> (from, to, current), one pass per user in time order."""
    result, by_user = {}, defaultdict(list)
    for user, ts, number, state in events:
        by_user[user].append((ts, number, state))
    for user, history in by_user.items():
        history.sort(key=lambda e: (e[0] is None, e[0] or datetime.min, e[1]))
        changes = [e for i, e in enumerate(history) if i == 0 or history[i - 1][2] != e[2]]
        for here, after in zip(changes, changes[1:] + [None]):
            result[user, here[1]] = (here[0], after and after[0], after is None)
    return result


@pytest.mark.parametrize("rows_per_task", [20, 300, 10**6])
def test_scd2_equals_a_pass_per_key_with_a_hot_key(spark, rows_per_task):
    dice = random.Random(7)
    start = datetime(2024, 1, 1)
    events = [
        (dice.choice([0, 0, 0, 1, 2, 3]), start + timedelta(minutes=dice.randrange(8_000)), i, dice.choice([None, "a", "b"]))
        for i in range(1_500)
    ]
    events.append((0, None, 5_000, "a"))
    df = spark.createDataFrame([*events, (None, start, 5_001, "a")], "user int, ts timestamp_ntz, id int, state string")
    found = scd2(df, ["user"], "ts", ["state"], ["id"], rows_per_task)
    assert {(r.user, r.id): (r.valid_from, r.valid_to, r.is_current) for r in found.collect()} == spells_by_hand(events)


def test_scd2_cuts_a_burst_evenly(spark):
    """A hot key whose rows crowd into one second is still cut into small stretches."""
    start = datetime(2024, 1, 1)
    df = spark.range(4_000).select(
        F.lit(1).alias("user"),
        F.timestamp_add("MICROSECOND", F.when(F.col("id") < 100, F.col("id") * 10**9).otherwise(F.lit(10**11) + F.col("id")),
                        F.lit(start).cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 3).alias("state"),
    )
    cut = _stretches(df, ["user"], "ts", 500)
    assert cut.groupBy("_stretch").count().agg(F.max("count")).first()[0] <= 600
    spells = scd2(df, ["user"], "ts", ["state"], rows_per_task=500)
    assert spells.count() == 4_000 and spells.where("is_current").count() == 1
    assert spells.where("valid_to <= valid_from").count() == 0


# --- increments


def test_changed_since_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, None)], "id int, m timestamp_ntz"
    ).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    changed = changed_since(source, "m", datetime(2024, 1, 1))
    assert rows(changed.select("id"), "id") == [(1,), (2,), (3,)]
    assert "GreaterThanOrEqual(m" in plan(changed)
    assert changed_since(source, "m", None).count() == 3
    assert high_water_mark(source, "m").first()[0] == datetime(2024, 1, 2)


def test_upsert(spark):
    schema = "id int, m int, v string"
    target = spark.createDataFrame([(1, 1, "keep"), (2, 5, "newer"), (3, 1, "old")], schema)
    changes = spark.createDataFrame([(2, 4, "late"), (3, 2, "mid"), (3, 3, "new"), (4, 1, "insert"), (None, 9, "no key")], schema)
    merged = upsert(target, changes, ["id"], ["m"], ["v"])
    assert rows(merged, "id") == [(1, 1, "keep"), (2, 5, "newer"), (3, 3, "new"), (4, 1, "insert")]
    assert plan(merged).count("BroadcastHashJoin") == 2
    again = upsert(merged, changes, ["id"], ["m"], ["v"])
    assert rows(again, "id") == rows(merged, "id")
    beyond = upsert(target, changes, ["id"], ["m"], ["v"], max_keys=1)
    assert rows(beyond, "id") == rows(merged, "id")


# --- quality


def test_row_counts_lists_separators(spark):
    report = quality.row_counts({"raw": {"a": spark.range(3)}, "marts": {"b": spark.range(0)}})
    assert rows(report, "position") == [(0, "RAW.A", 3), (1, "--- MARTS ---", None), (2, "MARTS.B", 0)]


def test_orphans_and_ranges(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    assert quality.orphan_count(child, spark.createDataFrame([(1,)], "k int"), ["k"]).first()[0] == 3
    assert "LeftAnti" in plan(quality.orphans(child, child, ["k"]))
    assert tuple(quality.value_range(child, "k", F.avg("k")).first()) == (1, 2, pytest.approx(5 / 3))


def test_missing_members(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("b",)], "x string")
    assert rows(quality.missing_members(expected, spark.createDataFrame([("a",)], "x string"), "x")) == [("b",)]


def test_layer_namespaces(spark):
    assert quality.missing_layers(spark, "nope_").count() == len(LAYERS)
    for layer in LAYERS[1:]:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS chk_{layer}")
    assert rows(quality.missing_layers(spark, "chk_")) == [("chk_raw",)]
    assert [r[0] for r in quality.present_layers(spark, "chk_").collect()] == sorted(f"chk_{x}" for x in LAYERS[1:])


def test_feed_shape(spark):
    payloads = spark.createDataFrame(
        [('{"quotes":{"USDEUR":1.0}}',), ('{"rates":{"EUR":1.0}}',), ('{"quotes":{}}',), ("[1]",)], "j string"
    )
    assert dict(rows(quality.feed_shape(payloads, "j", "USDEUR"))) == {"is_object": 1, "non_empty": 2, "has_required_quote": 3}


def test_enforce(spark):
    quality.enforce(quality.expect_non_empty(spark.range(1), "t"))
    with pytest.raises(quality.CheckFailed, match="t is not empty"):
        quality.enforce(quality.expect_non_empty(spark.range(0), "t"))


def test_trace_key(spark):
    raw = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    dim = raw.select(F.col("id").alias("nk"), "v")
    traced = quality.trace_key([("RAW", raw, "id", ("id", "v")), ("DIM", dim, "nk", ("nk", "v"))], raw.agg(F.min("id")), ("id", "v"))
    assert rows(traced, "layer", "v") == [("DIM", 1, "a"), ("DIM", 1, "b"), ("RAW", 1, "a"), ("RAW", 1, "b")]


@pytest.mark.parametrize("max_keys", [0, 1_000])
def test_upsert_leaves_untouched_rows_alone_on_either_branch(spark, max_keys):
    target = spark.createDataFrame([(1, 5, "a"), (2, 1, "old"), (9, 1, "x"), (9, 1, "x"), (None, 1, "n"), (None, 2, "m")], "id int, at int, v string")
    changes = spark.createDataFrame([(2, 3, "new"), (3, 1, "added"), (1, 2, "older"), (None, 9, "no key")], "id int, at int, v string")
    got = sorted(map(tuple, upsert(target, changes, ["id"], ["at"], ["v"], max_keys).collect()), key=str)
    assert got == sorted([(1, 5, "a"), (2, 3, "new"), (3, 1, "added"), (9, 1, "x"), (9, 1, "x"), (None, 1, "n"), (None, 2, "m")], key=str)


def test_rows_at_the_mark_are_read_again(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3)), (4, None)], "id int, at timestamp_ntz")
    assert sorted(r.id for r in changed_since(df, "at", datetime(2024, 1, 2)).collect()) == [2, 3, 4]


@pytest.mark.parametrize("rows_per_task", [2, 1_000])
def test_untimed_rows_are_the_newest_and_one_row_is_current(spark, rows_per_task):
    df = spark.createDataFrame(
        [(1, None, 1, "a"), (1, None, 2, "b"), (1, datetime(2024, 1, 1), 3, "c"), (2, datetime(2024, 1, 1), 4, "d")],
        "id int, at timestamp_ntz, n int, state string",
    )
    spells = scd2(df, ["id"], "at", ["state"], ["n"], rows_per_task)
    got = sorted((r.id, r.state, r.valid_to, r.is_current) for r in spells.collect())
    assert got == [(1, "a", None, False), (1, "b", None, True), (1, "c", None, False), (2, "d", None, True)]
