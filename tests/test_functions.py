from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.functions import calendar, keys, money, text, timestamps, variants
from stratamart.plans.curated import dim_date, dim_date_of


def one(df, *columns):
    return tuple(df.select(*columns).first())


def test_initcap_starts_words_after_delimiters(spark):
    names = ["mary-jane o'neil x.y", "ANNA MARIA", "a_b", "tab\there", "semi;colon/slash", "", None, "(x) [y] {z} <w>"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = [r[0] for r in df.select(text.initcap_delimited("n")).collect()]
    assert found == ["Mary-Jane O'neil X.Y", "Anna Maria", "A_B", "Tab\tHere", "Semi;Colon/Slash", "", None, "(X) [Y] {Z} <W>"]


def test_full_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(text.full_name("f", "l")).collect()] == ["A B", None, None]


def test_surrogate_key_does_not_depend_on_the_number_type(spark):
    df = spark.sql("SELECT 7 AS i, 7L AS l, CAST(7 AS DECIMAL(38,0)) AS d, CAST(NULL AS BIGINT) AS n")
    i, l, d, n = one(df, *[keys.surrogate_key(c) for c in "ildn"])
    assert i == l == d and n is not None and n != i


def test_surrogate_keys_are_distinct(spark):
    df = spark.range(200_000).select(keys.surrogate_key("id").alias("sk"))
    assert df.distinct().count() == 200_000


def test_date_key(spark):
    df = spark.createDataFrame([(date(2024, 2, 9),), (None,)], "d date")
    assert [r[0] for r in df.select(keys.date_key("d")).collect()] == [20240209, None]


def test_usd_is_rounded_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(12,2)) AS v, 0.5D AS r FROM VALUES (0.01), (-0.01), (0.03), (NULL) t(v)")
    found = [r[0] for r in df.select(money.to_usd(F.col("v"), F.col("r"))).collect()]
    assert found == [Decimal("0.01"), Decimal("-0.01"), Decimal("0.02"), None]


def test_usd_in_floating_point(spark):
    df = spark.sql("SELECT CAST(10 AS DECIMAL(12,2)) AS v, 0.333D AS r")
    assert one(df, money.to_usd(F.col("v"), F.col("r"), exact=False)) == (3.33,)


def test_mean_skips_nulls_and_survives_an_empty_group(spark):
    df = spark.sql("SELECT k, CAST(v AS DECIMAL(18,2)) AS v FROM VALUES (1, 1.00), (1, 1.01), (1, NULL), (2, NULL) t(k, v)")
    found = {r[0]: r[1] for r in df.groupBy("k").agg(money.mean("v")).collect()}
    assert found == {1: Decimal("1.01"), 2: None}  # 1.005 goes up


def test_zero_rate_fails(spark):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        spark.sql("SELECT 0.0D AS r").select(money.usd_per_unit("r")).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    df = spark.sql("SELECT 1730613600123456L AS us, 1730613600L AS s, TIMESTAMP'2024-11-03 01:30:00-05:00' AS z")
    found = one(
        df, timestamps.from_epoch_micros("us"), timestamps.to_epoch_micros(timestamps.from_epoch_micros("us")),
        timestamps.utc_date("s"), timestamps.utc_naive("z"),
    )
    assert found == (
        datetime(2024, 11, 3, 6, 0, 0, 123456), 1730613600123456, date(2024, 11, 3), datetime(2024, 11, 3, 6, 30),
    )


def test_utc_date_before_the_epoch(spark):
    assert one(spark.sql("SELECT -1L AS s"), timestamps.utc_date("s")) == (date(1969, 12, 31),)


def test_default_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 3287
    found = {r.date: r for r in days.where("date IN ('2022-01-01', '2024-02-29', '2030-12-31')").collect()}
    new_year = found[date(2022, 1, 1)]
    assert (new_year.date_key, new_year.week_of_year, new_year.day_of_week, new_year.day_name) == (20220101, 52, 6, "Sat")
    assert new_year.is_weekend is True and new_year.month_name == "Jan"
    leap = found[date(2024, 2, 29)]
    assert (leap.month_start, leap.month_end, leap.quarter_start, leap.year_start) == (
        date(2024, 2, 1), date(2024, 2, 29), date(2024, 1, 1), date(2024, 1, 1),
    )
    assert found[date(2030, 12, 31)].quarter == 4


def test_calendar_of_a_column_covers_gaps(spark):
    df = spark.createDataFrame([(date(2024, 1, 30),), (date(2024, 2, 2),), (None,)], "d date")
    assert [r.date_key for r in dim_date_of(df, "d").orderBy("date").collect()] == [20240130, 20240131, 20240201, 20240202]


def test_month_before_clamps_to_the_last_day(spark):
    df = spark.sql("SELECT DATE'2023-03-31' AS d")
    assert one(df, calendar.months_before(F.col("d"), 1)) == (date(2023, 2, 28),)


def test_variant_paths(spark):
    df = spark.createDataFrame([('{"id": null}',), ('{"x": 1}',), ('{"id": 1.5, "r": {"c": 3}}',)], "j string").select(
        F.parse_json("j").alias("v")
    )
    assert [r[0] for r in df.select(variants.has_path("v", "$.id")).collect()] == [True, False, True]
    assert [r[0] for r in df.select(variants.integer_field("v", "$.id")).collect()] == [None, None, 2]
    assert [r[0] for r in df.select(variants.field("v", "$.r.c", "bigint")).collect()] == [None, None, 3]


def test_bad_variant_cast_fails_unless_lenient(spark):
    df = spark.sql("""SELECT parse_json('{"id": "abc"}') AS v""")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.select(variants.integer_field("v", "$.id")).collect()
    assert one(df, variants.integer_field("v", "$.id", strict=False)) == (None,)
