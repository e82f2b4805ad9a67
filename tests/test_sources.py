import gzip
import json
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan, rows
from stratamart import schemas
from stratamart.constants import LAYERS
from stratamart.operators import quality, watermarks
from stratamart.operators.currency import flatten_fx_payload
from stratamart.plans import build, curated
from stratamart.session import shared_dir
from stratamart.sources import jdbc, landing, retail_feeds
from stratamart.sources.store import LayerStore
from stratamart.streaming import ingest
from stratamart.workload import queries

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.StringType())])


def test_landed_parquet_is_read_by_name(spark, tmp_path):
    df = spark.createDataFrame([("x", 5, 9)], "v string, id bigint, other int")
    assert landing.land_parquet(df, str(tmp_path), "t", "r1") == 1
    found = landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA, run_ts="2024-01-01 00:00:00")
    assert found.columns == ["id", "at", "v", "_load_ts", "_source_file"]
    row = found.first()
    assert (row.id, row.at, row.v, row._load_ts) == (5, None, "x", datetime(2024, 1, 1))
    assert "run_id=r1" in row._source_file


def test_stored_types_are_cast_to_the_declared_ones(spark, tmp_path):
    declared = T.StructType([*SCHEMA.fields, T.StructField("price", T.DecimalType(12, 2)), T.StructField("t", T.TimestampNTZType())])
    df = spark.sql("SELECT 1 AS ID, 1000001L AS at, 7 AS v, 1.005D AS price, TIMESTAMP'2024-01-01 12:00:00+02:00' AS t")
    landing.land_parquet(df, str(tmp_path), "t", "r1")
    found = landing.read_landed_parquet(spark, str(tmp_path), "t", declared).drop("_load_ts", "_source_file")
    assert found.schema.simpleString() == declared.simpleString()
    assert tuple(found.first()) == (1, datetime(1970, 1, 1, 0, 0, 1, 1), "7", Decimal("1.01"), datetime(2024, 1, 1, 10))


def test_noted_columns_spare_the_footers(spark, tmp_path):
    """A run's files are not opened to learn its columns, unless others have added files to it."""
    landing.land_parquet(spark.createDataFrame([(5, "x")], "id int, v string").coalesce(1), str(tmp_path), "t", "r1")
    run = tmp_path / "t" / "run_id=r1"
    (part,) = run.glob("part-*.parquet")
    content = part.read_bytes()
    part.write_bytes(bytes(len(content)))
    found = landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA).drop("_load_ts", "_source_file")
    part.write_bytes(content)
    (run / f".{part.name}.crc").unlink()
    assert rows(found) == [(5, None, "x")]
    spark.createDataFrame([(6, 1000000)], "id int, at bigint").write.mode("append").parquet(str(run))
    both = landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA).drop("_load_ts", "_source_file")
    assert rows(both, "id") == [(5, None, "x"), (6, datetime(1970, 1, 1, 0, 0, 1), None)]
    landing.land_parquet(spark.createDataFrame([("y", 7)], "v string, id bigint"), str(tmp_path), "t", "r1")
    assert rows(landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA).select("id", "v")) == [(7, "y")]


def test_value_that_does_not_fit_fails(spark, tmp_path):
    landing.land_parquet(spark.sql("SELECT 'abc' AS id"), str(tmp_path), "t", "r1")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA).collect()


def test_latest_run_wins(spark, tmp_path):
    for run in ("20240101T000000", "20240201T000000"):
        landing.land_parquet(spark.createDataFrame([(1, run)], "id bigint, v string"), str(tmp_path), "t", run)
    assert landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA).first()["v"] == "20240201T000000"
    assert landing.read_landed_parquet(spark, str(tmp_path), "t", SCHEMA, "20240101T000000").first()["v"] == "20240101T000000"
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        landing.latest_run(spark, str(tmp_path), "none")


def ids(df):
    return sorted(r[0] for r in df.select(F.variant_get("raw_data", "$.id", "int")).collect())


def test_json_lines_and_arrays(spark, tmp_path):
    with gzip.open(tmp_path / "feed.json.gz", "wt") as f:
        f.write('[{"id": 1}, {"id": 2}]\n{"id": 3}\n')
    found = landing.read_json_rows(spark, str(tmp_path / "feed.json.gz"))
    assert ids(found) == [1, 2, 3]
    assert found.first()["_source_file"].endswith("feed.json.gz")


def test_pretty_printed_array(spark, tmp_path):
    (tmp_path / "feed.json").write_text(json.dumps([{"id": i} for i in range(5)], indent=2))
    assert ids(landing.read_json_rows(spark, str(tmp_path / "feed.json"), whole_file=True)) == [0, 1, 2, 3, 4]


def test_feed_must_be_a_list(spark, tmp_path):
    (tmp_path / "feed.json").write_text('{"error": "limit"}')
    with pytest.raises(Exception, match="not a list"):
        landing.read_json_rows(spark, str(tmp_path / "feed.json"), require_array=True).collect()


def test_malformed_feed_fails(spark, tmp_path):
    (tmp_path / "feed.json").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        landing.read_json_rows(spark, str(tmp_path / "feed.json")).collect()


def test_jdbc_slices_and_timestamps(spark):
    assert jdbc.Slices("order_id", 1, 100, 4).options() == {
        "partitionColumn": "order_id", "lowerBound": "1", "upperBound": "100", "numPartitions": "4"
    }
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 12:00:00+02:00' AS z, TIMESTAMP_NTZ'2024-01-01 12:00:00' AS n, 1 AS i")
    found = jdbc.normalise_timestamps(df)
    assert tuple(found.first()) == (datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12), 1)
    assert [f.dataType.simpleString() for f in found.schema] == ["timestamp_ntz", "timestamp_ntz", "int"]


# --- layer tables


@pytest.fixture
def store(spark, tmp_path):
    made = LayerStore(spark, str(tmp_path / "lake"), f"t{abs(hash(str(tmp_path))) % 10**8}_")
    made.create_layers()
    yield made
    made.reset()


def test_a_write_switches_versions(spark, store):
    assert quality.missing_layers(spark, store.prefix).count() == 0
    assert store.write(spark.range(3), "staging", "t", "r1") == 3
    reader = store.read("staging", "t")
    assert store.write(spark.range(5), "staging", "t", "r2") == 5
    assert "/run_id=r2/" in store.location("staging", "t")
    assert store.read("staging", "t").count() == 5 and reader.count() == 3  # the old version stays readable


def test_a_failed_write_leaves_the_table(spark, store):
    store.write(spark.range(3), "staging", "t", "r1")
    with pytest.raises(Exception):
        store.write(spark.range(3).select(F.raise_error(F.lit("bad")).cast("bigint").alias("id")), "staging", "t", "r2")
    assert store.read("staging", "t").count() == 3


def test_a_failed_retry_of_the_same_run_leaves_the_table(spark, store):
    store.write(spark.range(5), "staging", "t", "r1")
    with pytest.raises(Exception):
        store.write(spark.range(3).select(F.raise_error(F.lit("bad")).cast("bigint").alias("id")), "staging", "t", "r1")
    assert store.read("staging", "t").count() == 5


def test_a_write_can_read_what_it_replaces(spark, store):
    store.write(spark.range(3), "staging", "t", "r1")
    store.write(store.read("staging", "t").where("id > 0"), "staging", "t", "r2")
    assert store.read("staging", "t").count() == 2


def test_schema_change_and_variants(spark, store):
    store.create_empty("raw", "p", schemas.raw_table("products"))
    assert store.read("raw", "p").count() == 0
    store.write(spark.sql("""SELECT parse_json('{"a": 1}') AS raw_data"""), "raw", "p", "r1")
    assert store.read("raw", "p").columns == ["raw_data"]


def test_raw_tables_can_be_declared_first(spark, store):
    build.create_raw_tables(store)
    for name in build.RAW_TABLES:
        assert store.read("raw", name).schema.simpleString() == schemas.raw_table(name).simpleString()


def test_root_with_a_quote(spark, tmp_path):
    made = LayerStore(spark, str(tmp_path / "it's a lake"), "quoted_")
    made.create_layers()
    made.write(spark.range(2), "raw", "t", "r1")
    made.write(spark.range(3), "raw", "t", "r2")
    assert made.read("raw", "t").count() == 3
    made.reset()


def test_append_and_reset(spark, store):
    store.append(spark.range(2), "metadata", "log")
    store.append(spark.range(3), "metadata", "log")
    assert store.read("metadata", "log").count() == 5
    store.reset()
    assert not store.exists("metadata", "log")
    store.append(spark.range(1), "metadata", "log")
    assert store.read("metadata", "log").count() == 1  # rows from before the reset do not come back


def test_a_replaced_table_goes_on_as_history(spark, store):
    store.write(spark.range(3), "raw", "t", "r1")
    store.append_run(spark.range(10, 12), "raw", "t", "r2")
    store.append_run(spark.range(10, 12), "raw", "t", "r2")
    assert rows(store.read("raw", "t").select("id", "_run"), "id") == [(0, "initial"), (1, "initial"), (2, "initial"), (10, "r2"), (11, "r2")]


def test_files_of_a_run_with_different_columns(spark, tmp_path):
    folder = f"{tmp_path}/landing/t/run_id=r1"
    spark.sql("SELECT 1 AS a").coalesce(1).write.parquet(folder)
    spark.sql("SELECT 2 AS a, 'x' AS b").coalesce(1).write.mode("append").parquet(folder)
    read = landing.read_landed_parquet(spark, f"{tmp_path}/landing", "t", T.StructType.fromDDL("a int, b string"))
    assert rows(read.select("a", "b"), "a") == [(1, None), (2, "x")]


def test_unfinished_runs_are_not_taken(spark, tmp_path):
    root = f"{tmp_path}/landing"
    for dataset, runs in (("x", ("r1", "r2")), ("y", ("r1",))):
        for run in runs:
            landing.land_parquet(spark.range(1), root, dataset, run)
    (tmp_path / "landing/x/run_id=r3/_temporary").mkdir(parents=True)
    assert landing.latest_run(spark, root, "x") == "r2"
    assert landing.latest_common_run(spark, root, ["x", "y"]) == "r1"


def test_watermarks(spark, store):
    source = spark.createDataFrame([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, m timestamp_ntz")
    first = watermarks.extract_changes(store, source, "orders", "m")
    assert first.count() == 2
    watermarks.record_mark(store, "orders", first, "m")
    assert rows(watermarks.extract_changes(store, source, "orders", "m").select("id")) == [(2,)]  # at the mark: read again
    watermarks.record_mark(store, "orders", first.limit(0), "m")
    later = source.unionByName(spark.createDataFrame([(3, datetime(2024, 1, 3))], source.schema))
    assert rows(watermarks.extract_changes(store, later, "orders", "m").select("id"), "id") == [(2,), (3,)]


def test_full_build_is_repeatable(spark, store):
    d = "/root/testdata/sf0.001"
    sources = queries.feed_sources(spark, d)
    results = []
    for run_id in ("20240101T000000", "20240102T000000"):
        run = build.Run(run_id=run_id, run_ts="2024-01-01 00:00:00", as_of=date(2024, 1, 1), calendar_start=date(1995, 1, 1), calendar_end=date(2001, 12, 31))
        log = build.run_all(store, sources, f"{store.root}/landing", run)
        assert log.count() == 18
        results.append({t: sorted(map(str, store.read("marts", t).collect())) for t in ("revenue_by_category", "revenue_by_country", "customer_segment_kpis")})
    assert results[0] == results[1]
    assert store.read("metadata", "run_log").count() == 36
    staged = store.read("staging", "stg_order_items")
    assert staged.count() == staged.select("order_item_id").distinct().count() == store.read("curated", "fct_order_items").count()
    outcome = dict(rows(build.check(store, run).select("rule", "failures")))
    assert outcome["items have an order"] == 0 and outcome["orders have an exchange rate"] > 0
    as_of = build.Run(run_id="20240103T000000", run_ts=run.run_ts, fx_as_of_order_date=True, calendar_start=run.calendar_start, calendar_end=run.calendar_end)
    build.build_layers(store, as_of, ("curated",))
    assert store.read("curated", "fct_orders").select("fx_rate_to_usd").distinct().count() > 6


def test_raw_history_is_added_once_per_run(spark, store):
    df = spark.sql("""SELECT 1L AS id, parse_json('{"a": 1}') AS raw_data""")
    assert store.append_run(df, "raw", "p", "20240101T000000") == 1
    assert store.append_run(df.unionAll(df), "raw", "p", "20240102T000000") == 2
    assert store.append_run(df.unionAll(df), "raw", "p", "20240102T000000") == 2
    assert rows(store.read("raw", "p").groupBy("_run").count(), "_run") == [("20240101T000000", 1), ("20240102T000000", 2)]
    store.write(df, "raw", "q", "r1")
    with pytest.raises(ValueError, match="replaced by each run"):
        store.append(df, "raw", "q")


@pytest.mark.parametrize("runner", [build.run_changes, build.run_deltas])
def test_incremental_runs_end_like_a_full_run(spark, store, tmp_path, runner):
    d = "/root/testdata/sf0.001"
    sources = queries.feed_sources(spark, d)
    mark = F.lit("1999-01-01").cast("timestamp_ntz")
    early = {**sources, **{t: sources[t].where(F.col(c).isNull() | (F.col(c) <= mark)) for t, c in build.CHANGED_AT.items()}}

    def run(number):
        return build.Run(run_id=f"2024010{number}T000000", run_ts=f"2024-01-0{number} 00:00:00", as_of=date(2024, 1, 1),
                         calendar_start=date(1995, 1, 1), calendar_end=date(2001, 12, 31))

    runner(store, early, f"{store.root}/landing", run(1))
    log = runner(store, sources, f"{store.root}/landing", run(2))
    added = {r.table_name: r.row_count for r in log.where("layer = 'raw'").collect()}
    assert 0 < added["orders"] < sources["orders"].count()
    reached = early["orders"].agg(F.max("modified_at")).first()[0]
    assert added["orders"] == sources["orders"].where(F.col("modified_at") >= F.lit(reached)).count()

    full = LayerStore(spark, str(tmp_path / "full"), store.prefix + "f_")
    build.run_all(full, sources, f"{full.root}/landing", run(2))
    for table in ("revenue_by_category", "revenue_by_country", "customer_segment_kpis"):
        assert sorted(map(str, store.read("marts", table).drop("_last_built_at").collect())) == sorted(
            map(str, full.read("marts", table).drop("_last_built_at").collect())
        )
    if runner is build.run_deltas:
        assert not store.exists("curated", "fct_orders")
        spells = curated.customer_spells(build.customer_versions(store))
        assert rows(spells) and sorted(map(str, rows(spells))) == sorted(map(str, rows(curated.dim_customer_history(full.read("raw", "customers")))))
    full.reset()


def test_a_full_load_can_be_followed_by_changes(spark, store):
    sources = queries.feed_sources(spark, "/root/testdata/sf0.001")
    runs = [build.Run(run_id=f"2024010{n}T000000", run_ts=f"2024-01-0{n} 00:00:00", as_of=date(2024, 1, 1),
                      calendar_start=date(1995, 1, 1), calendar_end=date(2001, 12, 31)) for n in (1, 2)]
    build.run_all(store, sources, f"{store.root}/landing", runs[0])
    before = sorted(map(str, store.read("marts", "revenue_by_country").drop("_last_built_at").collect()))
    build.run_changes(store, sources, f"{store.root}/landing", runs[1])
    assert sorted(map(str, store.read("marts", "revenue_by_country").drop("_last_built_at").collect())) == before


# --- streams

EVENT = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("v", T.StringType())])


def land(spark, folder, *records):
    spark.createDataFrame(list(records), EVENT).coalesce(1).write.mode("append").parquet(folder)


def test_stream_upserts_what_arrives(spark, store, tmp_path):
    folder, progress = str(tmp_path / "in"), str(tmp_path / "progress")

    def ingest_now():
        stream = ingest.landed_stream(spark, folder, EVENT)
        ingest.upsert_available(stream, store, "staging", "state", ["id"], ["ts"], progress, ["v"]).awaitTermination()
        return rows(store.read("staging", "state").select("id", "v"), "id")

    land(spark, folder, (1, datetime(2024, 1, 1), "a"), (1, datetime(2024, 1, 2), "b"), (2, datetime(2024, 1, 5), "c"))
    assert ingest_now() == [(1, "b"), (2, "c")]
    land(spark, folder, (2, datetime(2024, 1, 1), "late"), (1, datetime(2024, 1, 3), "d"), (3, datetime(2024, 1, 1), "e"))
    assert ingest_now() == [(1, "d"), (2, "c"), (3, "e")]
    assert ingest_now() == [(1, "d"), (2, "c"), (3, "e")]


def test_repeated_batch_changes_nothing(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    land(spark, folder, (1, datetime(2024, 1, 1), "a"))
    for progress in ("p1", "p2"):  # a fresh checkpoint replays batch 0
        stream = ingest.landed_stream(spark, folder, EVENT)
        ingest.upsert_available(stream, store, "staging", "state", ["id"], ["ts"], str(tmp_path / progress)).awaitTermination()
    assert store.read("staging", "state").count() == 1


def test_two_streams_into_one_table_both_arrive(spark, store, tmp_path):
    for number, name in enumerate(("one", "two")):
        land(spark, str(tmp_path / name), (number, datetime(2024, 1, 1), name))
        stream = ingest.landed_stream(spark, str(tmp_path / name), EVENT)
        ingest.upsert_available(stream, store, "staging", "state", ["id"], ["ts"], str(tmp_path / f"p{name}")).awaitTermination()
    assert rows(store.read("staging", "state").select("id", "v"), "id") == [(0, "one"), (1, "two")]


def test_late_rows_stay_in_the_log(spark, tmp_path):
    folder, log, progress = (str(tmp_path / x) for x in ("in", "log", "progress"))
    for record in ((1, datetime(2024, 3, 1), "new"), (2, datetime(2024, 1, 1), "late"), (None, datetime(2024, 1, 1), "no key")):
        land(spark, folder, record)
        ingest.append_log(ingest.landed_stream(spark, folder, EVENT), log, progress).awaitTermination()
    read = ingest.without_repeats(spark.read.schema(EVENT).parquet(log), ["id"], ["ts"])
    assert rows(read.select("id", "v"), "id") == [(None, "no key"), (1, "new"), (2, "late")]


def test_log_drops_repeats_across_batches(spark, tmp_path):
    folder, log, progress = (str(tmp_path / x) for x in ("in", "log", "progress"))
    for batch in ([(1, datetime(2024, 1, 1), "a"), (1, datetime(2024, 1, 1), "a")], [(1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 1), "b")]):
        land(spark, folder, *batch)
        ingest.append_log(ingest.landed_stream(spark, folder, EVENT), log, progress).awaitTermination()
    read = ingest.without_repeats(spark.read.schema(EVENT).parquet(log), ["id"], ["ts"])
    assert rows(read.select("id"), "id") == [(1,), (2,)]


def test_shared_dir_needs_the_setting_on_a_cluster(spark, conf):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_paths_of_files_are_written_without_bounds(spark, store):
    """Parquet keeps the least and greatest value of every column but the paths, which it would compare in full for each row."""
    df = spark.range(3).select("id", F.concat(F.lit("file:/landing/part-"), "id").alias("_source_file"))
    staged = df.withColumnRenamed("_source_file", "_raw_source_file")
    store.write(df, "raw", "written", "r1")
    store.write(staged, "staging", "written", "r1")
    store.write(df, "raw", "added", "r1")
    store.append_run(df, "raw", "added", "r2")
    for layer, table, path, copies in (
        ("raw", "written", "_source_file", 1), ("staging", "written", "_raw_source_file", 1), ("raw", "added", "_source_file", 2)
    ):
        assert sorted(rows(store.read(layer, table).select("id", path))) == sorted(rows(df) * copies)
        folder = Path(store.location(layer, table).removeprefix("file:"))
        bounds = set()
        for file in folder.rglob("*.parquet"):
            footer = pq.ParquetFile(file).metadata
            for group in range(footer.num_row_groups):
                for i in range(footer.num_columns):
                    column = footer.row_group(group).column(i)
                    bounds.add((column.path_in_schema, bool(column.statistics and column.statistics.has_min_max)))
        assert bounds == {("id", True), (path, False)}


def test_payloads_are_built_by_compiled_code(spark, tmp_path):
    kinds = ("view", "click", "error", "buy")
    events = spark.createDataFrame([(n, n, kind) for n, kind in enumerate(kinds)], "event_id bigint, user_id bigint, event_type string")
    events.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(str(tmp_path / "events.parquet"))
    payloads = retail_feeds.fx_payloads(spark, str(tmp_path))
    flat = plan(flatten_fx_payload(payloads, "payload"))
    assert not [line for line in flat.splitlines() if "to_json" in line.lower() or "StructsToJson" in line if "*(" not in line]
    read = {r.event_id: json.loads(r.payload) for r in payloads.collect()}
    assert (read[0]["source"], read[0]["timestamp"], sorted(read[0]["quotes"])) == ("USD", 788922000, ["USDEUR", "USDGBP", "USDINR", "USDJPY"])
    assert (read[1]["source"], read[1]["quotes"], sorted(read[1]["rates"])) == ("", {}, ["eur", "gbp", "inr", "jpy"])
    assert "quotes" not in read[2] and read[2]["date"] == "1995-01-03"
    assert "rates" not in read[3] and read[3]["quotes"]["USDEUR"] == 0.8114
