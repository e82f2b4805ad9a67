from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import rows
from pyspark.sql import types as T
from stratamart.streaming import dedupe
from stratamart.streaming.dedupe import Deduplicated
from stratamart.streaming.ingest import landed_stream

T0 = datetime(2024, 1, 1, 12)
SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("at", T.TimestampNTZType()), T.StructField("v", T.StringType())])


@pytest.fixture
def ingest(spark, tmp_path):
    """Land a file, and take in what has arrived."""
    table = Deduplicated(spark, str(tmp_path / "out"), SCHEMA, ("id",), "at", "2 hours")
    (tmp_path / "in").mkdir()
    landed = 0

    def land(*records):
        nonlocal landed
        landed += 1
        kinds = {"id": pa.int64(), "at": pa.timestamp("us"), "v": pa.string()}
        columns = {name: pa.array(values, kind) for (name, kind), values in zip(kinds.items(), zip(*records))}
        pq.write_table(pa.table(columns), tmp_path / "in" / f"{landed:03d}.parquet")

    def take():
        stream = landed_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
        table.run(stream, str(tmp_path / "progress")).awaitTermination()

    return table, land, take


def at(**ago):
    return T0 + timedelta(**ago)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_repeats_go_and_late_rows_are_kept_apart(spark, ingest):
    table, land, take = ingest
    land((1, at(hours=0), "a"), (2, at(hours=1), "b"), (1, at(hours=0), "again"))
    land((2, at(hours=1), "again"), (3, at(hours=20), "c"))
    take()
    assert ids(table.read("log")) == [1, 2, 3] and table.read("late").count() == 0
    # A new run goes on with the state and the watermark of the one before.
    land((3, at(hours=20), "again"), (4, at(hours=19), "in time"), (5, at(hours=2), "late"), (5, at(hours=2), "late again"), (1, at(hours=0), "late repeat"))
    take()
    land((5, at(hours=2), "late once more"), (6, at(hours=1), "late too"), (7, at(hours=30), "d"))
    take()
    assert ids(table.read("log")) == [1, 2, 3, 4, 7]
    assert ids(table.read("late")) == [5, 6]
    assert ids(table.rows().where("late")) == [5, 6] and table.rows().count() == 7
    take()  # nothing new
    assert table.rows().count() == 7


def test_many_rows_are_looked_up_in_one_join(ingest, monkeypatch):
    """Beyond the bound of a broadcast, in the log and the late rows together; nothing more is written for it."""
    written, pin = [], dedupe.pin
    monkeypatch.setattr(dedupe, "BROADCAST_ROWS", -1)
    monkeypatch.setattr(dedupe, "pin", lambda df, purpose: (written.append(purpose), pin(df, purpose))[1])
    table, land, take = ingest
    land((1, at(hours=0), "a"), (2, at(hours=9), "b"), (3, None, "c"))
    land((4, at(hours=2), "d"), (1, at(hours=1), "repeat"), (3, None, "repeat"))
    land((4, at(hours=3), "repeat"), (5, at(hours=1), "late"), (2, at(hours=9), "repeat"), (1, at(hours=4), "late, no repeat"))
    take()
    assert ids(table.read("log")) == [1, 2, 4] and ids(table.read("late")) == [1, 3, 5]
    assert set(written) == {"stream-batch", "stream-rows"}


def test_rows_without_key_or_time(ingest):
    table, land, take = ingest
    land((None, at(hours=0), "x"), (None, at(hours=0), "x"), (1, None, "y"), (2, at(hours=0), "z"))
    land((1, None, "y"), (None, None, "w"))
    take()
    assert ids(table.read("log")) == [2]
    assert sorted(str(r["id"]) for r in table.read("late").collect()) == ["1", "None", "None", "None"]


def test_a_batch_written_twice_is_the_same(spark, ingest):
    """A batch that failed after its first write is run again."""
    table, land, take = ingest
    land((1, at(hours=0), "a"), (9, at(hours=40), "b"))
    take()
    land((2, at(hours=1), "late"), (3, at(hours=41), "c"))
    take()
    before = rows(table.rows(), "id")
    batch_id = table.read("late").first()["_batch"]
    kept = spark.createDataFrame([(3, at(hours=41), "c", True), (3, at(hours=41), "c", False), (2, at(hours=1), "late", False)], "id bigint, at timestamp_ntz, v string, _kept boolean")
    table._write(kept, batch_id)
    assert rows(table.rows(), "id") == before
