from datetime import datetime

import pytest

from conftest import plan, rows
from pyspark.sql import functions as F, types as T
from stratamart.operators.merge import upsert
from stratamart.sources.cells import CellTable
from stratamart.streaming.ingest import landed_stream, upsert_cells_available

SCHEMA = T.StructType().add("id", T.LongType()).add("status", T.StringType()).add("at", T.TimestampNTZType())
T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


@pytest.fixture
def cells(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "orders"), SCHEMA, "id", 100)
    start = spark.range(0, 1000, 1, 4).select("id", F.lit("new").alias("status"), F.lit(T1).cast("timestamp_ntz").alias("at"))
    table.write(start)
    return table


def folders(table, version=None):
    return {r["cell"]: r["folder"] for r in table.manifest(version).collect()}


def frame(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def test_only_touched_cells_are_rewritten(spark, cells):
    before, table = folders(cells), cells.read()
    changes = frame(spark, (105, "paid", T2), (110, "late", T0), (1234, "first", T0), (-5, "below", T0), (None, "lost", T2))
    want = upsert(table, changes, ["id"], ["at"])
    cells.upsert(changes, ["id"], ["at"])
    after = folders(cells)
    assert {c for c in after if after[c] != before.get(c)} == {1, 12, -1}
    assert sorted(rows(cells.read())) == sorted(rows(want))
    assert rows(cells.manifest().where("cell = 1").select("least", "greatest", "row_count")) == [(100, 199, 100)]


def test_readers_of_a_version_keep_it_until_it_expires(spark, cells):
    old = cells.read()
    cells.upsert(frame(spark, (5, "paid", T2)), ["id"], ["at"])
    cells.upsert(frame(spark, (5, "sent", T2), (6, "sent", T2)), ["id"], ["at"], ["status"])
    assert old.where("status != 'new'").count() == 0
    assert rows(cells.read().where("status != 'new'").select("id", "status"), "id") == [(5, "sent"), (6, "sent")]
    versions = cells.versions()
    assert len(versions) == 3
    first, second, last = (folders(cells, v) for v in versions)
    assert cells.expire(keep=2) == [first[0]]
    assert cells.read(versions[1]).where("id = 5").first()["status"] == "paid"
    assert cells.expire() == [second[0]]
    assert cells.versions() == versions[-1:] and cells.read().count() == 1000
    assert cells.expire() == []


def test_a_failed_change_leaves_the_table(spark, cells):
    bad = frame(spark, (5, "paid", T2)).withColumn("status", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        cells.replace(cells.touched(frame(spark, (5, "x", T2))), bad)
    assert cells.read().count() == 1000 and len(cells.versions()) == 1


def test_null_keys_and_an_emptied_cell(spark, cells):
    cells.replace(spark.createDataFrame([(None,), (3,)], "cell bigint"), frame(spark, (None, "no key", T0)))
    assert cells.read().count() == 901
    assert rows(cells.manifest().where("cell IS NULL").select("least", "row_count")) == [(None, 1)]
    assert cells.read(cells=spark.createDataFrame([(None,)], "cell bigint")).first()["status"] == "no key"
    assert 3 not in folders(cells)


def test_before_the_first_write(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "none"), SCHEMA, "id", 10)
    assert table.read().count() == 0 and table.versions() == []
    table.upsert(frame(spark, (1, "a", T0), (1, "b", T1)), ["id"], ["at"])
    assert rows(table.read().select("id", "status")) == [(1, "b")]


def test_a_lookup_opens_the_cells_of_its_keys(spark, cells):
    found = cells.lookup([5, 730])
    assert rows(found.select("id"), "id") == [(5,), (730,)]
    assert {f.split("_cell=")[1].split("/")[0] for f in found.inputFiles()} == {"0", "7"}
    assert "PushedFilters: [In(id, [5,730])]" in plan(found)


def test_a_stream_rewrites_the_cells_of_its_batches(spark, cells, tmp_path):
    def arrive(*records):
        frame(spark, *records).coalesce(1).write.mode("append").parquet(str(tmp_path / "arrived"))
        stream = landed_stream(spark, str(tmp_path / "arrived"), SCHEMA, files_per_batch=1)
        upsert_cells_available(stream, cells, ["id"], ["at"], str(tmp_path / "progress")).awaitTermination()

    start = folders(cells)
    arrive((5, "paid", T2), (5, "late", T0), (None, "lost", T2))
    first = folders(cells)
    assert {c for c in first if first[c] != start[c]} == {0}
    arrive((730, "paid", T2), (6, "older", T0))  # a restart takes only what is new
    second = folders(cells)
    assert {c for c in second if second[c] != first[c]} == {0, 7}
    assert rows(cells.read().where("status != 'new'").select("id", "status"), "id") == [(5, "paid"), (730, "paid")]
    assert cells.read().count() == 1000
