from pathlib import Path

import pytest

from conftest import plan, rows
from pyspark.sql import functions as F, types as T
from stratamart.sources.snapshots import SnapshotLog

SCHEMA = T.StructType().add("id", T.LongType()).add("v", T.StringType())


@pytest.fixture
def log(spark, tmp_path):
    """Four runs of 100 rows in two files each, and one of 2,000 rows."""
    table = SnapshotLog(spark, str(tmp_path / "raw"), SCHEMA)
    for k in range(4):
        assert table.append(batch(spark, k, 100), f"r{k}") == 100
    assert table.append(batch(spark, 4, 2000), "r4") == 2000
    return table


def batch(spark, k, n):
    return spark.range(k * 10_000, k * 10_000 + n, 1, 2).select("id", F.concat(F.lit("v"), F.sha2(F.col("id").cast("string"), 256)).alias("v"))


def counts(df):
    return dict(rows(df.groupBy("_run").count()))


def stored(log):
    return {p.name for p in (Path(log.root) / "data").rglob("*.parquet")}


def bytes_of(log):
    return log.files().agg(F.sum("bytes")).first()[0]


ALL = {"r0": 100, "r1": 100, "r2": 100, "r3": 100, "r4": 2000}


def test_runs_are_added_once(spark, log):
    assert counts(log.read()) == ALL
    assert log.append(batch(spark, 9, 5), "r2") == 0
    assert counts(log.read()) == ALL and len(log.snapshots()) == 5
    assert rows(log.runs(), "_run")[-1] == ("r4", 2000)
    assert counts(log.read(log.snapshots()[1])) == {"r0": 100, "r1": 100}


def test_compaction_joins_small_files_and_leaves_large_ones(log):
    whole = sorted(rows(log.read()))
    sizes = sorted(b for (b,) in rows(log.files().select("bytes")))
    target = 2 * sizes[8] - 2  # the two files of r4 are no less than half of it
    large = set(rows(log.files().where(F.col("bytes") >= target // 2).select("path")))
    assert log.files().count() == 10 and len(large) == 2
    old = log.read()
    fewer = log.compact(target)
    after = set(rows(log.files().select("path")))
    assert large < after and len(after) == 10 - fewer < 10
    assert sorted(rows(log.read())) == whole == sorted(rows(old))
    assert log.compact(target) == 0


def test_a_run_of_any_size_is_cut_into_even_files(log):
    total = bytes_of(log)
    log.compact(10 * total)
    assert log.files().count() == 1
    log.compact(30 * total)
    assert log.files().count() == 1 and counts(log.read()) == ALL
    size = bytes_of(log)
    log.forget("r4")
    log.compact(size)
    assert counts(log.read()) == {"r4": 2000}


def test_the_hot_run_lies_in_several_files(spark, tmp_path):
    table = SnapshotLog(spark, str(tmp_path / "raw"), SCHEMA)
    table.append(batch(spark, 0, 3000).repartition(12), "hot")
    target = bytes_of(table) // 3
    parts = -(-bytes_of(table) // target)
    table.compact(target)
    held = [n for (n,) in rows(table.files().select("row_count"))]
    assert len(held) == parts and sum(held) == 3000 and max(held) < 1500


def test_compaction_neither_shuffles_nor_sorts_rows(spark, log, monkeypatch):
    plans, store = [], SnapshotLog._store
    monkeypatch.setattr(SnapshotLog, "_store", lambda self, rows: (plans.append(plan(rows)), store(self, rows))[1])
    assert log.compact(bytes_of(log) // 2) > 0
    assert plans and not [p for p in plans if "Exchange" in p or "Sort" in p]
    first, last = zip(*rows(log.files().select("first_run", "last_run"), "first_run"))
    assert list(last) == sorted(last) and counts(log.read()) == ALL


def test_runs_are_read_from_their_files_only(log):
    found = log.read(since="r1", until="r2")
    assert counts(found) == {"r1": 100, "r2": 100}
    assert len(found.inputFiles()) == 4


def test_forgetting_rewrites_only_mixed_files(spark, log):
    log.compact(1 << 30)
    assert log.files().count() == 1
    log.append(batch(spark, 5, 10), "r5")
    kept = set(rows(log.files().where("first_run = 'r5'").select("path")))
    assert log.forget("r3") == 300
    assert counts(log.read()) == {"r3": 100, "r4": 2000, "r5": 10}
    assert kept < set(rows(log.files().select("path")))
    assert log.append(batch(spark, 0, 100), "r0") == 0  # stays forgotten
    assert log.forget("r3") == 0


def test_old_snapshots_are_read_until_they_expire(spark, log):
    before, reader = log.snapshots()[-1], log.read()
    files = stored(log)
    log.compact(1 << 30)
    log.forget("r4")
    spark.range(3).write.parquet(f"{log.root}/data/abandoned")  # a failed attempt
    assert log.expire(keep=3) > 0  # the attempt and nothing a kept snapshot names
    assert counts(reader) == counts(log.read(before)) == ALL and files < stored(log)
    assert log.expire() > 0
    assert log.snapshots() == log.snapshots()[-1:] and counts(log.read()) == {"r4": 2000}
    assert len(stored(log)) == log.files().count()
    assert log.expire() == 0


def test_a_failed_append_changes_nothing(spark, log):
    bad = batch(spark, 7, 10).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        log.append(bad, "r7")
    assert counts(log.read()) == ALL
    assert log.append(batch(spark, 7, 10), "r7") == 10


def test_empty_tables_runs_and_nulls(spark, tmp_path):
    table = SnapshotLog(spark, str(tmp_path / "raw"), SCHEMA)
    assert table.read().count() == 0 and table.compact() == 0 and table.forget("z") == 0 and table.expire() == 0
    assert table.append(spark.createDataFrame([], SCHEMA), "r0") == 0
    assert rows(table.runs()) == [("r0", 0)] and table.read().count() == 0
    table.append(spark.createDataFrame([(None, None), (None, None)], SCHEMA), "r1")
    table.compact()
    assert rows(table.read()) == [(None, None, "r1")] * 2
    with pytest.raises(ValueError):
        SnapshotLog(spark, str(tmp_path / "other"), T.StructType().add("_run", T.StringType()))
