from pathlib import Path

import pyarrow.parquet as pq
import pytest

from conftest import plan
from pyspark.sql import functions as F
from stratamart.sources.clustered import clustered, interleaved


def bounds(folder):
    """Least and greatest value of each column of each file."""
    out = []
    for file in Path(folder).glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        out.append({group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)})
    return out


def opened(folder, column, value):
    return sum(f[column].has_min_max and f[column].min <= value <= f[column].max for f in bounds(folder))


def test_a_filter_on_any_column_skips_most_files(spark, tmp_path):
    n = F.col("id")
    # Two thirds of the rows belong to one customer; days are skewed towards the end.
    rows = spark.range(64_000).select(
        n, F.when(F.xxhash64(n) % 3 != 0, 7).otherwise(F.pmod(F.xxhash64(n, F.lit(1)), F.lit(10_000))).alias("customer"),
        F.sqrt(F.pmod(F.xxhash64(n, F.lit(2)), F.lit(1_000_000))).cast("int").alias("day"),
    )
    rows.write.parquet(str(tmp_path / "plain"))
    stored = spark.read.parquet(str(tmp_path / "plain"))
    clustered(stored, ["customer", "day"], 64).write.parquet(str(tmp_path / "clustered"))
    found = spark.read.parquet(str(tmp_path / "clustered"))
    assert found.count() == 64_000 and found.exceptAll(stored).count() == 0
    assert len(bounds(tmp_path / "clustered")) == 64
    for column, values in (("customer", (300, 5000, 9000)), ("day", (100, 600, 950))):
        for v in values:
            assert opened(tmp_path / "clustered", column, v) <= 24
    assert "EqualTo(day,600)" in plan(found.where("day = 600"))


@pytest.mark.parametrize("a, b, z", [(0, 0, 0), (1, 0, 2), (0, 1, 1), (3, 1, 11), (255, 255, 65535)])
def test_bits_alternate(spark, a, b, z):
    df = spark.createDataFrame([(a, b)], "a long, b long")
    assert df.select(interleaved([F.col("a"), F.col("b")])).first()[0] == z


def test_nulls_ties_and_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (1, None), (1, 2.0), (1, 2.0)], "a int, b double")
    assert sorted(map(str, clustered(df, ["a", "b"], 3).collect())) == sorted(map(str, df.collect()))
    assert clustered(df.limit(0), ["a", "b"], 3).count() == 0
