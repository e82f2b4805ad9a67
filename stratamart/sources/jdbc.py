"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratamart.functions.timestamps import utc_naive


@dataclass(frozen=True)
class Slices:
    """Parallel read of a table by ranges of a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    number: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.number),
        }


def normalise_timestamps(df: DataFrame) -> DataFrame:
    """Every zoned timestamp column as naive UTC; decided by the declared schema."""
    return df.select(
        *[
            utc_naive(field.name).alias(field.name) if isinstance(field.dataType, T.TimestampType) else F.col(field.name)
            for field in df.schema
        ]
    )


def column_bounds(spark: SparkSession, url: str, table: str, column: str, options: Mapping[str, str] = {}) -> tuple:
    """Smallest and largest value of a column, found by the source itself."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(url=url, query=query, **options).load().first()
    return row[0], row[1]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    slices: Slices | None = None,
    options: Mapping[str, str] = {},
) -> DataFrame:
    """A whole table, read in parallel slices when given; later filters reach the source."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if slices:
        reader = reader.options(**slices.options())
    return normalise_timestamps(reader.load())
