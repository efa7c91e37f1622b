"""File and JDBC sources, and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sql(spark: SparkSession, query: str, **params) -> DataFrame:
    """Result of a query with named parameters (``:name``), bound and not pasted in."""
    return spark.sql(query, args=params or None)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition: tuple[str, str, str, int] | None, **options,
) -> DataFrame:
    """Table or ``(query) alias`` over JDBC.

    ``partition`` is (column, lower, upper, parts) and has to be said; with None one task reads
    everything, right only for small tables.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition:
        column, lower, upper, parts = partition
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts
        )
    return reader.load()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_text(df: DataFrame, path: str) -> None:
    """The frame's only column, a row per line."""
    df.select(F.col(df.columns[0]).cast("string").alias("value")).write.mode("overwrite").text(path)
