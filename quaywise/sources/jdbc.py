"""Query results from a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """The result of ``query``; with a numeric column, read by several tasks.

    ``lower`` and ``upper`` only set where the column is cut: rows outside of
    them are read as well.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column is None:
        return reader.option("query", query).load()
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .load()
    )
