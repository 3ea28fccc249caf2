"""Integrity checks that a database would do with constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def orphans(rows: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Key values of ``column`` that have no member in the dimension."""
    return (
        rows.select(F.col(column).alias(key))
        .where(F.col(key).isNotNull())
        .distinct()
        .join(dimension.select(key), key, "left_anti")
    )


def repeated(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return rows.groupBy(*key).count().where(F.col("count") > 1)


def overlapping_bands(bands: DataFrame) -> DataFrame:
    """Bands (``low`` to ``high``, both inside) that share numbers with an earlier one."""
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    # a table of bands is a referential of some rows
    return bands.withColumn("reached", F.max("high").over(before)).where(F.col("low") <= F.col("reached"))


def missing_bands(bands: DataFrame) -> DataFrame:
    """Ranges between the first and the last band that no band holds."""
    before = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    reached = bands.withColumn("reached", F.max("high").over(before))
    gaps = reached.where(F.col("low") > F.col("reached") + 1)
    return gaps.select((F.col("reached") + 1).alias("low"), (F.col("low") - 1).alias("high"))
