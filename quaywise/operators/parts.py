"""Groups of any size as parts of a bounded size.

A group that becomes one value (a message, an element, an array) must fit a
task. Groups with more rows than that are dealt into numbered parts by a hash
of their rows; counts combine before the shuffle, so no group is gathered to
find out its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sizes(rows: DataFrame, key: Sequence[str], most: int, *figures: Column) -> DataFrame:
    """For each key the number of ``parts`` of about ``most`` rows, and more ``figures`` of it."""
    parts = F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int")
    return rows.groupBy(*key).agg(parts.alias("parts"), *figures)


def dealt(rows: DataFrame, found: DataFrame, key: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``rows`` with their ``part``, and what :func:`sizes` found of their group.

    Rows that differ in the columns ``by`` are spread evenly. The join is one by
    merging, which Spark splits where one key holds many rows.
    """
    part = F.when(F.col("parts") == 1, 0).otherwise(F.pmod(F.xxhash64(*by), F.col("parts")))
    return rows.join(found.hint("merge"), list(key)).withColumn("part", part.cast("int"))


def numbered(groups: DataFrame, found: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row for each part of each group, for empty groups one: ``part`` of ``parts``."""
    all_parts = groups.join(found.select(*key, "parts"), list(key), "left").withColumn(
        "parts", F.coalesce("parts", F.lit(1))
    )
    return all_parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))


def beside(groups: DataFrame, made: DataFrame, key: Sequence[str]) -> DataFrame:
    """What was ``made`` of each part, beside the ``numbered`` parts; null for parts without rows.

    Both lie by ``key`` already. The number of the part is compared behind that:
    as a key of the join it would send all that was made through a shuffle again.
    """
    other = made.select(*(F.col(c).alias(f"_{c}") if c in (*key, "part") else c for c in made.columns))
    same = F.col("part") - F.col("_part") == 0
    for c in key:
        same = same & (F.col(c) == F.col(f"_{c}"))
    return groups.join(other, same, "left").drop("_part", *(f"_{c}" for c in key))
