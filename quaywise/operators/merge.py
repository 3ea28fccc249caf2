"""Load semantics: insert if absent, latest wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in ``order``.

    ``order`` must decide between any two rows of a key. Spark turns the
    ``row_number() = 1`` filter into a group limit that also runs before the
    shuffle, so a key that holds a large share of the rows sends one row per
    input task instead of its whole group.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return (
        rows.withColumn("_rank_in_key", F.row_number().over(window))
        .where(F.col("_rank_in_key") == 1)
        .drop("_rank_in_key")
    )


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """The source rows an insert-if-absent would add, one for each key.

    ``order`` is left out when the source already has one row for each key.
    The source is made unique first, so that the join meets each key once even
    where one key holds most of the source; it reuses the shuffle by key.
    """
    unique = pick_one(source, key, order) if order else source
    return unique.join(target.select(*key), list(key), "left_anti")


def latest_wins(
    target: DataFrame, source: DataFrame, key: Sequence[str], version: Sequence[Column]
) -> DataFrame:
    """Target after an upsert: for each key the row with the highest version.

    On equal versions the source row replaces the target row, and two source
    rows fall back to the order of their remaining columns, so that a replay
    gives the same table.
    """
    both = target.withColumn("_side", F.lit(0)).unionByName(source.withColumn("_side", F.lit(1)))
    rest = [c for c in source.columns if c not in key]
    order = [v.desc_nulls_last() for v in version]
    order += [F.desc("_side")] + [F.col(c).desc_nulls_last() for c in rest]
    return pick_one(both, key, order).drop("_side")


def matching(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which nulls are equal."""
    other = right.select(*(F.col(c).alias(f"_{c}") for c in on))
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(other, condition, how)
