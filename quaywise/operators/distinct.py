"""Distinct-entity counts in two steps.

First one row for each (group, entity) with its flags, then one row for each
group. Both steps combine before their shuffle, so a group that holds a large
share of the rows is spread over its entities, and several conditional distinct
counts cost one pass (``count(distinct ...) filter`` would copy every row once
for each of them).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_entity(
    rows: DataFrame, group: Sequence[str], entity: str, **measures: Column
) -> DataFrame:
    aggregates = [column.alias(name) for name, column in measures.items()]
    keys = [*group, entity]
    return rows.groupBy(*keys).agg(*aggregates) if aggregates else rows.select(*keys).distinct()


def entities(flag: str | None = None) -> Column:
    """Number of entities, or of those whose 0/1 flag is set, as bigint."""
    if flag is None:
        return F.count(F.lit(1))
    return F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0).cast("bigint"))
