"""Previous value within a group, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    rows: DataFrame, key: str, order: Sequence[Column], span: Column, value: str, out: str
) -> DataFrame:
    """Add ``out``: ``value`` of the row before, within ``key`` by ``order``.

    ``order`` is ascending columns without NULLs; rows equal in all of them
    follow by ``value``. ``span`` is a number that must be the same or larger
    for a row that comes later in ``order``, such as the minute of a time that
    leads it. A group is worked on span by span, at any size: the first row of
    a span takes its value from the last row of the span before.
    """
    in_order = [*order, F.col(value)]
    spans = rows.withColumn("_span", span)
    in_span = Window.partitionBy(key, "_span").orderBy(*in_order)
    local = spans.withColumn("_local", F.lag(F.struct(F.col(value))).over(in_span))
    # combined before the shuffle; then one row for each span of a group
    last = spans.groupBy(key, "_span").agg(
        F.max(F.struct(*[c.alias(f"_{k}") for k, c in enumerate(in_order)])).alias("_last")
    )
    carried = last.select(
        key,
        "_span",
        F.lag(F.struct(F.col(f"_last._{len(order)}").alias(value)))
        .over(Window.partitionBy(key).orderBy("_span"))
        .alias("_carried"),
    )
    return (
        local.join(carried, [key, "_span"], "left")
        .withColumn(out, F.coalesce("_local", "_carried").getField(value))
        .select(*rows.columns, out)
    )
