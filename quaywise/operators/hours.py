"""Events that overlap clock hours, by exploding each event to its hours.

The condition "event overlaps hour" is a range join. Written as one it is a
nested loop over events and hours; here each event yields the few hours it
touches, clipped to the reporting window, and the rest is an equi aggregation.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.functions import times


def hour_spine(spark: SparkSession, first: datetime, last: datetime) -> DataFrame:
    """One row for each clock hour, both ends included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(times.ntz(first), times.ntz(last), F.expr("interval 1 hour"))
        ).alias("hour_start")
    )


def spread_hours(
    events: DataFrame, start: Column, stop: Column, first: datetime, last: datetime
) -> DataFrame:
    """One row for each event and hour from ``start`` to ``stop``, within the window.

    ``start`` and ``stop`` are full hours. Events with a missing bound, or whose
    range lies outside the window, yield nothing.
    """
    lo, hi = times.ntz(first), times.ntz(last)
    clipped = (
        events.withColumn("_from", F.when(start < lo, lo).otherwise(start))
        .withColumn("_to", F.when(stop > hi, hi).otherwise(stop))
        .where(F.col("_from") <= F.col("_to"))
    )
    return clipped.withColumn(
        "hour_start", F.explode(F.sequence("_from", "_to", F.expr("interval 1 hour")))
    ).drop("_from", "_to")
