"""Staging to operational tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywise.functions import times
from quaywise.operators.merge import pick_one, rows_to_insert


def _moment(column: str) -> Column:
    """Feed text as wall clock: an offset is dropped, unreadable text is NULL."""
    return F.col(column).try_cast("timestamp_ntz")


def new_trips(staged: DataFrame, target: DataFrame, since: date | None) -> DataFrame:
    """Trips that depart on ``since`` or later and are not in the target yet."""
    trips = staged.withColumn("departure_time", _moment("departure_time")).withColumn(
        "ref_date", F.col("departure_time").cast("date")
    )
    trips = trips.where(F.col("ref_date").isNotNull())
    if since is not None:
        trips = trips.where(F.col("ref_date") >= times.day(since))
        target = target.where(F.col("ref_date") >= times.day(since))
    rows = trips.select(
        "trip_id",
        F.col("train").alias("vehicule"),
        "origin_name",
        "departure_time",
        "dest_name",
        _moment("arrival_time").alias("arrival_time"),
        "published_line_name",
        "production_date",
        "ref_date",
    )
    order = [F.col("production_date")]
    order += [F.col(c) for c in rows.columns if c not in ("trip_id", "ref_date")]
    return rows_to_insert(target, rows, ["trip_id", "ref_date"], order)


def unreadable_trips(staged: DataFrame) -> DataFrame:
    """Staged trips whose departure time is not a timestamp."""
    return staged.where(_moment("departure_time").isNull())


def new_vehicules(staged: DataFrame, target: DataFrame) -> DataFrame:
    """One row for each train number; its first trip decides category and mode."""
    rows = staged.select(
        F.col("train").alias("num_vehicule"),
        F.split_part("vehicule_category", F.lit("::"), F.lit(2)).alias("category_vehicule"),
        "vehicule_mode",
        "production_date",
        "trip_id",
    )
    order = [F.col("production_date"), F.col("trip_id")]
    return rows_to_insert(target, rows, ["num_vehicule"], order).drop(
        "production_date", "trip_id"
    )


STOP_KEY = ("trip_id", "stop_name")


def new_stops(
    staged: DataFrame,
    trips: DataFrame,
    target: DataFrame,
    since: date | None,
    unseen: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Stops not seen before, once for each day their trip runs.

    A (trip, stop name) already stored for any day is never added again:
    ``target`` holds the stored stops, or some days of them if ``unseen`` keeps
    back the keys of all others. Staged rows are made unique before the join
    with the trips: a trip with very many staged rows is spread by its stop
    names, and what reaches the join is at most one row for each stop name of a
    trip.
    """
    order = [F.col("production_date"), F.col("call_index")]
    order += [
        F.col(c)
        for c in ("aimed_arrival", "expected_arrival", "aimed_departure", "expected_departure")
    ]
    fresh = rows_to_insert(target, staged, list(STOP_KEY), order)
    running = trips.select("trip_id", "ref_date")
    if since is not None:
        running = running.where(F.col("ref_date") >= times.day(since))
    # neither side is ever broadcast
    rows = fresh.join(running.hint("merge"), "trip_id").select(
        "trip_id",
        "stop_name",
        *[
            _moment(c).alias(c)
            for c in ("aimed_arrival", "expected_arrival", "aimed_departure", "expected_departure")
        ],
        F.col("is_starting_point").cast("int").alias("is_starting_point"),
        F.col("is_terminus").cast("int").alias("is_terminus"),
        "departure_platform_name",
        "arrival_platform_name",
        "production_date",
        "ref_date",
    )
    return unseen(rows) if unseen else rows


def latest_stops(stored: DataFrame, newer: DataFrame) -> DataFrame:
    """The alternative to first-wins: stops with the times of the newest feed."""
    rows = stored.unionByName(newer)
    rest = [c for c in rows.columns if c not in ("trip_id", "stop_name", "ref_date")]
    order = [F.col("production_date").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in rest]
    return pick_one(rows, ["trip_id", "stop_name", "ref_date"], order)
