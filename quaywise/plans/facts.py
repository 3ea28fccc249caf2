"""Fact loads. Facts are partitioned by day and hold dimension keys."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaywise.functions import status, text, times
from quaywise.functions.numbers import (
    WIDE,
    count_where,
    ratio,
    round_div,
    round_ratio,
    sum_where,
)
from quaywise.operators.distinct import entities, per_entity
from quaywise.operators.merge import rows_to_insert
from quaywise.operators.previous import with_previous

LATE_MINUTES = 5
# Stops and trips grow together: neither side is ever broadcast, however small
# its compressed files look. AQE splits skewed partitions of this join.
FACT_JOIN = "merge"
HISTORY_DAYS = 7


def _station_keys(d_station: DataFrame) -> DataFrame:
    """One key for each name: a name found in several places takes the lowest."""
    return d_station.groupBy("station_name").agg(F.min("tk_station").alias("tk"))


def _line_keys(d_line: DataFrame, exact: bool) -> DataFrame:
    name = F.col("line_name") if exact else text.line_key(F.col("line_name"))
    return d_line.groupBy(name.alias("line_name")).agg(F.min("tk_line").alias("tk"))


def _with_key(rows: DataFrame, keys: DataFrame, on: Column, name: str, out: str) -> DataFrame:
    """Left lookup of a dimension key, the unknown member where there is none."""
    renamed = keys.select(F.col(name).alias("_name"), F.col("tk").alias("_tk"))
    return (
        rows.join(renamed, on == F.col("_name"), "left")
        .withColumn(out, F.coalesce("_tk", F.lit(times.UNKNOWN_KEY)).cast("bigint"))
        .drop("_name", "_tk")
    )


def _trip_side(
    trips: DataFrame,
    d_vehicule: DataFrame,
    d_station: DataFrame,
    d_line: DataFrame,
    exact_line: bool,
) -> DataFrame:
    """Trips with the keys that depend on the trip alone.

    Looked up here, once for each trip, and not once for each stop. A trip whose
    train is not decoded yet, or whose day is outside the calendar, is left out.
    """
    stations = _station_keys(d_station)
    lines = _line_keys(d_line, exact_line)
    line = F.col("published_line_name")
    rows = trips.join(
        d_vehicule.select(
            F.col("num_vehicule").alias("vehicule"), F.col("tk_vehicule").alias("vehicule_tk")
        ),
        "vehicule",
    ).withColumnRenamed("vehicule", "num_vehicule")
    rows = rows.withColumn("ref_date_tk", times.date_key(F.col("ref_date"))).where(
        F.col("ref_date_tk") != times.UNKNOWN_KEY
    )
    rows = _with_key(rows, stations, F.col("origin_name"), "station_name", "origin_station_tk")
    rows = _with_key(rows, stations, F.col("dest_name"), "station_name", "destination_station_tk")
    return _with_key(
        rows, lines, line if exact_line else text.line_key(line), "line_name", "line_tk"
    )


def _stop_keys() -> list[Column]:
    """Date and time keys of the four times of a stop, by arithmetic."""
    out = []
    for kind in ("aimed_arrival", "expected_arrival", "aimed_departure", "expected_departure"):
        ts = F.col(kind)
        out.append(times.date_key(ts.cast("date")).alias(f"{kind}_date_tk"))
        out.append(times.time_key(ts).alias(f"{kind}_time_tk"))
    return out


def _delays() -> list[Column]:
    return [
        times.delay_minutes(F.col("expected_arrival"), F.col("aimed_arrival")).alias(
            "delay_arrival_minutes"
        ),
        times.delay_minutes(F.col("expected_departure"), F.col("aimed_departure")).alias(
            "delay_departure_minutes"
        ),
    ]


def _since(rows: DataFrame, since: date | None) -> DataFrame:
    """Day filter on the partition column."""
    return rows if since is None else rows.where(F.col("ref_date") >= times.day(since))


def trip_stops(
    stops: DataFrame,
    trips: DataFrame,
    d_vehicule: DataFrame,
    d_station: DataFrame,
    d_line: DataFrame,
    since: date | None,
) -> DataFrame:
    """Candidate rows of ``f_trips``: one for each stop of a trip on a day."""
    side = _trip_side(_since(trips, since), d_vehicule, d_station, d_line, exact_line=True)
    side = side.select(
        "trip_id", "ref_date", "num_vehicule", "vehicule_tk", "ref_date_tk",
        "origin_station_tk", "destination_station_tk", "line_tk",
    )
    stations = _station_keys(d_station).select(
        F.col("station_name").alias("stop_name"), F.col("tk").alias("stop_station_tk")
    )
    return (
        _since(stops, since)
        .join(stations, "stop_name")
        .join(side.hint(FACT_JOIN), ["trip_id", "ref_date"])
        .select(
            "trip_id", "vehicule_tk", "num_vehicule", "stop_station_tk", "origin_station_tk",
            "destination_station_tk", "line_tk",
            *_stop_keys(),
            *_delays(),
            "departure_platform_name",
            "arrival_platform_name",
            F.col("is_starting_point").cast("boolean").alias("is_starting_point"),
            F.col("is_terminus").cast("boolean").alias("is_terminus"),
            "ref_date_tk",
        )
    )


def new_trip_stops(candidates: DataFrame, target: DataFrame, since: date | None) -> DataFrame:
    """First write wins on (trip, day, stop).

    Stops are unique by (trip, name, day) and a name has one key, so the
    candidates need no second pass to be unique. Only the days being loaded are
    read from the target.
    """
    if since is not None:
        target = target.where(F.col("ref_date_tk") >= times.key_of(since))
    return rows_to_insert(target, candidates, ["trip_id", "ref_date_tk", "stop_station_tk"])


def reach(f_trips: DataFrame, stored: DataFrame, since: date | None) -> DataFrame:
    """For each day of ``f_trips`` the first and last days one of its stops arrives or departs.

    Only the days being loaded are read again; older days keep what is stored.
    """
    if since is not None:
        f_trips = f_trips.where(F.col("ref_date_tk") >= times.key_of(since))
    known = F.nullif(F.col("expected_departure_date_tk"), F.lit(times.UNKNOWN_KEY))
    loaded = f_trips.select(
        "ref_date_tk",
        F.col("expected_arrival_date_tk").alias("last_arrival_tk"),
        F.col("expected_departure_date_tk").alias("last_departure_tk"),
        known.alias("first_departure_tk"),
    )
    return (
        loaded.unionByName(stored)
        .groupBy("ref_date_tk")
        .agg(
            F.max("last_arrival_tk").alias("last_arrival_tk"),
            F.max("last_departure_tk").alias("last_departure_tk"),
            F.min("first_departure_tk").alias("first_departure_tk"),
        )
    )


def _without_days(f_trips: DataFrame, stored: DataFrame, settled: Column) -> DataFrame:
    """``f_trips`` without the partitions of ``settled`` days.

    A day that is not in the stored reach is kept. The list has at most one
    entry for each day of the calendar.
    """
    days = [row[0] for row in stored.where(settled).select("ref_date_tk").collect()]
    return f_trips.where(~F.col("ref_date_tk").isin(*days)) if days else f_trips


def reaching(f_trips: DataFrame, stored: DataFrame, last: str, lowest: int) -> DataFrame:
    """``f_trips`` without the days known to end before day ``lowest``.

    Metrics select stops by their arrival, which says nothing about the
    partition. This prunes partitions that cannot hold such a stop.
    """
    return _without_days(f_trips, stored, F.col(last) < lowest)


def overlapping(f_trips: DataFrame, stored: DataFrame, first: int, last: int) -> DataFrame:
    """``f_trips`` without the days none of whose stops can arrive on day ``first``
    or later and depart on day ``last`` or before."""
    outside = (F.col("last_arrival_tk") < first) | (
        F.coalesce("first_departure_tk", F.lit(99991231)) > last
    )
    return _without_days(f_trips, stored, outside)


def journeys(
    trips: DataFrame,
    d_vehicule: DataFrame,
    d_station: DataFrame,
    d_line: DataFrame,
    since: date | None,
) -> DataFrame:
    """Candidate rows of ``f_journey``: one for each trip on a day."""
    side = _trip_side(_since(trips, since), d_vehicule, d_station, d_line, exact_line=False)
    dep, arr = F.col("departure_time"), F.col("arrival_time")
    return side.select(
        "trip_id", "vehicule_tk", "num_vehicule", "origin_station_tk",
        "destination_station_tk", "line_tk",
        times.date_key(dep.cast("date")).alias("departure_journey_date_tk"),
        times.time_key(dep).alias("departure_journey_time_tk"),
        times.date_key(arr.cast("date")).alias("arrival_journey_date_tk"),
        times.time_key(arr).alias("arrival_journey_time_tk"),
        "ref_date_tk",
    )


def new_journeys(candidates: DataFrame, target: DataFrame, since: date | None) -> DataFrame:
    if since is not None:
        target = target.where(F.col("ref_date_tk") >= times.key_of(since))
    return rows_to_insert(target, candidates, ["trip_id", "ref_date_tk"])


def realtime(
    stops: DataFrame,
    trips: DataFrame,
    d_vehicule: DataFrame,
    d_station: DataFrame,
    d_line: DataFrame,
    as_of: datetime,
    days: int = 2,
) -> DataFrame:
    """Snapshot of the last days at ``as_of``, with the state of stop and journey."""
    since = times.days_before(as_of, days)
    now = times.ntz(as_of)
    side = _trip_side(_since(trips, since), d_vehicule, d_station, d_line, exact_line=False)
    side = side.select(
        "trip_id", "ref_date", "num_vehicule", "vehicule_tk", "origin_station_tk",
        "destination_station_tk", "line_tk",
        F.col("departure_time").alias("departure_time_journey"),
        F.col("arrival_time").alias("arrival_time_journey"),
    )
    placed = _with_key(
        _since(stops, since),
        _station_keys(d_station),
        F.col("stop_name"),
        "station_name",
        "stop_station_tk",
    )
    rows = (
        placed.join(side.hint(FACT_JOIN), ["trip_id", "ref_date"])
        .withColumn("is_starting_point", F.col("is_starting_point").cast("boolean"))
        .withColumn("is_terminus", F.col("is_terminus").cast("boolean"))
    )
    return rows.select(
        "trip_id", "vehicule_tk", "num_vehicule",
        now.alias("ref_date"),
        "stop_station_tk", "origin_station_tk", "destination_station_tk", "line_tk",
        *_stop_keys(),
        "aimed_departure", "aimed_arrival", "expected_departure", "expected_arrival",
        *_delays(),
        "departure_time_journey", "arrival_time_journey",
        "departure_platform_name", "arrival_platform_name",
        "is_starting_point", "is_terminus",
        status.stop_status(now).alias("status_stop"),
        status.journey_status(now).alias("status_journey"),
    )


# --- metrics ---------------------------------------------------------------


def _arrived_since(f_trips: DataFrame, since: date | None) -> DataFrame:
    lowest = 0 if since is None else times.key_of(since)
    return f_trips.where(F.col("expected_arrival_date_tk") >= lowest)


def line_metrics(f_trips: DataFrame, since: date | None) -> DataFrame:
    """For each line and day of arrival. "Delayed" counts any delay, the rate
    counts delays above five minutes."""
    delay = F.col("delay_arrival_minutes")
    trips = per_entity(
        _arrived_since(f_trips, since).where(F.col("line_tk").isNotNull()),
        ["line_tk", "expected_arrival_date_tk"],
        "trip_id",
        worst=F.max(delay),
        minutes=sum_where(delay > 0, delay),
        delays=count_where(delay > 0),
    )
    n, late = entities(), count_where(F.col("worst") > LATE_MINUTES)
    minutes = F.sum("minutes")
    return trips.groupBy("line_tk", F.col("expected_arrival_date_tk").alias("ref_date_tk")).agg(
        n.alias("nb_journey"),
        count_where(F.col("worst") > 0).alias("nb_delay"),
        round_ratio(late * 100, n, 2).alias("delay_rate"),
        minutes.alias("delay_minutes"),
        round_ratio(minutes, F.sum("delays"), 2).alias("avg_delay_minutes"),
    )


def daily_punctuality(f_trips: DataFrame, since: date | None) -> DataFrame:
    """Late and all trips of each day, and the minutes they were late at their terminus.

    A day of trips is one partition, so only the days being loaded are read.
    """
    if since is not None:
        f_trips = f_trips.where(F.col("ref_date_tk") >= times.key_of(since))
    late_at_end = F.col("is_terminus") & (F.col("delay_arrival_minutes") > 0)
    trips = per_entity(
        f_trips,
        ["ref_date_tk"],
        "trip_id",
        worst=F.max("delay_arrival_minutes"),
        minutes=F.sum(F.when(late_at_end, F.col("delay_arrival_minutes"))),
    )
    return trips.groupBy("ref_date_tk").agg(
        count_where(F.col("worst") > LATE_MINUTES).alias("nb_late"),
        entities().alias("nb_trips"),
        F.sum("minutes").alias("terminus_minutes"),
    )


def platform_usage(
    f_trips: DataFrame, since: date | None, legacy_swap: bool = False
) -> DataFrame:
    """Arrivals and departures for each station, platform and day of arrival.

    Each stop yields its arrival and its departure from one scan. Both are dated
    by the expected arrival, so stops without one count nowhere.
    ``legacy_swap`` exchanges the two delayed counts, as older tables have them.
    """
    event = F.explode(
        F.array(
            F.struct(
                F.lit(True).alias("arrival"),
                F.col("arrival_platform_name").alias("platform_name"),
                F.greatest("delay_arrival_minutes", F.lit(0)).alias("minutes"),
            ),
            F.struct(
                F.lit(False).alias("arrival"),
                F.col("departure_platform_name").alias("platform_name"),
                F.greatest("delay_departure_minutes", F.lit(0)).alias("minutes"),
            ),
        )
    )
    events = (
        _arrived_since(f_trips, since)
        .select(
            F.col("stop_station_tk").alias("station_tk"),
            F.col("expected_arrival_date_tk").alias("ref_date_tk"),
            event.alias("e"),
        )
        .select("station_tk", "ref_date_tk", "e.*")
        .where(F.col("platform_name").isNotNull() & (F.col("platform_name") != ""))
    )
    arrival, minutes = F.col("arrival"), F.col("minutes")
    total = F.sum(minutes.cast("bigint"))
    arrivals_delayed = count_where(arrival & (minutes > 0))
    departures_delayed = count_where(~arrival & (minutes > 0))
    if legacy_swap:
        arrivals_delayed, departures_delayed = departures_delayed, arrivals_delayed
    return events.groupBy("station_tk", "platform_name", "ref_date_tk").agg(
        count_where(arrival).alias("nb_arrivals"),
        count_where(~arrival).alias("nb_departures"),
        departures_delayed.alias("nb_departures_delayed"),
        arrivals_delayed.alias("nb_arrivals_delayed"),
        ratio(total, count_where(minutes > 0)).alias("avg_delay_minutes"),
        F.max(minutes).alias("max_delay_minutes"),
        total.alias("total_delay_minutes"),
    )


AVERAGE_UNIT = 1_000_000_000


def daily_metrics(usage: DataFrame, since: date | None) -> DataFrame:
    """Roll-up of the platforms of a station and day.

    The average is the mean of the platform averages, summed in units of 1e-9 so
    that the sum does not depend on the order of the rows.
    """
    if since is not None:
        usage = usage.where(F.col("ref_date_tk") >= times.key_of(since))
    delayed = F.col("nb_arrivals_delayed") + F.col("nb_departures_delayed")
    traffic = F.col("nb_arrivals") + F.col("nb_departures")
    units = round_div(F.col("total_delay_minutes"), delayed, AVERAGE_UNIT, WIDE)
    rows = usage.withColumn("traffic", traffic).withColumn("units", units)
    late = F.sum("nb_departures_delayed") + F.sum("nb_arrivals_delayed")
    return rows.groupBy("station_tk", "ref_date_tk").agg(
        F.sum("nb_arrivals").alias("nb_arrivals"),
        F.sum("nb_departures").alias("nb_departures"),
        F.sum("nb_departures_delayed").alias("nb_departures_delayed"),
        F.sum("nb_arrivals_delayed").alias("nb_arrivals_delayed"),
        ratio(late * 100, F.sum("traffic")).alias("delay_rate"),
        F.sum("total_delay_minutes").alias("total_delay_minutes"),
        (ratio(F.sum("units"), F.count("units")) / float(AVERAGE_UNIT)).alias(
            "avg_delay_minutes"
        ),
        F.max("max_delay_minutes").alias("max_delay_minutes"),
        F.count(F.lit(1)).alias("nb_platforms_used"),
        # ties go to the first platform name
        F.min_by("platform_name", F.struct(-F.col("traffic"), F.col("platform_name"))).alias(
            "most_used_platform"
        ),
    )


# --- delay steps -----------------------------------------------------------


def _with_region(rows: DataFrame, d_station: DataFrame, departements: DataFrame) -> DataFrame:
    """Region of the stop; names compared without case but with accents."""
    regions = d_station.join(
        departements, F.lower("departement") == F.lower("nom_departement")
    ).select(F.col("tk_station").alias("stop_station_tk"), F.col("nom_region").alias("region_station"))
    return rows.join(regions, "stop_station_tk")


#: Minutes of stops without a time, which come after all others.
_NO_TIME = 2**62


def delay_steps_realtime(
    f_realtime: DataFrame, d_station: DataFrame, departements: DataFrame
) -> DataFrame:
    """Delay at each stop and at the stop before, over the snapshot.

    Stops follow in order of expected arrival, those without one last; equal
    times are ordered by station and then by the time of the journey.
    """
    arrival = F.col("expected_arrival")
    rows = _with_region(f_realtime, d_station, departements).where(
        F.col("delay_arrival_minutes").isNotNull()
    )
    day = F.date_diff(arrival.cast("date"), F.lit("2000-01-01").cast("date")).cast("bigint")
    minute = day * 1440 + F.hour(arrival) * 60 + F.minute(arrival)
    never = F.lit(datetime(1, 1, 1)).cast("timestamp_ntz")
    stepped = with_previous(
        rows.select(
            "trip_id", "region_station", "stop_station_tk", "expected_arrival",
            "expected_departure", "departure_time_journey", "delay_arrival_minutes",
        ),
        "trip_id",
        [
            arrival.isNull(), F.coalesce(arrival, never), F.col("stop_station_tk"),
            F.coalesce("departure_time_journey", never),
        ],
        F.coalesce(minute, F.lit(_NO_TIME).cast("bigint")),
        "delay_arrival_minutes",
        "prev_delay",
    )
    return stepped.select(
        "trip_id",
        "region_station",
        F.coalesce(arrival.cast("date"), F.col("expected_departure").cast("date")).alias(
            "ref_date"
        ),
        F.hour(arrival).alias("heure_passage"),
        "delay_arrival_minutes",
        "prev_delay",
    )


def delay_steps_history(
    f_trips: DataFrame,
    d_station: DataFrame,
    departements: DataFrame,
    as_of: datetime,
    days: int = HISTORY_DAYS,
) -> DataFrame:
    """The same over the stored facts of the last days, for stops with an arrival
    and a departure time."""
    since = times.key_of(times.days_before(as_of, days))
    date_tk, time_tk = F.col("expected_arrival_date_tk"), F.col("expected_arrival_time_tk")
    rows = f_trips.where(
        (F.col("expected_departure_date_tk") >= since)
        & (time_tk != times.UNKNOWN_KEY)
        & F.col("delay_arrival_minutes").isNotNull()
    )
    rows = _with_region(rows, d_station, departements).select(
        "trip_id", "region_station", "stop_station_tk", "expected_arrival_date_tk",
        "expected_arrival_time_tk", "ref_date_tk", "delay_arrival_minutes",
    )
    hour = F.call_function("div", time_tk, F.lit(10000)).cast("int")
    to_minute = F.call_function("div", time_tk, F.lit(100))
    arrival_date = times.key_to_date(date_tk)
    stepped = with_previous(
        rows,
        "trip_id",
        [date_tk, time_tk, F.col("stop_station_tk"), F.col("ref_date_tk")],
        date_tk.cast("bigint") * 10000 + to_minute,
        "delay_arrival_minutes",
        "prev_delay",
    )
    return stepped.select(
        "trip_id",
        "region_station",
        arrival_date.alias("ref_date"),
        hour.alias("heure_passage"),
        "delay_arrival_minutes",
        "prev_delay",
    )
