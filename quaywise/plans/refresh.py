"""The refresh: staging to operational tables, dimensions, facts and metrics.

Every step is a load of its own with its own commit. Inserts add only what is
absent and metrics replace whole days, so a refresh that was cut short is
completed by running it again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaywise.functions.times import day, days_before, key_of
from quaywise.operators.known import KnownKeys
from quaywise.plans import dims, facts, ods
from quaywise.session import together
from quaywise.sources.tables import Tables


@dataclass(frozen=True)
class Window:
    """How far back each load reaches; None stands for all days."""

    trips: date | None = None
    stops: date | None = None
    names: date | None = None
    lines_after: date | None = None
    facts: date | None = None
    metrics: date | None = None

    @classmethod
    def rolling(cls, as_of: datetime) -> Window:
        """The windows of the periodic refresh.

        New stops run on these days, so no other day can bring a new station
        name; after a reload of the station referential run
        ``refresh_dims(tables, Window.history())`` once. Stops of earlier days
        are not opened: their keys are held by :func:`stop_keys`.
        """
        return cls(
            trips=days_before(as_of, 0),
            stops=days_before(as_of, 2),
            names=days_before(as_of, 2),
            lines_after=days_before(as_of, 2),
            facts=days_before(as_of, 1),
            metrics=days_before(as_of, 1),
        )

    @classmethod
    def history(cls) -> Window:
        """Backfill of all days."""
        return cls()


def _days_from(rows: DataFrame, since: date | None) -> DataFrame:
    return rows if since is None else rows.where(F.col("ref_date") >= day(since))


def init_calendar(tables: Tables) -> None:
    """Date and time dimensions, with the public holidays of every year."""
    spark = tables.spark
    days = dims.d_date(spark)
    holidays = dims.public_holidays(days)
    together(
        lambda: tables.reload("ods/public_holidays", holidays),
        lambda: tables.reload("dwh/d_date", dims.flag_holidays(days, holidays)),
        lambda: tables.reload("dwh/d_time", dims.d_time(spark)),
    )


def load_staging(tables: Tables, trips: DataFrame, stops: DataFrame) -> None:
    together(
        lambda: tables.reload("dsa/trips", trips), lambda: tables.reload("dsa/stops", stops)
    )


def load_referentials(
    tables: Tables, stations: DataFrame, departements: DataFrame, corrections: DataFrame
) -> None:
    together(
        lambda: tables.reload("ods/stations", stations),
        lambda: tables.reload("ods/ref_departements", departements),
        lambda: tables.reload("ods/station_name_corr", corrections),
    )


def stop_keys(tables: Tables) -> KnownKeys:
    """The (trip, stop name) of all days that periodic loads add nothing to any more."""
    key = StructType([tables["ods/stops"].schema[c] for c in ods.STOP_KEY])
    return KnownKeys(tables.spark, tables.path("ods/stops_known"), key)


def settle_stops(tables: Tables, since: date) -> KnownKeys:
    """Hold the keys of the days before ``since`` that are not held yet.

    A refresh for an earlier time than the last one begins anew, as it may add
    to days that are held.
    """
    known, last = stop_keys(tables), since - timedelta(days=1)
    through = known.through
    if through is not None and through > last:
        known.forget()
        through = None
    if through is None or through < last:
        days = F.col("ref_date") <= day(last)
        if through is not None:
            days = days & (F.col("ref_date") > day(through))
        known.add(tables["ods/stops"].where(days), last)
    return known


def _new_stops(tables: Tables, since: date | None) -> DataFrame:
    """Staged stops not stored for any day.

    With a window, days that can still get rows are compared with directly and
    all others by their keys; without one, which may add to any day, all days
    are opened and the keys are held anew by the next periodic refresh.
    """
    staged, trips, stored = tables["dsa/stops"], tables["ods/trips"], tables["ods/stops"]
    if since is None:
        stop_keys(tables).forget()
        return ods.new_stops(staged, trips, stored, None)
    known = settle_stops(tables, since)
    return ods.new_stops(staged, trips, _days_from(stored, since), since, known.absent)


def refresh_ods(tables: Tables, window: Window) -> None:
    staged = tables["dsa/trips"]

    def stops() -> None:
        tables.append("ods/stops", _new_stops(tables, window.stops))

    tables.append("ods/trips", ods.new_trips(staged, tables["ods/trips"], window.trips))
    together(
        stops,
        lambda: tables.append(
            "ods/vehicules", ods.new_vehicules(staged, tables["ods/vehicules"])
        ),
    )


def _add_members(tables: Tables, name: str, key: str, rows: DataFrame, order: list[str]) -> None:
    top = dims.highest_key(tables[name], key)
    tables.append(name, dims.assign_keys(rows, key, order, top))


def refresh_dims(tables: Tables, window: Window) -> None:
    def vehicles() -> None:
        rows = dims.new_vehicules(tables["dsa/trips"], tables["dwh/d_vehicule"])
        _add_members(tables, "dwh/d_vehicule", "tk_vehicule", rows, ["num_vehicule"])

    def lines() -> None:
        if tables["dwh/d_line"].isEmpty():
            tables.append("dwh/d_line", dims.unknown_line(tables.spark))
        rows = dims.new_lines(tables["ods/trips"], tables["dwh/d_line"], window.lines_after)
        _add_members(tables, "dwh/d_line", "tk_line", rows, ["line_name"])

    def stations() -> None:
        if tables["dwh/d_station"].isEmpty():
            tables.append("dwh/d_station", dims.unknown_station(tables["dwh/d_station"]))
        rows = dims.new_stations(
            _days_from(tables["ods/stops"], window.names),
            tables["ods/stations"],
            tables["ods/station_name_corr"],
            tables["dwh/d_station"],
        )
        order = ["station_name", "commune", "departement"]
        _add_members(tables, "dwh/d_station", "tk_station", rows, order)

    together(vehicles, lines, stations)


def refresh_facts(tables: Tables, as_of: datetime, window: Window) -> None:
    stops, trips = tables["ods/stops"], tables["ods/trips"]
    members = (tables["dwh/d_vehicule"], tables["dwh/d_station"], tables["dwh/d_line"])
    since = window.facts

    def trip_stops() -> None:
        rows = facts.trip_stops(stops, trips, *members, since)
        tables.append("dwh/f_trips", facts.new_trip_stops(rows, tables["dwh/f_trips"], since))
        tables.recover("dwh/f_trips_reach")
        tables.reload_from_itself(
            "dwh/f_trips_reach",
            facts.reach(tables["dwh/f_trips"], tables["dwh/f_trips_reach"], since),
        )

    def journeys() -> None:
        rows = facts.journeys(trips, *members, since)
        tables.append("dwh/f_journey", facts.new_journeys(rows, tables["dwh/f_journey"], since))

    def realtime() -> None:
        tables.reload("dwh/f_trips_realtime", facts.realtime(stops, trips, *members, as_of))

    together(trip_stops, journeys, realtime)


def refresh_metrics(tables: Tables, as_of: datetime, window: Window) -> None:
    since = window.metrics
    f_trips, reach = tables["dwh/f_trips"], tables["dwh/f_trips_reach"]
    lowest = 0 if since is None else key_of(since)
    arrived = facts.reaching(f_trips, reach, "last_arrival_tk", lowest)
    week = key_of(days_before(as_of, facts.HISTORY_DAYS))
    recent = facts.reaching(f_trips, reach, "last_departure_tk", week)
    places = (tables["dwh/d_station"], tables["ods/ref_departements"])

    def stations() -> None:
        tables.replace_days("dwh/f_station_platform_usage", facts.platform_usage(arrived, since))
        tables.replace_days(
            "dwh/f_station_daily_metrics",
            facts.daily_metrics(tables["dwh/f_station_platform_usage"], since),
        )

    together(
        lambda: tables.replace_days("dwh/f_line_metrics", facts.line_metrics(arrived, since)),
        lambda: tables.replace_days(
            "dwh/f_daily_punctuality", facts.daily_punctuality(f_trips, since)
        ),
        stations,
        lambda: tables.reload(
            "dwh/delay_steps_realtime",
            facts.delay_steps_realtime(tables["dwh/f_trips_realtime"], *places),
        ),
        lambda: tables.reload(
            "dwh/delay_steps_history", facts.delay_steps_history(recent, *places, as_of=as_of)
        ),
    )


def run_refresh(tables: Tables, as_of: datetime, window: Window | None = None) -> None:
    """All loads after staging, in order; ``as_of`` stands for the current time."""
    window = window or Window.rolling(as_of)
    refresh_ods(tables, window)
    refresh_dims(tables, window)
    refresh_facts(tables, as_of, window)
    refresh_metrics(tables, as_of, window)
