"""Queries behind the dashboards.

Optional parameters are None for "all". Result columns carry the line or the
station, so one call can answer for one of them or for all.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaywise.functions import text, times
from quaywise.functions.numbers import percent_change, ratio, round_ratio
from quaywise.plans import kpi
from quaywise.sources.tables import Tables

ALL = "-2"
LINE_DAYS = 14
PUNCTUAL_PERCENT = 90



def _only(rows: DataFrame, column: str, value: int | str | None) -> DataFrame:
    """Keep one value; the predicate is not there at all for "all"."""
    if value is None or value == ALL:
        return rows
    return rows.where(F.col(column) == F.lit(value))


def _among(rows: DataFrame, column: str, values: Sequence[int] | None) -> DataFrame:
    return rows if values is None else rows.where(F.col(column).isin(*values))


# --- traffic overview ------------------------------------------------------


def late_share_today(tables: Tables, as_of: datetime) -> DataFrame:
    day = as_of.date()
    today = kpi.late_rate(tables, day).where(F.col("jour") == times.day(day))
    share = ratio(F.sum("nb_trains_en_retard") * 100, F.sum("nb_trains_total"))
    rates = today.agg(share.alias("taux_retard_pct"))
    return rates.withColumn("taux_ponctualite_pct", F.lit(100.0) - F.col("taux_retard_pct"))


def punctuality_flag(tables: Tables, as_of: datetime) -> DataFrame:
    """The share of today with the flag the gauge turns red on."""
    return late_share_today(tables, as_of).withColumn(
        "sous_objectif", F.col("taux_ponctualite_pct") < PUNCTUAL_PERCENT
    )


def hours_with_forecast(tables: Tables, as_of: datetime) -> DataFrame:
    forecast = tables["forecast/fact_train_volume_forecast"].select(
        F.col("date").alias("hour_start"), "predicted_nb_train"
    )
    return (
        kpi.trains_per_hour(tables, as_of)
        .join(forecast, "hour_start", "left")
        .select(
            F.date_format("hour_start", "HH:mm").alias("heure"),
            "nb_trains_actifs",
            "nb_trains_actifs_j_1",
            "predicted_nb_train",
        )
    )


def delay_minutes_two_days(tables: Tables, as_of: datetime) -> DataFrame:
    day = F.col("date")
    return (
        kpi.delay_by_region(tables)
        .where(day.between(times.day(times.days_before(as_of, 1)), times.day(as_of.date())))
        .groupBy(day.alias("jour"))
        .agg(F.sum("total_delay_generated").alias("total_minutes_retard"))
        .orderBy(F.desc("jour"))
        .limit(2)
    )


def train_types_top(tables: Tables, as_of: datetime, top: int = 6) -> DataFrame:
    return (
        kpi.delay_by_train_type(tables, as_of)
        .orderBy(F.desc("nb_trains"), F.asc("type_vehicule"))
        .limit(top)
    )


def train_type_severity(tables: Tables, as_of: datetime) -> DataFrame:
    """The top train types with the colour band of their delay."""
    delay = F.col("retard_moyen_min")
    band = F.when(delay > 5, "danger").when(delay > 2, "warning").otherwise("success")
    return train_types_top(tables, as_of).withColumn("niveau", band)


def region_ranking(tables: Tables, as_of: datetime, top: int = 4) -> DataFrame:
    return (
        kpi.delay_by_region(tables)
        .where(F.col("date") == times.day(as_of.date()))
        .groupBy("region_station")
        .agg(F.sum("total_delay_generated").alias("total_delay_generated"))
        .orderBy(F.desc("total_delay_generated"), F.asc("region_station"))
        .limit(top)
    )


def region_share(tables: Tables, as_of: datetime) -> DataFrame:
    """Each listed region's part of the delay of the listed regions, in percent."""
    listed = region_ranking(tables, as_of)
    total = F.sum("total_delay_generated").over(Window.partitionBy())  # four rows
    share = round_ratio(F.col("total_delay_generated") * 100, F.col("_total"), 1)
    return (
        listed.withColumn("_total", total)
        .withColumn("part_pct", F.coalesce(share, F.lit(0.0)))
        .drop("_total")
    )


def heat_map(tables: Tables) -> DataFrame:
    """Regions by hour of the day, 0 where nothing was recorded."""
    columns = [f"h{hour:02d}" for hour in range(24)]
    label = F.concat(F.lit("h"), F.lpad(F.col("heure_passage").cast("string"), 2, "0"))
    return (
        kpi.delay_by_hour_and_region(tables)
        .withColumn("hour_label", label)
        .groupBy("region_station")
        .pivot("hour_label", columns)
        .agg(F.first("avg_delay_generated"))
        .fillna(0.0, columns)
    )


def active_trains_progress(tables: Tables, as_of: datetime) -> DataFrame:
    """Trains running now against an hour ago, with the text shown."""
    now, before = F.col("nb_trains_actifs"), F.col("nb_trains_actifs_h_1")
    change = percent_change(now, before)
    signed = F.concat(
        F.when(change >= 0, "+").otherwise(""), change.cast("decimal(20,1)").cast("string"),
        F.lit("%"),
    )
    shown = F.when(before > 0, signed).when(now > 0, "Nouveau").otherwise("0%")
    return kpi.active_trains(tables, as_of).select(
        now, before, change.alias("progression_pct"), shown.alias("progression")
    )


def delay_minutes_progress(tables: Tables, as_of: datetime) -> DataFrame:
    """Delay minutes of today against yesterday; 1 stands for "from nothing"."""
    days = delay_minutes_two_days(tables, as_of)
    today = F.col("jour") == times.day(as_of.date())
    minutes = days.agg(
        F.max(F.when(today, F.col("total_minutes_retard"))).alias("minutes_aujourdhui"),
        F.max(F.when(~today, F.col("total_minutes_retard"))).alias("minutes_hier"),
    )
    now, before = F.col("minutes_aujourdhui"), F.col("minutes_hier")
    change = (
        F.when(before != 0, round_ratio((now - before) * 100, before, 1))
        .when(now > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    # nothing to compare unless both days are there
    return minutes.where(now.isNotNull() & before.isNotNull()).withColumn(
        "variation_vs_hier", change
    )


# --- lines -----------------------------------------------------------------


def _line_days(
    tables: Tables, as_of: datetime, days: int, lines: Sequence[int] | None
) -> DataFrame:
    first, last = times.key_of(times.days_before(as_of, days)), times.key_of(as_of.date())
    metrics = tables["dwh/f_line_metrics"].where(F.col("ref_date_tk") >= first)
    if days == 0:
        metrics = metrics.where(F.col("ref_date_tk") == last)
    names = tables["dwh/d_line"].select(F.col("tk_line").alias("line_tk"), "line_name")
    return (
        _among(metrics, "line_tk", lines)
        .join(names, "line_tk")
        .withColumn("jour", times.key_to_date(F.col("ref_date_tk")))
    )


def _one(line: int | None) -> list[int] | None:
    return None if line is None else [line]


def line_volume(tables: Tables, as_of: datetime, line: int | None = None) -> DataFrame:
    return (
        _line_days(tables, as_of, LINE_DAYS, _one(line))
        .groupBy("line_name", "jour")
        .agg(
            F.sum("nb_journey").alias("nb_trajets_total"),
            F.sum("nb_delay").alias("nb_trajets_en_retard"),
        )
    )


def _rates(groups) -> DataFrame:
    late = ratio(F.sum("nb_delay") * 100, F.sum("nb_journey"))
    rates = groups.agg(late.alias("taux_retard_pct"))
    return rates.withColumn("taux_ponctualite_pct", F.lit(100.0) - F.col("taux_retard_pct"))


def line_rates(tables: Tables, as_of: datetime, line: int | None = None) -> DataFrame:
    rows = _line_days(tables, as_of, LINE_DAYS, _one(line))
    return _rates(rows.groupBy("line_name", "jour"))


def line_rates_today(tables: Tables, as_of: datetime, line: int | None = None) -> DataFrame:
    return _rates(_line_days(tables, as_of, 0, _one(line)).groupBy("line_name"))


def line_list(tables: Tables) -> DataFrame:
    return tables["dwh/d_line"].where(F.col("tk_line") != times.UNKNOWN_KEY).orderBy("line_name")


def lines_chart(
    tables: Tables, as_of: datetime, lines: Sequence[int] | None = None
) -> DataFrame:
    return (
        _line_days(tables, as_of, LINE_DAYS, lines)
        .orderBy(F.asc("jour"), F.col("delay_rate").desc_nulls_first(), F.desc("nb_delay"))
        .select(
            F.col("jour").alias("date"),
            F.col("line_name").alias("ligne"),
            F.col("nb_journey").alias("nb_trajets"),
            F.col("nb_delay").alias("nb_retards"),
        )
    )


def lines_table(
    tables: Tables, as_of: datetime, lines: Sequence[int] | None = None
) -> DataFrame:
    return (
        _line_days(tables, as_of, 0, lines)
        .orderBy(F.col("delay_rate").desc_nulls_first(), F.desc("nb_delay"), F.asc("line_name"))
        .select(
            F.col("line_name").alias("ligne"),
            F.col("nb_journey").alias("nb_trajets"),
            F.col("nb_delay").alias("nb_retards"),
            F.col("delay_rate").alias("taux_retard_pct"),
            F.col("delay_minutes").alias("nb_minutes_retard"),
            F.col("avg_delay_minutes").alias("retard_moyen_min"),
        )
    )


def lines_pivot(tables: Tables, as_of: datetime, names: Sequence[str]) -> DataFrame:
    """Days by line, two columns for each named line, 0 where a day has none."""
    rows = lines_chart(tables, as_of).where(F.col("ligne").isin(*names))
    wide = (
        rows.groupBy("date")
        .pivot("ligne", list(names))
        .agg(F.first("nb_trajets").alias("Total"), F.first("nb_retards").alias("Retard"))
    )
    return wide.select(
        "date",
        *[
            F.coalesce(F.col(f"`{name}_{part}`"), F.lit(0).cast("bigint")).alias(
                f"{name} ({part})"
            )
            for name in names
            for part in ("Total", "Retard")
        ],
    )


# --- places ----------------------------------------------------------------


def _sentinel(rows: DataFrame, label: str) -> DataFrame:
    """The "all" entry on top of a two-column list."""
    key, value = rows.columns
    entry = rows.sparkSession.range(1).select(F.lit(ALL).alias(key), F.lit(label).alias(value))
    return entry.unionAll(rows)


def regions(tables: Tables) -> DataFrame:
    rows = tables["ods/ref_departements"].select("code_region", "nom_region").distinct()
    return _sentinel(rows.orderBy("nom_region"), "Toutes les régions")


def departements(tables: Tables, region: str | None = None) -> DataFrame:
    rows = _only(tables["ods/ref_departements"], "code_region", region)
    rows = rows.select("code_departement", "nom_departement").distinct()
    return _sentinel(rows.orderBy("nom_departement"), "Tous les départements")


def _placed_stations(
    tables: Tables, region: str | None, departement: str | None, commune: str | None = None
) -> DataFrame:
    """Stations with their département, names compared without case and accents."""
    places = _only(tables["ods/ref_departements"], "code_region", region)
    places = _only(places, "code_departement", departement).select(
        text.folded(F.col("nom_departement")).alias("_place")
    )
    stations = tables["dwh/d_station"].withColumn("_place", text.folded(F.col("departement")))
    if commune is not None and commune != ALL:
        stations = stations.where(text.folded(F.col("commune")) == text.folded(F.lit(commune)))
    return stations.join(places, "_place").drop("_place")


def communes(
    tables: Tables, region: str | None = None, departement: str | None = None
) -> DataFrame:
    rows = _placed_stations(tables, region, departement)
    rows = rows.select(F.col("commune").alias("commune_key")).distinct()
    rows = rows.select("commune_key", F.col("commune_key").alias("commune_val"))
    return _sentinel(rows.orderBy("commune_key"), "Toutes les communes")


def stations(
    tables: Tables,
    region: str | None = None,
    departement: str | None = None,
    commune: str | None = None,
) -> DataFrame:
    rows = _placed_stations(tables, region, departement, commune)
    return (
        rows.where(F.col("tk_station") != times.UNKNOWN_KEY)
        .select("tk_station", "station_name_ref")
        .orderBy("station_name_ref")
    )


def stations_or_all(
    tables: Tables,
    region: str | None = None,
    departement: str | None = None,
    commune: str | None = None,
) -> DataFrame:
    rows = stations(tables, region, departement, commune)
    rows = rows.withColumn("tk_station", F.col("tk_station").cast("string"))
    return _sentinel(rows, "Toutes les gares")


# --- one station, or all ---------------------------------------------------


def _recent_station_days(tables: Tables, as_of: datetime, station: int | None) -> DataFrame:
    rows = kpi.station_days(tables, times.days_before(as_of, 1))
    return _only(rows, "station_tk", station)


def station_kpi(tables: Tables, as_of: datetime, station: int | None = None) -> DataFrame:
    return _recent_station_days(tables, as_of, station).select(
        "station_name", "ref_date", "total_trains", "total_delay_minutes",
        "nb_delayed_trains", "punctuality_rate", "avg_delay_minutes",
    ).orderBy(F.desc("ref_date"), F.asc("station_name"))


def station_flow(tables: Tables, as_of: datetime, station: int | None = None) -> DataFrame:
    return _recent_station_days(tables, as_of, station).select(
        "station_name", "ref_date", "nb_arrivals", "nb_departures",
        "nb_arrivals_delayed_trains", "nb_departures_delayed_trains",
    ).orderBy(F.desc("ref_date"), F.asc("station_name"))


def platforms_today(tables: Tables, as_of: datetime, station: int | None = None) -> DataFrame:
    day = as_of.date()
    rows = kpi.platform_days(tables, day).where(F.col("date") == times.day(day))
    return (
        _only(rows, "tk_station", station)
        .orderBy(F.desc("trafic_total"), F.asc("station_name"), F.asc("platform_name"))
        .select("station_name", "date", "platform_name", "nb_arrivals", "nb_departures")
    )


def station_deltas(tables: Tables, as_of: datetime, station: int | None = None) -> DataFrame:
    """Latest day of a station against the day before it among the recent days.

    Punctuality changes in points, trains and delay in percent; 0 without a base.
    """
    rows = _recent_station_days(tables, as_of, station)
    cents = [
        (F.col("punctuality_rate") * 100).cast("decimal(20,0)").cast("bigint").alias("punctual"),
        (F.col("avg_delay_minutes") * 100).cast("decimal(20,0)").cast("bigint").alias("delay"),
        F.col("total_trains").alias("trains"),
    ]
    latest = Window.partitionBy("station_tk").orderBy(F.desc("ref_date"))  # a few recent days
    ranked = rows.select("station_tk", "station_name", "ref_date", *cents)
    for name in ("punctual", "delay", "trains"):
        ranked = ranked.withColumn(f"{name}_before", F.lead(name).over(latest))
    ranked = ranked.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1)

    def change(name: str) -> Column:
        base = F.col(f"{name}_before")
        return F.coalesce(round_ratio((F.col(name) - base) * 100, base, 1), F.lit(0.0))

    points = F.col("punctual") - F.col("punctual_before")
    return ranked.select(
        "station_name",
        "ref_date",
        F.coalesce(round_ratio(points, F.lit(100), 1), F.lit(0.0)).alias("ponctualite_points"),
        change("trains").alias("trains_pct"),
        change("delay").alias("retard_pct"),
    )


# --- departure board -------------------------------------------------------


def board_status() -> Column:
    """What the board says of a stop's train."""
    status, delay = F.col("status_journey"), F.col("delay_arrival_minutes")
    # fixed values: the texts of the board
    return (
        F.when((status == "EN_COURS") & delay.isNull(), "En cours")
        .when((status == "EN_COURS") & (delay <= 1), "À l’heure")
        .when(status == "EN_COURS", F.concat(F.lit("Retard "), delay.cast("string"), F.lit(" min")))
        .when(status == "PREVU", "À venir")
        .when(status == "TERMINE", "Terminé")
        .otherwise("Indéterminé")
    )


def departure_board(
    tables: Tables,
    as_of: datetime,
    region: str | None = None,
    departement: str | None = None,
    commune: str | None = None,
    station: int | None = None,
) -> DataFrame:
    """Stops of the trains that run now, or start within half an hour.

    A trip is joined through its few distinct headers and not through its stops:
    only header columns are shown, so the distinct result is the same.
    """
    now = times.ntz(as_of)
    soon = times.ntz(as_of + timedelta(minutes=30))
    realtime = tables[kpi.REALTIME]
    vehicles = tables["dwh/d_vehicule"].select("num_vehicule", "categorie_vehicule")
    headers = (
        realtime.where(
            (F.col("ref_date").cast("date") == times.day(as_of.date()))
            & F.col("status_journey").isin("EN_COURS", "PREVU")
        )
        .select(
            "trip_id", "num_vehicule", "origin_station_tk", "destination_station_tk",
            F.col("status_journey").alias("trip_status"),
        )
        .distinct()
        .join(vehicles, "num_vehicule")
    )
    places = _placed_stations(tables, region, departement, commune)
    stop_names = _only(places, "tk_station", station).select(
        F.col("tk_station").alias("stop_station_tk"), F.col("station_name").alias("stop_name")
    )

    def role(key: str, name: str) -> DataFrame:
        return tables["dwh/d_station"].select(
            F.col("tk_station").alias(key), F.col("station_name").alias(name)
        )

    departure = F.col("expected_departure")
    stops = (
        realtime.where(departure.isNotNull())
        .select(
            "trip_id", "stop_station_tk", "status_journey", "delay_arrival_minutes",
            "expected_departure",
        )
        .join(stop_names, "stop_station_tk")
    )
    board = (
        stops.join(headers, "trip_id")
        .where((F.col("trip_status") == "EN_COURS") | departure.between(now, soon))
        .join(role("origin_station_tk", "origin_name"), "origin_station_tk", "left")
        .join(role("destination_station_tk", "dest_name"), "destination_station_tk", "left")
    )
    from_elsewhere = F.concat("stop_name", F.lit(" (De "), "origin_name", F.lit(")"))
    return (
        board.select(
            F.col("num_vehicule").alias("train_numero"),
            F.coalesce("categorie_vehicule", F.lit("Inconnu")).alias("type_train"),
            F.when(F.col("stop_station_tk") == F.col("origin_station_tk"), F.col("stop_name"))
            .otherwise(from_elsewhere)
            .alias("gare_depart"),
            F.col("dest_name").alias("gare_arrivee"),
            board_status().alias("statut"),
            F.date_format(departure, "HH:mm").alias("heure_depart"),
        )
        .distinct()
        .orderBy(F.desc("heure_depart"))
    )
