"""Column lists of every stored table, as Spark DDL."""

from __future__ import annotations

STAGED_TRIPS = """
    trip_id string, train string, origin_name string, departure_time string,
    dest_name string, arrival_time string, vehicule_category string,
    vehicule_mode string, published_line_name string, production_date timestamp_ntz
"""

# call_index keeps the order of the calls in the feed
STAGED_STOPS = """
    trip_id string, call_index bigint, stop_name string, aimed_arrival string,
    expected_arrival string, aimed_departure string, expected_departure string,
    is_starting_point bigint, is_terminus bigint, departure_platform_name string,
    arrival_platform_name string, production_date timestamp_ntz
"""

STATIONS = """
    code_uic string, libelle string, fret string, voyageurs string, code_ligne string,
    rg_troncon smallint, pk string, commune string, departemen string, idreseau int,
    idgaia string, x_l93 decimal(10,3), y_l93 decimal(10,3), x_wgs84 decimal(9,6),
    y_wgs84 decimal(9,6), geom string, geom_l93 string
"""

DEPARTEMENTS = """
    code_departement string, nom_departement string, code_region string, nom_region string
"""

NAME_CORRECTIONS = "station_name string, ref_name string, is_foreign boolean"

D_DATE = """
    tk_date int, date date, date_first_day_of_week date, date_last_day_of_week date,
    date_medium string, day_in_month int, is_first_day_of_month boolean,
    is_first_day_of_week boolean, is_first_month_of_quarter boolean,
    is_last_day_of_month boolean, is_last_day_of_week boolean,
    is_last_month_of_quarter boolean, month_abbreviation string, month_medium string,
    month_name string, month_number int, month_number_2digits string, month_tk int,
    quarter_first_month string, quarter_last_month string, quarter_name string,
    quarter_number int, quarter_tk int, week_in_month int, week_in_year string,
    week_medium string, week_number int, year_month_abbreviation string,
    year_month_number string, year_quarter string, year4 int, season string,
    is_public_holiday boolean
"""

D_TIME = """
    tk_time int, hour int, minute int, second int, day_moment string, hour_date string,
    hour_2digits string, minute_2digits string, second_2digits string
"""

D_STATION = """
    tk_station bigint, code_uic string, station_name string, station_name_ref string,
    fret boolean, voyageurs boolean, code_ligne string, rg_troncon smallint, pk string,
    commune string, departement string, idreseau int, idgaia string, x_l93 decimal(10,3),
    y_l93 decimal(10,3), x_wgs84 decimal(9,6), y_wgs84 decimal(9,6), geom string,
    geom_l93 string
"""

D_LINE = "tk_line bigint, line_name string"

D_VEHICULE = """
    tk_vehicule bigint, num_vehicule string, categorie_vehicule string,
    vehicule_mode string, sens_circulation string, type_train string, sous_type string,
    categorie_service string, axe_geographique string, region_origine string,
    vitesse_max_kmh int, plage_numero string, code_mission string, origine_mission string,
    destination_mission string, periode_service string, commentaire string
"""

_DIMENSION_KEYS = """
    stop_station_tk bigint, origin_station_tk bigint, destination_station_tk bigint,
    line_tk bigint, aimed_arrival_date_tk int, aimed_arrival_time_tk int,
    expected_arrival_date_tk int, expected_arrival_time_tk int,
    aimed_departure_date_tk int, aimed_departure_time_tk int,
    expected_departure_date_tk int, expected_departure_time_tk int
"""

F_TRIPS = f"""
    trip_id string, vehicule_tk bigint, num_vehicule string, {_DIMENSION_KEYS},
    delay_arrival_minutes int, delay_departure_minutes int,
    departure_platform_name string, arrival_platform_name string,
    is_starting_point boolean, is_terminus boolean, ref_date_tk int
"""

F_TRIPS_REALTIME = f"""
    trip_id string, vehicule_tk bigint, num_vehicule string, ref_date timestamp_ntz,
    {_DIMENSION_KEYS},
    aimed_departure timestamp_ntz, aimed_arrival timestamp_ntz,
    expected_departure timestamp_ntz, expected_arrival timestamp_ntz,
    delay_arrival_minutes int, delay_departure_minutes int,
    departure_time_journey timestamp_ntz, arrival_time_journey timestamp_ntz,
    departure_platform_name string, arrival_platform_name string,
    is_starting_point boolean, is_terminus boolean,
    status_stop string, status_journey string
"""

F_JOURNEY = """
    trip_id string, vehicule_tk bigint, num_vehicule string, origin_station_tk bigint,
    destination_station_tk bigint, line_tk bigint, departure_journey_date_tk int,
    departure_journey_time_tk int, arrival_journey_date_tk int,
    arrival_journey_time_tk int, ref_date_tk int
"""

ODS_TRIPS = """
    trip_id string, vehicule string, origin_name string, departure_time timestamp_ntz,
    dest_name string, arrival_time timestamp_ntz, published_line_name string,
    production_date timestamp_ntz, ref_date date
"""

ODS_STOPS = """
    trip_id string, stop_name string, aimed_arrival timestamp_ntz,
    expected_arrival timestamp_ntz, aimed_departure timestamp_ntz,
    expected_departure timestamp_ntz, is_starting_point int, is_terminus int,
    departure_platform_name string, arrival_platform_name string,
    production_date timestamp_ntz, ref_date date
"""

ODS_VEHICULES = "num_vehicule string, category_vehicule string, vehicule_mode string"

PUBLIC_HOLIDAYS = "year int, name string, date date"

F_LINE_METRICS = """
    line_tk bigint, nb_journey bigint, nb_delay bigint, delay_rate double,
    delay_minutes bigint, avg_delay_minutes double, ref_date_tk int
"""

LINE_TRIP_BITS = """
    line_tk bigint, ref_date_tk int, part bigint, seen binary, delayed binary, late binary,
    delay_minutes bigint, nb_delays bigint, nb_stops bigint, source_tk int
"""

F_DAILY_PUNCTUALITY = """
    nb_late bigint, nb_trips bigint, terminus_minutes bigint, ref_date_tk int
"""

F_STATION_PLATFORM_USAGE = """
    station_tk bigint, platform_name string, nb_arrivals bigint, nb_departures bigint,
    nb_departures_delayed bigint, nb_arrivals_delayed bigint, avg_delay_minutes double,
    max_delay_minutes int, total_delay_minutes bigint, ref_date_tk int
"""

F_STATION_DAILY_METRICS = """
    station_tk bigint, nb_arrivals bigint, nb_departures bigint,
    nb_departures_delayed bigint, nb_arrivals_delayed bigint, delay_rate double,
    total_delay_minutes bigint, avg_delay_minutes double, max_delay_minutes int,
    nb_platforms_used bigint, most_used_platform string, ref_date_tk int
"""

# latest day any stop of a partition of f_trips arrives or departs
F_TRIPS_REACH = "ref_date_tk int, last_arrival_tk int, last_departure_tk int, first_departure_tk int"

# delay of a stop and of the stop before it, with the region of the stop
DELAY_STEPS = """
    trip_id string, region_station string, ref_date date, heure_passage int,
    delay_arrival_minutes int, prev_delay int
"""

FORECAST = "date timestamp_ntz, predicted_nb_train int, model_name string"

MESSAGE = """
    trip_id string, train string, origin_name string, departure_time string,
    dest_name string, arrival_time string, production_date string, part int, parts int,
    stops array<struct<trip_id: string, stop_name: string, expected_arrival: string,
        aimed_arrival: string, expected_departure: string, aimed_departure: string,
        is_starting_point: int, is_terminus: int, production_date: string>>
"""

# name -> (columns, partition columns)
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "dsa/trips": (STAGED_TRIPS, ()),
    "dsa/stops": (STAGED_STOPS, ()),
    "ods/trips": (ODS_TRIPS, ("ref_date",)),
    "ods/stops": (ODS_STOPS, ("ref_date",)),
    "ods/vehicules": (ODS_VEHICULES, ()),
    "ods/stations": (STATIONS, ()),
    "ods/ref_departements": (DEPARTEMENTS, ()),
    "ods/station_name_corr": (NAME_CORRECTIONS, ()),
    "ods/public_holidays": (PUBLIC_HOLIDAYS, ()),
    "dwh/d_date": (D_DATE, ()),
    "dwh/d_time": (D_TIME, ()),
    "dwh/d_station": (D_STATION, ()),
    "dwh/d_line": (D_LINE, ()),
    "dwh/d_vehicule": (D_VEHICULE, ()),
    "dwh/f_trips": (F_TRIPS, ("ref_date_tk",)),
    "dwh/f_trips_reach": (F_TRIPS_REACH, ()),
    "dwh/f_journey": (F_JOURNEY, ("ref_date_tk",)),
    "dwh/f_trips_realtime": (F_TRIPS_REALTIME, ()),
    "dwh/trip_numbers": ("trip_id string, number bigint", ()),
    "dwh/line_trip_bits": (LINE_TRIP_BITS, ("source_tk",)),
    "dwh/f_line_metrics": (F_LINE_METRICS, ("ref_date_tk",)),
    "dwh/f_daily_punctuality": (F_DAILY_PUNCTUALITY, ("ref_date_tk",)),
    "dwh/f_station_platform_usage": (F_STATION_PLATFORM_USAGE, ("ref_date_tk",)),
    "dwh/f_station_daily_metrics": (F_STATION_DAILY_METRICS, ("ref_date_tk",)),
    "dwh/delay_steps_realtime": (DELAY_STEPS, ()),
    "dwh/delay_steps_history": (DELAY_STEPS, ()),
    "forecast/fact_train_volume_forecast": (FORECAST, ()),
}
