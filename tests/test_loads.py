from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import NOW, frame, stop, trip, values
from quaywise import schemas
from quaywise.plans import checks, dims, facts, forecast, kpi, ods, refresh


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def stations(spark, *rows):
    names = ("code_uic", "libelle", "code_ligne", "pk", "commune", "departemen", "fret")
    return frame(spark, "ods/stations", [dict(zip(names, row)) for row in rows])


def corrections(spark, *rows):
    return frame(
        spark, "ods/station_name_corr", [dict(zip(("station_name", "ref_name"), r)) for r in rows]
    )


def found_stations(spark, names, referential, corr=()):
    rows = spark.createDataFrame([(n,) for n in names], "stop_name string")
    return dims.new_stations(
        rows, referential, corrections(spark, *corr), frame(spark, "dwh/d_station", [])
    )


def test_station_names_match_without_hyphens_and_apostrophes(spark):
    ref = stations(spark, ("1", "L'Isle-d'Abeau", "a", "1", "X", "Isère", "O"))
    found = found_stations(spark, ["l isle d abeau"], ref)
    assert values(found, "station_name", "station_name_ref", "commune", "fret") == [
        ("l isle d abeau", "L'Isle-d'Abeau", "X", True)
    ]


def test_corrections_apply_only_to_unmatched_names(spark):
    ref = stations(
        spark, ("1", "Paris", "a", "1", "P", "75", "N"), ("2", "Lyon", "a", "1", "L", "69", "N")
    )
    found = found_stations(
        spark, ["Paris", "Lyon gare", "Nowhere"], ref,
        [("Paris", "Lyon"), ("Lyon gare", "LYON"), ("Nowhere", "Atlantis")],
    )
    assert values(found, "station_name", "station_name_ref", "commune", "code_uic") == [
        ("Lyon gare", "Lyon", "L", "2"), ("Nowhere", None, "N/A", None), ("Paris", "Paris", "P", "1")
    ]


def test_excluded_code_and_second_rows_do_not_match(spark):
    ref = stations(
        spark,
        (dims.EXCLUDED_UIC, "Gone", "a", "1", "G", "1", "N"),
        ("2", "First", "a", "1", "one", "1", "N"),
        ("2", "Second", "b", "1", "two", "1", "N"),
        ("2", "Third", None, "0", "three", "1", "N"),
    )
    found = found_stations(spark, ["Gone", "First", "Second", "Third"], ref)
    assert {r["station_name"] for r in found.where("code_uic is not null").collect()} == {"First"}


def test_one_name_in_two_places_keeps_both_and_facts_take_the_lowest_key(spark):
    ref = stations(
        spark, ("1", "Valence", "a", "1", "B", "26", "N"), ("2", "Valence", "a", "1", "A", "82", "N"),
        ("3", "VALENCE", "a", "1", "A", "82", "N"),
    )
    found = found_stations(spark, ["Valence"], ref)
    assert values(found, "commune", "code_uic") == [("A", "2"), ("B", "1")]
    keyed = dims.assign_keys(found, "tk_station", ["station_name", "commune", "departement"], 7)
    assert facts._station_keys(keyed).collect()[0]["tk"] == 8


def test_lines_have_one_spelling(spark):
    rows = [
        trip(f"t{i}", "2024-01-15 10:00:00", "2024-01-15 11:00:00", published_line_name=n)
        for i, n in enumerate(["Ligne 1", "LIGNE1", "ligne 1", "N/A", None, "B"])
    ]
    trips = ods.new_trips(frame(spark, "dsa/trips", rows), frame(spark, "ods/trips", []), None)
    new = dims.new_lines(trips, frame(spark, "dwh/d_line", []), None)
    assert values(new) == [("B",), ("LIGNE1",)]
    known = frame(spark, "dwh/d_line", [{"tk_line": 1, "line_name": "B"}])
    assert values(dims.new_lines(trips, known, None)) == [("LIGNE1",)]
    assert dims.new_lines(trips, known, date(2024, 1, 15)).count() == 0


def test_unreadable_departures_are_set_apart(spark):
    staged = frame(
        spark, "dsa/trips", [trip("a", "N/A", "N/A"), trip("b", "2024-01-15 10:00:00", "N/A")]
    )
    loaded = ods.new_trips(staged, frame(spark, "ods/trips", []), None)
    assert values(loaded, "trip_id", "arrival_time") == [("b", None)]
    assert values(ods.unreadable_trips(staged), "trip_id") == [("a",)]


def test_trips_of_past_days_are_not_loaded(spark):
    staged = frame(
        spark, "dsa/trips",
        [trip("a", "2024-01-14 23:59:59", "N/A"), trip("b", "2024-01-15 00:00:00", "N/A")],
    )
    loaded = ods.new_trips(staged, frame(spark, "ods/trips", []), date(2024, 1, 15))
    assert values(loaded, "trip_id") == [("b",)]


def test_a_stop_known_on_any_day_is_not_added_again(spark):
    days = [date(2024, 1, 14), date(2024, 1, 15)]
    trips = frame(spark, "ods/trips", [{"trip_id": "a", "ref_date": d} for d in days])
    target = frame(
        spark, "ods/stops", [{"trip_id": "a", "stop_name": "X", "ref_date": date(2023, 1, 1)}]
    )
    staged = frame(
        spark, "dsa/stops",
        [stop("a", 0, "X"), stop("a", 1, "Y", arrival="2024-01-15 10:00:00"),
         stop("a", 2, "Y", arrival="2024-01-15 11:00:00")],
    )
    added = ods.new_stops(staged, trips, target, None)
    ten = datetime(2024, 1, 15, 10)
    assert values(added, "stop_name", "ref_date", "aimed_arrival", "expected_departure") == [
        ("Y", days[0], ten, None), ("Y", days[1], ten, None)
    ]


def feed(spark, tables, late=3, extra=()):
    """Two trips of today over A, B, C; trip t2 is ``late`` + 4 minutes late at C."""
    day = "2024-01-15"
    trips = [
        trip("t1", f"{day} 10:00:00", f"{day} 13:00:00"),
        trip("t2", f"{day} 11:00:00", f"{day} 14:00:00", train="N/A", published_line_name="LIGNE1"),
        *extra,
    ]
    stops = []
    for name, hour in (("t1", 10), ("t2", 11)):
        stops += [
            stop(name, 0, "A", "", f"{day} {hour}:00:00", late),
            stop(name, 1, "B", f"{day} {hour + 1}:00:00", f"{day} {hour + 1}:05:00", late),
            stop(name, 2, "C", f"{day} {hour + 3}:00:00", "", late + 4 * (name == "t2")),
        ]
    refresh.load_staging(
        tables, frame(spark, "dsa/trips", trips), frame(spark, "dsa/stops", stops)
    )


def referentials(spark, tables):
    places = [("1", "A", "a", "1", "CA", "dép x", "O"), ("2", "B", "a", "1", "CB", "Dep Y", "O"),
              ("3", "C", "a", "1", "CC", "dep y", "N")]
    departements = [
        {"code_departement": "01", "nom_departement": "DÉP X", "code_region": "1",
         "nom_region": "R1"},
        {"code_departement": "02", "nom_departement": "Dép Y", "code_region": "2",
         "nom_region": "R2"},
    ]
    refresh.load_referentials(
        tables, stations(spark, *places), frame(spark, "ods/ref_departements", departements),
        corrections(spark),
    )


CONTENT = [n for n in schemas.TABLES if n.startswith(("ods/", "dwh/"))]


@pytest.fixture
def loaded(spark, tables):
    referentials(spark, tables)
    feed(spark, tables)
    refresh.run_refresh(tables, NOW)
    return tables


def test_running_the_refresh_again_changes_nothing(loaded):
    before = {name: values(loaded[name]) for name in CONTENT}
    refresh.run_refresh(loaded, NOW)
    assert {name: values(loaded[name]) for name in CONTENT} == before


def test_first_write_wins_in_the_facts(spark, loaded):
    before = values(loaded["dwh/f_trips"])
    feed(spark, loaded, late=30)
    refresh.run_refresh(loaded, NOW + timedelta(minutes=2))
    assert values(loaded["dwh/f_trips"]) == before


def test_latest_stops_take_the_newer_times(spark, loaded):
    stored = loaded["ods/stops"]
    newer = stored.where("stop_name = 'B'").withColumn(
        "production_date", F.lit("2024-01-15 11:30:00").cast("timestamp_ntz")
    ).withColumn("expected_arrival", F.lit(None).cast("timestamp_ntz"))
    merged = ods.latest_stops(stored, newer)
    assert merged.count() == stored.count()
    assert merged.where("stop_name = 'B' and expected_arrival is null").count() == 2


def test_fact_rows(loaded):
    rows = loaded["dwh/f_trips"].join(
        loaded["dwh/d_station"], F.col("stop_station_tk") == F.col("tk_station")
    )
    assert values(rows, "trip_id", "station_name", "delay_arrival_minutes", "expected_arrival_time_tk") == [
        ("t1", "A", 0, -1), ("t1", "B", 3, 110300), ("t1", "C", 3, 130300),
        ("t2", "A", 0, -1), ("t2", "B", 3, 120300), ("t2", "C", 7, 140700),
    ]
    # the exact spelling decides in f_trips, the normalised one in f_journey
    lines = loaded["dwh/d_line"]
    assert values(lines, "line_name") == [("LIGNE1",), ("N/A",)]
    assert values(loaded["dwh/f_trips"].where("line_tk > 0"), "trip_id") == [("t2",)] * 3
    assert loaded["dwh/f_journey"].where("line_tk > 0").count() == 2


def test_keys_refer_to_members_and_are_unique(loaded):
    refresh.init_calendar(loaded)
    keys = {"stop_station_tk": ("dwh/d_station", "tk_station"),
            "line_tk": ("dwh/d_line", "tk_line"), "vehicule_tk": ("dwh/d_vehicule", "tk_vehicule"),
            "expected_arrival_date_tk": ("dwh/d_date", "tk_date"),
            "expected_arrival_time_tk": ("dwh/d_time", "tk_time")}
    for column, (name, key) in keys.items():
        assert checks.orphans(loaded["dwh/f_trips"], column, loaded[name], key).isEmpty(), column
        assert checks.repeated(loaded[name], [key]).isEmpty(), name
    unique = ["trip_id", "ref_date_tk", "stop_station_tk"]
    assert checks.repeated(loaded["dwh/f_trips"], unique).isEmpty()


def test_platform_counts_keep_arrivals_and_departures_apart(loaded):
    usage = facts.platform_usage(loaded["dwh/f_trips"], None)
    at_c = usage.join(loaded["dwh/d_station"], F.col("station_tk") == F.col("tk_station")).where(
        "station_name = 'C'"
    ).first()
    assert (at_c.nb_arrivals, at_c.nb_arrivals_delayed) == (2, 2)
    assert (at_c.nb_departures, at_c.nb_departures_delayed) == (2, 0)
    swapped = facts.platform_usage(loaded["dwh/f_trips"], None, legacy_swap=True)
    assert {r.nb_departures_delayed for r in swapped.collect()} == {2}
    # origin stops have no arrival and count nowhere
    names = {r.station_tk for r in usage.collect()}
    assert len(names) == 2


def test_line_metrics_count_any_delay_but_rate_long_ones(loaded):
    rows = facts.line_metrics(loaded["dwh/f_trips"].where("line_tk > 0"), None)
    row = rows.first()
    assert (row.nb_journey, row.nb_delay, row.delay_rate) == (1, 1, 100.0)
    assert (row.delay_minutes, row.avg_delay_minutes) == (10, 5.0)
    other = facts.line_metrics(loaded["dwh/f_trips"].where("line_tk = -1"), None).first()
    assert (other.nb_delay, other.delay_rate) == (1, 0.0)


def test_metrics_of_other_days_stay(spark, loaded):
    old = frame(spark, "dwh/f_line_metrics",
                [{"line_tk": 1, "nb_journey": 9, "ref_date_tk": 20231201}])
    loaded.append("dwh/f_line_metrics", old)
    refresh.run_refresh(loaded, NOW)
    assert loaded["dwh/f_line_metrics"].where("ref_date_tk = 20231201").count() == 1
    assert loaded["dwh/f_line_metrics"].where("ref_date_tk = 20240115").count() == 2


def test_settled_days_are_not_read_for_metrics(spark, loaded):
    reach = frame(spark, "dwh/f_trips_reach", [
        {"ref_date_tk": 20240101, "last_arrival_tk": 20240102, "last_departure_tk": 20240102},
        {"ref_date_tk": 20240115, "last_arrival_tk": 20240115, "last_departure_tk": 20240115},
    ])
    pruned = facts.reaching(loaded["dwh/f_trips"], reach, "last_arrival_tk", 20240114)
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "20240101" in text.split("PartitionFilters")[1].split("]")[0]
    assert pruned.count() == loaded["dwh/f_trips"].count()
    assert values(loaded["dwh/f_trips_reach"]) == [(20240115, 20240115, 20240115, 20240115)]


def test_days_outside_a_window_are_not_read_for_training(spark, loaded):
    """Days whose stops all end before the window, or all begin after it, are not opened."""
    days = ((20240101, 20240102, 20240102, 20240101), (20240301, 20240301, 20240301, 20240301))
    names = ("ref_date_tk", "last_arrival_tk", "last_departure_tk", "first_departure_tk")
    reach = frame(spark, "dwh/f_trips_reach", [dict(zip(names, d)) for d in days])
    loaded.append("dwh/f_trips_reach", reach)
    rows = forecast.training_set(loaded, *forecast.recent_window(NOW))
    filters = plan(rows).split("PartitionFilters")
    assert any("ref_date_tk" in f and "20240101" in f and "20240301" in f for f in filters)


def test_a_periodic_refresh_opens_recent_days_of_stops_only(spark, loaded):
    window = refresh.Window.rolling(NOW)
    recent = refresh._days_from(loaded["ods/stops"], window.stops)
    rows = ods.new_stops(loaded["dsa/stops"], loaded["ods/trips"], recent, window.stops)
    filters = plan(rows).split("PartitionFilters")
    assert any("ref_date" in f and ">= 2024-01-13" in f for f in filters)


def test_a_rewrite_that_fails_halfway_loses_nothing(spark, loaded, monkeypatch):
    before = values(loaded["dwh/f_trips"])
    place = type(loaded)._write

    def fail(self, name, rows, mode):
        if mode == "overwrite":
            # the old partition is gone and little of the new one has come
            place(self, name, rows.limit(1), "overwrite")
            raise OSError("disk full")
        place(self, name, rows, mode)

    with monkeypatch.context() as m:
        m.setattr(type(loaded), "_write", fail)
        with pytest.raises(OSError):
            loaded.compact_days("dwh/f_trips", [20240115])
    loaded.recover("dwh/f_trips")
    assert values(loaded["dwh/f_trips"]) == before
    loaded.recover("dwh/f_trips")
    assert values(loaded["dwh/f_trips"]) == before


def test_steps_follow_arrivals_with_missing_ones_last(loaded):
    steps = loaded["dwh/delay_steps_realtime"].where("trip_id = 't2'")
    # département of B and C: "dep y" differs from "dép y" where accents count
    assert values(steps, "region_station", "delay_arrival_minutes", "prev_delay") == [
        ("R1", 0, None)
    ]


def test_terminus_without_departure_is_the_last_stop(loaded):
    assert values(kpi.delay_by_train_type(loaded, NOW)) == [("RER", 5.0, 2)]


def test_compaction_keeps_the_rows(spark, loaded):
    before = values(loaded["dwh/f_trips"])
    loaded.compact_days("dwh/f_trips", [20240115])
    assert values(loaded["dwh/f_trips"]) == before


def test_facts_wait_for_unknown_trains(spark, tables):
    referentials(spark, tables)
    feed(spark, tables)
    refresh.refresh_ods(tables, refresh.Window.rolling(NOW))
    refresh.refresh_dims(tables, refresh.Window.rolling(NOW))
    without = tables["dwh/d_vehicule"].where("num_vehicule <> 'N/A'")
    rows = facts.trip_stops(
        tables["ods/stops"], tables["ods/trips"], without, tables["dwh/d_station"],
        tables["dwh/d_line"], None,
    )
    assert {r.trip_id for r in rows.collect()} == {"t1"}


def test_no_stored_stop_is_forgotten(spark, tables):
    referentials(spark, tables)
    feed(spark, tables)
    old = frame(spark, "ods/stops", [
        {"trip_id": "t1", "stop_name": "B", "ref_date": date(2021, 12, 1)},
        {"trip_id": "t1", "stop_name": "C", "ref_date": date(2024, 1, 14)},
    ])
    tables.append("ods/stops", old)
    for _ in range(2):
        refresh.refresh_ods(tables, refresh.Window.rolling(NOW))
        today = tables["ods/stops"].where("trip_id = 't1' and ref_date = '2024-01-15'")
        assert values(today, "stop_name") == [("A",)]
    assert refresh.stop_keys(tables).through == date(2024, 1, 12)


def test_an_earlier_refresh_holds_the_keys_anew(spark, tables):
    referentials(spark, tables)
    feed(spark, tables)
    later = NOW + timedelta(days=30)
    refresh.refresh_ods(tables, refresh.Window.rolling(later))
    assert refresh.stop_keys(tables).through == date(2024, 2, 11)
    refresh.refresh_ods(tables, refresh.Window.rolling(NOW))
    stored = tables["ods/stops"].count()
    assert stored > 0 and refresh.stop_keys(tables).through == date(2024, 1, 12)
    refresh.refresh_ods(tables, refresh.Window.rolling(later))
    refresh.refresh_ods(tables, refresh.Window.history())
    assert tables["ods/stops"].count() == stored
    assert refresh.stop_keys(tables).through is None


def test_one_key_with_most_rows_is_inserted_once(spark):
    rows = [stop("N/A", i, "same") for i in range(500)] + [stop("x", 0, "other")]
    staged = frame(spark, "dsa/stops", rows)
    trips = frame(spark, "ods/trips", [{"trip_id": "N/A", "ref_date": date(2024, 1, 15)}])
    added = ods.new_stops(staged, trips, frame(spark, "ods/stops", []), None)
    assert values(added, "stop_name", "is_starting_point") == [("same", 1)]
