from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from quaywise.functions import calendar, status, text, times, trains
from quaywise.plans import checks
from quaywise.functions.numbers import percent_change, round_ratio
from quaywise.plans import dashboard, dims, kpi
from quaywise.sources import referentials

NOW = datetime(2024, 1, 15, 12, 0, 0)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "seconds, minutes", [(150, 3), (-150, -3), (29, 0), (30, 1), (-30, -1), (-29, 0), (90000, 1500)]
)
def test_delay_rounds_half_away_from_zero(spark, seconds, minutes):
    base = times.ntz(datetime(2024, 3, 31, 1, 30))
    late = times.shift_seconds(base, F.lit(seconds))
    assert one(spark, times.delay_minutes(late, base)) == minutes


def test_missing_time_gives_no_delay(spark):
    nothing = F.lit(None).cast("timestamp_ntz")
    assert one(spark, times.delay_minutes(nothing, times.ntz(datetime(2024, 1, 1)))) == 0


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        # 02:00 to 03:00 does not exist on that day in Paris
        a, b = times.ntz(datetime(2024, 3, 31, 1, 50)), times.ntz(datetime(2024, 3, 31, 3, 10))
        assert one(spark, times.delay_minutes(b, a)) == 80
        inside = times.ntz(datetime(2024, 3, 31, 2, 30, 15))
        assert one(spark, times.hour_floor(inside)) == datetime(2024, 3, 31, 2)
        assert one(spark, times.hour_ceil(inside)) == datetime(2024, 3, 31, 3)
        assert one(spark, times.time_key(inside)) == 23015
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_keys_and_delays_are_whole_number_arithmetic(spark):
    """No date, time or decimal is built for each row and field."""
    late, aimed = times.ntz(datetime(1969, 12, 31, 23, 59, 59)), times.ntz(datetime(1969, 12, 31, 23, 59, 30))
    assert one(spark, times.time_key(late + F.lit(timedelta(microseconds=999_999)))) == 235959
    assert one(spark, times.delay_minutes(late + F.lit(timedelta(microseconds=999_999)), aimed)) == 0
    assert one(spark, times.delay_minutes(aimed, late + F.lit(timedelta(seconds=1)))) == -1
    rows = spark.createDataFrame([], "a timestamp_ntz, b timestamp_ntz, n int")
    shown = rows.select(
        times.time_key(F.col("a")), times.delay_minutes(F.col("a"), F.col("b")),
        times.shift_minutes(F.col("a"), F.col("n")), times.shift_seconds(F.col("a"), F.col("n")),
    )._jdf.queryExecution().analyzed().toString()
    assert not any(word in shown for word in ("hour(", "second(", "extract", "make_dt_interval", "decimal"))


def test_text_with_offset_keeps_its_wall_clock(spark):
    read = F.lit("2025-06-01T10:00:00+02:00").try_cast("timestamp_ntz")
    assert one(spark, read) == datetime(2025, 6, 1, 10)


def test_keys_round_trip(spark):
    ts = times.ntz(datetime(2024, 1, 5, 7, 8, 9))
    keys = (times.date_key(ts.cast("date")), times.time_key(ts))
    assert one(spark, keys[0]) == 20240105 and one(spark, keys[1]) == 70809
    assert one(spark, times.keys_to_ts(*keys)) == datetime(2024, 1, 5, 7, 8, 9)
    assert one(spark, times.keys_to_ts(F.lit(-1), F.lit(-1))) is None
    assert one(spark, times.date_key(F.lit("2041-01-01").cast("date"))) == -1


@pytest.mark.parametrize(
    "num, den, digits, expected",
    [(1, 8, 2, 0.13), (-1, 8, 2, -0.13), (5, 2, 0, 3.0), (-5, 2, 0, -3.0), (1, 3, 5, 0.33333),
     (7, 0, 2, None)],
)
def test_round_ratio(spark, num, den, digits, expected):
    assert one(spark, round_ratio(F.lit(num), F.lit(den), digits)) == expected


def test_percent_change_needs_a_base(spark):
    assert one(spark, percent_change(F.lit(3), F.lit(0))) is None
    assert one(spark, percent_change(F.lit(3), F.lit(2))) == 50.0


BANDS = {
    "1": "1–499", "499": "1–499", "500": None, "6999": None, "7000": "7000–7999",
    "8999": "8000–8999", "50199": "50000–50199", "50200": None, "99999": "70000–99999",
    "110000": "110000–119999", "119999": "110000–119999", "300000": "300000–399999",
    "749999": "700000–749999", "750000": "750000–799999", "856999": "854000–856999",
    "857000": None, "N/A": None, "12345678901234567890123": None, "0": None,
}


def test_train_bands(spark):
    rows = spark.createDataFrame([(n,) for n in BANDS], "n string")
    decoded = trains.decoded(rows, "n")
    for row in decoded.collect():
        assert row["plage_numero"] == BANDS[row["n"]], row["n"]
        if row["n"] == "N/A":
            assert row["commentaire"] == trains.NOT_A_NUMBER and row["sens_circulation"] is None
        else:
            assert row["sens_circulation"] == ("Pair" if int(row["n"]) % 2 == 0 else "Impair")
            known = BANDS[row["n"]] is not None
            assert row["commentaire"] == ("" if known else trains.OUT_OF_RANGE)


def test_bands_are_a_table_joined_by_bins(spark):
    own = trains.bands(spark, [trains.Band(995, 2005, "A", "x"), trains.Band(2006, 2006, "B", "y")])
    rows = spark.range(990, 2010).select(F.col("id").cast("string").alias("n"))
    decoded = trains.decoded(rows, "n", own)
    assert decoded.count() == 1020
    assert {r["type_train"]: r["count"] for r in decoded.groupBy("type_train").count().collect()} == {
        "A": 1011, "B": 1, None: 8}
    plan = trains.decoded(rows, "n")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overlapping_and_missing_bands_are_reported(spark):
    band = lambda low, high: trains.Band(low, high, "t", "s")
    own = trains.bands(spark, [band(1, 9), band(5, 7), band(9, 12), band(13, 20), band(30, 40)])
    found = checks.overlapping_bands(own).select("low").collect()
    assert [r["low"] for r in found] == [5, 9]
    assert [tuple(r) for r in checks.missing_bands(own).collect()] == [(21, 29)]
    assert checks.overlapping_bands(trains.bands(spark)).count() == 0
    assert (500, 6999) in [tuple(r) for r in checks.missing_bands(trains.bands(spark)).collect()]


SAME_NAMES = [
    ("Évry", "EVRY"), ("É́vry".replace("́", ""), "evry"), ("Évry", "evry"), ("Győr", "gyor"), ("ŠIBENIK", "šibenik"),
    ("Škofja Loka", "skofja loka"), ("Œuilly", "oeuilly"), ("Łódź", "LODZ"), ("Αθήνα", "ΑΘΗΝΑ"), ("Москва́", "москва"),
    ("Straße", "STRASSE"), ("Tromsø", "tromso"),
]


def test_names_join_without_case_and_accents(spark):
    left = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(SAME_NAMES)], "i int, a string")
    right = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(SAME_NAMES)] + [(99, "other")], "j int, b string")
    joined = left.join(right, text.folded(F.col("a")) == text.folded(F.col("b")))
    pairs = {(r["i"], r["j"]) for r in joined.collect()}
    assert {(i, i) for i in range(len(SAME_NAMES))} <= pairs
    assert all(i == j or {i, j} <= {0, 1, 2} for i, j in pairs)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


EARLY, LATE, NOW = datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 15), datetime(2024, 1, 1, 12)


@pytest.mark.parametrize(
    "arr, dep, start, terminus, expected",
    [
        (LATE, None, False, True, "TERMINE"),
        (LATE, None, False, False, "NON_PLANIFIE"),
        (None, LATE, False, False, "NON_PLANIFIE"),
        (EARLY, EARLY, False, False, "TERMINE"),
        (LATE, LATE, False, False, "A_VENIR"),
        (EARLY, LATE, False, False, "EN_COURS"),
        (NOW, NOW, False, False, "EN_COURS"),
        (None, LATE, True, False, "EN_COURS"),
    ],
)
def test_stop_status(spark, arr, dep, start, terminus, expected):
    rows = spark.createDataFrame(
        [(arr, dep, start, terminus)],
        "expected_arrival timestamp_ntz, expected_departure timestamp_ntz, "
        "is_starting_point boolean, is_terminus boolean",
    )
    assert rows.select(status.stop_status(times.ntz(NOW))).first()[0] == expected


@pytest.mark.parametrize(
    "dep, arr, expected",
    [(EARLY, LATE, "EN_COURS"), (EARLY, EARLY, "TERMINE"), (LATE, LATE, "PREVU"),
     (NOW, LATE, "PREVU")],
)
def test_journey_status(spark, dep, arr, expected):
    rows = spark.createDataFrame(
        [(dep, arr)],
        "departure_time_journey timestamp_ntz, arrival_time_journey timestamp_ntz",
    )
    assert rows.select(status.journey_status(times.ntz(NOW))).first()[0] == expected


def test_names_fold(spark):
    assert one(spark, text.station_key(F.lit("L'Isle-d'Abeau"))) == "l isle d abeau"
    assert one(spark, text.folded(F.lit("Côtes-d'Armor Œuvre")) == text.folded(F.lit("cotes-D'ARMOR oeuvre")))
    assert one(spark, text.line_key(F.lit("Ligne 1 B"))) == "ligne1b"


def test_movable_holidays(spark):
    years = spark.createDataFrame([(2024,), (2025,), (2026,)], "y int")
    found = years.select(F.inline(calendar.holidays(F.col("y")))).collect()
    by_name = {(r["name"], r["date"].year): r["date"] for r in found}
    assert len(found) == 33
    assert by_name["Lundi de Pâques", 2024] == date(2024, 4, 1)
    assert by_name["Ascension", 2025] == date(2025, 5, 29)
    assert by_name["Lundi de Pentecôte", 2026] == date(2026, 5, 25)


def test_calendar_and_clock_are_complete(spark):
    days = dims.d_date(spark)
    assert days.count() == 9132 + 1
    assert days.where("tk_date = -1 and date is null").count() == 1
    assert dims.d_time(spark).count() == 86400 + 1
    day = days.where("tk_date = 20240229").first()
    assert (day.date_medium, day.quarter_name, day.week_in_year) == ("29 feb", "1er", "2024-S09")
    assert day.is_last_day_of_month and day.year_quarter == "2024-T1"
    assert day.is_public_holiday is None


def test_holiday_flag_is_never_taken_back(spark):
    days = dims.d_date(spark)
    flagged = dims.flag_holidays(days, dims.public_holidays(days))
    assert flagged.where("is_public_holiday").count() == 26 * 11 - 10
    again = dims.flag_holidays(flagged, dims.public_holidays(days).limit(0))
    assert again.where("is_public_holiday").count() == 26 * 11 - 10


def test_stop_status_for_every_combination(spark):
    """All times around now and all flags, NULL included, against the rules in SQL."""
    moments = [None, NOW - timedelta(minutes=5), NOW, NOW + timedelta(minutes=5)]
    flags = [None, True, False]
    cases = [(a, d, s, t) for a in moments for d in moments for s in flags for t in flags]
    names = "expected_arrival timestamp_ntz, expected_departure timestamp_ntz, is_starting_point boolean, is_terminus boolean"
    rows = spark.createDataFrame(cases, names)
    found = [r[0] for r in rows.select(status.stop_status(times.ntz(NOW))).collect()]
    duck = duckdb.connect()
    duck.execute("create table s (a timestamp, d timestamp, s boolean, t boolean)")
    duck.executemany("insert into s values (?, ?, ?, ?)", cases)
    now = f"timestamp '{NOW}'"
    expected = duck.execute(f"""select case when d is null and t then 'TERMINE'
        when d is null and not t then 'NON_PLANIFIE' when a is null and not s then 'NON_PLANIFIE'
        when (t or d < {now}) and a < {now} then 'TERMINE'
        when (t or d > {now}) and a > {now} then 'A_VENIR' else 'EN_COURS' end from s""").fetchall()
    assert found == [r[0] for r in expected]
    assert set(found) == {"TERMINE", "NON_PLANIFIE", "A_VENIR", "EN_COURS"}


@pytest.mark.parametrize(
    "category, family",
    [("RER A", "RER"), ("rer_b", "RER"), ("Train TER_nord", "TRAIN TER"), ("train special", "TRAIN SPECIAL"),
     ("Train", "TRAIN"), ("TRAIN_X", "TRAIN X"), ("INTER_CITES", "INTER CITES"), ("", ""), (None, "Non identifié")],
)
def test_train_family(spark, category, family):
    rows = spark.createDataFrame([(category,)], "c string")
    assert rows.select(kpi.train_family(F.col("c"))).first()[0] == family


@pytest.mark.parametrize(
    "state, delay, shown",
    [("EN_COURS", None, "En cours"), ("EN_COURS", 1, "À l’heure"), ("EN_COURS", -3, "À l’heure"),
     ("EN_COURS", 2, "Retard 2 min"), ("PREVU", 9, "À venir"), ("TERMINE", None, "Terminé"),
     ("OTHER", 1, "Indéterminé"), (None, None, "Indéterminé")],
)
def test_board_status(spark, state, delay, shown):
    rows = spark.createDataFrame([(state, delay)], "status_journey string, delay_arrival_minutes int")
    assert rows.select(dashboard.board_status()).first()[0] == shown


def test_departements_are_complete():
    codes = [r[0] for r in referentials.DEPARTEMENTS]
    assert len(codes) == len(set(codes)) == 101
    assert len({r[2] for r in referentials.DEPARTEMENTS}) == len({r[3] for r in referentials.DEPARTEMENTS}) == 18
