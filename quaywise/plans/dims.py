"""Dimension loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.functions import calendar, text, times, trains
from quaywise.operators.merge import pick_one, rows_to_insert

UNKNOWN_STATION = "Gare/Station inconnue"
UNKNOWN_LINE = "N/A"
# Fixed value: a referential code left out of station matching.
EXCLUDED_UIC = "87276063"


def assign_keys(rows: DataFrame, key: str, order: list[str], above: int) -> DataFrame:
    """Surrogate keys greater than ``above``, rising with ``order``.

    The sort is distributed by ranges and every partition numbers its own rows,
    so keys are unique and ordered but need not be dense. The caller stores the
    rows before anything refers to the keys.
    """
    return rows.orderBy(*order).withColumn(
        key, F.lit(above + 1).cast("bigint") + F.monotonically_increasing_id()
    )


def highest_key(dimension: DataFrame, key: str) -> int:
    top = dimension.agg(F.max(key)).first()[0]
    return 0 if top is None else max(top, 0)


# --- dates and times -------------------------------------------------------


def d_date(spark: SparkSession, public_holidays: DataFrame | None = None) -> DataFrame:
    """The calendar with its unknown member; the flag is NULL until holidays are given."""
    days = spark.range(1).select(
        F.explode(
            F.sequence(times.day(times.CALENDAR_FIRST), times.day(times.CALENDAR_LAST))
        ).alias("d")
    )
    rows = days.select(
        *[c.alias(name) for name, c in calendar.date_attributes(F.col("d")).items()],
        F.lit(None).cast("boolean").alias("is_public_holiday"),
    )
    unknown = rows.limit(1).select(
        F.lit(times.UNKNOWN_KEY).alias("tk_date"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != "tk_date"],
    )
    rows = rows.unionByName(unknown)
    return rows if public_holidays is None else flag_holidays(rows, public_holidays)


def public_holidays(dates: DataFrame, column: str = "date") -> DataFrame:
    """(year, name, date) of the public holidays of every year found in ``dates``."""
    years = dates.select(F.year(column).alias("year")).where(F.col("year").isNotNull()).distinct()
    return years.select(
        "year", F.inline(calendar.holidays(F.col("year")))
    )


def flag_holidays(calendar_rows: DataFrame, holidays: DataFrame) -> DataFrame:
    """Set the holiday flag on matching dates; a flag once set is never taken back."""
    marks = holidays.select("date", F.lit(True).alias("_holiday")).distinct()
    return (
        calendar_rows.join(marks, "date", "left")
        .withColumn("is_public_holiday", F.coalesce("_holiday", "is_public_holiday"))
        .select(*calendar_rows.columns)
    )


def d_time(spark: SparkSession) -> DataFrame:
    """Every second of the day, and the unknown member."""
    seconds = spark.range(86_400).select(
        *[c.alias(n) for n, c in calendar.clock_attributes(F.col("id").cast("int")).items()]
    )
    unknown = spark.range(1).select(
        F.lit(times.UNKNOWN_KEY).alias("tk_time"),
        *[F.lit(0).alias(c) for c in ("hour", "minute", "second")],
        *[F.lit(None).cast("string").alias(c) for c in ("day_moment", "hour_date")],
        *[F.lit("NC").alias(c) for c in ("hour_2digits", "minute_2digits", "second_2digits")],
    )
    return seconds.unionByName(unknown)


# --- vehicles --------------------------------------------------------------


def new_vehicules(staged_trips: DataFrame, target: DataFrame) -> DataFrame:
    """Train numbers not in the dimension yet, decoded; keys are assigned later."""
    rows = staged_trips.select(
        F.col("train").alias("num_vehicule"),
        F.split_part("vehicule_category", F.lit("::"), F.lit(2)).alias("categorie_vehicule"),
        "vehicule_mode",
        "production_date",
        "trip_id",
    )
    fresh = rows_to_insert(
        target, rows, ["num_vehicule"], [F.col("production_date"), F.col("trip_id")]
    )
    kept = fresh.select("num_vehicule", "categorie_vehicule", "vehicule_mode")
    return trains.decoded(kept, "num_vehicule")


# --- lines -----------------------------------------------------------------


def new_lines(ods_trips: DataFrame, target: DataFrame, arrived_after: date | None) -> DataFrame:
    """One spelling for each line, names compared without spaces and case."""
    name = F.col("published_line_name")
    trips = ods_trips.where(name.isNotNull() & (name != UNKNOWN_LINE))
    if arrived_after is not None:
        trips = trips.where(F.col("arrival_time").cast("date") > times.day(arrived_after))
    spellings = (
        trips.groupBy(F.upper(F.replace(name, F.lit(" "), F.lit(""))).alias("_name"))
        .agg(F.min(name).alias("line_name"))
        .drop("_name")
    )
    return rows_to_insert(target, spellings, ["line_name"])


def unknown_line(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit(times.UNKNOWN_KEY).cast("bigint").alias("tk_line"),
        F.lit(UNKNOWN_LINE).alias("line_name"),
    )


# --- stations --------------------------------------------------------------


def _nulls_last(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def referential_by_name(stations: DataFrame) -> DataFrame:
    """Referential rows stops can match, one for each (name key, commune, département).

    First the leading row of each station code, then the lowest code of each
    place: rows of one place would only collide in the dimension later, so
    keeping one of them here keeps the join with the stop names small.
    """
    rest = [c for c in stations.columns if c not in ("code_uic", "code_ligne", "pk")]
    leading = pick_one(
        stations.where(F.col("code_uic") != EXCLUDED_UIC),
        ["code_uic"],
        _nulls_last("code_ligne", "pk", *rest),
    )
    keyed = leading.withColumn("name_key", text.station_key(F.col("libelle"))).where(
        F.col("name_key").isNotNull()
    )
    keyed = keyed.withColumn("commune", F.coalesce("commune", F.lit("N/A"))).withColumn(
        "departement", F.coalesce("departemen", F.lit("N/A"))
    )
    return pick_one(keyed, ["name_key", "commune", "departement"], _nulls_last("code_uic"))


def new_stations(
    stop_names: DataFrame, stations: DataFrame, corrections: DataFrame, target: DataFrame
) -> DataFrame:
    """Stations behind the stop names, not in the dimension yet.

    A stop matches the referential by its own name; only where that fails the
    correction table may name another station. What matches nothing becomes a
    station of its own.
    """
    referential = referential_by_name(stations)
    names = (
        stop_names.select("stop_name")
        .distinct()
        .withColumn("own_key", text.station_key(F.col("stop_name")))
    )
    known = referential.select(F.col("name_key").alias("own_key")).distinct()
    matched = names.join(known, "own_key", "left_semi").withColumn("name_key", F.col("own_key"))
    corrected = (
        names.join(known, "own_key", "left_anti")
        .join(
            corrections.select(F.col("station_name").alias("stop_name"), "ref_name").distinct(),
            "stop_name",
            "left",
        )
        .withColumn("name_key", text.station_key(F.col("ref_name")))
        .drop("ref_name")
    )
    keyed = matched.unionByName(corrected)
    # names without any key need no join, and would all meet in one partition
    found = (
        keyed.where(F.col("name_key").isNotNull())
        .join(referential, "name_key", "left")
        .unionByName(keyed.where(F.col("name_key").isNull()), allowMissingColumns=True)
    )

    def yes_no(column: str) -> Column:
        return F.when(F.col(column) == "O", True).when(F.col(column) == "N", False)

    rows = found.select(
        "code_uic",
        F.col("stop_name").alias("station_name"),
        F.col("libelle").alias("station_name_ref"),
        yes_no("fret").alias("fret"),
        yes_no("voyageurs").alias("voyageurs"),
        "code_ligne",
        "rg_troncon",
        "pk",
        F.coalesce("commune", F.lit("N/A")).alias("commune"),
        F.coalesce("departement", F.lit("N/A")).alias("departement"),
        *("idreseau", "idgaia", "x_l93", "y_l93", "x_wgs84", "y_wgs84", "geom", "geom_l93"),
    )
    return rows_to_insert(
        target,
        rows,
        ["station_name", "commune", "departement"],
        _nulls_last("code_uic", "station_name_ref"),
    )


def unknown_station(like: DataFrame) -> DataFrame:
    """The unknown member, with the columns of ``like``."""
    given = {
        "tk_station": F.lit(times.UNKNOWN_KEY).cast("bigint"),
        "station_name": F.lit(UNKNOWN_STATION),
    }
    return like.sparkSession.range(1).select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema
        ]
    )
