"""Hourly train volume: training set, model and forecast."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.functions import times
from quaywise.operators.distinct import entities, per_entity
from quaywise.operators.hours import hour_spine, spread_hours
from quaywise.operators.merge import pick_one
from quaywise.plans import facts
from quaywise.session import scratch_path
from quaywise.sources.objects import write_daily
from quaywise.sources.tables import Tables

CALENDAR_FEATURES = (
    "is_weekend",
    "day_in_month",
    "is_first_day_of_month",
    "is_first_day_of_week",
    "is_first_month_of_quarter",
    "is_last_day_of_month",
    "is_last_day_of_week",
    "is_last_month_of_quarter",
    "day_in_the_week",
    "is_public_holiday",
)
FEATURES = ("hour", *CALENDAR_FEATURES)
LABEL = "nb_trains_actifs"
# The model's parameters.
TREES, DEPTH, SEED, TRAIN_SHARE = 200, 10, 42, 0.8

METRICS = ("mse", "rmse", "mae", "r2")
METADATA = """
    model_name string, trained_until timestamp_ntz, mse double, rmse double, mae double,
    r2 double, n_rows bigint, features array<string>, created_at timestamp_ntz
"""


def yesterday_window(as_of: datetime) -> tuple[datetime, datetime]:
    """First and last hour of the daily training set: 47 hours up to yesterday's end."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    return midnight - timedelta(hours=47), midnight - timedelta(hours=1)


def recent_window(as_of: datetime, days: int = 10) -> tuple[datetime, datetime]:
    """The longer window: some days and 23 hours up to the current hour."""
    hour = as_of.replace(minute=0, second=0, microsecond=0)
    return hour - timedelta(days=days, hours=23), hour


def with_calendar(hours: DataFrame, d_date: DataFrame) -> DataFrame:
    """Hours with the calendar features of their day; days without a calendar drop out."""
    weekday = F.dayofweek("date")  # Sunday is 1
    days = d_date.where(F.col("tk_date") != times.UNKNOWN_KEY).select(
        F.col("date").alias("_day"),
        weekday.isin(1, 7).alias("is_weekend"),
        "day_in_month",
        "is_first_day_of_month",
        "is_first_day_of_week",
        "is_first_month_of_quarter",
        "is_last_day_of_month",
        "is_last_day_of_week",
        "is_last_month_of_quarter",
        weekday.alias("day_in_the_week"),
        F.coalesce("is_public_holiday", F.lit(False)).alias("is_public_holiday"),
    )
    # the calendar has a fixed number of days, so it always fits a broadcast
    return hours.join(
        F.broadcast(days), F.col("hour_start").cast("date") == F.col("_day")
    ).drop("_day")


def training_set(tables: Tables, first: datetime, last: datetime) -> DataFrame:
    """For each clock hour: calendar features and the trains at a stop in it.

    A stop counts where it departs before the end of the hour and arrives at or
    after its start; stops without both times never count.
    """
    lo, hi = times.key_of(first.date()), times.key_of(last.date())
    days = facts.overlapping(tables["dwh/f_trips"], tables["dwh/f_trips_reach"], lo, hi)
    stops = days.where(
        # implied by the overlap with the window; these reach the Parquet scan
        (F.col("expected_arrival_date_tk") >= lo)
        & (F.col("expected_departure_date_tk") <= hi)
        & (F.col("expected_departure_date_tk") != times.UNKNOWN_KEY)
    )

    def hour_of(kind: str) -> Column:
        return times.keys_to_hour(F.col(f"{kind}_date_tk"), F.col(f"{kind}_time_tk"))

    overlaps = spread_hours(
        stops.select("trip_id", hour_of("expected_departure").alias("dep"),
                     hour_of("expected_arrival").alias("arr")),
        F.col("dep"),
        F.col("arr"),
        first,
        last,
    )
    counts = per_entity(overlaps, ["hour_start"], "trip_id").groupBy("hour_start").agg(
        entities().alias(LABEL)
    )
    hours = with_calendar(hour_spine(tables.spark, first, last), tables["dwh/d_date"])
    return hours.join(counts, "hour_start", "left").select(
        F.col("hour_start").cast("date").alias("date"),
        "hour_start",
        times.shift_hours(F.col("hour_start"), 1).alias("hour_end"),
        *CALENDAR_FEATURES,
        F.coalesce(LABEL, F.lit(0).cast("bigint")).alias(LABEL),
    )


def store_training_set(tables: Tables, folder: str, as_of: datetime) -> None:
    """The daily job: yesterday's training set as an object of its own.

    Sets of consecutive days overlap, and the older one has hours the newer one
    lacks, so objects are kept by the day they were made for and not by date.
    """
    made_for = times.days_before(as_of, 1).strftime("%Y%m%d")
    rows = training_set(tables, *yesterday_window(as_of))
    write_daily(rows.withColumn("made_for", F.lit(int(made_for))), folder, "made_for")


def future_grid(tables: Tables, trained_until: datetime, as_of: datetime) -> DataFrame:
    """Features of every hour after ``trained_until`` up to tomorrow 23:00."""
    midnight = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    hours = hour_spine(
        tables.spark, trained_until + timedelta(hours=1), midnight + timedelta(days=1, hours=23)
    )
    return with_calendar(hours, tables["dwh/d_date"]).select(
        "hour_start", F.hour("hour_start").alias("hour"), *CALENDAR_FEATURES
    )


def unique_hours(rows: DataFrame) -> DataFrame:
    """Consecutive daily sets share 23 hours: keep one row for each hour."""
    rest = [c for c in rows.columns if c != "hour_start"]
    order = [F.col(LABEL).desc()] + [F.col(c) for c in rest if c != LABEL]
    return pick_one(rows, ["hour_start"], order)


def split_by_time(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Oldest part for training, newest part for scoring."""
    n_train = int(rows.count() * TRAIN_SHARE)
    # one row, the first of the scoring part
    cut = rows.select("hour_start").orderBy("hour_start").offset(n_train).limit(1).first()
    if cut is None:
        return rows, rows.limit(0)
    first_test = times.ntz(cut[0])
    return (
        rows.where(F.col("hour_start") < first_test),
        rows.where(F.col("hour_start") >= first_test),
    )


def _numeric(rows: DataFrame) -> DataFrame:
    return rows.select(
        "*", *[F.col(c).cast("double").alias(f"x_{c}") for c in FEATURES]
    )


def _hours(rows: DataFrame) -> DataFrame:
    """One row for each hour, with the model's inputs; stored, as it is read several times.

    There are as many rows as hours of the calendar at most.
    """
    hours = unique_hours(rows).withColumn("hour", F.hour("hour_start"))
    hours = _numeric(hours).withColumn("label", F.col(LABEL).cast("double"))
    folder = scratch_path(rows.sparkSession, "hours")
    hours.write.parquet(folder)
    return rows.sparkSession.read.schema(hours.schema).parquet(folder)


def errors(scored_rows: DataFrame) -> DataFrame:
    """All metrics in one aggregate over labels and predictions."""
    label, miss = F.col("label"), F.col("label") - F.col("prediction")
    squares, n = F.sum(miss * miss), F.count(F.lit(1))
    around_mean = F.sum(label * label) - n * F.pow(F.avg(label), 2)
    return scored_rows.agg(
        (squares / n).alias("mse"),
        F.sqrt(squares / n).alias("rmse"),
        F.avg(F.abs(miss)).alias("mae"),
        (1 - squares / around_mean).alias("r2"),
    )


def scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Labels and predictions of the newest part of the training sets."""
    _, test = split_by_time(_hours(rows))
    return model.transform(test).select("hour_start", "label", "prediction")


def fit(rows: DataFrame, created_at: datetime) -> tuple[PipelineModel, DataFrame]:
    """Model and its one metadata row, from the stored hourly training sets."""
    spark = rows.sparkSession
    hours = _hours(rows)
    train, test = split_by_time(hours)
    forest = RandomForestRegressor(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="all"
    )
    assembler = VectorAssembler(inputCols=[f"x_{c}" for c in FEATURES], outputCol="features")
    model = Pipeline(stages=[assembler, forest]).fit(train)
    found = errors(model.transform(test)).first()
    bounds = hours.agg(F.max("hour_start").alias("last"), F.count(F.lit(1)).alias("n")).first()
    until = train.agg(F.max("hour_start")).first()[0]
    row = (
        f"nb_trains_model_{bounds['last']:%Y-%m-%d}", until, *(found[m] for m in METRICS),
        bounds["n"], list(FEATURES), created_at,
    )
    return model, spark.createDataFrame([row], METADATA)


def save(model: PipelineModel, metadata: DataFrame, root: str) -> None:
    """Model folder by name, and its metadata as one JSON row."""
    name = metadata.first()["model_name"]
    model.write().overwrite().save(f"{root}/models/{name}")
    metadata.write.mode("overwrite").json(f"{root}/metadata/{name}")


def load_latest(spark: SparkSession, root: str) -> tuple[PipelineModel, dict]:
    """The model created last."""
    latest = (
        spark.read.schema(METADATA)
        .option("recursiveFileLookup", "true")
        .json(f"{root}/metadata")
        .orderBy(F.desc("created_at"), F.desc("model_name"))
        .first()
    )
    if latest is None:
        raise FileNotFoundError(f"no model below {root}")
    return PipelineModel.load(f"{root}/models/{latest['model_name']}"), latest.asDict()


def raw_predictions(model: PipelineModel, grid: DataFrame) -> DataFrame:
    """The model's predictions with their fractions, by hour."""
    return model.transform(_numeric(grid)).select("hour_start", "prediction")


def predict(model: PipelineModel, grid: DataFrame, model_name: str) -> DataFrame:
    """Whole trains for each hour of the grid, fractions cut off."""
    return model.transform(_numeric(grid)).select(
        F.col("hour_start").alias("date"),
        F.col("prediction").cast("int").alias("predicted_nb_train"),
        F.lit(model_name).alias("model_name"),
    )


def refresh_forecast(tables: Tables, model_root: str, as_of: datetime) -> None:
    """Replace the stored forecast by that of the latest model."""
    model, metadata = load_latest(tables.spark, model_root)
    grid = future_grid(tables, metadata["trained_until"], as_of)
    tables.reload(
        "forecast/fact_train_volume_forecast", predict(model, grid, metadata["model_name"])
    )
