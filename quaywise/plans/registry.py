"""Every query by name, over the whole warehouse of the sample feed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from math import ceil
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.functions import times
from quaywise.operators import merge, parts
from quaywise.plans import dashboard, dims, facts, forecast, forest, increments, kpi, ods, refresh
from quaywise.plans.sample_warehouse import AS_OF, warehouse
from quaywise.session import scratch_path
from quaywise.sources import gtfs, messages, objects, referentials, sample, siri
from quaywise.sources.tables import Tables
from quaywise.streaming import latest, upserts
from quaywise.streaming import trips as streams
from quaywise.streaming.batches import Batches

Query = Callable[[SparkSession, str], DataFrame]

LINES = ("1 URGENT", "2 HIGH", "3 MEDIUM", "4 NOT SPECIFIED", "5 LOW")


def _on_tables(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(warehouse(spark, sf_dir))


def _names(tables: Tables, role: str) -> DataFrame:
    """Station names for the keys of one role: ``role``_station_tk."""
    return tables["dwh/d_station"].select(
        F.col("tk_station").alias(f"{role}_station_tk"), F.col("station_name").alias(f"{role}_name")
    )


def _line_names(tables: Tables) -> DataFrame:
    return tables["dwh/d_line"].select(F.col("tk_line").alias("line_tk"), "line_name")


def _named(tables: Tables, rows: DataFrame, *roles: str) -> DataFrame:
    """Natural names instead of surrogate keys, so results can be compared."""
    for role in roles:
        rows = rows.join(_names(tables, role), f"{role}_station_tk").drop(f"{role}_station_tk")
    if "line_tk" in rows.columns:
        rows = rows.join(_line_names(tables), "line_tk").drop("line_tk")
    return rows.drop("vehicule_tk")


# --- dimensions ------------------------------------------------------------


def _per_key(tables: Tables, key: str, out: str) -> DataFrame:
    return tables["dwh/f_trips"].groupBy(F.col(key).alias(out)).agg(F.count(F.lit(1)).alias("nb_stops"))


def _d_date(tables: Tables) -> DataFrame:
    """Every day of the calendar and the unknown one, with the stops of the day."""
    return (
        tables["dwh/d_date"]
        .drop("week_number", "season")
        .join(_per_key(tables, "ref_date_tk", "tk_date"), "tk_date", "left")
        .fillna(0, ["nb_stops"])
        .fillna(False, ["is_public_holiday"])
    )


def _d_time(tables: Tables) -> DataFrame:
    """Every second of the day and the unknown one, with the stops at that second."""
    usage = _per_key(tables, "expected_arrival_time_tk", "tk_time")
    return tables["dwh/d_time"].join(usage, "tk_time", "left").fillna(0, ["nb_stops"])


def _holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders on the public holidays of every year found in the orders."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderdate").cast("date").alias("date")
    )
    per_day = orders.groupBy("date").agg(F.count(F.lit(1)).alias("nb_orders"))
    return (
        dims.public_holidays(per_day)
        .join(per_day, "date", "left")
        .select("year", "name", "date", F.coalesce("nb_orders", F.lit(0)).alias("nb_orders"))
    )


def _static_departements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All départements, with the stations of the nation that has their code."""
    code = F.lpad(F.col("s_nationkey").cast("string"), 2, "0")
    served = spark.read.parquet(f"{sf_dir}/supplier.parquet").groupBy(
        code.alias("code_departement")
    ).agg(F.count(F.lit(1)).alias("nb_stations"))
    return (
        referentials.departements(spark)
        .join(served, "code_departement", "left")
        .fillna(0, ["nb_stations"])
    )


def _corrections_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name corrections of all stations, from a CSV file as a user supplies it."""
    path = scratch_path(spark, "corrections")
    sample.name_corrections(spark, sf_dir).write.option("header", "true").csv(path)
    return referentials.name_corrections(spark, path)


def _d_station(tables: Tables) -> DataFrame:
    return tables["dwh/d_station"].drop("tk_station", "idgaia")


# --- loads -----------------------------------------------------------------


def _renamed(staged: DataFrame) -> DataFrame:
    """Stops of a feed an hour later, in which half of the names are new."""
    renamed = F.when(
        F.col("call_index") % 2 == 0, F.concat("stop_name", F.lit(" bis"))
    ).otherwise(F.col("stop_name"))
    return staged.withColumn("stop_name", renamed).withColumn(
        "production_date", times.shift_hours(F.col("production_date"), 1)
    )


def _insert_if_absent(tables: Tables) -> DataFrame:
    """What a second feed would add to the stops: its trips run a day later, and
    half of its stop names are new."""
    feed = _renamed(tables["dsa/stops"])
    added = ods.new_stops(feed, tables["ods/trips"], tables["ods/stops"], None)
    return added.select(
        "trip_id", "stop_name", "ref_date", "expected_arrival", "expected_departure"
    )


def _latest_stops(tables: Tables) -> DataFrame:
    """Stops after a newer feed moved the expected times of every second call."""
    stored = tables["ods/stops"]
    newer = stored.where(F.second("expected_arrival") == 0)
    for column in ("expected_arrival", "expected_departure"):
        newer = newer.withColumn(
            column, times.shift_minutes(F.col(column), F.lit(7))
        )
    newer = newer.withColumn(
        "production_date", times.shift_hours(F.col("production_date"), 1)
    )
    merged = ods.latest_stops(stored, newer)
    return merged.select(
        "trip_id", "stop_name", "ref_date", "expected_arrival", "expected_departure",
        "production_date",
    )


def _upsert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line metrics after two days were changed and then recomputed."""
    source = warehouse(spark, sf_dir)
    tables = Tables(spark, scratch_path(spark, "upsert"))
    stored = source["dwh/f_line_metrics"].withColumn("nb_journey", F.col("nb_journey") + 1000)
    tables.replace_days("dwh/f_line_metrics", stored)
    since = times.days_before(AS_OF, 1)
    tables.replace_days(
        "dwh/f_line_metrics", facts.line_metrics(source["dwh/f_trips"], since)
    )
    return _named(source, tables["dwh/f_line_metrics"])


def _line_metrics_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line metrics kept up over three loads of stops, each with stops of every trip.

    The second load was cut short between its stops and its increments.
    """
    source = warehouse(spark, sf_dir)
    tables = Tables(spark, scratch_path(spark, "increments"))
    load = F.pmod(F.xxhash64("trip_id", "stop_station_tk"), F.lit(3))
    for k in range(3):
        folder = scratch_path(spark, "added")
        source["dwh/f_trips"].where(load == k).write.parquet(folder)
        added = spark.read.schema(source["dwh/f_trips"].schema).parquet(folder)
        tables.append("dwh/f_trips", added)
        if k != 1:
            increments.add_stops(tables, added)
    return _named(source, increments.line_metrics(tables))


def _ods_window(tables: Tables) -> DataFrame:
    """Trips the periodic load would add to an empty table at the current time."""
    empty = tables["ods/trips"].limit(0)
    return ods.new_trips(tables["dsa/trips"], empty, times.days_before(AS_OF, 0))


def _refresh_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each day after a periodic refresh of a warehouse that was not empty.

    The first feed lacks every third train and is loaded in full; the second
    has them all and goes through the windows of the periodic refresh.
    """
    source = warehouse(spark, sf_dir)
    tables = Tables(spark, scratch_path(spark, "rolling"))
    trips, stops = source["dsa/trips"], source["dsa/stops"]
    early = F.substring("trip_id", 2, 20).cast("bigint") % 3 != 0
    refresh.init_calendar(tables)
    refresh.load_referentials(
        tables, source["ods/stations"], source["ods/ref_departements"],
        source["ods/station_name_corr"],
    )
    refresh.load_staging(tables, trips.where(early), stops.where(early))
    refresh.run_refresh(tables, AS_OF, refresh.Window.history())
    refresh.load_staging(tables, trips, stops)
    refresh.run_refresh(tables, AS_OF, refresh.Window.rolling(AS_OF))

    def counted(name: str, day, out: str, value=None) -> DataFrame:
        number = F.count(F.lit(1)) if value is None else F.sum(value)
        return tables[name].groupBy(day.alias("ref_date_tk")).agg(number.alias(out))

    counts = [
        counted("ods/trips", times.date_key(F.col("ref_date")), "nb_trips"),
        counted("ods/stops", times.date_key(F.col("ref_date")), "nb_stops"),
        counted("dwh/f_trips", F.col("ref_date_tk"), "nb_facts"),
        counted("dwh/f_journey", F.col("ref_date_tk"), "nb_journeys"),
        counted("dwh/f_line_metrics", F.col("ref_date_tk"), "nb_line_journeys", "nb_journey"),
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.join(one, "ref_date_tk", "full")
    return result.fillna(0)


def _refresh_reused_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops after a feed used its trip ids again sixty days later.

    Half of the stop names of the second feed are new; the others were stored
    long before the days that its periodic refresh opens.
    """
    source = warehouse(spark, sf_dir)
    tables = Tables(spark, scratch_path(spark, "reused"))
    trips, stops = source["dsa/trips"], source["dsa/stops"]
    left = F.col("departure_time").cast("timestamp_ntz")
    earlier = times.shift_hours(left, -24 * 60).cast("string")
    refresh.load_staging(tables, trips.withColumn("departure_time", earlier), stops)
    refresh.refresh_ods(tables, refresh.Window.rolling(AS_OF - timedelta(days=75)))
    refresh.load_staging(tables, trips, _renamed(stops))
    refresh.refresh_ods(tables, refresh.Window.rolling(AS_OF))
    return tables["ods/stops"].select("trip_id", "stop_name", "ref_date", "expected_arrival")


# --- feeds -----------------------------------------------------------------


_folders: dict[tuple[str, str, str], str] = {}
_folders_lock = RLock()  # a run may need another folder


def _once(spark: SparkSession, sf_dir: str, kind: str, run: Callable[[], str]) -> str:
    """Folder that ``run`` fills, kept for the session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _folders_lock:
        if key not in _folders:
            _folders[key] = run()
        return _folders[key]


def _landing(
    spark: SparkSession, sf_dir: str, kind: str, write: Callable[[Tables, str], None]
) -> str:
    """Folder of a feed made from the staged tables."""

    def run() -> str:
        path = scratch_path(spark, kind)
        write(warehouse(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, kind, run)


def _journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    def write(tables: Tables, path: str) -> None:
        rows = sample.journeys(tables["dsa/trips"], tables["dsa/stops"])
        sample.write_journeys(rows, path)

    return siri.read_journeys(spark, _landing(spark, sf_dir, "xml", write))


def _xml_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return siri.staged_trips(_journeys(spark, sf_dir), sample.PRODUCED)


def _xml_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    stops = siri.staged_stops(_journeys(spark, sf_dir), sample.PRODUCED)
    return stops.drop("call_index", "production_date")


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of the whole feed, one on each line of the landed files."""

    def write(tables: Tables, path: str) -> None:
        rows = messages.trip_messages(tables["dsa/trips"], tables["dsa/stops"])
        objects.land(rows, path)

    return spark.read.text(_landing(spark, sf_dir, "messages", write))


def _message_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.message_stops(messages.parse_messages(_messages(spark, sf_dir)))


def _gtfs_entities(tables: Tables) -> DataFrame:
    """Decoded entities, one for each trip and day with the updates of its stops.

    Where these are very many they come in several entities, as feeds may send them.
    """

    def event(kind: str):
        seen = F.col(f"expected_{kind}")
        return F.when(
            seen.isNotNull(),
            F.struct(
                (times.delay_minutes(seen, F.col(f"aimed_{kind}")) * 60).alias("delay"),
                F.unix_seconds(seen.cast("timestamp")).alias("time"),
            ),
        )

    update = F.struct(
        F.col("stop_name").alias("stop_id"),
        event("arrival").alias("arrival"),
        event("departure").alias("departure"),
    )
    stops, of_trip = tables["ods/stops"], ["trip_id", "ref_date", "production_date"]
    found = parts.sizes(stops, of_trip, messages.PART_STOPS)
    trips = parts.dealt(stops, found, of_trip, ["stop_name"]).groupBy(*of_trip, "part", "parts").agg(
        F.array_sort(F.collect_list(update)).alias("updates")
    )
    number = F.when(F.col("parts") > 1, F.concat(F.lit("-"), "part")).otherwise("")
    return trips.select(
        F.concat("trip_id", number).alias("id"),
        F.struct(
            F.struct(
                F.col("trip_id"), F.date_format("ref_date", "yyyyMMdd").alias("start_date")
            ).alias("trip"),
            F.unix_seconds(F.col("production_date").cast("timestamp")).alias("timestamp"),
            F.col("updates").alias("stop_time_update"),
        ).alias("trip_update"),
    )


def _gtfs_updates(tables: Tables) -> DataFrame:
    return gtfs.stop_updates(_gtfs_entities(tables))


def _training_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recent training set, stored and read back."""
    folder = scratch_path(spark, "training")
    rows = forecast.training_set(warehouse(spark, sf_dir), *forecast.recent_window(AS_OF))
    objects.write_daily(rows, folder, "date")
    return objects.read_daily(spark, folder)


def _daily_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily job over five days, the last of them run twice; one row for each hour."""
    tables = warehouse(spark, sf_dir)
    folder = scratch_path(spark, "objects")
    for days_ago in (4, 3, 2, 1, 0, 0):
        forecast.store_training_set(tables, folder, AS_OF - timedelta(days=days_ago))
    return forecast.unique_hours(objects.read_daily(spark, folder).drop("made_for"))


def _objects_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose objects match a name pattern, with the trips of the day."""
    trips = warehouse(spark, sf_dir)["ods/trips"]
    folder = scratch_path(spark, "by-day")
    objects.write_daily(trips.select("trip_id", "ref_date"), folder, "ref_date")
    found = objects.read_matching(spark, folder, r"/ref_date=2024-01-1[0-4]/[^/]*\.parquet$")
    day = F.regexp_extract("path", "ref_date=([0-9-]+)", 1).cast("date")
    return (
        found.where(F.length("content") > 0)
        .select(day.alias("ref_date"))
        .distinct()
        .join(trips, "ref_date")
        .groupBy("ref_date")
        .agg(F.count(F.lit(1)).alias("nb_trips"))
    )


# --- streams ---------------------------------------------------------------


def _stream(
    spark: SparkSession,
    sink: Callable[[str], Callable[[DataFrame, int], None]],
    feeds: list[DataFrame],
    read: Callable[[DataFrame], DataFrame] = streams.parsed_stream,
) -> str:
    """Run the feeds one after another through a sink; returns its folder."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    checkpoint = scratch_path(spark, "checkpoint")
    for feed in feeds:
        objects.land(feed, landing)
        streams.drain(read(streams.file_messages(spark, landing)), sink(root), checkpoint)
    objects.clear(spark, landing)
    return root


def _with_bad_lines(feed: DataFrame) -> DataFrame:
    """Every message, and a cut-off copy of each that no parser can read."""
    return feed.unionByName(feed.select(F.concat(F.lit("{"), F.col("value")).alias("value")))


def _appended(spark: SparkSession, sf_dir: str) -> str:
    return _stream(spark, streams.append_batch, [_with_bad_lines(_messages(spark, sf_dir))])


def _stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Batches(spark, _appended(spark, sf_dir)).read("stops")


def _stream_append_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Batches(spark, _appended(spark, sf_dir)).read("trips")


def _trips_and_rejects(good: DataFrame, rejected: DataFrame, trip_in_text: str) -> DataFrame:
    """Rows and different trips of both kinds, in one aggregate."""
    trip_id = F.regexp_extract("value", trip_in_text, 1)
    both = good.select("trip_id", F.lit(True).alias("good")).unionByName(
        rejected.select(trip_id.alias("trip_id"), F.lit(False).alias("good"))
    )
    trips = both.groupBy("trip_id", "good").agg(F.count(F.lit(1)).alias("n"))
    return trips.agg(
        F.count_if("good").alias("nb_trips"),
        F.count_if(~F.col("good")).alias("nb_rejects"),
        F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("nb_good_rows"),
    )


def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _appended(spark, sf_dir)
    return _trips_and_rejects(
        Batches(spark, root).read("trips"), Batches(spark, root).read("rejects"),
        '"trip_id":"([^"]+)"',
    )


def _stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops of a feed in which every message is sent twice."""
    feed = _messages(spark, sf_dir)
    root = _stream(
        spark,
        streams.append_batch,
        [feed.unionByName(feed)],
        lambda messages_in: streams.parsed_stream(messages_in, "2 hours"),
    )
    return Batches(spark, root).read("stops")


def _stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops of a feed that came in six batches, compacted on the way and at the end.

    A batch that was cut short before its commit has left all of its rows.
    """
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    feed = _messages(spark, sf_dir)
    files = max(1, ceil(feed.count() / 6 / objects.FILE_ROWS))
    objects.land(feed.repartition(6 * files), landing)
    stream = streams.parsed_stream(streams.file_messages(spark, landing, files_per_batch=files))
    streams.drain(stream, streams.append_batch(root, compact_every=4), scratch_path(spark, "checkpoint"))
    objects.clear(spark, landing)
    batches = Batches(spark, root)
    _message_stops(spark, sf_dir).write.parquet(batches.path("stops", "000000000099-cut-short"))
    batches.compact(at_least=2)
    batches.vacuum()
    return batches.read("stops")


def _gtfs_streamed(spark: SparkSession, sf_dir: str) -> str:
    entities = _gtfs_entities(warehouse(spark, sf_dir))
    feed = entities.select(F.to_json(F.struct("*")).alias("value"))
    return _stream(
        spark, streams.gtfs_batch, [_with_bad_lines(feed)], lambda messages_in: messages_in
    )


def _stream_gtfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Batches(spark, _gtfs_streamed(spark, sf_dir)).read("stop_updates")


def _stream_gtfs_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _gtfs_streamed(spark, sf_dir)
    return _trips_and_rejects(
        Batches(spark, root).read("stop_updates"), Batches(spark, root).read("rejects"),
        '"id":"([^"]+)"',
    )


def _upserted(spark: SparkSession, sf_dir: str) -> str:
    """Tables after two feeds; the second, an hour newer, moves the destination."""
    tables = warehouse(spark, sf_dir)
    trips, stops = tables["dsa/trips"], tables["dsa/stops"]
    later = times.shift_hours(F.col("production_date"), 1)
    moved = trips.where(F.col("published_line_name") != "N/A").withColumn(
        "dest_name", F.concat("dest_name", F.lit(" 2"))
    )
    second = messages.trip_messages(moved.withColumn("production_date", later), stops)
    return _stream(
        spark,
        lambda folder: streams.upsert_batch(folder, buckets=2),
        [_messages(spark, sf_dir), second],
    )


def _stream_upsert_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserts.current_rows(spark, f"{_upserted(spark, sf_dir)}/trips").drop("day", "bucket")


def _stream_upsert_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserts.current_rows(spark, f"{_upserted(spark, sf_dir)}/stops").drop("day", "bucket")


def _stream_upsert_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and their days after messages that move them, newest first.

    An hour later a third of the trips leave forty days later, and a fifth of
    them have no readable departure; the messages from before arrive last.
    """
    tables = warehouse(spark, sf_dir)
    trips, stops = tables["dsa/trips"], tables["dsa/stops"].limit(0)
    number = F.substring("trip_id", 2, 20).cast("bigint")
    later = times.shift_hours(F.col("production_date"), 1)
    moved = (
        F.when(number % 5 == 0, F.lit("soon"))
        .when(number % 3 == 0, times.shift_hours(F.col("departure_time").cast("timestamp_ntz"), 24 * 40).cast("string"))
        .otherwise(F.col("departure_time"))
    )
    newer = trips.withColumn("production_date", later).withColumn("departure_time", moved)
    root = _stream(
        spark,
        lambda folder: streams.upsert_batch(folder, buckets=2),
        [messages.trip_messages(newer.where(number % 2 == 0), stops),
         messages.trip_messages(trips, stops),
         messages.trip_messages(newer.where(number % 2 == 1), stops)],
    )
    return upserts.current_rows(spark, f"{root}/trips").drop("bucket")


def _stream_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest stops as state of a stream: two hours later for some trips, then late messages.

    The second feed is the oldest one; the third, an hour newer, comes for every
    other trip, and changes nothing for those that had the newest message first.
    """
    tables = warehouse(spark, sf_dir)
    trips, stops = tables["dsa/trips"], tables["dsa/stops"]
    number = F.substring("trip_id", 2, 20).cast("bigint")

    def feed(hours: int, some) -> DataFrame:
        produced = times.shift_hours(F.col("production_date"), hours)
        named = F.concat("departure_platform_name", F.lit(f" {hours}"))
        own_stops = stops.where(some).withColumn("expected_arrival", named)
        own_trips = trips.where(some).withColumn("production_date", produced)
        return messages.trip_messages(own_trips, own_stops.withColumn("production_date", produced))

    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "state")
    checkpoint = scratch_path(spark, "checkpoint")
    for rows in (feed(2, number % 3 == 0), feed(0, number >= 0), feed(1, number % 2 == 0)):
        objects.land(rows, landing)
        changes = latest.newest_stops(streams.parsed_stream(streams.file_messages(spark, landing)))
        latest.drain_state(changes, latest.state_batch(path, streams.STOP_KEY, buckets=2), checkpoint)
    objects.clear(spark, landing)
    return upserts.current_rows(spark, path).select(
        "day", "trip_id", "stop_name", "expected_arrival", "production_date"
    )


# --- forecast --------------------------------------------------------------


def _forecast_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to predict, beside the trains of the same hour a week before."""
    past = _training_objects(spark, sf_dir)
    train, _ = forecast.split_by_time(forecast.unique_hours(past))
    until = train.agg(F.max("hour_start")).first()[0]
    grid = forecast.future_grid(warehouse(spark, sf_dir), until, AS_OF)
    week_ago = past.select(
        times.shift_hours(F.col("hour_start"), 24 * 7).alias("hour_start"),
        F.col("nb_trains_actifs").alias("nb_trains_j_7"),
    )
    return grid.join(week_ago, "hour_start", "left").withColumn(
        "nb_trains_j_7", F.coalesce("nb_trains_j_7", F.lit(0).cast("bigint"))
    )


def _train_volume_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load the latest model and predict the coming hours."""
    models = scratch_path(spark, "models")
    forecast.save(*forecast.fit(_training_objects(spark, sf_dir), AS_OF), models)
    tables = warehouse(spark, sf_dir)
    own = Tables(spark, scratch_path(spark, "forecast"))
    model, metadata = forecast.load_latest(spark, models)
    grid = forecast.future_grid(tables, metadata["trained_until"], AS_OF)
    own.reload(
        "forecast/fact_train_volume_forecast",
        forecast.predict(model, grid, metadata["model_name"]),
    )
    return own["forecast/fact_train_volume_forecast"]


def _forecast_by_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours to predict, and whether the forest's nodes give what its model predicts."""
    models, found_at = scratch_path(spark, "models"), scratch_path(spark, "predicted")
    model, metadata = forecast.fit(_training_objects(spark, sf_dir), AS_OF)
    forecast.save(model, metadata, models)
    stored = metadata.first()
    nodes = forest.read_nodes(spark, f"{models}/models/{stored['model_name']}")
    grid = forecast.future_grid(warehouse(spark, sf_dir), stored["trained_until"], AS_OF)
    grid.write.parquet(found_at)
    grid = spark.read.schema(grid.schema).parquet(found_at)
    by_nodes = forest.predictions(nodes, grid, "hour_start", forecast.FEATURES, forecast.DEPTH)
    by_model = forecast.raw_predictions(model, grid).withColumnRenamed("prediction", "expected")
    close = F.abs(F.col("prediction") - F.col("expected")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs("expected"))
    return by_model.join(by_nodes, "hour_start", "left").select(
        "hour_start", F.coalesce(close, F.lit(False)).alias("same_as_model")
    )


def _forecast_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be said of a forecast without knowing its numbers."""
    models, scored_at = scratch_path(spark, "models"), scratch_path(spark, "scored")
    past = _training_objects(spark, sf_dir)
    model, metadata = forecast.fit(past, AS_OF)
    forecast.save(model, metadata, models)
    model, stored = forecast.load_latest(spark, models)
    tables = Tables(spark, scratch_path(spark, "forecast"))
    tables.reload("dwh/d_date", warehouse(spark, sf_dir)["dwh/d_date"])
    forecast.refresh_forecast(tables, models, AS_OF)
    forecast.scored(model, past).write.parquet(scored_at)
    again = forecast.errors(spark.read.parquet(scored_at)).first()
    close = all(abs(again[m] - stored[m]) <= 1e-9 * max(1.0, abs(again[m])) for m in forecast.METRICS)
    labels = past.agg(F.min(forecast.LABEL).alias("lo"), F.max(forecast.LABEL).alias("hi")).first()
    predicted = F.col("predicted_nb_train")
    return tables["forecast/fact_train_volume_forecast"].agg(
        F.count(F.lit(1)).alias("nb_hours"),
        F.min("date").alias("first_hour"),
        F.max("date").alias("last_hour"),
        F.max("model_name").alias("model_name"),
        F.bool_and(predicted.between(labels["lo"], labels["hi"])).alias("in_label_range"),
        F.lit(close).alias("metrics_recomputed"),
        F.lit(stored["n_rows"]).cast("bigint").alias("n_rows"),
    )


def _events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event for each (user, type), as an upsert of time-ordered batches."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("user_id").cast("string").alias("trip_id"),
        F.col("event_type").alias("stop_name"),
        F.col("ts").alias("production_date"),
        F.col("value").alias("delay_seconds"),
        "event_id",
    )
    target = events.where(F.col("event_id") % 2 == 0)
    newer = events.where(F.col("event_id") % 2 == 1)
    order = [F.col("production_date"), F.col("event_id")]
    return merge.latest_wins(target, newer, ["trip_id", "stop_name"], order)


# --- dashboards with parameters ----------------------------------------------

REGION, DEPARTEMENT = "1", "02"
# a département with trains at ``AS_OF``, at any size
BOARD_PLACE = ("2", "12")
# upper case and accents that the stored name doesn't have
COMMUNE = "CÔMMUNÈ-7"
STATION = "Supplier 000000003"


def _station(tables: Tables) -> int:
    found = tables["dwh/d_station"].where(F.col("station_name") == STATION)
    return found.agg(F.coalesce(F.min("tk_station"), F.lit(0))).first()[0]


def _lines(tables: Tables, *names: str) -> list[int]:
    found = tables["dwh/d_line"].where(F.col("line_name").isin(*names)).select("tk_line")
    return [row[0] for row in found.collect()]  # as many as ``names`` at most


def _one_line(build, name: str) -> Query:
    return _on_tables(lambda w: build(w, AS_OF, (_lines(w, name) or [0])[0]))


def _parameterised() -> dict[str, Query]:
    t, every = _on_tables, dashboard.ALL
    some = LINES[:2]
    return {
        "line_volume_one": _one_line(dashboard.line_volume, LINES[0]),
        "line_rates_one": _one_line(dashboard.line_rates, LINES[1]),
        "line_radar_one": _one_line(dashboard.line_rates_today, LINES[2]),
        "lines_chart_some": t(lambda w: dashboard.lines_chart(w, AS_OF, _lines(w, *some))),
        "lines_table_some": t(lambda w: dashboard.lines_table(w, AS_OF, _lines(w, *some))),
        "departements_of_region": t(lambda w: dashboard.departements(w, REGION)),
        "departements_of_all": t(lambda w: dashboard.departements(w, every)),
        "communes_of_region": t(lambda w: dashboard.communes(w, REGION, every)),
        "communes_of_departement": t(lambda w: dashboard.communes(w, REGION, DEPARTEMENT)),
        "gares_of_commune": t(
            lambda w: dashboard.stations(w, every, every, COMMUNE).select("station_name_ref")
        ),
        "gares_all_of_departement": t(
            lambda w: dashboard.stations_or_all(w, every, DEPARTEMENT, every).select(
                "station_name_ref")
        ),
        "station_kpi_one": t(lambda w: dashboard.station_kpi(w, AS_OF, _station(w))),
        "station_kpi_every": t(lambda w: dashboard.station_kpi(w, AS_OF, every)),
        "station_flow_one": t(lambda w: dashboard.station_flow(w, AS_OF, _station(w))),
        "platform_one": t(lambda w: dashboard.platforms_today(w, AS_OF, _station(w))),
        "station_deltas_one": t(lambda w: dashboard.station_deltas(w, AS_OF, _station(w))),
        "board_of_region": t(lambda w: dashboard.departure_board(w, AS_OF, REGION, every, every)),
        "board_of_departement": t(
            lambda w: dashboard.departure_board(w, AS_OF, *BOARD_PLACE)
        ),
        "board_of_commune": t(lambda w: dashboard.departure_board(w, AS_OF, commune=COMMUNE)),
        "board_of_station": t(
            lambda w: dashboard.departure_board(w, AS_OF, station=_station(w))
        ),
    }


def queries() -> dict[str, Query]:
    t = _on_tables
    return _parameterised() | {
        # dimensions
        "d_date": t(_d_date),
        "d_time": t(_d_time),
        "public_holidays": _holidays,
        "d_vehicule": t(lambda w: w["dwh/d_vehicule"].drop("tk_vehicule")),
        "d_line": t(lambda w: w["dwh/d_line"].select("line_name")),
        "d_station": t(_d_station),
        # operational tables
        "ods_trips": t(lambda w: w["ods/trips"]),
        "ods_trips_window": t(_ods_window),
        "ods_vehicules": t(lambda w: w["ods/vehicules"]),
        "ods_stops": t(lambda w: w["ods/stops"]),
        "static_departements": _static_departements,
        "corrections_file": _corrections_file,
        "ods_stations": t(lambda w: w["ods/stations"].drop("idgaia")),
        # facts
        "f_trips": t(
            lambda w: _named(w, w["dwh/f_trips"], "stop", "origin", "destination")
        ),
        "f_journey": t(lambda w: _named(w, w["dwh/f_journey"], "origin", "destination")),
        "f_trips_realtime": t(
            lambda w: _named(w, w["dwh/f_trips_realtime"], "stop", "origin", "destination")
        ),
        "f_line_metrics": t(lambda w: _named(w, w["dwh/f_line_metrics"])),
        "f_station_platform_usage": t(
            lambda w: _named(
                w, w["dwh/f_station_platform_usage"].withColumnRenamed(
                    "station_tk", "stop_station_tk"), "stop")
        ),
        "f_station_daily_metrics": t(
            lambda w: _named(
                w, w["dwh/f_station_daily_metrics"].withColumnRenamed(
                    "station_tk", "stop_station_tk"), "stop")
        ),
        # load semantics
        "insert_if_absent": t(_insert_if_absent),
        "refresh_rolling": _refresh_rolling,
        "refresh_reused_ids": _refresh_reused_ids,
        "upsert_metrics": _upsert_metrics,
        "line_metrics_incremental": _line_metrics_incremental,
        "latest_wins_stops": t(_latest_stops),
        "latest_wins_merge": _events_latest,
        # KPI views
        "trains_actifs": t(lambda w: kpi.active_trains(w, AS_OF)),
        "trains_en_retard": t(lambda w: kpi.late_trains(w, AS_OF)),
        "retard_moyen": t(lambda w: kpi.mean_delay(w, AS_OF)),
        "gares_actives": t(lambda w: kpi.active_stations(w, AS_OF)),
        "taux_retard": t(kpi.late_rate),
        "trains_actifs_par_heure": t(lambda w: kpi.trains_per_hour(w, AS_OF)),
        "gares_plus_retard": t(lambda w: kpi.worst_stations(w, AS_OF).drop("tk_station")),
        "retard_par_type_train": t(lambda w: kpi.delay_by_train_type(w, AS_OF)),
        "retard_region": t(kpi.delay_by_region),
        "rattrapage_region": t(kpi.recovery_by_region),
        "retard_horaire": t(kpi.delay_by_hour),
        "retard_horaire_region": t(kpi.delay_by_hour_and_region),
        "station_kpi": t(lambda w: kpi.station_days(w).drop("station_tk")),
        "station_platforms": t(lambda w: kpi.platform_days(w).drop("tk_station")),
        "terminus_delay_minutes": t(kpi.terminus_delay_minutes),
        # dashboards
        "taux_retard_radar": t(lambda w: dashboard.late_share_today(w, AS_OF)),
        "punctuality_flag": t(lambda w: dashboard.punctuality_flag(w, AS_OF)),
        "evolution_par_heure": t(lambda w: dashboard.hours_with_forecast(w, AS_OF)),
        "minutes_retard": t(lambda w: dashboard.delay_minutes_two_days(w, AS_OF)),
        "minutes_retard_progress": t(lambda w: dashboard.delay_minutes_progress(w, AS_OF)),
        "retard_par_type_top6": t(lambda w: dashboard.train_types_top(w, AS_OF)),
        "retard_par_type_severity": t(lambda w: dashboard.train_type_severity(w, AS_OF)),
        "region_ranking": t(lambda w: dashboard.region_ranking(w, AS_OF)),
        "region_share": t(lambda w: dashboard.region_share(w, AS_OF)),
        "heatmap_pivot": t(dashboard.heat_map),
        "trains_actifs_progress": t(lambda w: dashboard.active_trains_progress(w, AS_OF)),
        "line_volume": t(lambda w: dashboard.line_volume(w, AS_OF)),
        "line_rates": t(lambda w: dashboard.line_rates(w, AS_OF)),
        "line_radar": t(lambda w: dashboard.line_rates_today(w, AS_OF)),
        "line_list": t(lambda w: dashboard.line_list(w).select("line_name")),
        "lines_chart": t(lambda w: dashboard.lines_chart(w, AS_OF)),
        "lines_table": t(lambda w: dashboard.lines_table(w, AS_OF)),
        "lines_pivot": t(lambda w: dashboard.lines_pivot(w, AS_OF, LINES)),
        "regions_list": t(dashboard.regions),
        "departements_list": t(dashboard.departements),
        "communes_list": t(dashboard.communes),
        "gares_list": t(lambda w: dashboard.stations(w).select("station_name_ref")),
        "gares_list_all": t(lambda w: dashboard.stations_or_all(w).select("station_name_ref")),
        "station_kpi_2d": t(lambda w: dashboard.station_kpi(w, AS_OF)),
        "station_flow": t(lambda w: dashboard.station_flow(w, AS_OF)),
        "platform_today": t(lambda w: dashboard.platforms_today(w, AS_OF)),
        "station_deltas": t(lambda w: dashboard.station_deltas(w, AS_OF)),
        "departure_board": t(lambda w: dashboard.departure_board(w, AS_OF)),
        # training set and forecast
        "hourly_training_set": t(
            lambda w: forecast.training_set(w, *forecast.yesterday_window(AS_OF))
        ),
        "recent_training_set": t(
            lambda w: forecast.training_set(w, *forecast.recent_window(AS_OF)).drop("date")
        ),
        "forecast_grid": _forecast_grid,
        "train_volume_forecast": _train_volume_forecast,
        "forecast_checks": _forecast_checks,
        "forecast_by_nodes": _forecast_by_nodes,
        "objects_matching": _objects_matching,
        "daily_objects": _daily_objects,
        # feeds and streams
        "siri_xml_trips": _xml_trips,
        "siri_xml_stops": _xml_stops,
        "trip_message_stops": _message_stops,
        "gtfs_stop_updates": t(_gtfs_updates),
        "stream_append_stops": _stream_append,
        "stream_append_trips": _stream_append_trips,
        "stream_compacted_stops": _stream_compacted,
        "stream_rejects": _stream_rejects,
        "stream_upsert_trips": _stream_upsert_trips,
        "stream_upsert_stops": _stream_upsert_stops,
        "stream_upsert_moved": _stream_upsert_moved,
        "stream_latest_state": _stream_latest_state,
        "stream_redelivered_stops": _stream_redelivered,
        "stream_gtfs_updates": _stream_gtfs,
        "stream_gtfs_rejects": _stream_gtfs_rejects,
    }
