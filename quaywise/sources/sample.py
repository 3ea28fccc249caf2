"""A feed made from the order tables, so that every job can run on them.

An order is a trip, its line items are the stops, suppliers are stations and
nations are départements. Dates are folded onto the ten days up to ``AS_OF``.
The whole tables take part; nothing is filtered.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.functions import times
from quaywise.operators import parts
from quaywise.sources import objects
from quaywise.sources.referentials import typed_stations
from quaywise.sources.siri import ROW_TAG

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
PRODUCED = AS_OF - timedelta(hours=1)
#: Calls of one journey element, about.
ELEMENT_CALLS = 1000

# Train family for each market segment.
FAMILIES = {
    "AUTOMOBILE": "RER A",
    "BUILDING": "TRAIN TER_NORD",
    "FURNITURE": "TRAIN SPECIAL",
    "HOUSEHOLD": "TRAIN",
    "MACHINERY": "INTER_CITES",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _stop_name(column: str) -> Column:
    return F.replace(F.col(column), F.lit("#"), F.lit(" "))


def _text(ts: Column) -> Column:
    return ts.cast("string")


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in the order of ``call_index``: by line number, and for equal
    ones by a number mixed from the other columns."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    quantity = F.col("l_quantity").cast("int")
    mixed = F.col("l_partkey") * 1_000_003 + F.col("l_suppkey") * 10_007 + cents * 31 + quantity
    index = F.col("l_linenumber").cast("bigint") * 10**15 + mixed % 10**15
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        quantity.alias("quantity"),
        "l_returnflag",
        "l_linestatus",
        index.alias("call_index"),
    )


def _journeys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order, with its first and last call where it has any."""
    orders = _table(spark, sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    ends = (
        _calls(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(
            F.min("call_index").alias("first_call"),
            F.max("call_index").alias("last_call"),
            F.min_by("l_suppkey", "call_index").alias("first_station"),
            F.max_by("l_suppkey", "call_index").alias("last_station"),
            F.max("l_linenumber").alias("last_line"),
        )
    )
    today = AS_OF.date()
    ref_date = F.date_sub(times.day(today), (F.col("o_orderkey") % 10).cast("int"))
    return (
        orders.select("o_orderkey", "o_custkey", "o_orderpriority")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(ends.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn(
            "departure",
            times.shift_minutes(
                ref_date.cast("timestamp_ntz"), F.col("o_orderkey") * 37 % 1440
            ),
        )
    )


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = _table(spark, sf_dir, "supplier")
    origin = stations.select(
        F.col("s_suppkey").alias("origin_key"), _stop_name("s_name").alias("origin")
    )
    dest = stations.select(
        F.col("s_suppkey").alias("dest_key"), _stop_name("s_name").alias("dest")
    )
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    family = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])
    arrival = times.shift_minutes(
        F.col("departure"), F.coalesce(F.col("last_line"), F.lit(0)) * 20
    )
    return (
        _journeys(spark, sf_dir)
        .join(origin, F.col("first_station") == F.col("origin_key"), "left")
        .join(dest, F.col("last_station") == F.col("dest_key"), "left")
        .select(
            F.concat(F.lit("T"), key.cast("string")).alias("trip_id"),
            F.when(F.col("o_custkey") % 50 == 0, "N/A")
            .otherwise((F.col("o_custkey") * 7919 % 900000).cast("string"))
            .alias("train"),
            F.coalesce("origin", F.lit("N/A")).alias("origin_name"),
            _text(F.col("departure")).alias("departure_time"),
            F.coalesce("dest", F.lit("N/A")).alias("dest_name"),
            _text(arrival).alias("arrival_time"),
            F.concat(F.lit("MODE::"), family[F.col("c_mktsegment")]).alias("vehicule_category"),
            F.lit("RAIL").alias("vehicule_mode"),
            F.when(key % 7 == 0, "N/A")
            .when(key % 3 == 0, F.upper(F.replace(priority, F.lit("-"), F.lit(" "))))
            .otherwise(F.replace(priority, F.lit("-"), F.lit("")))
            .alias("published_line_name"),
            times.ntz(PRODUCED).alias("production_date"),
        )
    )


def staged_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("station_key"), _stop_name("s_name").alias("stop_name")
    )
    journeys = _journeys(spark, sf_dir).select(
        "o_orderkey", "departure", "first_call", "last_call"
    )
    # lateness of the call in seconds, from 2.5 minutes early to 9.5 late
    late = (F.col("quantity") % 25 - 5) * 30
    minutes = F.col("l_linenumber") * 20
    first = F.col("call_index") == F.col("first_call")
    last = F.col("call_index") == F.col("last_call")

    def at(offset_minutes: Column, lateness: Column | None, missing: Column) -> Column:
        ts = times.shift_minutes(F.col("departure"), offset_minutes)
        if lateness is not None:
            ts = times.shift_seconds(ts, lateness)
        return F.when(missing, "").otherwise(_text(ts))

    return (
        _calls(spark, sf_dir)
        .join(journeys.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(stations, F.col("l_suppkey") == F.col("station_key"))
        .select(
            F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("trip_id"),
            "call_index",
            "stop_name",
            at(minutes, None, first).alias("aimed_arrival"),
            at(minutes, late, first).alias("expected_arrival"),
            at(minutes + 2, None, last).alias("aimed_departure"),
            at(minutes + 2, late, last).alias("expected_departure"),
            first.cast("bigint").alias("is_starting_point"),
            last.cast("bigint").alias("is_terminus"),
            F.col("l_linestatus").alias("departure_platform_name"),
            F.when(F.col("l_linenumber") % 4 == 0, "")
            .otherwise(F.col("l_returnflag"))
            .alias("arrival_platform_name"),
            times.ntz(PRODUCED).alias("production_date"),
        )
    )


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def departements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The départements that have a station."""
    served = _table(spark, sf_dir, "supplier").select("s_nationkey").distinct()
    return (
        _nation_names(spark, sf_dir)
        .join(served, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")
        .select(
            F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code_departement"),
            F.concat(F.lit("Dépt-"), F.col("n_name")).alias("nom_departement"),
            F.col("n_regionkey").cast("string").alias("code_region"),
            F.col("r_name").alias("nom_region"),
        )
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth station has a second row; département spellings differ."""
    key = F.col("s_suppkey")
    rows = (
        _table(spark, sf_dir, "supplier")
        .join(_nation_names(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn(
            "code_ligne",
            F.explode(
                F.when(key % 4 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(
                    F.array(F.lit("A"))
                )
            ),
        )
        .select(
            F.concat(F.lit("U"), F.lpad(key.cast("string"), 7, "0")).alias("code_uic"),
            F.when(key % 5 == 0, F.concat(F.lit("Ref-"), key.cast("string")))
            .otherwise(F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))))
            .alias("libelle"),
            F.when(key % 3 == 0, "O").otherwise("N").alias("fret"),
            F.lit("O").alias("voyageurs"),
            "code_ligne",
            F.lit(1).alias("rg_troncon"),
            F.concat(F.lit("PK "), (key % 100).cast("string")).alias("pk"),
            F.concat(F.lit("Commune-"), (key % 40).cast("string")).alias("commune"),
            F.concat(F.when(key % 2 == 0, "DEPT-").otherwise("Dépt-"), F.col("n_name")).alias(
                "departemen"
            ),
            (key % 1000).alias("idreseau"),
            F.lit(None).cast("string").alias("idgaia"),
            (key % 1000).alias("x_l93"),
            (key % 500).alias("y_l93"),
            (key % 90).alias("x_wgs84"),
            (key % 45).alias("y_wgs84"),
        )
    )
    return typed_stations(rows)


def name_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return (
        _table(spark, sf_dir, "supplier")
        .where((key % 5 == 0) & (key % 10 != 0))
        .select(
            _stop_name("s_name").alias("station_name"),
            F.concat(F.lit("Ref-"), key.cast("string")).alias("ref_name"),
            F.lit(False).alias("is_foreign"),
        )
    )


def journeys(trips: DataFrame, stops: DataFrame, element_calls: int = ELEMENT_CALLS) -> DataFrame:
    """Staged rows in the shape of the feed: one row for each journey element.

    A journey with more than ``element_calls`` calls is several elements of one
    reference, whose calls name their order.
    """

    def filled(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(""))

    found = parts.sizes(stops, ["trip_id"], element_calls, F.min("call_index").alias("first_call"))
    order = F.when(F.col("call_index") == F.col("first_call"), 1).otherwise(F.col("call_index") + 1)
    call = F.struct(
        "call_index",
        F.struct(
            filled("stop_name").alias("StopPointName"),
            F.when(F.col("parts") > 1, order).alias("Order"),
            filled("aimed_arrival").alias("AimedArrivalTime"),
            filled("expected_arrival").alias("ExpectedArrivalTime"),
            filled("aimed_departure").alias("AimedDepartureTime"),
            filled("expected_departure").alias("ExpectedDepartureTime"),
            filled("departure_platform_name").alias("DeparturePlatformName"),
            filled("arrival_platform_name").alias("ArrivalPlatformName"),
        ).alias("call"),
    )
    calls = (
        parts.dealt(stops, found, ["trip_id"], ["call_index", "stop_name"])
        .groupBy("trip_id", "part").agg(F.array_sort(F.collect_list(call)).alias("calls"))
    )
    elements = parts.numbered(trips, found, ["trip_id"])
    return parts.beside(elements, calls.hint("merge"), ["trip_id"]).select(
        F.struct(F.col("trip_id").alias("DatedVehicleJourneyRef")).alias(
            "FramedVehicleJourneyRef"
        ),
        F.struct(F.col("train").alias("TrainNumberRef")).alias("TrainNumbers"),
        F.col("origin_name").alias("OriginName"),
        F.col("departure_time").alias("OriginAimedDepartureTime"),
        F.col("dest_name").alias("DestinationName"),
        F.col("arrival_time").alias("DestinationAimedArrivalTime"),
        F.col("vehicule_category").alias("ProductCategoryRef"),
        F.col("vehicule_mode").alias("VehicleMode"),
        F.col("published_line_name").alias("PublishedLineName"),
        F.struct(F.transform("calls", lambda c: c["call"]).alias("RecordedCall")).alias(
            "RecordedCalls"
        ),
    )


def write_journeys(rows: DataFrame, path: str) -> None:
    """XML files, each a document of its own below one root element.

    Compressed: tags and times repeat, plain files take many times the disk. A
    file is not split then, so its number of elements is bounded.
    """
    (
        rows.write.format("xml").option("rowTag", ROW_TAG)
        .option("rootTag", "EstimatedJourneyVersionFrame")
        .option("compression", "gzip").option("maxRecordsPerFile", objects.FILE_ROWS)
        .save(path)
    )


def forecast(ods_trips: DataFrame) -> DataFrame:
    """A stand-in forecast for the two days around ``AS_OF``: departures by hour."""
    start = times.hour_floor(F.col("departure_time"))
    return (
        ods_trips.where(F.col("ref_date") >= times.day(AS_OF.date() - timedelta(days=1)))
        .groupBy(start.alias("date"))
        .agg(F.count(F.lit(1)).cast("int").alias("predicted_nb_train"))
        .withColumn("model_name", F.lit("departures"))
    )
