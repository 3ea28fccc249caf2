"""A third of all rows on one order, one supplier and one customer."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from oracle import SQL
from test_queries import SF_DIR, TABLES, rows_of

# departs within the half hour of the board and runs now
HOT_ORDER = 20


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skew"))
    hot = {"lineitem": ("l_partkey", {"l_orderkey": HOT_ORDER}),
           "orders": ("o_orderkey", {"o_custkey": 50}),
           "events": ("event_id", {"user_id": 1})}
    for name in TABLES:
        rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        if name in hot:
            by, changes = hot[name]
            for column, value in changes.items():
                moved = F.when(F.col(by) % 3 == 0, F.lit(value).cast("bigint"))
                rows = rows.withColumn(column, F.coalesce(moved, F.col(column)))
        if name == "lineitem":
            third = F.when(F.col("l_linenumber") % 3 == 1, F.lit(3).cast("bigint"))
            rows = rows.withColumn("l_suppkey", F.coalesce(third, F.col("l_suppkey")))
        rows.toPandas().to_parquet(f"{folder}/{name}.parquet", coerce_timestamps="us")
    return folder


QUERIES = (
    "ods_stops", "f_trips", "f_trips_realtime", "f_line_metrics", "f_station_daily_metrics",
    "insert_if_absent", "latest_wins_merge", "retard_region", "rattrapage_region",
    "retard_horaire", "trains_actifs_par_heure", "departure_board", "retard_par_type_train",
    "trip_message_stops", "stream_append_stops", "stream_rejects",
)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_query_equals_sql(spark, skewed, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{skewed}/{table}.parquet'")
    result, expected = entry_module.queries()[name](spark, skewed), duck.sql(SQL[name])
    assert rows_of(result.columns, result.collect()) == rows_of(
        expected.columns, expected.fetchall()
    )
