"""Newest message of each key as state of a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import values
from quaywise.operators.merge import latest_wins
from quaywise.sources.messages import message_day, message_stops, message_trips, parse_messages
from quaywise.streaming import latest, upserts
from quaywise.streaming import trips as streams


def feed(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        trip = f"t{rng.randrange(25)}"
        day = rng.choice(["2024-01-10 10:00:00", "2025-06-01 09:00:00", "soon"])
        stops = [
            {"trip_id": trip, "stop_name": f"s{k}", "expected_arrival": rng.choice("abc"),
             "production_date": f"2024-01-0{rng.randrange(1, 9)} 00:00:00"}
            for k in range(rng.randrange(4))
        ]
        out.append(json.dumps({
            "trip_id": trip, "dest_name": rng.choice("xyz"), "departure_time": day, "stops": stops,
            "production_date": f"2024-01-0{rng.randrange(1, 9)} 00:00:00",
        }))
    return out + ["{broken"]


@pytest.mark.parametrize("batches", [3])
def test_state_equals_latest_wins(spark, folder, batches):
    lines = feed(batches)
    landing, path, checkpoint = folder("in"), folder("table"), folder("state")
    for k in range(batches):
        part = spark.createDataFrame([(x,) for x in lines[k::batches]], "value string")
        part.write.mode("append").text(landing)
        changes = latest.newest_stops(streams.parsed_stream(streams.file_messages(spark, landing)))
        latest.drain_state(changes, latest.state_batch(path, ["trip_id", "stop_name"], 2), checkpoint)
    found = upserts.current_rows(spark, path)
    given = message_stops(parse_messages(spark.createDataFrame([(x,) for x in lines], "value string")), message_day())
    rest = [c for c in given.columns if c not in ("day", "trip_id", "stop_name", "production_date")] + ["day"]
    order = [F.col("production_date"), *(F.col(c) for c in rest)]
    expected = latest_wins(given.limit(0), given, ["trip_id", "stop_name"], order)
    columns = ("trip_id", "stop_name", "production_date", "day", "expected_arrival")
    assert values(found, *columns) == values(expected, *columns)


def test_a_batch_hands_on_its_own_keys(spark, folder):
    """Late messages of a key come with the newest row, other keys not at all."""
    landing, checkpoint, seen = folder("in"), folder("state"), []

    def send(*given):
        rows = [(json.dumps({"trip_id": t, "dest_name": d, "production_date": p}),) for t, d, p in given]
        spark.createDataFrame(rows, "value string").write.mode("append").text(landing)
        changes = latest.newest_trips(streams.parsed_stream(streams.file_messages(spark, landing)))
        latest.drain_state(changes, lambda b, _: seen.append(values(b, "trip_id", "dest_name")), checkpoint)

    send(("a", "first", "2"), ("b", "first", "2"), ("c", "first", "2"))
    send(("a", "second", "3"))
    send(("a", "late", "1"), ("b", "late", "1"), ("b", "newer", "3"))
    changed = [rows for rows in seen if rows]
    assert changed == [
        [("a", "first"), ("b", "first"), ("c", "first")], [("a", "second")], [("a", "second"), ("b", "newer")]
    ]


def test_the_session_keeps_its_own_provider(spark):
    before = spark.conf.get(latest.PROVIDER)
    with latest.state_on_disk(spark):
        assert spark.conf.get(latest.PROVIDER) == latest.ROCKSDB
    assert spark.conf.get(latest.PROVIDER) == before


def test_state_has_a_part_for_the_rows_of_a_task(spark):
    shuffles, at_first = latest._SHUFFLES, latest._AT_FIRST
    before = spark.conf.get(shuffles), spark.conf.get(at_first, None)
    try:
        spark.conf.set(at_first, "77")
        with latest.state_on_disk(spark):
            assert spark.conf.get(shuffles) == "77"
            # a write of a key does not read it first
            assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
        assert spark.conf.get(shuffles) == before[0]
    finally:
        spark.conf.unset(at_first) if before[1] is None else spark.conf.set(at_first, before[1])


def test_newest_of_a_table(spark):
    rows = spark.createDataFrame(
        [("a", None, "x"), ("a", "1", "y"), ("a", "1", "z"), ("b", None, None)], "k string, production_date string, v string"
    )
    assert values(latest.newest(rows, ["k"]), "k", "production_date", "v") == [("a", "1", "z"), ("b", None, None)]
    assert values(message_trips(parse_messages(rows.select(F.lit("{}").alias("value"))))) == []
