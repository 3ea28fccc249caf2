import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from quaywise import session
from quaywise.operators.hours import hour_spine, spread_hours
from quaywise.operators.merge import latest_wins, pick_one, rows_to_insert
from quaywise.operators.previous import with_previous


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_pick_one_limits_groups_before_the_shuffle(spark):
    rows = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    picked = pick_one(rows, ["k"], [F.desc("id")])
    assert values(picked) == [(0, 99), (1, 97), (2, 98)]
    before_shuffle = plan(picked).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_insert_adds_only_new_keys_once(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    source = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    assert values(rows_to_insert(target, source, ["k"], [F.col("v")])) == [(2, "a")]


def test_latest_wins_and_replays_change_nothing(spark):
    schema = "k int, t int, v string"
    target = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, 5, "c")], schema)
    source = spark.createDataFrame([(1, 6, "n"), (2, 4, "n"), (3, 5, "n"), (4, 1, "n")], schema)
    merged = latest_wins(target, source, ["k"], [F.col("t")])
    assert values(merged) == [(1, 6, "n"), (2, 5, "b"), (3, 5, "n"), (4, 1, "n")]
    assert values(latest_wins(merged, source, ["k"], [F.col("t")])) == values(merged)


def brute_previous(rows):
    """(id, previous delay) by sorting each group in Python."""
    out, groups = {}, {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for group in groups.values():
        ordered = sorted(group, key=lambda r: (r[2] is None, r[2] or 0, r[3]))
        for before, row in zip([None, *ordered], ordered):
            out[row[0]] = before[4] if before else None
    return out


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_previous_of_a_group_that_holds_most_rows(spark, width):
    draw = random.Random(7)
    rows = []
    for i in range(3000):
        trip = "hot" if i % 3 else f"t{i % 40}"
        moment = None if draw.random() < 0.4 else draw.randrange(50)
        delay = None if draw.random() < 0.1 else draw.randrange(20)
        rows.append((i, trip, moment, i, delay))
    frame = spark.createDataFrame(rows, "id int, trip string, t bigint, s bigint, delay int")
    span = F.coalesce(F.floor(F.col("t") / width), F.lit(10**12))
    order = [F.col("t").isNull(), F.col("t"), F.col("s")]
    result = with_previous(frame, "trip", order, span, "delay", "before")
    assert {r["id"]: r["before"] for r in result.collect()} == brute_previous(rows)
    assert result.columns == [*frame.columns, "before"]


def test_times_of_one_second_with_falling_keys(spark):
    """What leads the order decides, down to its microseconds, and the cut follows it."""
    rows = [(i, "x", 20_000 * i, 40 - i, i) for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, trip string, t bigint, s bigint, delay int")
    for second in (1, 60):
        span = F.floor(F.col("t") / (second * 1_000_000))
        result = with_previous(frame, "trip", [F.col("t"), F.col("s")], span, "delay", "before")
        assert {r["id"]: r["before"] for r in result.collect()} == brute_previous(rows)


def test_a_large_group_is_many_window_groups(spark):
    frame = spark.range(20_000).select(
        F.lit("x").alias("trip"), F.col("id").alias("t"), F.col("id").alias("delay")
    )
    result = with_previous(frame, "trip", [F.col("t")], F.floor(F.col("t") / 60), "delay", "before")
    assert "_span" in plan(result) and result.where("before = delay - 1").count() == 19_999


def test_hours_touched_by_an_event(spark):
    events = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 11)),
         ("b", datetime(2023, 1, 1), datetime(2025, 1, 1)),
         ("c", datetime(2024, 1, 1, 11), datetime(2024, 1, 1, 9)),
         ("d", None, datetime(2024, 1, 1, 9))],
        "id string, s timestamp_ntz, e timestamp_ntz",
    )
    first, last = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 12)
    found = spread_hours(events, F.col("s"), F.col("e"), first, last)
    hours = values(found.select("id", F.hour("hour_start")))
    assert sorted(hours) == [("a", h) for h in (9, 10, 11)] + [("b", h) for h in range(8, 13)]
    assert hour_spine(spark, first, last).count() == 5


def test_shuffles_have_more_partitions_for_more_rows(spark):
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(name, None) for name in names]
    try:
        session.bound_tasks(spark, 1000)
        assert spark.conf.get(names[0]) == spark.conf.get("spark.sql.shuffle.partitions")
        session.bound_tasks(spark, 10 * session.TASK_ROWS + 1)
        session.bound_tasks(spark, 1000)
        assert (spark.conf.get(names[0]), spark.conf.get(names[1])) == ("11", f"{session.TASK_BYTES}b")
        spark.conf.set(names[1], "8m")
        session.bound_tasks(spark, 1000)
        assert spark.conf.get(names[1]) == "8m"
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_shuffle_files_go_with_the_step_that_made_them(spark, folder):
    """In a session that was built without the settings of this package."""
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec")
    before = {name: spark.conf.get(name) for name in names}
    for name, plain in zip(names, ("false", "snappy"), strict=True):
        spark.conf.set(name, plain)
    stored = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum("shuffle_" in str(file) for file in stored.getAllFiles().mkString("\n").split("\n"))

    try:
        session.bound_tasks(spark, 1000)
        found = shuffled()
        rows = spark.range(1000).groupBy((F.col("id") % 100).alias("k")).agg(F.max("id").alias("id"))
        rows.write.parquet(folder("rows"))
        deadline = time.time() + 20
        while shuffled() > found and time.time() < deadline:
            time.sleep(0.2)
        assert shuffled() <= found
        # a frame that is asked again makes them again
        assert len(rows.collect()) == len(rows.collect()) == 100
        assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_tables_without_days_are_written_without_a_shuffle(spark, tables):
    """Tasks that make the rows have the size of files already."""
    stops = tables["dsa/stops"]
    plan = tables._shaped("dsa/stops", stops)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" not in plan
    days = tables._shaped("ods/stops", tables["ods/stops"])
    assert "RebalancePartitions" in days._jdf.queryExecution().analyzed().toString()
