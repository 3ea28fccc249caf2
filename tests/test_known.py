"""Keys of a whole history behind Bloom filters: exact, and never forgotten."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conftest import frame, stop, trip, values
from quaywise import session
from quaywise.operators import known
from quaywise.plans import ods, refresh
from quaywise.sources.tables import Tables

KEY = StructType([StructField("trip_id", StringType()), StructField("stop_name", StringType())])
DAY = date(2024, 1, 1)


def keys(spark, first, last, tail="x"):
    return spark.range(first, last).select(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("t"), "id")).alias("trip_id"),
        F.concat(F.lit(tail), (F.col("id") / 7).cast("long").cast("string")).alias("stop_name"),
        F.col("id").alias("n"),
    )


@pytest.fixture(autouse=True)
def few_shards(monkeypatch):
    monkeypatch.setattr(known, "SHARDS", 3)


@pytest.fixture
def held(spark, folder):
    return known.KnownKeys(spark, folder("keys"), KEY)


def test_absent_is_exact(spark, held):
    given = keys(spark, 0, 20_000)
    assert held.absent(given).count() == 20_000 and held.through is None
    held.add(keys(spark, 0, 8_000), DAY)
    held.add(keys(spark, 5_000, 12_000), DAY + timedelta(days=1))
    again = known.KnownKeys(spark, held.root, KEY)  # nothing is held in memory
    assert values(again.absent(given), "n") == sorted([(n,) for n in range(12_000, 20_000)], key=str)
    assert again.through == DAY + timedelta(days=1)
    assert again.absent(given.limit(0)).count() == 0


def test_several_rows_of_a_key_stay_together(spark, held):
    held.add(keys(spark, 0, 10), DAY)
    twice = keys(spark, 5, 15).unionByName(keys(spark, 5, 15))
    assert held.absent(twice).count() == 10


def test_filters_let_few_new_keys_pass(spark, held):
    held.add(keys(spark, 0, 100_000), DAY)
    asked = known.placed(keys(spark, 100_000, 200_000).select(*KEY.fieldNames()), KEY.fieldNames(), held._state()[1])
    passing = asked.join(held._filters(), ["shard", "bucket"]).where(
        F.forall("probes", lambda p: known.bit(F.col("bits"), p))
    )
    assert passing.count() < 2_000


def test_more_keys_make_more_buckets(spark, held, monkeypatch):
    monkeypatch.setattr(known, "KEYS_OF_A_FILTER", 20)
    sizes = []
    for k in range(3):
        held.add(keys(spark, k * 2_000, k * 2_000 + 2_000), DAY + timedelta(days=k))
        sizes.append(held._state()[1])
    assert sizes == sorted(sizes) and sizes[-1] > sizes[0]
    assert held.absent(keys(spark, 0, 8_000)).count() == 2_000


def test_only_shards_in_question_are_opened(spark, held):
    held.add(keys(spark, 0, 5_000), DAY)
    held.absent(keys(spark, 3, 4).unionByName(keys(spark, 90_000, 90_003)))
    maybe = spark.read.parquet(f"{held.root}/maybe")
    assert maybe.where("trip_id = 't3'").count() == 1 and maybe.count() <= 3


def test_forgotten_keys_come_back_with_the_next_load(spark, held):
    held.add(keys(spark, 0, 100), DAY)
    held.forget()
    assert held.through is None
    held.add(keys(spark, 50, 150), DAY)
    assert held.absent(keys(spark, 0, 200)).count() == 100


@pytest.mark.parametrize("at", ["filters_some", "state"])
def test_a_load_that_is_cut_short_is_finished(spark, held, monkeypatch, at):
    held.add(keys(spark, 0, 100), DAY)
    finish = session.finish_replacing

    def stop(*_):
        raise OSError("stopped")

    def finish_or_stop(spark, path, write):
        finish(spark, path, stop if path.endswith(at) else write)

    with monkeypatch.context() as m:
        m.setattr(session, "finish_replacing", finish_or_stop)
        with pytest.raises(OSError):
            held.add(keys(spark, 100, 200), DAY + timedelta(days=1))
    held.add(keys(spark, 100, 200), DAY + timedelta(days=1))
    assert held.absent(keys(spark, 0, 250)).count() == 50


def test_bits(spark):
    rows = spark.range(1).select(F.unhex(F.lit("0180ff00")).alias("b"))
    found = rows.select(*(known.bit(F.col("b"), F.lit(k)).alias(str(k)) for k in range(32))).first()
    assert [k for k in range(32) if found[k]] == [0, 15, *range(16, 24)]


def test_ids_that_come_back_add_nothing(spark, folder):
    """A feed uses its trip ids again after 30 and 60 days, with some new stop names."""
    now = datetime(2024, 3, 20, 12)
    tables, days = Tables(spark, folder("tables")), [now - timedelta(days=n) for n in (60, 30, 0)]
    for when in days:
        trips = [trip(f"t{k}", str(when), "x", production_date=when) for k in range(50)]
        names = ("same", f"every second month {when.month % 2}")
        stops = [stop(t["trip_id"], i, name) for t in trips for i, name in enumerate(names)]
        refresh.load_staging(tables, frame(spark, "dsa/trips", trips), frame(spark, "dsa/stops", stops))
        refresh.refresh_ods(tables, refresh.Window.rolling(when))
    stored = tables["ods/stops"]
    assert values(stored.groupBy("stop_name", "ref_date").count()) == [
        ("every second month 0", days[1].date(), 50), ("every second month 1", days[0].date(), 50),
        ("same", days[0].date(), 50),
    ]
    # the same by comparing with all days
    directly = ods.new_stops(tables["dsa/stops"], tables["ods/trips"], stored, now.date())
    assert directly.count() == 0


def test_filters_are_made_by_as_many_tasks_as_there_are_keys_for(spark):
    """A task sorts the bits of a bounded number of keys, however few files they are in."""
    made = known.filters(keys(spark, 0, 2000).coalesce(1), KEY.fieldNames(), 256)
    assert made.rdd.getNumPartitions() == 4
    assert made.select("shard", "bucket").distinct().count() == made.count()
