"""The newest message of every key as state of a stream.

State is one row for each key. A micro-batch shuffles its own rows, combined
before the shuffle, and hands on the keys that got a message, with the newest
row each has had so far: late messages change nothing, however late they are.
State stays on the executors' disks (RocksDB), so it may be larger than memory.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaywise.sources.messages import message_day, message_stops, message_trips
from quaywise.streaming.upserts import BUCKETS, upsert

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: State on disk. Counting its rows, for a metric, would read every key once more when it is written.
ON_DISK = {PROVIDER: ROCKSDB, "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
_SHUFFLES = "spark.sql.shuffle.partitions"
_AT_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def newest(rows: DataFrame, key: Sequence[str], version: str = "production_date") -> DataFrame:
    """The newest row of each key, for a stream in update mode or a table.

    Of equal versions the row with the greatest other columns counts; null
    versions are the oldest. The result does not depend on the order of rows.
    """
    # the order of upserts, so that both choose the same row
    rest = [c for c in rows.columns if c not in (*key, version, "day")]
    rest += ["day"] if "day" in rows.columns else []
    one = F.max(F.struct(version, *rest)).alias("newest")
    return rows.groupBy(*key).agg(one).select(*key, f"newest.{version}", *(f"newest.{c}" for c in rest))


def newest_stops(parsed: DataFrame) -> DataFrame:
    return newest(message_stops(parsed, message_day()), ["trip_id", "stop_name"])


def newest_trips(parsed: DataFrame) -> DataFrame:
    return newest(message_trips(parsed, message_day()), ["trip_id"])


def state_batch(path: str, key: Sequence[str], buckets: int = BUCKETS):
    """Sink of the update mode: keys that changed replace their stored rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch.sparkSession, path, batch, key, buckets, one_for_each_key=True)

    return write


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB.

    A state that begins is dealt into as many parts as shuffles of the session
    begin with, so that a task sorts and holds a bounded share of the keys; a
    state that is there keeps its parts.
    """
    parts = max(int(spark.conf.get(_SHUFFLES)), int(spark.conf.get(_AT_FIRST, None) or 0))
    settings = {**ON_DISK, _SHUFFLES: str(parts)}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def drain_state(changes: DataFrame, sink, checkpoint: str) -> None:
    """Process what is there and stop; state and offsets stay in ``checkpoint``."""
    with state_on_disk(changes.sparkSession):
        query = (
            changes.writeStream.outputMode("update").foreachBatch(sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
