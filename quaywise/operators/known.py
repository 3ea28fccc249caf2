"""Keys seen before, over a whole history, without opening its days.

A stored set of keys lies in shards by a hash of the key. Beside it stands a
Bloom filter for each of many small buckets: 32 768 bits, of which a key sets
seven. A key that its bucket's filter does not hold is new for certain; only
the others are looked up in the shards they belong to. So the answer is exact,
no key is ever forgotten, and a load of new keys reads filters of its own
buckets and almost no keys.

The number of buckets follows the number of keys: the filters are made anew
with more of them when they hold more than they are good for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quaywise.operators.merge import matching
from quaywise.session import TASK_ROWS, finish_replacing, read_or_none, replace_rows

#: Bits of a filter: the size of Spark's bitmaps.
BITS = 1 << 15
PROBES = 7
#: Keys of a filter beyond which it would let more than about one in a hundred pass.
KEYS_OF_A_FILTER = 3000
SHARDS = 64

STATE = "through date, buckets long, n long"
FILTERS = "shard int, bucket long, bits binary"


class KnownKeys:
    """The keys of all days up to one, below a folder of its own.

    One writer at a time. What a step that was cut short has left is finished
    or written again by the next one: filters and keys are sets.
    """

    def __init__(self, spark: SparkSession, root: str, key: StructType):
        self.spark, self.root, self.key = spark, root, key
        self.names = key.fieldNames()
        self.stored_schema = StructType([*key.fields, StructField("shard", IntegerType())])

    # --- reading -------------------------------------------------------------

    def _state(self) -> tuple[date | None, int, int]:
        self._finish()
        stored = read_or_none(self.spark, f"{self.root}/state", STATE)
        row = None if stored is None else stored.first()
        return (row["through"], row["buckets"], row["n"]) if row else (None, 0, 0)

    @property
    def through(self) -> date | None:
        """The last day whose keys are held; None before the first load."""
        return self._state()[0]

    def _keys(self) -> DataFrame:
        stored = read_or_none(self.spark, f"{self.root}/keys", self.stored_schema)
        return self.spark.createDataFrame([], self.stored_schema) if stored is None else stored

    def _filters(self) -> DataFrame:
        stored = read_or_none(self.spark, f"{self.root}/filters", FILTERS)
        return self.spark.createDataFrame([], FILTERS) if stored is None else stored

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not held; several rows of one key all stay.

        ``rows`` are written once and read twice: for their keys, and for what
        is left.
        """
        _, buckets, _ = self._state()
        if not buckets:
            return rows
        arrived = f"{self.root}/arrived"
        rows.write.mode("overwrite").parquet(arrived)
        given = self.spark.read.schema(rows.schema).parquet(arrived)
        asked = placed(given.select(*self.names).distinct(), self.names, buckets)
        passing = (
            asked.join(self._filters(), ["shard", "bucket"])
            .where(F.forall("probes", lambda p: bit(F.col("bits"), p)))
            .select("shard", *self.names)
        )
        maybe = f"{self.root}/maybe"
        passing.write.mode("overwrite").parquet(maybe)
        passing = self.spark.read.schema(self.stored_schema).parquet(maybe)
        # a row for each shard at most; others are not opened
        shards = F.broadcast(passing.select("shard").distinct())
        held = self._keys().join(shards, "shard", "left_semi").select(*self.names)
        found = matching(passing.select(*self.names), held, self.names, "left_semi")
        return matching(given, found, self.names, "left_anti")

    # --- writing -------------------------------------------------------------

    def add(self, rows: DataFrame, through: date) -> None:
        """Hold the keys of ``rows`` too, and note the day they reach to."""
        _, buckets, n = self._state()
        arrived = f"{self.root}/arrived"
        shard = shard_of(self.names)
        rows.select(*self.names).distinct().withColumn("shard", shard).write.mode("overwrite").parquet(arrived)
        new = self.spark.read.schema(self.stored_schema).parquet(arrived)
        more = new.count()
        if more:
            new.hint("rebalance", "shard").write.mode("append").partitionBy("shard").parquet(f"{self.root}/keys")
        n += more
        wanted = buckets_for(n)
        if wanted > buckets:
            # filters of all keys, with more buckets
            self._replace_filters(filters(self._keys(), self.names, wanted), static=True)
        elif more:
            fresh = filters(new, self.names, buckets)
            touched = F.broadcast(fresh.select("shard").distinct())
            old = self._filters().join(touched, "shard", "left_semi")
            both = old.select("shard", "bucket", "bits").unionByName(fresh)
            merged = both.groupBy("shard", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
            self._replace_filters(merged)
        state = self.spark.createDataFrame([(through, max(wanted, buckets), n)], STATE)
        replace_rows(self.spark, f"{self.root}/state", state, self._write_state)

    def forget(self) -> None:
        """Hold nothing, until the next :meth:`add` brings all days again."""
        if read_or_none(self.spark, f"{self.root}/state", STATE) is None:
            return
        empty = self.spark.createDataFrame([], STATE)
        replace_rows(self.spark, f"{self.root}/state", empty, self._write_state)
        none = self.spark.createDataFrame([], self.stored_schema)
        writer = none.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("shard").parquet(f"{self.root}/keys")
        self._replace_filters(self.spark.createDataFrame([], FILTERS), static=True)

    def _write_state(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state")

    def _writing_filters(self, static: bool):
        def write(rows: DataFrame) -> None:
            (
                rows.hint("rebalance", "shard").sortWithinPartitions("shard", "bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static" if static else "dynamic")
                .partitionBy("shard").parquet(f"{self.root}/filters")
            )

        return write

    def _replace_filters(self, rows: DataFrame, static: bool = False) -> None:
        # a part of the filters and all of them are marked apart
        name = "filters_all" if static else "filters_some"
        replace_rows(self.spark, f"{self.root}/{name}", rows, self._writing_filters(static))

    def _finish(self) -> None:
        finish_replacing(self.spark, f"{self.root}/filters_all", self._writing_filters(True))
        finish_replacing(self.spark, f"{self.root}/filters_some", self._writing_filters(False))
        finish_replacing(self.spark, f"{self.root}/state", self._write_state)


def buckets_for(n: int) -> int:
    """A power of two with which ``n`` keys fill their filters to three quarters at most."""
    buckets = SHARDS
    while buckets * KEYS_OF_A_FILTER * 3 < n * 4:
        buckets *= 2
    return buckets


def shard_of(key: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), *key), F.lit(SHARDS)).cast("int")


def _hashed(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the shard and the bucket of their key, its first bit and the step to the next."""
    first = F.pmod(F.xxhash64(F.lit("first"), *key), F.lit(BITS)).cast("int")
    step = F.pmod(F.xxhash64(F.lit("step"), *key), F.lit(BITS // 2)).cast("int") * 2 + 1
    return (
        rows.withColumn("shard", shard_of(key))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), *key), F.lit(buckets)))
        .withColumn("first", first).withColumn("step", step)
    )


def _probes() -> Column:
    every = F.sequence(F.lit(0), F.lit(PROBES - 1))
    return F.transform(every, lambda i: (F.col("first") + i * F.col("step")) % BITS)


def placed(rows: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """Rows with the shard and the bucket of their key and the bits it sets."""
    return _hashed(rows, key, buckets).withColumn("probes", _probes()).drop("first", "step")


def filters(keys: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """The filter of every bucket that holds a key.

    Buckets are dealt to as many tasks as their keys are good for, so that each
    sorts the bits of its own keys in memory.
    """
    tasks = -(-buckets * KEYS_OF_A_FILTER // TASK_ROWS)
    hashed = _hashed(keys, key, buckets).select("shard", "bucket", "first", "step")
    own = hashed.repartition(tasks, "shard", "bucket")
    probes = own.select("shard", "bucket", F.explode(_probes()).alias("probe"))
    return probes.groupBy("shard", "bucket").agg(F.bitmap_construct_agg("probe").alias("bits"))


def bit(bits: Column, at: Column) -> Column:
    """Whether a bit of a bitmap is set; bit 0 is the lowest of the first byte."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1
