"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a refresh has a few hundred generated classes; the default of 100 would
    # compile most of them again on every run
    "spark.sql.codegen.cache.maxEntries": "2000",
    # shuffle files go when the load or query that made them ends; else they
    # stay until the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # stored and copied tables take a third less disk than with the default
    "spark.sql.parquet.compression.codec": "zstd",
    # dynamic overwrite is also asked for by each writer
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

_local_roots: dict[str, str] = {}


def build_session(app: str = "quaywise", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only on a local master.

    Tables that cut lineage are written below it, so it must be reachable from
    every executor. On a cluster without the setting this raises rather than
    falling back to a folder that exists on one machine only.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="quaywise-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the scratch root; nothing is created here."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/quaywise/{app}/{name}-{uuid.uuid4().hex[:12]}"


#: Rows that a task of a load should sort, and bytes that it should read of a shuffle.
TASK_ROWS, TASK_BYTES = 250_000, 16 << 20
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_GIVE_BACK = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SPARKS_ADVISORY = "67108864b"
_CODEC, _SPARKS_CODEC = "spark.sql.parquet.compression.codec", "snappy"


def bound_tasks(spark: SparkSession, rows: int) -> None:
    """Shuffles of this session are cut so that a task's share is sorted in memory.

    Partitions of a fixed number grow with the rows, until every sort spills. AQE
    joins those that turn out small. A session that names a size of its own keeps it.
    Shuffle files of a step are given back when it ends, so a load needs the disk of
    the steps that run at a time and not of all.
    """
    spark.conf.set(_GIVE_BACK, SETTINGS[_GIVE_BACK])
    if spark.conf.get(_CODEC) == _SPARKS_CODEC:
        spark.conf.set(_CODEC, SETTINGS[_CODEC])
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
    if wanted > int(spark.conf.get(_PARTITIONS, None) or 0):
        spark.conf.set(_PARTITIONS, wanted)
    if spark.conf.get(_ADVISORY) == _SPARKS_ADVISORY:
        spark.conf.set(_ADVISORY, f"{TASK_BYTES}b")


def together(*steps: Callable[[], object]) -> None:
    """Steps that do not depend on each other share the cluster."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def replace_rows(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    write: Callable[[DataFrame], None],
    also: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace stored rows by ``rows`` that were derived from them.

    A folder must not be overwritten by a plan that still reads it, and an
    overwrite that fails halfway must not lose rows. So the new rows are written
    next to the table first and marked as complete; then ``write`` puts them in
    place. Whoever comes next finishes a marked copy (:func:`finish_replacing`).
    ``write`` gives the same table however often it runs; ``also`` names rows to
    add, made from those that were written. One writer at a time.
    """
    copy, mark = f"{path}__next", f"{path}__ready"
    rows.write.mode("overwrite").parquet(copy)
    if also:
        more = also(spark.read.schema(rows.schema).parquet(copy))
        more.write.mode("append").parquet(copy)
    spark.range(1).write.mode("overwrite").parquet(mark)
    finish_replacing(spark, path, write)


def finish_replacing(spark: SparkSession, path: str, write: Callable[[DataFrame], None]) -> None:
    """Put a copy that was marked as complete in place, and take the mark away."""
    copy, mark = f"{path}__next", f"{path}__ready"
    ready = read_or_none(spark, mark, "id long")
    if ready is None or ready.isEmpty():
        return
    rows = spark.read.parquet(copy)
    write(rows)
    spark.range(0).write.mode("overwrite").parquet(mark)
    give_back(spark, copy, rows.schema)


def give_back(spark: SparkSession, path: str, schema: StructType) -> None:
    """Rows that are not needed any more give their disk back; their schema stays."""
    spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)


def read_or_none(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The Parquet folder, or None before its first load."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
