"""The warehouse of the sample feed, built once for each session and data folder."""

from __future__ import annotations

from threading import Lock

from pyspark.sql import SparkSession

from quaywise.plans import refresh
from quaywise.session import bound_tasks, scratch_path
from quaywise.sources import sample
from quaywise.sources.tables import Tables

AS_OF = sample.AS_OF

_built: dict[tuple[str, str], str] = {}
_lock = Lock()


def build(spark: SparkSession, sf_dir: str) -> Tables:
    """Load everything into a new folder below the shared scratch folder."""
    bound_tasks(spark, spark.read.parquet(f"{sf_dir}/lineitem.parquet").count())
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    refresh.together(
        lambda: refresh.init_calendar(tables),
        lambda: refresh.load_referentials(
            tables,
            sample.stations(spark, sf_dir),
            sample.departements(spark, sf_dir),
            sample.name_corrections(spark, sf_dir),
        ),
        lambda: refresh.load_staging(
            tables, sample.staged_trips(spark, sf_dir), sample.staged_stops(spark, sf_dir)
        ),
    )
    refresh.run_refresh(tables, AS_OF, refresh.Window.history())
    tables.reload("forecast/fact_train_volume_forecast", sample.forecast(tables["ods/trips"]))
    return tables


def warehouse(spark: SparkSession, sf_dir: str) -> Tables:
    """The loaded tables; queries read these as dashboards read a warehouse."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _built:
            _built[key] = build(spark, sf_dir).root
    return Tables(spark, _built[key])
