"""Daily objects: one folder of files for each day below a dataset folder.

And landing folders: files of texts, as feeds leave them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a landed file. Compressed files are not split, so a file is what one task reads.
FILE_ROWS = 20_000


def land(rows: DataFrame, folder: str, mode: str = "append") -> None:
    """Add the texts of ``value`` to a landing folder, a line each, in compressed files of bounded size."""
    writer = rows.select("value").write.mode(mode).option("compression", "gzip")
    writer.option("maxRecordsPerFile", FILE_ROWS).text(folder)


def clear(spark: SparkSession, folder: str) -> None:
    """Give the disk of a landing folder back once all of it is taken in; the folder stays."""
    spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(folder)


def write_daily(rows: DataFrame, folder: str, date_column: str) -> None:
    """Replace the days found in ``rows``; other days stay."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(folder)
    )


def read_daily(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def read_matching(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, content) of the files below ``folder`` whose path matches ``pattern``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .where(F.col("path").rlike(pattern))
        .select("path", "content")
    )
