"""Stored tables: one Parquet folder each, facts partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaywise import schemas
from quaywise.session import finish_replacing, read_or_none, replace_rows


class Tables:
    """The warehouse below one root folder (any Hadoop file system URI)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        """The table, or an empty frame of its schema before its first load.

        The schema is declared, so no file footers are read to plan a query.
        """
        columns, _ = schemas.TABLES[name]
        stored = read_or_none(self.spark, self.path(name), columns)
        return self.spark.createDataFrame([], columns) if stored is None else stored

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(name)

    def _shaped(self, name: str, rows: DataFrame) -> DataFrame:
        columns, partitions = schemas.TABLES[name]
        wanted = StructType.fromDDL(columns)
        rows = rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in wanted])
        # files of the advisory size: AQE splits a day that holds most of the
        # rows over several tasks and joins small days. Without days the tasks
        # that make the rows are of that size already: no shuffle is needed
        return rows.hint("rebalance", *partitions) if partitions else rows

    def _write(self, name: str, rows: DataFrame, mode: str) -> None:
        _, partitions = schemas.TABLES[name]
        writer = self._shaped(name, rows).write.mode(mode)
        if partitions:
            writer = writer.partitionBy(*partitions)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic" if partitions else "static")
        writer.parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        self._write(name, rows, "append")

    def reload(self, name: str, rows: DataFrame) -> None:
        """Replace the table; ``rows`` must not be read from it."""
        self._write(name, rows, "overwrite")

    def replace_days(self, name: str, rows: DataFrame) -> None:
        """Replace only the partitions that occur in ``rows``."""
        assert schemas.TABLES[name][1], f"{name} has no partitions"
        self._write(name, rows, "overwrite")

    def reload_from_itself(self, name: str, rows: DataFrame) -> None:
        """Like :meth:`reload` for rows that were derived from the table."""
        replace_rows(self.spark, self.path(name), rows, lambda copy: self.reload(name, copy))

    def replace_days_from_itself(self, name: str, rows: DataFrame) -> None:
        """Like :meth:`replace_days` for rows that were derived from the table."""
        replace_rows(self.spark, self.path(name), rows, lambda copy: self.replace_days(name, copy))

    def compact_days(self, name: str, days: list[int] | list[str]) -> None:
        """Rewrite some day partitions, after many small appends, into few files."""
        _, partitions = schemas.TABLES[name]
        self.recover(name)
        self.replace_days_from_itself(name, self.read(name).where(F.col(partitions[0]).isin(*days)))

    def recover(self, name: str) -> None:
        """Finish a replacement that was cut short."""
        finish_replacing(self.spark, self.path(name), lambda copy: self._write(name, copy, "overwrite"))
