"""What the operators share: reading tables, texts in batches, shared files."""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaywise.session import scratch_path

#: Texts are handed on in slices of about so many bytes, so that a batch of
#: long texts is never expanded at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor, F.lit(0)).cast("int")


def crc_remainder(doc_id: int | None, divisor: int) -> int:
    """The same for one Python value."""
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % divisor


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written below the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs tasks, never the steps before.
    """
    spark = rows.sparkSession
    folder = scratch_path(spark, name)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def with_fields(rows: DataFrame, **fields: T.DataType) -> T.StructType:
    """The schema of ``rows`` with more fields at its end."""
    return T.StructType([*rows.schema.fields, *(T.StructField(k, v) for k, v in fields.items())])


BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of a batch that goes to a Python worker; Spark's own default is four times that.
BATCH_BYTES = "16777216b"
_SPARKS_BATCH_BYTES = "67108864b"


def map_batches(rows: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``rows.mapInArrow`` with batches of a bounded size."""
    bound_batches(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def bound_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches, unless the session names a size of its own.

    Executors and workers hold a few copies of a batch, so its size decides
    what a task needs for long texts.
    """
    if spark.conf.get(BATCH_KEY) == _SPARKS_BATCH_BYTES:
        spark.conf.set(BATCH_KEY, BATCH_BYTES)


def byte_texts(column: pa.Array) -> pa.Array:
    """A string column as UTF-8 bytes, without a copy for each value."""
    return column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``most`` bytes of text."""
    for batch in batches:
        start = size = 0
        lengths = pc.binary_length(batch.column(text)).to_pylist()
        for i, length in enumerate(lengths):
            size += length or 0
            if size >= most:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def local_path(uri: str) -> str | None:
    """The path behind a shared folder that is mounted as a file system."""
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def write_shared(folder: str, name: str, content: bytes) -> str:
    """Write one file of a shared folder under a name of its own; returns the name.

    The attempt that counts reports its name, so a file that a failed attempt
    left is never read.
    """
    name = f"{name}-{uuid.uuid4().hex}"
    if path := local_path(folder):
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{name}", "wb") as out:
            out.write(content)
    else:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{name}") as out:
            out.write(content)
    return name


def map_shared(folder: str, name: str):
    """A shared file as memory-mapped bytes.

    A store that is not mounted is copied to an unnamed temporary file first:
    it takes disk only while the process has it open and leaves nothing.
    """
    import numpy as np

    if path := local_path(folder):
        size = os.path.getsize(f"{path}/{name}")
        return np.memmap(f"{path}/{name}", dtype="u1", mode="r") if size else np.empty(0, "u1")
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    with tempfile.TemporaryFile() as copy:
        with store.open_input_stream(f"{root}/{name}") as source:
            while block := source.read(1 << 20):
                copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype="u1", mode="r") if copy.tell() else np.empty(0, "u1")
