"""Shared helpers of the training-data operators.

Everything written between stages goes to the cluster's shared folder
(``spark.checkpoint.dir``, see ``scrubline.session.shared_dir``).  Flat files
(archives, token files) are opened through ``pyarrow.fs`` so that the folder may
be a mounted path or any store that pyarrow reaches.
"""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.session import new_run_dir

#: Fixed value: a word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for d, _, names in os.walk(package):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), os.path.dirname(package)))
    uri = f"{file_dir(spark, 'code')}/scrubline_code.zip"  # executors fetch it from the shared folder
    fs, path = open_fs(uri)
    with fs.open_output_stream(path) as f:
        f.write(held.getvalue())
    spark.sparkContext.addPyFile(uri)
    _SHIPPED.add(app)


ARROW_ROWS = 1000  # rows in an Arrow batch: texts are wide, and a batch is held twice on either side


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package shipped to the workers.

    A session that still has Spark's default of 10,000 rows in an Arrow batch gets
    ``ARROW_ROWS``; a value that somebody set is kept.  Workers live on between tasks, so
    Arrow gives its free memory back at the end of each.
    """
    spark = df.sparkSession
    ship_code(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(ARROW_ROWS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    Cuts the lineage: what follows reads files that every executor can reach, so
    a lost executor costs only its own tasks.
    """
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 200_000  # narrow rows (ids and keys): a few MB


def checked_broadcast(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow rows, marked for broadcast only while its counted size allows; else joined by shuffle."""
    return F.broadcast(table) if table.count() <= rows else table


def file_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for flat files, made on the driver (tasks only add files)."""
    uri = new_run_dir(spark, name)
    fs, path = open_fs(uri)
    fs.create_dir(path, recursive=True)
    return uri


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or plain path; local files are memory-mapped."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(use_mmap=True), uri
    fs, path = pafs.FileSystem.from_uri(uri)
    return (pafs.LocalFileSystem(use_mmap=True) if isinstance(fs, pafs.LocalFileSystem) else fs), path


def attempt_name(prefix: str, part: int, suffix: str) -> str:
    """A file name of its own for each task attempt: retries never share a file."""
    return f"{prefix}-{part:06d}-{uuid.uuid4().hex[:12]}{suffix}"


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    """``schema`` without columns named like ``fields`` (in any case), then ``fields``."""
    new = {f.name.lower() for f in fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in new] + list(fields))


def set_columns(batch: pa.RecordBatch, schema: pa.Schema, **new: pa.Array) -> pa.RecordBatch:
    """The columns of ``schema``: the given arrays, the others from ``batch``."""
    arrays = [new[f.name] if f.name in new else batch.column(batch.schema.get_field_index(f.name)) for f in schema]
    return pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, schema)],
                                      schema=schema)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds at most ``max_bytes`` of a text column (one row at least)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > max_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
