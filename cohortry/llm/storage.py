"""Files in the shared folder of the session: written and read inside tasks through ``pyarrow.fs``.

A task writes under a name with its attempt number and returns that name as a row; only rows of tasks
that Spark committed are ever read, so a lost or repeated task leaves an unused file and no damage.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortry.scale import staging_root


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once a session; they may run where it isn't installed."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    target = f"{tempfile.mkdtemp(prefix='cohortry-')}/cohortry_package.zip"
    with zipfile.ZipFile(target, "w") as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the shared folder; tasks create it when they write."""
    return f"{staging_root(spark).rstrip('/')}/cohortry/{kind}-{uuid.uuid4().hex}"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


def create(uri: str):
    """An output stream; missing folders are made."""
    system, path = opened(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def attempt_name(folder: str, suffix: str, roll: int = 0) -> str:
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():06d}-{roll:04d}-{task.taskAttemptId()}{suffix}"


def rows_in_slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short slices keep the Python objects of one step small when texts are long."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about so many bytes of text; a longer text is a slice of its own."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def spread(df: DataFrame, rows: int) -> DataFrame:
    """One row a partition, for a list of files as long as the number of tasks that wrote it."""
    return df.repartition(max(1, rows), F.rand(7)) if rows > 1 else df.coalesce(1)


def texts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Only the id and the text, null texts as empty ones: other columns, whatever their names, can't interfere."""
    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go as soon as the query that made them has ended, and staged tables are packed closely."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
