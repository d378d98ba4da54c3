"""Size checks and staged tables.

The library leaves broadcasting to the optimizer, which does it below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles above. That is only right when sizes are true,
so small driver-side data becomes a local relation of known size, and a derived frame that feeds
several later steps is written once to shared storage and read back with its real size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Ids a study may hold on the driver (about 16 MB); larger sets stay distributed.
DRIVER_IDS = 1_000_000


def local_frame(spark: SparkSession, columns: dict[str, list], types: dict[str, pa.DataType]) -> DataFrame:
    """A driver-side relation.

    Built from Arrow so that the optimizer sees a local relation with its real size and decides
    itself whether it is small enough to broadcast.
    """
    arrays = {name: pa.array(values, types[name]) for name, values in columns.items()}
    return spark.createDataFrame(pa.table(arrays))


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A temporary folder is used only where neither is set and everything runs in one process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortry-"))
    return context.getCheckpointDir()


# Folder, below the staging root, of the work that is going on.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Inside, staged tables go to a folder of their own, which is removed at the end.

    Frames built inside must be written before that.
    """
    name = uuid.uuid4().hex
    before = _SCRATCH.set(name)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark).rstrip('/')}/cohortry/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    The result has a short lineage that survives lost executors, prunes columns, and carries its
    true size, which lets the optimizer choose the right join for every later use.
    """
    spark = df.sparkSession
    below = f"{_SCRATCH.get()}/" if _SCRATCH.get() else ""
    path = f"{staging_root(spark).rstrip('/')}/cohortry/{below}{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
