"""Sets of results that appear whole or not at all.

Every set is written under a new name. Rows and a checksum of each frame are observed in the pass that writes it, and one line of JSON
that lists all frames is appended to the set's manifest last. Readers take the newest line and nothing that no line names, so a write
that fails half-way leaves the former set in force. What is read can be checked against what was written.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from .sinks import read_back, write_table


def _checksum(df: DataFrame) -> Column:
    """The same for the same rows in any order; repeated rows count."""
    return F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def write_results(frames: Mapping[str, DataFrame], base: str, name: str, fmt: str = "parquet") -> str:
    """Writes ``frames`` as one set; returns its folder. Each frame is computed once."""
    spark = next(iter(frames.values())).sparkSession
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"
    folder = f"{base.rstrip('/')}/{name}-{run}"
    listed = []
    for key, df in frames.items():
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("n_rows"), _checksum(df).alias("checksum"))
        write_table(observed, f"{folder}/{key}", fmt)
        listed.append({"frame": key, "schema": df.schema.json(), "n_rows": seen.get["n_rows"], "checksum": seen.get["checksum"]})
    line = json.dumps({"run": run, "format": fmt, "frames": listed})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{base.rstrip('/')}/{name}.manifest")
    return folder


def read_results(spark: SparkSession, base: str, name: str, check: bool = True) -> dict[str, DataFrame]:
    """The frames of the newest whole set. With ``check`` rows and checksums are compared, which reads every frame once."""
    try:
        lines = [json.loads(r.value) for r in spark.read.text(f"{base.rstrip('/')}/{name}.manifest").collect()]
    except Exception as missing:
        raise ValueError(f"{base}: no whole set of results named {name}") from missing
    if not lines:
        raise ValueError(f"{base}: no whole set of results named {name}")
    newest = max(lines, key=lambda line: line["run"])
    found = {}
    for entry in newest["frames"]:
        schema = StructType.fromJson(json.loads(entry["schema"]))
        df = read_back(spark, f"{base.rstrip('/')}/{name}-{newest['run']}/{entry['frame']}", schema, newest["format"])
        if check:
            n_rows, checksum = df.agg(F.count(F.lit(1)), _checksum(df)).first()
            if (n_rows, checksum) != (entry["n_rows"], entry["checksum"]):
                raise ValueError(f"{entry['frame']}: {n_rows} rows with checksum {checksum} are there, {entry['n_rows']} with {entry['checksum']} were written")
        found[entry["frame"]] = df
    return found
