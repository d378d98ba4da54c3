"""Clinical tables bucketed by person, so that steps that join or group by person need no shuffle of facts.

Each table is dealt to buckets by the hash that Spark's own shuffles use, one file per bucket and sorted by concept in it, so
row groups are still skipped by concept. A small file beside the tables says how they were dealt; ``open_buckets`` declares them to a
session from it, so nothing depends on a catalog that outlives the session.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .schemas import CONCEPT_COLUMN

MANIFEST = "buckets.json"


def _name(prefix: str, table: str) -> str:
    return f"{prefix}_{table}"


def write_buckets(spark: SparkSession, tables: Mapping[str, DataFrame], target: str, buckets: int, prefix: str = "bucketed") -> list[str]:
    """Writes ``tables`` below ``target``; those with person_id in ``buckets`` files, others as they are. Returns their names.

    One shuffle per table, and one file per bucket: tasks hold whole buckets. The manifest is written last.
    """
    if buckets < 1:
        raise ValueError("buckets must be positive")
    base, written = target.rstrip("/"), []
    for table, df in tables.items():
        order = CONCEPT_COLUMN.get(table)
        path = f"{base}/{table}"
        if "person_id" in df.columns:
            dealt = df.withColumn("person_id", F.col("person_id").cast("bigint")).repartition(buckets, "person_id")
            sort = [order] if order in df.columns else ["person_id"]
            spark.sql(f"DROP TABLE IF EXISTS `{_name(prefix, table)}`")
            dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, "person_id").sortBy(*sort).saveAsTable(_name(prefix, table))
            written.append({"table": table, "schema": dealt.schema.json(), "sort": sort, "buckets": buckets})
        else:
            df.write.mode("overwrite").parquet(path)
            written.append({"table": table, "schema": df.schema.json(), "sort": [], "buckets": 0})
    rows = [(json.dumps(w),) for w in written]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("overwrite").text(f"{base}/{MANIFEST}")
    return [w["table"] for w in written]


def open_buckets(spark: SparkSession, target: str, prefix: str = "bucketed") -> dict[str, DataFrame]:
    """The tables that ``write_buckets`` left in ``target``, declared to this session with their buckets."""
    base, found = target.rstrip("/"), {}
    for row in spark.read.text(f"{base}/{MANIFEST}").collect():
        entry = json.loads(row.value)
        table, path = entry["table"], f"{base}/{entry['table']}"
        if not entry["buckets"]:
            found[table] = spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(path)
            continue
        name = _name(prefix, table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(json.loads(entry["schema"])))
        sort = ", ".join(f"`{c}`" for c in entry["sort"])
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        spark.sql(f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (person_id) SORTED BY ({sort}) INTO {entry['buckets']} BUCKETS LOCATION '{path}'")
        found[table] = spark.table(name)
    return found
