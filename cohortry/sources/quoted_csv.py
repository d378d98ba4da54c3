"""Records of quoted CSV files whose values may hold line ends, read in splits.

Whether a line begins inside a quoted value depends on the number of quotes before it in its file. One pass counts the quotes of
each file split; the running sum over a file's splits, modulo two, says in which state each split begins and ends. A second pass
cuts the lines of each split into records: a record belongs to the split it begins in. Splits that begin or end inside a
value are read once more for the fragments at their edges, at most two a split; they alone are shuffled. Any number of tasks can so read one file.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..scale import stage

#: Splits whose states are broadcast (about 30 bytes each); beyond, lines are dealt to their splits' states.
BROADCAST_SPLITS = 1_000_000
#: A longer record means that a quote is never closed.
RECORD_LINES = 1_000_000

PART = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.string())])
PART_SQL = "file long, block long, kind int, first boolean, record string"
WHOLE, HEAD, TAIL = 0, 1, 2


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines in the order of their split; a line belongs to the split it begins in. Carriage returns stay."""
    text = spark.read.option("lineSep", "\n").text(paths)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_path").alias("path"), "value")


def split_states(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, path, block, inside, open, odd): whether each split begins and ends inside a quoted value, and how many of its lines change that. Staged."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = _lines(spark, paths).groupBy("file", "path", "block").agg(F.sum(quotes).alias("quotes"), F.sum(quotes % 2).alias("odd"))
    upto = Window.partitionBy("file").orderBy("block")
    counted = counted.withColumn("all", F.sum("quotes").over(upto))
    return stage(counted.select("file", "path", "block", ((F.col("all") - F.col("quotes")) % 2 == 1).alias("inside"), (F.col("all") % 2 == 1).alias("open"), "odd"))


class _Split:
    """Cuts the lines of one split, batch by batch."""

    def __init__(self, file: int, block: int, inside: bool):
        self.file, self.block = file, block
        self.head = self.inside = inside
        self.first = block == 0 and not inside
        self.open: list[str] = []

    def take(self, lines: pa.Array) -> Iterator[tuple[int, bool, pa.Array]]:
        """(kind, first, records) of what is complete; an unfinished record is kept."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        after = (np.cumsum(quotes) + self.inside) % 2 == 1
        ends = np.flatnonzero(~after) + 1  # records end behind these lines
        self.inside = bool(after[-1])
        at = 0
        if (self.open or self.head) and len(ends):
            at = int(ends[0])
            record = "\n".join(self.open + lines[:at].to_pylist())
            yield HEAD if self.head else WHOLE, self.first, pa.array([record])
            self.open, self.head, self.first, ends = [], False, False, ends[1:]
        if self.first and len(ends):
            yield WHOLE, True, pa.array(["\n".join(lines[: int(ends[0])].to_pylist())])
            at, self.first, ends = int(ends[0]), False, ends[1:]
        if len(ends):
            offsets = np.concatenate([[at], ends]).astype(np.int32)
            if len(ends) == offsets[-1] - at:
                records = lines[at : int(offsets[-1])]
            else:
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")
            yield WHOLE, False, records
            at = int(offsets[-1])
        self.open += lines[at:].to_pylist()
        if len(self.open) > RECORD_LINES:
            raise ValueError(f"a quoted value in the split at byte {self.block} goes over more than {RECORD_LINES} lines: a quote is missing")

    def end(self) -> Iterator[tuple[int, bool, pa.Array]]:
        if self.open:
            yield HEAD if self.head else TAIL, self.first, pa.array(["\n".join(self.open)])


def _cut(batches: Iterator[pa.RecordBatch], header: list[str] | None, delimiter: str, whole: bool) -> Iterator[pa.RecordBatch]:
    """Whole records without headers, or else the fragments."""
    split: _Split | None = None

    def put(parts: Iterator[tuple[int, bool, pa.Array]]) -> Iterator[pa.RecordBatch]:
        for kind, first, records in parts:
            if first and kind == WHOLE:
                names = next(csv.reader([records[0].as_py().rstrip("\r").removeprefix("\ufeff")], delimiter=delimiter), [])
                if header is not None and [n.lower() for n in names] != [h.lower() for h in header]:
                    raise ValueError(f"a file's header {names} differs from {header}")
            elif (kind == WHOLE) == whole:
                n = len(records)
                yield pa.record_batch([pa.array(np.full(n, v), k) for v, k in zip((split.file, split.block, kind, first), PART.types)] + [records], PART.names)

    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch["file"].to_numpy(), batch["block"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if split is None or (split.file, split.block) != (file[a], block[a]):
                if split is not None:
                    yield from put(split.end())
                inside = batch["inside"][a].as_py()
                if inside is None:
                    raise ValueError("file splits differ from those that were counted; fix spark.sql.files.minPartitionNum")
                split = _Split(int(file[a]), int(block[a]), inside)
            yield from put(split.take(batch["value"].slice(a, b - a)))
    if split is not None:
        yield from put(split.end())


def quoted_records(
    spark: SparkSession, paths: list[str], header: list[str] | None, delimiter: str = ",", states: DataFrame | None = None, broadcast_splits: int = BROADCAST_SPLITS
) -> DataFrame:
    """(path, record) of every record but the headers and empty lines.

    Quotes must be balanced as in RFC 4180; lines end with or without a carriage return. With ``header``, files with another one are an error. An empty file has no records.
    """
    states = states or split_states(spark, paths)
    n, edged = states.agg(F.count("*"), F.count_if(F.col("inside") | F.col("open"))).first()

    def cut(wanted: DataFrame, how: str, whole: bool) -> DataFrame:
        lines, keys = _lines(spark, paths).drop("path"), wanted.select("file", "block", "inside")
        if n <= broadcast_splits:
            marked = lines.join(F.broadcast(keys), ["file", "block"], how)
        else:
            placed = lines.withColumn("at", F.monotonically_increasing_id()).join(keys, ["file", "block"], how)
            marked = placed.repartition("file", "block").sortWithinPartitions("file", "block", "at").drop("at")
        return marked.mapInArrow(partial(_cut, header=header, delimiter=delimiter, whole=whole), PART_SQL)

    records = cut(states, "left", True).select("file", "record")
    if edged:
        # A fragment that begins a record starts a new group; the fragments behind it in its file are the rest of it.
        along = Window.partitionBy("file").orderBy("block", "kind")
        pieces = cut(states.where("inside or open"), "inner", False).withColumn("owner", F.sum((F.col("kind") == TAIL).cast("int")).over(along))
        stitched = pieces.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "kind", "record"))).alias("parts"), F.max("first").alias("first"))
        records = records.union(stitched.where("not first").select("file", F.array_join("parts.record", "\n").alias("record")))
    files = states.select("file", "path").distinct()
    return records.join(files, "file").select("path", F.rtrim("record", F.lit("\r")).alias("record")).where(F.trim("record") != "")
