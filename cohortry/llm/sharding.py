"""Sharding by sampled splitters: contiguous key ranges of near equal size, dealt to shards.

The key is (hash of the text, doc_id), so equal texts lie next to each other. Keys are drawn with a
chance proportional to their size; quantiles of the draw cut the keys into many more ranges than
shards. A cut moves to the begin of its group of equal texts unless the group is large, so only groups
of over an eighth of a shard are divided. All rows are then measured range by range, ranges
that came out overfull are subdivided by a second draw, and whole ranges go to the lightest shard,
largest first. Only the draw, the few large groups and one row per range ever reach the driver.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortry.scale import local_frame, stage

from .storage import ship

#: Ranges per shard at least, the rows a range should not exceed by much, and draws per range.
RANGES, RANGE_ROWS, DRAWS = 64, 500_000, 24
#: A range this many times the mean is subdivided.
OVERFULL = 2.0
#: A group of equal texts of more than a shard's share over this is divided.
WHOLE = 8
#: Before every place of a group.
FIRST = -(2**63)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, group, place): UTF-8 bytes plus 8, checksum, and the two parts of the key.

    A null text has no bytes. ``place`` spreads the rows of a group and orders them; documents without an id share one place.
    """
    ship(docs.sparkSession)
    data = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(data) + 8).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(data).alias("group"), F.xxhash64(F.col("doc_id").cast("long")).alias("place"),
    )


def _drawn(rows: DataFrame, total: int, draws: int) -> list[tuple[int, int, int]]:
    """Keys drawn with chance draws * size / total, at most one per row; a hash decides, so a repeated task draws the same."""
    chance = (F.xxhash64("group", "place", "doc_id", F.lit(11)) / F.lit(2.0**64)) + F.lit(0.5)
    picked = rows.where(chance < F.lit(draws / max(1, total)) * F.col("size")).select("group", "place", "size")
    return sorted((r.group, r.place, max(1, r.size * draws // max(1, total))) for r in picked.collect())


def _cuts(drawn: list[tuple[int, int, int]], ranges: int, large: set[int]) -> set[tuple[int, int]]:
    """Quantile cuts, moved to the begin of their group unless that is one of the large ones."""
    weight, cuts, seen = sum(w for *_, w in drawn), set(), 0
    for group, place, w in drawn:
        # A row drawn with a weight of several quantiles still makes one cut.
        if seen * ranges // max(1, weight) != (seen + w) * ranges // max(1, weight):
            cuts |= {(group, FIRST), (group, place)} if group in large else {(group, FIRST)}
        seen += w
    return cuts


def range_number(groups: np.ndarray, places: np.ndarray, cuts: list[tuple[int, int]]) -> np.ndarray:
    """For each key the number of cuts at or before it."""
    cut_groups = np.array([g for g, _ in cuts], np.int64)
    cut_places = np.array([p for _, p in cuts], np.int64)
    low, high = np.searchsorted(cut_groups, groups, "left"), np.searchsorted(cut_groups, groups, "right")
    out = low.copy()
    for first, last in set(zip(low[low < high].tolist(), high[low < high].tolist())):
        same = (low == first) & (high == last)
        out[same] += np.searchsorted(cut_places[first:last], places[same], "right")
    return out


def _ranged(rows: DataFrame, cuts: list[tuple[int, int]], name: str) -> DataFrame:
    """``rows`` with the number of their range; the cuts, bounded by the draw, travel with the function."""

    @F.pandas_udf("int")
    def number(group: pd.Series, place: pd.Series) -> pd.Series:
        return pd.Series(range_number(group.to_numpy(np.int64), place.to_numpy(np.int64), cuts))

    return rows.withColumn(name, number("group", "place"))


def _lightest(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Largest range first, each to the shard with the fewest bytes."""
    heap, placed = [(0, s) for s in range(shards)], {}
    for number, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        bytes_, shard = heapq.heappop(heap)
        placed[number] = shard
        heapq.heappush(heap, (bytes_ + size, shard))
    return placed


def sharded(docs: DataFrame, shards: int = 24, ranges: int = RANGES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    The law is ``bytes``: shards get near equal bytes. Equal texts stay together unless they exceed a
    range. Slots count from 0 in each shard. Repeated rows get slots of their own; null and empty texts are 8 bytes; no rows give no rows. Only
    id and text are read.
    """
    spark = docs.sparkSession
    rows = stage(measured(docs))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("size")).first()
    wanted = shards * max(ranges, -(-count // (shards * range_rows)))
    by_group = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    large = {r.group for r in by_group.where(F.col("bytes") * (shards * WHOLE) > total).collect()}
    cuts = sorted(_cuts(_drawn(rows, total, DRAWS * wanted), wanted, large))
    most = OVERFULL * total / wanted
    while True:
        parts = _ranged(rows, cuts, "part")
        found = {r.part: (r.bytes, r.n) for r in parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("size").alias("n")).collect()}
        overfull = [p for p, (b, n) in found.items() if b > most and n > 1]
        if not overfull:
            break
        # Another draw inside the overfull ranges alone, until none is left or no cut is new: one row, or one text that stays together.
        excess = sum(found[p][0] for p in overfull)
        more = _drawn(parts.where(F.col("part").isin(overfull)), excess, DRAWS * -(-excess * wanted // max(1, total)))
        numbers = range_number(np.array([g for g, *_ in more], np.int64), np.array([p for _, p, _ in more], np.int64), cuts) if more else []
        by_part: dict[int, list] = {p: [] for p in overfull}
        for number, drawn in zip(numbers, more):
            by_part[int(number)].append(drawn)
        new = (_cuts(drawn, max(2, -(-found[p][0] * wanted // total)), large) for p, drawn in by_part.items())
        further = {*cuts}.union(*new)
        if len(further) == len(cuts):
            break
        cuts = sorted(further)
    placed = _lightest({p: b for p, (b, _) in found.items()}, shards)
    base, used = {}, [0] * shards
    for part in sorted(found):
        base[part] = used[placed[part]]
        used[placed[part]] += found[part][1]
    order = sorted(found)
    where = local_frame(
        spark, {"part": order, "shard": [placed[p] for p in order], "base": [base[p] for p in order]}, {"part": pa.int32(), "shard": pa.int32(), "base": pa.int64()}
    )
    in_part = F.row_number().over(Window.partitionBy("part").orderBy("group", "place", "doc_id", "size"))
    return parts.withColumn("number", in_part).join(where, "part").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
