"""SimHash near duplicates, found in an overlapping vantage-point partition of the fingerprints.

A tree node measures the Hamming distance of a fingerprint to a vantage point, counted on the node's
own block of bits, and has a child per distance. A path through all levels names a shard. By the
triangle inequality a step of one bit changes one of these distances by one at most, and the blocks are
disjoint, so a fingerprint within ``reach`` bits of x lies in a shard whose distances differ from x's by
``reach`` in sum at most; all other branches are pruned. Two fingerprints at 2 bits or fewer have one
between them that is within 1 of both. So each fingerprint goes to its own shard and to those that it
reaches with 1 bit, and every link lies whole in some shard.

In a shard, links are searched exactly; a large shard is split further by a local vantage-point
tree in the same way. Only a spanning forest of a shard's links is reported, as many rows as
fingerprints at most, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import stage

from .components import components
from .storage import rows_in_slices, texts

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Rows of a shard that are compared directly; above that it is split, where that helps.
DIRECT = 768
#: Vantage point of every level; any value serves, since the bits of fingerprints are mixed.
VANTAGE = 0x9E3779B97F4A7C15


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle, repeats included: A-Z lowered, words split at ASCII white space, joined by a space."""
    w = text.encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit b is 1 if it is set in over half of the hashes; no hashes give 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, bits): the fingerprint as a signed long; whole texts, null as empty."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_slices(batches):
            bits = [fingerprint(shingle_hashes(t, words)) for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], pa.array(np.array(bits, np.uint64).view(np.int64))], ["doc_id", "bits"])

    return texts(docs).mapInArrow(compute, "doc_id long, bits long")


def level_masks(levels: int) -> list[int]:
    """Disjoint blocks of bits that cover all 64."""
    edges = [64 * i // levels for i in range(levels + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def levels_for(fingerprints: int) -> int:
    """The tree deepens with the logarithm of the number of fingerprints, so shards keep their size; each level adds about 2.8 bits."""
    return int(np.clip(np.ceil(np.log2(max(2, fingerprints / 256)) / 2.8), 2, 8))


def shards_of(prints: DataFrame, levels: int) -> DataFrame:
    """(shard, bits): each fingerprint in its own shard and in all that it reaches with one bit.

    Radii up to 2 are covered, since a point halfway between two linked fingerprints is within 1 of both.
    """
    masks = level_masks(levels)
    distances = [F.bit_count(F.expr(f"(bits ^ {_signed(VANTAGE)}L) & {_signed(m)}L")) for m in masks]
    own = sum((d.cast("long") * F.lit(33**i) for i, d in enumerate(distances)), F.lit(0).cast("long"))
    reached = [F.when(d > 0, own - 33**i) for i, d in enumerate(distances)]
    reached += [F.when(d < m.bit_count(), own + 33**i) for i, (d, m) in enumerate(zip(distances, masks))]
    return prints.select("bits", F.explode(F.array_compact(F.array(own, *reached))).alias("shard"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _roots(count: int, pairs: np.ndarray) -> np.ndarray:
    root = list(range(count))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in pairs.tolist():
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(count)])


def _direct(values: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    a, b = np.nonzero(np.triu(near, 1))
    if not len(a):
        return []
    roots = _roots(len(values), np.column_stack([a, b]))
    moved = np.nonzero(roots != np.arange(len(values)))[0]
    return [(values[moved], values[roots[moved]])]


def _grown(values: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For a dense shard: components grown from a seed, each fingerprint compared with those not yet reached."""
    out, left = [], values
    while len(left):
        seed, left, front = left[0], left[1:], [left[0]]
        reached = []
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= radius
            if near.any():
                reached.append(left[near])
                front.extend(left[near])
                left = left[~near]
        if reached:
            members = np.concatenate(reached)
            out.append((members, np.full(len(members), seed)))
    return out


def forest(values: np.ndarray, radius: int = RADIUS, deep: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links (member, other) that span every component of the distinct ``values``.

    A large set is split by its distances to a vantage point at their median; both halves keep what is
    within ``radius`` of the split, so that no link is lost.
    """
    if len(values) <= DIRECT:
        return _direct(values, radius)
    vantage = values[(deep * 7919) % len(values)]
    away = np.bitwise_count(values ^ vantage).astype(np.int64)
    middle = int(np.median(away))
    reach = (radius + 1) // 2
    inside, outside = away <= middle + reach, away >= middle + 1 - reach
    if max(inside.sum(), outside.sum()) > 0.8 * len(values):
        return _grown(values, radius)
    return forest(values[inside], radius, deep + 1) + forest(values[outside], radius, deep + 1)


def links(prints: DataFrame, levels: int) -> DataFrame:
    """(a, b): links between distinct fingerprints, as many in each shard as span its components."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting = None, []

        def searched() -> pa.RecordBatch:
            found = forest(np.unique(np.concatenate(waiting)))
            a = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)])
            b = np.concatenate([y for _, y in found] or [np.zeros(0, np.uint64)])
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            shards = batch["shard"].to_numpy()
            bits = batch["bits"].to_numpy().view(np.uint64)
            edges = np.append(np.nonzero(np.diff(shards, prepend=shards[:1] - 1))[0], len(shards))
            for low, high in zip(edges, edges[1:]):
                if shards[low] != shard:
                    if sum(map(len, waiting)) > 1:
                        yield searched()
                    shard, waiting = shards[low], []
                waiting.append(bits[low:high])
        if sum(map(len, waiting)) > 1:
            yield searched()

    dealt = shards_of(prints, levels).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(search, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Fingerprints link at 2 or fewer differing bits; component_id is the smallest doc_id that links
    reach. Copies share a fingerprint and meet before any search. Rows without an id take part as others
    do and get their component's id, null only where nothing in it has one. Empty tables give no rows.
    """
    rows = stage(fingerprints(docs, words))
    prints = stage(rows.groupBy("bits").agg(F.min("doc_id").alias("first")))
    found = components(links(prints.select("bits"), levels_for(prints.count())))
    labels = prints.join(found.select(F.col("node").alias("bits"), "root"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    firsts = labels.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = stage(labels.join(firsts, "root").select("bits", "component_id"))
    printed = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return rows.join(by_print, "bits").select("doc_id", printed.alias("fingerprint"), "component_id")


def kept_one_each(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest id; rows without an id stay, of repeated rows all."""
    found = near_duplicates(docs, words)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
