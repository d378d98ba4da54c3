"""A hash-tree manifest of a dataset, with nested-interval labels.

Documents are leaves. Each source has a tree of its own, whose leaves ascend by doc_id, and the tops of
these trees are the leaves of one more tree. A node is labelled with its level and with the interval [lo, hi)
of leaf ranks that it covers. Levels are taken in tiers of ``height``; on each tier the rows are bucketed by
``lo div 3^(levels below the tier's end)``, so that a bucket holds at most 3^height rows and all their
ancestors of that tier. Ancestors are attached by a containment join within the bucket: of each level the
node whose interval holds the row's. What a parent's interval holds besides the row's own node are the siblings.
A document with many levels above it takes part in one such join per tier, not in one per level.

Ranks come from one range sort of ids and digests, so that a source may hold any share of the rows; texts
are only read where leaves are hashed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cohortry.scale import stage

from .storage import freed, ship

FAN, HEIGHT = 3, 7
#: Rows of one result batch.
ROWS = 4_096


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels(size: int) -> int:
    """Levels above the leaves of a tree with ``size`` leaves."""
    up = 0
    while size > 1:
        size, up = -(-size // FAN), up + 1
    return up


def _field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, shown): the leaf of each document, and the leaf of what a reader is shown.

    The shown copy is tampered with where 2 divides the checksum of the id: line ends are deleted from its text.
    A null text stays null, and a document without an id is shown unchanged.
    """

    def leaf(text: Column) -> Column:
        return F.sha2(F.concat(*map(_field, (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))), 256)

    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    plain = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), "lang", "n_chars", "text")
    made = plain.select("source", "doc_id", leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("shown"))
    return made.select("source", "doc_id", "leaf", F.coalesce("shown", "leaf").alias("shown"))


def ranked(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Adds tree (a number that ascends with ``group``, null first), lo (the rank in it, from 0) and size (its rows).

    One range sort; of each sorted partition only the number of rows per group is gathered.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = stage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("part", F.shiftrightunsigned("at", 33))
    runs = placed.groupBy(F.col(group).alias("g"), F.col("part").alias("p")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select("g", "p", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.min("first").over(whole).alias("tree"), F.sum("n").over(whole).alias("size")))
    joined = placed.join(runs, placed[group].eqNullSafe(runs["g"]) & (placed["part"] == runs["p"]))
    return joined.withColumn("lo", F.col("at") + F.col("shift")).drop("g", "p", "part", "at", "shift")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one (tree, bucket) at a time; a partition comes sorted by both."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, bucket = batch["tree"].to_numpy(), batch["bucket"].to_numpy()
        edges = [0, *(np.flatnonzero((np.diff(tree) != 0) | (np.diff(bucket) != 0)) + 1).tolist(), len(tree)]
        for a, b in zip(edges, edges[1:]):
            key = (tree[a], bucket[a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), schema.types)], schema.names)


NODE = pa.schema([("tree", pa.int64()), ("size", pa.int64()), ("level", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("digest", pa.string())])
NODE_SQL = "tree long, size long, level int, lo long, hi long, digest string"


def _risen(batches: Iterator[pa.RecordBatch], tier: int, height: int) -> Iterator[pa.RecordBatch]:
    """All nodes of the tier above each bucket's rows."""

    def nodes() -> Iterator[tuple]:
        for bucket in _buckets(batches):
            tree, size = bucket["tree"][0].as_py(), bucket["size"][0].as_py()
            lo, hi, digest = (bucket[c].to_pylist() for c in ("lo", "hi", "digest"))
            for up in range(1, min(height, levels(size) - height * tier) + 1):
                runs = range(0, len(lo), FAN)
                lo, hi, digest = lo[::FAN], [hi[min(i + FAN, len(hi)) - 1] for i in runs], [hashed("".join(digest[i : i + FAN])) for i in runs]
                for row in zip(lo, hi, digest):
                    yield tree, size, height * tier + up, *row

    return _batched(nodes(), NODE)


class Tree:
    """The trees over ranked rows (tree, size, lo, digest): their nodes, tier by tier, and their tops."""

    def __init__(self, rows: DataFrame, height: int = HEIGHT):
        ship(rows.sparkSession)
        self.height = height
        self.rows = rows.select("tree", "size", F.lit(0).alias("level"), "lo", (F.col("lo") + 1).alias("hi"), "digest")
        most = rows.agg(F.max("size")).first()[0] or 1
        self.tiers: list[DataFrame] = []
        for tier in range(max(1, -(-levels(most) // height))):
            self.tiers.append(stage(self._dealt(self.starting(tier), tier, "lo").mapInArrow(partial(_risen, tier=tier, height=height), NODE_SQL)))

    def _dealt(self, rows: DataFrame, tier: int, *order: str) -> DataFrame:
        dealt = rows.withColumn("bucket", F.expr(f"lo div {FAN ** (self.height * (tier + 1))}L"))
        return dealt.repartition("tree", "bucket").sortWithinPartitions("tree", "bucket", *order)

    def starting(self, tier: int) -> DataFrame:
        """The rows that the tier stands on: leaves, or the last level of the tier below unless it is the top."""
        return self.tiers[tier - 1].where(f"level = {self.height * tier} and hi - lo < size") if tier else self.rows

    def nodes(self) -> DataFrame:
        """Every node with its labels, leaves included."""
        out = self.rows
        for tier in self.tiers:
            out = out.union(tier)
        return out

    def tops(self, tier: int | None = None) -> DataFrame:
        """(tree, top) of the trees that end on the tier, or of all."""
        if tier is None:
            out = self.tops(0)
            for t in range(1, len(self.tiers)):
                out = out.union(self.tops(t))
            return out
        ended = self.tiers[tier].where("hi - lo = size")
        if tier == 0:
            ended = ended.union(self.rows.where("size = 1"))
        return ended.select("tree", F.col("digest").alias("top"))

    def paths(self, above: DataFrame, rows: DataFrame) -> DataFrame:
        """For ``rows`` (tree, lo, digest and more) what stands beside their way up, as ``left,right;`` per level.

        ``above`` (tree, top, path) says what stands above each tree's top.
        """
        carried = None
        for tier in reversed(range(len(self.tiers))):
            ends = self.tops(tier).select("tree", F.lit(0).cast("long").alias("lo")).join(above, "tree")
            if carried is not None:
                ends = ends.unionByName(carried.select("tree", "lo", "top", "path"))
            start = rows if tier == 0 else self.starting(tier).select("tree", "lo", "digest")
            extra = [c for c in start.columns if c not in ("tree", "lo", "digest")]
            met = ends.withColumn("kind", F.lit(0)).unionByName(self.tiers[tier].select("tree", "level", "lo", "hi", "digest").withColumn("kind", F.lit(1)), True)
            met = met.unionByName(start.withColumn("kind", F.lit(2)), True)
            kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in start.schema)
            carried = self._dealt(met, tier, "kind", "level", "lo").mapInArrow(partial(_attached, extra=extra), f"{kinds}, top string, path string")
        return carried


def _attached(batches: Iterator[pa.RecordBatch], extra: list[str]) -> Iterator[pa.RecordBatch]:
    """Containment join of a bucket's rows with its nodes, from the last level down."""
    for bucket in _buckets(batches):
        kind = bucket["kind"].to_numpy()
        first, second = np.searchsorted(kind, [1, 2])
        top, above = bucket["top"][0].as_py(), bucket["path"][0].as_py()
        labels, rows = bucket.slice(first, second - first), bucket.slice(second)
        level, lo, hi = (labels[c].to_numpy() for c in ("level", "lo", "hi"))
        digest = labels["digest"].to_pylist()
        edges = [0, *(np.flatnonzero(np.diff(level)) + 1).tolist(), len(level)] if len(level) else [0]
        tiers = [(lo[a:b], hi[a:b], digest[a:b]) for a, b in zip(edges, edges[1:])]
        starts = rows["lo"].to_numpy()
        # Of the rows themselves only the starts are needed to tell which node holds them.
        tiers.insert(0, (starts, None, rows["digest"].to_pylist()))
        paths = [above]
        for (inner_lo, _, inner), (outer_lo, outer_hi, _) in zip(tiers[-2::-1], tiers[:0:-1]):
            parent = np.searchsorted(outer_lo, inner_lo, "right") - 1
            begin = np.searchsorted(inner_lo, outer_lo, "left").tolist()
            end = np.searchsorted(inner_lo, outer_hi, "left").tolist()
            paths = [f"{''.join(inner[begin[p]:i])},{''.join(inner[i + 1:end[p]])};{paths[p]}" for i, p in enumerate(parent.tolist())]
        for at in range(0, len(paths), 512):
            part = rows.slice(at, 512)
            n = part.num_rows
            columns = {"tree": part["tree"], "lo": part["lo"], "digest": part["digest"]} | {c: part[c] for c in extra}
            table = pa.table({c: columns[c] for c in part.column_names if c in columns} | {"top": pa.array([top] * n), "path": pa.array(paths[at : at + n])})
            yield from table.combine_chunks().to_batches()


def _checked(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    """Digest of each way up, and the root that the shown leaf leads to."""
    for batch in batches:
        proof, folded = [], []
        for path, own in zip(batch["path"].to_pylist(), batch["shown"].to_pylist()):
            proof.append(hashed(path.replace(",", "").replace(";", "")))
            for step in path.split(";")[:-1]:
                left, right = step.split(",")
                own = hashed(left + own + right)
            folded.append(own)
        n = batch.num_rows
        yield pa.record_batch(
            [batch["doc_id"], batch["digest"], batch["top"], pa.array([root] * n, pa.string()), pa.array(proof, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_()), batch["lo"]],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "leaf_rank"],
        )


def _trees(docs: DataFrame, height: int) -> tuple[DataFrame, Tree, DataFrame, Tree]:
    rows = ranked(leaves(docs), "source", "doc_id", "leaf", "shown").withColumnRenamed("leaf", "digest")
    tree = Tree(rows, height)
    tops = tree.tops().select(F.lit(0).alias("one"), F.col("tree").alias("member"), F.col("top").alias("digest"))
    sources = ranked(tops, "one", "member").drop("one")
    return rows, tree, sources, Tree(sources, height)


def nodes(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The manifest: (source, level, lo, hi, digest) of every node of every source's tree.

    Rows without a source form a tree too; equal ids are ordered by the leaf's digest. No rows give no nodes.
    """
    with freed(docs.sparkSession):
        rows, tree, _, _ = _trees(docs, height)
        names = rows.select("tree", "source").distinct()
        return stage(tree.nodes().join(names, "tree").select("source", "level", "lo", "hi", "digest"))


def proofs(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """For each row its leaf, the tops it stands under, and the check of the copy that is shown to a reader.

    One row per row of ``docs``: repeated ids and repeated rows are leaves of their own (ordered by digest), null
    ids come first in their source and are shown unchanged, null fields are hashed as ``-``, and empty or very long texts are
    hashed whole. Only the five hashed columns are read, so other columns and their names don't matter. No rows give no rows.
    """
    spark: SparkSession = docs.sparkSession
    with freed(spark):
        rows, tree, sources, roots = _trees(docs, height)
        root = roots.tops().first()
        top = root["top"] if root else ""
        start = sources.select("tree").distinct().select("tree", F.lit(top).alias("top"), F.lit("").alias("path"))
        above = roots.paths(start, sources.select("tree", "lo", "digest", "member")).select(F.col("member").alias("tree"), F.col("digest").alias("top"), "path")
        ways = tree.paths(stage(above), rows.select("tree", "lo", "digest", "doc_id", "shown"))
        out = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, leaf_rank long"
        return stage(ways.mapInArrow(partial(_checked, root=top), out))
