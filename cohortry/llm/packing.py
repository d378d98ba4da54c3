"""Packing token ids into fixed windows by best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of it, and every shorter
document, is a piece. Pieces are dealt to shards of bounded size by a hash, and in each shard placed
longest first into the open window whose remaining capacity is the tightest that fits. A segment tree
over remaining capacities finds that window in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .storage import byte_slices, texts
from .tokens import encoder

WINDOW = 4096
#: Documents a shard holds on average; only a shard's last few windows can be badly filled.
SHARD_DOCS = 16_384

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class CapacityTree:
    """Open windows by remaining capacity; ``tightest(n)`` is the least capacity of n or more that is open."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.open[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        node = self.leaves + least
        if self.open[node]:
            return least
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit(lengths: Iterable[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """The window number and the offset in it of each length, for lengths given in descending order."""
    tree, holds, placed, windows = CapacityTree(window), {}, [], 0
    for length in lengths:
        room = tree.tightest(length)
        if room is None:
            number, room, windows = windows, window, windows + 1
        else:
            number = holds[room].pop()
            tree.add(room, -1)
        placed.append((number, window - room))
        if room > length:
            holds.setdefault(room - length, []).append(number)
            tree.add(room - length, 1)
    return placed


def tokenized_pieces(docs: DataFrame, path: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, start, length, doc_tokens, ids): each document's ids and its end id, cut at full windows.

    ids are little-endian unsigned 32-bit. A null or empty text is its end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        for batch in byte_slices(batches):
            ids, edges = encoding.encode_ended(batch["text"], end_id)
            totals = np.diff(edges)
            counts = -(-totals // window)
            owner = np.repeat(np.arange(len(totals)), counts)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * window
            length = np.minimum(window, totals[owner] - start)
            # Pieces lie one after the other, so their bytes are one buffer.
            data = pa.BinaryArray.from_buffers(pa.binary(), len(owner), [None, pa.py_buffer((4 * np.append(0, np.cumsum(length))).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
            yield pa.record_batch([batch["doc_id"].take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(totals[owner]), data], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return texts(docs).mapInArrow(cut, PIECES)


def packed(pieces: DataFrame, shards: int, window: int = WINDOW, *more: Column) -> DataFrame:
    """``pieces`` with sequence_id and offset; all its columns stay.

    Needs doc_id, start and length (1 to ``window``); ``more`` tells pieces of equal id and start apart, so that rows without an id
    or of one id spread over shards. Repeated rows are packed each on its own. The
    sequence id is the shard's number times 2**32 plus the window's number in the shard; equal input
    gives equal windows whatever order the shuffle delivers. No rows give no rows.
    """
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        full, waiting = 0, []

        def named(batch: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([*batch.columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], schema.names)

        for batch in batches:
            lengths = batch["length"].to_numpy(zero_copy_only=False)
            whole = lengths == window
            if whole.any():
                # A full window needs no search and doesn't wait.
                n = int(whole.sum())
                yield named(batch.filter(pa.array(whole)), base + full + np.arange(n), np.zeros(n, np.int64))
                full += n
            if not whole.all():
                waiting.append(batch.filter(pa.array(~whole)))
        if waiting:
            rest = pa.Table.from_batches(waiting).combine_chunks()
            order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")]
            rest = rest.sort_by(order)
            at = np.array(best_fit(rest["length"].to_pylist(), window), np.int64)
            seen = 0
            for batch in rest.to_batches(max_chunksize=4096):
                here = at[seen : seen + batch.num_rows]
                yield named(batch, base + full + here[:, 0], here[:, 1])
                seen += batch.num_rows

    dealt = pieces.repartition(max(1, shards), F.xxhash64("doc_id", "start", *more))
    return dealt.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Every piece of every document with its ids, its sequence and its offset there."""
    return packed(tokenized_pieces(docs, path, end_id, window), -(-docs.count() // shard_docs), window, F.crc32("ids"))


def packing_digest(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """As ``pack_documents``, but with a checksum in place of the ids, taken before the shuffle."""
    pieces = tokenized_pieces(docs, path, end_id, window).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return packed(pieces, -(-docs.count() // shard_docs), window, F.col("ids_crc32"))
