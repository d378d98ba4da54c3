"""Token id files: ids packed at the fewest bits the vocabulary needs, in blocks with an offset index.

A file is, in order: a header (magic, bits, ids per block), the packed blocks, and a footer: the byte
offset of each block, and for each document its id, whether it has one, and where its ids end. The
last 32 bytes say where the footer begins and how many blocks, documents and ids there are. Because the
width is fixed, the place of any id follows from its number, and numpy unpacks a block at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import local_frame, stage

from .storage import attempt_name, byte_slices, create, new_folder, opened, ship, spread, texts
from .tokens import encoder

MAGIC = b"TOKBITS1"
HEADER = struct.Struct("<8sII")
TRAILER = struct.Struct("<QQQQ")
BLOCK = 65_536


def bits_for(vocabulary: int) -> int:
    """Bits an id below ``vocabulary`` needs, at least 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """64 ids make ``bits`` 64-bit words; each column of 64 is shifted into place for all groups at once."""
    groups = -(-len(ids) // 64)
    lanes = np.zeros((groups, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((groups, bits), np.uint64)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)[:count]


class TokenWriter:
    """Appends documents to one file; at most one block of ids waits in memory."""

    def __init__(self, uri: str, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = create(uri), bits, block
        self.waiting, self.n_waiting, self.at = [], 0, HEADER.size
        self.offsets, self.docs, self.named, self.ends, self.total = [], [], [], [], 0
        self.out.write(HEADER.pack(MAGIC, bits, block))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.total += len(ids)
        self.docs.append(doc_id or 0)
        self.named.append(doc_id is not None)
        self.ends.append(self.total)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= self.block:
            self._flush(self.n_waiting - self.n_waiting % self.block)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for at in range(0, count, self.block):
            data = pack_bits(ids[at : min(at + self.block, count)], self.bits)
            self.offsets.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.waiting, self.n_waiting = [ids[count:].copy()], len(ids) - count

    def close(self) -> None:
        self._flush(self.n_waiting)
        for values, kind in ((self.offsets, "<u8"), (self.docs, "<i8"), (self.named, "<u1"), (self.ends, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(TRAILER.pack(self.at, len(self.offsets), len(self.docs), self.total))
        self.out.close()


class TokenReader:
    """Random access: reads the footer, then only the blocks that hold the wanted ids."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        footer, blocks, docs, self.total = TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        magic, self.bits, self.block = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        data = self.file.read_at(size - TRAILER.size - footer, footer)
        self.offsets = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(footer)).astype(np.int64)
        self.docs = np.frombuffer(data, "<i8", docs, 8 * blocks)
        self.named = np.frombuffer(data, "<u1", docs, 8 * (blocks + docs)).astype(bool)
        self.ends = np.frombuffer(data, "<u8", docs, 8 * (blocks + docs) + docs).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids number ``first`` to ``last`` (exclusive) of this file."""
        if first >= last:
            return np.zeros(0, np.uint32)
        low, high = first // self.block, (last - 1) // self.block
        data = self.file.read_at(int(self.offsets[high + 1] - self.offsets[low]), int(self.offsets[low]))
        parts = []
        for block in range(low, high + 1):
            here = data[int(self.offsets[block] - self.offsets[low]) : int(self.offsets[block + 1] - self.offsets[low])]
            parts.append(unpack_bits(here, self.bits, min(self.block, self.total - block * self.block)))
        return np.concatenate(parts)[first - low * self.block : last - low * self.block]

    def documents(self, at_once: int = 16 * BLOCK) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of each document, reading many blocks together."""
        starts = np.append(0, self.ends)
        at = 0
        while at < len(self.docs):
            until = max(at + 1, int(np.searchsorted(self.ends, starts[at] + at_once, "right")))
            ids = self.ids(int(starts[at]), int(starts[until]))
            for i in range(at, until):
                yield int(self.docs[i]) if self.named[i] else None, int(starts[i]), ids[starts[i] - starts[at] : starts[i + 1] - starts[at]]
            at = until


def write_token_files(docs: DataFrame, path: str, end_id: int, block: int = BLOCK) -> DataFrame:
    """Writes all documents in ascending doc_id order; one row per file: path, first (ids in the files before it), n_docs, n_tokens.

    Documents are range-partitioned by id, and each range becomes one file. A null or empty text is the
    end id alone; documents without an id come first; of equal ids the text's hash decides.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "token-files")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, writer, uri = encoder(path), None, ""
        for batch in byte_slices(batches):
            if writer is None and batch.num_rows:
                uri = attempt_name(folder, ".tok")
                writer = TokenWriter(uri, bits_for(max(encoding.vocabulary, end_id + 1)), block)
            ids, edges = encoding.encode_ended(batch["text"], end_id)
            for doc, since, until in zip(batch["doc_id"].to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                writer.add(doc, ids[since:until])
        if writer is not None:
            writer.close()
            yield pa.record_batch([[uri], [len(writer.docs)], [writer.total]], ["path", "n_docs", "n_tokens"])

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = texts(docs).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    files = stage(ordered.mapInArrow(write, "path string, n_docs long, n_tokens long"))
    # One row per writing task comes to the driver; names begin with the range's number.
    listed = sorted((r for r in files.collect()), key=lambda r: r.path)
    first = np.append(0, np.cumsum([r.n_tokens for r in listed], dtype=np.int64))[: len(listed)].tolist()
    kinds = {"path": pa.string(), "first": pa.int64(), "n_docs": pa.int64(), "n_tokens": pa.int64()}
    columns = {"path": [r.path for r in listed], "first": first, "n_docs": [r.n_docs for r in listed], "n_tokens": [r.n_tokens for r in listed]}
    return local_frame(spark, columns, kinds)


def read_token_files(files: DataFrame, with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, first in zip(batch["path"].to_pylist(), batch["first"].to_pylist()):
                rows: list[tuple] = []
                for doc, start, ids in TokenReader(uri).documents():
                    raw = ids.astype("<u4").tobytes()
                    rows.append((doc, first + start, len(ids), zlib.crc32(raw), *([raw] if with_ids else [])))
                    if len(rows) == 1024:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names)
    ship(files.sparkSession)
    return spread(files, files.count()).mapInArrow(read, schema)
