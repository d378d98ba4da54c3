"""Scores of texts under a two-level n-gram trie, trained on the corpus by Spark and searched in memory-mapped files.

Level 1 holds every training token: a sorted sequence of 64-bit word hashes; a word's id is its place. Level 2 holds the
pairs seen ``LEAST`` times or more, that is all: the sequence of context id * V + word id, which is monotone, so the pairs of
a context are its successors, searched relative to it. Both are Elias-Fano coded. A pair carries the
discounted probability (count - DISCOUNT) / count of its context, rounded down to one of 255 steps; what a context doesn't
spend on its pairs weighs the probability of the word alone:

    P(w | c) = share(c, w) + (1 - sum of shares of c) * (count(w) + 1) / (N + V + 1)

Pairs are counted per batch of documents, dealt to shards by a hash of the pair, so that no frequent context burdens
a task, and each shard becomes one file. Counting and training gather from all training documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortry.scale import stage

from .elias_fano import Sorted, write_sorted
from .storage import attempt_name, create, freed, new_folder, rows_in_slices, texts

LEAST, DISCOUNT = 1, 0.75
#: Tokens a map step counts together, and bytes of text it splits at once.
BATCH_TOKENS, BATCH_BYTES = 4_000_000, 4 << 20
#: The end of a text, also the context of its first word; words hold no blank.
END = b" "
#: Steps of the logarithm that shares are rounded down to: 255 steps from 1 down to 10**-10.
STEPS, DECADES = 255, 10.0


def held_out(doc_id: Column) -> Column:
    """Documents that training leaves out; one without an id isn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words_of(text: str) -> list[bytes]:
    """A-Z lowered, split at ASCII white space, and the end."""
    return [*text.encode().lower().split(), END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 7)


def share_code(share: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(-np.log10(share) * STEPS / DECADES - 1e-9), 0, STEPS).astype(np.uint8)


def share_of(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (-code.astype(np.float64) * DECADES / STEPS)


@dataclass
class Shards:
    """Files of one level with what the driver keeps of each: path, first key and number of entries before it."""

    paths: list[str]
    firsts: list[int]
    bases: list[int]


@dataclass
class Model:
    tokens: int
    vocabulary: int
    words: Shards
    pairs: list[str | None]
    rests: dict[int, str]


_OPEN: dict[str, Sorted | np.ndarray] = {}


def _open(path: str) -> Sorted:
    if path not in _OPEN:
        _OPEN[path] = Sorted(path)
    return _OPEN[path]


def find_words(model: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Id (-1: unknown) and training count of each word hash."""
    ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    if not model.words.paths:
        return ids, counts
    shard = np.searchsorted(np.array(model.words.firsts, np.uint64), hashes, "right") - 1
    order = np.argsort(shard, kind="stable")
    for number, at in _by_value(shard[order], order):
        if number >= 0:
            level = _open(model.words.paths[number])
            found = level.find(hashes[at])
            known = found >= 0
            ids[at[known]] = found[known] + model.words.bases[number]
            counts[at[known]] = level.payload[found[known]]
    return ids, counts


def _by_value(values: np.ndarray, carried: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.nonzero(np.diff(values, prepend=values[:1] - 1))[0] if len(values) else []
    for low, high in zip(cuts, [*cuts[1:], len(values)]):
        yield int(values[low]), carried[low:high]


def pair_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def sent() -> pa.RecordBatch:
        hashes = np.fromiter(map(word_hash, counts), np.uint64, len(counts)).view(np.int64)
        return pa.record_batch([pa.array(hashes), pa.array(list(counts.values()), pa.int64())], ["hash", "count"])

    for batch in rows_in_slices(batches):
        for text in batch["text"].to_pylist():
            counts.update(words_of(text))
        if len(counts) > 400_000:
            yield sent()
            counts.clear()
    if counts:
        yield sent()


def _train_words(train: DataFrame, folder: str, parts: int) -> tuple[Shards, int, int]:
    """Level 1: one file per range of hashes."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = [], []
        for batch in batches:
            # The order of signed hashes, moved to that of unsigned ones.
            hashes.append(batch["hash"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63))
            counts.append(batch["count"].to_numpy())
        if hashes:
            values, payload = np.concatenate(hashes), np.concatenate(counts)
            uri = attempt_name(folder + "/words", ".ef")
            write_sorted(uri, values, payload)
            yield pa.record_batch([[uri], [len(values)], [int(values[0]) - 2**63], [int(payload.sum())]], ["path", "n", "first", "tokens"])

    counted = stage(train.mapInArrow(_word_counts, "hash long, count long").groupBy("hash").agg(F.sum("count").alias("count")))
    files = stage(counted.repartitionByRange(parts, "hash").sortWithinPartitions("hash").mapInArrow(write, "path string, n long, first long, tokens long"))
    rows = sorted(files.collect(), key=lambda r: r.first)
    bases = np.concatenate([[0], np.cumsum([r.n for r in rows])]).astype(np.int64).tolist()
    return Shards([r.path for r in rows], [r.first + 2**63 for r in rows], bases[:-1]), bases[-1], sum(r.tokens for r in rows)


def _numbered(model: Model, rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and counts of all tokens of the texts, one after the other, and the tokens of each text."""
    split = [words_of(t) for t in rows]
    distinct = list({w for words in split for w in words})
    ids, counts = find_words(model, np.fromiter(map(word_hash, distinct), np.uint64, len(distinct)) ^ np.uint64(1 << 63))
    place = dict(zip(distinct, range(len(distinct))))
    lengths = np.array([len(w) for w in split], np.int64)
    at = np.fromiter((p for words in split for p in map(place.__getitem__, words)), np.int64, int(lengths.sum()))
    return ids[at], counts[at], lengths


def _texts_in_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    docs, rows, size = [], [], 0
    for batch in rows_in_slices(batches):
        for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            docs.append(doc)
            rows.append(text)
            size += len(text)
            if size >= BATCH_BYTES:
                yield docs, rows
                docs, rows, size = [], [], 0
    if rows:
        yield docs, rows


def _contexts(ids: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The id before each token; the end before the first of a text."""
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = end
    return before


def _train_pairs(train: DataFrame, model: Model, folder: str, parts: int) -> DataFrame:
    """Level 2: one file per shard of pairs; rows (shard, path, context, spent) with each context's share in the shard."""
    end = int(find_words(model, np.array([word_hash(END)], np.uint64) ^ np.uint64(1 << 63))[0][0]) if model.tokens else -1
    v = np.uint64(max(1, model.vocabulary))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def sent() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            shard = pair_shard(keys, parts)
            order = np.argsort(shard, kind="stable")
            out = [(number, keys[at].tobytes(), counts[at].astype(np.uint32).tobytes()) for number, at in _by_value(shard[order], order)]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32(), pa.binary(), pa.binary()])], ["shard", "pairs", "counts"])

        for _, rows in _texts_in_steps(batches):
            ids, _, lengths = _numbered(model, rows)
            waiting.append(_contexts(ids, lengths, end).astype(np.uint64) * v + ids.astype(np.uint64))
            size += len(ids)
            if size >= BATCH_TOKENS:
                yield sent()
                waiting, size = [], 0
        if waiting:
            yield sent()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, shard = {}, {}, None
        for batch in batches:
            for row in batch.to_pylist():
                keys.setdefault(row["shard"], []).append(np.frombuffer(row["pairs"], np.uint64))
                counts.setdefault(row["shard"], []).append(np.frombuffer(row["counts"], np.uint32))
        for shard in sorted(keys):
            pairs, inverse = np.unique(np.concatenate(keys.pop(shard)), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate(counts.pop(shard)), minlength=len(pairs))
            kept = total >= LEAST
            pairs, total = pairs[kept], total[kept]
            if not len(pairs):
                continue
            context, inverse = np.unique((pairs // v).astype(np.int64), return_inverse=True)
            code = share_code((total - DISCOUNT) / counts_by_id(model, context)[inverse])
            uri = attempt_name(f"{folder}/pairs", ".ef", shard)
            write_sorted(uri, pairs, code)
            spent = np.bincount(inverse, weights=share_of(code))
            for at in range(0, len(context), 100_000):
                here = slice(at, at + 100_000)
                n = len(context[here])
                yield pa.record_batch([pa.array([shard] * n, pa.int32()), pa.array([uri] * n), pa.array(context[here]), pa.array(spent[here])], ["shard", "path", "context", "spent"])

    blocks = train.mapInArrow(counted, "shard int, pairs binary, counts binary")
    return stage(blocks.repartition(parts, "shard").mapInArrow(write, "shard int, path string, context long, spent double"))


def counts_by_id(model: Model, ids: np.ndarray) -> np.ndarray:
    shard = np.searchsorted(np.array(model.words.bases), ids, "right") - 1
    out = np.empty(len(ids), np.int64)
    order = np.argsort(shard, kind="stable")
    for number, at in _by_value(shard[order], order):
        out[at] = _open(model.words.paths[number]).payload[ids[at] - model.words.bases[number]]
    return out


def _write_rests(spent: DataFrame, model: Model, folder: str) -> dict[int, str]:
    """What each context leaves to the word alone, as one array of floats per file of level 1."""
    bases = model.words.bases
    if not bases:
        return {}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rests: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, used = batch["context"].to_numpy(), batch["spent"].to_numpy()
            shard = np.searchsorted(np.array(bases), ids, "right") - 1
            order = np.argsort(shard, kind="stable")
            for number, at in _by_value(shard[order], order):
                size = (bases[number + 1] if number + 1 < len(bases) else model.vocabulary) - bases[number]
                rests.setdefault(number, np.ones(size, np.float32))[ids[at] - bases[number]] = np.maximum(1.0 - used[at], 1e-9)
        for number, values in rests.items():
            uri = attempt_name(f"{folder}/rests", ".f4", number)
            with create(uri) as out:
                out.write(values.tobytes())
            yield pa.record_batch([pa.array([number], pa.int32()), [uri]], ["part", "path"])

    edges = F.array(*[F.lit(b) for b in bases])
    part = F.size(F.filter(edges, lambda b: b <= F.col("context"))) - 1
    summed = spent.groupBy("context").agg(F.sum("spent").alias("spent"))
    dealt = summed.select("context", "spent", part.alias("part")).repartition(len(bases), "part")
    return {r.part: r.path for r in stage(dealt.mapInArrow(write, "part int, path string")).collect()}


def trained(docs: DataFrame) -> Model:
    """The model of all documents that aren't held out; its files lie in the shared folder."""
    spark = docs.sparkSession
    folder, parts = new_folder(spark, "language-model"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    train = texts(docs).where(~held_out(F.col("doc_id")))
    with freed(spark):
        words, vocabulary, tokens = _train_words(train, folder, parts)
        model = Model(tokens, vocabulary, words, [None] * parts, {})
        spent = _train_pairs(train, model, folder, parts)
        for r in spent.select("shard", "path").distinct().collect():
            model.pairs[r.shard] = r.path
        model.rests = _write_rests(spent.select("context", "spent"), model, folder)
    return model


def _rest(model: Model, ids: np.ndarray) -> np.ndarray:
    out = np.ones(len(ids))
    shard = np.searchsorted(np.array(model.words.bases), ids, "right") - 1 if model.words.bases else np.full(len(ids), -1)
    shard[ids < 0] = -1
    order = np.argsort(shard, kind="stable")
    for number, at in _by_value(shard[order], order):
        if number in model.rests:
            path = model.rests[number]
            if path not in _OPEN:
                from .elias_fano import mapped

                _OPEN[path] = mapped(path).view(np.float32)
            out[at] = _OPEN[path][ids[at] - model.words.bases[number]]
    return out


def token_scores(model: Model, rows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token of the texts: training count, log10 of the word alone, log10 after its context; and the tokens of each text."""
    ids, counts, lengths = _numbered(model, rows)
    alone = (counts + 1) / (model.tokens + model.vocabulary + 1)
    end = int(find_words(model, np.array([word_hash(END)], np.uint64) ^ np.uint64(1 << 63))[0][0])
    before = _contexts(ids, lengths, end)
    known = np.nonzero((ids >= 0) & (before >= 0))[0]
    keys, inverse = np.unique(before[known].astype(np.uint64) * np.uint64(max(1, model.vocabulary)) + ids[known].astype(np.uint64), return_inverse=True)
    share = np.zeros(len(keys))
    shard = pair_shard(keys, max(1, len(model.pairs)))
    order = np.argsort(shard, kind="stable")
    for number, at in _by_value(shard[order], order):
        if model.pairs[number] is not None:
            level = _open(model.pairs[number])
            found = level.find(keys[at])
            hit = found >= 0
            share[at[hit]] = share_of(level.payload[found[hit]])
    seen = np.zeros(len(ids))
    seen[known] = share[inverse]
    contexts, inverse = np.unique(before, return_inverse=True)
    after = seen + _rest(model, contexts)[inverse] * alone
    return counts, np.log10(alone), np.log10(after), lengths


OUT = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; a null or empty text is its end alone.

    Repeated rows are scored each, rows without an id too (not held out); no rows give no rows. Only id and text are read, so other columns don't matter.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.float64()] * 2
        for ids, rows in _texts_in_steps(batches):
            counts, alone, after, lengths = token_scores(model, rows)
            edges = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            sums = [np.add.reduceat(x, edges) for x in ((counts > 0).astype(np.int64), alone, after)]
            yield pa.record_batch([pa.array(c, k) for c, k in zip([ids, lengths, *sums], kinds)], [p.split()[0] for p in OUT.split(", ")])

    out = texts(docs).mapInArrow(score, OUT)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
