"""Near duplicates by word shingles beside the fingerprints: Jaccard similarity of ``SIMILARITY`` or more over sets of five-word shingles.

Fingerprints of texts with that similarity differ in up to about 15 of 64 bits, at which distance no vantage
point prunes anything. So similar texts are proposed by what they share, and then compared exactly. The first two steps only tie large groups
with few comparisons; steps 4 and 5 find every pair that they leave:

1. A text's sketch is its ``SKETCH`` shingles with the least hash. Of two texts that similar, the first ``KEYS`` of
   the sketches have one in common with a chance of over 0.99999.
2. Texts that share a key meet. The one whose sketch is most typical of them leads, and proposes itself to those whose
   sketches resemble its own. The rest, which has little more in common than, say, one line, is parted by what else is in
   the sketches and goes on in smaller groups. So a group proposes about as many pairs as it has members, whatever its size.
3. Proposed pairs are compared over all their shingles; those that hold tie texts to groups.
4. The shingles of all texts are put in one order, those known as frequent last. Of two texts that similar, the first
   n - ceil(SIMILARITY * n) + 1 shingles of each have one in common, and what follows their first common one is long enough
   for the overlap that they need. All texts that have such a shingle meet, however many, and those pairs of different
   groups whose sizes and places allow the similarity are proposed. Any order gives the same pairs in the end.
5. These are compared over all their shingles, too.

Texts with equal shingle sets are one from the beginning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import stage

from .components import components
from .simhash import near_duplicates, shingle_hashes
from .storage import freed, rows_in_slices, texts

WORDS, SIMILARITY = 5, 0.8
SKETCH, KEYS = 32, 8
#: Sketches that overlap less than this aren't compared; texts of similarity 0.8 overlap by about 0.89.
RESEMBLES = 0.5
LEADERS = 3
#: Members of a group that meet at once in step 2; the leaders of one block meet the next one.
BLOCK = 20_000
#: Members of a shingle's group in step 4 that meet in one task; of larger groups every chunk meets every other.
CHUNK = 4_000
#: Shingles with a known frequency, at most, and those counted together.
ORDERED, BATCH = 500_000, 4_000_000
MEMBER = np.dtype([("token", "<u4"), ("mark", "<i8"), ("label", "<i8"), ("size", "<u4"), ("at", "<u4")])


def frequent(docs: DataFrame, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, ascending, and how often they were met; occurrences alone in their batch aren't counted."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def sent() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.record_batch([pa.array(hashes[counts > 1].view(np.int64)), pa.array(counts[counts > 1])], ["hash", "n"])

        for batch in rows_in_slices(batches):
            for text in batch["text"].to_pylist():
                waiting.append(np.unique(shingle_hashes(text, words)))
                size += len(waiting[-1])
                if size >= BATCH:
                    yield sent()
                    waiting, size = [], 0
        if size:
            yield sent()

    counted = stage(texts(docs).mapInArrow(repeated, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")))
    levels = counted.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("n").alias("n")).collect()
    least, total = 64, 0
    for r in sorted(levels, key=lambda r: -r.level):
        total += r.n
        if total > ORDERED:
            break
        least = r.level
    table = counted.where(F.floor(F.log2("n")) >= least).toArrow()
    hashes, counts = table["hash"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def prefix(shingles: np.ndarray, order: tuple[np.ndarray, np.ndarray], similarity: float) -> np.ndarray:
    """The shingles of which a text of that similarity must have one; ``shingles`` ascend."""
    hashes, counts = order
    rank = np.zeros(len(shingles), np.int64)
    if len(hashes):
        at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
        rank = np.where(hashes[at] == shingles, counts[at], 0)
    keep = len(shingles) - int(np.ceil(similarity * len(shingles) - 1e-9)) + 1 if len(shingles) else 0
    return shingles[np.argsort(rank, kind="stable")[:keep]]


def sketches(docs: DataFrame, words: int, similarity: float, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, shingles, size, sketch, prefix): a hash of the set of shingles, its size, its sketch and its prefix."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_slices(batches):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch["text"].to_pylist()]
            marks = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 for s in sets]
            firsts = [s[:SKETCH].view(np.int64).tolist() for s in sets]
            prefixes = [prefix(s, order, similarity).tobytes() for s in sets]
            yield pa.record_batch(
                [batch["doc_id"], pa.array(marks, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(firsts, pa.list_(pa.int64())), pa.array(prefixes, pa.binary())],
                ["doc_id", "shingles", "size", "sketch", "prefix"],
            )

    return texts(docs).mapInArrow(compute, "doc_id long, shingles long, size long, sketch array<long>, prefix binary")


def _led(members: np.ndarray, found: np.ndarray, turn: int) -> list[tuple[int, int]]:
    """Pairs (member, leader) of row numbers within one group; ``found`` has a row of sketch items per text, -1 where there are fewer.

    Of equally typical texts LEADERS lead, beginning at one that differs from key to key by ``turn``.
    """
    pairs: list[tuple[int, int]] = []
    todo = [members]
    while todo:
        group = todo.pop()
        items = found[group]
        there = items >= 0
        values, inverse = np.unique(items, return_inverse=True)
        inverse = inverse.reshape(items.shape)
        times = np.bincount(inverse[there], minlength=len(values))
        lengths = there.sum(axis=1)
        typical = (times[inverse] * there).sum(axis=1) / lengths
        best = np.nonzero(typical >= typical.max() - 1e-9)[0]
        rest = np.ones(len(group), bool)
        for leader in {int(best[(turn + k) % len(best)]) for k in range(LEADERS)}:
            own = np.zeros(len(values), bool)
            own[inverse[leader][there[leader]]] = True
            overlap = (own[inverse] & there).sum(axis=1)
            like = overlap >= RESEMBLES * np.minimum(lengths, lengths[leader])
            pairs += [(int(i), int(group[leader])) for i in group[like] if i != group[leader]]
            rest &= ~like
        if rest.sum() < 2:
            continue
        # What half of the group has doesn't part it; every later group is half as large at most.
        parting = there & (times[inverse] * 2 <= len(group)) & (times[inverse] > 1)
        for _ in range(2):
            has = rest & parting.any(axis=1)
            first = parting.argmax(axis=1)
            key = inverse[np.arange(len(group)), first]
            order = np.nonzero(has)[0][np.argsort(key[has], kind="stable")]
            for part in np.split(order, np.nonzero(np.diff(key[order]))[0] + 1):
                if len(part) > 1:
                    todo.append(group[part])
            parting[np.arange(len(group)), first] = False
    return pairs


def proposals(classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of different shingle sets, proposed by the keys they share."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, marks, found = None, [], []

        def led() -> tuple[pa.RecordBatch, list[int]]:
            table = np.full((len(found), SKETCH), -1, np.int64)
            for at, hashes in enumerate(found):
                # Only equality counts, and non-negative numbers leave -1 free.
                table[at, : len(hashes)] = np.array(hashes, np.int64) & (2**63 - 1)
            pairs = _led(np.arange(len(found)), table, key % 8191)
            return pa.record_batch([pa.array([marks[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"]), sorted({p[1] for p in pairs})

        for batch in batches:
            for k, mark, hashes in zip(batch["key"].to_pylist(), batch["shingles"].to_pylist(), batch["sketch"].to_pylist()):
                if k != key or len(marks) >= BLOCK:
                    leaders: list[int] = []
                    if len(marks) > 1:
                        pairs, leaders = led()
                        yield pairs
                    keep = leaders if k == key and len(leaders) < BLOCK // 2 else []
                    key, marks, found = k, [marks[i] for i in keep], [found[i] for i in keep]
                marks.append(mark)
                found.append(hashes)
        if len(marks) > 1:
            yield led()[0]

    keyed = classes.select(F.explode(F.slice("sketch", 1, KEYS)).alias("key"), "shingles", "sketch")
    # Keys of one text only propose nothing, and are most of them.
    shared = keyed.groupBy("key").agg(F.count("key").alias("n")).where("n > 1").select("key")
    met = keyed.join(shared, "key", "left_semi").repartition("key").sortWithinPartitions("key", "shingles")
    return met.mapInArrow(search, "a long, b long").distinct()


def _allowed(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Where two members of one shingle may be similar texts of different groups, this shingle being their first common one."""
    sizes, other = a["size"].astype(np.int64), b["size"].astype(np.int64)
    need = np.ceil(similarity / (1 + similarity) * (sizes + other) - 1e-9)
    return (a["label"] != b["label"]) & (np.minimum(sizes - a["at"], other - b["at"]) >= need)


def _marks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.column_stack([np.minimum(a["mark"], b["mark"]), np.maximum(a["mark"], b["mark"])])


def _within(members: np.ndarray, similarity: float) -> Iterator[np.ndarray]:
    """Pairs of marks in groups of equal tokens; ``members`` ascend by token and size."""
    token, size = members["token"], members["size"].astype(np.int64)
    at, step = np.arange(len(members)), 1
    while len(at):
        at = at[at + step < len(members)]
        # Later ones are larger still, so where one is too large the search ends.
        at = at[(token[at] == token[at + step]) & (size[at] >= similarity * size[at + step] - 1e-9)]
        a, b = members[at], members[at + step]
        good = _allowed(a, b, similarity)
        if good.any():
            yield _marks(a[good], b[good])
        step += 1


def _between(left: np.ndarray, right: np.ndarray, similarity: float) -> Iterator[np.ndarray]:
    for at in range(0, len(left), 64):
        a, b = left[at : at + 64, None], right[None, :]
        i, j = np.nonzero(_allowed(a, b, similarity))
        if len(i):
            yield _marks(left[at + i], right[j])


def _pair_batch(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], ["a", "b"])


def crossing(classes: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """Distinct pairs (a, b) of shingle sets with different labels that their prefixes don't rule out, all there are.

    ``classes`` has (shingles, label, size, prefix). Members of a shingle come together in one shard; above ``chunk`` they are
    cut in chunks, and each chunk meets each other one whose sizes allow it in a task of its own.
    """
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def sent() -> pa.RecordBatch:
            tokens = np.concatenate([t for t, *_ in waiting])
            members = np.empty(len(tokens), MEMBER)
            lengths = [len(t) for t, *_ in waiting]
            members["token"] = tokens & np.uint64(0xFFFFFFFF)
            members["at"] = np.concatenate([np.arange(n) for n in lengths])
            for k, name in enumerate(("mark", "label", "size"), 1):
                members[name] = np.repeat([w[k] for w in waiting], lengths)
            shard = ((tokens >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            edges = np.nonzero(np.diff(shard[order], prepend=-1))[0]
            blobs = [members[at].tobytes() for at in np.split(order, edges[1:])]
            return pa.record_batch([pa.array(shard[order][edges], pa.int32()), pa.array(blobs, pa.binary())], ["shard", "members"])

        for batch in batches:
            for mark, label, n, tokens in zip(*(batch[c].to_pylist() for c in ("shingles", "label", "size", "prefix"))):
                waiting.append((np.frombuffer(tokens, np.uint64), mark, label, n))
                size += len(waiting[-1][0])
                if size >= BATCH // 4:
                    yield sent()
                    waiting, size = [], 0
        if waiting:
            yield sent()

    names = ["a", "b", "shard", "token", "part", "least", "most", "members"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for shard, blob in zip(batch["shard"].to_pylist(), batch["members"].to_pylist()):
                blobs.setdefault(shard, []).append(np.frombuffer(blob, MEMBER))
        for shard in sorted(blobs):
            members = np.concatenate(blobs.pop(shard))
            members = members[np.lexsort((members["size"], members["token"]))]
            starts = np.nonzero(np.diff(members["token"].astype(np.int64), prepend=-1))[0]
            counts = np.diff(np.append(starts, len(members)))
            # Where all are of one group already there is nothing to find.
            mixed = np.minimum.reduceat(members["label"], starts) != np.maximum.reduceat(members["label"], starts)
            for pairs in _within(members[np.repeat(mixed & (counts <= chunk), counts)], similarity):
                n = len(pairs)
                yield pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())] + [pa.nulls(n, k) for k in kinds[2:]], names)
            for group in np.nonzero(mixed & (counts > chunk))[0]:
                for part, at in enumerate(range(starts[group], starts[group] + counts[group], chunk)):
                    own = members[at : min(at + chunk, starts[group] + counts[group])]
                    row = [None, None, shard, int(own["token"][0]), part, int(own["size"][0]), int(own["size"][-1]), own.tobytes()]
                    yield pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names)

    def chunks_met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y, same in zip(*(batch[c].to_pylist() for c in ("x", "y", "same"))):
                x, y = np.frombuffer(x, MEMBER), np.frombuffer(y, MEMBER)
                for pairs in _within(x, similarity) if same else _between(x, y, similarity):
                    yield _pair_batch(pairs)

    blocks = classes.mapInArrow(dealt, "shard int, members binary").repartition(parts, "shard")
    schema = "a long, b long, shard int, token long, part int, least long, most long, members binary"
    found = stage(blocks.mapInArrow(met, schema))
    large = found.where("members is not null")
    x, y = (large.select("shard", "token", F.col("part").alias(f"{k}_part"), F.col("least").alias(f"{k}_least"), F.col("most").alias(f"{k}_most"), F.col("members").alias(k)) for k in "xy")
    # Chunks ascend by size.
    both = x.join(y, ["shard", "token"]).where((F.col("x_part") <= F.col("y_part")) & (F.col("x_most") >= F.lit(similarity) * F.col("y_least") - F.lit(1e-9)))
    both = both.select("x", "y", (F.col("x_part") == F.col("y_part")).alias("same")).repartition(parts, F.xxhash64("x", "y"))
    return found.where("members is null").select("a", "b").union(both.mapInArrow(chunks_met, "a long, b long")).distinct()


def verified(docs: DataFrame, rows: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """Those of ``pairs`` whose whole sets of shingles are similar."""
    needed = pairs.select(F.col("a").alias("shingles")).union(pairs.select("b")).distinct()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_slices(batches):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch["text"].to_pylist()]
            marks = [xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 for s in sets]
            yield pa.record_batch([pa.array(marks, pa.int64()), pa.array([s.view(np.int64).tolist() for s in sets], pa.list_(pa.int64()))], ["shingles", "hashes"])

    # The whole sets are computed again, for one document of each set that was proposed.
    firsts = rows.join(needed, "shingles", "left_semi").groupBy("shingles").agg(F.min("doc_id").alias("doc_id")).select("doc_id").where("doc_id is not null").distinct()
    sets = stage(texts(docs).join(firsts, "doc_id", "left_semi").mapInArrow(whole, "shingles long, hashes array<long>").join(needed, "shingles", "left_semi").dropDuplicates(["shingles"]))
    both = pairs.join(sets.select(F.col("shingles").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("shingles").alias("b"), F.col("hashes").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    alike = both.where(shared >= F.lit(similarity) * (F.size("x") + F.size("y") - shared) - F.lit(1e-9))
    return alike.select("a", "b")


def similar_pairs(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, shingles) of every row, and verified pairs (a, b) of different shingle sets that tie all similar ones."""
    with freed(docs.sparkSession):
        rows = stage(sketches(docs, words, similarity, frequent(docs, words)))
        named = rows.where("size > 0 and doc_id is not null")
        alike = stage(verified(docs, rows, stage(proposals(named.groupBy("shingles").agg(F.any_value("sketch").alias("sketch")))), words, similarity))
        labels = components(alike).select(F.col("node").alias("shingles"), "root")
        classes = named.groupBy("shingles").agg(F.any_value("size").alias("size"), F.any_value("prefix").alias("prefix")).join(labels, "shingles", "left")
        pairs = stage(crossing(classes.select("shingles", F.coalesce("root", "shingles").alias("label"), "size", "prefix"), similarity))
        more = stage(verified(docs, rows, pairs, words, similarity))
    return rows.select("doc_id", "shingles"), alike.union(more)


def linked(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, radius_links: DataFrame | None = None) -> DataFrame:
    """(doc_id, component_id) of every row: texts with equal shingle sets, similar ones, and those that ``radius_links`` ties.

    ``radius_links`` has pairs (a, b) of doc_ids. component_id is the smallest doc_id reachable. Texts without words are
    equal; rows without an id are left out, since nothing can name them.
    """
    rows, pairs = similar_pairs(docs, words, similarity)
    rows = rows.where("doc_id is not null")
    heads = rows.groupBy("shingles").agg(F.min("doc_id").alias("head"))
    same = rows.join(heads, "shingles").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    a, b = (heads.select(F.col("shingles").alias(x), F.col("head").alias(f"{x}_head")) for x in "ab")
    ties = same.union(pairs.join(a, "a").join(b, "b").select("a_head", "b_head"))
    found = components(ties if radius_links is None else ties.union(radius_links.select("a", "b")))
    own = found.select(F.col("node").alias("doc_id"), "root")
    return rows.join(own, "doc_id", "left").select("doc_id", F.coalesce("root", "doc_id").alias("component_id"))


def kept_one_each(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id.

    Groups are tied by fingerprints of at most 2 differing bits, found in the overlapping vantage-point partition, and by
    shingle similarity. Rows without an id stay, of repeated rows all.
    """
    near = near_duplicates(docs, words).where("doc_id is not null and doc_id <> component_id")
    ties = near.select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    gone = linked(docs, words, similarity, ties).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
