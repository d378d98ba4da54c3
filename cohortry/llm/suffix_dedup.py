"""Removal of repeated passages: bytes covered by a string of ``LENGTH`` bytes that also starts in an earlier document.

1. Every string of 50 bytes is represented by an anchor, the 20-byte gram with the least hash in it, so equal
   strings have equal anchors at equal places. Anchors are about a sixteenth of the bytes. Those seen in one
   document only are dropped; a batch of documents sends an anchor that it holds often once, so a passage
   that a third of the documents share burdens no task.
2. Around each anchor left, the segment that holds all its strings (80 bytes) is taken; equal segments are one, with
   their smallest document.
3. Different segments of one anchor meet in one task. A suffix array over them is built by two-stage sorting: only suffixes smaller
   than their successors are sorted directly, all others follow from scanning the buckets in order. Adjacent
   common prefixes of 50 bytes or more then give the smallest document of each string.
   An anchor with more different segments than one array should hold is parted by where the anchor lies in a string: strings
   with it in one half of the places have bytes to its right in common with any equal string, those of the other half bytes to its left, so
   only segments with the same such bytes meet, with only these strings. Parts that are still too large are halved again; strings with the
   anchor at one place that share all those bytes are equal.
4. Each document's strings with a smaller document are joined to spans and cut out.

Exact copies of a text are resolved beforehand by their checksum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import scratch, stage

from .storage import freed, new_folder, rows_in_slices, ship

LENGTH, GRAM = 50, 20
#: Anchors a string can have: grams in it.
REACH = LENGTH - GRAM + 1
#: Bytes of text a map step collapses together, and segments that are solved together (one suffix array of at most 2 MB, unless an anchor has more).
BATCH_BYTES, ARRAY_ROWS = 8 << 20, 24_576
NO_ID = 2**63 - 1
#: Different segments that one suffix array holds of one anchor; larger anchors, such as the edge of a very common line, are parted.
LARGE = 30_000


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A mixed 64-bit hash of each run of ``gram`` bytes, built by doubling."""
    base, power, width = 0x9E3779B97F4A7C15, data.astype(np.uint64) + np.uint64(1), 1
    out, done, left = None, 0, gram
    while left:
        if left & 1:
            n = len(data) - (done + width) + 1
            out = power if out is None else out[:n] * np.uint64(pow(base, width, 1 << 64)) + power[done : done + n]
            done += width
        left >>= 1
        if left:
            power = power[:-width] * np.uint64(pow(base, width, 1 << 64)) + power[width:]
            width *= 2
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        out = (out ^ (out >> np.uint64(33))) * np.uint64(factor)
    return out ^ (out >> np.uint64(33))


def sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or, by np.maximum, largest) of each run of ``width`` values."""
    out, span = values, 1
    while span * 2 <= width:
        out = least(out[:-span], out[span:])
        span *= 2
    n = len(values) - width + 1
    return least(out[:n], out[width - span : width - span + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are the least of some string of LENGTH bytes (all of equal ones)."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    least = sliding(hashes, REACH, np.minimum)
    edge = np.zeros(REACH - 1, np.uint64)
    best = sliding(np.concatenate([edge, least, edge]), REACH, np.maximum)
    at = np.nonzero(best == hashes)[0]
    return at, hashes[at]


def suffix_order(text: np.ndarray, words: list[np.ndarray] | None = None) -> np.ndarray:
    """Suffixes of ``text`` (small non-negative integers) in the order of their first LENGTH values at least, by two-stage sorting.

    ``words`` are its ``prefix_words``, where they are at hand.
    """
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32), append=-1))
    # Equal neighbours take the direction of the next different one; the last suffix has no successor and counts as larger.
    known = np.where(step != 0, np.arange(n), n)
    after = np.minimum.accumulate(known[::-1])[::-1]
    smaller = step[np.minimum(after, n - 1)] > 0
    words = prefix_words(text) if words is None else words
    direct = np.nonzero(smaller)[0]
    direct = direct[np.lexsort([words[k][direct] for k in reversed(range(len(words)))])]
    first = text[direct]
    most = int(text.max(initial=0)) + 1
    s_edges = np.searchsorted(first, np.arange(most + 1))
    waiting: list[list[np.ndarray]] = [[] for _ in range(most)]
    last = n - 1
    waiting[int(text[last])].append(np.array([last]))
    order = []

    def deal(block: np.ndarray, value: int) -> None:
        """Predecessors that are larger than these suffixes and begin with a larger value wait for their bucket, in order."""
        before = block[block > 0] - 1
        before = before[text[before] > value]
        values = text[before]
        by_value = np.argsort(values, kind="stable")
        before, values = before[by_value], values[by_value]
        cuts = np.nonzero(np.diff(values, prepend=-1))[0]
        for low, high in zip(cuts, np.append(cuts[1:], len(values))):
            waiting[int(values[low])].append(before[low:high])

    for value in range(most):
        front = np.concatenate(waiting[value]) if waiting[value] else np.zeros(0, np.int64)
        waiting[value] = []
        while len(front):
            order.append(front)
            deal(front, value)
            # Runs of one value: the predecessor in the same bucket is larger too, and comes next.
            before = front[front > 0] - 1
            front = before[(text[before] == value) & ~smaller[before]]
        block = direct[s_edges[value] : s_edges[value + 1]]
        if len(block):
            order.append(block)
            deal(block, value)
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def prefix_words(text: np.ndarray) -> list[np.ndarray]:
    """The first LENGTH values of each suffix as sortable integers, as many values to a word of 64 bits as their number of kinds allows."""
    n, kinds = len(text), max(2, int(text.max(initial=0)) + 1)
    fits = max(k for k in range(1, LENGTH + 1) if kinds**k <= 1 << 64)
    padded = np.concatenate([text.astype(np.uint64), np.zeros(LENGTH + fits, np.uint64)])
    full, rest = np.zeros(n + LENGTH, np.uint64), LENGTH % fits
    short = full
    for k in range(fits):
        full *= np.uint64(kinds)
        full += padded[k : k + n + LENGTH]
        if k + 1 == rest:
            short = full.copy()
    words = [full[fits * k : fits * k + n] for k in range(LENGTH // fits)]
    return [*words, short[LENGTH - rest : LENGTH - rest + n]] if rest else words


def long_prefixes(words: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """For each suffix in order, whether it shares LENGTH values or more with the one before it."""
    same = np.ones(len(order), bool)
    same[:1] = False
    for word in words:
        ordered = word[order]
        same[1:] &= ordered[1:] == ordered[:-1]
    return same


def earliest(segments: list[bytes], firsts: np.ndarray) -> list[np.ndarray]:
    """For each segment the smallest document of each of its strings of LENGTH bytes, over all segments given."""
    lengths = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\x00".join(segments) + b"\x00", np.uint8).astype(np.int16) + 1
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    text[starts + lengths] = 0
    # Only the bytes in use are numbered, so that more of them fit a word and fewer words are sorted by.
    used = np.bincount(text) > 0
    text = (np.cumsum(used) - 1).astype(np.int16)[text]
    owner = np.repeat(np.arange(len(segments)), lengths + 1)
    room = (starts + lengths)[owner] - np.arange(len(text))
    words = prefix_words(text)
    order = suffix_order(text, words)
    same = long_prefixes(words, order)
    run = np.cumsum(~same) - 1
    least = np.full(int(run[-1]) + 1, NO_ID, np.int64)
    np.minimum.at(least, run, firsts[owner[order]])
    out = np.empty(len(text), np.int64)
    out[order] = least[run]
    return [out[s : s + max(0, n - LENGTH + 1)] for s, n in zip(starts, lengths)]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc, print, text): documents without an id count as later than all others."""
    ship(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("print"), text.alias("text"))


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, bytes]]]:
    rows, size = [], 0
    for batch in rows_in_slices(batches):
        for doc, mark, text in zip(batch["doc"].to_pylist(), batch["print"].to_pylist(), batch["text"].to_pylist()):
            data = text.encode()
            rows.append((doc, mark, data))
            size += len(data)
            if size >= BATCH_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _anchor_blocks(parts: int):
    """Rows (part, docs, prints, high, low, places, owners, sure): anchors of a batch, dealt by hash.

    48 bits of a hash travel, in two parts; chance matches only bring segments that are then found to differ.
    An anchor in several texts of the batch is surely repeated: all its places are marked so and dealt by document, and one
    more entry with place -1 tells the hash's own part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "docs", "prints", "high", "low", "places", "owners", "sure"]
        for rows in _batched(batches):
            # Of equal texts in the batch only the one with the smallest id matters here.
            least: dict[bytes, tuple[int, int]] = {}
            for doc, mark, data in rows:
                if data not in least or doc < least[data][0]:
                    least[data] = (doc, mark)
            found = [(doc, mark, *anchors(np.frombuffer(data, np.uint8))) for data, (doc, mark) in least.items()]
            counts = [len(at) for *_, at, _ in found]
            if not sum(counts):
                continue
            docs, prints = np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64)
            owners = np.repeat(np.arange(len(found), dtype=np.uint32), counts)
            places = np.concatenate([f[2] for f in found]).astype(np.int32)
            hashes = np.concatenate([f[3] for f in found])
            _, inverse, times = np.unique(hashes, return_inverse=True, return_counts=True)
            # The smallest and largest document of each hash differ where several texts hold it.
            order = np.argsort(inverse, kind="stable")
            edges = np.concatenate([[0], np.cumsum(times)[:-1]])
            low, high = np.minimum.reduceat(docs[owners[order]], edges), np.maximum.reduceat(docs[owners[order]], edges)
            sure = (low != high)[inverse]
            told = order[edges][low != high]
            part = np.where(sure, docs[owners].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20), hashes >> np.uint64(16)) % np.uint64(parts)
            all_parts = np.concatenate([part, (hashes[told] >> np.uint64(16)) % np.uint64(parts)])
            all_hashes = np.concatenate([hashes, hashes[told]])
            all_places = np.concatenate([places, np.full(len(told), -1, np.int32)])
            all_owners = np.concatenate([owners, owners[told]])
            all_sure = np.concatenate([sure, np.ones(len(told), bool)])
            by_part = np.argsort(all_parts, kind="stable")
            cuts = np.nonzero(np.diff(all_parts[by_part].astype(np.int64), prepend=-1))[0]
            out = []
            for begin, end in zip(cuts, np.append(cuts[1:], len(by_part))):
                here = by_part[begin:end]
                own, index = np.unique(all_owners[here], return_inverse=True)
                out.append((int(all_parts[here[0]]), docs[own].tobytes(), prints[own].tobytes(), (all_hashes[here] >> np.uint64(32)).astype(np.uint32).tobytes(), (all_hashes[here] >> np.uint64(16)).astype(np.uint16).tobytes(), all_places[here].tobytes(), index.astype(np.uint32).tobytes(), np.packbits(all_sure[here]).tobytes()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), [pa.int32()] + [pa.binary()] * 7)], names)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, print, place) of the anchors of one part that several documents hold."""
    docs, prints, hashes, places, sure = [], [], [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            owners = np.frombuffer(row["owners"], np.uint32)
            docs.append(np.frombuffer(row["docs"], np.int64)[owners])
            prints.append(np.frombuffer(row["prints"], np.int64)[owners])
            high, low = np.frombuffer(row["high"], np.uint32), np.frombuffer(row["low"], np.uint16)
            hashes.append(high.astype(np.uint64) << np.uint64(16) | low)
            places.append(np.frombuffer(row["places"], np.int32))
            sure.append(np.unpackbits(np.frombuffer(row["sure"], np.uint8), count=len(owners)).astype(bool))
    if not docs:
        return
    docs, prints, hashes, places, sure = (np.concatenate(x) for x in (docs, prints, hashes, places, sure))
    order = np.argsort(hashes, kind="stable")
    edges = np.nonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))[0]
    group = np.cumsum(np.concatenate([[True], np.diff(hashes[order]) != 0])) - 1
    several = np.minimum.reduceat(docs[order], edges) != np.maximum.reduceat(docs[order], edges)
    told = np.maximum.reduceat((sure & (places < 0))[order].astype(np.uint8), edges).astype(bool)
    keep = np.empty(len(order), bool)
    keep[order] = (several | told)[group]
    keep = (keep | sure) & (places >= 0)
    for at in range(0, int(keep.sum()), 100_000):
        here = np.nonzero(keep)[0][at : at + 100_000]
        yield pa.record_batch([pa.array(docs[here]), pa.array(prints[here]), pa.array(places[here])], ["doc", "print", "place"])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, print, begin, anchor, mark, segment, place, first): every anchor's segment; its bytes stand with one of the equal ones of a batch.

    ``mark`` is a hash of the segment and of the anchor's place in it.
    """
    names = ["doc", "print", "begin", "anchor", "mark", "segment", "place", "first"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    for batch in rows_in_slices(batches, 4096):
        rows, first = [], {}
        for doc, mark, text, places in zip(*(batch[c].to_pylist() for c in ("doc", "print", "text", "places"))):
            data = text.encode()
            # A repeated id can bring the places of its other text.
            at = sorted({p for p in places if p + GRAM <= len(data)})
            if not at:
                continue
            hashes = gram_hashes(np.frombuffer(data, np.uint8)).view(np.int64)[at].tolist()
            for place, anchor in zip(at, hashes):
                begin = max(0, place - REACH + 1)
                segment = data[begin : place + LENGTH]
                if len(segment) >= LENGTH:
                    key = (anchor, segment, place - begin)
                    if key not in first or doc < first[key]:
                        first[key] = doc
                    rows.append((doc, mark, begin, anchor, segment, place - begin))
        out = []
        for doc, mark, begin, anchor, segment, place in rows:
            least = first.pop((anchor, segment, place), None)
            out.append((doc, mark, begin, anchor, xxhash.xxh3_64_intdigest(segment, place) - 2**63, segment if least is not None else None, place, least))
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _solved(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The runs of whole anchors."""
    names, kinds = ["anchor", "mark", "since", "until", "first"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    anchor, mark, first = (rows[c].to_numpy() for c in ("anchor", "mark", "first"))
    segment = rows["segment"].combine_chunks()
    order = np.lexsort((mark, anchor))
    fresh = np.concatenate([[True], (np.diff(anchor[order]) != 0) | (np.diff(mark[order]) != 0)])
    one = order[fresh]  # a row of each different segment
    least = np.minimum.reduceat(first[order], np.flatnonzero(fresh))
    anchor, mark = anchor[one], mark[one]
    begins = np.flatnonzero(np.concatenate([[True], np.diff(anchor) != 0]))
    counts = np.diff(np.append(begins, len(anchor)))
    # One segment alone has no other to share a string with.
    alone = begins[counts == 1]
    until = pc.binary_length(segment.take(pa.array(one[alone]))).to_numpy(zero_copy_only=False) - (LENGTH - 1)
    yield pa.record_batch([pa.array(c, k) for c, k in zip((anchor[alone], mark[alone], np.zeros(len(alone), np.int32), until, least[alone]), kinds)], names)
    several = np.flatnonzero(np.repeat(counts > 1, counts))
    if len(several):
        found = earliest(segment.take(pa.array(one[several])).to_pylist(), least[several])
        lengths = np.array([len(x) for x in found])
        values, ends = np.concatenate(found), np.cumsum(lengths)
        cut = np.concatenate([[True], np.diff(values) != 0])
        cut[ends[:-1]] = True
        at = np.flatnonzero(cut)
        owner = np.searchsorted(ends, at, "right")
        since = at - (ends - lengths)[owner]
        until = np.append(at[1:], len(values)) - (ends - lengths)[owner]
        own = several[owner]
        yield pa.record_batch([pa.array(c, k) for c, k in zip((anchor[own], mark[own], since, until, values[at]), kinds)], names)


def _sorted_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, mark, since, until, first): the smallest document of each string of each segment, as runs of places.

    Rows come sorted by anchor; whole anchors are gathered until a suffix array is full.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, ARRAY_ROWS):
            part = batch.slice(at, ARRAY_ROWS)
            held.append(part)
            size += part.num_rows
            if size < ARRAY_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            anchor = rows["anchor"].to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1]))
            if whole:
                yield from _solved(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
                size = rows.num_rows - whole
    if held:
        yield from _solved(pa.Table.from_batches(held))


RUNS = "anchor long, mark long, since int, until int, first long"


def _least(own: DataFrame, parts: int) -> DataFrame:
    dealt = own.select("anchor", "mark", "segment", "first").repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(_sorted_segments, RUNS)


def _too_large(own: DataFrame, large: int) -> DataFrame:
    counts = own.select("anchor", "mark").distinct().groupBy("anchor").agg(F.count("anchor").alias("n"))
    return stage(counts.where(F.col("n") > large).select("anchor"))


def _halved(rows: DataFrame, low: int, high: int) -> DataFrame:
    """Strings with the anchor at places ``low`` to ``high`` of them, keyed by the bytes that any two equal ones share.

    ``rows`` has anchor (a key), whole, mark, segment, place and first; ``whole`` and ``mark`` name the original segment. The new segment
    holds just these strings, ``skip`` of the original one's come before it.
    """
    size = F.octet_length("segment")
    least, most = F.greatest(F.lit(low), F.col("place") + LENGTH - size), F.least(F.lit(high), F.col("place"))
    cut = rows.withColumn("least", least).withColumn("most", most).where("least <= most")
    beside = F.substring("segment", F.col("place") - low + 1, F.lit(low + GRAM + REACH - 1 - high))
    segment = F.substring("segment", F.col("place") - F.col("most") + 1, F.col("most") - F.col("least") + LENGTH)
    return cut.select(
        F.xxhash64("anchor", F.lit(low), F.lit(high), beside).alias("anchor"), "whole", "mark", segment.alias("segment"), F.col("most").alias("place"),
        "first", (F.col("skip") + F.col("place") - F.col("most")).alias("skip"),
    )


def _parted(own: DataFrame, parts: int, large: int) -> DataFrame:
    """The same answer as ``_least`` for anchors with very many segments, from parts that share bytes beside the anchor."""
    waiting = [(0, REACH - 1, own.withColumn("whole", F.col("anchor")).withColumn("skip", F.lit(0)))]
    found = None
    while waiting:
        low, high, rows = waiting.pop()
        middle = (low + high) // 2
        for begin, end in ((low, middle), (middle + 1, high)):
            half = stage(_halved(rows, begin, end).withColumn("cell", F.xxhash64("segment", "place")))
            cells = half.select("anchor", F.col("cell").alias("mark"), "segment", "first")
            hot = _too_large(cells, large)
            small = half.join(hot, "anchor", "left_anti")
            runs = _least(cells.join(hot, "anchor", "left_anti"), parts).withColumnRenamed("mark", "cell").drop("whole")
            done = small.select("anchor", "whole", "mark", "skip", "cell").distinct().join(runs, ["anchor", "cell"])
            done = stage(done.select(F.col("whole").alias("anchor"), "mark", (F.col("skip") + F.col("since")).alias("since"), (F.col("skip") + F.col("until")).alias("until"), "first"))
            found = done if found is None else found.unionByName(done)
            if begin < end and hot.limit(1).count():
                waiting.append((begin, end, half.join(hot, "anchor", "left_semi").drop("cell")))
    return found


SPANS = "doc long, print long, copy boolean, spans array<struct<since:int,until:int>>"


def repeated_spans(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """(doc, print, copy, spans): texts with something to remove; ``copy`` where the whole text is one of an earlier document.

    Only this result is left in the shared folder; everything it was made of is deleted.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    path = new_folder(spark, "spans")
    with freed(spark), scratch(spark):
        whole = stage(keyed.select("doc", "print", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.octet_length("text").alias("n_bytes")))
        firsts = whole.groupBy("sha").agg(F.min("doc").alias("least"))
        copies = stage(whole.join(firsts, "sha").where((F.col("doc") > F.col("least")) & (F.col("n_bytes") >= LENGTH)).select("doc", "print").distinct())
        blocks = keyed.mapInArrow(_anchor_blocks(parts), "part int, docs binary, prints binary, high binary, low binary, places binary, owners binary, sure binary")
        kept = blocks.repartition(parts, "part").mapInArrow(_repeated, "doc long, print long, place int")
        places = kept.groupBy("doc", "print").agg(F.collect_list("place").alias("places")).join(copies, ["doc", "print"], "left_anti")
        anchored = keyed.join(places, ["doc", "print"]).select("doc", "print", "text", "places")
        segments = stage(anchored.mapInArrow(_segments, "doc long, print long, begin int, anchor long, mark long, segment binary, place int, first long"))
        own = segments.where(F.col("segment").isNotNull()).select("anchor", "mark", "segment", "place", "first")
        hot = _too_large(own, large)
        least = stage(_least(own.join(hot, "anchor", "left_anti"), parts))
        if hot.limit(1).count():
            least = least.unionByName(_parted(own.join(hot, "anchor", "left_semi"), parts, large))
        places = segments.select("doc", "print", "begin", "anchor", "mark").join(least, ["anchor", "mark"]).where("first < doc")
        span = F.struct((F.col("begin") + F.col("since")).alias("since"), (F.col("begin") + F.col("until") - 1 + LENGTH).alias("until"))
        spans = places.groupBy("doc", "print").agg(F.collect_set(span).alias("spans")).select("doc", "print", F.lit(False).alias("copy"), "spans")
        spans.unionByName(copies.select("doc", "print", F.lit(True).alias("copy"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))).write.parquet(path)
    return spark.read.schema(SPANS).parquet(path)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal covered runs, in order; runs that touch are one."""
    out: list[tuple[int, int]] = []
    for since, until in sorted(spans):
        if out and since <= out[-1][1]:
            out[-1] = (out[-1][0], max(until, out[-1][1]))
        else:
            out.append((since, until))
    return out


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def deduplicated(docs: DataFrame, with_text: bool = True, large: int = LARGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; ``kept`` is what remains, in bytes, since a cut may split a character.

    Null texts are empty. Rows of equal id don't remove each other's bytes, nor do rows without an id, which come after all others.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_slices(batches):
            rows = []
            for doc, text, copy, spans in zip(*(batch[c].to_pylist() for c in ("doc", "text", "copy", "spans"))):
                data = text.encode()
                runs = [(0, len(data))] if copy else merged([(s["since"], s["until"]) for s in spans or ()])
                edges = [0, *(x for run in runs for x in run), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (None if doc == NO_ID else doc, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = KEPT if with_text else KEPT.rpartition(",")[0]
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = ([pa.int64()] * 4 + [pa.string(), pa.binary()])[: len(names)]
    joined = _keyed(docs).join(repeated_spans(docs, large), ["doc", "print"], "left")
    return joined.select("doc", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans").mapInArrow(cut, schema)
