"""Benchmark items in documents: SimHash fingerprints of item-sized windows, found through multi-index blocks, then verified.

Words are lower-cased and split at ASCII white space, and an item is found where a window of as many words
has a weighted similarity of ``SIMILARITY`` or more over five-word shingles (sum of the smaller counts over sum
of the larger).

1. Such a window holds at least that share of an item's shingles. Shingle hashes of documents are
   joined with those of the items, and only windows that begin at a shared shingle and hold enough
   of them go on. Moving a window's begin to its first shared shingle loses none, so no item is missed.
   Windows with equal words are one from here on.
2. Each such window, and each item, gets a 64-bit fingerprint of its words. The fingerprint is cut in four blocks of 16
   bits. Two fingerprints within ``RADIUS`` bits have a block within RADIUS // 4 bits, so items are
   indexed under all values that near, and a window looks up its four blocks: every pair within the radius is met.
3. Of the pairs met within the radius, the weighted similarity decides.

Items with fewer than five words are one shingle, all their words, and are found only in a document that equals them, not in a longer one. DataFrame operations only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from cohortry.scale import stage

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 15
BLOCKS, BLOCK_BITS = 4, 16
#: Counters of a fingerprint in one long: lanes of 16 bits, enough for windows of 65,535 words.
LANE = 0x0001000100010001


def _words(text: Column) -> Column:
    """Words, A-Z lowered; other letters stay."""
    plain = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """A hash per run of five words, or one for all words of a shorter text; none for no words."""
    count = F.size(words) - (SHINGLE - 1)
    long = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)]))
    return F.when(count >= 1, long).when(F.size(words) > 0, F.array(F.xxhash64(words)))


def _bits(words: Column) -> Column:
    """SimHash of words: a bit is 1 if it is set in over half of their hashes."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    total = F.size(words)

    def lanes(b: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(LANE)))

    def bit(lane: int, b: int, sums: Column) -> Column:
        count = F.shiftrightunsigned(F.get(sums, F.lit(b)), 16 * lane).bitwiseAND(F.lit(0xFFFF))
        return F.when(count * 2 > total, F.lit(_signed(1 << (16 * lane + b)))).otherwise(F.lit(0).cast("long"))

    def folded(sums: Column) -> Column:
        out = F.lit(0).cast("long")
        for lane in range(4):
            for b in range(BLOCK_BITS):
                out = out.bitwiseOR(bit(lane, b, sums))
        return out

    return F.get(F.transform(F.array(F.array(*map(lanes, range(BLOCK_BITS)))), folded), F.lit(0))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _block_values(bits: str) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(bits, BLOCK_BITS * i).bitwiseAND(F.lit(0xFFFF)).alias("value")) for i in range(BLOCKS)])


def near_masks(radius: int = RADIUS) -> list[int]:
    """All changes of a block that a pair within the radius can have in its nearest block."""
    return [sum(1 << b for b in c) for n in range(radius // BLOCKS + 1) for c in combinations(range(BLOCK_BITS), n)]


def indexed_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, shingles, bits) of every item that has a word."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    return stage(items.select("item_id", F.size("words").alias("n_words"), _shingles(F.col("words")).alias("shingles"), _bits(F.col("words")).alias("bits")))


def candidate_windows(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, start, n_words, words) of the item-sized windows that share enough shingles; the last of a text may be cut short."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("print"), _words(F.col("text")).alias("words")
    )
    sizes = items.select(F.explode("shingles").alias("hash"), "n_words").distinct()
    shared = rows.select("doc_id", "print", F.posexplode(_shingles(F.col("words"))).alias("at", "hash")).join(sizes, "hash")
    places = shared.groupBy("doc_id", "print", "n_words").agg(F.sort_array(F.collect_set("at")).alias("at"))
    span = F.greatest(F.col("n_words") - (SHINGLE - 1), F.lit(1))
    need = F.greatest(F.ceil(span * similarity - F.lit(1e-9)).cast("int"), F.lit(1))
    # The need-th shared shingle from here on still lies in the window.
    full = F.filter("at", lambda a, i: F.get(F.col("at"), i + need - 1) - a < span)
    begins = places.select("doc_id", "print", F.explode(F.transform(full, lambda a: F.struct(a.alias("start"), F.col("n_words").alias("n_words")))).alias("window"))
    grouped = begins.groupBy("doc_id", "print").agg(F.collect_list("window").alias("windows"))
    found = grouped.select(F.col("doc_id").alias("_doc"), F.col("print").alias("_print"), "windows")
    # Rows of equal id and text have equal windows; one of them stands for all.
    own = rows["doc_id"].eqNullSafe(found["_doc"]) & (rows["print"] == found["_print"])
    window = rows.join(found, own).select("doc_id", "words", F.explode("windows").alias("w"))
    return window.select("doc_id", F.col("w.start").alias("start"), F.col("w.n_words").alias("n_words"), F.slice("words", F.col("w.start") + 1, F.col("w.n_words")).alias("words"))


def _shared(a: str, b: str) -> Column:
    """How many shingles two lists have in common, repeats counted."""
    once = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda name, x: F.size(F.filter(name, lambda y: y == x))
    many = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, x: s + F.least(count(a, x), count(b, x)))
    return F.when(once, F.size(F.array_intersect(a, b))).otherwise(many)


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start, n_words, distance, similarity): the best window of each document for each item it holds.

    Of equally similar windows the first. Null or empty texts and items hold nothing and are held by nothing; repeated rows
    are reported once, documents without an id with a null id. An empty table of documents or items gives no rows. Only ids and texts are read.
    """
    items = indexed_items(benchmark)
    found = stage(candidate_windows(docs, items, similarity))
    distinct = found.select("n_words", "words").distinct()
    prints = stage(distinct.select("n_words", "words", _bits(F.col("words")).alias("bits"), _shingles(F.col("words")).alias("shingles")))
    masks = F.explode(F.array(*[F.lit(m).cast("long") for m in near_masks(radius)])).alias("mask")
    index = items.select("item_id", "n_words", "bits", F.explode(_block_values("bits")).alias("b")).select("item_id", "n_words", "bits", "b", masks)
    index = index.select("item_id", "n_words", F.col("bits").alias("item_bits"), F.col("b.block").alias("block"), F.col("b.value").bitwiseXOR(F.col("mask")).alias("value"))
    looked = prints.select("n_words", "words", "bits", F.explode(_block_values("bits")).alias("b")).select("n_words", "words", "bits", "b.block", "b.value")
    distance = F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))).cast("int")
    # The index grows with the benchmark, and its size isn't known before it is made: never broadcast.
    met = looked.join(index.hint("merge"), ["n_words", "block", "value"]).withColumn("distance", distance).where(F.col("distance") <= radius)
    pairs = met.select("n_words", "words", "item_id", "distance").distinct()
    sides = pairs.join(prints.select("n_words", "words", "shingles"), ["n_words", "words"]).join(items.select("item_id", F.col("shingles").alias("item_shingles")), "item_id")
    shared = _shared("shingles", "item_shingles")
    alike = shared / (F.size("shingles") + F.size("item_shingles") - shared)
    good = sides.withColumn("similarity", alike).where(F.col("similarity") >= similarity - 1e-12).select("n_words", "words", "item_id", "distance", "similarity")
    best = F.min_by(F.struct("start", "n_words", "distance", "similarity"), F.struct(-F.col("similarity"), "start")).alias("best")
    return found.join(good, ["n_words", "words"]).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item; rows without an id stay."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti")
