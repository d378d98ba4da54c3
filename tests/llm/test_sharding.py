"""Shards: every row once, gapless slots, near equal bytes, equal texts together unless they are very many."""

import zlib
from collections import Counter, defaultdict

from cohortry.llm import queries, sharding

from .conftest import FOLDER


def check(rows, docs):
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(24))


def bytes_by_shard(rows):
    out = Counter()
    for r in rows:
        out[r.shard] += r.size
    return [out[s] for s in range(24)]


def test_documents(spark):
    rows = queries.op5_sharding(spark, FOLDER).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, docs)
    sizes, largest = bytes_by_shard(rows), max(r.size for r in rows)
    assert max(sizes) - min(sizes) <= largest
    shards, group = defaultdict(set), Counter()
    for r in rows:
        shards[r.text_crc32].add(r.shard)
        group[r.text_crc32] += r.size
    assert all(len(s) == 1 or 8 * 24 * group[c] > sum(sizes) for c, s in shards.items())


def test_one_text_in_most_rows_is_divided(spark):
    docs = [(i, "the same text") for i in range(6000)] + [(i, f"text {i}") for i in range(6000, 12_000)]
    rows = sharding.sharded(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check(rows, docs)
    sizes = bytes_by_shard(rows)
    assert max(sizes) < 1.03 * min(sizes)
    groups = Counter(r.shard for r in rows if r.doc_id < 6000)
    assert len(groups) > 8


def test_odd_rows(odd_docs, no_docs):
    check(sharding.sharded(odd_docs).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert sharding.sharded(no_docs).collect() == []


def test_range_number():
    import numpy as np

    cuts = [(1, -5), (3, -5), (3, 2), (3, 9)]
    keys = [(0, 9), (1, -9), (1, -5), (2, 0), (3, -9), (3, -5), (3, 1), (3, 2), (3, 8), (3, 9), (4, -9)]
    got = sharding.range_number(np.array([g for g, _ in keys]), np.array([p for _, p in keys]), cuts)
    assert got.tolist() == [sum(c <= k for c in cuts) for k in keys]


def test_ranges_are_divided_until_none_is_overfull(spark):
    """Few first draws leave overfull ranges; one text under the large limit in many rows stays together all the same."""
    import random

    chance = random.Random(3)
    docs = [(i, "x" * chance.choice([1, 5, 50, 4000])) for i in range(2000)] + [(3000 + i, "same " * 20) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = sharding.sharded(frame, shards=4, ranges=32).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, _ in docs)
    sizes = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(sizes) <= 1.1 * sum(sizes) / 4
    assert len({r.shard for r in rows if r.doc_id >= 3000}) == 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
