"""Fingerprints and components against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from cohortry.llm import queries, simhash
from cohortry.llm.components import components

from .conftest import FOLDER


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Component of each distinct fingerprint by comparing all with all."""
    values = sorted(set(prints))
    array = np.array(values, np.uint64)
    root = list(range(len(values)))
    for i in range(len(values)):
        for j in np.nonzero(np.bitwise_count(array ^ array[i]) <= 2)[0]:
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    return dict(zip(values, root))


def check(rows, docs):
    prints = [brute_print(t) for _, t in docs]
    comp = brute_components(prints)
    least = {}
    for (d, _), p in zip(docs, prints):
        if d is not None:
            least[comp[p]] = min(d, least.get(comp[p], d))
    want = sorted(((d, f"{p:016x}", least.get(comp[p])) for (d, _), p in zip(docs, prints)), key=repr)
    assert sorted((tuple(r) for r in rows), key=repr) == want


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op1_simhash(spark, FOLDER).collect(), docs)


def test_odd_rows(odd_docs, no_docs):
    check(simhash.near_duplicates(odd_docs).collect(), [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.kept_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.where("doc_id = 2").count() == 0 and kept.where("doc_id is null").count() == 1


@pytest.mark.parametrize("levels", [2, 3, 5, 8])
def test_overlapping_shards_lose_no_link(spark, levels):
    chance = np.random.default_rng(levels)
    seeds = chance.integers(0, 2**64, 40, np.uint64)
    values = [int(v) for v in seeds]
    for v in seeds:
        for _ in range(8):
            x = int(v)
            for b in chance.choice(64, chance.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            values.append(x)
    values += [0, (1 << 64) - 1, 1, 3, 7]
    prints = spark.createDataFrame([(simhash._signed(v),) for v in sorted(set(values))], "bits long")
    found = components(simhash.links(prints, levels)).collect()
    root = {r.node % 2**64: r.root % 2**64 for r in found}
    comp = brute_components(values)
    groups, want = {}, {}
    for v in set(values):
        groups.setdefault(root.get(v, v), set()).add(v)
        want.setdefault(comp[v], set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@given(st.integers(0, 2**32), st.integers(1, 9))
@settings(max_examples=25, deadline=None)
def test_forest_of_a_large_shard(seed, flips):
    chance = np.random.default_rng(seed)
    base = chance.integers(0, 2**64, 6, np.uint64)
    values = np.unique(np.concatenate([base ^ np.bitwise_or.reduce([np.uint64(1) << chance.integers(0, 64, 6).astype(np.uint64) for _ in range(flips)]) for _ in range(300)]))
    parts = simhash.forest(values)
    position = {int(v): i for i, v in enumerate(values)}
    pairs = np.array([(position[int(a)], position[int(b)]) for x, y in parts for a, b in zip(x, y)], np.int64).reshape(-1, 2)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    want = simhash._roots(len(values), np.column_stack(np.nonzero(np.triu(near, 1))))
    assert simhash._roots(len(values), pairs).tolist() == want.tolist()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2001, 2000)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 2001: 2000}
