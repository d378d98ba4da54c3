"""Contamination against comparing every window of every text with every item."""

import re
from collections import Counter

import numpy as np
import pytest

from cohortry.llm import decontaminate as D, queries

from .conftest import FOLDER


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] * bool(w))


def brute(docs, items):
    """Pairs with a window of the item's size, anywhere, that is similar enough."""
    out = set()
    sized = [(i, len(words(t)), shingles(words(t))) for i, t in items]
    for d, t in docs:
        w = words(t)
        mine = set(shingles(w))
        for i, n, other in sized:
            if n and mine & set(other):
                for at in range(max(1, len(w) - 4)):
                    window = shingles(w[at : at + n])
                    if sum((window & other).values()) >= 0.8 * sum((window | other).values()):
                        out.add((d, i))
                        break
    return out


def test_documents(spark):
    rows = queries.op4_decontaminate(spark, FOLDER).collect()
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").select(*c).collect()]
    assert {(r.doc_id, r.item_id) for r in rows} == brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})


def test_near_copies_cut_ends_and_odd_rows(spark, odd_docs, no_docs):
    chance = np.random.default_rng(2)
    text = lambda n: [f"v{chance.integers(0, 400)}" for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([3, 5, 12, 40, 55, 59, 90, 120])]
    docs = []
    for i, w in items:
        for change in range(6):
            copy = list(w)
            for at in chance.choice(len(w), min(change, len(w)), replace=False):
                copy[at] = "changed"
            docs.append((len(docs), " ".join(text(30) + copy + text(int(chance.integers(0, 30))))))
        for cut in (1, 3, 8):
            docs += [(len(docs), " ".join(w[cut:])), (len(docs) + 1, " ".join(w[: len(w) - cut]))]
    docs.append((len(docs), " ".join((items[3][1] + ["x"] * 3) * 4)))
    docs += [(7, docs[12][1]), (7, docs[12][1]), (None, docs[18][1])]
    items = [(i, " ".join(w).upper() if i % 2 else "\n".join(w)) for i, w in items] + [(100, None), (101, ""), (102, " ".join(["la"] * 20)), (103, " ".join(items[4][1]))]
    docs += [(900, " ".join(["la"] * 19)), (901, " ".join(["la"] * 60)), (902, None), (903, "")]
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n_words int")
    frame = spark.createDataFrame([(*r, 1, 1) for r in docs], "doc_id long, text string, words int, start int")
    rows = D.contaminated(frame, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == brute(docs, items)
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    assert D.contaminated(no_docs, bench).collect() == [] and D.contaminated(odd_docs, bench.limit(0)).collect() == []
    held = {d for d, _ in brute(docs, items)}
    assert sorted(r.doc_id or -1 for r in D.clean(frame, bench).collect()) == sorted(d or -1 for d, _ in docs if d is None or d not in held)
    assert D.contaminated(odd_docs, bench).count() == 0


@pytest.mark.parametrize("radius", [3, 7, 15])
def test_blocks_meet_every_pair_in_the_radius(radius):
    chance = np.random.default_rng(radius)
    masks = set(D.near_masks(radius))
    for _ in range(500):
        bits = chance.choice(64, radius, replace=False)
        blocks = [sum(1 << (int(b) % 16) for b in bits if b // 16 == k) for k in range(4)]
        assert any(b in masks for b in blocks)
