"""Sorted files against numpy, scores against a plain dictionary model, and that held-out texts gain from the contexts."""

import math
import re
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortry.llm import language_model as L, queries
from cohortry.llm.elias_fano import Sorted, write_sorted

from .conftest import FOLDER


@given(st.sets(st.one_of(st.integers(0, 300), st.integers(0, 2**64 - 1), st.integers(2**40, 2**40 + 500)), max_size=300))
@settings(max_examples=200, deadline=None)
def test_sorted_file(values):
    keys = np.array(sorted(values), np.uint64)
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/a.ef"
    write_sorted(path, keys, np.arange(len(keys), dtype=np.uint16))
    level = Sorted(path)
    assert level.find(keys).tolist() == list(range(len(keys))) == level.payload.tolist()
    around = np.unique(np.concatenate([keys + np.uint64(1), keys - np.uint64(1), np.array([0, 1, 2**63, 2**64 - 1], np.uint64)]))
    want = {int(k): i for i, k in enumerate(keys)}
    assert level.find(around).tolist() == [want.get(int(k), -1) for k in around]


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")), None]


def out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


class Plain:
    def __init__(self, docs):
        train = [tokens(t) for d, t in docs if not out(d)]
        self.count = Counter(w for t in train for w in t)
        self.pairs = Counter(p for t in train for p in zip([None, *t], t))
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.spent = defaultdict(float)
        for (c, w), k in self.pairs.items():
            if k >= L.LEAST:
                self.spent[c] += self.share(c, w)

    def share(self, c, w):
        k = self.pairs[c, w]
        if k < L.LEAST:
            return 0.0
        return float(L.share_of(L.share_code(np.array([(k - L.DISCOUNT) / self.count[c]])))[0])

    def alone(self, w):
        return (self.count[w] + 1) / (self.n + self.v + 1)

    def row(self, d, t):
        words = tokens(t)
        base = sum(math.log10(self.alone(w)) for w in words)
        score = sum(math.log10(self.share(c, w) + max(1 - self.spent[c], 1e-9) * self.alone(w)) for c, w in zip([None, *words], words))
        return d, out(d), len(words), sum(self.count[w] > 0 for w in words), self.n, base, score


def check(rows, docs):
    model = Plain(docs)
    want = sorted((model.row(d, t) for d, t in docs), key=repr)
    got = sorted((tuple(r) for r in rows), key=repr)
    key = lambda r: (repr(r[:5]), round(r[5], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-5)


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op10_language_model(spark, FOLDER).collect()
    check(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_contexts_sum_to_one():
    docs = [(i, t) for i, t in enumerate(["a b a b a c", "a b b", "c a b a b", "b a b c c c"] * 3)]
    model = Plain(docs)
    for c in model.count:
        rest = 1 - model.spent[c]
        total = sum(model.share(c, w) + rest * model.alone(w) for w in model.count) + rest * model.alone("unseen")
        assert total == pytest.approx(1)


def test_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    check(L.scored(odd_docs, L.trained(odd_docs)).collect(), docs)
    assert L.scored(no_docs, L.trained(no_docs)).collect() == []
    rows = L.scored(odd_docs, L.trained(no_docs)).collect()
    assert len(rows) == len(docs) and all(r.train_tokens == 0 and r.score == 0 == r.base_score for r in rows)


def test_a_pair_seen_once_counts(spark):
    docs = [(i, t) for i, t in enumerate(["red fox", "red hen", "old fox", "old hen", "new cat"])]
    train = [(d, t) for d, t in docs if not out(d)]
    pairs = Counter(p for _, t in train for p in zip([None, *tokens(t)], tokens(t)))
    once = next(p for p, k in pairs.items() if k == 1 and p[0] is not None and p[1] is not None)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    count = Counter(w for _, t in train for w in tokens(t))
    model = L.trained(frame)
    _, alone, after, _ = L.token_scores(model, [" ".join(once)])
    share = (1 - L.DISCOUNT) / count[once[0]]
    assert 10 ** after[1] > 10 ** alone[1] and 10 ** after[1] >= 0.9 * share
