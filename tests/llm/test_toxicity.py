"""Network and gradients against plain code, words and grams against Python, held-out accuracy, odd rows."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from zlib import crc32

from cohortry.llm import queries, toxicity as T

from .conftest import FOLDER


def small_net(seed=1):
    chance = np.random.default_rng(seed)
    hashes = T.word_hashes(pa.array(["a", "b", "c"]))
    net = T.Network.begun(hashes, np.array([1.0, -1.0, 0.5]), T.word_grams(pa.array(["ab"]))[1], np.full(len(T.word_grams(pa.array(["ab"]))[1]), 0.7))
    net.p = {k: chance.normal(0, 0.6, v.shape) for k, v in net.p.items()}
    return net


def plain_logit(net, rows):
    """Word by word, for one window of gate rows (2, words, gates)."""
    sig = lambda v: 1 / (1 + np.exp(-v))
    both = []
    for d, order in ((0, range(len(rows[0]))), (1, reversed(range(len(rows[0]))))):
        h, out = np.zeros(T.HIDDEN), {}
        for t in order:
            x, y = rows[d][t], h @ net.p["state"][d]
            r, u = sig(x[: T.HIDDEN] + y[: T.HIDDEN]), sig(x[T.HIDDEN : 2 * T.HIDDEN] + y[T.HIDDEN : 2 * T.HIDDEN])
            c = np.tanh(x[2 * T.HIDDEN :] + r * y[2 * T.HIDDEN :])
            h = (1 - u) * c + u * h
            out[t] = h
        both.append([out[t] for t in range(len(rows[0]))])
    seen = np.concatenate(both, axis=1)
    w = np.exp(seen @ net.p["look"])
    return (w / w.sum()) @ seen @ net.p["out"] + net.p["base"][0]


def test_forward_against_plain_loop():
    net, chance = small_net(), np.random.default_rng(2)
    gates = chance.normal(0, 1, (2, 9, 3 * T.HIDDEN))
    words = chance.integers(0, 9, 30)
    begins, sizes = np.array([0, 5, 9, 20, 29]), np.array([5, 3, 11, 9, 1])
    got = net.logits(gates, words, begins, sizes)
    for z, b, n in zip(got, begins, sizes):
        assert np.isclose(z, plain_logit(net, gates[:, words[b : b + n]]), atol=1e-5)


def test_gradients_against_differences(monkeypatch):
    monkeypatch.setattr(np, "float32", np.float64)  # differences of single precision are too coarse
    net, chance = small_net(3), np.random.default_rng(4)
    gates = chance.normal(0, 1, (2, 7, 3 * T.HIDDEN))
    table, sizes = chance.integers(0, 7, (4, 6)), np.array([6, 2, 5, 1])
    toxic, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])

    def loss():
        z = net.forward(gates, table, sizes)[0]
        return (weights * (np.logaddexp(0, z) - toxic * z)).sum() / weights.sum()

    g, dgates = net.gradients(gates, table, sizes, toxic, weights)
    total = np.zeros_like(gates)
    for d in (0, 1):
        np.add.at(total[d], table, dgates[d])
    for array, found in ((net.p["state"], g["state"]), (net.p["look"], g["look"]), (net.p["out"], g["out"]), (net.p["base"], g["base"]), (gates, total)):
        for _ in range(12):
            at = tuple(chance.integers(0, n) for n in array.shape)
            was, eps = array[at], 1e-5
            array[at] = was + eps
            up = loss()
            array[at] = was - eps
            down = loss()
            array[at] = was
            assert np.isclose((up - down) / (2 * eps), found[at], atol=1e-6)


@given(st.lists(st.text(alphabet="ab é!.1ß\n\U0001f600", max_size=40) | st.just(""), max_size=5))
@settings(max_examples=200, deadline=None)
def test_words(rows):
    words, different, edges = T.split_words(pa.array(rows, pa.string()))
    names = different.to_pylist()
    want = [re.findall(r"[^\W_]+", r.lower()) for r in rows]
    assert [[names[w] for w in words[a:b]] for a, b in zip(edges, edges[1:])] == want


def test_grams_and_hashes():
    words = ["a", "an", "idiot", "réeuxê", "x" * 30, "an"]
    owner, h = T.word_grams(pa.array(words))
    names = {}
    for i, w in enumerate(words):
        framed = f"<{w}>".encode()
        grams = [framed[k : k + n] for n in T.GRAMS for k in range(len(framed) - n + 1)]
        found = h[owner == i].tolist()
        assert len(found) == len(grams)
        for gram, value in zip(grams, found):
            assert names.setdefault(gram, value) == value
    assert len(set(names.values())) == len(names)
    hashes = T.word_hashes(pa.array(words)).tolist()
    assert hashes[1] == hashes[5] and len(set(hashes)) == 5
    lookup = T.Lookup(np.array(hashes[:3], np.uint64))
    assert lookup(np.array(hashes, np.uint64)).tolist() == [1, 2, 3, 0, 0, 2]


@given(st.lists(st.integers(0, 300), min_size=1, max_size=6))
@settings(max_examples=100, deadline=None)
def test_windows_hold_every_word_and_overlap_by_half(lengths):
    edges = np.concatenate([[0], np.cumsum(lengths)])
    owner, begins, sizes = T.windows(edges)
    assert set(owner) == set(range(len(lengths)))
    for i, n in enumerate(lengths):
        own = [(b - edges[i], s) for o, b, s in zip(owner, begins, sizes) if o == i]
        assert {w for b, s in own for w in range(b, b + s)} == set(range(n)) and all(s <= T.WINDOW for _, s in own)
        assert [b for b, _ in own] == [k * T.STRIDE for k in range(len(own))] and (n <= T.WINDOW) == (len(own) == 1)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op11_toxicity(spark, folder).collect() if r.held_out and r.doc_id in labels]
    caught = [r.predicted for r in rows if labels[r.doc_id] == 1]
    blamed = [r.predicted for r in rows if labels[r.doc_id] == 0]
    assert sum(caught) >= 0.85 * len(caught) and sum(blamed) <= 0.02 * len(blamed)


def test_query(spark, tiny):
    rows = queries.op11_toxicity(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in tiny("documents").collect())
    for r in rows:
        assert r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)


@pytest.mark.parametrize("some", [True, False])
def test_odd_rows(odd_docs, no_docs, tiny, some):
    net = T.trained(tiny("documents"), tiny("labels") if some else tiny("labels").limit(0))
    rows = T.scored(odd_docs, net).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((r.doc_id for r in odd_docs.collect()), key=repr)
    empty = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert next(r for r in rows if r.doc_id is None).held_out is False
    assert next(r for r in rows if r.doc_id == 6).windows == -(-(60_000 - T.WINDOW) // T.STRIDE) + 1
    assert T.scored(no_docs, net).collect() == []
    assert T.trained(no_docs, tiny("labels")).p["words"].shape == (1, T.EMBED)
