"""Suffix order against plain sorting, and removals against looking every 50-byte string up."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortry.llm import queries, suffix_dedup as D

from .conftest import FOLDER


@given(st.lists(st.integers(0, 3), min_size=1, max_size=120))
@settings(max_examples=300, deadline=None)
def test_two_stage_order(values):
    text = np.array(values, np.int16)
    order = D.suffix_order(text).tolist()
    assert sorted(order) == list(range(len(values)))
    keys = [tuple(values[i : i + D.LENGTH]) for i in order]
    assert keys == sorted(keys)


@given(st.lists(st.binary(min_size=50, max_size=80), min_size=1, max_size=6), st.integers(0, 9))
@settings(max_examples=150, deadline=None)
def test_earliest(parts, seed):
    chance = np.random.default_rng(seed)
    segments = list({(a + b)[-90:] if chance.random() < 0.7 else a for a, b in zip(parts, parts[1:] + parts[:1])} | {p[:60] for p in parts})
    firsts = chance.integers(0, 50, len(segments))
    got = D.earliest(segments, firsts)
    for s, least in zip(segments, got):
        for i in range(len(s) - 49):
            assert least[i] == min(int(f) for o, f in zip(segments, firsts) if s[i : i + 50] in o)


def brute(docs):
    first: dict[bytes, int] = {}
    rows = [(D.NO_ID if d is None else d, (t or "").encode()) for d, t in docs]
    for d, data in rows:
        for i in range(len(data) - 49):
            s = data[i : i + 50]
            first[s] = min(d, first.get(s, d))
    out = []
    for d, data in rows:
        gone = np.zeros(len(data) + 1, np.int8)
        for i in range(len(data) - 49):
            if first[data[i : i + 50]] < d:
                gone[i : i + 50] = 1
        kept = bytes(np.frombuffer(data, np.uint8)[gone[:-1] == 0])
        spans = int(np.sum(np.diff(gone, prepend=0) == 1))
        out.append((None if d == D.NO_ID else d, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(frame, docs):
    assert sorted((tuple(r)[:5] for r in frame.collect()), key=repr) == brute(docs)


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check(queries.op6_suffix_dedup(spark, FOLDER), docs)


def test_anchors_with_many_segments_are_parted(spark):
    chance = np.random.default_rng(1)
    word = lambda n: "".join(chance.choice(list("abcdefgh "), n))
    line = word(90)
    docs = [(i, word(70) + line + word(60)) for i in range(30)] + [(i, word(30) + line[:60] + word(40) + line[20:]) for i in range(30, 40)]
    for large in (1, 3):
        check(D.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), large=large), docs)


def test_one_anchor_with_twenty_thousand_segments_over_many_slices(spark):
    """A line of 40 bytes in every text; what stands beside it is drawn so that only some strings across its edges are equal."""
    chance = np.random.default_rng(2)
    line = "".join(chance.choice(list("abcdefgh"), 40))
    sides = ["".join(chance.choice(list("stuvw"), 6)) for _ in range(60)]
    tails = chance.choice(list("klmnop"), (20_000, 60))
    docs = [(i, "".join(tails[i, :30]) + sides[int(chance.integers(60))] + line + sides[int(chance.integers(60))] + "".join(tails[i, 30:])) for i in range(20_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(40)
    rows = D.deduplicated(frame, large=1_500)
    check(rows, docs)
    assert rows.where("n_removed > 0").count() > 10_000


def test_odd_rows(spark, odd_docs, no_docs):
    chance = np.random.default_rng(8)
    base = ["".join(chance.choice(list("abcdé \n"), n)) for n in (49, 50, 51, 120, 400)]
    docs = [(i, base[int(chance.integers(5))][int(chance.integers(0, 30)) :] + "".join(chance.choice(list("xyz"), 30)) + base[int(chance.integers(5))]) for i in range(40)]
    docs += [(3, base[4]), (3, base[4]), (3, base[3]), (None, base[4]), (None, base[2]), (50, "a" * 300), (51, "a" * 200), (52, "a" * 49), (53, "ab" * 100), (54, ("z" + "a" * 60) * 4), (55, None), (56, "")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, place int, spans string")
    rows = D.deduplicated(frame)
    check(rows, docs)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows.collect())
    assert D.deduplicated(no_docs).collect() == []
    assert D.deduplicated(odd_docs).count() == odd_docs.count()


def test_small_batches_and_arrays_change_nothing(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()]
    rows = [(d, m, t.encode()) for m, (d, t) in enumerate(docs)]
    segments = {}
    for d, _, data in rows:
        at, hashes = D.anchors(np.frombuffer(data, np.uint8))
        # Every string of 50 bytes holds an anchor.
        covered = np.zeros(max(0, len(data) - 49), bool)
        for p, h in zip(at.tolist(), hashes.tolist()):
            covered[max(0, p - D.REACH + 1) : p + 1] = True
            segments.setdefault(h, set()).add(data[max(0, p - D.REACH + 1) : p + 50])
        assert covered.all()


@pytest.mark.parametrize("kinds, words", [(2, 1), (84, 5), (138, 6), (246, 7), (257, 8)])
def test_words_hold_as_many_values_as_fit(kinds, words):
    """Suffixes compare by their words as by their values; fewer kinds of bytes need fewer words."""
    rng = np.random.default_rng(kinds)
    text = np.concatenate([rng.integers(0, kinds, 120), np.full(60, kinds - 1), rng.integers(0, min(kinds, 2), 200)]).astype(np.int16)
    found = D.prefix_words(text)
    assert len(found) == words
    padded = [*text.tolist(), *[0] * D.LENGTH]
    wanted = sorted(range(len(text)), key=lambda i: padded[i : i + D.LENGTH])
    assert np.lexsort(found[::-1]).tolist() == wanted


def test_bytes_in_use_are_numbered_in_the_arrays(monkeypatch):
    widths = []
    words = D.prefix_words
    monkeypatch.setattr(D, "prefix_words", lambda text: widths.append(int(text.max())) or words(text))
    same = bytes(range(97, 123)) * 2 + b"\xff"
    got = D.earliest([b"zz" + same, same], np.array([5, 3]))
    assert [x.tolist() for x in got] == [[5, 5, 3, 3, 3, 3], [3, 3, 3, 3]]
    assert widths == [27]
