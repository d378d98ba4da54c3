"""Counts against brute force; Viterbi and marginals against all paths; verdicts against the labels."""

import itertools
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from cohortry.llm import quality, queries

from .conftest import FOLDER


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, t in enumerate(threes) if threes.count(t) > 1 for j in (i, i + 1, i + 2)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@given(st.text(alphabet=st.sampled_from(list("ab #|\n\t é")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_counts(text):
    assert quality.counted(text) == brute(text)


def paths(field, x):
    score = {}
    for states in itertools.product((0, 1), repeat=len(x)):
        s = field.start[states[0]] + sum((x[i] @ field.emit)[y] for i, y in enumerate(states))
        score[states] = s + sum(field.step[a, b] for a, b in zip(states, states[1:]))
    return score


def test_viterbi_and_marginals_against_all_paths():
    chance = np.random.default_rng(3)
    field = quality.LineField(chance.normal(size=(len(quality.FEATURES), 2)), chance.normal(size=(2, 2)), chance.normal(size=2))
    lengths = [1, 2, 5, 6]
    xs = [chance.integers(0, 2, (n, len(quality.FEATURES))).astype(float) for n in lengths]
    padded, there = np.zeros((4, 6, len(quality.FEATURES))), np.zeros((4, 6))
    for i, x in enumerate(xs):
        padded[i, : len(x)], there[i, : len(x)] = x, 1
    at, pairs = field._marginals(padded, there)
    for i, x in enumerate(xs):
        score = paths(field, x)
        assert tuple(field.decode(x)) == max(score, key=score.get)
        chances = {k: np.exp(v) for k, v in score.items()}
        total = sum(chances.values())
        for t in range(len(x)):
            assert np.isclose(at[i, t, 1], sum(v for k, v in chances.items() if k[t]) / total)
            for a, b in itertools.product((0, 1), repeat=2):
                if t + 1 < len(x):
                    assert np.isclose(pairs[i, t, a, b], sum(v for k, v in chances.items() if k[t : t + 2] == (a, b)) / total)


def test_documents(spark):
    rows = queries.op7_quality(spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        counts = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_verdicts_on_documents_not_trained_on(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    field = quality.train_lines(docs.where("doc_id % 2 = 0"), labels)
    rows = quality.judged(docs.where("doc_id % 2 = 1"), field).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_odd_rows(odd_docs, no_docs, tiny):
    labels = tiny("labels")
    field = quality.train_lines(odd_docs, labels.limit(0))
    assert np.all(field.emit == 0)
    rows = quality.judged(odd_docs, field).collect()
    want = sorted(((r.doc_id, *brute_fast(r.text)) for r in odd_docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.n_words, r.word_chars) for r in rows), key=repr) == want
    assert quality.judged(no_docs, field).collect() == []


def brute_fast(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return len(words), sum(map(len, words))
