"""Similar texts against comparing all with all, for documents and for large groups."""

import numpy as np

from cohortry.llm import similarity as S
from cohortry.llm.simhash import shingle_hashes

from .conftest import FOLDER


def brute(docs):
    sets = [(d, frozenset(shingle_hashes(t or "", 5).tolist())) for d, t in docs if d is not None]
    root = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a == b or len(a & b) >= 0.8 * len(a | b) - 1e-9 and a | b:
                x, y = root[i], root[j]
                if x != y:
                    root = [min(x, y) if r in (x, y) else r for r in root]
    ids = {}
    for (d, _), r in zip(sets, root):
        ids.setdefault(r, set()).add(d)
    return {d: min(ids[r]) for (d, _), r in zip(sets, root)}


def test_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in S.linked(frame).collect()} == brute(docs)


def edited(chance, words, edits):
    out = list(words)
    for at in chance.choice(len(out), edits, replace=False):
        out[at] = f"e{chance.integers(10**9)}"
    return " ".join(out)


def test_groups_of_edited_copies_and_a_shared_line(spark):
    chance = np.random.default_rng(4)
    word = lambda n: [f"w{i}" for i in chance.integers(0, 5000, n)]
    line = " ".join(word(12))
    docs = []
    # Copies of the large group resemble each other; those of the small ones only their original.
    for copies, size, edits in [(60, 300, 2)] + [(6, 300, 4)] * 15 + [(6, 80, 1)] * 15:
        base = word(size)
        docs += [(len(docs) + k, edited(chance, base, edits if k else 0) + " " + line) for k in range(copies)]
    docs += [(len(docs) + k, line + " " + " ".join(word(60))) for k in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got, want = {r.doc_id: r.component_id for r in S.linked(frame).collect()}, brute(docs)
    assert all(got[d] == got[w] for d, w in want.items()) and all(want[d] == want[c] for d, c in got.items())


def test_one_stays(spark, odd_docs, no_docs):
    kept = S.kept_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 3, 6, 8, 9] and kept.where("doc_id is null").count() == 1
    assert S.kept_one_each(no_docs).collect() == []


def same_groups(got, want):
    return all(got[d] == got[w] for d, w in want.items()) and all(want[d] == want[c] for d, c in got.items())


def family(chance, texts, planted):
    """Texts that share 83% of their shingles, so that two of them have a similarity of 0.71; the last ``planted`` are copies with other ends."""
    template = [f"t{i}" for i in chance.integers(0, 5000, 170)]
    own = [[f"u{i}" for i in chance.integers(0, 10**9, 34)] for _ in range(texts)]
    own += [[*o[:-2], "other", f"end{k}"] for k, o in enumerate(own[:planted])]
    return [(k, " ".join(template + o)) for k, o in enumerate(own)]


def test_pairs_in_a_family_with_a_template(spark):
    docs = family(np.random.default_rng(6), 160, 60)
    got = {r.doc_id: r.component_id for r in S.linked(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = brute(docs)
    assert len(set(want.values())) == 160 and same_groups(got, want)


def test_blocks_and_chunks_change_nothing(spark, monkeypatch):
    docs = family(np.random.default_rng(7), 60, 20)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(S, "BLOCK", 4)
    got = {r.doc_id: r.component_id for r in S.linked(frame).collect()}
    assert same_groups(got, brute(docs))
    order = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    classes = S.sketches(frame, 5, 0.8, order).selectExpr("shingles", "shingles as label", "size", "prefix")
    pairs = [{tuple(r) for r in S.crossing(classes, 0.8, chunk).collect()} for chunk in (3, 10**6)]
    assert pairs[0] == pairs[1] and len(pairs[0]) >= 20
