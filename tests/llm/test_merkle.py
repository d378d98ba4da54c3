"""Every column against a plain tree in Python, for several tier heights; interval labels; odd rows."""

from hashlib import sha256
from zlib import crc32

import pytest

from cohortry.llm import merkle, queries

from .conftest import FOLDER


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def built(row):
    out = [row]
    while len(row) > 1:
        row = [h(*row[i : i + 3]) for i in range(0, len(row), 3)]
        out.append(row)
    return out


def way(tree, at):
    sides = []
    for row in tree[:-1]:
        begin = at // 3 * 3
        sides.append(("".join(row[begin:at]), "".join(row[at + 1 : begin + 3])))
        at //= 3
    return sides


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for name in names:
        by[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees.append(built([leaf_of(r, r.text) for r in by[name]]))
    above = built([t[-1][0] for t in trees])
    root, out = above[-1][0], []
    for k, name in enumerate(names):
        for i, r in enumerate(by[name]):
            sides, text = way(trees[k], i) + way(above, k), r.text
            if text is not None and r.doc_id is not None and crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            own = leaf_of(r, text)
            for left, right in sides:
                own = h(left, own, right)
            out.append((r.doc_id, leaf_of(r, r.text), trees[k][-1][0], root, h(*map("".join, sides)), own, own == root, i))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("height", [1, 2])
def test_tiers(tiny, height):
    docs = tiny("documents")
    assert rows_of(merkle.proofs(docs, height)) == brute(docs.collect())


def test_query(spark, tiny):
    got = rows_of(queries.op13_merkle(spark, FOLDER))
    assert got == brute(tiny("documents").collect())
    assert 0 < sum(r[6] for r in got) < len(got)


def test_one_large_source_and_many_small_ones(frame):
    """A source with over 3^7 rows needs two tiers; sources of one row have no level at all."""
    rows = [(i, "t" * (i % 5) + "\n", "en", "big", i) for i in range(2500)] + [(9000 + i, "x", None, f"s{i:03d}", None) for i in range(40)]
    docs = frame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(merkle.proofs(docs)) == brute(docs.collect())


def test_interval_labels(tiny):
    docs = tiny("documents")
    found = merkle.nodes(docs, 2).collect()
    by = {(n.source, n.level, n.lo): n for n in found}
    assert len(by) == len(found)
    for n in found:
        if n.level:
            inside = [by[n.source, n.level - 1, lo] for lo in range(n.lo, n.hi, 3 ** (n.level - 1))]
            assert inside[0].lo == n.lo and inside[-1].hi == n.hi and n.digest == h(*(c.digest for c in inside))


def test_odd_rows(odd_docs, no_docs):
    assert rows_of(merkle.proofs(odd_docs)) == brute(odd_docs.collect())
    assert merkle.proofs(no_docs).collect() == []
    assert merkle.nodes(no_docs).collect() == []
