"""Faults, costs, audits and texts against an independent search; grammar and pieces change nothing; odd rows."""

import re
from functools import cache
from hashlib import sha256
from zlib import crc32

import pytest
from hypothesis import given, settings, strategies as st

from cohortry.llm import conversations as C, queries

from .conftest import FOLDER

LEGAL = re.compile(r"(s?(ua)+)?")


def all_repairs(symbols, inserts=2):
    """(cost, audit) of every repair with up to so many inserts in a row, by plain enumeration."""
    gaps = [("I" * n, roles) for n in range(inserts + 1) for roles in ([""] if n == 0 else ["u", "a"] if n == 1 else ["ua", "au"])]

    def walk(i, cost, audit, roles):
        for done, more in gaps:
            c, a, r = cost + 5 * len(done), audit + done, roles + more
            if i == len(symbols):
                if LEGAL.fullmatch(r):
                    yield c, a
                continue
            s = symbols[i]
            extra = 5 * s.isupper()
            yield from walk(i + 1, c + 2, a + "D", r)
            if s != "x":
                yield from walk(i + 1, c + extra, a + "K", r + (s.lower() if s.lower() in "sua" else "?"))
                for role in "ua":
                    yield from walk(i + 1, c + 1 + extra, a + "R", r + role)

    return min(walk(0, 0, "", ""))


@given(st.text(alphabet="suaoSUAOx", max_size=4))
@settings(max_examples=60, deadline=None)
def test_least_repair_against_enumeration(symbols):
    repairer = C.Repairer(["ua", "su", chr(C.FIRST_RULE) * 2])
    assert repairer.ended(repairer.further(None, symbols)) == all_repairs(symbols)


@given(st.text(alphabet="suaoSUAOx", min_size=1, max_size=40), st.lists(st.integers(0, 40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_pieces_and_rules_change_nothing(symbols, cuts):
    plain, ruled = C.Repairer([]), C.Repairer(["ua", "ax", chr(C.FIRST_RULE) * 2, "su", chr(C.FIRST_RULE + 2) + "u"])
    whole = plain.ended(plain.further(None, symbols))
    edges, ways = sorted({0, len(symbols), *(c for c in cuts if c < len(symbols))}), None
    for a, b in zip(edges, edges[1:]):
        ways = ruled.further(ways, symbols[a:b])
    assert ruled.ended(ways) == whole == dp(symbols)


def dp(symbols):
    """From the back: (cost, audit) of the best rest after so many rows with so many roles written."""
    fits = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def rest(i, last, left):
        ways = [(0, "")] if i == len(symbols) and last in ("", "a") else []
        if left:
            ways += [put(5, "I", rest(i, fits[last, r], left - 1)) for r in "ua" if (last, r) in fits]
        if i < len(symbols):
            s, extra = symbols[i].lower(), 5 * symbols[i].isupper()
            ways.append(put(2, "D", rest(i + 1, last, 3)))
            if symbols[i] != "x":
                ways += [put(extra, "K", rest(i + 1, fits[last, s], 3))] if (last, s) in fits else []
                ways += [put(1 + extra, "R", rest(i + 1, fits[last, r], 3)) for r in "ua" if (last, r) in fits]
        return min(ways, default=(10**9, ""))

    def put(cost, edit, way):
        return way[0] + cost, edit + way[1]

    return rest(0, "", 3)


def brute(rows):
    by, out = {}, []
    for r in rows:
        by.setdefault(r.conv_id, [])
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        code, role, text = crc32(key.encode()) % 20, " " if r.role is None else r.role, " " if r.text is None else r.text
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            by[r.conv_id] += [(r.turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    for conv, items in by.items():
        items.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), sha256(x[2].encode()).digest()))
        turns = {t for t, _, _ in items if t is not None}
        seen, symbols, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in items:
            bare = text.strip(C.SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
        cost, audit = dp(symbols)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        lines, left, last = [], iter(items), ""
        for edit in audit:
            role, text = (None, "") if edit == "I" else next(left)[1:]
            if edit != "D":
                last = role[0] if edit == "K" else "a" if last == "u" else "u"
                lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[last]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query(spark, tiny):
    assert rows_of(queries.op12_conversations(spark, FOLDER)) == brute(tiny("conversations").collect())


ODD = [
    *((None, t, "user" if t % 2 == 0 else "assistant", f"text {t}.") for t in range(60)),  # a long conversation without an id
    (1, None, None, None), (1, None, "system", "a."), (1, 3, "user", ""), (1, 3, "user", ""), (1, 3, "", "x"), (2, 5, "Ünknown", "kept? yes!  \n"),
    (3, 0, "user", "w " * 50_000), (3, 0, "user", "w " * 50_000), (3, 1, "assistant", "ok."), (4, 10**12, "user", "far."), (4, 0, "assistant", "near."),
    *((5, t, "assistant", "ends without") for t in range(9)),
]
SCHEMA = "conv_id long, turn long, role string, text string, kind int, at long, seq string, place long"


@pytest.mark.parametrize("piece", [C.PIECE, 4])
def test_odd_rows(frame, piece):
    rows = frame([(*r, 7, 7, "ua", 7) for r in ODD], SCHEMA)
    assert rows_of(C.audited(rows, piece)) == brute(rows.collect())


def test_nothing_and_all_dropped(frame):
    gone = [(c, 0, "user", "a.") for c in range(100) if crc32(f"{c}:0".encode()) % 20 == 0]
    schema = "conv_id long, turn long, role string, text string"
    assert rows_of(C.audited(frame(gone, schema))) == sorted(((c, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest()) for c, *_ in gone), key=repr)
    assert C.audited(frame(gone, schema).limit(0)).collect() == []


def test_repaired_rows(frame):
    rows = frame([(1, 0, "assistant", "hello."), (1, 1, "assistant", "again."), (2, 0, "user", "one.")], "conv_id long, turn long, role string, text string")
    got = rows_of(C.repaired(rows))
    assert got == [(1, 0, "user", "hello.", "R"), (1, 1, "assistant", "again.", "K")]
