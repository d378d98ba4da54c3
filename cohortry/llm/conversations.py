"""Repair of conversation structure by a grammar-compressed dynamic programme.

Each row of a conversation becomes one symbol: its role's initial and its fault. A repair keeps, reroles or deletes each row and
inserts rows between, so that initials read ``(s?(ua)+)?``; one symbol is then a 4 x 4 matrix over the states of that pattern
(nothing yet, after s, after u, after a), whose entries hold the least cost and the least audit string. Sequences are matrices
multiplied in (min, +), and the symbol sequences of all conversations share one Re-Pair grammar: frequent pairs become new symbols,
round by round, and each rule's matrix is made once from those of its two parts. A conversation then costs one vector-matrix step
for each symbol that is left of it.

Of two audits with the same rows, ends and cost neither is the other's beginning (the longer one would have further inserts,
which cost), so the least of joined audits is joined from least ones, and the products are exact.

Long conversations are cut in pieces of ``PIECE`` rows after one range sort of narrow rows; pieces meet only as vectors. The hash of
the repaired text is by nature sequential: the texts of one conversation stream through one task, in order, and are never held.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortry.scale import stage

from .storage import freed, rows_in_slices, ship

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
PIECE = 4_096
#: The grammar: rounds, rules, pairs looked at in a round, rows a rule may stand for, and conversations a worker remembers.
ROUNDS, RULES, LOOKED_AT, LONGEST, REMEMBERED = 24, 512, 256, 256, 100_000
SPACE = " \t\n\x0b\x0c\r"
#: Symbols: initial s, u, a or another; a capital is truncated; x must be deleted.
MUST_GO, PLAIN, FIRST_RULE = "x", "suao", 0xE000
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: Ways to get from a state to others by inserts alone: (state, number).
INSERTS = {START: [(START, 0), (AFTER_U, 1), (AFTER_A, 2)], AFTER_S: [(AFTER_S, 0), (AFTER_U, 1), (AFTER_A, 2)], AFTER_U: [(AFTER_U, 0), (AFTER_A, 1)], AFTER_A: [(AFTER_A, 0), (AFTER_U, 1)]}
STEP = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
END = (START, AFTER_A)

Matrix = list[dict[int, tuple[int, str]]]


# Matrices


def _least(ways: Iterator[tuple[int, int, str]]) -> dict[int, tuple[int, str]]:
    best: dict[int, tuple[int, str]] = {}
    for to, cost, audit in ways:
        if to not in best or (cost, audit) < best[to]:
            best[to] = cost, audit
    return best


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before a row, then what is done with the row."""
    initial, extra = symbol.lower(), TRUNCATED * symbol.isupper()

    def done(state: int) -> Iterator[tuple[int, int, str]]:
        yield state, DELETE, "D"
        if symbol != MUST_GO:
            if (state, initial) in STEP:
                yield STEP[state, initial], KEEP + extra, "K"
            for role in "ua":
                if (state, role) in STEP:
                    yield STEP[state, role], REROLE + extra, "R"

    return [_least((to, INSERT * n + cost, "I" * n + edit) for at, n in INSERTS[begin] for to, cost, edit in done(at)) for begin in range(4)]


def joined(left: Matrix, right: Matrix) -> Matrix:
    return [_least((to, cost + more, audit + tail) for mid, (cost, audit) in row.items() for to, (more, tail) in right[mid].items()) for row in left]


def rule_matrices(rules: list[str]) -> dict[str, Matrix]:
    """One matrix per symbol and rule, from the bottom up. Rule i, a pair of symbols, is the symbol FIRST_RULE + i."""
    out = {s: symbol_matrix(s) for s in MUST_GO + PLAIN + PLAIN.upper()}
    for i, (left, right) in enumerate(rules):
        out[chr(FIRST_RULE + i)] = joined(out[left], out[right])
    return out


def compressed(sequence: str, rules: list[str]) -> str:
    for i, pair in enumerate(rules):
        if len(sequence) < 2:
            break
        sequence = sequence.replace(pair, chr(FIRST_RULE + i))
    return sequence


# Rows


def damaged(conversations: DataFrame) -> DataFrame:
    """The test damage, by a checksum of ``conv_id:turn``: of twenty rows one each is dropped, emptied, loses its ``.!?``, is repeated, gets role user.

    Null roles, texts and parts of the checksum's key are one space.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))
    key = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")))
    rows = rows.withColumn("code", F.crc32(key) % 20).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    again = F.when(F.col("code") == 3, 1).otherwise(0)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(0), again)).alias("copy")).drop("copy")


def _narrow(rows: DataFrame) -> DataFrame:
    """What decides about a row, and ``at``, which ascends with conversation, turn (nulls first), role and text."""
    ended = F.rtrim("text", F.lit(SPACE))
    seen = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("mark"), F.substring("role", 1, 1).alias("initial"),
        (ended == "").alias("blank"), (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "mark")]
    placed = stage(seen.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    again = placed.where("not blank").groupBy("conv_id", "role", "mark").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = again.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first")
    met = placed.join(firsts, placed["conv_id"].eqNullSafe(firsts["c"]) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")) & ~F.col("blank"), "left")
    return met.select("conv_id", "at", "initial", "blank", F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("duplicate"), "truncated")


PIECES = pa.schema([
    ("conv_id", pa.int64()), ("at", pa.int64()), ("seq", pa.string()), ("first", pa.string()), ("last", pa.string()),
    ("illegal", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
])
PIECES_SQL = "conv_id long, at long, seq string, first string, last string, illegal long, blank long, duplicate long, truncated long"


def _illegal(left: str, right: str) -> bool:
    return left + right not in ("su", "ua", "au")


def _cut(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Symbol sequences, one for each conversation and chunk of ``piece`` places."""
    held: list[tuple] = []
    key, seq, initials, at_first, counts = None, [], [], 0, [0, 0, 0]

    def close() -> None:
        if seq:
            illegal = sum(map(_illegal, initials, initials[1:]))
            held.append((key[0], at_first, "".join(seq), initials[0], initials[-1], illegal, *counts))

    for batch in rows_in_slices(batches, 8_192):
        for conv, at, initial, blank, duplicate, truncated in zip(*(batch[c].to_pylist() for c in ("conv_id", "at", "initial", "blank", "duplicate", "truncated"))):
            if (conv, at // piece) != key:
                close()
                key, seq, initials, at_first, counts = (conv, at // piece), [], [], at, [0, 0, 0]
            symbol = initial if initial in ("s", "u", "a") else "o"
            if blank or duplicate:
                symbol = MUST_GO
                counts[0 if blank else 1] += 1
            elif truncated:
                symbol = symbol.upper()
                counts[2] += 1
            seq.append(symbol)
            initials.append(initial)
        if len(held) > 8_192:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), PIECES.types)], PIECES.names)
            held.clear()
    close()
    if held:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held), PIECES.types)], PIECES.names)


def _pieces(rows: DataFrame, piece: int) -> DataFrame:
    dealt = _narrow(rows).withColumn("chunk", F.expr(f"at div {piece}L"))
    return stage(dealt.repartition("chunk").sortWithinPartitions("chunk", "at").drop("chunk").mapInArrow(partial(_cut, piece=piece), PIECES_SQL))


# Grammar


def _pairs(batches: Iterator[pa.RecordBatch], rules: list[str]) -> Iterator[pa.RecordBatch]:
    found: Counter[str] = Counter()
    for batch in batches:
        for seq, n in zip(batch["seq"].to_pylist(), batch["n"].to_pylist()):
            seq = compressed(seq, rules)
            for i in range(len(seq) - 1):
                found[seq[i : i + 2]] += n
    yield pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"])


def learned_grammar(pieces: DataFrame, rounds: int = ROUNDS, most: int = RULES) -> list[str]:
    """Re-Pair rules over the different sequences, each weighing as often as it occurs.

    A round takes the most frequent pairs that can't overlap one another in a text. The bounds on rounds and rules only decide how far
    sequences shrink; results don't depend on them. At most ``LOOKED_AT`` pairs a round reach the driver.
    """
    different = stage(pieces.groupBy("seq").agg(F.count("*").alias("n")))
    rules: list[str] = []
    lengths: dict[str, int] = {}
    for _ in range(rounds):
        counted = different.mapInArrow(partial(_pairs, rules=list(rules)), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        chosen: list[str] = []
        for row in counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(LOOKED_AT).collect():
            left, right = row["pair"]
            length = lengths.get(left, 1) + lengths.get(right, 1)
            free = all(right != other[0] and left != other[1] for other in chosen)
            if free and length <= LONGEST and len(rules) + len(chosen) < most:
                chosen.append(row["pair"])
        if not chosen:
            break
        for pair in chosen:
            lengths[chr(FIRST_RULE + len(rules))] = lengths.get(pair[0], 1) + lengths.get(pair[1], 1)
            rules.append(pair)
    return rules


# Conversations


class _Way:
    """The best way into a state: the audit of the last piece, and the way before it."""

    __slots__ = ("cost", "audit", "before")

    def __init__(self, cost: int, audit: str, before: _Way | None):
        self.cost, self.audit, self.before = cost, audit, before

    def beats(self, other: _Way) -> bool:
        if self.cost != other.cost:
            return self.cost < other.cost
        mine, theirs, a, b = [], [], self, other
        while a is not b:  # both have one part a piece; most parts are shared
            mine.append(a.audit)
            theirs.append(b.audit)
            a, b = a.before, b.before
        return "".join(reversed(mine)) < "".join(reversed(theirs))

    def whole(self) -> str:
        parts, at = [], self
        while at is not None:
            parts.append(at.audit)
            at = at.before
        return "".join(reversed(parts))


class Repairer:
    """Least repairs of symbol sequences."""

    def __init__(self, rules: list[str]):
        self.rules, self.matrices = rules, rule_matrices(rules)
        self.known: dict[str, Matrix] = {}

    def rows(self, seq: str, begins: list[int]) -> Matrix:
        """The matrix's rows of the given states; others stay empty."""
        ways: Matrix = [{s: (0, "")} if s in begins else {} for s in range(4)]
        for symbol in compressed(seq, self.rules):
            ways = joined(ways, self.matrices[symbol])
        return ways

    def from_start(self, seq: str) -> dict[int, tuple[int, str]]:
        if seq not in self.known:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[seq] = self.rows(seq, [START])
        return self.known[seq][START]

    def further(self, ways: dict[int, _Way] | None, seq: str) -> dict[int, _Way]:
        if ways is None:
            return {to: _Way(cost, audit, None) for to, (cost, audit) in self.from_start(seq).items()}
        out: dict[int, _Way] = {}
        matrix = self.rows(seq, list(ways))
        for mid, way in ways.items():
            for to, (cost, audit) in matrix[mid].items():
                new = _Way(way.cost + cost, audit, way)
                if to not in out or new.beats(out[to]):
                    out[to] = new
        return out

    def ended(self, ways: dict[int, _Way] | None) -> tuple[int, str]:
        if ways is None:
            return 0, ""
        best: _Way | None = None
        for state, way in ways.items():
            for to, n in INSERTS[state]:
                if to in END:
                    new = _Way(way.cost + INSERT * n, way.audit + "I" * n, way.before)
                    if best is None or new.beats(best):
                        best = new
        return best.cost, best.whole()


class _Conversation:
    """Takes the pieces of one conversation, then its rows, both in order."""

    def __init__(self, conv: int | None):
        self.conv, self.ways, self.last = conv, None, None
        self.illegal = self.blank = self.duplicate = self.truncated = self.cost = self.at = self.state = self.written = 0
        self.audit: str | None = None
        self.least = self.most = self.turn = None
        self.turns, self.digest = 0, sha256()

    def piece(self, repairer: Repairer, seq: str, first: str, last: str, illegal: int, blank: int, duplicate: int, truncated: int) -> None:
        self.ways = repairer.further(self.ways, seq)
        self.illegal += illegal + (self.last is not None and _illegal(self.last, first))
        self.last = last
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._position("a" if self.state == AFTER_U else "u", None, "", "I")

    def _position(self, initial: str, role: str | None, text: str, edit: str) -> tuple[str, str, str]:
        self.state = STEP[self.state, initial]
        return role if role is not None else {"u": "user", "a": "assistant"}[initial], text, edit

    def row(self, repairer: Repairer, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """Rows of the repaired conversation up to this one: role, text and edit."""
        if self.audit is None:
            self.cost, self.audit = repairer.ended(self.ways)
        if turn is not None and turn != self.turn:
            self.turns, self.turn, self.most = self.turns + 1, turn, turn
            self.least = turn if self.least is None else self.least
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            yield self._position(role[0], role, text, edit)
        elif edit == "R":
            yield self._position("a" if self.state == AFTER_U else "u", None, text, edit)

    def end(self, repairer: Repairer) -> Iterator[tuple[str, str, str]]:
        if self.audit is None:
            self.cost, self.audit = repairer.ended(self.ways)
        yield from self._inserted()

    def gaps(self) -> int:
        return self.most - self.least + 1 - self.turns if self.turns else 0


DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
    ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
DIGEST_SQL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
REPAIRED_SQL = "conv_id long, place long, role string, text string, edit string"


def _walked(batches: Iterator[pa.RecordBatch], rules: list[str], digests: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation: one to announce it, its pieces, its rows."""
    repairer, schema = Repairer(rules), DIGEST if digests else REPAIRED
    out: list[tuple] = []
    now: _Conversation | None = None

    def take(rows: Iterator[tuple[str, str, str]]) -> None:
        for role, text, edit in rows:
            if digests:
                now.digest.update(f"{'\n' if now.written else ''}{role}:{text}".encode())
            else:
                out.append((now.conv, now.written, role, text, edit))
            now.written += 1

    def close() -> None:
        if now is not None:
            take(now.end(repairer))
            if digests:
                out.append((now.conv, now.gaps(), now.blank, now.duplicate, now.truncated, now.illegal, now.cost, now.audit, now.digest.hexdigest()))

    for batch in rows_in_slices(batches, 1_024):
        for row in batch.to_pylist():
            if now is None or row["conv_id"] != now.conv:
                close()
                now = _Conversation(row["conv_id"])
            if row["kind"] == 1:
                now.piece(repairer, *(row[c] for c in PIECES.names[2:]))
            elif row["kind"] == 2:
                take(now.row(repairer, row["turn"], row["role"], row["text"]))
        if len(out) > 1_024:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), schema.types)], schema.names)
            out.clear()
    close()
    if out:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), schema.types)], schema.names)


def _repairs(rows: DataFrame, ids: DataFrame, piece: int, digests: bool) -> DataFrame:
    ship(rows.sparkSession)
    with freed(rows.sparkSession):
        pieces = _pieces(rows, piece)
        rules = learned_grammar(pieces)
        met = ids.select("conv_id").distinct().withColumn("kind", F.lit(0)).unionByName(pieces.withColumn("kind", F.lit(1)), True)
        texts = rows.select("conv_id", "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("mark"), F.lit(2).alias("kind"))
        order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "at", "turn", "role", "mark")]
        dealt = met.unionByName(texts, True).repartition("conv_id").sortWithinPartitions(*order).drop("mark", "at")
        return stage(dealt.mapInArrow(partial(_walked, rules=rules, digests=digests), DIGEST_SQL if digests else REPAIRED_SQL))


def repaired(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """The repaired conversations: (conv_id, place, role, text, edit), edit being K, R or I.

    ``rows`` are (conv_id, turn, role, text) without null roles and texts; other columns don't matter. Conversations of which nothing is left have no row.
    """
    return _repairs(rows.select("conv_id", "turn", "role", "text"), rows, piece, False)


def audited(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """Damages ``conversations``, repairs them, and returns one row of faults, cost, audit and hash per conversation.

    Every conversation has a row, the one of rows without conv_id too; where the damage leaves nothing, counts are 0, the audit is empty and
    the hash is that of an empty text. Rows of equal turn are ordered by role and by the text's hash, null turns come first and are
    no turn for gaps; repeated rows are duplicates; empty texts are blank. Other columns are not read. No rows give no rows.
    """
    return _repairs(damaged(conversations), conversations.select(F.col("conv_id").cast("long").alias("conv_id")), piece, True)
