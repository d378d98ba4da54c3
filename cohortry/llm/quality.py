"""Quality rules by line labels: a linear-chain conditional random field marks each line as content or boilerplate.

The model is trained here from documents labelled good or bad: the lines of a good document count as
content, those of a bad one as boilerplate. Training sees a bounded sample (``TRAIN_DOCS`` documents,
``TRAIN_LINES`` lines of each); decoding sees every line of every text. A document is retained when
the lines that the Viterbi path calls content hold ``LEAST_CONTENT`` of the characters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import rows_in_slices, texts

TRAIN_DOCS, TRAIN_LINES = 2_000, 64
LEAST_CONTENT = 0.5
#: Weight of the penalty on squared weights, rounds and step of the training.
PENALTY, ROUNDS, STEP = 1e-3, 150, 0.5

SPACE = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
MARKS = re.compile(r"https?://|www\.|©|copyright|all rights reserved|licen[sc]e|cookie|subscribe|sign in|privacy policy", re.I)
FEATURES = (
    "bias", "blank", "words_1_3", "words_4_8", "symbols", "symbols_dense", "pipes", "capitals", "exclaims",
    "digits", "no_stop", "repeats_line", "few_distinct", "marks", "edge",
)


def counted(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = WORDS.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in lines
            lines.add(line)
    threes = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(threes)) < len(threes):
        often, until = Counter(threes), 0
        for at, three in enumerate(threes):
            if often[three] > 1:
                repeated += at + 3 - max(at, until)
                until = at + 3
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated


def line_features(lines: list[str]) -> np.ndarray:
    """A row of 0 and 1 per line."""
    out, seen, last = np.zeros((len(lines), len(FEATURES)), np.float64), set(), len(lines) - 1
    for at, line in enumerate(lines):
        words = line.split()
        letters = sum(map(str.isalpha, line)) or 1
        symbols, length = sum(map(line.count, SYMBOLS)), max(1, len(line))
        n = len(words)
        out[at] = (
            1, n == 0, 0 < n < 4, 3 < n < 9, symbols > 0, symbols * 20 > length, line.count("|") > 1,
            n > 0 and sum(map(str.isupper, line)) * 10 > 6 * letters, line.count("!") * 20 > length, sum(map(str.isdigit, line)) * 3 > length,
            n > 0 and words[-1][-1] not in ".!?:;\"'”)", line in seen and n > 0, n > 5 and 2 * len(set(words)) < n,
            MARKS.search(line) is not None, at in (0, last),
        )
        seen.add(line)
    return out


class LineField:
    """A chain over lines with states 0 (boilerplate) and 1 (content)."""

    def __init__(self, emit: np.ndarray, step: np.ndarray, start: np.ndarray):
        self.emit, self.step, self.start = emit, step, start

    @classmethod
    def untrained(cls) -> LineField:
        """Without labelled documents every line is content."""
        return cls(np.zeros((len(FEATURES), 2)), np.zeros((2, 2)), np.zeros(2))

    def decode(self, features: np.ndarray) -> list[int]:
        """The most likely states; of equally likely ones content."""
        scores = (features @ self.emit).tolist()
        if not scores:
            return []
        (t00, t01), (t10, t11) = self.step.tolist()
        bad, good = scores[0][0] + float(self.start[0]), scores[0][1] + float(self.start[1])
        back: list[tuple[int, int]] = []
        for to_bad, to_good in scores[1:]:
            from_bad, from_good = int(good + t10 >= bad + t00), int(good + t11 >= bad + t01)
            back.append((from_bad, from_good))
            bad, good = (good + t10 if from_bad else bad + t00) + to_bad, (good + t11 if from_good else bad + t01) + to_good
        states = [int(good >= bad)]
        for step in reversed(back):
            states.append(step[states[-1]])
        return states[::-1]

    @classmethod
    def trained(cls, sequences: list[tuple[np.ndarray, int]]) -> LineField:
        """Gradient ascent on the mean log-likelihood of sequences whose lines share one state; good and bad weigh alike."""
        field = cls.untrained()
        if len({y for _, y in sequences}) < 2:
            return field
        n, most = len(sequences), max(len(x) for x, _ in sequences)
        x = np.zeros((n, most, len(FEATURES)))
        there = np.zeros((n, most))
        y = np.array([state for _, state in sequences])
        for i, (rows, _) in enumerate(sequences):
            x[i, : len(rows)], there[i, : len(rows)] = rows, 1
        share = np.bincount(y, weights=there.sum(axis=1), minlength=2)
        weight = (0.5 / np.maximum(share, 1))[y]
        own = np.zeros((n, 2))
        own[np.arange(n), y] = 1
        squares = [np.full_like(p, 1e-8) for p in (field.emit, field.step, field.start)]
        for _ in range(ROUNDS):
            at, pairs = field._marginals(x, there)
            gap = (own[:, None, :] - at) * there[:, :, None] * weight[:, None, None]
            links = there[:, 1:].sum(axis=1)
            seen = np.zeros((2, 2))
            np.add.at(seen, (y, y), links * weight)
            gradient = [np.einsum("nlf,nls->fs", x, gap), seen - np.einsum("nlab,nl,n->ab", pairs, there[:, 1:], weight), gap[:, 0].sum(axis=0)]
            for p, g, sq in zip((field.emit, field.step, field.start), gradient, squares):
                g -= PENALTY * p
                sq += g * g
                p += STEP * g / np.sqrt(sq)
        return field

    def _marginals(self, x: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward sums, scaled line by line; absent lines repeat their neighbour."""
        n, most, _ = x.shape
        scores = x @ self.emit
        scores[:, 0] += self.start
        local = np.exp(scores - scores.max(axis=2, keepdims=True))
        move = np.exp(self.step - self.step.max())
        ahead, behind = np.empty((n, most, 2)), np.ones((n, most, 2))
        ahead[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, most):
            f = (ahead[:, t - 1] @ move) * local[:, t]
            ahead[:, t] = np.where(there[:, t, None] > 0, f / f.sum(axis=1, keepdims=True), ahead[:, t - 1])
        for t in range(most - 2, -1, -1):
            b = (behind[:, t + 1] * local[:, t + 1]) @ move.T
            behind[:, t] = np.where(there[:, t + 1, None] > 0, b / b.sum(axis=1, keepdims=True), 1.0)
        at = ahead * behind
        at /= at.sum(axis=2, keepdims=True)
        pairs = ahead[:, :-1, :, None] * move[None, None] * (local[:, 1:] * behind[:, 1:])[:, :, None, :]
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        return at, pairs


def train_lines(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> LineField:
    """The model of at most ``documents`` labelled documents, half good and half bad, drawn by a hash of their id.

    Labels that are neither 0 nor 1, or null, don't count. What reaches the driver is bounded by the two parameters.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality in (0, 1) and doc_id is not null")
    order = F.xxhash64("doc_id", F.lit(5))
    drawn = [known.where(F.col("quality") == q).orderBy(order, "doc_id").limit(documents // 2) for q in (0, 1)]
    chosen = drawn[0].union(drawn[1])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_slices(batches):
            rows = [line_features(t.split("\n")[:lines]).astype(np.uint8).tobytes() for t in batch["text"].to_pylist()]
            yield pa.record_batch([batch["doc_id"], batch["quality"], pa.array(rows, pa.binary())], ["doc_id", "quality", "rows"])

    found = texts(docs).join(chosen, "doc_id").select("doc_id", "quality", "text").mapInArrow(features, "doc_id long, quality int, rows binary")
    # Repeated ids could make the sample longer than asked for.
    rows = found.orderBy("doc_id", "rows").limit(documents).collect()
    return LineField.trained([(np.frombuffer(bytes(r.rows), np.uint8).reshape(-1, len(FEATURES)).astype(np.float64), r.quality) for r in rows])


OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, content_share double"


def judged(docs: DataFrame, field: LineField, least: float = LEAST_CONTENT) -> DataFrame:
    """Counts, share of content and verdict of every row; null or empty texts have no words and fail.

    Repeated rows are judged each; no rows give no rows; other columns and their names don't matter. base_failed: fewer than 50 words, or over half of them in repeated 3-word windows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in OUT.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.bool_(), pa.bool_(), pa.float64()]
        for batch in rows_in_slices(batches):
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                counts = counted(text)
                n_words, repeated = counts[0], counts[4]
                failed = n_words < 50 or 100 * repeated > 50 * n_words
                lines = text.split("\n")
                states = field.decode(line_features(lines))
                sizes = [len(line.strip(SPACE)) for line in lines]
                whole = sum(sizes)
                share = sum(s for s, state in zip(sizes, states) if state) / whole if whole else 0.0
                rows.append((doc, *counts, failed, not failed and share >= least, share))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return texts(docs).mapInArrow(judge, OUT)
