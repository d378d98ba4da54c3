"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained here in numpy.

A word enters the network as two vectors: one of its own, if it is in the vocabulary, and the sum of those of its character grams (3,
5 and 7 bytes of ``<word>``). Two recurrent passes, one from each end, run over windows of ``WINDOW`` words; attention pools
their states; one output. Windows start at every ``STRIDE``-th word, so that neighbours overlap by half, and every word of a text is in
one. A text's score is that of its most toxic window.

Training: at most ``SAMPLE`` labelled texts per class, drawn by a hash of the id, of at most ``LONGEST`` characters each, in one task. Which
window of a toxic text is toxic isn't labelled, so each round first scores all windows of the sample and then learns from each
text's highest one (and, of clean texts, from another one as well). The vocabulary holds words and grams that tell the classes
apart, at most ``VOCABULARY`` each; their vectors begin with the log-odds.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .storage import byte_slices, texts

WINDOW, STRIDE = 64, 32
SAMPLE, LONGEST, VOCABULARY = 1_500, 65_536, 6_000
#: Texts a feature must be in, and how many standard errors its log-odds must be from zero.
LEAST, STRENGTH = 4, 3.0
GRAMS = (3, 5, 7)
EMBED, HIDDEN = 8, 8
ROUNDS, BATCH, STEP, DECAY = 6, 128, 4e-3, 1e-4
TOXIC_FROM = 0.7
#: Words whose grams are looked up at once, windows in one pass.
WORDS, PASS = 16_384, 2_048
_BITS = 20


# Words and grams


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Word numbers of all texts in order, the different words, and where each text begins (one more entry at the end)."""
    plain = pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(column), r"[^\pL\pM\pN]+", " "))
    lists = pc.utf8_split_whitespace(plain)
    words = lists.flatten()
    there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    counts = np.concatenate([[0], np.cumsum(there)])
    edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    coded = words.filter(pa.array(there)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, counts[edges]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, 0x9E3779B97F4A7C15, np.uint64))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(words), np.uint64)
    if not len(words):
        return out
    data, edges = _bytes(words)
    sizes = np.diff(edges)
    place = np.arange(len(data)) - np.repeat(edges[:-1], sizes)
    terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[place]
    return _mixed(np.add.reduceat(terms, edges[:-1]) + sizes.astype(np.uint64))


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``<word>`` one after the other, and where each begins."""
    framed = pc.binary_join_element_wise("<", words, ">", "").cast(pa.large_string())
    edges = np.frombuffer(framed.buffers()[1], np.int64)[framed.offset : framed.offset + len(framed) + 1]
    return np.frombuffer(framed.buffers()[2], np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def word_grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash of a gram) for every gram of every word."""
    owners, hashes = [], []
    if len(words):
        data, edges = _bytes(words)
        owner = np.repeat(np.arange(len(words)), np.diff(edges))
        for n in GRAMS:
            if len(data) < n:
                continue
            whole = owner[: len(owner) - n + 1] == owner[n - 1 :]
            h = np.full(int(whole.sum()), n, np.uint64)
            for k, power in enumerate(_powers(n)):
                h += (data[k : len(data) - n + 1 + k][whole].astype(np.uint64) + np.uint64(1)) * power
            owners.append(owner[: len(owner) - n + 1][whole])
            hashes.append(_mixed(h))
    return (np.concatenate(owners), np.concatenate(hashes)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


class Lookup:
    """Numbers of known hashes, 0 for others. Of two known hashes with the same place the first one stays."""

    def __init__(self, known: np.ndarray):
        place = (known >> np.uint64(64 - _BITS)).astype(np.int64)
        _, first = np.unique(place, return_index=True)
        first.sort()
        self.known = known[first]
        self.number = np.zeros(1 << _BITS, np.int32)
        self.number[place[first]] = np.arange(1, len(first) + 1)
        self.check = np.concatenate([np.zeros(1, np.uint64), self.known])

    def __getstate__(self) -> np.ndarray:
        return self.known

    def __setstate__(self, known: np.ndarray) -> None:
        self.__init__(known)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        number = self.number[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)]
        return np.where(self.check[number] == hashes, number, 0)


# Network


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Weights ``p``: word and gram vectors, and for both directions at once input and state weights; attention and output.

    Gate columns are reset, update and candidate, ``HIDDEN`` each.
    """

    def __init__(self, words: Lookup, grams: Lookup, p: dict[str, np.ndarray]):
        self.words, self.grams, self.p = words, grams, p

    @classmethod
    def begun(cls, words: np.ndarray, word_odds: np.ndarray, grams: np.ndarray, gram_odds: np.ndarray) -> Network:
        chance = np.random.default_rng(11)
        lookups, vectors = [], []
        for known, odds in ((words, word_odds), (grams, gram_odds)):
            lookup = Lookup(known)
            rank = {h: o for h, o in zip(known.tolist(), odds.tolist())}
            table = chance.normal(0, 0.05, (len(lookup.known) + 1, EMBED))
            table[1:, 0] = [rank[h] for h in lookup.known.tolist()]
            table[0] = 0
            lookups.append(lookup)
            vectors.append(table)
        inner = 2 * EMBED
        p = {
            "words": vectors[0], "grams": vectors[1],
            "input": chance.normal(0, 0.4 / np.sqrt(EMBED), (2, inner, 3 * HIDDEN)), "bias": np.zeros((2, 1, 3 * HIDDEN)),
            "state": chance.normal(0, 0.6 / np.sqrt(HIDDEN), (2, HIDDEN, 3 * HIDDEN)),
            "look": chance.normal(0, 0.5, 2 * HIDDEN), "out": chance.normal(0, 0.5, 2 * HIDDEN), "base": np.zeros(1),
        }
        return cls(*lookups, {k: v.astype(np.float32) for k, v in p.items()})

    def numbers(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary number of each word; (word, number) of its known grams."""
        own = self.words(word_hashes(words))
        owners, found = [], []
        for at in range(0, len(words), WORDS):
            owner, h = word_grams(words.slice(at, WORDS))
            number = self.grams(h)
            owners.append(owner[number > 0] + at)
            found.append(number[number > 0])
        return own, np.concatenate(owners or [np.zeros(0, np.int64)]), np.concatenate(found or [np.zeros(0, np.int32)])

    def vectors(self, own: np.ndarray, owner: np.ndarray, gram: np.ndarray) -> np.ndarray:
        sums = np.stack([np.bincount(owner, self.p["grams"][gram, d], len(own)) for d in range(EMBED)], axis=1)
        return np.concatenate([self.p["words"][own], sums.astype(np.float32)], axis=1)

    def gates(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.p["input"] + self.p["bias"]

    def logits(self, gates: np.ndarray, words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """One number for each window of ``sizes`` words from ``begins`` on."""
        out = np.full(len(begins), self.p["base"][0], np.float32)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        for at in range(0, len(order), PASS):
            part = order[at : at + PASS]
            out[part] = self.forward(gates, _table(words, begins[part], sizes[part]), sizes[part])[0]
        return out

    def forward(self, gates: np.ndarray, table: np.ndarray, sizes: np.ndarray, keep: bool = False) -> tuple:
        """Logits of the windows in ``table`` (windows x words); with ``keep`` what the way back needs."""
        n, most = table.shape
        h = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((most, 2, n, HIDDEN), np.float32)
        kept = []
        least = int(sizes.min())
        for t in range(most):
            s = most - 1 - t
            x = np.stack([gates[0].take(table[:, t], axis=0), gates[1].take(table[:, s], axis=0)])
            y = h @ self.p["state"]
            ru = _sigmoid(x[..., : 2 * HIDDEN] + y[..., : 2 * HIDDEN])
            r, u = ru[..., :HIDDEN], ru[..., HIDDEN:]
            c = np.tanh(x[..., 2 * HIDDEN :] + r * y[..., 2 * HIDDEN :])
            new = c + u * (h - c)
            if t >= least:
                new[0] = np.where((t < sizes)[:, None], new[0], h[0])
            if s >= least:
                new[1] = np.where((s < sizes)[:, None], new[1], h[1])
            if keep:
                kept.append((h, ru, c, y[..., 2 * HIDDEN :]))
            h = new
            states[t, 0], states[s, 1] = h[0], h[1]
        seen = np.concatenate([states[:, 0], states[:, 1]], axis=2)  # words x windows x states
        there = np.arange(most)[:, None] < sizes
        look = np.where(there, seen @ self.p["look"], -np.inf)
        weight = np.exp(look - look.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, seen)
        return pooled @ self.p["out"] + self.p["base"][0], seen, weight, pooled, there, kept

    def gradients(self, gates: np.ndarray, table: np.ndarray, sizes: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log loss; the last result is that of the gates, (2, windows, words, gates)."""
        z, seen, weight, pooled, there, kept = self.forward(gates, table, sizes, True)
        n, most = table.shape
        p = self.p
        dz = ((_sigmoid(z) - toxic) * weights / weights.sum()).astype(np.float32)
        g = {"out": pooled.T @ dz, "base": np.array([dz.sum()], np.float32)}
        dpooled = dz[:, None] * p["out"]
        dweight = np.einsum("nh,tnh->tn", dpooled, seen)
        dlook = weight * (dweight - (weight * dweight).sum(axis=0))
        g["look"] = np.einsum("tn,tnh->h", dlook, seen)
        dseen = weight[..., None] * dpooled + dlook[..., None] * p["look"]
        dgates = np.zeros((2, n, most, 3 * HIDDEN), np.float32)
        g["state"] = np.zeros_like(p["state"])
        dh = np.zeros((2, n, HIDDEN), np.float32)
        for t in reversed(range(most)):
            s = most - 1 - t
            h, ru, c, yc = kept[t]
            r, u = ru[..., :HIDDEN], ru[..., HIDDEN:]
            dh = dh + np.stack([dseen[t, :, :HIDDEN], dseen[s, :, HIDDEN:]])
            on = np.stack([there[t], there[s]])[..., None]
            dc = dh * (1 - u) * (1 - c * c)
            du = dh * (h - c) * u * (1 - u)
            dr = dc * yc * r * (1 - r)
            dx = np.concatenate([dr, du, dc], axis=2) * on
            dy = np.concatenate([dr, du, dc * r], axis=2) * on
            g["state"] += h.transpose(0, 2, 1) @ dy
            dh = np.where(on, dh * u, dh) + dy @ p["state"].transpose(0, 2, 1)
            dgates[0, :, t], dgates[1, :, s] = dx[0], dx[1]
        return g, dgates


def _table(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return words[begins[:, None] + np.minimum(np.arange(int(sizes.max())), sizes[:, None] - 1)]


def windows(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, first word and size of all windows of texts that begin at ``edges``; an empty text has one empty window."""
    lengths = np.diff(edges)
    counts = np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1)
    owner = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = nth * STRIDE
    return owner, edges[:-1][owner] + begin, np.minimum(WINDOW, lengths[owner] - begin)


def highest(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The highest value of each owner; owners ascend and none is left out."""
    return np.maximum.reduceat(values, np.flatnonzero(np.diff(owner, prepend=-1)))


# Training


def _telling(feature: np.ndarray, text: np.ndarray, toxic: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and log-odds of features (below n) that differ between the classes, the strongest first; pairs are distinct."""
    per = [np.bincount(feature[toxic[text] == y], minlength=n).astype(float) for y in (0, 1)]
    totals = [float((toxic == y).sum()) for y in (0, 1)]
    odds = np.log((per[1] + 0.5) / (totals[1] + 1)) - np.log((per[0] + 0.5) / (totals[0] + 1))
    strength = np.abs(odds) / np.sqrt(1 / (per[1] + 0.5) + 1 / (per[0] + 0.5))
    chosen = np.flatnonzero((per[0] + per[1] >= LEAST) & (strength >= STRENGTH))
    chosen = chosen[np.argsort(-strength[chosen], kind="stable")][:VOCABULARY]
    return chosen, np.clip(odds[chosen], -4, 4)


def train(column: pa.Array, toxic: np.ndarray) -> Network:
    """A network for texts with labels 0 and 1; with one class only, or no texts, it gives every text the same score."""
    words, different, edges = split_words(column)
    hashes = word_hashes(different)
    owner, grams = word_grams(different)
    names, gram = np.unique(grams, return_inverse=True)
    text_of = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    pairs = np.unique(text_of * max(1, len(different)) + words)
    pair_text, pair_word = pairs // max(1, len(different)), pairs % max(1, len(different))
    known, word_odds = _telling(pair_word, pair_text, toxic, len(different))
    first, count = np.searchsorted(np.sort(owner), [np.arange(len(different)), np.arange(1, len(different) + 1)])
    by_word = np.argsort(owner, kind="stable")
    sizes = count - first
    parts = []
    for at in range(0, len(pairs), 50_000):  # grams of a text, each once
        t, w = pair_text[at : at + 50_000], pair_word[at : at + 50_000]
        n = sizes[w]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        parts.append(np.unique(np.repeat(t, n) * max(1, len(names)) + gram[by_word[np.repeat(first[w], n) + inside]]))
    both = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
    known_grams, gram_odds = _telling(both % max(1, len(names)), both // max(1, len(names)), toxic, len(names))
    net = Network.begun(hashes[known], word_odds, names[known_grams], gram_odds)
    if len(np.unique(toxic)) < 2:
        return net
    return _fitted(net, words, different, edges, toxic)


def _fitted(net: Network, words: np.ndarray, different: pa.Array, edges: np.ndarray, toxic: np.ndarray) -> Network:
    chance = np.random.default_rng(5)
    own, owner, gram = net.numbers(different)
    order = np.argsort(owner, kind="stable")
    owner, gram = owner[order], gram[order]
    first = np.searchsorted(owner, np.arange(len(own)))
    count = np.searchsorted(owner, np.arange(len(own)), "right") - first
    text, begins, sizes = windows(edges)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    per_text = np.diff(np.append(starts, len(text)))
    # First guess: the window with the strongest words.
    odds = net.vectors(own, owner, gram)[:, [0, EMBED]].sum(axis=1)
    total = np.concatenate([[0], np.cumsum(odds[words], dtype=np.float64)])
    values = total[begins + sizes] - total[begins]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    balance = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum())) * len(toxic)
    steps = 0
    for turn in range(ROUNDS):
        vectors = net.vectors(own, owner, gram)
        if turn:
            values = net.logits(net.gates(vectors), words, begins, sizes)
        top = np.array([s + int(np.argmax(values[s : s + n])) for s, n in zip(starts, per_text)])
        other = starts + (chance.random(len(starts)) * per_text).astype(np.int64)
        chosen = np.concatenate([top, other[toxic == 0]])
        chosen = chance.permutation(chosen[sizes[chosen] > 0])
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            table = _table(words, begins[part], sizes[part])
            seen, place = np.unique(table, return_inverse=True)
            place = place.reshape(table.shape)
            n = count[seen]
            mine = np.repeat(np.arange(len(seen)), n)
            inside = np.repeat(first[seen], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            x = net.vectors(own[seen], mine, gram[inside])
            g, dgates = net.gradients(net.gates(x), place, sizes[part], toxic[text[part]], balance[text[part]])
            flat = place.ravel()
            per = np.stack([np.stack([np.bincount(flat, dgates[d, :, :, k].ravel(), len(seen)) for k in range(3 * HIDDEN)], axis=1) for d in range(2)]).astype(np.float32)
            g["input"] = x.T @ per
            g["bias"] = per.sum(axis=1, keepdims=True)
            dx = (per @ net.p["input"].transpose(0, 2, 1)).sum(axis=0)
            g["words"], g["grams"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["grams"])
            np.add.at(g["words"], own[seen], dx[:, :EMBED])
            np.add.at(g["grams"], gram[inside], dx[mine, EMBED:])
            g["words"][0] = g["grams"][0] = 0
            steps += 1
            for k, w in net.p.items():
                mean, square = moments[k]
                mean += 0.1 * (g[k] - mean)
                square += 0.001 * (g[k] * g[k] - square)
                w -= STEP * (mean / (1 - 0.9**steps) / (np.sqrt(square / (1 - 0.999**steps)) + 1e-8) + DECAY * w)
    return net


# Frames


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learnt from; a row without an id is none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = [(b["text"], b["toxic"]) for b in batches if b.num_rows]
    text = pa.concat_arrays([c[0] for c in columns]) if columns else pa.array([], pa.string())
    labels = np.concatenate([c[1].to_numpy() for c in columns]) if columns else np.zeros(0)
    yield pa.record_batch([pa.array([pickle.dumps(train(text, labels.astype(np.float32)))], pa.binary())], ["model"])


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """The network of at most ``sample`` labelled texts per class; only the finished weights reach the driver.

    Held-out rows, labels other than 0 and 1, and ids with both labels don't count.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    order = F.xxhash64("doc_id", F.lit(11))
    drawn = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(sample).select("doc_id", "toxic") for y in (0, 1)]
    rows = texts(docs).where(F.length("text") <= LONGEST).join(drawn[0].union(drawn[1]), "doc_id").orderBy(order, "doc_id", F.xxhash64("text")).limit(2 * sample)
    model = rows.select("text", "toxic").coalesce(1).mapInArrow(_learnt, "model binary").first()
    # An empty table may have no partition, so that no task has run.
    return pickle.loads(bytes(model["model"])) if model else train(pa.array([], pa.string()), np.zeros(0, np.float32))


OUT = "doc_id long, held_out boolean, score double, predicted int, windows int"


def _scored(batches: Iterator[pa.RecordBatch], net: Network) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches):
        words, different, edges = split_words(batch["text"])
        text, begins, sizes = windows(edges)
        gates = net.gates(net.vectors(*net.numbers(different)))
        best = highest(text, net.logits(gates, words, begins, sizes))
        score = _sigmoid(best.astype(np.float64))
        n = np.bincount(text, minlength=batch.num_rows).astype(np.int32)
        yield pa.record_batch([batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32)), pa.array(n)], ["doc_id", "held_out", "score", "predicted", "windows"])


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """Score, prediction and number of windows of every row's whole text.

    Null and empty texts, and texts without letters or digits, have one empty window and get its score. Repeated rows are scored each; rows
    without an id are scored and not held out. Only id and text are read, so other columns and their names don't matter.
    """
    rows = texts(docs).select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(partial(_scored, net=net), OUT)
