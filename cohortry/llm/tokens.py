"""Token ids of whole texts by the ``tokenizers`` library, one library call per distinct word.

Both public vocabularies split text before merging, and never join what stands before white space with
what stands behind it. So texts are cut where ASCII white space begins, all at once on their bytes; Arrow numbers the distinct pieces of
a batch, new ones are encoded and remembered, and the ids of all texts are gathered by offsets. Texts for which that isn't certain (they
hold a special token's string, or white space and control characters beyond ASCII) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces, and ids of them, that a worker remembers: about 200 MB.
REMEMBERED, REMEMBERED_IDS = 700_000, 8_000_000
#: New pieces encoded in one call.
ROW = 1_024
BLANK = " \t\n\x0b\x0c\r"
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
UNSURE = "\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def spread_ids(ids: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``at``, one after the other."""
    ends = np.cumsum(sizes)
    return ids[np.repeat(at - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def byte_widths(library) -> np.ndarray | None:
    """How many bytes of text each id stands for, if the vocabulary spells bytes and nothing is changed before merging; else None."""
    made = json.loads(library.to_str())
    model, cut = made["model"], made["pre_tokenizer"] or {}
    changed = made["normalizer"] or made["post_processor"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
    marked = any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
    if model.get("type") != "BPE" or changed or marked:
        return None
    widths = np.zeros(max(model["vocab"].values()) + 1, np.int64)
    for token, i in model["vocab"].items():
        widths[i] = len(token)
    return widths


class WordEncoder:
    """``encode(column)`` gives the ids of all texts in order, and where each text's begin (one more entry at the end)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.unsure = "|".join([f"[{UNSURE}]", *special])
        self.widths = byte_widths(self.library)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _row(self, text: str, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a row of pieces, given their sizes in bytes, and the number of ids of each piece."""
        if self.widths is not None:
            # Ids that stand for bytes say themselves where a piece ends; the library's offsets cost as much as its ids.
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum(self.widths[ids])
            if len(ids) and ends[-1] == sizes.sum():
                return ids, np.bincount(np.searchsorted(np.cumsum(sizes), ends - self.widths[ids], "right"), minlength=len(sizes))
        encoded = self.library.encode(text, add_special_tokens=False)
        begins = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(encoded))
        # Offsets count characters: those are the bytes that continue none.
        starts = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
        ends = starts[np.cumsum(sizes) - 1]
        return np.array(encoded.ids, np.uint32), np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(sizes))

    def _numbers(self, pieces: pa.StringArray) -> np.ndarray:
        """Numbers of pieces, new ones included."""
        known, words = self.known, pieces.to_pylist()
        numbers = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            # Pieces between white space and something else go through the library in long rows, which is three times as fast.
            edges = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
            data = np.frombuffer(pieces.buffers()[2], np.uint8)
            rowed = SPACES[data[edges[new]]] & ~SPACES[data[edges[new + 1] - 1]]
            alone = len(new) - int(rowed.sum())
            new = np.concatenate([new[~rowed], new[rowed]])
            fresh, lengths = [words[i] for i in new.tolist()], (edges[new + 1] - edges[new]).astype(np.int64)
            found = self._library_ids(fresh[:alone])
            ids = [np.fromiter((i for f in found for i in f), np.uint32)]
            sizes = [np.fromiter(map(len, found), np.int64, len(found))]
            for at in range(alone, len(new), ROW):
                encoded, counts = self._row("".join(fresh[at : at + ROW]), lengths[at : at + ROW])
                ids.append(encoded)
                sizes.append(counts)
            ids, sizes = np.concatenate(ids), np.concatenate(sizes)
            total, first = len(ids), len(known)
            while len(self.at) < first + len(new):
                self.at, self.sizes = np.resize(self.at, 2 * len(self.at)), np.resize(self.sizes, 2 * len(self.sizes))
            while len(self.ids) < self.used + total:
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.ids[self.used : self.used + total] = ids
            self.sizes[first : first + len(new)] = sizes
            self.at[first : first + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.used += total
            known.update(zip(fresh, range(first, first + len(new))))
            numbers[new] = np.arange(first, first + len(new))
        return numbers

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED or self.used > REMEMBERED_IDS:
            self._forget()
        unsure = pc.match_substring_regex(column, self.unsure)
        whole = np.flatnonzero(unsure.to_numpy(zero_copy_only=False))
        plain = pc.if_else(unsure, "", column) if len(whole) else column
        edges = np.frombuffer(plain.buffers()[1], np.int32)[plain.offset : plain.offset + len(plain) + 1].astype(np.int64)
        data = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
        edges -= edges[0]
        begins = SPACES[data]
        begins[1:] &= ~begins[:-1]
        begins[edges[:-1][edges[:-1] < edges[1:]]] = True
        at = np.flatnonzero(begins)
        offsets = np.append(at, len(data)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        number = self._numbers(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[number]
        ids = spread_ids(self.ids, self.at[number], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(at, edges)]
        if not len(whole):
            return ids, ends
        parts, lengths, last = [], np.diff(ends), 0
        for i, found in zip(whole.tolist(), self._library_ids(column.take(pa.array(whole)).to_pylist())):
            parts += [ids[last : ends[i]], np.array(found, np.uint32)]
            lengths[i], last = len(found), ends[i]
        return np.concatenate([*parts, ids[last:]]), np.concatenate([[0], np.cumsum(lengths)])

    def encode_ended(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` behind each text."""
        ids, edges = self.encode(column)
        nth = np.arange(len(column))
        out = np.full(len(ids) + len(column), end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(nth, np.diff(edges))] = ids
        return out, edges + np.arange(len(column) + 1)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
