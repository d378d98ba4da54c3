"""Packing and token files against the tokenizers library and exact round trips."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cohortry.llm import packing, queries, token_files
from cohortry.llm.tokens import WordEncoder

from .conftest import FOLDER

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ENCODERS = {p: (WordEncoder(p), Tokenizer.from_file(p)) for p in (WORD, BYTE)}


def library_ids(path, text, end):
    return np.array(ENCODERS[path][1].encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("path", [WORD, BYTE])
@given(st.text(alphabet=st.sampled_from(list("aB's 1.,\n\t\r\x0b\x0c\x1c\x85\xa0 　é́ΣσİK!|<>_\U0001f600")), max_size=40))
@settings(max_examples=400, deadline=None)
def test_pieces_give_the_ids_of_the_whole_text(path, text):
    cached, library = ENCODERS[path]
    whole = [text, "", f"x {text}", text[::-1]]
    ids, edges = cached.encode(pa.array(["cut off", *whole])[1:])
    assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [library.encode(t, add_special_tokens=False).ids for t in whole]


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200))
@settings(max_examples=200, deadline=None)
def test_bits_round_trip(bits, values):
    ids = np.array([v % (1 << bits) for v in values], np.uint32)
    assert token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, len(ids)).tolist() == ids.tolist()


def test_bits_for():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257)] == [1, 1, 2, 8, 9, 16]


@given(st.lists(st.integers(1, 30), max_size=60))
@settings(max_examples=200, deadline=None)
def test_best_fit_takes_the_tightest_window(lengths):
    lengths = sorted(lengths, reverse=True)
    rooms: list[int] = []
    for length, (number, offset) in zip(lengths, packing.best_fit(lengths, 30)):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            assert 30 - offset == min(fitting) == rooms[number]
        else:
            assert (number, offset) == (len(rooms), 0)
            rooms.append(30)
        rooms[number] -= length


def check_packing(rows, docs, window=4096):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    copies = {d: sum(1 for x, _ in docs if x == d) for d, _ in docs}
    assert set(by_doc) == set(copies)
    for d, t in docs:
        ids = library_ids(WORD, t, 2)
        pieces = {}
        for r in by_doc[d]:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
            pieces.setdefault(r.start, []).append(r.length)
        assert all(len(v) == copies[d] and len(set(v)) == 1 for v in pieces.values())
        at = 0
        for start in sorted(pieces):
            assert start == at
            at += pieces[start][0]
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences) * window / sum(r.length for r in rows)


def test_packing_of_the_documents(spark):
    rows = queries.op2_packing(spark, FOLDER).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert check_packing(rows, docs) < 1.05


def test_packing_of_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    check_packing(packing.packing_digest(odd_docs, WORD, 2, shard_docs=4).collect(), docs)
    assert packing.packing_digest(no_docs, WORD, 2).collect() == []
    whole = packing.pack_documents(odd_docs, WORD, 2).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(len(library_ids(WORD, t, 2)) for _, t in docs)


def check_files(rows, docs):
    want = {}
    for d, t in docs:
        want.setdefault(d, []).append(library_ids(BYTE, t, 0))
    at, seen = 0, []
    for r in sorted(rows, key=lambda r: r.start):
        ids = want[r.doc_id].pop(next(i for i, x in enumerate(want[r.doc_id]) if zlib.crc32(x.tobytes()) == r.ids_crc32))
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)
        seen.append(r.doc_id)
    assert not any(want.values())
    assert seen == sorted(seen, key=lambda d: (d is not None, d or 0))


def test_files_of_the_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check_files(queries.op9_token_files(spark, FOLDER).collect(), docs)


def test_files_of_odd_rows_with_small_blocks(odd_docs, no_docs):
    files = token_files.write_token_files(odd_docs, BYTE, 0, block=64)
    rows = token_files.read_token_files(files).collect()
    check_files(rows, [tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    path = files.first().path
    reader = token_files.TokenReader(path)
    whole = reader.ids(0, reader.total)
    for first, last in ((0, 1), (60, 70), (63, 64), (64, 193), (reader.total - 1, reader.total), (5, 5)):
        if last <= reader.total:
            assert reader.ids(first, last).tolist() == whole[first:last].tolist()
    assert token_files.read_token_files(token_files.write_token_files(no_docs, BYTE, 0)).collect() == []


def test_byte_vocabularies_need_no_offsets():
    """Ids of a byte vocabulary say how many bytes they stand for, so rows of pieces are cut without the library's offsets."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = WordEncoder(path)
    library = coder.library

    class NoOffsets:
        def __getattr__(self, name):
            if name == "encode":
                raise AssertionError("a row is encoded with offsets")
            return getattr(library, name)

    coder.library = NoOffsets()
    texts = ["plain words and 12 numbers", "", "größer 東京 \U0001f600 naïvé x", " lead\n\n\tand trail \n", "a\x00b ﻿c"]
    ids, edges = coder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[edges[i] : edges[i + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
    # Where widths don't add up to the text, offsets decide after all.
    coder.library, coder.widths = library, coder.widths + 1
    coder._forget()
    again, ends = coder.encode(pa.array(texts))
    assert again.tolist() == ids.tolist() and ends.tolist() == edges.tolist()


def test_changing_vocabularies_keep_offsets():
    coder = WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert coder.widths is None
    texts = ["Größer 東京 don't \U0001f600 x", "a  b\tÉcole 123"]
    ids, edges = coder.encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[edges[i] : edges[i + 1]].tolist() == coder.library.encode(text, add_special_tokens=False).ids
