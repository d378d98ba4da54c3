"""Archives: exact round trip of the pages, and salvage of damaged files."""

import base64
import gzip
import hashlib
import random
import tempfile

import pytest

from cohortry.llm import queries, warc

from .conftest import FOLDER


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages):
    largest = {}
    for page, html in pages:
        if page is not None:
            largest[digest(html)] = max(page, largest.get(digest(html), page))
    rows = []
    for page, html in pages:
        top = largest.get(digest(html))
        refers = top if top is not None and (page is None or page < top) else None
        rows.append((page, len((html or "").encode()), digest(html), "response" if refers is None else "revisit", refers))
    return sorted(rows, key=repr)


def test_pages_round_trip(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "html").collect()]
    assert sorted((tuple(r) for r in queries.op8_warc(spark, FOLDER).collect()), key=repr) == expected(pages)


@pytest.mark.parametrize("compress", [True, False])
def test_odd_pages(spark, compress):
    html = [(1, "u", "<a>"), (2, None, "<a>"), (2, "x y\r\nz", "<a>"), (3, "u", None), (4, "u", ""), (None, "u", "<a>"), (None, None, "only"), (5, "u", "é\r\n\r\nWARC/1.1\r\n" * 70_000)]
    pages = spark.createDataFrame([(*r, 9, 9) for r in html], "page_id long, url string, html string, payload int, digest int")
    read = warc.read_archives(warc.write_archives(pages, compress=compress))
    assert sorted((tuple(r) for r in warc.pages_of(read).collect()), key=repr) == expected([(p, h) for p, _, h in html])
    assert {r.payload.decode() for r in read.where("record_type = 'response' and page_id = 5").collect()} == {html[-1][2]}
    assert read.where("gap is not null").count() == 0
    assert warc.pages_of(warc.read_archives(warc.write_archives(pages.limit(0)))).collect() == []


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(spark, compress):
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    chance = random.Random(5)
    records = [warc.member(warc.page_record(i, "u", bytes(chance.randrange(256) for _ in range(400)) + b"WARC/1.0 \x1f\x8b\x08", None), compress) for i in range(40)]
    starts = [sum(map(len, records[:i])) for i in range(41)]
    data = bytearray(b"".join(records))
    data[starts[3] + 40] ^= 255
    data[starts[10] + len(records[10]) // 2] ^= 255
    data[starts[11] : starts[12]] = b"x" * len(records[11])
    data = data[: starts[39] + 50]
    path = f"{folder}/a.warc"
    with open(path, "wb") as out:
        out.write(data)
    found = list(warc.salvage(path))
    kept = [int(r.headers["warc-record-id"][10:-1]) for r in found if isinstance(r, warc.Record)]
    assert kept == [i for i in range(39) if i not in (3, 10, 11)]
    gaps = [g[:2] for g in found if not isinstance(g, warc.Record)]
    assert gaps == [(starts[3], starts[4]), (starts[10], starts[12]), (starts[39], len(data))]
    frame = warc.read_archives(spark.createDataFrame([(path,)], "path string"))
    assert frame.where("gap is not null").count() == 3 and frame.where("gap is null").count() == 36


def test_foreign_gzip_members_are_gaps():
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/b.warc.gz"
    good = warc.member(warc.page_record(1, "u", b"x", None), True)
    with open(path, "wb") as out:
        out.write(gzip.compress(b"not a record") + good + b"")
    found = list(warc.salvage(path))
    assert isinstance(found[1], warc.Record) and found[0][1] == found[1].start
