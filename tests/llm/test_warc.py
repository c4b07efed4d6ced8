import gzip
import json
import zlib
from pathlib import Path

from helpers import sha

from affinis.llm import warc
from affinis.llm.scratch import Scratch

LONG = "<p>äö " + "x" * 200
PAGES = [
    (3, "http://a/ b\n", LONG), (1, None, LONG), (2, "u", LONG), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
    (8, "u", "y" * 100), (9, "u", "y" * 100), (10, "u", "z" * 99), (11, "u", "z" * 99), (None, "u", LONG), (None, "u", "only" * 50),
    (12, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" + "w" * 100), (13, "u", "same row" * 20), (13, "u", "same row" * 20),
]
SCHEMA = "page_id long, url string, html string, payload_digest int"


def pages(spark):
    return spark.createDataFrame([(*p, 0) for p in PAGES], SCHEMA).repartition(3)


def test_round_trip(spark):
    got = warc.round_trip(pages(spark)).collect()
    assert len(got) == len(PAGES)
    firsts = {LONG: 1, "y" * 100: 8, "same row" * 20: 13}
    want = []
    for page_id, _, html in PAGES:
        html = html or ""
        first = firsts.get(html)
        refers = first if first is not None and page_id != first else None
        want.append((page_id, len(html.encode()), sha(html), "revisit" if refers else "response", refers, None if refers else html.encode()))
    order = lambda rows: sorted(rows, key=repr)
    assert order((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload is not None else None) for r in got) == order(want)


def test_members_and_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 37)  # records cross the pieces read
    scratch = Scratch(spark, "warc-test")
    whole = scratch.written(warc.archived(warc.with_revisits(pages(spark)), scratch.folder), "whole")
    single = scratch.written(warc.normalised(whole, scratch.folder), "single")
    assert sum(r.n_records for r in whole.collect()) == len(PAGES)
    for row in whole.collect():
        stream = zlib.decompressobj(31)
        stream.decompress(Path(row.path).read_bytes())
        assert stream.eof and not stream.unused_data  # one member holds all
    seen = 0
    for row in single.collect():
        data = Path(row.path).read_bytes()
        at = 0
        for line in Path(row["index"]).read_text().splitlines():
            offset, length, page = json.loads(line)
            assert offset == at
            parsed = warc.parsed(gzip.decompress(data[offset : offset + length]))
            assert parsed["page_id"] == page
            at, seen = offset + length, seen + 1
        assert at == len(data)
    assert seen == len(PAGES)


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cut_archives():
    """An archive that ends early is refused, wherever it was cut; a small chunk bounds each piece."""
    import io
    import random

    import pytest

    data = bytes(random.Random(1).randrange(256) for _ in range(5000)) + b"\0" * 300_000
    whole = gzip.compress(data)
    pieces = list(warc.inflated(io.BytesIO(whole + gzip.compress(b"second")), 1000))
    assert b"".join(pieces) == data + b"second" and max(map(len, pieces)) <= 1000
    for cut in (0, 5, len(whole) // 2, len(whole) - 9, len(whole) - 1):
        with pytest.raises(ValueError):
            list(warc.inflated(io.BytesIO(whole[:cut]), 1000))


def test_one_payload_on_most_pages(spark, monkeypatch):
    from affinis.operators import joins

    monkeypatch.setattr(joins, "ROWS_PER_SALT", 4)
    rows = [(i, "u", LONG if i % 5 else f"page {i} " * 30, 0) for i in range(60)]
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_digest) for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: ("revisit", 1, sha(LONG)) if html == LONG and i > 1 else ("response", None, sha(html)) for i, _, html, _ in rows}


def test_a_task_for_each_archive(spark):
    some = spark.createDataFrame([(f"p{i}", f"p{i}.idx", 1) for i in range(6)], warc.MANIFEST).coalesce(1)
    assert warc._dealt(some).rdd.glom().map(len).collect() == [1] * 6
