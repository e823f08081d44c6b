"""Archives against what went into them."""

import base64
import hashlib
import zlib

import pytest

from caresift.llm import warc
from caresift.llm.store import open_store

SCHEMA = "page_id long, url string, html string, payload string, extra int"


def brute(pages, least=0):
    out = []
    for page_id, _, html, *_ in pages:
        body = (html or "").encode()
        same = [p[0] for p in pages if (p[2] or "").encode() == body and p[0] is not None]
        first = min(same) if same and len(body) >= least else page_id
        refers = None if first == page_id or not same else first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page_id, len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a.org/x y", "<p>äö</p>", "p", 1),
    (3, "http://b.org/\r\nEvil: 1", "<p>äö</p>", "p", 1),
    (9, None, None, None, 2),
    (2, "", "", "q", None),
    (11, "http://c.org", "long " * 200_000, "r", 3),
    (12, "http://c.org", "long " * 200_000, "r", 3),
    (13, "http://c.org", "\r\n\r\nWARC/1.1\r\n\r\n", "r", 3),
    (5, "http://a.org/x y", "<p>äö</p>", "p", 1),
    (None, "http://d.org", "only here", None, None),
]


@pytest.mark.parametrize("least", [0, 1, 100])
def test_round_trip(spark, least):
    df = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    got = warc.read_records(warc.write_archives(df, min_bytes=least)).collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == brute(PAGES, least)
    bodies = {p[0]: p[2] or "" for p in PAGES}
    assert all(r["payload"] == bodies[r["page_id"]] for r in got if r["record_type"] == "response")


def test_hot_payload_and_small_files(spark):
    pages = [(i, f"http://h/{i}", "same" if i % 3 else f"own {i}", "", 0) for i in range(3000)]
    index = warc.write_archives(spark.createDataFrame(pages, SCHEMA), file_bytes=10_000)
    assert index.select("file").distinct().count() > 8
    got = warc.read_records(index, max_gap=0, block_bytes=2_000)
    assert got.where("record_type = 'revisit'").count() == 2000 - 1
    assert {r[0] for r in got.where("refers_to IS NOT NULL").select("refers_to").distinct().collect()} == {1}
    assert got.count() == 3000


def test_selected_records_are_read_alone(spark):
    pages = [(i, f"http://h/{i % 7}", f"text {i}", "", 0) for i in range(500)]
    index = warc.write_archives(spark.createDataFrame(pages, SCHEMA))
    got = warc.read_records(index.where("url = 'http://h/3'")).collect()
    assert sorted(r["page_id"] for r in got) == [i for i in range(500) if i % 7 == 3]


def test_every_index_row_is_a_gzip_member(spark):
    index = warc.write_archives(spark.createDataFrame(PAGES, SCHEMA)).collect()
    for row in index:
        store, path = open_store(row["file"])
        with store.open_input_file(path) as stream:
            stream.seek(row["offset"])
            text = zlib.decompress(stream.read(row["length"]), 31)
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
        assert b"\r\nEvil" not in text.split(b"\r\n\r\n")[0]


def test_empty_table(spark):
    assert warc.read_records(warc.write_archives(spark.createDataFrame([], SCHEMA))).count() == 0


def test_ranges_join_neighbours():
    spans = [(0, 10), (10, 5), (40, 5), (100, 50)]
    joined = list(warc._ranges(spans, max_gap=25, max_bytes=60))
    assert [(a, b, len(m)) for a, b, m in joined] == [(0, 45, 3), (100, 150, 1)]
