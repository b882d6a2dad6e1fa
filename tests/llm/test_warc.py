"""Archives: round trips, revisits against SQL, files that stand on their own."""

import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from compare import check, connect
from siltstone.llm import warc
from siltstone.sources.stage import scratch_path

HTML = ["<p>" + "é😀\r\n" * 60 + "</p>", "short", "", None, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5, "x" * 99, "x" * 100, "\r\n\r\n" * 40, "y" * 300_000]


def plain(rows):
    out = []
    for k, (page, html) in enumerate(rows):
        data = (html or "").encode()
        same = [(p is None, p or 0, j) for j, (p, h) in enumerate(rows) if (h or "") == (html or "")]
        first = rows[min(same)[2]][0]
        is_first = len(data) < 100 or min(same)[:2] == (page is None, page or 0)
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if is_first else "revisit", None if is_first else first))
    return out


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 500])
def test_round_trip(spark, rows, chunk_bytes):
    data = [(k, HTML[k % len(HTML)]) for k in range(40)]
    pages = spark.createDataFrame([(p, h, f"http://x/{p}\r\nX: y", 1, "t") for p, h in data], "page_id long, html string, url string, at int, type string").repartition(3)
    folder = scratch_path(spark, "warc")
    got = warc.archived(pages, folder, chunk_bytes=chunk_bytes)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(got) == sorted(plain(data), key=repr)
    raw = warc.read(spark, f"{folder}/raw")
    texts = {r.page_id: r.payload.decode() for r in raw.collect()}
    assert texts == {str(p): h or "" for p, h in data}
    assert raw.where(F.col("uri").contains("\n")).count() == 0
    unique = warc.read(spark, f"{folder}/unique").collect()
    assert sum(r.type == "revisit" and r.payload is None and r.refers_to is not None for r in unique) == sum(r[3] == "revisit" for r in plain(data))
    for name in glob.glob(f"{folder.removeprefix('file:')}/unique/part-*"):
        with gzip.open(name) as file:  # any gzip reader takes it
            whole = file.read()
        records = list(warc.parse(whole))
        assert [r[1:] for r in records] == [r[1:] for _, member in warc.members(open(name, "rb").read()) for r in warc.parse(member)]
        assert records and (len(records) == 1 or sum(len(b) for _, _, b in records) <= chunk_bytes)
        assert all(h["warc-type"] in ("response", "revisit") and h["warc-record-id"].startswith("<urn:uuid:") for _, h, _ in records)


def test_repeated_rows_and_null_ids(spark):
    big = "z" * 200
    pages = spark.createDataFrame([(5, big, None), (5, big, "u"), (None, big, "u"), (None, "q" * 150, "u"), (7, big, "u")], "page_id long, html string, url string")
    got = sorted((tuple(r) for r in warc.archived(pages, scratch_path(spark, "warc")).collect()), key=repr)
    assert [(r[0], r[3], r[4]) for r in got] == sorted([(5, "response", None), (5, "revisit", 5), (None, "revisit", 5), (None, "response", None), (7, "revisit", 5)], key=lambda r: repr((r[0], 200 if r[0] or r[1] == "revisit" else 150)))


def test_missing_response(spark):
    record = ("1", "<urn:uuid:a>", "revisit", "u", None, None, hashlib.sha256(b"x").hexdigest(), "<urn:uuid:gone>")
    path = scratch_path(spark, "warc")
    warc.write(spark.createDataFrame([record], warc.RECORD), path)
    assert [(r.payload_bytes, r.refers_to_page) for r in warc.resolve(spark, path).collect()] == [(None, None)]


def test_broken_files():
    good = warc.record_bytes({"page_id": "1", "record_id": "<r>", "type": "response", "uri": None, "payload": b"abc", "payload_digest": hashlib.sha256(b"abc").hexdigest(), "refers_to": None})
    assert [(h["content-length"], b) for _, h, b in warc.parse(good + good)] == [("3", b"abc")] * 2
    packed = gzip.compress(good) + gzip.compress(good * 3)
    assert list(warc.members(packed + b"\0")) == [(0, good), (len(gzip.compress(good)), good * 3)]
    with pytest.raises(ValueError):
        list(warc.members(packed[:-5]))
    for bad in (good[:-2], b"x" + good, good.replace(b"Content-Length: 3", b"Content-Length: 2")):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, html string, url string")
    assert warc.archived(pages, scratch_path(spark, "warc")).collect() == []


def test_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    assert check(spark, connect(sf_dir), warc.op6_warc, warc.OP6_SQL, sf_dir) == 250


def test_ids_of_any_text(spark):
    """Ids come back as they were, with blanks, line breaks and signs."""
    ids = [" a\nb ", "a b", "a%20b", "", "é日 ", "x: y\r\n\r\nWARC/1.1", None]
    pages = spark.createDataFrame([(i, "http://x/", "same payload " * 20) for i in ids], "page_id string, url string, html string")
    found = warc.archived(pages, scratch_path(spark, "archive")).collect()
    assert sorted((r.page_id for r in found), key=repr) == sorted(ids, key=repr)
    first = next(r.page_id for r in found if r.record_type == "response")
    assert {r.refers_to for r in found if r.record_type == "revisit"} == {first}
