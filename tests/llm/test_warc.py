"""Archives: exact round trip, records, and what each capture is."""

from __future__ import annotations

import base64
import hashlib

import pytest
from corpora import values

from tripguard.llm import warc

PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, "http://a.example/2", "<p>one</p>"),
    (3, None, None),
    (4, "http://a.example/4\r\nX: y", ""),
    (5, "http://a.example/5", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nb\r\n\r\n"),
    (6, "http://a.example/6", "WARC/1.1\r\nInside: é – 漢\n\n\r\n\r\n"),
    (7, "http://a.example/7", "x" * 300_000),
    (9, "http://a.example/9", "<p>one</p>"),
    *((20 + i, "u", "\r\n" * i + "y" * (65_500 + i) + "\r\n\r\n" * (i % 5) + "\r" * (i % 3)) for i in range(90)),
]


@pytest.fixture(autouse=True)
def small_splits(spark):
    """Files are read in parts that end anywhere."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100001")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def captured(spark, tmp_path, rows=PAGES, **options):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for name in ("id", "payload", "digest", "record", "type"):
        pages = pages.withColumn(name, pages["url"])
    path = f"file://{tmp_path}/archive"
    warc.write_archive(pages, path, **options)
    return warc.read_records(spark, path)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, tmp_path, compression):
    records = captured(spark, tmp_path, compression=compression)
    assert records.count() == 3 * len(PAGES)
    rows = {r["response"]["record_id"]: r for r in warc.transactions(records).collect()}
    assert len(rows) == len(PAGES)
    for page, _, html in PAGES:
        row = rows[f"<urn:capture:response:{page}>"]
        same = [p for p, _, h in PAGES if (h or "") == (html or "")]
        top = max(same)
        assert row["response"]["type"] == ("response" if page == top else "revisit")
        assert row["response"]["refers_to"] == (None if page == top else f"<urn:capture:response:{top}>")
        assert row["payload"] == ((html or "") if page == top else None)
        assert row["response"]["digest"] == digest(html)
        assert row["request"]["block"].startswith("GET ") and f"captureId: {page}\r\n" in row["metadata"]["block"]


def test_files_are_plain_archives(spark, tmp_path):
    captured(spark, tmp_path)
    seen = 0
    for file in (tmp_path / "archive").glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
            assert rest[length : length + 4] == b"\r\n\r\n"
            data, seen = rest[length + 4 :], seen + 1
    assert seen == 3 * len(PAGES)


def test_small_payloads_are_no_revisits(spark, tmp_path):
    rows = warc.transactions(captured(spark, tmp_path, least_bytes=11)).collect()
    assert {r["response"]["type"] for r in rows} == {"response"}


def test_cut_off_archives_stop_the_read(spark, tmp_path):
    captured(spark, tmp_path)
    for file in (tmp_path / "archive").glob("part-*"):
        data = file.read_bytes()
        (tmp_path / "cut").mkdir(exist_ok=True)
        (tmp_path / "cut" / file.name).write_bytes(data[:-9])
    with pytest.raises(Exception, match="another length"):
        warc.read_records(spark, f"file://{tmp_path}/cut").collect()


def test_odd_tables(spark, tmp_path):
    assert warc.transactions(captured(spark, tmp_path, rows=[])).count() == 0
    twice = [(1, "u", "x"), (1, "u", "x"), (None, None, None)]
    found = captured(spark, tmp_path / "b", rows=twice)
    assert values(found.groupBy("type").count(), "type", "count") == [("metadata", 3), ("request", 3), ("response", 3)]


def test_repeated_ids_give_a_row_each(spark, tmp_path):
    rows = [(1, "u", "x"), (1, "u", "x"), (1, "v", "y"), (2, "u", "x"), (3, "w", "y"), (3, "w", "y"), (None, "n", "z"), (None, "n", None)]
    found = warc.transactions(captured(spark, tmp_path, rows=rows)).collect()
    assert sorted(r["response"]["uri"] for r in found) == sorted(u for _, u, _ in rows)
    ids = {r["response"]["record_id"]: r for r in found}
    assert len(ids) == len(rows) and "<urn:capture:response:2>" in ids
    for r in found:
        assert r["request"]["uri"] == r["metadata"]["uri"] == r["response"]["uri"]
        if r["response"]["type"] == "revisit":
            first = ids[r["response"]["refers_to"]]["response"]
            assert first["type"] == "response" and first["digest"] == r["response"]["digest"]
    kinds = sorted((r["response"]["digest"], r["response"]["type"]) for r in found)
    want = [(x, "response") for x in "xyyz"] + [("", "response")] + [("x", "revisit")] * 2 + [("y", "revisit")]
    assert kinds == sorted((digest(x), kind) for x, kind in want)


def test_archives_of_the_query_take_less_disk_than_the_pages(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "shared_folder", lambda spark, what: f"file://{tmp_path}/{what}")
    found = warc.op8_warc(spark, "/root/testdata/sf0.01")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    payloads = sum(len((r["html"] or "").encode()) for r in pages.select("html").collect())
    files = list((tmp_path / "warc").glob("part-*"))
    assert found.count() == pages.count()
    assert files and sum(f.stat().st_size for f in files) < payloads / 2
