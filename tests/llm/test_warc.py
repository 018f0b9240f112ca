import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tripspark.llm import warc
from tripspark.llm.common import new_path

DDL = "page_id long, url string, html string, record_type string, chunk string, first_id long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DDL)


def tricky():
    rng = random.Random(4)
    return [
        (1, "http://a/1", None),
        (2, None, ""),
        (3, "http://a/3\r\nEvil: yes", "a" * 99),
        (4, "http://a/4", "a" * 99),
        (5, "u", "é" * 50),  # 100 bytes
        (6, "u", "é" * 50),
        (7, "u", "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 5),
        (8, "u", "\r\n" * 70),
        (9, "u", "ends with cr\r" + "." * 100 + "\r"),
        (10, "u", "\n" + "." * 120 + "\r\n"),
        (11, "u", "".join(rng.choice("ab\r\n ") for _ in range(5000))),
        (12, "u", "".join(rng.choice("ab\r\n ") for _ in range(5000))),
        (13, "u", "z" * 64),
        (14, "u", "z" * 128),
        (15, "u", "t" * 200),
        (15, "u", "t" * 200),
        (16, "u", "t" * 200),
        (None, "u", "t" * 200),
        (None, "u", "only without id " * 10),
    ]


def brute(rows):
    ids = {}
    for page, _, html in rows:
        if page is not None:
            ids.setdefault(html or "", []).append(page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min(ids.get(html or "", [None]))
        again = len(data) >= 100 and first is not None and page != first
        out.append((page, len(data), hashlib.sha256(data).hexdigest(),
                    "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def test_report(spark):
    rows = tricky()
    assert sorted(map(tuple, warc.report(pages(spark, rows)).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1000])
def test_chunks_round_trip(spark, chunk):
    rows = [r for r in tricky() if r[0] is not None and r[0] != 15]
    if chunk == 1:
        rows = [r for r in rows if len(r[2] or "") < 300]
    path = new_path(spark, "warc-test")
    warc.write_archive(warc.with_revisits(pages(spark, rows)), path, chunk)
    back = warc.read_archive(spark, path, chunk).orderBy("record_id", "chunk_no").collect()
    payload, last = {}, {}
    for r in back:
        payload.setdefault(r["record_id"], []).append(bytes(r["chunk"]))
        assert len(r["chunk"]) <= chunk + 2 or r["last"]
        if r["record_type"] == "response":  # each row carries what has been seen so far
            data = b"".join(payload[r["record_id"]])
            assert r["payload_bytes"] == len(data)
            assert r["payload_digest"] == hashlib.sha256(data).hexdigest()
        last[r["record_id"]] = r
    for page, _, html in rows:
        r = last[f"urn:page:{page}"]
        assert r["last"]
        if r["record_type"] == "response":
            assert b"".join(payload[r["record_id"]]) == (html or "").encode()


def test_archive_is_plain_warc(spark, tmp_path):
    """Read with an independent parser that follows the lengths."""
    rows = tricky()
    path = f"file://{tmp_path}/w"
    warc.write_archive(warc.with_revisits(pages(spark, rows)).coalesce(1), path, 256)
    (file,) = (tmp_path / "w").glob("*.gz")
    data, at, kinds = gzip.open(file).read(), 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.0"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        kinds.append(fields["WARC-Type"])
        at = end + 4 + int(fields["Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds.count("response") + kinds.count("revisit") == len(rows)
    assert "continuation" in kinds


def test_truncated_file(spark, tmp_path):
    whole = (b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 5\r\n"
             b"\r\nhello\r\n\r\n")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.gz").write_bytes(gzip.compress(whole + whole[:-6]))
    (tmp_path / "w" / "b.gz").write_bytes(gzip.compress(whole))
    back = warc.read_archive(spark, f"file://{tmp_path}/w").where("last").collect()
    assert [(r["record_id"], bytes(r["chunk"])) for r in back] == [("urn:page:1", b"hello")] * 2


def test_empty(spark):
    assert warc.report(pages(spark, [])).collect() == []


def test_many_copies(spark):
    df = spark.range(2000).select(
        F.col("id").alias("page_id"),
        F.lit("u").alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("c" * 300)).otherwise(F.col("id").cast("string")).alias("html"),
    )
    out = warc.report(df)
    assert out.where("record_type = 'revisit' AND refers_to = 0").count() == 666
