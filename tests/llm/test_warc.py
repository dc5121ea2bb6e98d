import gzip
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperflow.llm import warc
from paperflow.llm.common import shared_dir


def brute(rows):
    same = defaultdict(list)
    for page, _, html in rows:
        same[(html or "").encode()].append(page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = max((p for p in same[raw] if p is not None), default=None)
        revisit = len(raw) >= 1000 and first is not None and page != first
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def tricky():
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    inner = (warc.record(900, "u", noise(40).encode(), None, warc.DATE) + b"\r\n\r\n").decode("latin-1")
    long = noise(1500)
    return [
        (7000, None, None), (7001, "", "x" * 2000), (7002, "a\r\nb", "x" * 2000), (None, "n", "x" * 2000), (None, "n", ""), (7002, "again", "x" * 2000),
        (7003, "m", inner), (7004, "m", warc.MAGIC), (7005, "q", f"zé {warc.MAGIC}Content-Length: 5\r\n\r\nhello"), (7006, "m", noise(30) + inner + noise(30)), (7007, "m", warc.MAGIC * 2 + noise(9)),
        (7008, "l", long + inner), (7009, "l", long + inner), (7010, "t", "y" * 999), (7011, "t", "y" * 999), (7012, "t", "y" * 1000), (7013, "t", "y" * 1000), (7014, "e", "\r\n\r\n"),
    ]


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_round_trip(spark, data, split):
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = spark.read.parquet(f"{data}/pages.parquet").select("page_id", "url", "html").union(spark.createDataFrame(tricky(), "page_id long, url string, html string")).repartition(3)
        got = warc.round_trip(pages.withColumn("payload_bytes", F.lit(1)))
        rows = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got.collect()), key=str)
        assert rows == brute([tuple(r) for r in pages.collect()])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_embedded_records_are_not_found_and_payloads_come_back(spark):
    rows = tricky()
    path = shared_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    found = warc.read_archives(spark, path).collect()
    assert len(found) == len(rows)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in found if r["record_type"] == "response" and r["page_id"]}
    assert all(payloads[p] == (h or "").encode() for p, _, h in rows if p in payloads)
    assert {7003, 7004, 7005, 7006, 7007} <= set(payloads)


def test_magic_lines_of_stored_payloads_are_no_records(spark, tmp_path):
    rows = [(n, "u", f"page {n}\n{warc.MAGIC}Content-Length: {n}\r\n\r\nnot a record {n}") for n in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_dir(spark, "warc")
    warc.write_archives(df.repartition(3), path)
    raw = b"".join(p.read_bytes() for p in Path(path.removeprefix("file://")).glob("part-*"))
    assert raw.count(warc.MAGIC.encode()) == 80 and b"not a record 7" in raw
    found = warc.read_archives(spark, path).collect()
    assert sorted((r["page_id"], bytes(r["payload"]).decode()) for r in found) == sorted((n, h) for n, _, h in rows)


def test_damaged_records_are_set_aside(spark, tmp_path):
    def record(n, coding, body, length=None):
        http = b"HTTP/1.1 200 OK\r\n" + coding + f"Content-Length: {length or len(body)}\r\n\r\n".encode() + body
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <{warc.URN}{n}>\r\nContent-Length: {len(http)}\r\n\r\n".encode() + http + b"\r\n\r\n"

    packed = gzip.compress(b"hello")
    coding = b"Content-Encoding: gzip\r\n"
    revisit = record(5, b"", b"", "many").replace(b"response", b"revisit")
    (tmp_path / "a").write_bytes(record(1, coding, packed) + record(2, coding, packed[:9]) + record(3, coding, b"no gzip") + record(4, b"", b"plain", "x") + revisit + record(6, b"", b"last"))
    got = {r["page_id"]: (r["record_type"], r["payload_bytes"], r["payload"] and bytes(r["payload"])) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {1: ("response", 5, b"hello"), 2: ("damaged", None, None), 3: ("damaged", None, None), 4: ("response", 5, b"plain"), 5: ("revisit", None, None), 6: ("response", 4, b"last")}


def test_records_of_other_writers(spark, tmp_path):
    """Other versions, headers that are not UTF-8, a length that is no number before one that is, chunked bodies."""

    def record(n, version, extra, body, http=b""):
        block = b"HTTP/1.1 200 OK\r\n" + http + b"\r\n" + body
        return b"WARC/" + version + b"\r\nWARC-Type: response\r\n" + extra + f"WARC-Record-ID: <{warc.URN}{n}>\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    chunked = b"Transfer-Encoding: chunked\r\n"
    (tmp_path / "a").write_bytes(
        record(1, b"1.1", b"", b"one WARC/1.1\r\nContent-Length: 3\r\n\r\nabc") + record(2, b"0.18", "WARC-Target-URI: http://x/caf\u00e9\r\n".encode("latin-1"), b"two WARC/ WARC/1.0")
        + record(3, b"1.0", b"Content-Length: x\r\n", b"three") + record(4, b"1.1", b"", b"4\r\nfour\r\n3;a=b\r\n, 4\r\n0\r\n\r\n", chunked) + record(5, b"1.1", b"", b"no chunks", chunked)
        + record(6, b"1.1", b"", b"%x\r\n%s\r\n0\r\n\r\n" % (len(gzip.compress(b"six")), gzip.compress(b"six")), chunked + b"Content-Encoding: gzip\r\n")
    )
    got = {r["page_id"]: (r["record_type"], bytes(r["payload"])) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    payloads = [b"one WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", b"two WARC/ WARC/1.0", b"three", b"four, 4", b"no chunks", b"six"]
    assert got == {n: ("response", x) for n, x in enumerate(payloads, 1)}
    assert warc.read_archives(spark, str(tmp_path)).where("page_id = 2").first()["url"] == "http://x/caf\ufffd"


def test_files_that_begin_with_something_else_or_break_off(spark, tmp_path):
    one = warc.record(1, "u", b"abc", None, warc.DATE) + b"\r\n\r\n"
    (tmp_path / "a").write_bytes(one + one + b"WARC/1.0\r\nContent-Length: x\r\n\r\n" + one)
    (tmp_path / "b").write_bytes(b"junk" + one)
    (tmp_path / "c").write_bytes(b"")
    (tmp_path / "d").write_bytes(one + one[:-4])
    (tmp_path / "e").write_bytes(one + one[:-6])
    assert warc.read_archives(spark, str(tmp_path)).count() == 2 + 2 + 1


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
