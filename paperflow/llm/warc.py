"""Web archives: records written through Spark's text writer, and read back by boundary-chain verification.

A file is read in splits at every "WARC/", which may also stand inside a
payload. Each that begins a version line, whatever the version, and a header
with a content length is a candidate, and names its successor's offset.
Candidates whose successor is simply the next one form runs; pointer jumping
over runs, from each file's start, keeps the candidates that the chain reaches,
and what lies between two of them belongs to the first.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, column, shared_dir, stored

#: Fixed values of the format.
MAGIC, END = "WARC/1.0\r\n", "\r\n\r\n"
#: What every record begins with, and what follows it.
SPLIT, VERSION = "WARC/", r"^[0-9]{1,3}\.[0-9]{1,3}\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:paperflow:page:"
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"

RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record without its closing blank lines. The payload stands in it as it is; a revisit has only the headers."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}"
    block = http.encode() + (payload if refers_to is None else b"")
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", "%0A", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return (MAGIC + "\r\n".join(head) + END).encode("utf-8", "surrogatepass") + block


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, html, refers_to): the largest page_id with the same payload of at least `least` bytes, else null."""
    known = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    long = known.where(F.octet_length("html") >= least)
    # written first, so that Spark knows its size when it picks the join
    shared = stored(long.groupBy("sha1").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", "first"), "payloads")
    joined = known.join(shared, "sha1", "left")
    refers = F.when((F.octet_length("html") >= least) & (F.coalesce("page_id", F.col("first") - 1) != F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """One record for each row (page_id, url, html) below `path`, as many files as partitions.

    Null payloads are empty, null urls have no target. Of equal payloads of at
    least LEAST_REVISIT bytes the record of the largest page_id holds the
    payload, the others refer to it; rows repeated under that page_id all hold it.
    """
    bounded_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(column(batch, c) for c in ("page_id", "url", "html", "refers_to")))
            yield pa.RecordBatch.from_arrays([pa.array([record(p, u, h.encode("utf-8", "surrogatepass"), r, date) for p, u, h, r in rows], pa.binary())], names=["record"])

    records = with_revisits(pages).mapInArrow(run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END).option("compression", "none").text(path)


def segments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Places (file, block, seq, at, width, next) and bytes (file, block, seq, raw) from each SPLIT to the next; next is the successor's offset that its header names, else null."""
    lines = spark.read.option("lineSep", SPLIT).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract(head, r"(?i)(?:^|\n)content-length:[ \t]*([0-9]{1,18})[ \t]*(?:\r|$)", 1)
    size = F.when(F.col("value").rlike(VERSION) & (F.octet_length(head) < F.octet_length("value")), F.octet_length(head) + 2 * len(END) + F.nullif("length", F.lit("")).try_cast("long"))
    found = lines.withColumn("length", length).select("file", "block", "seq", (F.octet_length("value") + len(SPLIT)).cast("long").alias("width"), size.cast("long").alias("size"), F.col("value").cast("binary").alias("raw"))
    rows = stored(found, "segments", compression="zstd")
    place = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.select("file", "block", "seq", "width", "size", (F.coalesce(F.sum("width").over(place), F.lit(0)) - len(SPLIT)).alias("at"))
    # what stands before a file's first magic line is no candidate
    narrow = stored(placed.withColumn("next", F.when(F.col("at") >= 0, F.col("at") + len(SPLIT) + F.col("size"))), "places")
    return narrow, rows


def chained(places: DataFrame) -> DataFrame:
    """(file, at): the candidates that the chain from the file's start reaches."""
    order = Window.partitionBy("file").orderBy("at")
    known = places.where("next is not null").select("file", "at", "next")
    broken = F.coalesce((F.lag("next").over(order) != F.col("at")).cast("long"), F.lit(1))
    runs = stored(known.withColumn("broken", broken).select("file", "at", "next", F.sum("broken").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("run")), "runs")
    exits = runs.groupBy("file", "run").agg(F.max("next").alias("next"))
    heads = runs.select("file", F.col("at").alias("next"), F.col("run").alias("to"))
    jumps = stored(exits.join(heads, ["file", "next"]).select("file", "run", "to", F.col("next").alias("entry")), "jumps")
    reached = stored(runs.where("at = 0").select("file", "run", F.col("at").alias("entry")), "reached")
    while not jumps.isEmpty():
        step = reached.select("file", "run").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        reached = stored(reached.unionByName(step), "reached")
        onward = jumps.select("file", F.col("run").alias("to"), F.col("to").alias("far"), F.col("entry").alias("far_entry"))
        jumps = stored(jumps.join(onward, ["file", "to"]).select("file", "run", F.col("far").alias("to"), F.col("far_entry").alias("entry")), "jumps")
    return runs.join(reached, ["file", "run"]).where("at >= entry").select("file", "at")


def whole_records(spark: SparkSession, path: str) -> DataFrame:
    """(raw): the bytes of every verified record, without the "WARC/" that it begins with.

    Nearly every record is one segment, which stays where it is. The others
    (parts of payloads with a magic line in them, and what no chain reaches) are
    listed, and only these are joined to their bytes.
    """
    places, rows = segments(spark, path)
    good = stored(chained(places).withColumn("good", F.lit(True)), "chain")
    marked = places.join(good, ["file", "at"], "left")
    owner = F.last(F.when(F.col("good"), F.struct(F.col("at").alias("record"), F.col("next").alias("end"))), ignorenulls=True).over(Window.partitionBy("file").orderBy("at"))
    alone = F.coalesce(F.col("good") & (F.col("next") - F.col("at") == F.col("width")), F.lit(False))
    others = stored(marked.select("file", "block", "seq", "at", owner.alias("owner"), alone.alias("alone")).where("not alone").select("file", "block", "seq", "at", "owner.*"), "others")
    keys = ["file", "block", "seq"]
    single = rows.select(*keys, "raw").join(others.select(*keys), keys, "left_anti").select("raw")
    parts = rows.select(*keys, "raw").join(others.where("record is not null and at < end"), keys)
    magic = F.lit(SPLIT).cast("binary")
    together = F.sort_array(F.collect_list(F.struct("at", "raw")))
    joined = F.aggregate(F.slice(together, 2, 1_000_000_000), together[0]["raw"], lambda a, x: F.concat(a, magic, x["raw"]))
    # the closing blank lines of a file's last record may be missing, nothing else
    whole = F.octet_length("raw") + len(SPLIT) + len(END) >= F.col("end") - F.col("record")
    return single.unionByName(parts.groupBy("file", "record", "end").agg(joined.alias("raw")).where(whole).select("raw"))


def field(head: bytes, name: str, value: bytes = rb"[^\r\n]*") -> str | None:
    """The first value of a header that is like this; bytes that are not UTF-8 are replaced."""
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(" + value + rb")[ \t]*\r?$", head)
    return m and m[1].decode("utf-8", "replace").strip()


def number(urn: str | None) -> int | None:
    m = re.search(rf"{URN}(-?[0-9]{{1,18}})>?$", urn or "")
    return int(m[1]) if m else None


def unchunked(body: bytes) -> bytes:
    """A body without the marks of its chunks; one that does not hold such marks, as of writers that took them out, as it is."""
    out, at = [], 0
    while True:
        m = re.compile(rb"([0-9A-Fa-f]{1,15})[ \t]*(?:;[^\r\n]*)?\r\n").match(body, at)
        if not m:
            return body
        size, start = int(m[1], 16), m.end()
        if not size:
            return b"".join(out)
        if body[start + size : start + size + 2] != b"\r\n":
            return body
        out.append(body[start : start + size])
        at = start + size + 2


def parsed(raw: bytes) -> tuple[dict, bytes | None]:
    """Fields of a record, and its payload; a revisit has none, and its size and digest are those that its headers name.

    Chunks of a body are put together, and gzip is undone. A record whose
    payload cannot be decoded is of type damaged: no size, the digest that it
    names, no payload.
    """
    head, _, rest = raw.partition(END.encode())
    # the length that its place in the file was verified by
    block = rest[: int(field(head, "Content-Length", rb"[0-9]{1,18}") or 0)]
    http, _, body = block.partition(END.encode())
    kind, digest = field(head, "WARC-Type"), (field(head, "WARC-Payload-Digest") or "").removeprefix("sha1:") or None
    out = {"page_id": number(field(head, "WARC-Record-ID")), "url": field(head, "WARC-Target-URI"), "record_type": kind, "refers_to": number(field(head, "WARC-Refers-To"))}
    if kind == "revisit":
        size = field(http, "Content-Length") or "0"
        return out | {"payload_bytes": int(size) if size.isascii() and size.isdigit() and len(size) < 19 else None, "payload_digest": digest}, None
    try:
        payload = unchunked(body) if (field(http, "Transfer-Encoding") or "").lower() == "chunked" else body
        payload = gzip.decompress(payload) if (field(http, "Content-Encoding") or "").lower() == "gzip" else payload
    except (OSError, EOFError, zlib.error):
        return out | {"record_type": "damaged", "payload_bytes": None, "payload_digest": digest}, None
    return out | {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest()}, payload


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row for each verified record below `path`: RECORD, and the payload's bytes (null for revisits) if asked for.

    Sizes and digests are taken from the payload read. A file that does not
    begin with a record has none; a chain ends where no record follows.
    """
    bounded_batches(spark)
    schema = RECORD + ", payload binary" * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parsed(x) for x in column(batch, "raw")]
            names = [x.split()[0] for x in RECORD.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string()}
            arrays = [pa.array([r[0][n] for r in rows], kinds[x.split()[1]]) for n, x in zip(names, RECORD.split(", "))]
            yield pa.RecordBatch.from_arrays([*arrays, *([pa.array([r[1] for r in rows], pa.binary())] if payload else [])], names=[*names, *(["payload"] if payload else [])])

    return whole_records(spark, path).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read those back, without the payloads."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, payload=False)
