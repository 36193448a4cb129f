"""WARC archives: writing with revisits and segments, reading with reassembly.

Writing: one record per page, payload the html in UTF-8 in an HTTP response with chunked transfer
framing, one gzip member per record. Of pages with equal payloads of at least ``REVISIT_BYTES``
bytes the one with the largest page_id is a response and the others are revisits that refer to it.
A block longer than ``SEGMENT_BYTES`` is cut: the first segment keeps the record's type, the others
are continuation records with the origin's identifier and their number, the last one with the total
length.

Reading: records that are segments are grouped by origin identifier and ordered by segment number;
the numbers must run from 1 without a gap or repeat and the lengths add up to the total, else the
payload is null and ``complete`` is false. The chunked framing is then decoded. Only segments are
shuffled, and a group is one record's segments.

Null html counts as empty. A null page_id is kept and never refers or is referred to. Rows that
repeat a page_id are records of their own; with equal payloads they are alike (both responses if it
is the largest id). A null url is written as an empty one. Extra columns are ignored; an empty
table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecell.llm.common import scratch, ship, written
from ratecell.llm.files import make_folder, put

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4096
FILE_BYTES = 8 << 20
READ_BYTES = 4 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records ----------------------------------------------------------------------------------------

def chunked(payload: bytes) -> bytes:
    """Chunked transfer framing."""
    out = []
    for a in range(0, len(payload), CHUNK_BYTES):
        part = payload[a:a + CHUNK_BYTES]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes | None:
    """The payload of a chunked body (extensions and trailers are skipped); None if it is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(body[at:end].split(b";")[0].strip(), 16)
        except ValueError:
            return None
        if size < 0:
            return None
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            return None
        out.append(body[at:at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes | None:
    """The payload of an HTTP response block, framing removed."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    if b"transfer-encoding: chunked" in head.lower():
        return unchunked(body)
    return body


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    raw = f"WARC/1.1\r\nWARC-Type: {kind}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def page_records(uid: str, url: str, payload: bytes, sha1: str, refers) -> list[bytes]:
    """The records of one page."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    url = "".join(" " if c in "\r\n" else c for c in url)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    common = [("WARC-Record-ID", f"<urn:page:{uid}>"), ("WARC-Target-URI", url), ("WARC-Date", "2024-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", digest), ("Content-Type", "application/http;msgtype=response")]
    if refers is not None:
        return [record("revisit", [*common, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers}>")], http)]
    block = http + chunked(payload)
    if len(block) <= SEGMENT_BYTES:
        return [record("response", common, block)]
    parts = [block[a:a + SEGMENT_BYTES] for a in range(0, len(block), SEGMENT_BYTES)]
    out = [record("response", [*common, ("WARC-Segment-Number", "1")], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        fields = [("WARC-Record-ID", f"<urn:page:{uid}:{k}>"), ("WARC-Segment-Origin-ID", f"<urn:page:{uid}>"),
                  ("WARC-Segment-Number", str(k)), ("WARC-Date", "2024-01-01T00:00:00Z")]
        if k == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record("continuation", fields, part))
    return out


def records(data: bytes):
    """(headers, block) of each record of a file of gzip members."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, out = zlib.decompressobj(31), []
        while not z.eof and at < len(view):     # a piece at a time: what a member leaves over is copied
            piece = view[at:at + READ_BYTES]
            out.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        raw = b"".join(out) + z.flush()
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        yield fields, rest[:int(fields["content-length"])]


# --- writing ----------------------------------------------------------------------------------------

def plan(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, sha1, refers_to of every page."""
    p = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                     F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("sha1", F.sha1("payload"))
    big = (p.where(F.octet_length("payload") >= REVISIT_BYTES).where("page_id IS NOT NULL").select("page_id", "sha1"))
    # Only digests and ids meet; equal payloads may be a third of all rows.
    last = big.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = big.join(last, "sha1").where("page_id < refers_to").distinct()
    return p.join(again, ["page_id", "sha1"], "left")


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives to ``folder``; returns their names and numbers of records. Files of attempts that
    failed may stay in the folder; those returned are the archive."""
    ship(pages.sparkSession)
    make_folder(folder)

    def run(batches):
        part, number, size, out, done, row = TaskContext.get().partitionId(), 0, 0, [], [], 0

        def flush():
            nonlocal number, size, out
            # A retried task may meet its rows in another order: each attempt writes files of its own.
            name = f"pages-{part:08d}-{number:06d}-{TaskContext.get().taskAttemptId()}.warc.gz"
            put(folder, name, b"".join(out))
            done.append((name, len(out)))
            number, size, out = number + 1, 0, []

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for page, sha1, url, payload, refers in zip(*(c.to_pylist() for c in batch.slice(a, 256).columns)):
                    row += 1
                    for r in page_records(f"{'' if page is None else page}:{part}-{row}", url, payload, sha1, refers):
                        out.append(r)
                        size += len(r)
                    if size >= FILE_BYTES:
                        flush()
        if out:
            flush()
        cols = list(zip(*done)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64())],
                                         ["name", "n_records"])

    p = plan(pages).select("page_id", "sha1", "url", "payload", "refers_to")
    # Written at once: the files come from one run of this job.
    return written(p.mapInArrow(run, "name string, n_records long"), "warc-files")


# --- reading ----------------------------------------------------------------------------------------

_FIELDS = ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to", "warc-payload-digest",
           "warc-segment-number", "warc-segment-origin-id", "warc-segment-total-length")


def read_records(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """One row per record: type, id, uri, refers, digest, segment, origin, total, block. ``files``: the
    files to read, as ``write_archives`` returns them (their names go to the driver, which lists the files
    it reads in any case); without it, every archive in the folder."""
    ship(spark)
    names = ["type", "id", "uri", "refers", "digest", "segment", "origin", "total"]

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in records(data.as_buffer().to_pybytes()):
                    rows.append([*(fields.get(f) for f in _FIELDS), block])
                    if len(rows) == 256:
                        yield _batch(rows, names)
                        rows = []
                yield _batch(rows, names)

    if files is None:
        paths = [folder]
    else:
        paths = [f"{folder}/{r.name}" for r in files.select("name").collect()]
    if paths:
        data = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(paths).select("content")
    else:
        data = spark.createDataFrame([], "content binary")
    r = data.mapInArrow(run, ", ".join(f"{n} string" for n in names) + ", block binary")
    return r.withColumn("segment", F.col("segment").cast("int")).withColumn("total", F.col("total").cast("long"))


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * (len(names) + 1)
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:-1]), pa.array(cols[-1], pa.binary())],
                                      [*names, "block"])


def reassemble(rec: DataFrame) -> DataFrame:
    """One row per logical record: type, id, uri, refers, digest, block, complete."""
    cols = ["type", "id", "uri", "refers", "digest"]
    whole = rec.where("segment IS NULL").select(*cols, "block", F.lit(True).alias("complete"))
    parts = rec.where("segment IS NOT NULL").withColumn("origin", F.coalesce("origin", "id"))
    s = parts.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("segment", "block", "total", *cols))).alias("s"))
    length = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    in_order = F.transform("s", lambda x: x["segment"]) == F.sequence(F.lit(1), F.size("s"))
    ok = F.coalesce(in_order & (F.element_at("s", -1)["total"] == length), F.lit(False))
    first = F.element_at("s", 1)
    joined = s.select(*[first[c].alias(c) for c in cols],
                      F.aggregate("s", F.lit(b""), lambda a, x: F.concat(a, x["block"])).alias("block"), ok.alias("complete"))
    return whole.unionByName(joined.withColumn("block", F.when(F.col("complete"), F.col("block"))))


def read_digests(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """type, id, refers, digest, payload_bytes, payload_digest of every logical record, the payloads read
    once and not kept. Segments that lie together in a file are joined where it is read; the rest, if any, are
    written with their blocks, meet by origin, and are verified as in ``reassemble``."""
    ship(spark)
    paths = [f"{folder}/{r.name}" for r in files.select("name").collect()]
    if not paths:
        return spark.createDataFrame([], "type string, id string, refers string, digest string, payload_bytes long, "
                                         "payload_digest string")

    def logical(fields, block):
        payload = http_payload(block) if fields.get("warc-type") == "response" else None
        said = None if payload is None else (len(payload), hashlib.sha1(payload).hexdigest())
        return [*(fields.get(f) for f in _FIELDS[:5]), *(said or (None, None)), None, None, None, None]

    def read(data):
        parts = {}
        for fields, block in records(data):
            if "warc-segment-number" in fields:
                origin = fields.get("warc-segment-origin-id") or fields["warc-record-id"]
                parts.setdefault(origin, []).append((int(fields["warc-segment-number"]), fields, block))
            else:
                yield logical(fields, block)
        for origin, found in parts.items():
            found.sort(key=lambda x: x[0])
            total = found[-1][1].get("warc-segment-total-length")
            if [k for k, _, _ in found] == list(range(1, len(found) + 1)) and str(sum(len(b) for _, _, b in found)) == total:
                yield logical(found[0][1], b"".join(b for _, _, b in found))
            else:
                for k, fields, block in found:
                    n = fields.get("warc-segment-total-length")
                    yield [*(fields.get(f) for f in _FIELDS[:5]), None, None, k, origin, None if n is None else int(n), block]

    names = ["type", "id", "uri", "refers", "digest", "payload_bytes", "payload_digest", "segment", "origin", "total", "block"]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.binary()]

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                rows = read(data.as_buffer().to_pybytes())
                while part := list(islice(rows, 4096)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)

    data = spark.read.format("binaryFile").load(paths).select("content")
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, ["string"] * 5 + ["long", "string", "int", "string", "long", "binary"]))
    got = written(data.mapInArrow(run, schema), "warc-records")
    loose = reassemble(got.where("segment IS NOT NULL").drop("payload_bytes", "payload_digest"))
    loose = loose.withColumn("payload", _payload()("type", "block"))
    out = ["type", "id", "refers", "digest"]
    return got.where("segment IS NULL").select(*out, "payload_bytes", "payload_digest").unionByName(
        loose.select(*out, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")))


def _payload():
    @F.pandas_udf("binary")
    def payload(kind: pd.Series, block: pd.Series) -> pd.Series:
        return pd.Series([http_payload(bytes(b)) if k == "response" and b is not None else None
                          for k, b in zip(kind, block)], dtype=object)

    return payload


_PAGE = r"^<urn:page:(-?\d+)"


def read_pages(spark: SparkSession, folder: str, files: DataFrame | None = None) -> DataFrame:
    """page_id, record_type, refers_to, uri, payload (null for revisits), digest, complete."""
    r = reassemble(read_records(spark, folder, files))
    return r.select(F.regexp_extract("id", _PAGE, 1).try_cast("long").alias("page_id"), F.col("type").alias("record_type"),
                    F.regexp_extract("refers", _PAGE, 1).try_cast("long").alias("refers_to"), "uri",
                    _payload()("type", "block").alias("payload"), "digest", "complete")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, from the
    archives; a revisit's payload is that of the response it refers to."""
    spark = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    p = read_digests(spark, folder, write_archives(pages, folder)).select(
        F.regexp_extract("id", _PAGE, 1).try_cast("long").alias("page_id"), F.col("type").alias("record_type"),
        F.regexp_extract("refers", _PAGE, 1).try_cast("long").alias("refers_to"), "digest", "payload_bytes", "payload_digest")
    said = p.where("record_type = 'response'")
    there = (said.select(F.col("page_id").alias("refers_to"), "digest", F.col("payload_bytes").alias("b"),
                         F.col("payload_digest").alias("d")).distinct())
    revisit = (p.where("record_type = 'revisit'").join(there, ["refers_to", "digest"], "left")
               .select("page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to"))
    return said.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(revisit)


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
l AS (
  SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN l ON p.payload_digest = l.payload_digest AND payload_bytes >= 1000
"""
