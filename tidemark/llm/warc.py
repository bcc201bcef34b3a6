"""WARC archives: a deduplicating writer, and a splittable reader of gzip members."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Table, batch, map_batches, may_be_among, shared_path

_MAGIC = b"\x1f\x8b\x08"
_HEAD = 64


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that pyarrow knows by its address: file, hdfs, s3, gs."""
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decide(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0, salts: int = 64) -> DataFrame:
    """page_id, url, payload (never null), digest, refers_to (null for responses).

    Digests that occur twice are found first, from (digest, id) alone. Pages whose digest can't be one of them are responses
    where they stand; only the others are shuffled with their payloads. Copies are counted per digest and salt before per
    digest, and joined back per digest and salt, so that no digest, even of a third of all pages, meets in one task. Of
    equal payloads that with the largest page_id is the response; rows that repeat the largest id are responses too. A null
    id counts as less than any other.
    """
    p = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        (F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")).alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)))
    large = p.where(F.octet_length("payload") >= min_bytes)
    parts = large.groupBy("sha", "salt").agg(F.max("page_id").alias("m"), F.count("*").alias("n"))
    best = parts.groupBy("sha").agg(F.max("m").alias("best"), F.collect_set("salt").alias("salts"))
    best = best.select("sha", "best", F.explode("salts").alias("salt"))
    several = parts.groupBy("sha").agg(F.sum("n").alias("n")).where("n > 1").select("sha")
    doubtful = p.withColumn("doubtful", may_be_among(F.col("sha"), several))
    alone = doubtful.where("not doubtful").withColumn("best", F.col("page_id"))
    joined = doubtful.where("doubtful").join(best, ["sha", "salt"], "left").unionByName(alone, allowMissingColumns=True)
    revisit = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("best"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("best")).alias("refers_to"))


def _record(page_id, url, payload: bytes, refers_to, date: str, level: int) -> bytes:
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else "%%%02X" % ord(c) for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", payload_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 2) -> DataFrame:
    """Writes a gzip member per row to archives under `path` and returns the manifest (file, bytes, records).

    Every task attempt writes a file of its own name; only files in the manifest, itself written under Spark's commit
    protocol, are part of the result, so retried and speculative attempts do no harm.

    A null payload is an empty one; a null id is written as an empty name and may be referred to only if all equal payloads
    lack one; rows that repeat an id are records each, responses if it is the largest of their payload; a null url has no
    header. An empty table writes no archive and gives an empty manifest. Other columns are ignored.
    """
    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
    fs, base = _open(path)
    fs.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(path)
        name, size, n, out = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                data = _record(*row, date, level)
                out.write(data)
                size, n = size + len(data), n + 1
        if out is not None:
            out.close()
            yield batch(schema, [f"{path}/{name}"], [size], [n])

    chosen = decide(pages, id_col, payload_col, min_bytes)
    return Table(map_batches(chosen, run, "file string, bytes long, records long"), "warc-manifest").df


def _header(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = raw.decode("utf-8", "replace").split("\r\n")
    return first, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in rest if ":" in x)}


def members(f, start: int, end: int, size: int, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of the WARC members that start in [start, end); (offset, None) where one is damaged.

    Finds gzip magic bytes, believes a candidate only if what it inflates to begins as a WARC record and the member's
    checksum holds, and looks on one byte later if not. The last member is read past `end` to its own end. At the file's
    start, and where a member ends, another one must begin: if none does, that place is told as damaged, by the range of the
    member before.
    """
    held, at, due = b"", start, start == 0  # held: bytes of the file from `at`; due: a member must begin there

    def more(upto: int) -> bool:
        nonlocal held
        f.seek(at + len(held))
        new = f.read(min(upto, size - at - len(held)))
        held += new
        return bool(new)

    while at < end or due and at < size:
        i = held.find(_MAGIC)
        if due and i and (i > 0 or len(held) > 2):
            yield at, None
            due = False
        if i < 0:
            keep = min(len(held), 2)
            at, held = at + len(held) - keep, held[len(held) - keep :]
            if at >= end and not due or not more(chunk):
                return
            continue
        at, held = at + i, held[i:]
        if at >= end and not due:
            return
        z, out, used, good = zlib.decompressobj(31), [], 0, True
        checked = 0
        while True:
            part = held[used:]
            used = len(held)
            try:
                if part:
                    out.append(z.decompress(part))
            except zlib.error:
                good = False
                break
            if checked < 5:
                head = b"".join(out)[:5]
                checked = len(head)
                if not b"WARC/".startswith(head):
                    good = False
                    break
            if z.eof:
                break
            if not more(chunk):
                good = False
                break
        if at >= end:
            if not (good and checked == 5):
                yield at, None
            return
        if good and checked == 5:
            yield at, b"".join(out)
            skip, due = used - len(z.unused_data), True
        else:
            if due:
                yield at, None
            skip, due = 1, False
        at, held = at + skip, held[skip:]


def read_warc(spark: SparkSession, manifest: DataFrame, split_bytes: int = 32 << 20, payloads: bool = True) -> DataFrame:
    """Reads archives (columns file and bytes) back as rows, in tasks of byte ranges that need no index.

    Columns: file, offset, record_id, record_type, url, refers_to, payload_digest (as the header has it), payload_sha1 (of
    the payload that is there), http_length (of the payload where it is there; of revisits what the HTTP header keeps),
    payload. A record belongs to the range it starts in, so every split size gives the same rows.

    Nothing goes unseen: a place where a member should begin and none can be read, or a record whose block is shorter than
    its header says, is a row of record_type "damaged", with null columns but for file and offset. Reading goes on at the
    next member. Null or empty files, and an empty manifest, give no rows. A manifest that names a file twice reads it twice.
    """
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_sha1", pa.string()), ("http_length", pa.int64()), ("payload", pa.binary())])
    n = F.greatest(F.lit(1), F.ceil(F.col("bytes") / split_bytes)).cast("int")
    ranges = manifest.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    ranges = ranges.select("file", (F.col("k") * F.lit(split_bytes)).cast("long").alias("start"), F.least(F.col("bytes"), (F.col("k") + 1) * F.lit(split_bytes)).cast("long").alias("end"), "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start, end, size in zip(*(c.to_pylist() for c in b.columns)):
                fs, path = _open(file)
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    for offset, content in members(f, start, end, size):
                        raw, _, block = (content or b"").partition(b"\r\n\r\n")
                        _, h = _header(raw)
                        if content is None or len(block) < (length := int(h.get("content-length", 0))):
                            rows.append((file, offset, None, "damaged", *[None] * 6))
                            continue
                        http, _, payload = block[:length].partition(b"\r\n\r\n")
                        _, hh = _header(http)
                        kind = h.get("warc-type")
                        there = kind == "response"
                        rows.append((file, offset, h.get("warc-record-id"), kind, h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest", "").removeprefix("sha1:"), digest(payload) if there else None, len(payload) if there else int(hh.get("content-length", 0)), payload if there and payloads else None))
                        held += len(content) if payloads else 0
                        if held > 16 << 20 or len(rows) >= 4096:
                            yield batch(schema, *([r[i] for r in rows] for i in range(10)))
                            rows, held = [], 0
                yield batch(schema, *([r[i] for r in rows] for i in range(10)))

    tasks = max(1, ranges.count())
    dealt = ranges.repartition(tasks)
    return map_batches(dealt, run, "file string, offset long, record_id string, record_type string, url string, refers_to string, payload_digest string, payload_sha1 string, http_length long, payload binary")


def archive_dir(spark: SparkSession) -> str:
    return shared_path(spark, "warc")
