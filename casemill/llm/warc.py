"""Writing WARC archives and reading them back in splits.

Each record is a gzip member of its own. The reader deals out byte ranges of the files: a task
looks for the gzip magic number in its range, takes each place for a candidate, decodes it and
keeps it if it is a whole member (checksum included) that starts with a WARC header. A record
belongs to the range in which it starts, and is read beyond the range's end. After a member the
scan goes on at its end, so false magic inside compressed data only matters in front of a range's
first record; a payload that is itself a WARC file could give one, and such records lie inside
another one and are dropped by comparing the ranges' ends (``drop_nested``).

Files are written and read through ``pyarrow.fs`` (local and mounted paths, hdfs, s3, gs). Every
attempt of a task writes files of its own; only those in the written manifest count.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernel
from .tables import cut, scratch_path, ship, table

ARCHIVE_BYTES = 128 << 20
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 18
MAGIC = b"\x1f\x8b\x08"
# fixed values of the format
VERSION = b"WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages have no time of capture

MANIFEST = "path string, size long, records long"
RECORD = (
    "path string, split long, start long, end long, record_type string, page_id long, url string, "
    "digest string, refers_to long, payload_length long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, sha: str, refers_to) -> bytes:
    """One record, not yet compressed. A revisit has no payload but its length and digest."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{sha}",
        "WARC-Profile": REVISIT if revisit else None,
        "WARC-Refers-To": _record_id(refers_to) if revisit else None,
        "X-Page-Id": page_id,
        "X-Refers-To-Page-Id": refers_to,
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers.items() if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write(folder: str):
    def run(batches):
        fs, top = pafs.FileSystem.from_uri(folder)
        fs.create_dir(top, recursive=True)
        out, name, size, count = None, None, 0, 0
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name, size, count = f"{top}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(name, compression=None)
                member = _member(record(row["page_id"], row["url"], row["payload"], base64.b32encode(bytes.fromhex(row["sha"])).decode(), row["refers_to"]))
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((name, size, count))
        if out is not None:
            out.close()
            done.append((name, size, count))
        path, size, count = (list(c) for c in zip(*done)) if done else ([], [], [])
        yield kernel.rows(path=pa.array(path, pa.string()), size=pa.array(size, pa.int64()), records=pa.array(count, pa.int64()))

    return run


def write_warc(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write a record for each row (page_id, url, html) into ``folder``; returns the manifest.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the smallest page_id is
    a response and the others are revisits of it; smaller payloads are all responses. Null html is
    an empty payload. Rows that share the smallest id are all responses, and so are those without
    any id among them; a row without id next to ids is a revisit."""
    ship(pages.sparkSession)
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha"))
    groups = (
        hashed.where(F.octet_length("payload") >= min_bytes).groupBy("sha")
        .agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1").select("sha", "first")
    )
    rows = hashed.join(groups, "sha", "left")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return cut(rows.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "payload", "sha", refers.cast("long").alias("refers_to")).mapInArrow(_write(folder), MANIFEST))


def parse(data: bytes) -> dict | None:
    """The parts of an uncompressed record; None if it isn't one."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        return None
    headers = {}
    for line in lines[1:]:
        key, _, value = line.decode("utf-8", "replace").partition(":")
        headers[key.strip().lower()] = value.strip()
    try:
        block = rest[: int(headers.get("content-length", ""))]
    except ValueError:
        return None
    number = lambda k: int(headers[k]) if headers.get(k, "").lstrip("-").isdigit() else None
    kind = headers.get("warc-type")
    payload = block
    if headers.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    return {
        "record_type": kind, "page_id": number("x-page-id"), "url": headers.get("warc-target-uri"),
        "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None, "refers_to": number("x-refers-to-page-id"),
        "payload_length": number("x-payload-length"), "payload": None if kind == "revisit" else payload,
    }


def member_at(file, size: int, start: int) -> tuple[bytes, int] | None:
    """The data and the end of the gzip member at ``start``, if it is a whole WARC record."""
    unpack, out, at = zlib.decompressobj(31), [], start
    checked = False
    while not unpack.eof:
        piece = file.read_at(min(READ_BYTES, size - at), at) if at < size else b""
        if not piece:
            return None
        try:
            out.append(unpack.decompress(piece))
        except zlib.error:
            return None
        at += len(piece)
        if not checked and sum(map(len, out)) >= 5:
            if not b"".join(out).startswith(b"WARC/"):
                return None
            checked = True
    data = b"".join(out)
    return (data, at - len(unpack.unused_data)) if data.startswith(b"WARC/") else None


def read_range(file, size: int, lo: int, hi: int):
    """(start, end, parsed record) of the records that start in [lo, hi)."""
    at = lo
    while at < hi:
        piece = file.read_at(min(READ_BYTES, size - at), at)
        found = piece.find(MAGIC)
        if found < 0 or at + found >= hi:
            at += max(1, len(piece) - len(MAGIC) + 1)
            continue
        start = at + found
        reserved = len(piece) > found + 3 and piece[found + 3] & 0xE0
        got = None if reserved else member_at(file, size, start)
        parsed = parse(got[0]) if got else None
        if parsed is None:
            at = start + 1
            continue
        yield start, got[1], parsed
        at = got[1]


def _read(batches):
    kinds = {"path": pa.string(), "split": pa.int64(), "start": pa.int64(), "end": pa.int64(), "record_type": pa.string(), "page_id": pa.int64(), "url": pa.string(), "digest": pa.string(), "refers_to": pa.int64(), "payload_length": pa.int64(), "payload": pa.binary()}
    schema = pa.schema(list(kinds.items()))
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = pafs.FileSystem.from_uri(row["path"])
            held, weight = [], 0
            with fs.open_input_file(path) as file:
                for start, end, parsed in read_range(file, row["size"], row["lo"], row["hi"]):
                    held.append({"path": row["path"], "split": row["lo"], "start": start, "end": end, **parsed})
                    weight += len(parsed["payload"] or b"") + 200
                    if weight > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, weight = [], 0
            yield pa.RecordBatch.from_pylist(held, schema)


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of the files in ``manifest`` (path, size), read by ranges of ``split_bytes``.

    Places that aren't whole WARC members are skipped. Files of no bytes and an empty manifest give
    no rows."""
    spark = ship(manifest.sparkSession)
    count = manifest.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 1
    lo = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    splits = manifest.where("size > 0").select("path", F.col("size").cast("long").alias("size"), lo.alias("lo"))
    splits = splits.withColumn("hi", F.least(F.col("lo") + split_bytes, F.col("size")))
    tasks = max(1, min(count, 100 * spark.sparkContext.defaultParallelism))
    return splits.repartition(tasks, "path", "lo").mapInArrow(_read, RECORD)


def drop_nested(records: DataFrame) -> DataFrame:
    """Without the records that lie inside a record of an earlier range of the same file.

    Only (file, range) and two numbers are shuffled."""
    ends = records.groupBy("path", "split").agg(F.max("end").alias("end"))
    earlier = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    reach = ends.select("path", "split", F.max("end").over(earlier).alias("reach")).where("reach > split")
    return records.join(reach, ["path", "split"], "left").where("reach IS NULL OR start >= reach").drop("reach")


def _digested(batches):
    for batch in batches:
        payload = batch.column("payload").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("path", "split", "start", "end", "page_id", "record_type", "refers_to")]
            + [
                pa.array([len(p) if p is not None else n for p, n in zip(payload, batch.column("payload_length").to_pylist())], pa.int64()),
                pa.array([digest(p) if p is not None else d for p, d in zip(payload, batch.column("digest").to_pylist())], pa.string()),
            ],
            names=["path", "split", "start", "end", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"],
        )


NAME = "op4_splittable_warc"
SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM d
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    kinds = "path string, split long, start long, end long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
    records = cut(read_warc(manifest).mapInArrow(_digested, kinds))
    return drop_nested(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
