"""WARC archives, index first.

Writing: each task writes one gzip-per-record archive into a shared folder and returns an index row
per record (file, offset, length, URL, digest). The index is a table; an archive that a lost task
left behind is never in it. Reading: the selected index rows are dealt out by archive and block,
sorted by offset, neighbouring ranges are read with one request, and each record is parsed.

Defined cases: a null html is an empty payload; equal payloads at or over `min_bytes` are stored
once, by the rows with the smallest id, and the others become revisit records; with repeated ids
every row of the smallest id is a response; an empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, shared_dir, small_batches

#: A read request covers records that lie at most this far apart,
GAP = 64 << 10
#: and is not longer than this unless one record is.
READ = 8 << 20
#: Records of an archive within so many bytes go to one reading task.
BLOCK = 64 << 20
#: Archives are written in pieces of this size.
WRITE = 4 << 20

INDEX = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, "
    "file string, offset long, length long"
)
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def _record(kind: str, url: str, record_id: str, digest: str, payload: bytes, size: int, refers: str | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{refers}>",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page_of(identifier: str) -> int | None:
    text = identifier.strip("<>").rpartition(":")[2]
    return int(text) if text else None


def _one_line(url: str | None) -> str:
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        name, out, at, held, waiting = f"{uuid.uuid4().hex}.warc.gz", None, 0, [], 0
        rows: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode("utf-8", "surrogatepass")
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                refers = None if row["first_id"] is None else record_id(row["first_id"])
                kind = "response" if refers is None else "revisit"
                data = _gzip(_record(kind, _one_line(row["url"]), record_id(row["page_id"]), digest, payload, len(payload), refers))
                if out is None:
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                rows.append((row["page_id"], row["url"], kind, row["first_id"], digest, name, at, len(data)))
                at += len(data)
                held.append(data)
                waiting += len(data)
                if waiting > WRITE:
                    out.write(b"".join(held))
                    held, waiting = [], 0
        if out is not None:
            out.write(b"".join(held))
            out.close()
        # index rows leave only when the archive is whole
        names = [f.split()[0] for f in INDEX.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        for k in range(0, len(rows), 10_000):
            columns = list(zip(*rows[k : k + 10_000], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return write


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> tuple[DataFrame, str]:
    """Write a record for each row of pages (page_id, url, html); return the index and the archives' folder.

    The smallest id of each digest is found with a map-side minimum. Only digests that occur twice
    or more meet the pages again, in a left join that Spark can split where one payload is hot.
    """
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("_digest"), F.octet_length(html).alias("_bytes"))
    firsts = (
        keyed.where(F.col("_bytes") >= min_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .select("_digest", "_first")
    )
    joined = keyed.join(firsts, "_digest", "left").select(
        "page_id",
        "url",
        F.when(F.col("_first") < F.col("page_id"), F.col("_first")).alias("first_id"),
        "html",
    )
    return materialise(joined.mapInArrow(_writer(folder), INDEX), "warc-index"), folder


def _parse(data: bytes) -> dict:
    head, _, block = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"fields": fields, "payload": payload, "size": size}


def _reader(folder: str, keep_payload: bool):
    def one(row: dict, data: bytes) -> tuple:
        record = _parse(zlib.decompress(data, 31))
        fields, payload = record["fields"], record["payload"]
        stored = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if digest != stored or size != record["size"]:
                raise ValueError(f"archive {row['file']} is damaged at {row['offset']}")
        else:
            size, digest = record["size"], stored
        refers = _page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
        out = (_page_of(fields["WARC-Record-ID"]), row["url"], kind, refers, size, digest)
        return (*out, payload.decode("utf-8", "surrogatepass") if kind == "response" else None) if keep_payload else out

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        name, source = None, None
        names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * keep_payload
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * keep_payload
        for batch in batches:
            rows, k, found = batch.to_pylist(), 0, []
            while k < len(rows):
                end, start = k + 1, rows[k]["offset"]
                stop = start + rows[k]["length"]
                while end < len(rows) and rows[end]["file"] == rows[k]["file"] and rows[end]["offset"] - stop <= GAP and rows[end]["offset"] + rows[end]["length"] - start <= READ:
                    stop = max(stop, rows[end]["offset"] + rows[end]["length"])
                    end += 1
                if name != rows[k]["file"]:
                    if source is not None:
                        source.close()
                    name = rows[k]["file"]
                    source = fs.open_input_file(f"{path}/{name}")
                data = source.read_at(stop - start, start)
                found += [one(r, data[r["offset"] - start : r["offset"] - start + r["length"]]) for r in rows[k:end]]
                k = end
            if found:
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
        if source is not None:
            source.close()

    return read


def read_records(selected: DataFrame, folder: str, keep_payload: bool = False) -> DataFrame:
    """Read the records of the selected index rows: neighbours in an archive with one request."""
    # by the bytes they point to: the index rows themselves are too small to be dealt out by their own size
    tasks = 1 + (selected.agg(F.sum("length")).first()[0] or 0) // BLOCK
    dealt = (
        selected.select("url", "file", "offset", "length")
        .withColumn("_block", F.expr(f"offset div {BLOCK}"))
        .repartition(int(tasks), "file", "_block")
        .sortWithinPartitions("file", "offset")
        .drop("_block")
    )
    return dealt.mapInArrow(_reader(folder, keep_payload), RECORD + ", payload string" * keep_payload)


def archive_pages(pages: DataFrame) -> DataFrame:
    index, folder = write_archives(pages)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )


def archive_sql() -> str:
    """The same in DuckDB, base32 spelled out five hex digits at a time."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    chars = []
    for k in range(8):
        v = f"('0x' || substr(sha1(html), {5 * k + 1}, 5))::BIGINT"
        chars += [f"substr('{alphabet}', ({v} >> {s}) % 32 + 1, 1)" for s in (15, 10, 5, 0)]
    return f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS low FROM p GROUP BY html)
SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, {" || ".join(chars)} AS payload_digest,
  CASE WHEN page_id > low THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > low THEN low END AS refers_to
FROM p JOIN f USING (html)"""
