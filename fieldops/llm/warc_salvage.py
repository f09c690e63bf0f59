"""WARC writing and a salvage reader (operator 6).

Writing: payloads are compared by SHA-1 and length; of equal ones the row with
the largest id is a response record, the others are revisit records that refer
to it.  Every task writes its own archives, one gzip member a record, and rolls
over to a new one beyond ``ARCHIVE_BYTES``; the staged manifest names only
archives of tasks that ended well.

Reading: each archive is read record by record.  A record counts if its member
or version line, header, length and payload digest are right.  After a failure
the reader looks for the next place where a member or a version line begins a
valid record, goes on from there, and reports the bytes between as a gap.

Cases: null html is an empty payload, compared like any other; a null id never
is the one referred to unless all ids are null; rows with the same id and
payload are all responses where that id is the largest; a null url leaves the
header out; an empty table gives no archive and an empty result; extra columns
are ignored; in an unreadable or empty archive all bytes are one gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldops.llm.common import read, row_slices, staged
from fieldops.session import scratch_path

ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER, VERSION = b"\x1f\x8b\x08", b"WARC/1."
HEADER_MOST = 1 << 20  # bytes of a record's header; a longer one is not a record


def _filesystem(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if path.startswith("file:") else path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit record holds no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Block-Digest: sha1:{digest(block)}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _writing(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        files, base = _filesystem(folder)
        files.create_dir(base, recursive=True)
        made: list[tuple[str, int, int]] = []
        out, name, size, n = None, "", 0, 0

        def close() -> None:
            nonlocal out, size, n
            if out is not None:
                out.close()
                made.append((f"{folder}/{name}", size, n))
            out, size, n = None, 0, 0

        try:
            for whole in batches:
                for rb in row_slices(whole, "html"):
                    for page_id, url, html, refers in zip(*(c.to_pylist() for c in rb.columns), strict=True):
                        if out is None:
                            name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):05d}.warc.gz"
                            out = files.open_output_stream(f"{base}/{name}", compression=None)
                        data = member(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers, refers is not None))
                        out.write(data)
                        size, n = size + len(data), n + 1
                        if size >= ARCHIVE_BYTES:
                            close()
        finally:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())],
                                         names=["path", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Archive every page under ``folder`` (shared by all executors); returns the
    staged manifest (path, bytes, records)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    key = [F.sha1(F.col("html").cast("binary")).alias("sha"), F.octet_length("html").alias("len")]
    equal = (rows.select("page_id", *key).groupBy("sha", "len").agg(F.max("page_id").alias("top"), F.min("page_id").alias("low"), F.count(F.lit(1)).alias("c"), F.count("page_id").alias("ids"))
             .where("c > 1 AND top IS NOT NULL AND (low < top OR ids < c)").select(F.col("sha"), F.col("len"), "top"))
    kinds = rows.select("*", *key).join(equal, ["sha", "len"], "left")
    refers = F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))
    return staged(kinds.select("page_id", "url", "html", refers.alias("refers_to")).mapInArrow(_writing(folder), "path string, bytes long, records long"), "warc-manifest")


class Broken(Exception):
    """The bytes at a place are no valid record."""


def parse_record(data: bytes, whole: bool = True) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, length) of the record that ``data`` begins with."""
    if not data.startswith(VERSION):
        raise Broken("no version line")
    stop = data.find(b"\r\n\r\n", 0, HEADER_MOST)
    if stop < 0:
        raise Broken("no end of header")
    head: dict[str, str] = {}
    for line in data[:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Broken("bad header line")
        head[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not re.fullmatch(r"[0-9]{1,18}", head.get("content-length", "")):
        raise Broken("no content length")
    size = int(head["content-length"])
    block = data[stop + 4:stop + 4 + size]
    end = stop + 4 + size + 4
    if len(block) < size or data[end - 4:end] != b"\r\n\r\n" or whole and len(data) != end:
        raise Broken("wrong length")
    said = head.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != digest(block):
        raise Broken("wrong block digest")
    if head.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        if cut < 0:
            raise Broken("no end of HTTP header")
        payload = block[cut + 4:]
    else:
        payload = block
    said = head.get("warc-payload-digest", "")
    if head.get("warc-type") != "revisit" and said.startswith("sha1:") and said[5:] != digest(payload):
        raise Broken("wrong payload digest")
    return head, payload, end


def _read_at(source, pos: int, n: int) -> bytes:
    source.seek(pos)
    return source.read(n)


def _record_at(source, pos: int, size: int) -> tuple[dict[str, str], bytes, int]:
    """The valid record that begins at ``pos``; reads no more than it needs to tell."""
    start = _read_at(source, pos, len(VERSION))
    if start.startswith(MEMBER):
        z, out, at = zlib.decompressobj(31), [], pos
        first = True
        while not z.eof:
            data = _read_at(source, at, CHUNK if not first else 1 << 16)
            if not data:
                raise Broken("member cut off")
            at += len(data)
            try:
                out.append(z.decompress(data))
            except zlib.error as e:
                raise Broken(f"member: {e}") from None
            if first and out[0] and not out[0].startswith(VERSION[:len(out[0])]):
                raise Broken("member without a record")
            first = False
        head, payload, _ = parse_record(b"".join(out))
        return head, payload, at - len(z.unused_data) - pos
    if start == VERSION:
        data = _read_at(source, pos, 1 << 16)
        while (stop := data.find(b"\r\n\r\n")) < 0 and len(data) < HEADER_MOST and pos + len(data) < size:
            data += _read_at(source, pos + len(data), CHUNK)
        m = re.search(rb"\r\ncontent-length:\s*([0-9]{1,18})\s*\r\n", data[:stop + 2] if stop >= 0 else data, re.I)
        if stop < 0 or not m:
            raise Broken("no content length")
        need = stop + 4 + int(m[1]) + 4
        if pos + need > size:
            raise Broken("record cut off")
        if len(data) < need:
            data += _read_at(source, pos + len(data), need - len(data))
        head, payload, end = parse_record(data[:need], True)
        return head, payload, end
    raise Broken("neither a member nor a version line")


def _candidates(source, pos: int, size: int) -> Iterator[int]:
    """Places from ``pos`` on where a member or a version line begins."""
    either = re.compile(re.escape(MEMBER) + b"|" + re.escape(VERSION))
    keep = len(VERSION) - 1
    while pos < size:
        data = _read_at(source, pos, CHUNK + keep)
        for m in either.finditer(data):
            if m.start() < CHUNK:
                yield pos + m.start()
        pos += CHUNK


def salvage(source, size: int) -> Iterator[tuple[str, int, int, str | None, dict[str, str], bytes | None]]:
    """(kind, offset, length, reason, headers, payload): records, and the gaps
    between them, that together cover ``size`` bytes."""
    pos = 0
    while pos < size:
        try:
            head, payload, n = _record_at(source, pos, size)
        except Broken as e:
            reason, back = str(e), size
            for at in _candidates(source, pos + 1, size):
                try:
                    _record_at(source, at, size)
                except Broken:
                    continue
                back = at
                break
            yield "gap", pos, back - pos, reason, {}, None
            pos = back
            continue
        yield "record", pos, n, None, head, payload
        pos += n


RECORDS = ("path string, kind string, offset long, length long, reason string, warc_type string, record_id string, target_uri string, "
           "payload_digest string, payload_length long, refers_to string, payload binary")


def _reading(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        types = [kinds[c.split()[1]] for c in RECORDS.split(", ")]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for rb in batches:
            for path in rb.column(0).to_pylist():
                files, inner = _filesystem(path)
                size = files.get_file_info(inner).size or 0
                rows, held = [], 0
                with files.open_input_file(inner) as source:
                    for kind, offset, length, reason, head, payload in salvage(source, size):
                        n = head.get("warc-payload-length") if head.get("warc-type") == "revisit" else len(payload or b"")
                        rows.append((path, kind, offset, length, reason, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-target-uri"),
                                     head.get("warc-payload-digest"), None if kind == "gap" or n is None else int(n), head.get("warc-refers-to"), payload if with_payload else None))
                        held += len(payload or b"") + 500
                        if held > 8 << 20:
                            yield made(rows)
                            rows, held = [], 0
                if rows:
                    yield made(rows)
    return run


def read_archives(paths: DataFrame, path: str = "path", with_payload: bool = True) -> DataFrame:
    """Every record and gap (``RECORDS``) of the archives named in ``paths``;
    one archive is the unit of work."""
    spark = paths.sparkSession
    n = max(1, min(paths.count(), 100 * spark.sparkContext.defaultParallelism))
    return paths.select(F.col(path).alias("path")).repartition(n).mapInArrow(_reading(with_payload), RECORDS)


def quarantined(records: DataFrame) -> DataFrame:
    """The log of byte ranges that no valid record covers."""
    return records.where("kind = 'gap'").select("path", "offset", "length", "reason")


def op6_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = write_archives(read(spark, sf_dir, "pages"), folder)
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return read_archives(manifest, with_payload=False).where("kind = 'record'").select(
        number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), F.col("warc_type").alias("record_type"), number("refers_to").alias("refers_to"))


_BITS = " || ".join(f"lpad(bin(('0x' || substr(h, {i}, 8))::BIGINT), 32, '0')" for i in range(1, 41, 8))
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, strlen(html)::BIGINT AS n, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (SELECT *, {_BITS} AS bits FROM d)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           list_sum(list_transform(range(0, 5), lambda j: CASE WHEN substr(bits, (5 * i + j + 1)::INT, 1) = '1' THEN (16 >> j) ELSE 0 END))::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM b
"""
