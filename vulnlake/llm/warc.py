"""WARC archives: one gzip member per record, and a splittable reader.

Writing: payload digests are grouped map-side to find, for each payload of at least ``MIN_REVISIT_BYTES``
that several pages share, the smallest page id; only those (page, refers_to) pairs are joined to the pages.
Each task streams its rows into archive files in the shared folder (temporary name, then rename, so a
repeated task replaces its own file).

Reading: the archives, of this or other writers with a gzip member per record, are cut into byte ranges. A task scans
its range for the gzip magic, validates each candidate member by decoding the start of it (it must begin with a WARC
version line) and owns the records whose members start inside its range; a member that crosses the end is read to its
own end. CRC and length of every owned member are checked by the decoder.

Defined cases: a record of any length is read whole; null html is the empty payload; a null url leaves the target header out; rows that repeat the
id of a response are responses too; a null id never names a response unless all pages of that payload have
null ids; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, scratch_path, stored, table

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20  # a task starts a new archive beyond this size
RANGE_BYTES = 4 << 20
TASK_BYTES = 64 << 20  # of archives for a task, where there are more than a few for each core
WINDOW = 1 << 16  # read at once
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"  # records carry a fixed date: the archives are a function of the table


def _open_fs(uri: str):
    return pafs.FileSystem.from_uri(uri)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member holding one WARC/1.1 record."""
    ident = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}:{digest}")
    head = ["WARC/1.1", f"WARC-Record-ID: <urn:uuid:{ident}>", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "%%%02X" % (ord(c) & 255) for c in url))
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        head.append("WARC-Type: response")
        block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    else:
        origin = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{refers_to}:{digest}")
        head += ["WARC-Type: revisit", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{origin}>", f"X-Refers-To-Page-Id: {refers_to}"]
        block = http + b"\r\n"
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    data = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    c = zlib.compressobj(4, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archives(pages: DataFrame, root: str) -> DataFrame:
    """Write ``pages(page_id, url, html)`` under ``root``; returns the manifest ``(file, bytes, records)``."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    shared = (rows.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1"))
    ids = rows.select("page_id", "digest")
    revisits = (ids.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
                .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to").distinct())
    rows = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open_fs(root)
        ctx = TaskContext.get()
        fs.create_dir(base, recursive=True)
        out, name, temp, size, count, part, done = None, "", "", 0, 0, 0, []

        def close():
            out.close()
            fs.move(temp, f"{base}/{name}")
            done.append((f"{root.rstrip('/')}/{name}", size, count))

        for b in batches:
            for page_id, url, payload, digest, refers_to in zip(*(b.column(i).to_pylist() for i in range(5))):
                if out is None:
                    name = f"pages-{ctx.partitionId():06d}-{part:04d}.warc.gz"
                    temp = f"{base}/_tmp-{ctx.taskAttemptId()}-{name}"
                    out, size, count, part = fs.open_output_stream(temp, compression=None), 0, 0, part + 1
                member = record_bytes(page_id, url, payload, digest, refers_to)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], ["file", "bytes", "records"])

    return stored(map_batches(rows.select("page_id", "url", "payload", "digest", "refers_to"), write,
                              "file string, bytes bigint, records bigint"), "warc-manifest")


class _Forward:
    """An open file of ``size`` bytes read forward in windows; what was read from ``at`` on stays at hand."""

    def __init__(self, f, start: int, size: int, window: int):
        self.f, self.at, self.size, self.window = f, start, size, window
        self.held, self.next = b"", start
        f.seek(start)

    def more(self, most: int | None = None) -> bool:
        """Read on; False at the end of the file, or where what is held reaches ``most``."""
        want = min(self.window, (self.size if most is None else min(most, self.size)) - self.next)
        if want <= 0:
            return False
        data = self.f.read(want)
        if not data:
            raise EOFError(f"archive ends at {self.next}, its manifest says {self.size}")
        self.held, self.next = self.held + data, self.next + len(data)
        return True

    def skip(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def back_to(self, at: int) -> None:
        self.f.seek(at)
        self.at = self.next = at
        self.held = b""


def _member(s: _Forward) -> bytes | None:
    """Decode the gzip member at ``s.at`` and go behind it; None, one byte further, when it is no WARC record."""
    d, parts, start, checked = zlib.decompressobj(31), [], s.at, False
    try:
        while not d.eof:
            if not s.held and not s.more():
                break
            if not checked:  # until the head is known, what was read stays at hand
                head = zlib.decompressobj(31).decompress(s.held, 7)
                if len(head) < 7 and s.more():
                    continue
                if not head.startswith(b"WARC/1."):
                    s.skip(1)
                    return None
                checked = True
            data = s.held
            parts.append(d.decompress(data))
            s.skip(len(data) - len(d.unused_data))
    except zlib.error:
        pass
    if d.eof:
        return b"".join(parts)
    if s.at == start:
        s.skip(1)
    else:  # it began like a record and was none
        s.back_to(start + 1)
    return None


def _record(data: bytes) -> tuple[dict, bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError(f"record of {len(rest)} bytes says {length}")
    return fields, rest[:length]


def read_range(f, start: int, end: int, size: int, window: int = WINDOW) -> Iterator[tuple[dict, bytes]]:
    """Records whose members start in ``[start, end)`` of an open file of ``size`` bytes. The file is read once, forward: the
    magic is searched for only at the start and where a member is not followed by another."""
    s = _Forward(f, start, size, window)
    while s.at < end:
        while len(s.held) < len(MAGIC) and s.more():
            pass
        if not s.held.startswith(MAGIC):
            hit = s.held.find(MAGIC, 1)
            if hit < 0:
                s.skip(max(0, len(s.held) - len(MAGIC) + 1))
                if not s.more(end + len(MAGIC) - 1):
                    return
                continue
            s.skip(hit)
            continue
        found = _member(s)
        if found is not None:
            yield _record(found)


def _digest_fits(header: str | None, body: bytes) -> bool | None:
    """Whether a payload has the digest of its header, in hex or base32; None where there is none or its kind is unknown."""
    kind, _, said = (header or "").partition(":")
    kind = kind.strip().lower().replace("-", "")
    if not said or kind not in ("sha1", "sha256", "sha512", "md5"):
        return None
    digest = hashlib.new(kind, body).digest()
    return said.strip().lower() == digest.hex() or said.strip().upper().rstrip("=") == base64.b32encode(digest).decode().rstrip("=")


def _sha256_of(header: str | None) -> str | None:
    """The SHA-256 of a digest header as hex, if it is one."""
    kind, _, said = (header or "").partition(":")
    said = said.strip()
    if kind.strip().lower().replace("-", "") != "sha256":
        return None
    if len(said) == 64:
        return said.lower()
    try:
        return base64.b32decode(said.upper() + "=" * (-len(said) % 8)).hex()
    except ValueError:
        return None


def _integer(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.lstrip("-").isdigit() else None


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES, types: tuple[str, ...] = ("response", "revisit"),
                  strict: bool = False, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``manifest(file, bytes)`` -> one row per record of the ``types``; the others are passed over. Columns: page_id and
    refers_to (of archives written here), url, record_type, payload_bytes, payload_digest (SHA-256 as hex; of revisits, what the header says,
    if that is one), digest_ok (whether the header's digest fits, null where nothing can be compared), record_id,
    refers_to_record and the payload (null for revisits). ``strict``: a payload that does not fit its digest is an error.

    Ranges are dealt to as many tasks as their bytes ask for: the rows that describe them are tiny, so left alone
    adaptive execution would bring them together in one.
    """
    spark = manifest.sparkSession
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, min(-(-total // range_bytes), max(4 * spark.sparkContext.defaultParallelism, -(-total // task_bytes))))
    ranges = manifest.where("bytes > 0").select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint"))).alias("start"))
    fields = [("page_id", "bigint", pa.int64()), ("url", "string", pa.string()), ("record_type", "string", pa.string()), ("refers_to", "bigint", pa.int64()),
              ("payload_bytes", "bigint", pa.int64()), ("payload_digest", "string", pa.string()), ("digest_ok", "boolean", pa.bool_()),
              ("record_id", "string", pa.string()), ("refers_to_record", "string", pa.string()), ("payload", "binary", pa.binary())]

    def row(h: dict, block: bytes) -> tuple:
        kind, said = h.get("warc-type"), h.get("warc-payload-digest")
        around = (h.get("warc-record-id"), h.get("warc-refers-to"))
        page, url = _integer(h.get("x-page-id")), h.get("warc-target-uri")
        if kind == "revisit":
            return (page, url, kind, _integer(h.get("x-refers-to-page-id")), _integer(h.get("x-payload-length")), _sha256_of(said), None, *around, None)
        body = block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else block
        fits = _digest_fits(said, body)
        if strict and not fits:
            raise ValueError(f"payload of {around[0]} does not fit its digest")
        return (page, url, kind, None, len(body), sha256(body).hexdigest(), fits, *around, body)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, _, k) in zip(zip(*rows), fields)], [n for n, _, _ in fields])

        for b in batches:
            for uri, size, start in zip(*(b.column(i).to_pylist() for i in range(3))):
                fs, path = _open_fs(uri)
                rows, held = [], 0
                with fs.open_input_file(path) as f:
                    for h, block in read_range(f, start, min(start + range_bytes, size), size):
                        if h.get("warc-type") not in types:
                            continue
                        rows.append(row(h, block))
                        held += len(rows[-1][-1] or b"")
                        if held > 4 << 20 or len(rows) >= 10_000:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return map_batches(ranges.select("file", "bytes", "start").repartition(tasks), read, ", ".join(f"{n} {t}" for n, t, _ in fields))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(manifest, strict=True).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
