from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests_llm_tools import table_rows
from vulnlake.llm.queries import QUERIES
from vulnlake.llm.warc import read_archives, read_range, record_bytes, write_archives

SF = "/root/testdata/sf0.001"


def expected(rows):
    first = {}
    for i, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, h in rows:
        p = (h or "").encode()
        origin = first.get(p)
        revisit = origin is not None and i != origin
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", origin if revisit else None))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


def test_query_equals_brute_force(spark):
    assert got(QUERIES["op9_warc"](spark, SF)) == expected(table_rows(SF, "pages", "page_id, html"))


def test_round_trip_of_copies_nulls_and_odd_urls(spark, tmp_dir):
    big, long = "é" * 50 + "<p>" + "x" * 40, "z" * 300_000
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://ü", big), (9, "http://ü", big), (1, "u", "short"), (2, "u", "short"),
            (4, "u", None), (6, "u", ""), (None, "u", big), (None, None, "y" * 200), (7, "u", long), (8, "u", long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("clash"))
    manifest = write_archives(pages.repartition(3), f"{tmp_dir}/warc")
    for size in (500, 4096, 1 << 22):  # ranges smaller than a member own each record once
        assert got(read_archives(manifest, range_bytes=size)) == expected([(i, h) for i, _, h in rows])
    back = read_archives(manifest).where("record_type = 'response' and page_id = 7").first()
    assert bytes(back.payload).decode() == long and back.url == "u"
    empty = write_archives(pages.limit(0), f"{tmp_dir}/none")
    assert read_archives(empty).count() == 0


class Counting(io.BytesIO):
    bytes_read = 0

    def read(self, n=-1):
        data = super().read(n)
        self.bytes_read += len(data)
        return data


def gzipped(data):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def test_a_range_is_read_once():
    rng = random.Random(0)
    members = [record_bytes(i, "u", rng.randbytes(rng.choice([10, 2000, 9000])), "d" * 64, None) for i in range(2000)]
    data, seen, read = b"".join(members), [], 0
    step = 1 << 20
    for start in range(0, len(data), step):
        f = Counting(data)
        seen += [int(r[0]["x-page-id"]) for r in read_range(f, start, min(start + step, len(data)), len(data))]
        read += f.bytes_read
    assert seen == list(range(2000)) and read <= 1.1 * len(data)


def test_ranges_are_dealt_to_many_tasks(spark, tmp_dir):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    manifest = write_archives(pages.coalesce(1), f"{tmp_dir}/warc")
    back = read_archives(manifest, range_bytes=4096).select("page_id", F.spark_partition_id().alias("task"))
    tasks = Counter(r.task for r in back.collect())
    assert sum(tasks.values()) == 400 and len(tasks) >= 12 and max(tasks.values()) < 100
    few = read_archives(manifest, range_bytes=4096, task_bytes=1 << 30)
    assert few.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism


def test_archives_of_other_writers(spark, tmp_dir):
    def record(kind, block, **fields):
        head = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:{kind}>", "Content-Length": str(len(block)), **{k.replace("_", "-"): v for k, v in fields.items()}}
        return gzipped(b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n")

    body = b"<p>hello</p>"
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body
    of = {"Content_Type": "application/http; msgtype=response"}
    b32 = lambda k: base64.b32encode(hashlib.new(k, body).digest()).decode()
    data = b"".join([
        record("warcinfo", b"software: x"), record("request", b"GET / HTTP/1.1\r\n\r\n"), record("metadata", b"a: b"),
        record("response", http, WARC_Payload_Digest="sha1:" + b32("sha1"), WARC_Target_URI="http://a/", **of),
        record("response", http, WARC_Payload_Digest="sha256:" + b32("sha256"), **of), record("response", http, **of),
        record("response", http, WARC_Payload_Digest="md5:00", **of), record("response", http, WARC_Payload_Digest="crc:1", **of), record("resource", body),
        record("revisit", b"HTTP/1.1 200 OK\r\n\r\n", WARC_Payload_Digest="sha1:" + b32("sha1"), WARC_Refers_To="<urn:response>", **of),
        record("revisit", b"", WARC_Payload_Digest="sha256:" + b32("sha256"))])
    path = f"{tmp_dir}/other.warc.gz"
    with open(path, "wb") as f:
        f.write(data)
    manifest = spark.createDataFrame([("file://" + path, len(data))], "file string, bytes bigint")
    for size in (64, 1 << 22):
        rows = read_archives(manifest, range_bytes=size, types=("response", "revisit", "resource")).collect()
        assert Counter((r.record_type, r.digest_ok) for r in rows) == Counter(
            {("response", True): 2, ("response", None): 2, ("response", False): 1, ("resource", None): 1, ("revisit", None): 2})
        assert all(bytes(r.payload) == body and r.payload_digest == hashlib.sha256(body).hexdigest() for r in rows if r.record_type != "revisit")
        assert {(r.refers_to_record, r.payload_digest) for r in rows if r.record_type == "revisit"} == {
            ("<urn:response>", None), (None, hashlib.sha256(body).hexdigest())}
    assert read_archives(manifest).count() == 7
    with pytest.raises(Exception, match="does not fit its digest"):
        read_archives(manifest, strict=True).collect()


def test_false_magic_is_no_record():
    member = record_bytes(1, "u", b"payload", "d" * 64, None)
    other = zlib.compressobj(0, zlib.DEFLATED, 31)  # a gzip member that is no WARC record, stored uncompressed
    other = other.compress(b"xx" + member[:40]) + other.flush()
    data = b"\x1f\x8b\x08junk" + other + member + b"\x1f\x8b" + member
    for step in (1, 7, 64, len(data)):
        seen = []
        for start in range(0, len(data), step):
            seen += [r[0]["x-page-id"] for r in read_range(io.BytesIO(data), start, min(start + step, len(data)), len(data), window=16)]
        assert seen == ["1", "1"], step
