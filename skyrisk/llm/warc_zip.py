"""WARC records in ZIP packages, read by ranges.

A package holds two stored (uncompressed) members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, one line per record with its
range.  Readers parse the end-of-central-directory record (and ZIP64's), the
central directory and the local headers, then fetch only index and records.
Tasks open the packages with ``pyarrow.fs``, so the folder may be any store
that it knows; the table of packages is written by Spark, so files of
attempts that failed are never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyrisk.llm.common import pick
from skyrisk.session import scratch_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES, RANGE_BYTES = 128 << 20, 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages carry no capture time
RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


# ---------------------------------------------------------------- records
def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"Refers-To-Page-Id: {refers_to}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; the payload of a response is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    f = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[:int(f["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
    if f["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"record {f['WARC-Record-ID']}: payload does not match its digest")
    page, ref, url = f.get("Page-Id"), f.get("Refers-To-Page-Id"), f.get("WARC-Target-URI")
    return {"page_id": None if page is None else int(page), "payload_bytes": size, "payload_digest": digest,
            "url": None if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "record_type": f["WARC-Type"], "refers_to": None if ref is None else int(ref),
            "payload": payload if f["WARC-Type"] == "response" else None}


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _gzip(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


# ---------------------------------------------------------------- writing
class Package:
    """One ZIP package on an output stream that need not seek."""

    def __init__(self, uri: str):
        store, path = pafs.FileSystem.from_uri(uri)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.lines, self.size = uri, [], 0
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, raw: bytes, page_id) -> None:
        packed = _gzip(raw)
        self.lines.append(json.dumps({"page_id": page_id, "offset": self.size, "length": len(packed)}))
        self.data.write(packed)
        self.size += len(packed)

    def close(self) -> tuple[str, int]:
        self.data.close()
        with self.zip.open(INDEX, "w", force_zip64=True) as f:
            f.write("\n".join(self.lines).encode())
        self.zip.close()
        self.out.close()
        return self.uri, len(self.lines)


def _write(folder: str, package_bytes: int):
    def run(batches):
        task, k, p, done = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            for page, url, payload, sha, ref in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "refers_to"))):
                if p is None:
                    p = Package(f"{folder}/part-{task:05d}-{k}-{uuid.uuid4().hex[:12]}.wacz")
                p.add(record(page, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), ref), page)
                if p.size >= package_bytes:
                    done.append(p.close())
                    p, k = None, k + 1
        if p is not None:
            done.append(p.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done]), pa.array([n for _, n in done], pa.int64())], names=["path", "records"])
    return run


def write_archives(pages: DataFrame, path: str, min_payload: int = 0, package_bytes: int = PACKAGE_BYTES) -> None:
    """Packages of one record per row under ``path``, listed in ``path/packages``.

    Of rows with equal payloads of ``min_payload`` bytes or more those with the
    smallest page_id are responses (repeated rows all), the rest revisits of it;
    shorter payloads are all responses.  Null html counts as empty, a null
    page_id as larger than any other, a null url is left out.
    """
    d = pick(pages, page_id="page_id", url="url", html="html")
    d = d.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                 F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    d = d.withColumn("sha", F.sha1("payload"))
    again = d.where(F.octet_length("payload") >= min_payload).groupBy("sha") \
        .agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    spark, repeats = pages.sparkSession, scratch_path(pages.sparkSession, "repeated-payloads")
    again.write.parquet(repeats)  # its size is known then: small, it is broadcast and no payload is shuffled
    again = spark.read.parquet(repeats)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    d.join(again, "sha", "left").select("page_id", "url", "payload", "sha", refers.alias("refers_to")) \
        .mapInArrow(_write(f"{path}/archives", package_bytes), "path string, records long").write.parquet(f"{path}/packages")


# ---------------------------------------------------------------- reading
def read_at(f, at: int, size: int) -> bytes:
    f.seek(at)
    return f.read(size)


def central_directory(f, size: int) -> list[dict]:
    """Members (name, method, bytes, where their data begin) of a ZIP file, read from its end."""
    tail_at = max(0, size - 65557)  # end record of 22 bytes with the longest comment
    tail = read_at(f, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if 0xFFFF == entries or 0xFFFFFFFF in (length, offset):
        locator = read_at(f, tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("ZIP64 locator missing")
        end = read_at(f, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("ZIP64 end of central directory missing")
        entries, length, offset = struct.unpack_from("<QQQ", end, 32)
    raw, at, out = read_at(f, offset, length), 0, []
    for _ in range(entries):
        if raw[at:at + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, plain, n, m, c = struct.unpack_from("<IIHHH", raw, at + 20)
        local, = struct.unpack_from("<I", raw, at + 42)
        name, extra, k = raw[at + 46:at + 46 + n].decode(), raw[at + 46 + n:at + 46 + n + m], 0
        while k + 4 <= len(extra):
            kind, long = struct.unpack_from("<HH", extra, k)
            if kind == 1:  # ZIP64: only the fields that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{long // 8}Q", extra, k + 4))
                plain, packed, local = (next(wide) if v == 0xFFFFFFFF else v for v in (plain, packed, local))
            k += 4 + long
        at += 46 + n + m + c
        head = read_at(f, local, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: no local header")
        skip = sum(struct.unpack_from("<HH", head, 26))
        out.append({"name": name, "method": method, "bytes": packed, "at": local + 30 + skip})
    return out


def _ranges(batches):
    """Index entries of each package as ranges of neighbouring records."""
    for b in batches:
        for uri in b.column("path").to_pylist():
            store, path = pafs.FileSystem.from_uri(uri)
            with store.open_input_file(path) as f:
                members = {m["name"]: m for m in central_directory(f, f.size())}
                data, index = members[DATA], members[INDEX]
                if data["method"] or index["method"]:
                    raise ValueError(f"{uri}: members must be stored, not compressed")
                lines = [json.loads(x) for x in read_at(f, index["at"], index["bytes"]).splitlines()]
            out, begin, cut = [], 0, []
            for e in lines:
                if cut and e["offset"] + e["length"] - begin > RANGE_BYTES:
                    out.append((uri, data["at"] + begin, cut))
                    cut = []
                if not cut:
                    begin = e["offset"]
                cut.append(e["length"])
            if cut:
                out.append((uri, data["at"] + begin, cut))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out]), pa.array([o[1] for o in out], pa.int64()),
                                                  pa.array([o[2] for o in out], pa.list_(pa.int64()))], names=["path", "at", "lengths"])


def _records(with_payload: bool):
    def run(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for uri, at, lengths in zip(*(b.column(c).to_pylist() for c in ("path", "at", "lengths"))):
                store, path = pafs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as f:
                    raw = read_at(f, at, sum(lengths))
                out, k = [], 0
                for n in lengths:
                    r = parse_record(zlib.decompress(raw[k:k + n], 31))
                    out.append(r if with_payload else r | {"payload": None})
                    k += n
                yield pa.RecordBatch.from_pylist(out, schema=schema)
    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Records of all listed packages; packages and ranges are dealt over the tasks.

    Their rows are few and small but stand for much reading, so the number of
    tasks is given: merging small partitions would leave it all to one."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packages = spark.read.schema("path string, records long").parquet(f"{path}/packages").select("path")
    ranges = packages.repartition(n, "path").mapInArrow(_ranges, "path string, at long, lengths array<long>")
    return ranges.repartition(n, "path", "at").mapInArrow(_records(with_payload), RECORDS)
