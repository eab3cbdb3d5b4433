import base64
import hashlib
import io
import zipfile

import duckdb
import pytest

from skyrisk.llm import warc_zip as Z
from skyrisk.llm.queries import OP4
from skyrisk.session import scratch_path

SCHEMA = "page_id long, url string, html string, HTML string, payload string, sha string, first long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", 9) for i, u, h in rows], SCHEMA)


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def slow(rows, least=0):
    out = []
    for i, _, h in rows:
        h = h or ""
        same = [j for j, _, g in rows if (g or "") == h and j is not None] if len(h.encode()) >= least else []
        first = min(same, default=None)
        revisit = first is not None and first != i
        out.append((i, len(h.encode()), b32(h), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/\r\nX: y%", None), (4, "u", ""), (None, "u", "<p>one</p>"),
        (None, None, "only here"), (6, "u", "é😀\r\n\r\nWARC/1.1\r\n" * 999), (7, "u", "x" * 300_000), (1, "http://a/", "<p>one</p>")]


@pytest.mark.parametrize("least", [0, 5, 100])
def test_round_trip(spark, least):
    path = scratch_path(spark, "w")
    Z.write_archives(pages(spark, ROWS), path, least, package_bytes=1000)
    got = Z.read_archives(spark, path).collect()
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in cols) for r in got), key=str) == slow(ROWS, least)
    assert {r["url"] for r in got} == {u for _, u, _ in ROWS}
    for r in got:
        if r["record_type"] == "response":
            assert b32(bytes(r["payload"]).decode()) == r["payload_digest"]


def test_sql_twin(spark, sf_small):
    from skyrisk.llm.queries import queries
    con = duckdb.connect()
    con.sql(f"create view pages as from '{sf_small}/pages.parquet'")
    got = queries()["op4_warc_packages"](spark, sf_small)
    want = con.sql(OP4)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_packages_are_plain_zip_files(spark):
    path = scratch_path(spark, "w")
    Z.write_archives(pages(spark, ROWS), path)
    for r in spark.read.parquet(f"{path}/packages").collect():
        with zipfile.ZipFile(r["path"].removeprefix("file://")) as z:
            assert z.testzip() is None and set(z.namelist()) == {Z.DATA, Z.INDEX}


def directory(raw):
    f = io.BytesIO(raw)
    return {m["name"]: raw[m["at"]:m["at"] + m["bytes"]] for m in Z.central_directory(f, len(raw))}


def test_zip64_and_comments(monkeypatch):
    def build():
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for i in range(5):
                z.writestr(f"m{i}", b"data" * i * 100)
            z.comment = b"a comment" * 100
        return out.getvalue()
    want = {f"m{i}": b"data" * i * 100 for i in range(5)}
    assert directory(build()) == want
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 150)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 3)
    raw = build()
    assert b"PK\x06\x06" in raw and directory(raw) == want


def test_damaged_files():
    for raw in (b"", b"no zip at all", b"PK\x05\x06" + b"\xff" * 18):
        with pytest.raises(ValueError):
            Z.central_directory(io.BytesIO(raw), len(raw))


def test_wrong_payload_is_noticed():
    raw = Z.record(1, "u", b"payload", b32("other"), None)
    with pytest.raises(ValueError):
        Z.parse_record(raw)


def test_empty_table(spark):
    path = scratch_path(spark, "w")
    Z.write_archives(pages(spark, []), path)
    assert Z.read_archives(spark, path).count() == 0
