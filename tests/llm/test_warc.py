"""WARC archives: exact round trips, revisits by digest, foreign records, and what is refused."""

from __future__ import annotations

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ratewright.llm import warc

PAGES = "page_id long, url string, html string, key string, original long, file string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages():
    """(page_id, url, html): copies, nulls, empty and very long payloads, line ends of every kind, record heads inside payloads, a repeated row."""
    texts = ["<p>a</p>", None, "", "<p>a</p>", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "\r\n", "\r\n\r\n", "\n", "tail\r", "tail\r\n", "Ê日" * 7, "<p>a</p>", "y" * 300_000, "line\n" * 60_000, "y" * 300_000]
    rows = [(100 - i, f"http://h/{i}", t) for i, t in enumerate(texts)] + [(7, None, "lone"), (6, "http://h/a\r\nb", "lone"), (5, "", "")]
    return [*rows, rows[0]]


def expected(rows, least=0):
    body = [(k, (t or "").encode()) for k, _, t in rows]
    out = []
    for k, p in body:
        first = min(a for a, b in body if b == p)
        revisit = len(p) >= least and first != k
        out.append((k, len(p), digest(p), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out)


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "k", 5, "f") for r in pages()], PAGES).repartition(3)


@pytest.mark.parametrize("least,broadcast", [(0, "10m"), (0, "-1"), (5, "-1"), (10**6, "10m")])
def test_round_trip(spark, frame, least, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = warc.round_trip(frame, "page_id", "url", "html", least).drop("archives")
        assert sorted(tuple(r) for r in found.collect()) == expected(pages(), least)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_archives_hold_whole_payloads_once_and_fresh_headers(spark, frame):
    folder = warc.round_trip(frame, "page_id", "url", "html").first()["archives"]
    read = {r["key"]: r for r in warc.read_archives(spark, folder).collect()}
    want = {k: (kind, refers) for k, _, _, kind, refers in expected(pages())}
    ids = {r["record_id"] for r in read.values()}
    assert len(ids) == len(read) == len(want)
    for k, url, html in pages():
        row, (kind, refers) = read[str(k)], want[k]
        assert row["record_type"] == kind and row["payload_bytes"] == len((html or "").encode())
        assert bytes(row["payload"]) == ((html or "").encode() if kind == "response" else b"")
        assert row["target_uri"] == (url.replace("\r", "%0D").replace("\n", "%0A") if url is not None else None)
        assert row["refers_to_record"] == (read[str(refers)]["record_id"] if refers else None)
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("*.gz"))
    assert raw.count(b"\r\nWARC-Profile: " + warc.PROFILE.encode()) == sum(r[3] == "revisit" for r in expected(pages())) and raw.endswith(b"\r\n\r\n")


def test_binary_payloads_and_string_keys(spark, tmp_path):
    blobs = [bytes(range(256)) * 3, b"\xff\xfe\r\n\r\n\x00", b"", bytes(range(256)) * 3]
    df = spark.createDataFrame([(k, f"u{k}", b) for k, b in zip(["b", " a b", "c", "é"], blobs, strict=True)], "id string, url string, body binary")
    warc.write_archives(warc.page_records(df, "id", "url", "body"), str(tmp_path / "a"))
    assert {r["key"]: bytes(r["payload"]) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()} == dict(zip(["b", " a b", "c", "é"], blobs, strict=True))
    found = {r["key"]: r["refers_to"] for r in warc.round_trip(df, "id", "url", "body").collect()}
    assert found == {"b": None, " a b": None, "c": None, "é": "b"}


def foreign(records) -> bytes:
    """Archives as others write them: a compressed member per record."""
    out = b""
    for fields, block in records:
        head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
        out += gzip.compress(f"WARC/1.0\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return out


def test_rewriting_foreign_archives(spark, tmp_path):
    http = lambda p: b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n" + p
    response = lambda i, p: ({"WARC-Type": "response", "WARC-Record-ID": f"<urn:uuid:{i}>", "WARC-Target-URI": f"http://{i}", "WARC-Date": "2020-01-01T00:00:00Z", "Content-Type": "application/http; msgtype=response"}, http(p))
    revisit = lambda i, p: ({"WARC-Type": "revisit", "WARC-Record-ID": f"<urn:uuid:{i}>", "WARC-Payload-Digest": f"sha1:{digest(p)}", "Content-Type": "application/http"}, b"HTTP/1.1 200 OK\r\n\r\n")
    info = ({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:i>", "Content-Type": "application/warc-fields"}, b"software: x\r\n")
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.warc.gz").write_bytes(foreign([info, response("r1", b"alpha"), response("r2", b"beta")]))
    (source / "two.warc.gz").write_bytes(foreign([response("r3", b"alpha"), revisit("v1", b"beta"), revisit("v2", b"nowhere")]))
    warc.rewrite(spark, str(source), str(tmp_path / "out"))
    rows = warc.read_archives(spark, str(tmp_path / "out")).collect()
    kinds = {r["record_id"]: (r["record_type"], bytes(r["payload"])) for r in rows if r["record_type"] != "revisit"}
    assert kinds == {"<urn:uuid:i>": ("warcinfo", b"software: x\r\n"), "<urn:uuid:r1>": ("response", b"alpha"), "<urn:uuid:r2>": ("response", b"beta")}
    assert sorted((r["payload_digest"], r["refers_to_record"]) for r in rows if r["record_type"] == "revisit") == sorted([(digest(b"alpha"), "<urn:uuid:r1>"), (digest(b"beta"), "<urn:uuid:r2>"), (digest(b"nowhere"), None)])


@pytest.mark.parametrize("damage,message", [(lambda x: x[:-30], "cut off"), (lambda x: x.replace(b"alpha", b"alphb"), "digest"), (lambda x: b"junk\r\n\r\n" + x, "version")])
def test_damaged_archives_raise(spark, tmp_path, damage, message):
    df = spark.createDataFrame([(1, "u", "alpha" * 20)], "id long, url string, body string")
    records = warc.page_records(df, "id", "url", "body")
    text = records.select(warc.record_text(records.columns)).first()[0].encode() + b"\r\n\r\n"
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(damage(text)))
    with pytest.raises(Exception, match=message):
        warc.read_archives(spark, str(tmp_path)).collect()


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(df, "page_id", "url", "html").count() == 0


def test_digest_equals_hashlib(spark):
    rows = ["", "a", "é日", None]
    found = spark.createDataFrame([(x,) for x in rows], "t string").select("t", warc.payload_digest(F.col("t").cast("binary"))).collect()
    assert all(r[1] == (digest(r[0].encode()) if r[0] is not None else None) for r in found)
