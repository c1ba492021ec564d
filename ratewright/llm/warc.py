"""WARC archives in which a payload stands once: later copies are revisit records that refer to the original response.

Archives are written by Spark's text writer, a record per row and the two line ends that close a record as its line separator, so files are
committed by task and may lie in any store.  Reading goes line by line over whole compressed files (they are never split) and puts records
together by Content-Length in the task, so a task holds one record and one batch of lines, however large its archives are.

Only headers are shuffled by payload digest: the smallest id of each repeated digest is found there.  Payloads stay where they are while that table
of originals is small enough for Spark's own broadcast limit (it is written, so its size is known); else the records are joined with it by
digest, where Spark splits a digest of very many records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewright.llm.arrays import releasing
from ratewright.sources.io import shared_folder

VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The field that carries a record's own id, an extension that other readers skip.
KEY = "Row-Key"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_READ = "key string, record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, payload_bytes bigint, refers_to_record string, payload binary"


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are eight groups of five hexadecimal or four base32 digits."""
    sha = F.sha1(payload)
    groups = (F.conv(F.substring(sha, 5 * g + 1, 5), 16, 10).cast("int") for g in range(8))
    digit = lambda v, shift: F.substr(F.lit(_BASE32), F.shiftright(v, shift).bitwiseAND(F.lit(31)) + 1, F.lit(1))
    return F.concat(*(digit(v, shift) for v in groups for shift in (15, 10, 5, 0)))


def _record_id(*parts: Column) -> Column:
    """A name-based UUID: a repeated task gives the same record the same id."""
    h = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))
    cut = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-3"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12), F.lit(">"))


def page_records(pages: DataFrame, key: str, url: str, payload: str, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """(key, target_uri, date, record_type, content_type, payload, payload_digest, payload_bytes, record_id): a response per row; a null payload is empty.

    Other columns are left out.  `payload` is a string (its UTF-8) or binary.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("target_uri"), F.lit(date).alias("date"), F.lit("response").alias("record_type"), F.lit("text/html; charset=utf-8").alias("content_type"), body.alias("payload"))
    rows = rows.withColumns({"payload_digest": payload_digest(F.col("payload")), "payload_bytes": F.octet_length("payload").cast("long")})
    return rows.withColumn("record_id", _record_id(F.col("key"), F.col("target_uri"), F.col("payload_digest")))


def originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(payload_digest, original): of each digest that several responses of `least_bytes` bytes or more have, the one with the smallest key (a null key is last).

    Counts and minima are added up in the tasks first, so a digest of very many records sends a row a task.
    """
    large = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes))
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "record_id", "target_uri", "date", "payload_bytes"))
    return large.groupBy("payload_digest").agg(first.alias("original"), F.count("*").alias("_n"))


def deduplicated(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records with `original`: null for what stays a response, else the response that a revisit refers to.

    A repeated row of an original (the same key, address and payload) is a response as well.  A revisit of the input refers to the response with its digest, and
    to none where the archives hold none.  Other types stay as they are.
    """
    spark = records.sparkSession
    path = f"{shared_folder(spark)}/originals-{uuid.uuid4().hex}"
    headers = records.select("key", "record_id", "record_type", "target_uri", "date", "payload_digest", "payload_bytes")
    found = originals(headers, least_bytes)
    if "refers_to_record" in records.columns:  # archives that were read: their revisits may be the only other record of a digest
        asked = records.where("record_type = 'revisit'").select("payload_digest").distinct().withColumn("_asked", F.lit(True))
        found = found.join(asked, "payload_digest", "left").where(F.col("_asked") | (F.col("_n") > 1)).drop("_asked")
    else:
        found = found.where("_n > 1")
    found.drop("_n").write.parquet(path)
    joined = records.join(spark.read.parquet(path), "payload_digest", "left")
    itself = F.col("key").eqNullSafe(F.col("original.key")) & F.col("record_id").eqNullSafe(F.col("original.record_id"))
    copy = (F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes) & ~itself
    original = F.when((F.col("record_type") == "revisit") | copy, F.col("original"))
    kind = F.when(F.col("record_type").isin("response", "revisit"), F.when(original.isNotNull() | (F.col("record_type") == "revisit"), "revisit").otherwise("response")).otherwise(F.col("record_type"))
    return joined.withColumns({"original": original, "record_type": kind, "payload_bytes": F.coalesce("payload_bytes", "original.payload_bytes")})


def _line(name: str, value: Column) -> Column:
    """A header line; nothing where the value is null.  Line ends in a value would end the header: they are percent-encoded."""
    clean = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(END)), F.lit(""))


def record_text(columns: list[str]) -> Column:
    """A record of rows with these columns, with fresh header lines and lengths, but for the two line ends that close it.  A revisit whose original is not
    known keeps the record id that it referred to."""
    kind, http = F.col("record_type"), F.col("record_type").isin("response", "revisit")
    status = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: "), F.coalesce("content_type", F.lit("application/octet-stream")), F.lit(END), _line("Content-Length", F.col("payload_bytes")), F.lit(END))
    body = F.when(kind == "revisit", F.lit("")).otherwise(F.col("payload").cast("string"))
    block = F.concat(F.when(http, status).otherwise(F.lit("")), body)
    refers = F.col("original") if "original" in columns else F.lit(None).cast("struct<record_id:string,target_uri:string,date:string>")
    refers_to = F.coalesce(refers["record_id"], "refers_to_record") if "refers_to_record" in columns else refers["record_id"]
    lines = [
        F.lit(VERSION + END), _line("WARC-Type", kind), _line("WARC-Record-ID", F.when(kind == "revisit", _record_id(F.lit("revisit"), F.col("record_id"))).otherwise(F.col("record_id"))), _line("WARC-Date", F.col("date")),
        _line("WARC-Target-URI", F.col("target_uri")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))), _line(KEY, F.col("key")),
        _line("WARC-Profile", F.when(kind == "revisit", F.lit(PROFILE))), _line("WARC-Refers-To", F.when(kind == "revisit", refers_to)), _line("WARC-Refers-To-Target-URI", refers["target_uri"]), _line("WARC-Refers-To-Date", refers["date"]),
        _line("Content-Type", F.when(http, "application/http; msgtype=response").otherwise(F.col("content_type"))), _line("Content-Length", F.octet_length(block)), F.lit(END),
    ]
    return F.concat(*lines, block)


def write_archives(records: DataFrame, path: str) -> None:
    """A compressed archive per task; `records` as from `page_records` or `deduplicated`."""
    records.select(record_text(records.columns).alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(path)


class _Records:
    """Puts the lines of one archive together to records."""

    def __init__(self, name: str, with_payload: bool):
        self.name, self.with_payload, self.parts, self.size, self.need, self.first = name, with_payload, [], 0, 1, True

    def feed(self, lines: bytes) -> Iterator[tuple]:
        """`lines`: whole lines joined by line feeds; their last feed belongs to the next ones."""
        data = lines if self.first else b"\n" + lines
        self.first = False
        self.parts.append(data)
        self.size += len(data)
        if self.size < self.need:
            return
        data, at = b"".join(self.parts), 0
        while True:
            while data[at : at + 2] == b"\r\n":
                at += 2
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                need = 0
                break
            version, *fields = data[at:end].decode("utf-8", "replace").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"{self.name}: a record doesn't begin with its version")
            field = {k.strip().lower(): v.removeprefix(" ") for k, _, v in (x.partition(":") for x in fields)}
            start, length = end + 4, int(field["content-length"])
            if len(data) < start + length:
                need = start + length - at
                break
            yield self.record(field, data[start : start + length])
            at = start + length
        rest = data[at:]
        self.parts, self.size, self.need = [rest], len(rest), max(need, len(rest) + 1)

    def close(self) -> None:
        if b"".join(self.parts).strip(b"\r\n"):
            raise ValueError(f"{self.name}: the last record is cut off")

    def record(self, field: dict[str, str], block: bytes) -> tuple:
        kind, http = field.get("warc-type", "").strip(), field.get("content-type", "").startswith("application/http")
        content = field.get("content-type")
        payload, said = block, field.get("warc-payload-digest")
        if http:
            head, _, payload = block.partition(b"\r\n\r\n")
            lines = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
            content = lines.get("content-type")
        said = said.strip().removeprefix("sha1:").upper() if said else None
        if kind == "revisit":
            size = int(lines["content-length"]) if http and "content-length" in lines else None
            payload = b""
        else:
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()  # 32 digits, no padding
            if said not in (None, digest):
                raise ValueError(f"{self.name}: the payload of {field.get('warc-record-id')} doesn't fit its digest")
            said = digest
        return field.get(KEY.lower()), field.get("warc-record-id"), kind, field.get("warc-target-uri"), field.get("warc-date"), content, said, size, field.get("warc-refers-to"), payload if self.with_payload else None


def _reader(with_payload: bool):
    types = [pa.string()] * 7 + [pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _READ.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    @releasing
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, rows, size = None, [], 0
        for batch in batches:
            files, starts = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
            if len(starts) and starts.max() > 0:
                raise ValueError("archives must be compressed, so that Spark doesn't split them")
            lines = batch.column(0).cast(pa.large_binary())
            for i, name in enumerate(files.dictionary.to_pylist()):  # a partition's files come one after another
                at = [k for k, x in enumerate(files.indices.to_pylist()) if x == i] if len(files.dictionary) > 1 else range(len(batch))
                if archive is None or archive.name != name:
                    if archive is not None:
                        archive.close()
                    archive = _Records(name, with_payload)
                own = lines.slice(at[0], len(at)) if len(at) else lines.slice(0, 0)
                for row in archive.feed(b"\n".join(own.to_pylist())):
                    rows.append(row)
                    size += 500 + len(row[-1] or b"")
                    if size > 1 << 22:
                        yield batch_of(rows)
                        rows, size = [], 0
        if archive is not None:
            archive.close()
        if rows:
            yield batch_of(rows)

    return read


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(key, record_id, record_type, target_uri, date, content_type, payload_digest, payload_bytes, refers_to_record, payload) of all records of the compressed archives.

    Digest and size of a response are taken from its payload, and a header that says another digest raises, as do cut-off records and archives that
    aren't compressed.  A revisit has the digest and size that its header lines give (no size: null) and an empty payload.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return lines.mapInArrow(_reader(with_payload), _READ)


def resolved(headers: DataFrame, key_type: str = "bigint") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to) of responses and revisits that were read: revisits take size and key of the response with their digest.

    Of several such responses that with the smallest key; a revisit without one keeps its own size and refers to null.  Headers meet by digest; Spark splits
    a digest of very many revisits, whose one partner is an aggregate.
    """
    rows = headers.select(F.col("key").cast(key_type).alias("key"), "record_id", "record_type", "target_uri", "date", "payload_digest", "payload_bytes")
    revisits = rows.where("record_type = 'revisit'").select("key", "payload_digest", "payload_bytes", "record_type")
    first = originals(rows).select("payload_digest", F.col("original.key").alias("refers_to"), F.col("original.payload_bytes").alias("_bytes"))
    found = revisits.join(first, "payload_digest", "left").select("key", F.coalesce("_bytes", "payload_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
    kept = rows.where("record_type = 'response'").select("key", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(key_type).alias("refers_to"))
    return kept.unionByName(found)


def round_trip(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Writes deduplicated archives of the pages to the shared folder and returns what `resolved` reads from them, and `archives`, the folder."""
    spark = pages.sparkSession
    base = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(deduplicated(page_records(pages, key, url, payload), least_bytes), f"{base}/archives")
    read_archives(spark, f"{base}/archives", with_payload=False).drop("payload").write.parquet(f"{base}/headers")
    return resolved(spark.read.parquet(f"{base}/headers"), pages.schema[key].dataType.simpleString()).withColumn("archives", F.lit(f"{base}/archives"))


def rewrite(spark: SparkSession, source: str, target: str, least_bytes: int = 0, key_type: str = "bigint") -> None:
    """Archives in which copies may stand, and revisits from elsewhere, to archives in which each payload of `least_bytes` bytes or more stands once."""
    records = read_archives(spark, source).withColumn("key", F.col("key").cast(key_type))
    write_archives(deduplicated(records, least_bytes), target)
