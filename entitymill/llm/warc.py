"""A content-addressed web archive: payloads once, record headers apart, records by a join.

Each page is a WARC/1.1 record with its html as the payload. The archive is two written tables:

- `headers`: one row per record with the exact header bytes, the record type and the SHA-256 of
  its payload;
- `payloads`: the payload bytes, once per SHA-256.

Among records with equal payloads of at least `REVISIT_BYTES` bytes the one with the largest
page_id is a response and the others are revisits of it; smaller payloads are responses each.
`records` puts the original record bytes together again: header, payload (none in a revisit), two
line ends. What is read is verified: a payload must have the digest it is stored under, and the
record parsed from the bytes must carry the digests of its payload.

Everything is built-in functions. Scale: only digests and ids are shuffled to find the responses;
payload bytes are shuffled once to be stored once (equal ones of a task meet before that), and
once to be read back. The joins read written tables, so adaptive execution can split a payload
that a third of the pages hold.

Defined cases: a null html is an empty payload; a null url is an empty target; a null page_id
ranks below all others; repeated rows (equal page_id and payload) are each of the type of the id;
if all records of a payload have a null page_id, all are responses; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep_table

REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
_END = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class Archive(NamedTuple):
    headers: DataFrame
    payloads: DataFrame


def _bytes(value: Column) -> Column:
    return F.encode(value, "UTF-8")


def _record_id(page_id: Column, payload_sha1: Column) -> Column:
    """A name-based id: the same page with the same payload has the same one."""
    h = F.md5(_bytes(F.concat(F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(" "), payload_sha1)))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4),
             F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def page_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, its SHA-256 (store key), SHA-1 and length."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        # a header value has no line ends
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), "[\r\n]", "%0A").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("sha256"), F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("bytes"),
    )


def _header() -> Column:
    """The exact header bytes of a record: WARC fields, and the HTTP header that opens the block."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(_END + _END))
    # what the block holds after the header: the payload, or nothing in a revisit
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    fields = F.concat(
        F.lit(f"WARC/1.1{_END}WARC-Type: "), F.col("record_type"),
        F.lit(f"{_END}WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("sha1")),
        F.lit(f"{_END}WARC-Date: {DATE}{_END}WARC-Target-URI: "), F.col("url"),
        F.lit(f"{_END}WARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(
            F.lit(f"{_END}WARC-Profile: {_PROFILE}{_END}WARC-Refers-To: "),
            _record_id(F.col("leader"), F.col("sha1")))).otherwise(F.lit("")),
        F.lit(f"{_END}Content-Type: application/http; msgtype=response{_END}Content-Length: "),
        block.cast("string"), F.lit(_END + _END))
    return _bytes(F.concat(fields, http))


def write_archive(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> Archive:
    """Write the two tables of the archive and return them as read back."""
    rows = page_records(pages)
    digests = rows.select("page_id", "url", "sha256", "sha1", "bytes")
    leaders = keep_table(
        digests.where(F.col("bytes") >= revisit_bytes).groupBy("sha256")
        .agg(F.max("page_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "leaders")
    other = F.col("leader").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("leader"))
    typed = digests.join(leaders, "sha256", "left").withColumn(
        "record_type", F.when(other, F.lit("revisit")).otherwise(F.lit("response")))
    headers = keep_table(
        typed.select("page_id", "record_type", F.when(other, F.col("leader")).alias("refers_to"), "sha256",
                     _header().alias("header")), "warc-headers")
    payloads = keep_table(
        rows.select("sha256", "payload").groupBy("sha256").agg(F.first("payload").alias("payload")),
        "warc-payloads")
    return Archive(headers, payloads)


def records(archive: Archive) -> DataFrame:
    """page_id, record_type, refers_to, payload and the whole record, by a join of the two tables."""
    stored = archive.payloads.withColumn(
        "payload", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("payload does not have its digest "), F.col("sha256")))))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.headers.join(stored, "sha256").select(
        "page_id", "record_type", "refers_to", "payload",
        F.concat("header", body, F.lit((_END + _END).encode())).alias("record"))


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, f"(?m)^{name}: ([^\\r\\n]*)", 1)


def read_records(archive: Archive) -> DataFrame:
    """What the record bytes say: page_id, payload_bytes, payload_digest, record_type, refers_to,
    record_id, target and payload; a record that contradicts its payload raises an error."""
    rows = records(archive)
    # the WARC fields end at the first empty line; the HTTP header at the next one
    text = F.col("record").cast("string")
    head = F.substring_index(text, _END + _END, 1)
    http = F.substring_index(F.substring_index(text, _END + _END, 2), _END + _END, -1)
    digest = F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^sha1:", "")
    length = _field(http, "Content-Length").cast("long")
    block = _field(head, "Content-Length").cast("long")
    whole = F.octet_length("record") == F.octet_length(head) + 4 + block + 4
    # cut the payload out of a response; a revisit takes it from the record it refers to
    start = F.octet_length(head) + F.octet_length(http) + 9
    own = F.substring(F.col("record"), start, length.cast("int"))
    kind = _field(head, "WARC-Type")
    payload = F.when(kind == "response", own).otherwise(F.col("payload"))
    right = whole & (F.sha1(payload) == digest) & (F.octet_length(payload) == length)
    return rows.select(
        "page_id", length.alias("payload_bytes"),
        F.when(right, digest).otherwise(F.raise_error(F.lit("a record contradicts its payload"))).alias(
            "payload_digest"),
        kind.alias("record_type"), "refers_to", _field(head, "WARC-Record-ID").alias("record_id"),
        _field(head, "WARC-Target-URI").alias("target"), payload.alias("payload"))


def archive_pages(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write the pages as an archive and read the records back."""
    return read_records(write_archive(pages, revisit_bytes))
