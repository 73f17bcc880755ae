"""Web archives: writing pages as records, and assembling captures from records.

Writing: each page gives a request, a response (or a revisit, if its payload is that of
another page) and a metadata record, tied by WARC-Concurrent-To. Files are written by
Spark's text writer, one capture per row, with the blank lines that end a record as the
row separator; a plain uncompressed archive is the result.

Reading: files are split at the version line that starts a record, so a large archive is
read by many tasks. Lengths are checked. Records of one capture are then joined through
their concurrent-to identifiers, wherever they lie, and become one nested row.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import stored, texts
from medallion.session import work_dir

VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
# Fixed values of the format.
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = b"2024-01-01T00:00:00Z"
CAPTURED = ("response", "revisit")

RECORDS = (
    "record_id string, type string, uri string, concurrent_to array<string>, refers_to string, "
    "date string, payload_digest string, payload_bytes long, payload binary, fields map<string,string>"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: bytes, record_id: str, block: bytes, fields: list[tuple[bytes, bytes]]) -> bytes:
    """A record without the two blank lines that end it."""
    head = [(b"WARC-Type", kind), (b"WARC-Record-ID", f"<{record_id}>".encode()), (b"WARC-Date", DATE), *fields]
    head.append((b"Content-Length", str(len(block)).encode()))
    return VERSION + b"".join(n + b": " + v + b"\r\n" for n, v in head) + b"\r\n" + block


def http_response(payload: bytes, body: bool = True) -> bytes:
    """An HTTP message. A body that contains a record's version line is sent in chunks
    that cut it, so the line never occurs inside a record."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    length = b"X-Payload-Length: " + str(len(payload)).encode() + b"\r\n"
    if not body:
        return head + length + b"\r\n"
    if VERSION not in payload + b"\r\n":
        return head + b"Content-Length: " + str(len(payload)).encode() + b"\r\n\r\n" + payload
    pieces = re.split(rb"(?<=WARC/1)(?=\.1(?:\r\n|\Z))", payload)
    chunks = b"".join(f"{len(p):x}".encode() + b"\r\n" + p + b"\r\n" for p in pieces if p)
    return head + length + b"Transfer-Encoding: chunked\r\n\r\n" + chunks + b"0\r\n\r\n"


def parse_fields(head: bytes) -> list[tuple[str, str]]:
    """Names in lower case; folded lines are joined."""
    found: list[tuple[str, str]] = []
    for line in head.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def http_payload(block: bytes) -> tuple[bytes, dict[str, str]]:
    """The body of an HTTP message, chunks joined, and its fields."""
    head, _, body = block.partition(END)
    fields = dict(parse_fields(head.partition(b"\r\n")[2]))
    if fields.get("transfer-encoding", "").lower() != "chunked":
        return body, fields
    parts, at = [], 0
    while at < len(body):
        line = body.index(b"\r\n", at)
        length = int(body[at:line].split(b";")[0], 16)
        if not length:
            break
        parts.append(body[line + 2 : line + 2 + length])
        at = line + 4 + length
    return b"".join(parts), fields


def parse_record(data: bytes) -> dict:
    """A record given without its version line; ValueError if its length is not as stated."""
    head, blank, rest = data.partition(END)
    pairs = parse_fields(head)
    fields = dict(pairs)
    length = int(fields.get("content-length", -1))
    if not blank or length < 0 or len(rest) < length or rest[length:].strip(b"\r\n"):
        raise ValueError(f"a record's block has not the stated length {length}")
    block = rest[:length]
    kind = fields.get("warc-type", "")
    is_http = fields.get("content-type", "").startswith("application/http")
    payload, http = http_payload(block) if is_http and kind != "request" else (block, {})
    size = len(payload)
    if kind == "revisit":
        size = int(http.get("x-payload-length", http.get("content-length", -1)))
    return {
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "type": kind,
        "uri": fields.get("warc-target-uri"),
        "concurrent_to": [v.strip("<>") for n, v in pairs if n == "warc-concurrent-to"],
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "date": fields.get("warc-date"),
        "payload_digest": fields.get("warc-payload-digest", "").rpartition(":")[2] or None,
        "payload_bytes": size if size >= 0 else None,
        "payload": None if kind == "revisit" else payload,
        "fields": list(fields.items()),
    }


def _capture_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch.column(c) for c in ("page_id", "url", "payload", "response_id", "is_response"))
        for page_id, url, payload, response_id, is_response in zip(*columns):
            page_id, payload = page_id.as_py(), payload.as_py()
            uri = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], (url.as_py() or "").encode())
            uri = uri.replace(b"WARC/1.1", b"WARC%2F1.1")
            own = response_id.as_py() if is_response.as_py() else uuid.uuid4().urn
            tie = (b"WARC-Concurrent-To", f"<{own}>".encode())
            target = (b"WARC-Target-URI", uri)
            digest = (b"WARC-Payload-Digest", b"sha1:" + payload_digest(payload).encode())
            http = (b"Content-Type", b"application/http; msgtype=response")
            if is_response.as_py():
                main = record(b"response", own, http_response(payload), [target, digest, http])
            else:
                refers = (b"WARC-Refers-To", f"<{response_id.as_py()}>".encode())
                profile = (b"WARC-Profile", REVISIT_PROFILE)
                main = record(b"revisit", own, http_response(payload, body=False), [target, refers, profile, digest, http])
            request = record(
                b"request", uuid.uuid4().urn, b"GET " + uri + b" HTTP/1.1\r\n\r\n",
                [target, tie, (b"Content-Type", b"application/http; msgtype=request")],
            )
            about = b"" if page_id is None else f"page_id: {page_id}\r\n".encode()
            metadata = record(
                b"metadata", uuid.uuid4().urn, about, [target, tie, (b"Content-Type", b"application/warc-fields")]
            )
            rows.append(END.join([request, main, metadata]))
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def write_pages(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """A capture per row of ``pages`` (page_id, url, html), payload the html in UTF-8.

    Of rows with equal payloads the one of the smallest page_id has the response, the
    others revisit it; of repeated page_ids the first row read, and rows without page_id
    come last. A null html is an empty payload, a null url an empty one, and an empty
    table gives no records. ``pages`` must give its rows in the same partitions each
    time, as a stored table does. Other columns are ignored.

    Each file is compressed as a whole: one task then reads it, record by record, so
    files are as large as the tasks that write them. ``compression="none"`` gives files
    that are split among tasks.
    """
    payload = F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")
    ).withColumns({"digest": F.unhex(F.sha2("payload", 256)), "row": F.monotonically_increasing_id()})
    first = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row"))
    firsts = rows.groupBy("digest").agg(first.getField("row").alias("first_row"))
    firsts = firsts.withColumn("response_id", F.concat(F.lit("urn:sha256:"), F.lower(F.hex("digest"))))
    captures = rows.join(firsts, "digest").select(
        "page_id", "url", "payload", "response_id", (F.col("row") == F.col("first_row")).alias("is_response")
    )
    archived = captures.mapInArrow(_capture_batches, "value binary")
    archived.select(F.col("value").cast("string")).write.options(lineSep=END.decode(), compression=compression).text(path)


def _record_batches(payloads: bool) -> Callable:
    kinds = {
        "concurrent_to": pa.list_(pa.string()), "payload_bytes": pa.int64(),
        "payload": pa.binary(), "fields": pa.map_(pa.string(), pa.string()),
    }
    names = re.findall(r"(\w+) (?:string|array<string>|long|binary|map<string,string>)", RECORDS)

    def checked(data: bytes) -> dict:
        found = parse_record(data)
        if found["type"] == "response" and not payloads:
            if found["payload_digest"] != payload_digest(found["payload"]):
                raise ValueError(f"{found['record_id']}: the payload has not the stated digest")
            found["payload"] = None
        return found

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = [checked(v) for v in texts(batch.column("value")) if v.strip()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names
            )

    return batches


def read_records(spark, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives under ``path``, as in ``RECORDS``.

    Archives are split at version lines. A foreign archive with such a line inside a
    block is refused by the length check rather than read wrongly. A revisit's payload
    is null and its size the one its HTTP head states. Without ``payloads`` those of
    responses are only checked against their digests.
    """
    lines = spark.read.option("lineSep", VERSION.decode()).text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(_record_batches(payloads), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: record_id, type, and the response or revisit, requests and
    metadata as nested values.

    A record belongs to the captures it is concurrent to, directly or, for a record tied
    only to a request, through that. Records tied to no response or revisit are no
    capture. An empty table gives no row.
    """
    main = records.where(F.col("type").isin(*CAPTURED))
    others = records.where(~F.col("type").isin(*CAPTURED)).select(
        "record_id", "concurrent_to", F.struct("record_id", "type", "uri", "date", "payload", "fields").alias("record")
    )
    ties = records.select("record_id", "type", F.explode("concurrent_to").alias("other"))
    # A tie may be stated by either record.
    from_main = ties.where(F.col("type").isin(*CAPTURED)).select(F.col("other").alias("record_id"), F.col("record_id").alias("capture"))
    from_others = ties.where(~F.col("type").isin(*CAPTURED)).select("record_id", F.col("other").alias("capture"))
    known = main.select(F.col("record_id").alias("capture"))
    direct = from_main.unionByName(from_others.join(known, "capture", "left_semi")).distinct()
    indirect = (
        from_others.join(known, "capture", "left_anti").withColumnRenamed("capture", "through")
        .join(direct.withColumnRenamed("record_id", "through"), "through")
        .select("record_id", "capture")
    )
    tied = direct.unionByName(indirect).distinct().join(others.select("record_id", "record"), "record_id")
    of = tied.groupBy("capture").agg(
        F.sort_array(F.collect_list(F.when(F.col("record.type") == "request", F.struct("record.record_id", "record.uri", "record.date", "record.payload")))).alias("requests"),
        F.sort_array(F.collect_list(F.when(F.col("record.type") == "metadata", F.struct("record.record_id", "record.uri", "record.date", "record.payload")))).alias("metadata"),
    )
    return main.join(of.withColumnRenamed("capture", "record_id"), "record_id", "left").select(
        "record_id", "type",
        F.struct("uri", "date", "payload_digest", "payload_bytes", "payload", "refers_to").alias("response"),
        "requests", "metadata",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` into the shared folder, read them back and assemble their captures.

    Per page: page_id, payload_bytes, payload_digest, record_type, and the page_id of
    the response it refers to.
    """
    spark = pages.sparkSession
    path = work_dir(spark, "warc")
    write_pages(pages, path)
    records = stored(read_records(spark, path, payloads=False), "records")
    stated = F.regexp_extract(F.element_at("metadata", 1)["payload"].cast("string"), r"page_id: (-?\d+)", 1)
    captures = assemble(records).select(
        "record_id", F.col("type").alias("record_type"),
        F.when(stated != "", stated.cast("long")).alias("page_id"),
        "response.payload_bytes", "response.payload_digest", F.col("response.refers_to").alias("refers"),
    )
    captures = stored(captures, "captures")
    targets = captures.where("record_type = 'response'").select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to")
    )
    return captures.join(targets, "refers", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
