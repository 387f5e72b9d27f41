"""WARC archives: writing with copies as revisits, and reading back with segments put together.

Writing: each row becomes a record whose block is an HTTP response with a chunked body.  Of rows with
equal payloads of at least `min_bytes`, the one with the smallest key is the response and the others
are revisits that name it and carry no payload; shorter payloads are all responses.  A block longer than
`segment_bytes` is cut into continuation records.  Reading: segments are grouped by their origin
record, put in order of segment number, checked against the total length, and the chunked framing is
decoded and checked against the digest.

Every row gives one row.  A null payload counts as empty.  A null key is larger than any other; if all
keys of equal payloads are null, all are responses.  Rows equal to the smallest in key and payload are
all responses.  `problem` says what is wrong with a record, else it is null.  A revisit names its response's
record by WARC-Refers-To unless several rows are alike in its key and payload; the key is named in any
case.  An empty table gives no rows; columns other than the three named ones take no part.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm.common import arrow_map, slices, stored, texts
from ledgerlink.sources.store import shared_folder

_END = b"\r\n\r\n"
_RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, problem string"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; an error if the framing is broken."""
    at, parts = 0, []
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = line + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        parts.append(body[line + 2 : at])
        at += 2


def record(fields: dict[str, object], block: bytes) -> bytes:
    """A record without the two line breaks that end it."""
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in fields.items() if v is not None)]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block])


def info_record(date: str) -> tuple[str, bytes]:
    """A new warcinfo record and its id."""
    name = _new_id()
    fields = {"WARC-Type": "warcinfo", "WARC-Record-ID": name, "WARC-Date": date, "Content-Type": "application/warc-fields"}
    return name, record(fields, b"format: WARC File Format 1.1\r\n")


def _new_id() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def _named_id(key: int, payload: bytes) -> str:
    """The id of the response that revisits refer to, known from its key and payload."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key} {digest(payload)}')}>"


def page_records(
    key: int | None, url: str, payload: bytes, first: int | None, chunk_bytes: int, segment_bytes: int,
    date: str = "1970-01-01T00:00:00Z", info: str | None = None, named: int | None = None,
) -> Iterator[bytes]:
    """The records of one row: a revisit of `first`, or a response in as many segments as it needs.

    `named` is the key of the one response with this payload that revisits can name by its record id.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    name = _named_id(key, payload) if first is None and key is not None and key == named else _new_id()
    fields = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": date,
        "WARC-Warcinfo-ID": info,
        "WARC-Target-URI": " ".join(url.split()) or None,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "X-Page-ID": key,
    }
    if first is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields["WARC-Refers-To"] = None if named is None else _named_id(named, payload)
        fields["X-Refers-To-Page-ID"] = first
        yield record(fields, http + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = http + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield record(fields, block)
        return
    for number, part in enumerate(parts, 1):
        own = dict(fields) if number == 1 else {
            "WARC-Type": "continuation", "WARC-Record-ID": _new_id(), "WARC-Date": date, "WARC-Warcinfo-ID": info,
            "WARC-Segment-Origin-ID": name,
        }
        own["WARC-Segment-Number"] = number
        if number == len(parts):
            own["WARC-Segment-Total-Length"] = len(block)
        yield record(own, part)


def write(
    pages: DataFrame, folder: str, min_bytes: int = 0, key: str = "page_id", url: str = "url", payload: str = "html",
    chunk_bytes: int = 4096, segment_bytes: int = 32768, date: str | None = None,
) -> None:
    """Write the archive files.  Only the table of payloads that occur more than once is joined to the pages.

    Each task writes one warcinfo record, which its other records name.  `date` (default: now) is the date
    of all records.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    text = F.coalesce(pages[payload].cast("string"), F.lit(""))
    rows = pages.select(pages[key].cast("bigint").alias("key"), F.coalesce(pages[url].cast("string"), F.lit("")).alias("url"), text.alias("text"))
    rows = rows.withColumn("sum", F.sha1("text"))
    long_enough = rows.filter(F.octet_length("text") >= min_bytes)
    # Rows alike in key and payload are all responses, and then no single record can be named.
    alike = long_enough.groupBy("sum", "key").agg(F.count("*").alias("n"))
    smallest = F.min(F.when(F.col("key").isNotNull(), F.struct("key", F.col("n").alias("alike"))))
    copies = alike.groupBy("sum").agg(smallest.alias("smallest"), F.sum("n").alias("n")).filter("n > 1")
    named = F.when(F.col("smallest.alike") == 1, F.col("smallest.key")).alias("named")
    copies = copies.select("sum", F.col("smallest.key").alias("first"), named)
    met = rows.join(stored(copies, "warc-copies"), "sum", "left").drop("sum")
    met = met.withColumn("first", F.when(F.col("key").isNull() | (F.col("key") > F.col("first")), F.col("first")))

    def run(batches):
        info = None
        for batch in slices(batches, "text"):
            made = []
            if info is None:
                info, opening = info_record(date)
                made.append(opening)
            columns = (batch.column(c).to_pylist() for c in ("key", "first", "named"))
            for k, first, named, u, t in zip(*columns, texts(batch, "url"), texts(batch), strict=True):
                made += page_records(k, u, t.encode(), first, chunk_bytes, segment_bytes, date, info, named)
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])

    # Spark's text writer puts a string's bytes out as they are, and ends each with the separator.
    records = arrow_map(met, run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", _END.decode()).option("maxRecordsPerFile", 2000).text(folder)


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (lower-case names) and block of each record of a file."""
    at = 0
    while at < len(content):
        stop = content.index(_END, at)
        lines = content[at:stop].decode().split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = stop + len(_END)
        end = start + int(fields["content-length"])
        yield fields, content[start:end]
        at = end + len(_END)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def restored(segments: list[tuple[dict[str, str], bytes]]) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, problem of a record and its continuations."""
    segments = sorted(segments, key=lambda s: int(s[0].get("warc-segment-number", 1)))
    fields, last = segments[0][0], segments[-1][0]
    block = b"".join(s[1] for s in segments)
    page, refers = _number(fields.get("x-page-id")), _number(fields.get("x-refers-to-page-id"))
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    numbers = [int(s[0].get("warc-segment-number", 1)) for s in segments]
    total = _number(last.get("warc-segment-total-length"))
    cut = len(numbers) > 1 or "warc-segment-number" in fields
    if numbers != list(range(1, len(numbers) + 1)) or (cut and total != len(block)):
        return page, None, stated, kind, refers, "segments are missing"
    head, _, body = block.partition(_END)
    header = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}
    if kind == "revisit":
        return page, _number(header.get("content-length")), stated, kind, refers, None
    try:
        payload = unchunked(body) if header.get("transfer-encoding") == "chunked" else body
    except ValueError as error:
        return page, None, stated, kind, refers, str(error)
    found = digest(payload)
    return page, len(payload), found, kind, refers, None if found == stated else "the digest differs"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def _origin(fields: dict[str, str]) -> str | None:
    """The record that a segment belongs to; none for a whole record."""
    if "warc-segment-origin-id" in fields:
        return fields["warc-segment-origin-id"]
    return fields["warc-record-id"] if "warc-segment-number" in fields else None


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, problem of each record but warcinfo.

    Files are read once: whole records are restored there, and only segments are stored and shuffled, by
    origin.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    empty = _batch([])

    def parsed(batches):
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for content in batch.column("content"):
                whole, found = [], []
                for fields, block in records(content.as_py()):
                    origin = _origin(fields)
                    if origin is not None:
                        found.append((origin, list(fields.items()), block))
                    elif fields.get("warc-type") != "warcinfo":
                        whole.append(restored([(fields, block)]))
                pieces = [pa.array([x[k] for x in found], t) for k, t in enumerate((pa.string(), kind, pa.binary()))]
                rows = _batch(whole)
                upper = [*rows.columns, *(pa.nulls(len(whole), p.type) for p in pieces)]
                lower = [*(pa.nulls(len(found), c.type) for c in empty.columns), *pieces]
                names = [*rows.schema.names, "origin", "fields", "block"]
                yield pa.RecordBatch.from_arrays(upper, names)
                yield pa.RecordBatch.from_arrays(lower, names)

    def together(batches):
        for batch in batches:
            yield _batch([restored([(dict(s["fields"]), s["block"]) for s in g]) for g in batch.column("segments").to_pylist()])

    found = stored(arrow_map(files, parsed, f"{_RESULT}, origin string, fields map<string,string>, block binary"), "warc-read")
    segments = found.filter("origin is not null")
    groups = segments.groupBy("origin").agg(F.collect_list(F.struct("fields", "block")).alias("segments")).select("segments")
    return found.filter("origin is null").select(*empty.schema.names).unionByName(arrow_map(groups, together, _RESULT))


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the pages below the session's shared folder and read them back."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write(pages, folder, **options)
    return read(spark, folder)
