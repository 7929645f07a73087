"""WARC archives: writing captures as linked records, reading them back, assembling transactions.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record; request and
metadata name the main record in WARC-Concurrent-To. Archives are gzipped text files of a bounded number of
records, written and listed by Spark alone, so any store that Spark reaches will do.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators.ordered import join_heavy
from reviewlens.sources.scratch import materialise

#: Payloads below this many bytes are always stored.
LEAST_REVISIT = 100
#: Records in an archive file, so that a file can be read by one task.
FILE_RECORDS = 6_000
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string,"
    " payload_bytes long, payload_digest string, payload binary, page_id long"
)


def _record(kind: str, record_id: Column, headers: list[Column], block: Column) -> Column:
    """A record without the blank lines that end it; null headers are left out."""
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), kind if isinstance(kind, Column) else F.lit(kind)),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        F.lit(f"WARC-Date: {EPOCH}"),
        *headers,
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit("\r\n\r\n"), block)


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value)


def _urn(what: Column) -> Column:
    x = F.md5(what.cast("binary"))
    parts = [x.substr(a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, file_records: int = FILE_RECORDS, floor: int = 100_000, repeats: bool = False
) -> None:
    """Writes (page_id, url, html) as archives under ``path``.

    Of the captures with equal payloads of at least 100 bytes the one of smallest page_id holds the payload, the
    others are revisits that refer to it; smaller payloads are all stored. A null html is an empty payload,
    a null url has no target, a null page_id comes after all others; line breaks and controls in a url are
    percent-encoded. Rows that agree in page_id, url and html are one capture, or with ``repeats`` a capture
    each. Other columns are left out. An empty table writes no records.

    The choice is made on digests: a group of copies of any size is one row per task, then joined back in
    pieces of at least ``floor`` rows.
    """
    html = F.coalesce("html", F.lit(""))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    pages = pages.select("page_id", url.alias("url"), html.alias("html"))
    digest = F.sha2("html", 256)
    known = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-")), digest)
    named = pages.withColumns({"digest": digest, "n": F.octet_length("html"), "rid": _urn(known)})
    narrow = named.groupBy("page_id", "digest", "n", "rid").agg(F.count("*").alias("times"))
    narrow = materialise(narrow, "captures")
    order = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "rid")
    groups = narrow.filter(F.col("n") >= LEAST_REVISIT).groupBy("digest")
    groups = groups.agg(F.min(order).alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    groups = groups.select("digest", F.col("first.rid").alias("response"), "copies")
    placed = join_heavy(narrow.select("rid", "digest", "n"), groups, ["digest"], "copies", "rid", "inner", floor=floor)
    revisits = materialise(placed.filter("rid <> response").select("rid", "response"), "revisits")
    # a payload travels only if the revisits are too many to broadcast
    rows = named.join(revisits, "rid", "left")
    if repeats:
        rows = _numbered(rows, narrow.filter("times > 1").select("rid", "times"), floor)
    again = F.col("response").isNotNull()
    target = _header("WARC-Target-URI", F.col("url"))
    payload = _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit("\r\n\r\n"),
        F.when(again, F.lit("")).otherwise(F.col("html")),
    )
    main = _record(
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.col("rid"),
        [
            target,
            payload,
            _header("WARC-Refers-To", F.col("response")),
            F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
            F.lit("Content-Type: application/http; msgtype=response"),
        ],
        http,
    )
    linked = [target, _header("WARC-Concurrent-To", F.col("rid"))]
    request = _record(
        "request",
        _urn(F.concat(F.col("rid"), F.lit("request"))),
        [*linked, F.lit("Content-Type: application/http; msgtype=request")],
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    metadata = _record(
        "metadata",
        _urn(F.concat(F.col("rid"), F.lit("metadata"))),
        [*linked, F.lit("Content-Type: application/warc-fields")],
        F.concat_ws("", F.lit("pageId: "), F.col("page_id").cast("string"), F.lit("\r\n")),
    )
    records = rows.select(F.explode(F.array(request, main, metadata)).alias("value"))
    writer = records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", file_records).text(path)


def _numbered(rows: DataFrame, repeated: DataFrame, floor: int) -> DataFrame:
    """``rows`` with a rid of its own for each of equal rows: the first keeps it, the others add their number.

    Equal rows need no order: one of them meets the numbers, in pieces of at least ``floor``.
    """
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "rid").dropDuplicates(["rid"])
    # some numbers at a time, so that no array is as long as a group
    starts = F.sequence(F.lit(1).cast("long"), F.col("times") - 1, F.lit(10_000).cast("long"))
    numbers = repeated.select("rid", "times", F.explode(starts).alias("start"))
    last = F.least(F.col("times") - 1, F.col("start") + 9_999)
    numbers = numbers.select("rid", F.explode(F.sequence("start", last)).alias("number"))
    more = join_heavy(numbers, one, ["rid"], "times", "number", "inner", floor=floor)
    more = more.withColumn("rid", _urn(F.concat_ws("|", "rid", F.col("number").cast("string"))))
    rest = rows.join(repeated, "rid", "left_anti")
    return rest.unionByName(one.select(*rows.columns)).unionByName(more.select(*rows.columns))


def _fields(lines: bytes) -> dict[str, str]:
    """Named fields of a header block, names in lower case, the last of a name."""
    found = {}
    for line in lines.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def records_of(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, gzipped as a whole or record by record, or plain.

    Blocks are cut by their Content-Length, so they may hold anything. What is cut short at the end is left out.
    """
    plain = []
    while raw[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        plain.append(member.decompress(raw))
        raw = member.unused_data
    data = b"".join(plain) if plain else raw
    at = data.find(b"WARC/1.")
    while at >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = _fields(data[at:end])
        size = int(head.get("content-length", "0"))
        if end + 4 + size > len(data):
            return
        yield head, data[end + 4 : end + 4 + size]
        at = data.find(b"WARC/1.", end + 4 + size)


def _rows(raw: bytes) -> Iterator[tuple]:
    for head, block in records_of(raw):
        kind, payload, size, digest, page = head.get("warc-type"), None, None, None, None
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if kind == "revisit":  # only the headers tell of the payload
                size = int(_fields(http).get("content-length", "0"))
                digest = head.get("warc-payload-digest", "").removeprefix("sha256:") or None
                payload = None
        elif kind == "metadata":
            value = _fields(block).get("pageid", "")
            page = int(value) if value else None
        link = head.get("warc-concurrent-to")
        yield (head.get("warc-record-id"), kind, link, head.get("warc-refers-to"), head.get("warc-target-uri"),
               size, digest, payload, page)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives under ``path``; a task holds one file's records at a time."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                rows = list(_rows(raw.as_py()))
                for k in range(0, len(rows), 1000):
                    columns = zip(*rows[k : k + 1000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
                    )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter("length > 0").select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response (or revisit), metadata.

    Requests and metadata join the main record that they are concurrent to; a main record without them has
    nulls there. A record whose main record is missing belongs to no capture. Records that repeat an id
    count once.
    """
    main = records.filter(F.col("type").isin("response", "revisit")).dropDuplicates(["record_id"])
    main = main.select(
        F.col("record_id").alias("capture_id"),
        F.struct("type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload").alias("response"),
    )

    def linked(kind: str, *fields: str) -> DataFrame:
        own = records.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        return own.groupBy(F.col("concurrent_to").alias("capture_id")).agg(
            F.min(F.struct("record_id", *fields)).alias(kind)
        )

    found = main.join(linked("request", "target_uri"), "capture_id", "left")
    return found.join(linked("metadata", "page_id"), "capture_id", "left")


def captures(records: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id) and url."""
    flat = assemble(records).select(
        "capture_id",
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("target"),
        F.col("response.target_uri").alias("url"),
    )
    flat = materialise(flat, "assembled")
    pointed = flat.filter("record_type = 'response'").select(
        F.col("capture_id").alias("target"), F.col("page_id").alias("refers_to")
    )
    return flat.join(pointed, "target", "left").drop("target", "capture_id")
