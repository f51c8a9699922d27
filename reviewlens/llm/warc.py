"""WARC archives: writing captures with revisits, reading records, joining them to transactions.

A capture is three records that point at each other: the response (or the revisit of an earlier
response with the same payload), the request, and a metadata record. Reading gives one row per
record; :func:`transactions` joins them through their concurrent-to identifiers into one nested row
per capture.

Null html is an empty payload. Several rows with one page_id are several captures. Any text may be
in url and html: a header value is percent-coded where it holds control characters. A null page_id
is written as ``-`` and read back as null. A page must fit in a task's memory. An empty table gives an archive without records.
Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm.common import new_folder, stored

END = "\r\n"
#: Records of equal payloads are dealt over this many groups when they look up their response.
SPREAD = 32
#: Repeated payloads (a digest and a number each) that are broadcast: some 30 MB.
FEW = 300_000
#: Payload bytes of an archive, by the mean of all pages; records handed on at a time.
ARCHIVE_BYTES = 64_000_000
BATCH_ROWS, BATCH_BYTES = 500, 8_000_000
WRITTEN_AT = "2020-01-01T00:00:00Z"

RECORDS = (
    "type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "date string, payload_digest string, content_type string, fields map<string,string>, payload binary"
)


def payloads(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (text, never null) and its digest: upper-case base32 of the SHA-1."""
    text = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", text.alias("payload"), base32(F.sha1(text.cast("binary"))).alias("digest"))


def base32(hexadecimal):
    """Base32 of 40 hexadecimal digits: each ten are eight digits of five bits."""
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    groups = [F.lpad(F.conv(F.substring(hexadecimal, start + 1, 10), 16, 32), 8, "0") for start in range(0, 40, 10)]
    return F.translate(F.concat(*groups), digits, letters)


def with_response(captures: DataFrame, few: int = FEW) -> DataFrame:
    """Adds ``response_page``: of equal payloads, the largest page_id.

    Payloads that occur more than once are found by digest alone, with maxima formed before the
    shuffle. Up to ``few`` of them go to every task and no page is shuffled; more are joined, each
    copied to every group its records are dealt over, so a frequent payload is no hot key.
    """
    repeated = stored(
        captures.groupBy("digest")
        .agg(F.max("page_id").alias("response_page"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "response_page"),
        "repeated",
    )
    if repeated.count() <= few:
        found = captures.join(F.broadcast(repeated), "digest", "left")
    else:
        dealt = captures.withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.lit(SPREAD)).cast("int"))
        spread = repeated.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
        found = dealt.join(spread, ["digest", "part"], "left").drop("part")
    return found.withColumn("response_page", F.coalesce("response_page", "page_id"))


def _identifier(kind: str, page):
    return F.concat(F.lit(f"<urn:page:{kind}:"), page, F.lit(">"))


def _record(headers: list[tuple[str, object]], block, block_bytes):
    """Text of one record; a header whose value is null is left out."""
    lines = [F.lit("WARC/1.1" + END)]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit("")))
    lines += [F.lit("Content-Length: "), block_bytes.cast("string"), F.lit(END + END), block]
    return F.concat(*lines)


def record_texts(captures: DataFrame) -> DataFrame:
    """One column ``value`` with a record per row; captures come from :func:`with_response`."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    # One-line header values; the page's own characters stay as they are.
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "%", "%25"), "[\\x00-\\x20\\x7f]", "%20")
    # Several rows may have one page_id: the digest tells them apart.
    name = F.concat_ws(":", page, F.col("digest"), F.xxhash64("url").cast("string"))
    answer, ask, about = (_identifier(kind, name) for kind in ("response", "request", "metadata"))
    size = F.octet_length("payload")
    first = F.coalesce(F.col("page_id") == F.col("response_page"), F.lit(True))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size.cast("string"), F.lit(END + END))
    http = F.when(first, F.concat(head, F.col("payload"))).otherwise(head)
    request = F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{END}{END}"))
    fields = F.concat(
        F.lit("pageId: "), page, F.lit(END), F.lit("payloadBytes: "), size.cast("string"), F.lit(END),
        F.coalesce(F.concat(F.lit("refersToPage: "), F.when(~first, F.col("response_page").cast("string")), F.lit(END)), F.lit("")),
    )
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    records = F.array(
        _record(
            [
                ("WARC-Type", F.when(first, "response").otherwise("revisit")),
                ("WARC-Record-ID", answer),
                ("WARC-Date", WRITTEN_AT),
                ("WARC-Target-URI", uri),
                ("WARC-Payload-Digest", digest),
                ("WARC-Profile", F.when(~first, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                ("WARC-Refers-To", F.when(~first, _identifier("page", F.col("response_page").cast("string")))),
                ("Content-Type", "application/http; msgtype=response"),
            ],
            http,
            F.octet_length(http),
        ),
        _record(
            [
                ("WARC-Type", "request"),
                ("WARC-Record-ID", ask),
                ("WARC-Date", WRITTEN_AT),
                ("WARC-Target-URI", uri),
                ("WARC-Concurrent-To", answer),
                ("Content-Type", "application/http; msgtype=request"),
            ],
            request,
            F.octet_length(request),
        ),
        _record(
            [
                ("WARC-Type", "metadata"),
                ("WARC-Record-ID", about),
                ("WARC-Date", WRITTEN_AT),
                ("WARC-Target-URI", uri),
                ("WARC-Concurrent-To", answer),
                ("Content-Type", "application/warc-fields"),
            ],
            fields,
            F.octet_length(fields),
        ),
    )
    return captures.select(F.explode(records).alias("value"))


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write compressed archives with Spark's own committer, so a lost task leaves no half file.

    A record ends with an empty line and one more, which is the line end Spark writes per row. A file
    holds as many pages as make ``archive_bytes`` on average.
    """
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 1.0
    record_texts(with_response(payloads(pages))).write.option("lineSep", END + END).option(
        "maxRecordsPerFile", 3 * max(1, int(archive_bytes / max(mean, 1.0)))
    ).option("compression", "gzip").text(folder)


def parse(data: bytes):
    """Records of one archive, by their stated lengths, as tuples of :data:`RECORDS`. The archive is
    unpacked as it is read: memory holds the packed archive and one record."""
    packed = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=packed), 1 << 16) if data[:2] == b"\x1f\x8b" else packed
    number = 0
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record after {number} records")
        headers: dict[str, list[str]] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers.setdefault(name.lower(), []).append(value.strip())
        size = int(headers["content-length"][0])
        block = stream.read(size)
        if len(block) < size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record after {number} records is cut short")
        number += 1
        one = lambda name: headers.get(name, [None])[0]
        kind, fields, payload = one("warc-type"), None, None
        if one("content-type") == "application/warc-fields":
            pairs = (line.partition(":") for line in block.decode("utf-8").split(END) if line)
            fields = {name: value.strip() for name, _, value in pairs}
        elif kind == "response":
            payload = block[block.index(b"\r\n\r\n") + 4 :]
        yield (
            kind, one("warc-record-id"), headers.get("warc-concurrent-to"), one("warc-refers-to"), one("warc-target-uri"),
            one("warc-date"), one("warc-payload-digest"), one("content-type"), fields, payload,
        )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of all archives below a folder; files are read by Spark, one a row.

    A response's payload is checked against its digest; a damaged archive fails the read.
    """
    names = ("type", "record_id", "concurrent_to", "refers_to", "target_uri", "date", "payload_digest", "content_type", "fields", "payload")
    kinds = [pa.string(), pa.string(), pa.list_(pa.string())] + [pa.string()] * 5 + [pa.map_(pa.string(), pa.string()), pa.binary()]

    def records(stream):
        for batch in stream:
            for content in batch["content"]:
                rows: list[tuple] = []
                held = 0
                for row in parse(content.as_py()):
                    if row[9] is not None and row[6] is not None and row[6] != _digest(row[9]):
                        raise ValueError(f"payload of {row[1]} does not match its digest")
                    rows.append(row)
                    held += len(row[9] or b"")
                    if len(rows) == BATCH_ROWS or held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    def _batch(rows):
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(records, RECORDS)


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def transactions(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture`` (response or revisit), ``request``, ``metadata`` structs.

    Requests and metadata name the capture they were made with; a record that names none or an
    unknown one is left out, a capture without them has nulls there. Several records of a kind for
    one capture: the one with the smallest identifier.
    """
    whole = F.struct("type", "record_id", "refers_to", "target_uri", "date", "payload_digest", "payload")
    captures = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), whole.alias("capture")
    )

    def beside(kind: str) -> DataFrame:
        part = F.struct("record_id", "target_uri", "date", "fields")
        return (
            records.where(F.col("type") == kind)
            .select(F.explode("concurrent_to").alias("capture_id"), part.alias("part"))
            .groupBy("capture_id")
            .agg(F.min_by("part", F.col("part.record_id")).alias(kind))
        )

    return captures.join(beside("request"), "capture_id", "left").join(beside("metadata"), "capture_id", "left")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of all pages to the shared folder and assemble them again."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write(pages, folder)
    return transactions(read(spark, folder))
