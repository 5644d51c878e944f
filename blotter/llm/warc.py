"""Content-addressed WARC archive.

A page becomes a record: an exact header block and a payload. Payload bytes are stored once, by
SHA-256 (verified against length and SHA-1 when read); headers are kept apart, one row each.
Records are rebuilt by joining the two. WARC files hold one gzip member per record, so readers can
seek to any of them, and are read back member by member, by the lengths that the headers state.
"""

from __future__ import annotations

import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import stored
from blotter.session import scratch_path

#: Payloads from this size on are stored once per archive, further records revisit them.
LEAST_SHARED = 1000
#: Records per archive file at most, by the bytes of their payloads (up to so many): a file, which
#: one task reads, holds about 64 MB, or one record.
FILE_RECORDS = ((1 << 17, 500), (1 << 22, 16), (None, 1))
#: Records of a batch that a reader hands on, and bytes after which it does so before.
READ_RECORDS, READ_BYTES = 64, 1 << 23
#: Bytes that a member is decompressed from at a time.
READ_PIECE = 1 << 16
#: The marks of the format.
VERSION = "WARC/1.1"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def page_records(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload digests and length, record type, and the page that a revisit refers
    to. Equal payloads of at least ``least_shared`` bytes have one response, the page with the
    largest id (a null id is smaller than any); repeated rows of it are responses too. Null html
    is an empty payload.

    Only digests are grouped (partial aggregates), so copies of one payload by the thousand send
    one row per task.
    """
    # bytes, so that what is hashed is what is stored
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    digested = pages.select(
        "page_id",
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("payload"),
    ).select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("sha256"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
    )
    return digested.withColumn("shared", F.col("bytes") >= least_shared)


def repeated_payloads(digested: DataFrame) -> DataFrame:
    """Digests that several rows share, with the largest page id."""
    return (
        digested.groupBy("sha256", "bytes", "sha1")
        .agg(F.max("page_id").alias("head_id"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
        .withColumn("repeated", F.lit(True))
    )


def typed_records(digested: DataFrame, repeated: DataFrame) -> DataFrame:
    """``digested`` with record_type, refers_to and whether its payload is stored from here
    (``stores``: null for a payload that only this row has)."""
    is_head = F.col("head_id").eqNullSafe(F.col("page_id"))
    revisit = F.col("shared") & F.coalesce("repeated", F.lit(False)) & ~is_head
    return (
        digested.join(repeated, ["sha256", "bytes", "sha1"], "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("head_id")))
        .withColumn("stores", F.when(F.col("repeated"), is_head))
        .drop("head_id", "repeated")
    )


def with_headers(records: DataFrame, date: str) -> DataFrame:
    """The exact header block of each record: the WARC fields, then the HTTP head of the block.
    ``date`` is the archive's, as the format writes it; a record without one is not valid.
    ``url`` keeps its text, but line ends in it would end the field, so they are percent-coded."""
    ident = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(F.lit(HTTP), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("record_type") == "revisit"
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", ident(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("X-Payload-Digest", F.concat(F.lit("sha256:"), F.col("sha256"))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(SAME_PAYLOAD)), line("WARC-Refers-To", ident(F.col("refers_to")))
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit("\r\n"),
        http,
    )
    return records.withColumn("header", header)


def write_archive(pages: DataFrame, path: str, least_shared: int = LEAST_SHARED, date: str | None = None) -> None:
    """``path``/headers: page_id, record_type, refers_to, sha256, bytes and the exact header of every
    record, dated now unless ``date`` (UTC, ``yyyy-MM-ddTHH:mm:ssZ``) is given. ``path``/payloads: sha256, sha1, bytes and payload, one row per distinct payload."""
    digested = page_records(pages, least_shared)
    repeated = stored(repeated_payloads(digested), "repeated-payloads")
    records = typed_records(digested, repeated)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    with_headers(records, date).select("page_id", "record_type", "refers_to", "sha256", "bytes", "header").write.parquet(
        f"{path}/headers"
    )
    columns = ["sha256", "sha1", "bytes", "payload"]
    alone = records.where(F.col("stores").isNull()).select(*columns)
    # of a repeated payload only the rows of its largest page id meet, to leave one
    once = records.where(F.col("stores")).select(*columns).dropDuplicates(["sha256", "sha1", "bytes"])
    for rows in (alone, once):
        rows.write.mode("append").option("compression", "zstd").parquet(f"{path}/payloads")


def rebuilt_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records: headers joined with the payloads by digest. A payload that does not
    match its digests stops the job."""
    stored_bytes = F.col("payload")
    sound = (F.sha2(stored_bytes, 256) == F.col("sha256")) & (F.octet_length(stored_bytes) == F.col("bytes"))
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "sha256",
        "bytes",
        F.when(sound, stored_bytes)
        .otherwise(F.raise_error(F.concat(F.lit("payload does not match "), F.col("sha256"))).cast("binary"))
        .alias("payload"),
    )
    return spark.read.parquet(f"{path}/headers").join(payloads, ["sha256", "bytes"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte, which is 0: it ends in the upper byte of
    the record's size, or, for a record of 16 MB or more, in that of an empty member behind it."""
    empty = gzip.compress(b"", mtime=0)
    for batch in batches:
        out = []
        for header, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            record = b"".join((header.encode(), payload or b"", b"\r\n\r\n"))
            member = gzip.compress(record, 6, mtime=0)
            out.append((member if member[-1] == 0 else member + empty)[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def _written_between(low: int, high: int | None):
    """Records whose written payload has from ``low`` to below ``high`` bytes; a revisit has none. The
    bounds stand on ``bytes`` alone, so that they reach the payloads before these are shuffled to their
    headers, and only those of the size that is written move."""
    revisit, size = F.col("record_type") == "revisit", F.col("bytes")
    if not low:
        return F.lit(True) if high is None else revisit | (size < high)
    above = ~revisit & (size >= low)
    return above if high is None else above & (size < high)


def write_warc(records: DataFrame, path: str) -> None:
    """WARC files of the rebuilt records (record_type, bytes, header, payload), one gzip member each;
    a revisit has no payload of its own. The text writer adds the last byte of a member as the end of
    its line. Records are put in files by size, so that no file is much above 64 MB but for a record
    that is larger alone."""
    payload = F.when(F.col("record_type") != "revisit", F.col("payload"))
    low = 0
    for high, per_file in FILE_RECORDS:
        inside = _written_between(low, high)
        members = records.where(inside).select("header", payload.alias("payload")).mapInArrow(_members, "value binary")
        writer = members.select(F.col("value").cast("string")).write.mode("append").option("lineSep", "\0")
        writer.option("maxRecordsPerFile", per_file).text(path)
        low = high


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: page_id, record_type, refers_to, sha256, sha1, payload_length as the
    headers state them, the exact header and the payload (null for a revisit). A task holds a file's
    compressed bytes and a few records."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for k in range(batch.num_rows):
                name, content = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                for record in parsed(content, name):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if len(held) >= READ_RECORDS or size >= READ_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(
        parse,
        "page_id long, record_type string, refers_to long, sha256 string, sha1 string, payload_length long, "
        "header string, payload binary",
    )


_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("sha256", pa.string()),
        ("sha1", pa.string()),
        ("payload_length", pa.int64()),
        ("header", pa.string()),
        ("payload", pa.binary()),
    ]
)


def unzipped(content: bytes, name: str) -> Iterator[tuple[int, bytes]]:
    """The members of a gzip file and where they begin, one at a time; empty ones are passed over."""
    view, at = memoryview(content), 0
    while at < len(content):
        member, parts, end = zlib.decompressobj(31), [], at
        try:
            # fed in pieces, as what is left of the last piece is copied
            while not member.eof and end < len(content):
                parts.append(member.decompress(view[end : end + READ_PIECE]))
                end = min(end + READ_PIECE, len(content))
        except zlib.error as e:
            raise ValueError(f"{name}: no member at byte {at}") from e
        if not member.eof:
            raise ValueError(f"{name}: the member at byte {at} does not end")
        if any(parts):
            yield at, b"".join(parts)
        at = end - len(member.unused_data)


def parsed(content: bytes, name: str) -> Iterator[dict]:
    """Walks an archive file, one record per member; what does not fit its stated lengths or digest
    stops the job."""

    def page(value: str | None) -> int | None:
        inner = (value or "")[len("<urn:page:") : -1]
        return int(inner) if inner and inner != "null" else None

    for at, data in unzipped(content, name):
        end = data.index(b"\r\n\r\n") + 4
        lines = data[: end - 4].decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"{name}: no record at byte {at}")
        field = dict(x.split(": ", 1) for x in lines[1:])
        size = int(field["Content-Length"])
        if len(data) != end + size + 4 or data[end + size :] != b"\r\n\r\n":
            raise ValueError(f"{name}: the record at byte {at} does not end where it says")
        head = data.index(b"\r\n\r\n", end) + 4
        payload = data[head : end + size] if field["WARC-Type"] == "response" else None
        sha1 = field["WARC-Payload-Digest"].removeprefix("sha1:")
        if payload is not None and hashlib.sha1(payload).hexdigest() != sha1:
            raise ValueError(f"{name}: the payload at byte {at} does not match its digest")
        yield {
            "page_id": page(field["WARC-Record-ID"]),
            "record_type": field["WARC-Type"],
            "refers_to": page(field.get("WARC-Refers-To")),
            "sha256": field["X-Payload-Digest"].removeprefix("sha256:"),
            "sha1": sha1,
            "payload_length": int(field["X-Payload-Length"]),
            "header": data[:head].decode(),
            "payload": payload,
        }


def archived_pages(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """Archive ``pages`` (page_id, url, html), write WARC files from the rebuilt records, read
    them back and describe each record: page_id, payload_bytes, payload_digest (SHA-1 of the
    full payload), record_type, refers_to.

    A response's figures are those of the payload read back. A revisit's are those of the
    response it refers to, found by joining on its digest. An empty table gives no rows; columns
    with other names are ignored.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archive")
    write_archive(pages, path, least_shared)
    headers = spark.read.parquet(f"{path}/headers")
    responses = rebuilt_records(spark, path).where(F.col("record_type") != "revisit")
    # a revisit's payload is not written, so it is not joined either
    revisits = headers.where(F.col("record_type") == "revisit").withColumn("payload", F.lit(None).cast("binary"))
    write_warc(responses.unionByName(revisits), f"{path}/warc")
    read = stored(
        read_warc(spark, f"{path}/warc").select(
            "page_id",
            "record_type",
            "refers_to",
            "sha256",
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha1("payload").alias("sha1"),
        ),
        "archive-read",
    )
    responses = read.where(F.col("record_type") == "response")
    full = responses.groupBy("sha256").agg(F.max("bytes").alias("bytes"), F.max("sha1").alias("sha1"))
    revisits = read.where(F.col("record_type") == "revisit").drop("bytes", "sha1").join(full, "sha256")
    return (
        responses.unionByName(revisits)
        .select(
            "page_id",
            F.col("bytes").alias("payload_bytes"),
            F.col("sha1").alias("payload_digest"),
            "record_type",
            "refers_to",
        )
    )
