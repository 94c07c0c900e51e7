"""WARC archives: records for pages, and reading them back with segments reassembled.

Pages are written as HTTP responses in chunked transfer framing; a response above ``segment_bytes``
is cut into a first record and continuations. Copies of a payload become revisit records. Reading
parses the records, groups continuations by the identifier of their origin, orders them by segment
number, verifies that the numbers are complete and the total length is right, and decodes the
framing.

Archives are written by Spark's text writer, whose line separator is the separator of WARC records,
and read as a stream by its reader, so they may be in any store that Spark reaches. Records go
through string columns as they are: Spark neither checks nor changes the bytes of a string that was
cast from binary.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import shared_path, staged

SEPARATOR = "\r\n\r\n"
VERSION = "WARC/1.1"
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
REVISIT_BYTES = 1000  # smaller payloads are always written in full
CHUNK_BYTES = 4096
SEGMENT_BYTES = 8192
ROWS_PER_FILE = 20_000


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for begin in range(0, len(payload), size):
        piece = payload[begin : begin + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are left out."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("a chunk has no size")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is shorter than its size")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, separator, body = block.partition(b"\r\n\r\n")
    if not separator:
        raise ValueError("the response has no end of headers")
    if re.search(rb"(?im)^transfer-encoding:.*\bchunked\b", head):
        return dechunked(body)
    return body


def record_id(page_id: int | None, digest: str, part: int = 1) -> str:
    """The identifier of a record: the same page, payload and part give the same one."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{part}').urn}>"


def _record(fields: dict[str, str | int | None], block: bytes) -> bytes:
    lines = [VERSION]
    for name, value in {**fields, "Content-Length": len(block)}.items():
        if value is not None:
            # A line end within a value would end the field.
            clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", str(value))
            lines.append(f"{name}: {clean}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def page_records(page_id, url, payload: bytes, digest: str, refers_to, segment_bytes: int):
    """The records of one page, without the separators that end them."""
    common = {
        "WARC-Date": RECORD_DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Page-ID": page_id,
    }
    if refers_to is not None:
        yield _record(
            {
                "WARC-Type": "revisit",
                "WARC-Record-ID": record_id(page_id, digest),
                "WARC-Profile": REVISIT_PROFILE,
                "WARC-Refers-To": record_id(refers_to, digest),
                **common,
            },
            b"",
        )
        return
    block = HTTP_HEAD + chunked(payload)
    parts = [block[k : k + segment_bytes] for k in range(0, len(block), segment_bytes)]
    origin = record_id(page_id, digest)
    for number, part in enumerate(parts, 1):
        fields = {
            "WARC-Type": "response" if number == 1 else "continuation",
            "WARC-Record-ID": record_id(page_id, digest, number),
            **common,
        }
        if len(parts) > 1:
            fields["WARC-Segment-Number"] = number
        if number > 1:
            fields["WARC-Segment-Origin-ID"] = origin
            if number == len(parts):
                fields["WARC-Segment-Total-Length"] = len(block)
        yield _record(fields, part)


def payload(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def write_archives(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Writes the records of ``pages`` (page_id, url, html) as compressed archives to ``path``.

    Of pages with equal payloads of at least ``revisit_bytes``, the one with the largest page_id is
    written in full and the others as revisits of it. Null html is an empty payload, a null url has
    no field. Rows that repeat a page are records of their own; pages without id revisit others but
    are never revisited. Extra columns are ignored.
    """
    body = payload(F.col("html"))
    hashed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        body.alias("payload"),
        F.sha1(body).alias("digest"),
    )
    narrow = staged(
        hashed.where(F.octet_length("payload") >= revisit_bytes).select("page_id", "digest"),
        "payloads",
    )
    winners = narrow.groupBy("digest").agg(
        F.max("page_id").alias("winner"), F.count("*").alias("n")
    )
    others = staged(
        narrow.join(staged(winners.where("n > 1"), "winners"), "digest")
        .where("winner IS NOT NULL AND NOT page_id <=> winner")
        .select(F.struct("page_id", "digest").alias("key"), F.col("winner").alias("refers_to"))
        .distinct(),
        "revisits",
    )
    rows = (
        hashed.withColumn("key", F.struct("page_id", "digest"))
        .join(others, "key", "left")
        .select("page_id", "url", "payload", "digest", "refers_to")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in zip(*(batch[name] for name in batch.schema.names)):
                for record in page_records(*(cell.as_py() for cell in row), segment_bytes):
                    held.append(record)
                    size += len(record)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    (
        rows.mapInArrow(run, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", SEPARATOR)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )


RECORD_SCHEMA = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, "
    "refers_to string, origin string, number int, total long, block binary"
)


def _parsed(head: bytes, block: bytes) -> tuple:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record does not begin with its version")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()

    def whole(name: str) -> int | None:
        return int(fields[name]) if name in fields else None

    number = whole("warc-segment-number")
    own = fields.get("warc-record-id")
    return (
        own,
        fields.get("warc-type"),
        whole("x-page-id"),
        fields.get("warc-target-uri"),
        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        fields.get("warc-refers-to"),
        fields.get("warc-segment-origin-id") or (own if number == 1 else None),
        number,
        whole("warc-segment-total-length"),
        block,
    )


def _stream(pieces: Iterator[bytes]) -> Iterator[tuple]:
    """Records of one archive from the texts between the separators, in order."""
    buffer = bytearray()
    need, head = None, b""
    separator = SEPARATOR.encode()
    for piece in pieces:
        buffer += piece + separator
        while True:
            if need is None:
                while buffer[:2] == b"\r\n":
                    del buffer[:2]
                end = buffer.find(separator)
                if end < 0:
                    break
                head = bytes(buffer[:end])
                length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
                if not length:
                    raise ValueError("a record has no length")
                need = int(length[1])
                del buffer[: end + 4]
            if len(buffer) < need:
                break
            yield _parsed(head, bytes(buffer[:need]))
            del buffer[:need]
            need = None
    if need is not None:
        raise ValueError("the last record is cut off")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives at ``path`` (``RECORD_SCHEMA``).

    Compressed archives are read from their begin by one task each, as a stream; a record is the
    most that is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), *[pa.string()] * 4]
        kinds += [pa.int32(), pa.int64(), pa.binary()]

        def rows(records: list[tuple]) -> pa.RecordBatch:
            columns = zip(*records)
            return pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names
            )

        def archives() -> Iterator[tuple[str, Iterator[bytes]]]:
            """Each archive with its pieces; an archive's pieces must be used up before the next."""
            cells = (
                (file, piece)
                for batch in batches
                for file, piece in zip(batch["file"].to_pylist(), batch["piece"].to_pylist())
            )
            ahead = next(cells, None)
            while ahead is not None:
                current = ahead[0]

                def pieces():
                    nonlocal ahead
                    while ahead is not None and ahead[0] == current:
                        yield ahead[1]
                        ahead = next(cells, None)

                yield current, pieces()

        held, size = [], 0
        for _, pieces in archives():
            for record in _stream(pieces):
                held.append(record)
                size += len(record[-1])
                if size > 1 << 22 or len(held) >= 1000:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    lines = spark.read.option("lineSep", SEPARATOR).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")
    ).mapInArrow(run, RECORD_SCHEMA)


def _decoded(rows: DataFrame) -> DataFrame:
    """``rows`` with the parts ``blocks`` joined and decoded to ``payload``, or the ``error``."""
    keep = ["record_id", "record_type", "page_id", "url", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                payloads, errors = [], []
                for blocks, error in zip(part["blocks"].to_pylist(), part["error"].to_pylist()):
                    found = None
                    if error is None and blocks is not None:
                        try:
                            found = payload_of(b"".join(blocks))
                        except ValueError as problem:
                            error = str(problem)
                    payloads.append(found)
                    errors.append(error)
                yield pa.RecordBatch.from_arrays(
                    [part[name] for name in keep]
                    + [pa.array(payloads, pa.binary()), pa.array(errors, pa.string())],
                    [*keep, "payload", "error"],
                )

    return rows.select(*keep, "blocks", "error").mapInArrow(
        run,
        "record_id string, record_type string, page_id long, url string, refers_to string, "
        "payload binary, error string",
    )


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per response and revisit record, with the reassembled payload of responses.

    (record_id, record_type, page_id, url, refers_to, payload, error). Only cut responses are
    shuffled, by their origin; a group is the parts of one response. A response whose parts are not
    complete, whose length is not the stated one or whose framing is broken has no payload and says
    why; one that was written several times is there as often.
    """
    records = read_records(spark, path)
    no_error = F.lit(None).cast("string").alias("error")
    whole = records.where("origin IS NULL")
    parts = F.sort_array("parts")
    grouped = (
        records.where("origin IS NOT NULL")
        .groupBy("origin")
        .agg(
            F.collect_set(F.struct("number", "block")).alias("parts"),
            F.max("total").alias("total"),
            F.max(F.when(F.col("number") == 1, F.struct("page_id", "url"))).alias("first"),
            F.count_if(F.col("number") == 1).alias("copies"),
        )
        .withColumn("parts", parts)
    )
    numbers = F.transform("parts", lambda p: p["number"])
    length = F.aggregate(
        "parts", F.lit(0).cast("long"), lambda total, p: total + F.octet_length(p["block"])
    )
    checked = (
        grouped.withColumn("blocks", F.transform("parts", lambda p: p["block"]))
        .withColumn(
            "error",
            F.when(numbers != F.sequence(F.lit(1), F.size("parts")), "a segment is missing")
            .when(F.col("total").isNull(), "the last segment is missing")
            .when(length != F.col("total"), "the total length is wrong"),
        )
        .where("copies > 0")
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
        .select(
            F.col("origin").alias("record_id"),
            F.lit("response").alias("record_type"),
            "first.page_id",
            "first.url",
            F.lit(None).cast("string").alias("refers_to"),
            "blocks",
            "error",
        )
    )
    columns = ["record_id", "record_type", "page_id", "url", "refers_to"]
    responses = whole.where("record_type = 'response'").select(
        *columns, F.array("block").alias("blocks"), no_error
    )
    revisits = whole.where("record_type = 'revisit'").select(
        *columns, F.lit(None).cast("array<binary>").alias("blocks"), no_error
    )
    return _decoded(responses.unionByName(revisits).unionByName(checked))


def archive_report(pages: DataFrame, **settings) -> DataFrame:
    """Writes ``pages`` as archives, reads them back, and gives one row per row of ``pages``.

    (page_id, payload_bytes, payload_digest, record_type, refers_to, error): the digests are of the
    payloads read; a revisit has those of the response it refers to. An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = shared_path(spark, "archives")
    write_archives(pages, path, **settings)
    read = staged(
        read_payloads(spark, path).select(
            "record_id",
            "record_type",
            "page_id",
            "refers_to",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha1("payload").alias("payload_digest"),
            "error",
        ),
        "records",
    )
    responses = read.where("record_type = 'response'")
    of = responses.select(
        F.col("record_id").alias("refers_to"),
        F.struct("page_id", "payload_bytes", "payload_digest").alias("of"),
    ).dropDuplicates(["refers_to"])
    revisits = read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error"]
    nothing = F.lit(None)
    resolved = revisits.join(staged(of, "targets"), "refers_to", "left").select(
        "page_id",
        F.col("of.payload_bytes").alias("payload_bytes"),
        F.col("of.payload_digest").alias("payload_digest"),
        "record_type",
        F.col("of.page_id").alias("refers_to"),
        F.when(F.col("of").isNull(), "the response is missing").alias("error"),
    )
    return (
        responses.withColumn("refers_to", nothing.cast("long")).select(*columns)
    ).unionByName(resolved.select(*columns))
