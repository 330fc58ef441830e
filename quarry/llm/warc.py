"""WARC archives: write pages as records, read archives back.

`write_archive` writes one record per page: a `response` record (an HTTP
message whose body is the payload in chunked transfer coding), or a `revisit`
of the response that holds the same payload. A block longer than
`segment_bytes` is cut into a first record and `continuation` records, as the
WARC 1.1 standard describes. Files are gzip members written by Spark, so they
can lie in any store that Spark writes to.

`read_archive` reads such files, groups continuation records by their origin
identifier, orders them by segment number, checks the total length, parses the
HTTP message and decodes the chunked transfer coding.

Scale: pages meet by the digest of their payload in one combined aggregate of
narrow rows; the first-copy table is written and joined back, so a payload
shared by a third of all pages is split by adaptive execution. Only the
segments of one record ever meet in one place, and only records that were cut
are shuffled on reading.

Defined cases: a null payload is empty; a null url is written as an empty one;
a null id sorts after all ids and stays null; rows that repeat id and payload
give the same records, and reading returns as many rows as were written; empty
input gives an archive without records. Any other columns are ignored. A
malformed archive (bad header, missing segment, wrong length, bad chunk) fails
the read with a message that names the record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import staged

# Fixed values of the WARC 1.1 and HTTP 1.1 standards.
VERSION = b"WARC/1.1"
BREAK = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

_FLUSH = 8 << 20  # bytes of records handed on at a time
_PIECE = 1 << 16  # compressed bytes inflated at a time


def record_id(page_id: int | None, digest: str) -> str:
    name = hashlib.md5(f"{page_id}|{digest}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=name)}>"


def chunked(body: bytes, size: int) -> bytes:
    """`body` in HTTP chunked transfer coding."""
    parts = []
    for at in range(0, len(body), size):
        piece = body[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(message: bytes, at: int) -> bytes:
    """Body in chunked transfer coding from position `at`."""
    parts = []
    while True:
        end = message.index(b"\r\n", at)
        size = int(message[at:end].split(b";")[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if message[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(message[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """Body of an HTTP message, its transfer coding removed."""
    head_end = block.index(BREAK) + len(BREAK)
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", block[:head_end].replace(b"\r", b"")):
        return unchunked(block, head_end)
    return block[head_end:]


def _record(fields: Iterable[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in fields if v is not None]]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + BREAK + block


def page_records(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    first_id: int | None,
    segment_bytes: int,
    chunk_bytes: int,
    date: str,
) -> Iterator[bytes]:
    """The records of one page, without the line breaks that end a record."""
    own = record_id(page_id, digest)
    uri = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
    common = [("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-ID", page_id)]
    about = [("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if first_id is not None and first_id != page_id:
        yield _record(
            [
                ("WARC-Type", "revisit"),
                ("WARC-Record-ID", own),
                *common,
                ("WARC-Profile", REVISIT_PROFILE),
                ("WARC-Refers-To", record_id(first_id, digest)),
                *about,
            ],
            HTTP_HEAD,
        )
        return
    block = HTTP_HEAD + chunked(payload, chunk_bytes)
    cuts = range(0, len(block), segment_bytes)
    number = 1 if len(cuts) > 1 else None
    yield _record(
        [("WARC-Type", "response"), ("WARC-Record-ID", own), *common, *about, ("WARC-Segment-Number", number)],
        block[:segment_bytes],
    )
    for number, at in enumerate(cuts[1:], 2):
        yield _record(
            [
                ("WARC-Type", "continuation"),
                ("WARC-Record-ID", record_id(page_id, f"{digest}|{number}")),
                *common,
                ("WARC-Segment-Origin-ID", own),
                ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", len(block) if number == len(cuts) else None),
            ],
            block[at : at + segment_bytes],
        )


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of a file."""
    at = 0
    while at < len(content):
        if not content.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        end = content.index(BREAK, at)
        head = content[at:end].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head)}
        start = end + len(BREAK)
        stop = start + int(fields["content-length"])
        if content[stop : stop + len(BREAK)] != BREAK:
            raise ValueError(f"{fields.get('warc-record-id')}: the block does not end where it should")
        yield fields, content[start:stop]
        at = stop + len(BREAK)


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_revisit: int = 100,
    segment_bytes: int = 32 << 10,
    chunk_bytes: int = 8 << 10,
    records_per_file: int = 2000,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one record per page to `path`. Of equal payloads of at least
    `least_revisit` bytes the one with the smallest id is a response and the
    others revisit it; shorter ones are all responses."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    firsts = staged(
        rows.where(F.octet_length("payload") >= least_revisit)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "first-copies",
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(c) for c in range(batch.num_columns)), strict=True):
                page_id, url, payload, digest, first_id = (x.as_py() for x in row)
                for record in page_records(
                    page_id, url, payload, digest, first_id, segment_bytes, chunk_bytes, date
                ):
                    out.append(record)
                    size += len(record)
                if size >= _FLUSH:
                    yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})
                    out, size = [], 0
            yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    (
        rows.join(firsts, "digest", "left")
        .select("id", "url", "payload", "digest", "first_id")
        .mapInArrow(records, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", BREAK.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


_PARSED = (
    "record_id string, record_type string, page_id long, url string, refers_record string, declared string, "
    "origin string, segment int, total long, body binary"
)
_PARSED_ARROW = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("refers_record", pa.string()),
        ("declared", pa.string()),
        ("origin", pa.string()),
        ("segment", pa.int32()),
        ("total", pa.int64()),
        ("body", pa.binary()),
    ]
)


def inflated(raw: bytes) -> bytes:
    """All gzip members of a file, joined; zero bytes may stand after a member."""
    view, at, out = memoryview(raw), 0, []
    while at < len(raw):
        if not raw[at]:
            at += 1
            continue
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(raw):
                raise ValueError("a gzip member is cut short")
            piece = view[at : at + _PIECE]
            out.append(member.decompress(piece))
            at += len(piece) - len(member.unused_data)
    return b"".join(out)


def _whole(value: str | None) -> int | None:
    return None if value is None else int(value)


def _parsed(cut: bool):
    """Parser of files into records: those that were cut, with their raw
    segment, or the whole ones, with their payload."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for content in batch.column(0):
                raw = content.as_py()
                if raw[:2] == b"\x1f\x8b":
                    raw = inflated(raw)
                for fields, block in parse_records(raw):
                    number = _whole(fields.get("warc-segment-number"))
                    if (number is not None) != cut:
                        continue
                    kind, own = fields["warc-type"], fields["warc-record-id"]
                    # a revisit's block is a head without the body it stands for
                    body = block if cut else b"" if kind == "revisit" else payload_of(block)
                    out.append(
                        (
                            own,
                            kind,
                            _whole(fields.get("x-page-id")),
                            fields.get("warc-target-uri"),
                            fields.get("warc-refers-to"),
                            fields.get("warc-payload-digest"),
                            fields.get("warc-segment-origin-id", own),
                            number,
                            _whole(fields.get("warc-segment-total-length")),
                            body,
                        )
                    )
                    size += len(body)
                    if size >= _FLUSH:
                        yield _as_batch(out)
                        out, size = [], 0
            yield _as_batch(out)

    return parse


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in _PARSED_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _PARSED_ARROW, strict=True)], schema=_PARSED_ARROW
    )


def reassembled(segments: list[tuple[int, int | None, bytes]], origin: str) -> bytes:
    """The block of a record that was cut, from (number, total, bytes) in any
    order; repeated segments count once."""
    ordered = sorted({number: (total, body) for number, total, body in segments}.items())
    block = b"".join(body for _, (_, body) in ordered)
    if [number for number, _ in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError(f"{origin}: a segment is missing")
    if ordered[-1][1][0] != len(block):
        raise ValueError(f"{origin}: {len(block)} bytes, {ordered[-1][1][0]} declared")
    return block


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            segments = [(s["segment"], s["total"], s["body"]) for s in row["segments"]]
            body = payload_of(reassembled(segments, row["origin"]))
            found = (row["origin"], "response", row["page_id"], row["url"], None, row["declared"], row["origin"], None, None, body)
            yield _as_batch([found] * row["copies"])


def read_archive(spark: SparkSession, path: str, names: str = "part-*") -> DataFrame:
    """One row per record: record_id, record_type (response or revisit),
    page_id, url, refers_record, declared (digest), payload (binary; empty for
    revisits, whose payload the referred record holds), of the files under `path`
    whose names match the glob `names`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("content")
    whole = files.mapInArrow(_parsed(cut=False), _PARSED)
    first = F.col("segment") == 1
    cut = (
        files.mapInArrow(_parsed(cut=True), _PARSED)
        .groupBy("origin")
        .agg(
            F.max(F.when(first, F.col("page_id"))).alias("page_id"),
            F.max(F.when(first, F.col("url"))).alias("url"),
            F.max(F.when(first, F.col("declared"))).alias("declared"),
            F.count(F.when(first, True)).alias("copies"),
            F.collect_list(F.struct("segment", "total", "body")).alias("segments"),
        )
        .mapInArrow(_joined, _PARSED)
    )
    return whole.unionByName(cut).select(
        "record_id", "record_type", "page_id", "url", "refers_record", "declared", F.col("body").alias("payload")
    )


def page_digests(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each
    record; a revisit's payload is that of the response it refers to."""
    found = staged(
        records.select(
            "record_id",
            "record_type",
            "page_id",
            "refers_record",
            F.octet_length("payload").cast("long").alias("payload_bytes"),
            F.sha2("payload", 256).alias("payload_digest"),
        ),
        "archive-records",
    )
    responses = found.where("record_type = 'response'")
    targets = staged(
        responses.groupBy(F.col("record_id").alias("refers_record")).agg(
            F.min("page_id").alias("refers_to"),
            F.min("payload_bytes").alias("payload_bytes"),
            F.min("payload_digest").alias("payload_digest"),
        ),
        "archive-responses",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = (
        found.where("record_type = 'revisit'")
        .drop("payload_bytes", "payload_digest")
        .join(targets, "refers_record", "left")
    )
    return (
        responses.withColumn("refers_to", F.lit(None).cast("long"))
        .select(columns)
        .unionByName(revisits.select(columns))
    )
