"""WARC archives with a Zstandard dictionary, written and read by Spark.

An archive is a sequence of Zstandard frames: first a skippable frame (magic 0x184D2A5D) that holds the
dictionary, then one frame per record, each compressed on its own with that dictionary, so a record can be
cut out and read alone. Empty skippable frames stand between records; they are the line separator of
Spark's text writer, through which the archives reach any file system Spark can write, under Spark's
commit protocol: a lost executor's half-written archives never become visible.

Of records with equal payloads of at least ``least_bytes``, that with the smallest page id is a response;
the others are revisit records that refer to it and carry no payload. Smaller payloads are all responses.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.frames import utf8
from tallyweave.session import scratch_path, staged

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = b"P*M\x18\x00\x00\x00\x00"  # an empty skippable frame, magic 0x184D2A50
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PLAN_SCHEMA = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, refers_to long"
READ_SCHEMA = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, "
    "refers_to long, intact boolean"
)
_HEADER = re.compile(rb"^([^:\r\n]+):[ ]?([^\r\n]*)\r?$", re.M)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _safe(value: str) -> str:
    """Header value without controls, blanks and percent signs of its own; undone by ``_plain``."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def _plain(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def build_record(
    page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str
) -> bytes:
    """One WARC/1.1 record: an HTTP response with its payload, or a revisit with the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_safe(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
        lines.append(f"X-Refers-To-Page-Id: {refers_to}")
    body = http if revisit else http + payload
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of one record; ``intact`` says that lengths and digest agree with what was read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.decode().lower(): v.decode() for k, v in _HEADER.findall(head)}
    body = rest[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(_HEADER.findall(http))[b"Content-Length"])
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    whole = rest[len(body) :] == b"\r\n\r\n" and len(body) == int(fields["content-length"])
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("x-page-id"),
        "url": _plain(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "record_type": fields["warc-type"],
        "payload": None if revisit else payload,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": number("x-refers-to-page-id"),
        "intact": whole and (revisit or (len(payload) == size and hashlib.sha256(payload).hexdigest() == digest)),
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def _frame_end(view: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, by its block headers; nothing is unpacked or copied."""
    head = view[at : at + 18]  # the longest header
    end, last = at + zstandard.frame_header_size(head), 0
    while not last and end + 3 <= len(view):
        header = int.from_bytes(view[end : end + 3], "little")
        last, kind, size = header & 1, header >> 1 & 3, header >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * zstandard.get_frame_parameters(head).has_checksum
    if not last or end > len(view):
        raise ValueError(f"archive ends within the record at byte {at}")
    return end


def read_archive(content: bytes) -> Iterator[bytes]:
    """Records of one archive, in order; each frame is cut out first, so the work grows with the archive's length."""
    at, reader = 0, zstandard.ZstdDecompressor()
    view = memoryview(content)
    while at < len(content):
        (magic,) = struct.unpack_from("<I", content, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            (size,) = struct.unpack_from("<I", content, at + 4)
            if magic == DICTIONARY_MAGIC and at == 0:
                held = zstandard.ZstdCompressionDict(content[at + 8 : at + 8 + size])
                reader = zstandard.ZstdDecompressor(dict_data=held)
            at += 8 + size
            continue
        end, one = _frame_end(view, at), reader.decompressobj()
        record = one.decompress(view[at:end])
        if not one.eof:
            raise ValueError(f"archive ends within the record at byte {at}")
        yield record
        at = end


def plan_records(
    pages: DataFrame, least_bytes: int = 100, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Rows to write: page_id, url, payload (null on a revisit), payload_bytes, payload_digest, refers_to.

    The leaders are found by an aggregate per digest and only digests, sizes and ids are shuffled for it;
    payloads are not. Rows without an id lead only if no row of their group has one. Rows that share the
    smallest id of their group are all responses.
    """
    body = utf8(F.col(f"`{html}`"))
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha2(body, 256).alias("payload_digest"),
    )
    leaders = staged(  # as a table its size is known, so that Spark broadcasts it if it is small
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("leader"), F.count("*").alias("n"))
        .where("n > 1 and leader is not null")
        .select("payload_digest", "leader"),
        "warc-leaders",
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("leader")), F.lit(None)).otherwise(F.col("leader"))
    return (
        rows.join(leaders, "payload_digest", "left")
        .withColumn("refers_to", refers)
        .select(
            "page_id",
            "url",
            F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"),
            "payload_bytes",
            "payload_digest",
            "refers_to",
        )
    )


def train_dictionary(records: DataFrame, size: int = 64 << 10, samples: int = 512, longest: int = 64 << 10) -> bytes:
    """Dictionary of ``size`` bytes from at most ``samples`` payloads of 100 to ``longest`` bytes, chosen by hash.

    ``records`` are those of :func:`plan_records`. Tasks pass on only the payloads below a bound of the hash
    that lets about twice ``samples`` through, so at most a few dozen MB travel, however many pages there
    are. Without enough material the result is empty and archives are written without a dictionary.
    """
    n = records.count()
    lot = F.shiftrightunsigned(F.xxhash64("payload_digest"), 11).cast("double") / F.lit(float(1 << 53))
    chosen = (
        records.where(F.col("refers_to").isNull() & F.col("payload_bytes").between(100, longest))
        .where(lot < min(1.0, 2 * samples / max(1, n)))
        .select("payload_digest", "payload")
        .dropDuplicates(["payload_digest"])
        .orderBy(F.xxhash64("payload_digest"))
        .limit(samples)
        .collect()
    )
    texts = [bytes(r["payload"]) for r in chosen]
    if sum(map(len, texts)) < 2 * size or len(texts) < 8:
        return b""
    try:
        return zstandard.train_dictionary(size, texts, level=3).as_bytes()
    except zstandard.ZstdError:  # the trainer finds nothing that repeats
        return b""


def write_archives(
    records: DataFrame, path: str, dictionary: bytes = b"", level: int = 3, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """One archive per non-empty partition of ``records`` (columns as from :func:`plan_records`) below ``path``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if dictionary:
            packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        else:
            packer = zstandard.ZstdCompressor(level=level)
        lead = [dictionary_frame(dictionary)] if dictionary else []
        for batch in batches:
            names = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
            columns = [batch.column(c).to_pylist() for c in names]
            frames, lead = lead, []
            for page_id, url, payload, size, digest, refers_to in zip(*columns, strict=True):
                record = build_record(page_id, url, payload or b"", size, digest, refers_to, date)
                frames.append(packer.compress(record))
            if frames:
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    frames = records.mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR.decode()).text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``; a task holds one archive at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                for record in read_archive(content.as_py()):
                    rows.append(parse_record(record))
                    held += len(record)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    arrow = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("refers_to", pa.int64()),
            ("intact", pa.bool_()),
        ]
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, READ_SCHEMA)


def archive_pages(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` to archives and read them back; null html is an empty payload, null urls are left out.

    There is an archive per partition, so Spark's file split size (or a ``repartition`` before) bounds what
    a task holds on reading. Other input columns are not read. An empty table makes no records and no rows.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    records = plan_records(pages, **options)
    write_archives(records, path, train_dictionary(records))
    return read_archives(spark, path)
