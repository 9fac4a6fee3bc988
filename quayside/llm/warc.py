"""Web pages as WARC archives, each compressed with a dictionary of its own.

An archive holds the records of up to ``ARCHIVE_BYTES`` of payload.  A Zstandard dictionary
is built from all of them and embedded at the head of the file in a skippable frame; then
each record is a frame of its own, so any record can be read alone.  Of records with equal
payloads of at least ``REVISIT_BYTES`` only the one with the smallest page_id is a response;
the others revisit it and carry their HTTP header, but no payload.

Every attempt of a task writes archives under new names and returns these; only archives
that a successful attempt has named belong to the collection.  So a lost executor costs a
repetition, and leaves files that nobody reads.

A null page counts as empty.  Payloads shorter than ``REVISIT_BYTES`` and pages without a
page_id are always responses; rows that share the smallest page_id of equal payloads are
all responses.  A null url leaves its header out.  Only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.batches import bounded
from quayside.session import cut_lineage
from quayside.sources.files import open_path

ARCHIVE_BYTES = 16 << 20
REVISIT_BYTES = 100
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:x-page:"
COLLECTION = "archive string, records bigint, archive_bytes bigint"
RECORDS = "archive string, damage string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


class Record(NamedTuple):
    headers: dict[str, str]
    block: bytes


def record_bytes(headers: dict[str, str | None], block: bytes) -> bytes:
    lines = ["WARC/1.1"] + [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    size = int(headers.get("Content-Length", -1))
    if lines[0] != "WARC/1.1" or size < 0 or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return Record(headers, rest[:size])


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    revisit = refers_to is not None
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{_ID}{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        # No header may hold a line break; everything outside ASCII is escaped as well.
        "WARC-Target-URI": None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": f"<{_ID}{refers_to}>" if revisit else None,
        "Content-Type": "application/http; msgtype=response",
    }
    return record_bytes(headers, http.encode() + (b"" if revisit else payload))


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES):
    """A dictionary trained on all the records, or their end itself if they are too few."""
    import zstandard

    total = sum(map(len, records))
    try:
        return zstandard.train_dictionary(min(size, max(256, total // 8)), records, k=1024, d=8)
    except zstandard.ZstdError:
        tail = b"".join(records[-64:])[-size:]
        return zstandard.ZstdCompressionDict(tail, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes], level: int = LEVEL) -> bytes:
    import zstandard

    info = record_bytes(
        {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE},
        b"format: WARC File Format 1.1\r\n",
    )
    dictionary = build_dictionary(records)
    plain = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary)
    frames = [struct.pack("<II", DICTIONARY_MAGIC, len(plain)), plain]
    return b"".join(frames + [compressor.compress(r) for r in [info, *records]])


def read_archive(data: bytes) -> Iterator[Record]:
    """All records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary")
    plain = data[8 : 8 + size]
    if plain[:4] == FRAME_MAGIC:  # other writers may compress it
        plain = zstandard.ZstdDecompressor().decompress(plain)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(plain))
    rest = memoryview(data)[8 + size :]
    while len(rest):
        frame = decompressor.decompressobj()
        content = frame.decompress(rest)
        yield parse_record(content)
        rest = rest[len(rest) - len(frame.unused_data) :] if frame.unused_data else rest[len(rest) :]


def _put(uri: str, data: bytes) -> None:
    filesystem, path = open_path(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(path, compression=None) as stream:
        stream.write(data)


def write_archives(pages: DataFrame, folder: str, archive_size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives into the folder; returns archive, records, archive_bytes of each."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = bounded(pages).select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html")
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    repeated = (
        rows.where(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # Only payloads that occur more than once: broadcast if measured small, else a join
    # whose hot payloads are split.
    joined = rows.join(cut_lineage(repeated), "digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") != F.col("first"), F.col("first"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        size = 0

        def flush():
            nonlocal records, size
            name = f"pages-{uuid.uuid4().hex}.warc.zst"
            data = archive_bytes(records)
            _put(f"{folder}/{name}", data)
            row = {"archive": name, "records": len(records), "archive_bytes": len(data)}
            records, size = [], 0
            yield pa.RecordBatch.from_pylist([row])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers_to")]
            for page_id, url, digest, refers_to, text in zip(*columns, batch.column("html").cast(pa.binary())):
                records.append(page_record(page_id, url, text.as_py(), digest, refers_to))
                size += len(records[-1])
                if size >= archive_size:
                    yield from flush()
        if records:
            yield from flush()

    return cut_lineage(joined.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, COLLECTION))


def _page_rows(data: bytes) -> Iterator[dict]:
    def number(uri: str | None) -> int | None:
        text = (uri or "").strip("<>").removeprefix(_ID)
        return int(text) if text else None

    for record in read_archive(data):
        kind = record.headers["WARC-Type"]
        if kind == "warcinfo":
            continue
        http, _, payload = record.block.partition(b"\r\n\r\n")
        length = re.search(rb"Content-Length: (\d+)", http)
        size = int(length[1]) if length else -1
        digest = record.headers["WARC-Payload-Digest"].removeprefix("sha256:")
        if size < 0 or kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
            raise ValueError("a record does not hold the payload it names")
        yield {
            "page_id": number(record.headers["WARC-Record-ID"]),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": number(record.headers.get("WARC-Refers-To")),
        }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            archive = path.rsplit("/", 1)[-1]
            try:
                found = [{"archive": archive, **row} for row in _page_rows(content.as_py())]
            except (ValueError, KeyError, struct.error, zstandard.ZstdError) as problem:
                # The file may be what a lost task left half written.
                found = [{"archive": archive, "damage": str(problem)}]
            yield pa.RecordBatch.from_pylist(found, _RECORDS)


_RECORDS = pa.schema(
    [
        ("archive", pa.string()),
        ("damage", pa.string()),
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def read_archives(spark: SparkSession, folder: str, collection: DataFrame) -> DataFrame:
    """One row for each page record of the archives that the collection names.

    Payloads of responses are read whole and their digest is checked; a revisit's size is
    that of its HTTP header, its digest that of its record.  A damaged archive stops the
    job if the collection names it; other files in the folder do not matter.
    """
    files = (
        spark.read.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.warc.zst")
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    records = files.select("path", "content").mapInArrow(_read, RECORDS)
    named = records.join(collection.select("archive", "records"), "archive")
    # The number of records is looked at so that the test comes after the join.
    stop = F.raise_error(F.concat("archive", F.lit(": "), "damage")).cast("boolean")
    sound = F.when(F.col("damage").isNotNull() & (F.col("records") >= 0), stop).otherwise(F.lit(True))
    return named.where(sound).drop("damage", "records")
