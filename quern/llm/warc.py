"""A WARC writer and reader with one Zstandard dictionary per archive.

Each archive starts with a skippable frame that holds a dictionary built from the records of that
archive; every record is a frame of its own, compressed with it, so a reader can start at any
record. Payloads that several pages share are stored once, in the record of the largest page id;
the other pages get revisit records that refer to it. Smaller payloads than ``revisit_from`` bytes
are always stored.

Archives are written by the tasks, each attempt under names of its own; the manifest, which is
committed with the job, names those of the attempts that count, so lost, repeated or speculative
attempts leave nothing that is read. The folder can be any that ``pyarrow.fs`` can write to.

Results in odd cases: a null payload is an empty one; a null URL is written as ``about:blank``;
control characters in a URL are percent-encoded; a null page id is always a response and comes
back as null; repeated rows of the largest page id are all responses. Empty tables give no
archive. Columns other than the three named are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import materialize, shared_path

SKIPPABLE = 0x184D2A5D
DICTIONARY_BYTES = 65_536
#: A dictionary is built from at most so many bytes of an archive's records, taken evenly.
SAMPLE_BYTES = 4_000_000
#: An archive is closed when its records have so many bytes.
ARCHIVE_BYTES = 24_000_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TAG = 0x1D5


def record_id(page_id: int | None, salt: bytes = b"") -> str:
    """A URN that holds the page id, so it can be read back from a reference to the record."""
    if page_id is None:
        return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(salt).digest()[:16], version=5)}>"
    i = page_id & (1 << 64) - 1
    value = (i >> 16) << 80 | 8 << 76 | _TAG << 64 | 2 << 62 | i & 0xFFFF
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(urn: str) -> int | None:
    value = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 76 & 15 != 8:
        return None
    i = value >> 80 << 16 | value & 0xFFFF
    return i - (1 << 64) if i >> 63 else i


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """An uncompressed response record, or a revisit record without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url if url is not None else "about:blank")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, payload + target.encode())}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of a record; the payload's size and digest are the full payload's, for revisits from their headers."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)^content-length: *(\d+)", http, re.M)[1])
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged payload in {fields['warc-record-id']}")
    refers = fields.get("warc-refers-to")
    return {"page_id": page_of(fields["warc-record-id"]), "url": fields["warc-target-uri"], "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": page_of(refers) if refers else None, "payload": payload if kind == "response" else None}


def build_dictionary(records: list[bytes]) -> bytes:
    """A trained dictionary from evenly spaced records, or plain content where there are too few."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    samples = [r[:131_072] for r in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return samples[0][:4096]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def archive_bytes(records: list[bytes], level: int = 3) -> Iterator[bytes]:
    """The frames of an archive."""
    raw = build_dictionary(records)
    yield struct.pack("<II", SKIPPABLE, len(raw)) + raw
    shared = _dictionary(raw)
    shared.precompute_compress(level=level)
    zstd = zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True, write_checksum=True)
    for record in records:
        yield zstd.compress(record)


def archive_records(raw: bytes) -> Iterator[bytes]:
    """The records of an archive, each from a frame of its own."""
    magic, size = struct.unpack_from("<II", raw)
    if magic != SKIPPABLE:
        raise ValueError("the archive doesn't start with a dictionary")
    zstd = zstandard.ZstdDecompressor(dict_data=_dictionary(raw[8 : 8 + size]))
    whole, at = memoryview(raw), 8 + size
    while at < len(whole):
        reader, parts = zstd.decompressobj(), []
        while not reader.eof:  # in steps, as what a frame leaves over is copied
            step = whole[at : at + 16_384]
            if not step:
                raise ValueError("the archive ends within a record")
            parts.append(reader.decompress(step))
            at += len(step)
        at -= len(reader.unused_data)
        yield b"".join(parts)


def arrow_uri(folder: str) -> str:
    """A folder's name as Arrow's file systems know it: Hadoop's ``s3a`` and ``s3n`` are their ``s3``, a bare path is a local file's."""
    return "file://" + folder if folder.startswith("/") else re.sub("^s3[an]://", "s3://", folder)


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0, archive_size: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all pages as archives under ``folder``; one row per archive with its path and number of records.

    The page that keeps a shared payload is found from digests alone; the payloads are shuffled once,
    to meet it. Where a third of the pages share one, the join's splitting of skewed partitions
    spreads them; the side that is split holds pages, the other one row per digest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digest = F.unhex(F.sha1(payload))
    keepers = pages.select("page_id", digest.alias("digest"), F.octet_length(payload).alias("size")).where(F.col("size") >= revisit_from).groupBy("digest").agg(F.max("page_id").alias("keeper"))
    marked = pages.select("page_id", "url", payload.alias("payload"), digest.alias("digest")).join(keepers, "digest", "left")
    rows = marked.select("page_id", "url", "payload", F.when(F.col("page_id") < F.col("keeper"), F.col("keeper")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(arrow_uri(folder))
        task = TaskContext.get()
        store.create_dir(root, recursive=True)
        records: list[bytes] = []
        made, held = [], 0

        def close() -> None:
            nonlocal records, held
            path = f"{root}/part-{task.partitionId():06d}-{len(made):05d}-{task.taskAttemptId()}.warc.zst"
            with store.open_output_stream(path, compression=None) as out:
                for frame in archive_bytes(records):
                    out.write(frame)
            made.append((path, len(records)))
            records, held = [], 0

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                for row in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True):
                    records.append(make_record(*row))
                    held += len(records[-1])
                    if held >= archive_size:
                        close()
        if records:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())], names=["path", "records"])

    return materialize(rows.mapInArrow(write, "path string, records long"), "warc-manifest")


def read_archives(archives: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives that ``write_archives`` listed."""
    fields = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload

    def batched(rows: Iterable[dict]) -> pa.RecordBatch:
        rows = list(rows)
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind) for n, kind in fields.items()], names=list(fields))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(arrow_uri(folder))
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_stream(path, compression=None) as source:
                    raw = source.read()
                rows: list[dict] = []
                for record in archive_records(raw):
                    rows.append(parse_record(record))
                    if len(rows) == 500:
                        yield batched(rows)
                        rows = []
                yield batched(rows)

    count = archives.count()
    return archives.select("path").repartition(max(1, count)).mapInArrow(read, schema)


def round_trip(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Archive all pages in the shared folder and read the archives back, without the payloads."""
    folder = shared_path(spark, "warc")
    return read_archives(write_archives(pages, folder, revisit_from), folder, with_payload=False)
