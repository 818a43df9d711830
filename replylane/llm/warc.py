"""Web archives of individually compressed records behind an embedded Zstandard dictionary.

Each task writes archives of bounded size. An archive's dictionary is built from its own first
records and stands in a leading skippable frame; every record is a frame of its own, so that
one can be read by offset. Archives are listed by the task attempt that finished, so what a
lost attempt left behind is never read.

Defined results: a null html is an empty payload; a null url leaves the target out; rows with
one page id are records of their own, and of equal rows with the largest id one is the
response; a null page id counts as the smallest; an archive of fewer than ``SAMPLES`` records
and under ``SAMPLES * PIECE_BYTES`` bytes, or one whose first ``HELD_BYTES`` give the trainer
nothing to build from, has no dictionary; an empty table writes no archive; other columns are ignored. The pages have to
be a table that reads the same way twice.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from replylane.llm import files
from replylane.staging import new_path, stage

# Fixed values of the archive format.
DICTIONARY_FRAME = 0x184D2A5D
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 32 << 10
SAMPLE_BYTES = 1 << 20
#: what a dictionary needs at least, the shortest pieces that long records are cut into for
#: training, and how many bytes of records wait at most
SAMPLES = 8
PIECE_BYTES = 4 << 10
HELD_BYTES = 8 << 20
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
SALTS = 16
DATE = "2024-01-01T00:00:00Z"


def record_id(page_id: int | None, tag: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page_id}/{tag}'.encode()).digest()[:16])}>"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(row: dict, payload: bytes) -> bytes:
    """One record; a revisit carries the HTTP head of its page but no payload."""
    revisit = row["refers_tag"] is not None
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], row["tag"])),
        ("WARC-Date", DATE),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", "".join(row["url"].split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"))
    if revisit:
        fields += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_id(row["refers_to"], row["refers_tag"])),
        ]
        if row["refers_to"] is not None:
            fields.append(("Page-Refers-To", str(row["refers_to"])))
    if row["page_id"] is not None:
        fields.append(("Page-ID", str(row["page_id"])))
    fields += [
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + lines + b"\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from records; None where there is too little in them.

    Long records are cut, so that a few of them are samples enough, and of each at most an
    equal share of ``SAMPLE_BYTES`` is taken, spread over the record.
    """
    share = SAMPLE_BYTES // SAMPLES
    piece = min(share, max(PIECE_BYTES, sum(map(len, samples)) // SAMPLES))
    each = max(1, SAMPLE_BYTES // min(len(samples), SAMPLES) // piece) if samples else 1
    cut = []
    for record in samples:
        pieces = range(0, len(record), piece)
        cut += [record[a : a + piece] for a in pieces[:: -(-len(pieces) // each)]]
    samples = cut
    if len(samples) < SAMPLES:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Holds back the first records until the dictionary can be built from them."""

    def __init__(self, sink: BinaryIO):
        self.sink = sink
        self.waiting: list[bytes] | None = []
        self.size = self.records = 0
        self.ready = SAMPLE_BYTES

    def add(self, record: bytes) -> None:
        self.size += len(record)
        self.records += 1
        if self.waiting is None:
            self.sink.write(self.compressor.compress(record))
            return
        self.waiting.append(record)
        if self.size >= HELD_BYTES or (self.size >= self.ready and self.records >= SAMPLES):
            self._begin(self.size >= HELD_BYTES)

    def _begin(self, last: bool = True) -> None:
        dictionary = build_dictionary(self.waiting)
        if dictionary is None and not last:
            # nothing to learn from yet, such as pages of one letter: wait for as much again
            self.ready = 2 * self.size
            return
        if dictionary is not None:
            raw = dictionary.as_bytes()
            self.sink.write(struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw)
            self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        else:
            self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        for record in self.waiting:
            self.sink.write(self.compressor.compress(record))
        self.waiting = None

    def close(self) -> None:
        if self.waiting is not None:
            self._begin()
        self.sink.close()


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an archive."""
    lead = source.read(8)
    dictionary = None
    if len(lead) == 8 and struct.unpack("<II", lead)[0] == DICTIONARY_FRAME:
        raw = source.read(struct.unpack("<II", lead)[1])
        if raw[:4] == struct.pack("<I", ZSTD_FRAME):  # the format allows a compressed one
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
    else:
        source = io.BytesIO(lead + source.read())
    stream = io.BufferedReader(
        zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True),
        1 << 16,
    )
    while version := stream.readline():
        if version != VERSION:
            raise ValueError(f"not a record: {version[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield fields, block


def with_verdicts(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, tag, and refers_to/refers_tag where an equal payload is kept.

    Payloads of ``min_bytes`` and more are compared by digest. Only digests that occur more
    than once take part in the join, whose hot keys are salted. ``tag`` is a row's place in
    the scan, which is the same in both reads of the table.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("tag"),
    ).withColumn("digest", F.unhex(F.sha1(F.col("html").cast("binary"))))
    kept = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "tag")).alias("kept"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "kept")
    )
    kept = kept.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("tag"), F.lit(SALTS)).cast("int"))
    refers = F.col("kept.tag") != F.col("tag")
    return salted.join(kept, ["digest", "salt"], "left").select(
        "page_id", "url", "html", "tag",
        F.when(refers, F.col("kept.page_id")).alias("refers_to"),
        F.when(refers, F.col("kept.tag")).alias("refers_tag"),
    )


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write one record per row; returns the list (path, records, bytes) of the archives."""
    folder = folder or new_path(pages.sparkSession, "warc")

    def run(batches):
        filesystem, root = files.at(folder)
        filesystem.create_dir(root, recursive=True)
        stem, writer, done = files.attempt_stem(), None, []

        def finish():
            writer.close()
            done.append((name, writer.records, writer.size))

        for batch in batches:
            html = batch.column("html").cast(pa.large_binary())
            slim = batch.drop_columns(["html"])
            for i, row in enumerate(slim.to_pylist()):
                if writer is None:
                    name = f"{stem}-{len(done):04d}.warc.zst"
                    writer = ArchiveWriter(filesystem.open_output_stream(f"{root}/{name}"))
                writer.add(make_record(row, html[i].as_py()))
                if writer.size >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        names = [f"{folder}/{n}" for n, _, _ in done]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([r for _, r, _ in done], pa.int64()),
             pa.array([s for _, _, s in done], pa.int64())],
            ["path", "records", "bytes"],
        )

    listing = with_verdicts(pages, min_bytes).mapInArrow(
        run, "path string, records long, bytes long"
    )
    return stage(listing, "warc-list")


def read_archives(listing: DataFrame) -> DataFrame:
    """One row per record of the listed archives; a response's digest is taken anew."""
    columns = {
        "page_id": pa.int64(), "record_type": pa.string(), "url": pa.string(),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(),
    }

    def rows(path: str):
        filesystem, name = files.at(path)
        with filesystem.open_input_stream(name) as source:
            for fields, block in read_records(source):
                head, _, payload = block.partition(b"\r\n\r\n")
                length = int(head.rpartition(b"Content-Length: ")[2])
                kind = fields["WARC-Type"]
                if kind == "response":
                    if len(payload) != length:
                        raise ValueError(f"a payload of {path} is cut off")
                    digest = base32_sha1(payload)
                else:
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                page, refers = fields.get("Page-ID"), fields.get("Page-Refers-To")
                yield (None if page is None else int(page), kind, fields.get("WARC-Target-URI"),
                       length, digest, None if refers is None else int(refers))

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held = []
                for row in rows(path):
                    held.append(row)
                    if len(held) == 4096:
                        yield pack(held)
                        held = []
                yield pack(held)

    def pack(held):
        values = list(zip(*held)) if held else [[]] * len(columns)
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(values, columns.values())], list(columns)
        )

    count = max(1, listing.count())
    return listing.select("path").repartition(count).mapInArrow(
        run, "page_id long, record_type string, url string, payload_bytes long, "
        "payload_digest string, refers_to long"
    )
