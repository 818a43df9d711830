import base64
import hashlib
import io
import struct

import pyarrow as pa

from replylane.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_archives_read_back(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i} é</p>" * (i % 7 + 1), 9) for i in range(60)]
    rows += [(100 + i, "http://h/same", "<p>same</p>", 1) for i in range(40)]
    rows += [(200, None, None, 1), (201, "a b\nc", "", 1), (None, "http://x", "<p>same</p>", 1),
             (139, "http://h/same", "<p>same</p>", 1), (300, "u", "x" * 3_000_000, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest int")
    got = warc.read_archives(warc.write_archives(df)).collect()
    assert len(got) == len(rows)
    best = {}
    for page, _, html, _ in rows:
        best[digest(html)] = max(best.get(digest(html), -1), -1 if page is None else page)
    want = sorted((str(p), len((h or "").encode()), digest(h)) for p, _, h, _ in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in got) == want
    for r in got:
        if r.record_type == "response":
            assert r.refers_to is None and r.page_id == best[r.payload_digest]
        else:
            assert r.refers_to == best[r.payload_digest]
    assert len([r for r in got if r.record_type == "response"]) == len(best)


def test_short_payloads_can_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    got = {r.page_id: r.record_type for r in warc.read_archives(warc.write_archives(df, min_bytes=3)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_layout_of_an_archive():
    class Kept(io.BytesIO):
        def close(self):
            pass

    def record(i):
        row = {"page_id": i, "tag": i, "url": f"http://h/{i}", "refers_to": None, "refers_tag": None}
        return warc.make_record(row, f"<html><body>common head and foot {i * 7919}</body></html>".encode() * 3)

    sink = Kept()
    writer = warc.ArchiveWriter(sink)
    for i in range(3000):
        writer.add(record(i))
    writer.close()
    data = sink.getvalue()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and data[8:12] == struct.pack("<I", 0xEC30A437)
    import zstandard
    one = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(data[8:8 + size]))
    assert one.decompressobj().decompress(data[8 + size:]) == record(0)
    assert [f["Page-ID"] for f, _ in warc.read_records(io.BytesIO(data))] == [str(i) for i in range(3000)]
    few = Kept()
    writer = warc.ArchiveWriter(few)
    writer.add(record(1))
    writer.close()
    assert [b for _, b in warc.read_records(io.BytesIO(few.getvalue()))]


def test_long_records_leave_no_archive_without_dictionary():
    import random

    class Kept(io.BytesIO):
        def close(self):
            pass

    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(3000)]

    def page(size):
        return " ".join(rng.choice(words) for _ in range(size // 7)).encode()

    small = [page(900) for _ in range(1500)]
    for pages in (
        [page(1_500_000), *small],
        [small[0], page(1_100_000), *small],
        [page(200_000) for _ in range(12)],
        [page(200_000) for _ in range(3)],
        [page(9_000_000)],
        [b"x" * 1_200_000, *small],
    ):
        sink = Kept()
        writer = warc.ArchiveWriter(sink)
        for i, body in enumerate(pages):
            writer.add(warc.make_record(
                {"page_id": i, "tag": i, "url": f"http://h/{i}", "refers_to": None, "refers_tag": None}, body))
        writer.close()
        data = sink.getvalue()
        assert struct.unpack("<I", data[:4])[0] == 0x184D2A5D, len(pages)
        got = list(warc.read_records(io.BytesIO(data)))
        assert [f["Page-ID"] for f, _ in got] == [str(i) for i in range(len(pages))]
        assert all(b.endswith(p) for (_, b), p in zip(got, pages))


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(df)).count() == 0
