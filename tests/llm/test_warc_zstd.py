import hashlib
import struct

import pytest
import zstandard

from salesmart.llm import warc_zstd
from salesmart.session import settle

PAGE = "<html><body><p>A page about something, with words that other pages have too: number {}.</p>" + "<p>filler</p>" * 20


def round_trip(spark, rows, archive_bytes=4 << 20):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return warc_zstd.read_archives(settle(warc_zstd.write_archives(warc_zstd.mark_revisits(pages), archive_bytes))).collect()


def brute(rows):
    """(page_id, bytes, digest, type, refers_to), sorted."""
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, g in rows if (g or "").encode() == data and j is not None] if len(data) >= 100 else []
        refers = min(same) if same and (i is None or i > min(same)) else None
        out.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "response" if refers is None else "revisit", str(refers)))
    return sorted(out)


@pytest.mark.parametrize("archive_bytes", [1, 3_000, 4 << 20])
def test_round_trip(spark, archive_bytes):
    rows = [(i, f"http://x/{i}", PAGE.format(i % 40)) for i in range(100)]
    rows += [(200, "u", None), (201, None, ""), (202, "a b\r\nX: y", "short"), (203, "u", "short"), (None, "u", PAGE.format(1)),
             (7, "again", PAGE.format(7)), (5, "x", "other"), (300, "u", "é" * 300_000), (301, "u", "a\r\n\r\nb" * 50)]
    got = round_trip(spark, rows, archive_bytes)
    assert all(r.error is None for r in got)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, str(r.refers_to)) for r in got) == brute(rows)
    payloads = {i: (h or "").encode() for i, _, h in rows if i != 7 and i != 5}
    assert all(r.payload == payloads[r.page_id] for r in got if r.record_type == "response" and r.page_id in payloads)
    assert {r.target_uri for r in got if r.page_id == 202} == {"a%20b%0D%0AX:%20y"}


def test_no_rows(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, payload int, first int")
    assert warc_zstd.read_archives(warc_zstd.write_archives(warc_zstd.mark_revisits(pages))).collect() == []


def records(n):
    return [warc_zstd.record(i, "u", f"payload {i}".encode(), 9 + (i > 9), hashlib.sha256(f"payload {i}".encode()).hexdigest(), None, "2024-01-01T00:00:00Z")
            for i in range(n)]


def test_layout_is_dictionary_then_a_frame_a_record():
    content = warc_zstd.archive(records(300))
    magic, size = struct.unpack_from("<II", content)
    assert magic == 0x184D2A5D
    held = zstandard.ZstdDecompressor().decompress(content[8:8 + size])
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    found = list(warc_zstd.frames(content))
    assert [d for _, d, _ in found] == records(300)
    ends = [at for at, *_ in found[1:]] + [len(content)]
    assert all(unpack.decompress(content[at:end]) == data for (at, data, _), end in zip(found, ends))


def test_archives_of_others_read_as_binary_files(spark, tmp_path):
    raw = zstandard.train_dictionary(4096, records(300), k=64, d=8)
    plain = zstandard.ZstdCompressor(write_content_size=False, write_checksum=False, dict_data=raw)
    body = b"".join(plain.compress(r) for r in records(30))
    frame = struct.pack("<II", 0x184D2A5D, len(raw.as_bytes())) + raw.as_bytes()  # a dictionary that is not compressed
    (tmp_path / "a.warc.zst").write_bytes(frame + struct.pack("<II", 0x184D2A50, 3) + b"abc" + body)
    (tmp_path / "b.warc.zst").write_bytes(b"".join(zstandard.compress(r) for r in records(5)))
    (tmp_path / "c.warc.zst").write_bytes(b"")
    got = warc_zstd.read_archives(spark.read.format("binaryFile").load(str(tmp_path))).collect()
    assert len(got) == 35 and all(r.error is None for r in got)


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1"), lambda r: r[:-2], lambda r: r.replace(b"payload 3", b"payload 4"),
    lambda r: r.replace(b"WARC-Date", b"X-Date"), lambda r: r.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1),
])
def test_invalid_records_are_named_and_cost_no_other(spark, spoil):
    rows = records(8)
    rows[3] = spoil(rows[3])
    archives = spark.createDataFrame([("a", bytearray(warc_zstd.archive(rows)))], "path string, content binary")
    got = warc_zstd.read_archives(archives).collect()
    assert [bool(r.error) for r in got] == [i == 3 for i in range(8)]


def test_damaged_and_cut_off_frames(spark):
    content = bytearray(warc_zstd.archive(records(20)))
    at = [a for a, *_ in warc_zstd.frames(bytes(content))]
    content[at[5] + 14] ^= 0xFF
    got = list(warc_zstd.frames(bytes(content[:-3])))
    assert [i for i, x in enumerate(got) if x[2]] == [5, 19] and len(got) == 20


def test_hot_payload(spark):
    pages = spark.range(0, 3000, 1, 6).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id % 3 = 0 THEN repeat('same', 50) ELSE string(id) END AS html")
    got = warc_zstd.read_archives(warc_zstd.write_archives(warc_zstd.mark_revisits(pages))).groupBy("record_type", "refers_to").count().collect()
    assert {(r.record_type, r.refers_to, r["count"]) for r in got} == {("response", None, 2001), ("revisit", 0, 999)}
