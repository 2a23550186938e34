"""WARC archives under Zstandard with a shared dictionary: writer and validating reader.

An archive starts with a skippable frame that holds the dictionary, then has one compressed frame a record, so
any record can be decoded on its own. The reader loads the dictionary, finds each frame's end from its
block headers, decodes one frame at a time and validates headers, lengths and payload digests; what fails
comes out as a row with ``error``, so that one bad record costs no other.

Archives are rows (path, content), the shape of Spark's ``binaryFile`` source: archives written by others are
read with it, and ours are kept in a table, which commits whole tasks and needs no file system that executors
open by themselves. A task holds one archive of about ``archive_bytes`` at a time. Payloads that occur again are
written once: the page with the smallest id is the response and others are revisits that point to it. Equal
payloads are found by an aggregation that combines before it shuffles and by a join whose hot keys Spark splits.

Defined results: a null payload is empty; a null id sorts last and refers to the smallest id there is; rows
that repeat the smallest id are all responses; line breaks in a URL are percent-encoded; an empty table gives no
archives, and an archive without a dictionary frame is read as plain Zstandard.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import settle

#: Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

ARCHIVES = "path string, content binary"
RECORDS = (
    "path string, frame_offset bigint, page_id bigint, target_uri string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, error string"
)


def mark_revisits(pages: DataFrame, least_bytes: int = 100, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): what to write, payload null where it is a revisit."""
    content = F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8")
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), content.alias("payload"),
                        F.sha2(content, 256).alias("payload_digest"))
    repeated = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL").select("payload_digest", "first")
    )
    # Settled: its size is then known, and a large one is joined with hot digests split.
    joined = rows.join(settle(repeated, "repeated-payloads"), "payload_digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    return joined.select(
        "page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), "payload_digest", refers.alias("refers_to"))


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit (no payload) has the HTTP header only."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(page_id)),
              ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def archive(records: list[bytes], dictionary_bytes: int = 16 << 10, level: int = 6) -> bytes:
    """The records as frames behind the dictionary that they train; too few records go without one."""
    try:
        trained = zstandard.train_dictionary(dictionary_bytes, records, k=256, d=8)
    except zstandard.ZstdError:
        trained = None
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True)
    parts = []
    if trained is not None:
        held = zstandard.ZstdCompressor(level=level).compress(trained.as_bytes())
        parts += [struct.pack("<II", DICTIONARY_MAGIC, len(held)), held]
    return b"".join(parts + [packer.compress(r) for r in records])


def write_archives(marked: DataFrame, archive_bytes: int = 4 << 20, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Archives (path, content) of what ``mark_revisits`` gives, one at least for each task that has rows."""
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(records: list[bytes]) -> pa.RecordBatch:
            content = archive(records)
            return pa.RecordBatch.from_pydict(
                {"path": [f"{hashlib.sha256(content).hexdigest()[:32]}.warc.zst"], "content": pa.array([content], pa.binary())})

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(n) for n in names]
            for row in range(batch.num_rows):
                held.append(record(*(c[row].as_py() for c in columns), date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield done(held)
                    held, size = [], 0
        if held:
            yield done(held)

    return marked.select(*names).mapInArrow(write, ARCHIVES)


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its header and block headers."""
    if len(data) < at + 5 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError("no frame here")
    flags = data[at + 4]
    single = flags >> 5 & 1
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + ((1 if single else 0), 2, 4, 8)[flags >> 6]
    while True:
        if at + 3 > len(data):
            raise ValueError("cut-off frame")
        head = data[at] | data[at + 1] << 8 | data[at + 2] << 16
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    at += 4 * (flags >> 2 & 1)
    if at > len(data):
        raise ValueError("cut-off frame")
    return at


def frames(content: bytes) -> Iterator[tuple[int, bytes | None, str | None]]:
    """(offset, decoded record or None, error) of each frame after the dictionary."""
    data, at, trained = memoryview(content), 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        held = bytes(data[8:at])
        try:
            if held[:4] == struct.pack("<I", FRAME_MAGIC):
                held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
            trained = zstandard.ZstdCompressionDict(held)
        except zstandard.ZstdError as error:
            yield 0, None, f"dictionary: {error}"
    unpacker = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(data):
        if len(data) >= at + 8 and struct.unpack_from("<I", data, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        try:
            end = frame_end(data, at)
        except ValueError as error:
            yield at, None, str(error)  # without its end nothing behind it can be found
            return
        try:
            yield at, unpacker.decompressobj().decompress(data[at:end]), None
        except zstandard.ZstdError as error:
            yield at, None, str(error)
        at = end


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", name)
    return int(found[1]) if found else None


def parse(data: bytes) -> dict:
    """Fields of a record; ``error`` says what is wrong with it."""
    row = dict.fromkeys(("page_id", "target_uri", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "error"))
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1.") or not gap:
        return row | {"error": "no WARC header"}
    fields = _fields(head)
    row |= {"page_id": _page(fields.get("warc-record-id", "")), "target_uri": fields.get("warc-target-uri"), "record_type": fields.get("warc-type")}
    missing = [k for k in REQUIRED if not fields.get(k)]
    if missing:
        return row | {"error": f"no {', '.join(missing)}"}
    size = int(fields["content-length"]) if fields["content-length"].isdigit() else -1
    if len(rest) != size + 4 or not rest.endswith(b"\r\n\r\n"):
        return row | {"error": f"content length {fields['content-length']}, but {len(rest) - 4} bytes"}
    block = rest[:-4]
    http, gap, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    digest = (fields.get("warc-payload-digest") or "").removeprefix("sha256:")
    if row["record_type"] == "revisit":
        length = _fields(http).get("content-length", "")
        return row | {"payload_bytes": int(length) if length.isdigit() else None, "payload_digest": digest,
                      "refers_to": _page(fields.get("warc-refers-to", "")), "error": None if length.isdigit() else "no payload length"}
    own = hashlib.sha256(payload).hexdigest()
    return row | {"payload": payload, "payload_bytes": len(payload), "payload_digest": own,
                  "error": None if digest in ("", own) else f"payload digest {digest}, but {own}"}


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row a record (``RECORDS``) of archives (path, content); ``payloads=False`` leaves payloads out."""
    kinds = {"path": pa.string(), "frame_offset": pa.int64(), "page_id": pa.int64(), "target_uri": pa.string(), "record_type": pa.string(),
             "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "error": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for at, data, error in frames(content.as_py() or b""):
                    row = parse(data) if error is None else {"error": error}
                    size += len(row.get("payload") or b"")
                    if not payloads:
                        row["payload"] = None
                    held.append({"path": path.as_py(), "frame_offset": at} | row)
                    if len(held) >= 5000 or payloads and size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("path", "content").mapInArrow(read, RECORDS)
