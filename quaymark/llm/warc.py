"""WARC archives of zstandard frames with a shared dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import meet, written

#: Fixed values of the public formats: frame magics, and the skippable frame that holds a dictionary.
FRAME, SKIPPABLE = 0xFD2FB528, 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"


class BadArchive(ValueError):
    """An archive that breaks the format: a cut frame, a wrong length or digest, a missing header."""


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record. A revisit has the payload's digest and length, but not the payload."""
    uri = "".join(c if 32 < ord(c) < 127 else "".join(f"%{b:02X}" for b in c.encode("utf-8", "surrogatepass")) for c in url
        or "about:blank")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page)), ("WARC-Date", DATE), ("WARC-Target-URI", uri),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def archive(records: list[bytes], level: int = 3, dict_bytes: int = 16384, learn_from: int = 256) -> bytes:
    """An archive: the dictionary in a skippable frame, then one frame per record.

    The dictionary is trained on the archive's first ``learn_from`` records, the first 8 KB of
    each; with too little to train on, the skippable frame is empty and none is used.
    """
    samples = [r[:8192] for r in records[:learn_from]]
    trained = b""
    if len(samples) >= 8 and sum(map(len, samples)) > 8 * dict_bytes:
        try:
            trained = zstandard.train_dictionary(dict_bytes, samples).as_bytes()
        except zstandard.ZstdError:
            trained = b""
    use = {"dict_data": zstandard.ZstdCompressionDict(trained)} if trained else {}
    press = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True, **use)
    out = [struct.pack("<II", SKIPPABLE, len(trained)), trained]
    out += [press.compress(r) for r in records]
    return b"".join(out)


def _frame_end(data: memoryview, at: int) -> int:
    """Where the zstandard frame that starts at ``at`` ends, from its header and block sizes."""
    try:
        flags = data[at + 4]
        at += zstandard.frame_header_size(data[at : at + 18])
        while True:
            head = data[at] | data[at + 1] << 8 | data[at + 2] << 16
            at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
            if head & 1:
                break
    except (IndexError, zstandard.ZstdError) as e:
        raise BadArchive(f"cut or broken frame: {e}") from None
    at += 4 * (flags >> 2 & 1)
    if at > len(data):
        raise BadArchive("the last frame is cut off")
    return at


def _unpacked(unpress: zstandard.ZstdDecompressor, frame: memoryview, most: int) -> bytes:
    """One frame's content, whether its header gives the size or not; at most ``most`` bytes."""
    with unpress.stream_reader(frame, read_across_frames=False) as source:
        raw = source.read(most + 1)
    if len(raw) > most:
        raise BadArchive(f"a record of more than {most} bytes")
    return raw


def _record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a frame's one record, checked."""
    cut = raw.find(b"\r\n\r\n")
    lines = raw[:cut].split(b"\r\n")
    if cut < 0 or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise BadArchive("no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive(f"header line {line[:60]!r}")
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise BadArchive(f"no {name}")
    if not headers["content-length"].isdigit():
        raise BadArchive("Content-Length is no number")
    n = int(headers["content-length"])
    if len(raw) != cut + 4 + n + 4 or raw[-4:] != b"\r\n\r\n":
        raise BadArchive("the record's length is not its Content-Length")
    block = raw[cut + 4 : cut + 4 + n]
    if headers.get("warc-block-digest", "").startswith("sha1:") and headers["warc-block-digest"] != f"sha1:{sha1_base32(block)}":
        raise BadArchive("block digest")
    return headers, block


def read_archive(blob: bytes, most: int = 1 << 30) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of each record, in order, of any type; header names in lower case.

    Checks the dictionary frame, each frame's checksum and content size where it has them, the
    version line, the header lines, the block's length and SHA-1 digest, and that a frame holds
    just one record of at most ``most`` bytes. An archive may lack the dictionary frame; other
    skippable frames are passed over.
    """
    data = memoryview(blob)
    if len(data) < 8:
        raise BadArchive("no frame")
    magic, size = struct.unpack_from("<II", data)
    at, unpress = 0, zstandard.ZstdDecompressor()
    if magic == SKIPPABLE:
        if 8 + size > len(data):
            raise BadArchive("the dictionary frame is cut off")
        words = bytes(data[8 : 8 + size])
        at = 8 + size
        if words[:4] == struct.pack("<I", FRAME):  # the format allows a compressed dictionary
            words = _unpacked(unpress, memoryview(words), most)
        if words:
            unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
    elif magic != FRAME:
        raise BadArchive("neither a dictionary frame nor a record's")
    while at < len(data):
        if at + 8 > len(data):
            raise BadArchive("the last frame is cut off")
        magic, size = struct.unpack_from("<II", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE & 0xFFFFFFF0:
            at += 8 + size
            if at > len(data):
                raise BadArchive("a skippable frame is cut off")
            continue
        if magic != FRAME:
            raise BadArchive("no frame where one must start")
        end = _frame_end(data, at)
        try:
            raw = _unpacked(unpress, data[at:end], most)
        except zstandard.ZstdError as e:
            raise BadArchive(f"frame at {at}: {e}") from None
        at = end
        yield _record(raw)


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What a record's block carries: of an HTTP message its body, else the block."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return block
    cut = block.find(b"\r\n\r\n")
    return block[cut + 4 :] if cut >= 0 else b""


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0,
    target: int = 8 << 20) -> DataFrame:
    """Archives of all pages: a table ``(archive binary)`` in the shared folder, each of about ``target`` raw bytes.

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at
    least ``least`` bytes, that with the largest id is a response and the others revisit it;
    rows that tie for the largest id are responses all, and so are rows with a null id if all
    ids of their payload are null. A table of binary rows can be written to any store that
    Spark writes to; each row is a whole ``.warc.zst`` file.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("html"))
    keyed = rows.withColumn("sha", F.sha2("html", 256))
    shared = keyed.groupBy("sha").agg(F.max("id").alias("owner"), F.count("*").alias("n")).where("n > 1")
    joined = meet(keyed, written(shared, "payloads"), "sha", F.xxhash64("id", "url"))
    again = (F.length("html") >= least) & F.col("owner").isNotNull() & ~F.col("id").eqNullSafe(F.col("owner"))
    ready = joined.select("id", "url", "html", F.when(again, F.col("owner")).alias("refers"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        for batch in batches:
            for page, url, html, refers in zip(*(c.to_pylist() for c in batch.columns)):
                one = record(page, url, html, sha1_base32(html), refers, refers is not None)
                held.append(one)
                size += len(one)
                if size >= target:
                    yield pa.record_batch([pa.array([archive(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([archive(held)], pa.binary())], ["archive"])

    return written(ready.mapInArrow(pack, "archive binary"), "archives")


def read_archives(archives: DataFrame, col: str = "archive") -> DataFrame:
    """Records of a column of archives; also of ``spark.read.format("binaryFile")``, with ``col="content"``.

    ``(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload)`` of every record of
    any type; a broken archive fails the read, a null one has no records. The digest and length of
    what has a payload are of the payload that was read, and must be those that its headers give,
    if they do. A revisit has no payload: its digest and length are its headers', or null; so are page
    ids that no header gives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        def row(h: dict[str, str], block: bytes) -> tuple:
            named = h.get("warc-payload-digest")
            listed = int(h["x-payload-length"]) if "x-payload-length" in h else None
            payload, digest, length = None, named and named.removeprefix("sha1:"), listed
            if h["warc-type"] != "revisit":
                payload = payload_of(h, block)
                digest, length = sha1_base32(payload), len(payload)
                if (named or "").startswith("sha1:") and named != f"sha1:{digest}" or listed not in (None, length):
                    raise BadArchive("payload digest or length")
            page, refers = h.get("x-page-id"), h.get("x-refers-to-page")
            return page and int(page), h.get("warc-target-uri"), h["warc-type"], length, digest, refers and int(refers), payload

        for batch in batches:
            for blob in batch.column(0):
                rows, size = [], 0
                for h, block in read_archive(blob.as_buffer().to_pybytes()) if blob.is_valid else ():
                    rows.append(row(h, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    return archives.select(F.col(col)).mapInArrow(run,
        "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """Write every page to archives and read them back: one row per page, without the payload."""
    back = read_archives(write_archives(pages, **names))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
