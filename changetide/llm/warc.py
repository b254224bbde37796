"""Web archives: records as gzip members written by Spark, and a reader that splits files anywhere.

Spark's text writer puts raw bytes and a separator. A gzip member ends with the high byte of its length,
which is zero below 16 MiB, so members are handed over without that byte and the separator is the
zero byte: the files are plain concatenated members. (A longer record is followed by an empty member.)

The reader gets byte ranges, not files. A task looks for the gzip magic in its range, inflates what
follows each find, takes it for a record if that begins with a WARC version, and owns the records
that start inside its range, wherever they end.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from changetide.llm.common import map_arrow, slices, stored, text_or_empty
from changetide.session import scratch_dir

#: Fixed values of the formats.
MAGIC, VERSION, GZIP = b"\x1f\x8b\x08", b"WARC/1.1", 31
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of a range, and bytes read at once beyond its end.
RANGE, AHEAD = 16 << 20, 256 << 10
#: Bytes inflated at once: first, and then.
FIRST, PIECE = 4 << 10, 64 << 10
_RECORD = "urn:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, date: str) -> bytes:
    """A WARC record. A revisit has the HTTP header, which tells the length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{_RECORD}{'' if page is None else page}>",
        "WARC-Date": date,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        fields["WARC-Target-URI"] = re.sub(r"\s", "%20", url)
    if kind == "revisit":
        fields |= {"WARC-Refers-To": f"<{_RECORD}{refers_to}>", "WARC-Profile": PROFILE}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 4) -> bytes:
    """A gzip member that ends with a zero byte, or two of which the second is empty."""
    member = zlib.compress(data, level, GZIP)
    return member if member[-1] == 0 else member + zlib.compress(b"", level, GZIP)


def with_record_types(pages: DataFrame, least_payload: int = 0) -> DataFrame:
    """Adds record_type and refers_to: of equal payloads of `least_payload` bytes or more the largest page_id's is the response.

    A null html is empty. Repeated rows of that page_id are all responses; a null page_id is smaller
    than any other. Payloads are equal if SHA-1 and length are.
    """
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html")
    ).withColumns({"_sha": F.sha1("html"), "_bytes": F.octet_length("html")})
    # Stored, so that a payload with very many pages is a skewed join that Spark splits.
    last, _ = stored(named.groupBy("_sha", "_bytes").agg(F.max("page_id").alias("_last")), "payloads")
    again = (F.col("_bytes") >= least_payload) & F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return named.join(last, ["_sha", "_bytes"]).select(
        "page_id",
        "url",
        "html",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_last")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write pages with record types to compressed archives in a folder, one per task."""

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "record_type", "refers_to")), strict=True)
            data = [gzip_member(record(p, u, h.encode(), k, r, date))[:-1] for p, u, h, k, r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["member"])

    written = map_arrow(pages.select("page_id", "url", "html", "record_type", "refers_to"), members, "member binary")
    written.select(F.col("member").cast("string").alias("value")).write.text(folder, lineSep="\0")


def open_file(path: str) -> pa.NativeFile:
    """Random access to a file in any store that Arrow knows."""
    uri = re.sub(r"^file:/+", "file:///", path)
    store, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    return store.open_input_file(name)


def pieces(file: pa.NativeFile, size: int, at: int, window: memoryview, base: int) -> Iterator[tuple[int, bytes]]:
    """The bytes from an offset on, in pieces with the offset behind each: out of the window, then out of the file.

    A piece is small, so that a record costs what it is long, not what lies behind it.
    """
    length = FIRST
    while at < size:
        piece = window[at - base : at - base + length] or file.read_at(min(AHEAD, size - at), at)
        at, length = at + len(piece), PIECE
        yield at, piece


def inflate(file: pa.NativeFile, size: int, at: int, window: memoryview, base: int) -> tuple[bytes, int] | None:
    """Content of the record member at an offset, and the offset behind it; None if there is no record."""
    inflater, parts, begun = zlib.decompressobj(GZIP), [], b""
    try:
        for position, piece in pieces(file, size, at, window, base):
            parts.append(inflater.decompress(piece))
            if len(begun) < len(VERSION):
                begun += parts[-1][: len(VERSION)]
                if not VERSION[:7].startswith(begun[:7]):
                    return None
            if inflater.eof:
                return (b"".join(parts), position - len(inflater.unused_data)) if len(begun) >= 7 else None
    except zlib.error as error:
        # The call that fails gives nothing back, so the start is decoded again, alone.
        if (begun if len(begun) >= 7 else start_of(window[at - base : at - base + FIRST]))[:7] == VERSION[:7]:
            raise ValueError(f"the record at byte {at} is damaged") from error
        return None
    if len(begun) >= 7:
        raise ValueError(f"the record at byte {at} is not complete")
    return None


def start_of(member: bytes | memoryview) -> bytes:
    """The first bytes of a member's content; nothing if they do not decode."""
    try:
        return zlib.decompressobj(GZIP).decompress(member, len(VERSION))
    except zlib.error:
        return b""


def records(path: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Offset and content of the records that start in a range of a file."""
    with open_file(path) as file:
        size = file.size()
        window = file.read_at(min(size, end + AHEAD) - start, start)
        view = memoryview(window)
        at = start
        while 0 <= (found := window.find(MAGIC, at - start)) < end - start:
            at = start + found
            if got := inflate(file, size, at, view, start):
                yield at, got[0]
                at = got[1]
                if at >= end:
                    return
            else:
                at += 1


def parse(content: bytes) -> dict:
    """Fields of a record; a response's payload is held against its digest."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(v) if (v := fields.get(name, "").strip("<>").removeprefix(_RECORD)) else None
    length = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
    told = fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-type"] == "response" and (len(payload) != length or digest(payload) != told):
        raise ValueError(f"the payload of {fields['warc-record-id']} does not match its digest")
    return {
        "page_id": number("warc-record-id"),
        "record_type": fields["warc-type"],
        "refers_to": number("warc-refers-to"),
        "url": fields.get("warc-target-uri"),
        "payload_digest": told,
        "payload_bytes": length,
        "payload": payload if fields["warc-type"] == "response" else None,
    }


_FIELDS = "page_id bigint, record_type string, refers_to bigint, url string, payload_digest string, payload_bytes bigint, payload binary"
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


def read_warc(spark: SparkSession, folder: str, range_bytes: int = RANGE, with_payload: bool = True) -> DataFrame:
    """Records of all archives in a folder, in any order: path, at (offset), and their fields.

    A revisit has no payload, but its length and digest. A record that ends too early, does not inflate
    to its end, or does not fit its digest, is an error. Empty files have no records.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "length", starts.alias("start"))
    tasks = max(1, min(100_000, ranges.count()))  # a task reads more than one range beyond that
    kept = [n for n in _NAMES if with_payload or n != "payload"]
    columns = ", ".join(f for f in _FIELDS.split(", ") if f.split()[0] in kept)
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]] for f in columns.split(", ")]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(path, rows):
            arrays = [pa.array([r[n] for _, r in rows], kind) for n, kind in zip(kept, kinds, strict=True)]
            places = [pa.array([path] * len(rows), pa.string()), pa.array([at for at, _ in rows], pa.int64())]
            return pa.RecordBatch.from_arrays(places + arrays, ["path", "at", *kept])

        for batch in batches:
            for path, start, length in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length")), strict=True):
                rows, size = [], 0
                for at, content in records(path, start, min(length, start + range_bytes)):
                    rows.append((at, parse(content)))
                    size += len(content)
                    if size > 8 << 20:
                        yield batch_of(path, rows)
                        rows, size = [], 0
                yield batch_of(path, rows)

    dealt = ranges.repartition(tasks, "path", "start")
    return map_arrow(dealt, read, f"path string, at bigint, {columns}")


def archive_round_trip(pages: DataFrame, least_payload: int = 0, range_bytes: int = RANGE) -> DataFrame:
    """Write pages to archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Every row of `pages` is a record, so null, repeated and tied page_ids come back as often as they
    went in. Other columns are not read. An empty table gives empty archives and no rows.
    """
    folder = scratch_dir(pages.sparkSession, "warc")
    write_warc(with_record_types(pages, least_payload), folder)
    back = read_warc(pages.sparkSession, folder, range_bytes, with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
