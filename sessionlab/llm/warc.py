"""WARC records in seekable Zstandard bundles.

Each task writes bundles of its rows to the cluster's shared folder.  A
bundle is a row of independent Zstandard frames, each of which holds whole
records of about ``frame_bytes``, and ends with a skippable frame that is the
seek table (compressed and decompressed size per frame), so a reader finds
any frame from the file's end.  The index maps a record to its bundle, frame
and offset inside the decompressed frame.

Records with equal payloads are found by digest: Spark joins pages to the
digests that occur more than once, so only the first-class record (largest
page id) carries the payload and the others are revisits.  Files are written
under names of their own per attempt and count only once their index rows are
committed, so a lost executor leaves at most files nobody refers to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import col, shuffle_partitions, slices
from sessionlab.session import checkpoint_dir
from sessionlab.sources.store import stage

FRAME_BYTES = 1 << 20
BUNDLE_FRAMES = 64
# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_TABLE_MAGIC = 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")

_NO_ID = -2 ** 63
INDEX = "page_id long, bundle string, frame int, offset long, length long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder given as Spark names it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# ----------------------------------------------------------------- records

def _name(page_id) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(name: str):
    value = name[len("<urn:page:"):-1]
    return None if value == "none" else int(value)


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One WARC/1.1 record.  A revisit has the HTTP head without the body; its
    Content-Length is that of the full payload."""
    b32 = base64.b32encode(digest).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    head.append(f"WARC-Payload-Digest: sha1:{b32}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(frame: bytes) -> Iterator[tuple[int, int, dict, bytes, bytes]]:
    """(offset, length, headers, HTTP head, payload) of a frame's records."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at offset {at}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if frame[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} is cut short")
        http, _, payload = frame[start:stop].partition(b"\r\n\r\n")
        yield at, stop + 4 - at, headers, http, payload
        at = stop + 4


# ----------------------------------------------------------------- bundles

def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(_ENTRY.pack(c, d) for c, d in sizes)
    footer = _FOOTER.pack(len(sizes), 0, SEEK_TABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(position, compressed size, decompressed size) per frame, read from
    the end of an open file."""
    f.seek(size - _FOOTER.size)
    n, flags, magic = _FOOTER.unpack(f.read(_FOOTER.size))
    if magic != SEEK_TABLE_MAGIC:
        raise ValueError("no seek table")
    width = _ENTRY.size + (4 if flags & 0x80 else 0)
    f.seek(size - _FOOTER.size - n * width)
    table, out, at = f.read(n * width), [], 0
    for i in range(n):
        c, d = _ENTRY.unpack_from(table, i * width)
        out.append((at, c, d))
        at += c
    return out


def read_frame(f, frame: tuple[int, int, int]) -> bytes:
    at, compressed, size = frame
    f.seek(at)
    return zstandard.ZstdDecompressor().decompress(f.read(compressed), max_output_size=max(1, size))


def _write(batches: Iterator[pa.RecordBatch], folder: str, frame_bytes: int, bundle_frames: int):
    fs, base = filesystem(folder)
    zstd = zstandard.ZstdCompressor(level=3)
    records, held, sizes, out, index = [], 0, [], None, []
    name = None

    def close_frame():
        nonlocal records, held, out, name
        if not records:
            return
        if out is None:
            name = f"{uuid.uuid4().hex}.warc.zst"
            fs.create_dir(base, recursive=True)
            out = fs.open_output_stream(f"{base}/{name}", compression=None)
        offset = 0
        for page_id, data in records:
            index.append((page_id, name, len(sizes), offset, len(data)))
            offset += len(data)
        frame = zstd.compress(b"".join(d for _, d in records))
        out.write(frame)
        sizes.append((len(frame), offset))
        records, held = [], 0

    def close_bundle():
        nonlocal out, sizes
        if out is not None:
            out.write(seek_table(sizes))
            out.close()
        out, sizes = None, []

    def rows():
        cols = list(zip(*index)) or [[]] * 5
        index.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()))],
            names=["page_id", "bundle", "frame", "offset", "length"])

    for part in slices(batches, 1 << 23, "html"):
        for r in part.to_pylist():
            page_id = None if r["k"] == _NO_ID else r["k"]
            first = None if r["first"] in (None, _NO_ID) else r["first"]
            data = record(page_id, r["url"], r["html"].encode("utf-8"), r["digest"], first, r["first"] is not None)
            records.append((page_id, data))
            held += len(data)
            if held >= frame_bytes:
                close_frame()
                if len(sizes) >= bundle_frames:
                    close_bundle()
                    yield rows()
    close_frame()
    close_bundle()
    yield rows()


def write_bundles(pages: DataFrame, folder: str, id_col="page_id", url_col="url", html_col="html",
                  min_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_frames: int = BUNDLE_FRAMES) -> DataFrame:
    """Write a record per row under ``folder``; returns the index (page_id,
    bundle, frame, offset, length), staged and thus committed.

    Of payloads of at least ``min_bytes`` that are equal, the row with the
    largest id is the response (rows that repeat this id too), the others
    refer to it.  A null html is the empty payload; a null id counts as the
    smallest; a null url is left out; an empty table writes no bundle; other
    columns are not read.
    """
    html = F.coalesce(col(pages, html_col).cast("string"), F.lit(""))
    rows = pages.select(F.coalesce(col(pages, id_col).cast("long"), F.lit(_NO_ID)).alias("k"),
                        col(pages, url_col).cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("html", "UTF-8"))))
    again = (rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
             .agg(F.max("k").alias("top"), F.min("k").alias("low")).where("low < top").drop("low"))
    typed = rows.join(again, "digest", "left").select(
        "k", "url", "html", "digest", F.when(F.col("k") < F.col("top"), F.col("top")).alias("first"))
    return stage(typed.mapInArrow(lambda it: _write(it, folder, frame_bytes, bundle_frames), INDEX), "warc_index")


def _read(batches: Iterator[pa.RecordBatch], folder: str):
    fs, base = filesystem(folder)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame",
             "offset", "html"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int32(),
             pa.int64(), pa.string()]
    for batch in batches:
        for name in batch.column("bundle").to_pylist():
            path = f"{base}/{name}"
            with fs.open_input_file(path) as f:
                for n, frame in enumerate(read_seek_table(f, f.size())):
                    rows = []
                    for at, _, h, http, payload in parse(read_frame(f, frame)):
                        kind = h["WARC-Type"]
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                        if kind == "response" and (len(payload) != length or base64.b32encode(
                                hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{path}: the payload at {n}, {at} does not match its digest")
                        refers = h.get("WARC-Refers-To")
                        rows.append((_page_id(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), length, digest, kind,
                                     _page_id(refers) if refers else None, name, n, at,
                                     payload.decode("utf-8") if kind == "response" else None))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the index's bundles, frame by frame, payloads checked
    against their digests (html is null for revisits)."""
    # few bytes a row but a whole bundle's work: dealt out by number; by key, the
    # partitions of the distinct would be kept and merged for their small size
    bundles = index.select("bundle").distinct().repartition(shuffle_partitions(index.sparkSession))
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, bundle string, frame int, offset long, html string")
    return bundles.mapInArrow(lambda it: _read(it, folder), schema)


def read_record(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict, bytes]:
    """Headers and payload of one record by its place in the index: only its
    frame is read."""
    fs, base = filesystem(folder)
    with fs.open_input_file(f"{base}/{bundle}") as f:
        data = read_frame(f, read_seek_table(f, f.size())[frame])
    _, _, headers, _, payload = next(parse(data[offset:]))
    return headers, payload


def new_folder(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
