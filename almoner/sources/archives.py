"""Filings in ZIP archives: listing members, and reading the wanted ones.

An archive's directory is read as a stream: neither it nor an archive is ever held as a whole."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from almoner.sources.inflate64 import inflate64

SUFFIX, DEFLATE64 = "_public.xml", 9
LISTED = "object_id string, zip_file string, member string, bytes long"
#: Bytes of documents, and rows, that are handed over at once.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 5_000
#: Bytes of an archive that one task reads, and of a directory that are read at once.
SPAN, BLOCK = 32 << 20, 1 << 20
READ = "object_id string, zip_file string, xml string, error string"
#: Where a member stands and how it is packed.
PLACE = "offset long, packed long, crc long, method int, flags int"
_READ = pa.schema([(c, pa.string()) for c in ("object_id", "zip_file", "xml", "error")])
_PLACE = [("offset", pa.int64()), ("packed", pa.int64()), ("crc", pa.int64()), ("method", pa.int32()), ("flags", pa.int32())]
_LISTED = pa.schema([(c, pa.string()) for c in ("object_id", "zip_file", "member")] + [("bytes", pa.int64()), ("path", pa.string()), *_PLACE])


def object_id(member: str) -> str:
    return member.rpartition("/")[2][: -len(SUFFIX)]


def _directory(f: BinaryIO) -> tuple[int, int, int]:
    """Where an archive's directory begins, its bytes, and how far all places are shifted by what precedes the archive."""
    size = f.seek(0, 2)
    tail_at = f.seek(max(0, size - (1 << 16) - 22))
    tail = f.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0 or len(tail) < end + 22:
        raise zipfile.BadZipFile("no end of a directory")
    length, start = struct.unpack("<LL", tail[end + 12 : end + 20])
    end += tail_at
    f.seek(max(0, end - 20))
    if end >= 20 and (locator := f.read(20))[:4] == b"PK\x06\x07":
        # the large form's end has no comment, so it stands right before its locator
        f.seek(at := max(0, end - 76))
        if (large := f.read(56))[:4] != b"PK\x06\x06":
            f.seek(at := struct.unpack("<Q", locator[8:16])[0])
            large = f.read(56)
        if large[:4] == b"PK\x06\x06":
            end, (length, start) = at, struct.unpack("<QQ", large[40:56])
    if (shift := end - length - start) < 0:
        raise zipfile.BadZipFile("the directory's place is wrong")
    return start + shift, length, shift


def entries(f: BinaryIO) -> Iterator[zipfile.ZipInfo]:
    """The members that an archive's directory lists, one by one, in its order."""
    start, left, shift = _directory(f)
    at, held = start, b""
    place = 0

    def need(n: int) -> bool:
        """Whether the next n bytes of the directory are at hand now."""
        nonlocal held, place, at, left
        while len(held) - place < n and left:
            f.seek(at)  # a member may have been read in between
            more = f.read(min(BLOCK, left))
            if not more:
                break
            held, place, at, left = held[place:] + more, 0, at + len(more), left - len(more)
        return len(held) - place >= n

    while need(1):
        if not need(46) or held[place : place + 4] != b"PK\x01\x02":
            raise zipfile.BadZipFile("a directory's entry is broken")
        flags, method, _, _, crc, packed, size, n, extra, comment, _, _, _, offset = struct.unpack("<HHHHLLLHHHHHLL", held[place + 8 : place + 46])
        if not need(46 + n + extra + comment):
            raise zipfile.BadZipFile("the directory is cut off")
        raw, more = held[place + 46 : place + 46 + n], held[place + 46 + n : place + 46 + n + extra]
        place += 46 + n + extra + comment
        while len(more) >= 4:
            kind, k = struct.unpack("<HH", more[:4])
            if kind == 1:  # what is too large for 32 bits, in this order
                wide = io.BytesIO(more[4 : 4 + k])
                size, packed, offset = (int.from_bytes(wide.read(8), "little") if v == 0xFFFFFFFF else v for v in (size, packed, offset))
            more = more[4 + k :]
        info = zipfile.ZipInfo(raw.decode("utf-8" if flags & 0x800 else "cp437"))
        info.flag_bits, info.compress_type, info.CRC = flags, method, crc
        info.compress_size, info.file_size, info.header_offset = packed, size, offset + shift
        yield info


def filings_in(f: BinaryIO) -> Iterator[zipfile.ZipInfo]:
    return (i for i in entries(f) if i.filename.lower().endswith(SUFFIX))


def raw_member(f: BinaryIO, info: zipfile.ZipInfo) -> bytes:
    """A member's bytes as they stand, by its own header."""
    f.seek(info.header_offset)
    head = f.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise zipfile.BadZipFile("a member's header is broken")
    n, extra = struct.unpack("<HH", head[26:30])
    name = f.read(n + extra)[:n].decode("utf-8" if info.flag_bits & 0x800 else "cp437")
    if name != info.orig_filename:
        raise zipfile.BadZipFile(f"its header names {name}")
    return f.read(info.compress_size)


def read_member(f: BinaryIO, info: zipfile.ZipInfo) -> tuple[str | None, str | None]:
    """A member's text, or why it can't be read (a method without a decoder, a broken header, a wrong size or sum)."""
    try:
        if info.flag_bits & 1:
            raise zipfile.BadZipFile("encrypted")
        raw = raw_member(f, info)
        if info.compress_type == DEFLATE64:
            body = inflate64(raw, info.file_size)
            if zlib.crc32(body) != info.CRC:
                raise zipfile.BadZipFile("bad CRC-32")
        else:
            with zipfile.ZipExtFile(io.BytesIO(raw), "r", info) as member:
                body = member.read()
    except (ValueError, NotImplementedError, zipfile.BadZipFile, zlib.error, RuntimeError, EOFError, OSError) as e:
        return None, f"{info.filename}: {e} (compression method {info.compress_type})"
    if len(body) != info.file_size:
        return None, f"{info.filename}: {len(body)} bytes inflated, {info.file_size} stated"
    return body.decode("utf-8-sig", "replace"), None


def _batches(rows: Iterable[tuple], schema: pa.Schema, size=lambda row: 0) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded rows and bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) >= BATCH_ROWS or total >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)


def _text_size(row: tuple) -> int:
    return len(row[2] or "")


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)


def opened(path: str) -> BinaryIO:
    """A file that can be read from any place on, by its own file system: an archive is never held as a whole."""
    if path.startswith("file:/"):
        return open("/" + path[5:].lstrip("/"), "rb")  # noqa: SIM115
    system, inside = pyarrow.fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def _listed(spark: SparkSession, path: str) -> DataFrame:
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (x for batch in batches for x in batch.column(0).to_pylist()):
            with opened(name) as f:
                rows = (
                    (object_id(i.filename), name.rpartition("/")[2], i.orig_filename, i.file_size, name, i.header_offset, i.compress_size, i.CRC, i.compress_type, i.flag_bits)
                    for i in filings_in(f)
                )
                yield from _batches(rows, _LISTED)

    return archives(spark, path).select("path").mapInArrow(listed, f"{LISTED}, path string, {PLACE}")


def members(spark: SparkSession, path: str) -> DataFrame:
    """What the archives' central directories list; nothing else of them is read."""
    return _listed(spark, path).select("object_id", "zip_file", "member", "bytes")


def documents(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """object_id, zip_file, xml and error of the wanted members; others are never read or inflated.

    Only names are joined: what an archive holds is listed, and the wanted ones' places go to tasks that each open a span
    of it and read their members in order."""
    names = _listed(spark, path).drop("zip_file")
    if wanted is not None:
        names = names.join(wanted.select("object_id").distinct(), "object_id", "left_semi")
    names = names.repartition("path", F.floor(F.col("offset") / SPAN)).sortWithinPartitions("path", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            name = f = None
            try:
                for m in (m for batch in batches for m in batch.to_pylist()):
                    if m["path"] != name:
                        if f is not None:
                            f.close()
                        name = m["path"]
                        f = opened(name)
                    info = zipfile.ZipInfo(m["member"])
                    info.flag_bits, info.compress_type, info.CRC = m["flags"], m["method"], m["crc"]
                    info.compress_size, info.file_size, info.header_offset = m["packed"], m["bytes"], m["offset"]
                    yield (m["object_id"], name.rpartition("/")[2], *read_member(f, info))
            finally:
                if f is not None:
                    f.close()

        yield from _batches(rows(), _READ, _text_size)

    return names.mapInArrow(read, READ)


class ZipFilings(DataSource):
    """spark.read.format("zip_filings").option("paths", "a.zip,b.zip").load(): streams members of archives on a mounted
    file system, one partition for each archive, without holding an archive in memory. Option wanted: ids, comma-joined."""

    @classmethod
    def name(cls) -> str:
        return "zip_filings"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> DataSourceReader:
        return _ZipReader(self.options)


class _Archive(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _ZipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options.get("paths", "").split(",") if p]
        self.wanted = {x for x in options.get("wanted", "").split(",") if x} or None

    def partitions(self) -> list[InputPartition]:
        return [_Archive(p) for p in self.paths]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as f:
            rows = (
                (object_id(i.filename), partition.path.rpartition("/")[2], *read_member(f, i)) for i in filings_in(f)
                if self.wanted is None or object_id(i.filename) in self.wanted
            )
            yield from _batches(rows, _READ, _text_size)
