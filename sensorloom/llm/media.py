"""Media columns: payloads kept losslessly as images in archives, read back by a Spark data source.

`media_archive` writes each row's media into archives (zip files without further packing) in a shared folder. Reading plans byte
ranges over the archives; a range holds the members whose header starts in it. A task reads its range at once, checks each
member, and reads a damaged one again, on its own, by its offset. Batches of members leave the task through Arrow.
"""

from __future__ import annotations

import struct
import time
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import arrow_batches, column_bytes, record, text_bytes
from ..session import scratch_folder

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
MEMBER = "doc_id long, n_bytes long, archive string, offset long, attempts int, media binary"


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_image(payload: bytes) -> bytes:
    """A grey 8-bit PNG, 64 samples a row, of a payload whose length is a positive multiple of 64."""
    rows = np.zeros((len(payload) // WIDTH, WIDTH + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    header = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 1)) + chunk(b"IEND", b"")


def from_image(media: bytes) -> np.ndarray:
    """Samples of such an image, one row each; an error if a part is damaged or of another kind."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, packed = 8, None, []
    while at < len(media):
        if len(media) < at + 12 or len(media) < at + 12 + int.from_bytes(media[at : at + 4], "big"):
            raise ValueError("an image ends too early")
        n, kind = struct.unpack(">I4s", media[at : at + 8])
        data = media[at + 8 : at + 8 + n]
        if zlib.crc32(kind + data) != struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged part of an image")
        if kind == b"IHDR":
            size = struct.unpack(">IIBBBBB", data)
        elif kind == b"IDAT":
            packed.append(data)
        at += 12 + n
    if size is None or size[2:] != (8, 0, 0, 0, 0):
        raise ValueError("another kind of PNG")
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(size[1], size[0] + 1)
    if rows[:, 0].any():
        raise ValueError("filtered rows are not written here")
    return rows[:, 1:]


def payload_of(text: bytes) -> bytes:
    """The text's bytes and as many zero bytes as make a positive multiple of 64."""
    return text + bytes(max(WIDTH, -(-len(text) // WIDTH) * WIDTH) - len(text))


def features(samples: np.ndarray) -> str:
    """Mean, deviation and entropy of the samples, and which columns are lighter than the middle one (64 bits)."""
    counts = np.bincount(samples.reshape(-1), minlength=256)
    share = counts[counts > 0] / samples.size
    mean = float((counts * np.arange(256)).sum() / samples.size)
    spread = float(np.sqrt((counts * (np.arange(256) - mean) ** 2).sum() / samples.size))
    columns = samples.sum(axis=0, dtype=np.int64)
    bits = np.packbits(columns > np.sort(columns)[WIDTH // 2]).tobytes().hex()
    return f"{mean:.3f}:{spread:.3f}:{max(0.0, float(-(share * np.log2(share)).sum())):.4f}:{bits}"


def file_system(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    archives: list


@dataclass
class ByteRange(InputPartition):
    archive: str
    first: int
    last: int

    def __init__(self, archive: str, first: int, last: int):
        self.archive, self.first, self.last = archive, first, last


class ArchiveWriter(DataSourceArrowWriter):
    """Archives of up to `archive_bytes`, named after the write and the task's attempt; only those of attempts that Spark commits stay."""

    def __init__(self, options: dict):
        self.path, self.limit = options["path"], int(options.get("archive_bytes", 64 << 20))

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        import warnings
        import zipfile

        warnings.simplefilter("ignore", UserWarning)
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        names, archive, out, number = [], None, None, 0
        for b in batches:
            for doc_id, n_bytes, media in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if archive is None:
                    names.append(f"media-{uuid.uuid4().hex}.zip")
                    out = fs.open_output_stream(f"{folder}/{names[-1]}")
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                member = zipfile.ZipInfo(f"{number}_{'' if doc_id is None else doc_id}_{n_bytes}.png")
                archive.writestr(member, media)
                number += 1
                if out.tell() >= self.limit:
                    archive.close(), out.close()
                    archive = None
        if archive is not None:
            archive.close(), out.close()
        return Written(names)

    def commit(self, messages: list) -> None:
        """List the archives of the committed tasks; a reader looks at no other file."""
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/_archives") as out:
            out.write("\n".join(n for m in messages if m for n in m.archives).encode())

    def abort(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            for name in m.archives if m else ():
                fs.delete_file(f"{folder}/{name}")


def directory(source, size: int) -> list[tuple[int, int, int, str]]:
    """(offset, size, crc, name) of each member, in order of offset, from the directory at the end of an archive."""
    import zipfile

    with zipfile.ZipFile(source) as archive:
        return sorted((i.header_offset, i.file_size, i.CRC, i.filename) for i in archive.infolist())


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("range_bytes", 16 << 20))
        self.retries, self.pause = int(options.get("retries", 3)), float(options.get("pause_seconds", 0.2))
        self.batch = int(options.get("batch_bytes", 8 << 20))

    def partitions(self) -> list[ByteRange]:
        """Byte ranges of all archives, by their sizes alone: no directory is read here."""
        from pyarrow import fs as pafs

        fs, folder = file_system(self.path)
        with fs.open_input_stream(f"{folder}/_archives") as listed:
            names = [n for n in listed.read().decode().split("\n") if n]
        sizes = {f.path.rsplit("/", 1)[-1]: f.size for f in fs.get_file_info(pafs.FileSelector(folder))}
        return [ByteRange(n, at, min(sizes[n], at + self.range)) for n in names for at in range(0, sizes[n], self.range)] or [ByteRange("", 0, 0)]

    def member(self, source, held: bytes, base: int, offset: int, size: int, crc: int) -> tuple[bytes, int]:
        """A member's bytes and the number of reads it took: from the bytes of the range at first, then alone from its offset."""
        for attempt in range(self.retries + 1):
            if attempt:
                time.sleep(self.pause * (attempt - 1))
                source.seek(offset)
                held, base = source.read(30 + 2 * 65535 + size), offset
            at = offset - base
            head = held[at : at + 30]
            if len(head) == 30 and head[:4] == b"PK\x03\x04":
                start = at + 30 + sum(struct.unpack("<HH", head[26:30]))
                data = held[start : start + size]
                if len(data) == size and zlib.crc32(data) == crc:
                    return data, attempt + 1
        raise OSError(f"member at {offset} is damaged after {self.retries + 1} reads")

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        fs, folder = file_system(self.path)
        kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "archive": pa.string(), "offset": pa.int64(), "attempts": pa.int32(), "media": pa.binary()}
        with fs.open_input_file(f"{folder}/{partition.archive}") as source:
            every = directory(source, partition.last)
            ends = [m[0] for m in every[1:]] + [every[-1][0] + 30 + 2 * 65535 + every[-1][1]] if every else []
            mine = [(m, e) for m, e in zip(every, ends) if partition.first <= m[0] < partition.last]
            while mine:
                part, size = [], 0
                while mine and (not part or size + mine[0][0][1] <= self.batch):
                    size += mine[0][0][1]
                    part.append(mine.pop(0))
                base = part[0][0][0]
                source.seek(base)
                held = source.read(part[-1][1] - base)
                rows = []
                for (offset, length, crc, name), _ in part:
                    data, attempts = self.member(source, held, base, offset, length, crc)
                    _, doc_id, n_bytes = name.removesuffix(".png").split("_")
                    rows.append((int(doc_id) if doc_id else None, int(n_bytes), partition.archive, offset, attempts, data))
                yield record(dict(zip(kinds, zip(*rows))), kinds)


class MediaArchive(DataSource):
    """Format `media_archive`. Options: path; archive_bytes to write; range_bytes, batch_bytes, retries, pause_seconds to read."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return MEMBER

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, also where another one (of a stream's batch, for one) was active last in this thread."""
    for session in {spark, SparkSession.getActiveSession() or spark}:
        session.dataSource.register(MediaArchive)
    spark._jvm.org.apache.spark.sql.SparkSession.setActiveSession(spark._jsparkSession)


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", **options) -> None:
    """Write every row's text as an image into archives in a folder that all machines share."""
    spark = docs.sparkSession
    arrow_batches(spark)
    register(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column_bytes(b, "text")
            yield record({"doc_id": b.column(0), "n_bytes": [len(t) for t in texts], "media": [to_image(payload_of(t)) for t in texts]},
                         {"doc_id": pa.int64(), "n_bytes": pa.int64(), "media": pa.binary()})

    images = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, media binary")
    images.write.format("media_archive").options(path=folder, **options).mode("append").save()


def stored(spark, folder: str, **options) -> DataFrame:
    """The members of all archives of a folder: doc_id, n_bytes, archive, offset, attempts, media."""
    register(spark)
    return spark.read.format("media_archive").options(path=folder, **options).load()


def described(members: DataFrame) -> DataFrame:
    """Columns that follow from each member's stored bytes: sizes and hashes of payload and media, and image features."""
    import hashlib

    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(),
             "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            media, rows = column_bytes(b, "media"), []
            for m in media:
                samples = np.ascontiguousarray(from_image(m))
                payload = samples.tobytes()
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(m), hashlib.sha256(m).hexdigest(),
                             features(samples)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 6, list(kinds.values())[2:]))],
                                             names=list(kinds))

    return members.select("doc_id", "n_bytes", "media").mapInArrow(
        run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Store every row's text as media and describe what is read back.

    Null text counts as empty, whose payload is 64 zero bytes. Repeated rows are stored and given each, a null id stays null. An empty table
    gives no rows; other columns are ignored. A member that stays damaged after all retries fails the read rather than being left out.
    """
    folder = folder or scratch_folder(docs.sparkSession) + "/media"
    store(docs, folder, id_col, text_col)
    return described(stored(docs.sparkSession, folder))
