"""Sum-of-squares online packing of token sequences into windows.

Each document's ids (and an end id) are cut into full windows and a rest. A rest goes, as it comes, to the fill level
that leaves the sum of squared counts of partly filled windows smallest; the counts are kept in an array by level. What is
still partly filled when a partition ends (or when `most_open` windows are open) is laid end to end and cut into full
windows, so only the last window of a partition is short; that one is cut into power-of-two lengths.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, column_bytes, record, text_bytes, word_ids

WINDOW = 2048
END = 1
PIECE = {"row": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
         "sequence": pa.int64(), "offset": pa.int64(), "ids": pa.list_(pa.int32())}


class LevelArray:
    """Counts of partly filled windows by level, and the windows themselves."""

    def __init__(self, window: int):
        self.window, self.count = window, np.zeros(window + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(window + 1)]
        self.total = 0

    def level_for(self, size: int) -> int:
        """Level whose use changes the sum of squares least; the fullest of equally good ones.

        Moving a window from level h to h + size changes the sum by 2 (N[h+size] - N[h]) + 2; a new window or a
        filled one leaves out the part of level 0 or of the full level, whose windows do not count.
        """
        n, top = self.count, self.window - size
        change = 2 * (n[size : self.window + 1] - n[: top + 1]) + 2
        change[0] = 2 * n[size] + 1
        if top:
            change[top] = 1 - 2 * n[top]
        change[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(change[::-1].argmin())

    def place(self, piece) -> list | None:
        """Put a piece (its length comes first) into a window; the window, if that fills it."""
        size = piece[0]
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.count[level] -= 1
        else:
            held = []
            self.total += 1
        held.append(piece)
        if level + size == self.window:
            self.total -= 1
            return held
        self.open[level + size].append(held)
        self.count[level + size] += 1
        return None

    def drain(self) -> list[list]:
        """All partly filled windows, fullest first."""
        found = [w for level in reversed(self.open) for w in level]
        self.__init__(self.window)
        return found


def pack_stream(docs: Iterator[tuple], window: int = WINDOW, most_open: int = 4096) -> Iterator[list]:
    """Windows of pieces (length, key, start, ids) from documents (key, ids), each id in exactly one piece."""
    levels = LevelArray(window)

    def merged(last: bool) -> Iterator[list]:
        held, room = [], window
        for length, key, start, ids in (p for w in levels.drain() for p in w):
            while length:
                n = min(length, room)
                held.append((n, key, start, ids[:n]))
                length, start, ids, room = length - n, start + n, ids[n:], room - n
                if not room:
                    yield held
                    held, room = [], window
        if held and not last:
            for p in held:
                levels.place(p)
        elif held:
            left = window - room
            while left:
                part, need = [], 1 << left.bit_length() - 1
                left -= need
                while need:
                    length, key, start, ids = held.pop(0)
                    n = min(length, need)
                    part.append((n, key, start, ids[:n]))
                    if length > n:
                        held.insert(0, (length - n, key, start + n, ids[n:]))
                    need -= n
                yield part

    for key, ids in docs:
        whole = len(ids) // window * window
        for start in range(0, whole, window):
            yield [(window, key, start, ids[start : start + window])]
        if len(ids) > whole:
            full = levels.place((len(ids) - whole, key, whole, ids[whole:]))
            if full:
                yield full
            if levels.total > most_open:
                yield from merged(False)
    yield from merged(True)


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    Every input partition packs its own rows in their order, without a shuffle and holding at most `most_open` windows;
    sequence ids are the partition number and a running number, so a task that is run again gives the same pieces. Null or
    empty text is a document of the end id alone. Repeated rows are packed each; a null id is passed on. Empty input gives
    no rows; other columns are ignored. The ids of a piece are `ids`, where `with_ids` asks for them.
    """
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_ids(vocabulary), TaskContext.get().partitionId()

        def stream():
            for b in batches:
                keys = b.column(0).to_pylist()
                flat, counts = encoder.encode(column_bytes(b, "text"))
                ends = np.cumsum(counts)
                for key, e, n in zip(keys, ends.tolist(), counts.tolist()):
                    ids = np.empty(n + 1, "<u4")
                    ids[:n], ids[n] = flat[e - n : e], end_id
                    yield (key, n + 1), ids

        rows: list[tuple] = []
        for number, held in enumerate(pack_stream(stream(), window)):
            at = 0
            for length, (key, total), start, ids in held:
                rows.append((key, start, length, zlib.crc32(ids.tobytes()), total, (part << 33) + number, at,
                             ids.astype(np.int32) if with_ids else None))
                at += length
            if len(rows) >= 2000:
                yield record(dict(zip(PIECE, zip(*rows))), PIECE)
                rows = []
        if rows:
            yield record(dict(zip(PIECE, zip(*rows))), PIECE)

    pieces = docs.select(F.col(id_col).cast("long").alias("row"), text_bytes(text_col).alias("text")).mapInArrow(
        run, "row long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, ids array<int>")
    out = pieces.select(F.col("row").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens",
                        F.col("sequence").alias("sequence_id"), "offset", "ids")
    return out if with_ids else out.drop("ids")
