"""Sum-of-squares online packing of documents into token windows.

A document's full windows go out at once; its rest is placed into the fill level for which the sum of the squared numbers of
open windows per level becomes smallest. That keeps the levels even, so that a rest of almost any size finds a window it
fills. The state of a lane is one array of 1,024 numbers and the open windows themselves. A lane is one partition of the
input: nothing is shuffled, and no lane grows beyond its partition.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.llm import tokens
from offermart.llm.common import table
from offermart.llm.registry import query

LENGTH = 1024
ROWS_OUT = 4096  # pieces of one output batch


class Lane:
    """Open windows by fill level. ``pieces`` collects ``(sequence, offset, doc, start, ids)`` of closed windows."""

    def __init__(self, length: int, first_sequence: int):
        self.length, self.next = length, first_sequence
        self.counts = np.zeros(length + 1, np.int64)
        self.open: list[list[list]] = [[] for _ in range(length)]  # per level: windows, each a list of pieces
        self.pieces: list[tuple] = []

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose use makes the sum of squares smallest; the fullest of equals."""
        n = self.counts
        levels = np.flatnonzero(n[: self.length - size + 1])
        after = n[levels + size]
        grown = np.where(levels + size == self.length, 0, 2 * after + 1)  # a full window is no longer counted
        change = grown - (2 * n[levels] - 1)
        new = 0 if size == self.length else 2 * n[size] + 1
        if len(levels) == 0 or new < change.min():
            return 0
        return int(levels[len(change) - 1 - np.argmin(change[::-1])])

    def add(self, doc: int, start: int, ids: bytes) -> None:
        size = len(ids) // 4
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        window.append((doc, start, ids))
        if level + size == self.length:
            self.close(window)
        else:
            self.open[level + size].append(window)
            self.counts[level + size] += 1

    def close(self, window: list) -> None:
        offset = 0
        for doc, start, ids in window:
            self.pieces.append((self.next, offset, doc, start, ids))
            offset += len(ids) // 4
        self.next += 1

    def add_document(self, doc: int, ids: bytes) -> None:
        full = len(ids) // 4 // self.length * self.length
        for start in range(0, full, self.length):
            self.close([(doc, start, ids[4 * start : 4 * (start + self.length)])])
        if len(ids) > 4 * full:
            self.add(doc, full, ids[4 * full :])

    def drain(self) -> None:
        """Puts what is still open into full windows, cutting pieces where a window ends; only the last has padding."""
        window, room = [], self.length
        for level in range(self.length - 1, 0, -1):
            for doc, start, ids in (piece for w in self.open[level] for piece in w):
                while ids:
                    part, ids = ids[: 4 * room], ids[4 * room :]
                    window.append((doc, start, part))
                    start, room = start + len(part) // 4, room - len(part) // 4
                    if room == 0:
                        self.close(window)
                        window, room = [], self.length
        if window:
            self.close(window)


def pack(
    docs: DataFrame, length: int = LENGTH, end_id: int = 0, ranks: str | None = None, keep_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``(id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``, with ``ids`` if asked for.

    Every row of ``docs`` is one document: its ids and then ``end_id``; a null text is an empty one. Repeated rows and
    null ids are documents of their own. Only the last sequence of a lane can be shorter than ``length``. ``docs`` should be a
    stored table, so that a repeated task sees the same rows in the same order.
    """
    ranks = ranks or tokens.default_ranks()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    zeros = [F.lit(0).cast("long").alias(n) for n in numbers] + [F.lit(b"").alias("ids")] * keep_ids
    schema = rows.select("id", *zeros).schema
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.words_of(ranks)
        lane = Lane(length, TaskContext.get().partitionId() << 32)
        open_docs: dict[int, list] = {}  # documents with pieces that are not out yet: id, tokens, tokens not out
        kind, count = None, 0

        def out() -> pa.RecordBatch:
            columns: list[list] = [[] for _ in range(7 + keep_ids)]
            for sequence, offset, doc, start, ids in lane.pieces:
                info = open_docs[doc]
                values = (info[0], start, len(ids) // 4, zlib.crc32(ids), info[1], sequence, offset, ids)
                for column, value in zip(columns, values):
                    column.append(value)
                info[2] -= len(ids) // 4
                if not info[2]:
                    del open_docs[doc]
            lane.pieces.clear()
            arrays = [pa.array(columns[0], kind)] + [pa.array(c, pa.int64()) for c in columns[1:7]]
            arrays += [pa.array(c, pa.binary()) for c in columns[7:]]
            return pa.RecordBatch.from_arrays(arrays, names=["id", *numbers, *["ids"] * keep_ids])

        for batch in batches:
            kind, texts = batch.column(0).type, batch.column(1)
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                ids = tokens.encode(texts[row].as_py(), words) + end
                n = len(ids) // 4
                open_docs[count] = [doc_id, n, n]
                lane.add_document(count, ids)
                count += 1
                if len(lane.pieces) >= ROWS_OUT:
                    yield out()
        lane.drain()
        if lane.pieces:
            yield out()

    return rows.mapInArrow(run, schema)


@query(tested_by="tests/llm/test_text_operators.py")
def op5_sum_of_squares(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
