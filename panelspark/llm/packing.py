"""Operator 2: sum-of-squares online packing of tokenised documents into windows.

Every document is tokenised whole and ends with an end id.  Its full windows leave at once;
what remains (shorter than a window) is placed online: a level array counts the open
windows by how full they are, and the piece goes to the level that makes the sum of the
squared counts smallest (a fresh window counts as level 0, a window that gets full leaves
the count; the fullest level wins ties).  That rule keeps the open windows few and spread.

Each task packs the rows it scans, so nothing is shuffled and nothing but the open windows
is kept (at most a few per level).  When a task's rows end, its open windows are run
together and cut anew into full windows; the last one is cut at powers of two, which need
no padding.  Sequence ids hold the task's number in the upper bits.

Results for odd input: null or empty text is one piece with the end id alone; repeated
rows are packed as often as they come; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_tokens import TEXT_BYTES, open_tokenizer, slices, with_end

CAPACITY = 2048
END_ID = 1
ROWS_OUT = 20_000          # rows of an output batch

NEVER = 1 << 40

class SumOfSquares:
    """Open windows by fill level; ``add`` returns the windows that got full."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.shut = np.full(capacity + 1, NEVER)        # NEVER at levels without a window, else 0
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]

    def level_for(self, size: int) -> int:
        """The level whose windows should take a piece of this size (0: a fresh window)."""
        n, top = self.count, self.capacity - size
        if top == 0:
            return 0
        change = n[1 + size:] - n[1:top + 1]        # half of what a move adds to the squares, less one
        change += change
        change += self.shut[1:top + 1]
        change[-1] -= 1                             # a window that gets full is counted no more
        at = top - 1 - int(change[::-1].argmin())
        return at + 1 if change[at] + 2 <= 2 * n[size] + 1 else 0

    def move(self, level: int, by: int) -> None:
        self.count[level] += by
        self.shut[level] = 0 if self.count[level] else NEVER

    def add(self, size: int, piece: tuple) -> list | None:
        level = self.level_for(size)
        window = [] if level == 0 else self.open[level].pop()
        if level:
            self.move(level, -1)
        window.append(piece)
        level += size
        if level == self.capacity:
            return window
        self.open[level].append(window)
        self.move(level, 1)
        return None

    def drain(self) -> list:
        """The pieces of all open windows, fullest windows first."""
        left = [p for level in reversed(self.open) for window in level for p in window]
        self.__init__(self.capacity)
        return left


def _cut_row(pieces: list, capacity: int) -> Iterator[list]:
    """Pieces run together, cut into full windows and at last into powers of two."""
    rest = sum(len(p[3]) // 4 for p in pieces)
    window, room = [], 0
    for doc, start, total, ids in pieces:
        at, n = 0, len(ids) // 4
        while at < n:
            if room == 0:
                if window:
                    yield window
                window, room = [], capacity if rest >= capacity else 1 << (rest.bit_length() - 1)
                rest -= room
            take = min(room, n - at)
            window.append((doc, start + at, total, ids[4 * at:4 * (at + take)]))
            at, room = at + take, room - take
    if window:
        yield window


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, cut_bytes: int = TEXT_BYTES) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padding
    of its sequence (0 at a power of two) and, if asked for, the ids themselves.

    ``cut_bytes`` of text are cut into words together: more costs less time and more memory per worker.
    """
    kept = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    fields = [T.StructField(id_col, kept.schema[0].dataType), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
              T.StructField("offset", T.LongType()), T.StructField("padding", T.IntegerType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, packer = open_tokenizer(tokenizer_path, leading_space=True), SumOfSquares(capacity)
        base, made, rows, target = TaskContext.get().partitionId() << 33, 0, [], None

        def close(window: list) -> None:
            nonlocal made
            used = sum(len(p[3]) // 4 for p in window)
            padding = 0 if used & (used - 1) == 0 else capacity - used
            offset = 0
            for doc, start, total, ids in window:
                n = len(ids) // 4
                row = (doc, start, n, zlib.crc32(ids), total, base + made, offset, padding)
                rows.append(row + (np.frombuffer(ids, dtype="<u4").tolist(),) if with_ids else row)
                offset += n
            made += 1

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), target)], schema=target)
            rows.clear()
            return batch

        def token_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for at, n in slices(batch.column(1), cut_bytes):
                flat, per = with_end(*tok.ids(batch.column(1).slice(at, n)), end_id)
                data, ends = flat.tobytes(), (4 * np.cumsum(per)).tolist()
                yield from zip(batch.column(0).slice(at, n).to_pylist(), (data[a:b] for a, b in zip([0, *ends], ends)))

        for batch in batches:
            if target is None:
                types = [batch.schema.field(0).type] + [pa.int64()] * 6 + [pa.int32()] + [pa.list_(pa.int32())] * with_ids
                target = pa.schema([pa.field(f.name, t) for f, t in zip(fields, types)])
            for doc, ids in token_rows(batch):
                total = len(ids) // 4
                full = total - total % capacity
                for start in range(0, full, capacity):
                    close([(doc, start, total, ids[4 * start:4 * (start + capacity)])])
                if full < total:
                    window = packer.add(total - full, (doc, full, total, ids[4 * full:]))
                    if window:
                        close(window)
                if len(rows) >= ROWS_OUT:
                    yield out()
        for window in _cut_row(packer.drain(), capacity):
            close(window)
            if len(rows) >= ROWS_OUT:
                yield out()
        if rows:
            yield out()

    return kept.mapInArrow(run, schema)
