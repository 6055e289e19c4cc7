"""Packing of tokenised documents into training sequences by best-fit decreasing.

Overlong documents are first cut into full windows; what is left of each document goes, longest
first, to the open window with the least room that still holds it. A segment tree over the
possible amounts of room finds that window in logarithmic time.

Each task packs what it reads, in groups of a bounded number of tokens, so nothing is shuffled and
no group grows with the input; only the last windows of a group can have room left.

Results in odd cases: null text is treated as empty, and a document always has at least the
closing id; repeated rows are packed as documents of their own. An empty table gives no pieces.
Columns other than the key and the text are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quern.llm import bpe

CAPACITY = 2048
CLOSING_ID = 1
#: A group is packed when it holds so many tokens.
GROUP_TOKENS = 6_000_000


class RoomTree:
    """A segment tree over amounts of room; each node tells whether any window below it is open."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.base)
        self.windows: list[list[int]] = [[] for _ in range(self.base)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        at = self.base + room
        while at and not self.open[at]:
            self.open[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room of at least ``need``."""
        at = self.base + need
        if not self.open[at]:
            while True:  # up until a right sibling has an open window
                if at == 1:
                    return None
                if not at & 1 and self.open[at + 1]:
                    at += 1
                    break
                at >>= 1
            while at < self.base:
                at *= 2
                if not self.open[at]:
                    at += 1
        room = at - self.base
        window = self.windows[room].pop()
        if not self.windows[room]:
            self.open[at] = 0
            at >>= 1
            while at and not (self.open[2 * at] or self.open[2 * at + 1]):
                self.open[at] = 0
                at >>= 1
        return room, window


def best_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """For each piece its window and its offset there; and the number of windows."""
    window_of, offset_of, opened = [0] * len(lengths), [0] * len(lengths), 0
    tree = RoomTree(capacity)
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        if (found := tree.take(lengths[i])) is None:
            found = capacity, opened
            opened += 1
        room, window = found
        window_of[i], offset_of[i] = window, capacity - room
        tree.add(room - lengths[i], window)
    return window_of, offset_of, opened


SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = bpe.VOCABULARY, ranks: str = bpe.RANKS) -> DataFrame:
    """One row per piece: its document's key, its place there and in its sequence, and its ids."""
    field = docs.schema[key]
    schema = T.StructType([T.StructField("key", field.dataType), *T._parse_datatype_string(SCHEMA).fields])
    made = ["start", "length", "doc_tokens", "sequence_id", "offset"]

    def packed(group: list[tuple], first: int) -> tuple[list[tuple], int]:
        """group: (key, ids). Rows, and the next free sequence."""
        whole, rest = [], []
        for key, ids in group:
            n = len(ids)
            for start in range(0, n - n % capacity, capacity):
                whole.append((key, start, capacity, n, ids[start : start + capacity]))
            if n % capacity:
                rest.append((key, n - n % capacity, n % capacity, n, ids[n - n % capacity :]))
        window_of, offset_of, opened = best_fit_decreasing([r[2] for r in rest], capacity)
        rows = [(*r[:4], first + i, 0, r[4].tobytes()) for i, r in enumerate(whole)]
        rows += [(*r[:4], first + len(whole) + w, o, r[4].tobytes()) for r, w, o in zip(rest, window_of, offset_of, strict=True)]
        return rows, first + len(whole) + opened

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(vocabulary, ranks)
        next_free = TaskContext.get().partitionId() << 32
        group, held = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal group, held, next_free
            rows, next_free = packed(group, next_free)
            group, held = [], 0
            for k in range(0, len(rows), 2000):
                part = list(zip(*rows[k : k + 2000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], kind), *(pa.array(c, pa.int64()) for c in part[1:6]), pa.array(part[6], pa.binary())], names=["key", *made, "ids"])

        for batch in batches:
            kind = batch.column(0).type
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = np.array([*encoder.encode(value or ""), CLOSING_ID], "<u4")
                    group.append((key, ids))
                    held += len(ids)
                    if held >= GROUP_TOKENS:
                        yield from flushed()
        if group:
            yield from flushed()

    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema).withColumnRenamed("key", key)
