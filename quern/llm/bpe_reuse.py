"""BPE encoding with content-defined chunk reuse, and decoding.

A text is cut where a rolling hash of the last sixteen bytes has its low bits clear, so equal
passages are cut alike wherever they stand. Each chunk is encoded once per task and looked up
after that. Tokens at a chunk's edges may be wrong, as words and merges cross the cut: a join is
repaired by encoding a window again, from a word beginning before the cut to one after it. The
repair is accepted when the window's first and last words come out exactly as the chunks have
them; else the window grows, in the end to the whole chunks.

Results in odd cases: null text is treated as empty and gives no ids; a special token's string in
a text is that token, as in the library; repeated rows each get a row. Other columns are kept,
except that ``ids`` or ``decoded`` replace columns of that name. Ids are little-endian unsigned
32-bit integers in a binary column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quern.llm import bpe

WINDOW = 16
#: Chunks have about this many bytes more than the least.
MEAN_BITS = 9
LEAST = 128
#: Tokens that a task's cache may hold; the older half goes when it is full.
CACHE_TOKENS = 3_000_000
#: Without a word beginning in so many tokens before a cut, the text is encoded at once.
REACH = 2000

_GEAR = np.random.Generator(np.random.PCG64(20240)).integers(0, 2**32, 256, dtype=np.uint32)


def cuts(raw: bytes) -> list[int]:
    """Offsets at which to cut UTF-8 text: content-defined, never inside a character."""
    if len(raw) < LEAST + WINDOW:
        return []
    b = np.frombuffer(raw, np.uint8)
    h, width = _GEAR[b], 1
    while width < WINDOW:
        h = (h[:-width] << np.uint32(width)) + h[width:]
        width *= 2
    # the top bits depend on all bytes of the window
    at = np.flatnonzero(h >> np.uint32(32 - MEAN_BITS) == 0) + WINDOW
    at = at[at < len(b)]
    at = at[b[at] & 0xC0 != 0x80]
    found, last = [], 0
    for i in at.tolist():
        if i - last >= LEAST:
            found.append(i)
            last = i
    return found


class Cache:
    """Chunk text to ids, in two generations with a bounded number of tokens."""

    def __init__(self, encoder: bpe.Encoder, limit: int = CACHE_TOKENS):
        self.encoder, self.limit, self.young, self.old, self.held, self.encoded = encoder, limit, {}, {}, 0, 0

    def ids(self, text: str) -> list[int]:
        found = self.young.get(text)
        if found is None:
            found = self.old.get(text)
            if found is None:
                found = self.encoder.encode(text)
                self.encoded += 1
            self.young[text] = found
            self.held += len(found) + 8
            if 2 * self.held > self.limit:
                self.young, self.old, self.held = {}, self.young, 0
        return found


def _begin_before(ids: list[int], begins: list[bool], i: int) -> int:
    """Index of the last word beginning before index i; 0 if there is none, -1 if it is too far."""
    stop = max(0, i - REACH)
    for k in range(i - 1, stop - 1, -1):
        if begins[ids[k]]:
            return k
    return 0 if stop == 0 else -1


def _begin_after(ids: list[int], begins: list[bool], i: int) -> int:
    for k in range(i, len(ids)):
        if begins[ids[k]]:
            return k
    return len(ids)


def encode_text(text: str, cache: Cache) -> list[int]:
    """Ids of a text, from the ids of its chunks."""
    encoder = cache.encoder
    if bpe.END_OF_TEXT in text:
        return encoder.encode(text)
    raw = text.encode()
    at = cuts(raw)
    if not at:
        return encoder.encode(text)
    begins, table = encoder.begins, encoder.bytes
    out: list[int] = []
    start = 0
    for stop in [*at, len(raw)]:
        ids = cache.ids(raw[start:stop].decode())
        if out:
            # guards: the words that must come out unchanged at either end of the window
            left, right = _begin_before(out, begins, len(out)), _begin_after(ids, begins, 0)
            while True:
                if left < 0:
                    return encoder.encode(text)
                guard_left = _begin_before(out, begins, left) if left else 0
                guard_right = _begin_after(ids, begins, right + 1) if right < len(ids) else right
                if guard_left < 0:
                    return encoder.encode(text)
                window = b"".join([table[t] for t in out[guard_left:]] + [table[t] for t in ids[:guard_right]])
                again = cache.ids(window.decode())
                before, after = out[guard_left:left], ids[right:guard_right]
                if again[: len(before)] == before and (not after or again[len(again) - len(after) :] == after):
                    del out[guard_left:]
                    out += again
                    out += ids[guard_right:]
                    break
                left, right = guard_left, guard_right
        else:
            out = list(ids)
        start = stop
    return out


def _extended(docs: DataFrame, name: str, kind: T.DataType) -> tuple[list[str], T.StructType]:
    kept = [f for f in docs.schema.fields if f.name.lower() != name]
    return [f.name for f in kept], T.StructType([*kept, T.StructField(name, kind)])


def encode(docs: DataFrame, text: str = "text", vocabulary: str = bpe.VOCABULARY, ranks: str = bpe.RANKS) -> DataFrame:
    """``docs`` without their text, with ``ids``."""
    kept, schema = _extended(docs.drop(text), "ids", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Cache(bpe.encoder(vocabulary, ranks))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                ids = [np.array(encode_text(t or "", cache), "<u4").tobytes() for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), pa.array(ids, pa.binary())], names=[*kept, "ids"])

    return docs.select(*[f"`{n}`" for n in kept], f"`{text}`").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str = bpe.VOCABULARY, ranks: str = bpe.RANKS) -> DataFrame:
    """Rows with ``ids``, and their text in ``decoded``; null ids give null."""
    kept, schema = _extended(encoded, "decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder(vocabulary, ranks)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = [None if b is None else encoder.decode(np.frombuffer(b, "<u4").tolist()) for b in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in kept), pa.array(texts, pa.string())], names=[*kept, "decoded"])

    return encoded.select(*[f"`{n}`" for n in kept]).mapInArrow(run, schema)
