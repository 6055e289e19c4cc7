"""Quality rules: word, symbol and repetition counts, and bands of Zstandard compression ratios.

Text that compresses far better than prose of its length is repetitive, text that hardly
compresses is noise. Limits depend on the length in bytes, as short texts compress worse. The
whole document must lie within the band for its length, and so must most of its fixed-size chunks,
which finds long documents that are only partly repetitive or random.

Results in odd cases: null text is treated as empty: no words, ratio null, rejected by the base
rule. Repeated rows each get a row. Whole texts are measured, whatever their length. Columns that
clash with an output name are replaced; others are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quern.llm.aside import set_aside


@dataclass(frozen=True)
class Rules:
    """Limits. bands: (length in bytes up to which it holds, lowest ratio, highest ratio)."""

    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    chunk_bytes: int = 4096
    max_bad_chunk_share: float = 0.5
    bands: tuple[tuple[float, float, float], ...] = (
        (128, 0.60, 9.0),
        (256, 0.45, 1.10),
        (512, 0.35, 0.85),
        (1024, 0.30, 0.78),
        (2048, 0.27, 0.72),
        (4096, 0.25, 0.70),
        (16384, 0.22, 0.70),
        (float("inf"), 0.20, 0.70),
    )

    def within(self, size: int, ratio: float) -> bool:
        low, high = next((low, high) for top, low, high in self.bands if size <= top)
        return low <= ratio <= high


FIELDS = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("zstd_ratio", T.DoubleType()),
    ("bad_chunk_share", T.DoubleType()),
    ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()),
]


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a three-word window that occurs twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    total, covered = 0, 0  # covered: words before this index are counted
    for i, w in enumerate(windows):
        if w in often:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def measure(text: str | None, rules: Rules, zstd: zstandard.ZstdCompressor) -> tuple:
    """The values of ``FIELDS`` for one text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at blanks and 0x09 to 0x0D, and at nothing else
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = repeated_words(words)
    ratio = len(zstd.compress(raw)) / len(raw) if raw else None
    bad = 0
    for i in range(0, len(raw) if len(raw) > rules.chunk_bytes else 0, rules.chunk_bytes):
        chunk = raw[i : i + rules.chunk_bytes]
        bad += 0 if rules.within(len(chunk), len(zstd.compress(chunk)) / len(chunk)) else len(chunk)
    share = bad / len(raw) if raw else 0.0
    failed = len(words) < rules.min_words or 100 * repeated > rules.max_repeat_percent * len(words)
    kept = not failed and rules.within(len(raw), ratio) and share <= rules.max_bad_chunk_share
    return len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), repeated, ratio, share, failed, kept


def apply_rules(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``FIELDS``; one row per input row, no shuffle."""
    names = {n for n, _ in FIELDS}
    before = [f for f in docs.schema.fields if f.name.lower() not in names]
    schema = T.StructType(before + [T.StructField(n, t) for n, t in FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=rules.level, write_content_size=True)
        kinds = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.BooleanType(): pa.bool_()}
        for batch in batches:
            rows = [measure(t, rules, zstd) for t in batch.column(text).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * len(FIELDS)
            made = [pa.array(c, kinds[t]) for c, (_, t) in zip(columns, FIELDS, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in before), *made], names=[*(f.name for f in before), *(n for n, _ in FIELDS)])

    return docs.select(*[f"`{f.name}`" for f in before]).mapInArrow(run, schema)


def keep_passing(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows that pass, with their columns as they were."""
    moved, back = set_aside(docs, [n for n, _ in FIELDS])
    return back(apply_rules(moved, rules).where("kept"))
